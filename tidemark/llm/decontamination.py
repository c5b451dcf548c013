"""Benchmark decontamination: windows of benchmark words found in documents by their rarest shingle."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.bytework import LOWER, run_hashes, runs, text_bytes, whole_windows, window_hashes
from tidemark.llm.common import arrow_map, pieces

WINDOW = 10
SHINGLE = 3
# Windows that one pass over the documents looks for; a larger benchmark takes several passes.
BLOCK_WINDOWS = 500_000
WORD = np.zeros(256, dtype=bool)
WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
FILTER_BITS = 20
SCAN = "_scan_text"
FOUND = "n_words long, hits array<struct<start: int, end: int>>, items array<string>"
RESULTS = ("n_words", "n_hit", "hits", "items", "contaminated")


def text_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every word: runs of digits, letters and non-ASCII characters, A-Z in lower case."""
    low = LOWER[data]
    starts, ends, row = runs(WORD[low], offsets)
    return run_hashes(low, starts, ends), row


def item_windows(items: list[tuple]) -> list[tuple]:
    """Distinct windows as (words, item): ten words each, or all words of a shorter item that has any."""
    seen = {}
    for item, text in items:
        raw = np.frombuffer((text or "").encode(), dtype=np.uint8)
        words, _ = text_words(raw, np.array([0, len(raw)]))
        size = min(WINDOW, len(words))
        for start in range(len(words) - size + 1 if size else 0):
            seen.setdefault((words[start: start + size].tobytes(), item), None)
    return list(seen)


class Block:
    """Windows of one pass, ordered by length; every window is looked up by one shingle of its words."""

    def __init__(self, windows: list[tuple]) -> None:
        self.items = [item for _, item in windows]
        self.words = [np.frombuffer(words, dtype=np.uint64) for words, _ in windows]
        self.key = np.zeros(0, dtype=np.uint64)

    def shingles(self) -> dict[int, list[np.ndarray]]:
        """For each shingle size that occurs, the shingles of each window of that size class."""
        return {n: [window_hashes(w, n) if min(SHINGLE, len(w)) == n else np.zeros(0, dtype=np.uint64) for w in self.words] for n in sorted({min(SHINGLE, len(w)) for w in self.words})}

    def order(self, frequency: dict[tuple[int, int], int]) -> None:
        """Chooses the rarest shingle of each window (ties: the first) as its key.

        A document holds the window only if it holds this one shingle: the necessary prefix of a containment of all words.
        """
        self.by_size = {}
        for size, lists in self.shingles().items():
            key, window, place = [], [], []
            for number, own in enumerate(lists):
                if len(own):
                    best = min(range(len(own)), key=lambda i: (frequency.get((size, int(own[i])), 0), i))
                    key.append(own[best])
                    window.append(number)
                    place.append(best)
            key = np.array(key, dtype=np.uint64)
            by_key = np.argsort(key, kind="stable")
            self.by_size[size] = (key[by_key], np.array(window)[by_key], np.array(place)[by_key], _filter(key))


def _filter(keys: np.ndarray) -> np.ndarray:
    bits = np.zeros(1 << FILTER_BITS, dtype=bool)
    bits[(keys >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
    return bits


def shingle_frequency(docs: DataFrame, block: Block, text_column: str = "text") -> dict[tuple[int, int], int]:
    """How often each shingle of the block occurs in all documents; the answer is no larger than the block."""
    wanted = {size: np.unique(np.concatenate(lists)) for size, lists in block.shingles().items()}
    spread = docs.sparkSession.sparkContext.broadcast({n: (keys, _filter(keys)) for n, keys in wanted.items()})

    def run(batches):
        counts = {n: np.zeros(len(keys), dtype=np.int64) for n, (keys, _) in spread.value.items()}
        for batch in pieces(batches, text_column):
            words, row = text_words(*text_bytes(batch.column(0)))
            for n, (keys, bits) in spread.value.items():
                found = window_hashes(words, n)
                found = found[bits[(found >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] & whole_windows(row, n)]
                at = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
                np.add.at(counts[n], at[keys[at] == found], 1)
        for n, (keys, _) in spread.value.items():
            some = np.flatnonzero(counts[n])
            yield {"size": np.full(len(some), n), "shingle": keys[some].view(np.int64), "n": counts[n][some]}

    rows = arrow_map(docs.select(F.col(text_column).cast("string")), run, "size int, shingle long, n long")
    return {(r["size"], r["shingle"] & 0xFFFFFFFFFFFFFFFF): r["n"] for r in rows.groupBy("size", "shingle").agg(F.sum("n").alias("n")).collect()}


def occurrences(words: np.ndarray, row: np.ndarray, block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Start and window number of every exact occurrence of a window inside one row."""
    starts, numbers = [], []
    for size, (keys, window, place, bits) in block.by_size.items():
        shingle = window_hashes(words, size)
        at = np.flatnonzero(bits[(shingle >> np.uint64(64 - FILTER_BITS)).astype(np.int64)]) if len(shingle) else np.zeros(0, dtype=np.int64)
        low, high = np.searchsorted(keys, shingle[at], side="left"), np.searchsorted(keys, shingle[at], side="right")
        many = high - low
        at, low = np.repeat(at[many > 0], many[many > 0]), np.repeat(low[many > 0], many[many > 0])
        first = np.concatenate([[True], (at[1:] != at[:-1])]) if len(at) else np.zeros(0, dtype=bool)
        run_start = np.maximum.accumulate(np.where(first, np.arange(len(at)), 0)) if len(at) else at
        entry = low + np.arange(len(at)) - run_start
        number, start = window[entry], at - place[entry]
        lengths = np.array([len(w) for w in block.words])[number]
        # Position and length bounds: the whole window must lie inside the row.
        ok = (start >= 0) & (start + lengths <= len(words))
        number, start, lengths = number[ok], start[ok], lengths[ok]
        ok = row[start] == row[start + lengths - 1]
        number, start, lengths = number[ok], start[ok], lengths[ok]
        for length in np.unique(lengths):
            these = np.flatnonzero(lengths == length)
            want = np.stack([block.words[k] for k in number[these]])
            same = (words[start[these][:, None] + np.arange(length)] == want).all(axis=1)
            starts.append(start[these][same])
            numbers.append(number[these][same])
    if not starts:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(starts), np.concatenate(numbers)


def scan_block(rows: DataFrame, block: Block) -> DataFrame:
    """Adds to ``hits`` the runs of words, and to ``items`` the items, that the windows of one block find in each row."""
    carried = [c for c in rows.columns if c not in ("n_words", "hits", "items")]
    shape = rows.select(*[F.col(f"`{c}`") for c in carried]).schema
    shape = T.StructType([*shape.fields, *T._parse_datatype_string(FOUND).fields])
    spread = rows.sparkSession.sparkContext.broadcast(block)

    def run(batches):
        own = spread.value
        lengths = np.array([len(w) for w in own.words], dtype=np.int64)
        for batch in pieces(batches, SCAN):
            column = {name: batch.column(k) for k, name in enumerate(batch.schema.names)}
            words, row = text_words(*text_bytes(column[SCAN]))
            n_words = np.bincount(row, minlength=batch.num_rows)
            first = np.concatenate([[0], np.cumsum(n_words)])
            start, number = occurrences(words, row, own)
            edges = np.zeros(len(words) + 1, dtype=np.int64)
            np.add.at(edges, start, 1)
            np.add.at(edges, start + lengths[number], -1)
            items: list[set] = [set() for _ in range(batch.num_rows)]
            for s, k in zip(start.tolist(), number.tolist()):
                items[int(row[s])].add(own.items[k])
            if "hits" in column:
                for r, (before, found) in enumerate(zip(column["hits"].to_pylist(), column["items"].to_pylist())):
                    items[r].update(found)
                    for hit in before:
                        edges[int(first[r]) + hit["start"]] += 1
                        edges[int(first[r]) + hit["end"]] -= 1
            hits: list[list] = [[] for _ in range(batch.num_rows)]
            for a, b, r in zip(*(x.tolist() for x in runs(np.cumsum(edges)[:-1] > 0, first))):
                hits[r].append({"start": a - int(first[r]), "end": b - int(first[r])})
            yield {c: column[c] for c in carried} | {"n_words": n_words, "hits": hits, "items": [sorted(i) for i in items]}

    return arrow_map(rows, run, shape)


def window_blocks(benchmark: DataFrame, item_column: str, text_column: str, size: int) -> Iterator[Block]:
    """The benchmark's windows in blocks of a fixed number; items come to the driver one partition at a time."""
    rows = benchmark.where(F.col(item_column).isNotNull()).select(F.col(item_column).cast("string"), F.col(text_column).cast("string"))
    waiting: list[tuple] = []
    for item, text in rows.toLocalIterator():
        waiting.extend(item_windows([(item, text)]))
        while len(waiting) >= size:
            yield Block(list(dict.fromkeys(waiting[:size])))
            waiting = waiting[size:]
    yield Block(list(dict.fromkeys(waiting)))


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, keep: list[str] | None = None, item_column: str = "item_id", text_column: str = "text",
    block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """Words of every document that lie inside an occurrence of a benchmark window, and the items they come from.

    One row per input row with the columns named in ``keep`` (all of them by default), ``n_words``, ``n_hit``, ``items``
    (as sorted strings) and ``contaminated``. The benchmark is the stated query set: it is taken in blocks of a fixed number
    of windows, each with a pass over the documents that needs no shuffle. Null texts have no words, items without words
    or without an id match nothing, repeated items count once, an empty benchmark hits nothing. Columns whose
    names clash with the results are replaced.
    """
    carried = [c for c in (keep if keep is not None else docs.columns) if c not in RESULTS]
    result = docs.select(*[F.col(f"`{c}`") for c in carried], F.col(text_column).cast("string").alias(SCAN))
    for block in window_blocks(benchmark, item_column, text_column, block_windows):
        block.order(shingle_frequency(docs, block, text_column) if block.words else {})
        result = scan_block(result, block)
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda a, h: a + h["end"] - h["start"])
    return result.select(*[F.col(f"`{c}`") for c in carried], "n_words", n_hit.alias("n_hit"), "items", (F.size("hits") > 0).alias("contaminated"))


def contamination_digest(found: DataFrame) -> DataFrame:
    """Counts and a checksum over the items of each document."""
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated",
    )
