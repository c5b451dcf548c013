"""Removal of long byte strings that an earlier document holds, by a common-prefix-aware merge of sorted suffix runs.

A string of ``SIZE`` bytes always holds an anchor: a place whose next ``GRAM`` bytes have the smallest hash among all such
places in it, which depends on nothing else. So only suffixes that start at anchors need sorting, and only
those whose first ``GRAM`` bytes some other document has at an anchor too.

1. Tasks send the grams of their anchors, packed and sorted, to buckets by gram; each document learns which are shared.
2. Tasks sort the suffixes at shared anchors, fold equal windows within their run into one with its smallest document,
   and send the runs front-coded to the buckets.
3. A bucket merges its runs with a tree of losers that keeps for every run how much its head has in common with the last
   output, so that no known prefix is compared again. Neighbours that share a gram form a group, in which every string of
   ``SIZE`` bytes around the anchor gets the smallest document that has it.
4. Grams in very many documents do not go that way, as a group stays in one task. For them tasks send every string of ``SIZE``
   bytes around the anchor as a hash with its smallest document, which Spark groups by string.
5. The spans found go back to their documents.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bytework import BYTE_CODE, POWERS, mix, text_bytes
from tidemark.llm.common import arrow_map, pieces, stored

SIZE = 50
GRAM = 24
BEFORE = SIZE - GRAM
GRAM_BITS = 48
FLUSH_ANCHORS = 1_000_000
FLUSH_SUFFIXES = 200_000
GROUP_ROWS = 20_000
PIECE = 1_000_000
# From so many documents on, a gram's strings are grouped by Spark instead of in one task.
HEAVY_DOCS = 100_000
# A task reports a gram from this share of ``HEAVY_DOCS`` on, so what is missed grows only with the number of tasks.
REPORTED = 5_000
# Buckets grow in number with the text.
BUCKET_BYTES = 2**26


def pack_arrays(arrays: list[np.ndarray]) -> bytes:
    """Arrays of numbers in one compressed value; bytes of equal weight lie together, which compresses sorted numbers well."""
    head = json.dumps([[a.dtype.str, len(a)] for a in arrays]).encode()
    body = b"".join(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes() if len(a) else b"" for a in arrays)
    return zstandard.ZstdCompressor(level=1).compress(struct.pack("<I", len(head)) + head + body)


def unpack_arrays(value: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(value)
    size = struct.unpack_from("<I", raw)[0]
    at, out = 4 + size, []
    for kind, n in json.loads(raw[4: 4 + size]):
        width = np.dtype(kind).itemsize
        planes = np.frombuffer(raw, dtype=np.uint8, count=n * width, offset=at).reshape(width, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += n * width
    return out


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place, row and gram (its hash) of every anchor."""
    n = len(data)
    none = np.zeros(0, dtype=np.int64)
    if n < SIZE:
        return none, none, none.astype(np.uint64)
    step = [BYTE_CODE[data]]
    for width in (1, 2, 4, 8):
        step.append(step[-1][:-width] * POWERS[width] + step[-1][width:])
    grams = mix(step[4][: n - GRAM + 1] * POWERS[8] + step[3][16: 16 + n - GRAM + 1])
    del step
    order = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    least = order
    for width in (1, 2, 4, 8):
        least = np.minimum(least[:-width], least[width:])
    span = SIZE - GRAM + 1
    least = np.minimum(least[: len(order) - span + 1], least[span - 16: span - 16 + len(order) - span + 1])
    # Windows that reach into the next row do not count.
    last = np.maximum(offsets[:-1], offsets[1:] - SIZE + 1)
    outside = np.zeros(n + 1, dtype=np.int64)
    np.add.at(outside, last, 1)
    np.add.at(outside, offsets[1:], -1)
    inside = np.cumsum(outside)[: len(least)] == 0
    chosen = np.zeros(len(grams), dtype=bool)
    chosen[(least[inside] & np.uint64(0xFFFFFFFF)).astype(np.int64)] = True
    place = np.flatnonzero(chosen)
    return place, np.searchsorted(offsets, place, side="right") - 1, grams[place] >> np.uint64(64 - GRAM_BITS)


def _buckets(grams: np.ndarray, width: int) -> np.ndarray:
    return (mix(grams) % np.uint64(width)).astype(np.int64)


def _docs(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def _gram_rows(docs: np.ndarray, grams: np.ndarray, width: int) -> dict:
    """Packed rows of one stretch: one document per gram to compare, and the rest of those that share it here already."""
    order = np.lexsort((docs, grams))
    docs, grams = docs[order], grams[order]
    if len(grams):
        new = np.concatenate([[True], (grams[1:] != grams[:-1]) | (docs[1:] != docs[:-1])])
        docs, grams = docs[new], grams[new]
    first = np.concatenate([[True], grams[1:] != grams[:-1]]) if len(grams) else np.zeros(0, dtype=bool)
    many = np.bincount(np.cumsum(first) - 1)[np.cumsum(first) - 1] > 1 if len(grams) else first
    bucket = _buckets(grams, width)
    out: dict[str, list] = {"bucket": [], "kind": [], "value": []}
    for kind, keep in ((0, first), (1, many & ~first)):
        at = np.flatnonzero(keep)
        at = at[np.argsort(bucket[at], kind="stable")]
        cuts = np.searchsorted(bucket[at], np.arange(width + 1))
        for b in np.flatnonzero(np.diff(cuts)):
            own = at[cuts[b]: cuts[b + 1]]
            known, number = np.unique(docs[own], return_inverse=True)
            delta = np.diff(grams[own], prepend=np.uint64(0))
            flags = many[own].astype(np.uint8)
            out["bucket"].append(int(b))
            out["kind"].append(kind)
            out["value"].append(pack_arrays([delta, number.astype(np.uint32), np.diff(known, prepend=0), flags]))
    return out


def _dealt(docs: np.ndarray, columns: list[np.ndarray], width: int) -> dict:
    """What was found for documents, packed for the bucket of documents that collects it."""
    order = np.argsort(docs, kind="stable")
    docs, columns = docs[order], [c[order] for c in columns]
    bucket = _buckets(docs.astype(np.uint64), width)
    out: dict[str, list] = {"bucket": [], "value": []}
    by_bucket = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[by_bucket], np.arange(width + 1))
    for b in np.flatnonzero(np.diff(cuts)):
        own = by_bucket[cuts[b]: cuts[b + 1]]
        out["bucket"].append(int(b))
        out["value"].append(pack_arrays([np.diff(docs[own], prepend=0), *[c[own] for c in columns]]))
    return out


def _collected(packed: DataFrame, width: int, rows, schema: str) -> DataFrame:
    """Everything found for the documents of each bucket, given to ``rows`` as arrays in order of the document."""
    def run(batches):
        current, held = None, []

        def give():
            docs, *columns = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(docs, kind="stable")
            return rows(docs[order], *[c[order] for c in columns])

        for batch in batches:
            for bucket, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if bucket != current and held:
                    yield give()
                    held = []
                current = bucket
                delta, *columns = unpack_arrays(value)
                held.append((np.cumsum(delta), *columns))
        if held:
            yield give()

    return arrow_map(packed.repartition(width, "bucket").sortWithinPartitions("bucket"), run, schema)


def _gram_lists(docs: np.ndarray, grams: np.ndarray) -> dict:
    known, start = np.unique(docs, return_index=True)
    raw, at = grams.astype("<u8").tobytes(), [*(start * 8).tolist(), len(grams) * 8]
    return {"doc_id": known, "marks": [raw[a:b] for a, b in zip(at, at[1:])]}


def _span_lists(docs: np.ndarray, checks: np.ndarray, begin: np.ndarray, end: np.ndarray) -> dict:
    order = np.lexsort((begin, checks, docs))
    docs, checks, pair = docs[order], checks[order], np.stack([begin[order], end[order]], axis=1).astype("<i4")
    start = np.flatnonzero(np.concatenate([[True], (docs[1:] != docs[:-1]) | (checks[1:] != checks[:-1])]))
    raw, at = pair.tobytes(), [*(start * 8).tolist(), len(docs) * 8]
    return {"doc_id": docs[start], "check": checks[start].astype(np.int64), "spans": [raw[a:b] for a, b in zip(at, at[1:])]}


def shared_grams(docs: DataFrame, width: int) -> DataFrame:
    """Per document the grams at its anchors that another document has at an anchor."""
    def send(batches):
        held, count = [], 0
        for batch in pieces(batches, "text", PIECE):
            place, row, gram = anchors(*text_bytes(batch.column(1)))
            held.append((batch.column(0).to_numpy()[row], gram))
            count += len(place)
            if count > FLUSH_ANCHORS:
                yield _gram_rows(*(np.concatenate(x) for x in zip(*held)), width)
                held, count = [], 0
        if held:
            yield _gram_rows(*(np.concatenate(x) for x in zip(*held)), width)

    sent = arrow_map(_docs(docs).where("doc_id is not null and text is not null"), send, "bucket int, kind int, value binary")
    dealt = sent.repartition(width, "bucket").sortWithinPartitions("bucket")
    return _collected(arrow_map(dealt, lambda batches: _compared(batches, width), "bucket int, value binary"), width, _gram_lists, "doc_id long, marks binary")


def _compared(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[dict]:
    """What the documents share in the buckets of one task, packed for the buckets of documents.

    It is collected over the task's rows, whose number grows with the senders: each of them would else give a row a bucket.
    """
    current, held, found, count = None, [], [], 0

    def flush():
        docs, grams = (np.concatenate(x) for x in zip(*found))
        return _dealt(docs, [grams], width)

    for batch in batches:
        for bucket, kind, value in zip(*(batch.column(k).to_pylist() for k in range(3))):
            if bucket != current and held:
                found.append(_shared(held))
                count += len(found[-1][0])
                held = []
            current = bucket
            delta, number, known, flags = unpack_arrays(value)
            docs, grams = np.cumsum(known)[number], np.cumsum(delta, dtype=np.uint64)
            if kind:
                found.append((docs, grams))
                count += len(docs)
            else:
                held.append((docs, grams, flags > 0))
            if count > FLUSH_ANCHORS:
                yield flush()
                found, count = [], 0
    if held:
        found.append(_shared(held))
    if found:
        yield flush()


def _shared(held: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """Documents and grams of one bucket, where another document has the gram."""
    docs, grams, many = (np.concatenate(x) for x in zip(*held))
    order = np.lexsort((docs, grams))
    docs, grams, many = docs[order], grams[order], many[order]
    first = np.concatenate([[True], grams[1:] != grams[:-1]])
    group = np.cumsum(first) - 1
    start = np.flatnonzero(first)
    end = np.concatenate([start[1:], [len(grams)]]) - 1
    wide = (docs[start] != docs[end]) | (np.maximum.reduceat(many.astype(np.uint8), start) > 0)
    keep = wide[group]
    return docs[keep], grams[keep]


def _runs(suffixes: list[tuple], width: int) -> dict:
    """Sorted, folded and front-coded runs of (right, left, doc, check, place, gram) by bucket."""
    out: dict[str, list] = {"bucket": [], "value": []}
    gram = np.array([s[5] for s in suffixes], dtype=np.uint64)
    bucket = _buckets(gram, width).tolist()
    by_bucket: dict[int, list[tuple]] = {}
    for b, s in zip(bucket, suffixes):
        by_bucket.setdefault(b, []).append(s)
    for b, own in by_bucket.items():
        own.sort()
        lcp, tails, lefts, count, owner, places = [], [], [], [], [], []
        last_right, last_left = b"", None
        for right, left, doc, check, place, _ in own:
            if right == last_right and left == last_left:
                count[-1] += 1
            else:
                same = common_prefix(last_right, right, 0)
                lcp.append(same)
                tails.append(right[same:])
                lefts.append(left)
                count.append(1)
                last_right, last_left = right, left
            owner.append((doc, check))
            places.append(place)
        known = sorted(set(owner))
        number = {pair: k for k, pair in enumerate(known)}
        value = pack_arrays([
            np.array(lcp, dtype=np.uint8), np.array([len(t) for t in tails], dtype=np.uint8), np.frombuffer(b"".join(tails), dtype=np.uint8),
            np.array([len(x) for x in lefts], dtype=np.uint8), np.frombuffer(b"".join(lefts), dtype=np.uint8),
            np.array(count, dtype=np.uint32), np.diff(np.array([d for d, _ in known], dtype=np.int64), prepend=0), np.array([c for _, c in known], dtype=np.uint32),
            np.array([number[pair] for pair in owner], dtype=np.uint32), np.array(places, dtype=np.uint32),
        ])
        out["bucket"].append(b)
        out["value"].append(value)
    return out


def heavy_grams(marks: DataFrame, heavy: int) -> np.ndarray:
    """Grams that more than about ``heavy`` documents share, sorted; at most one for so many anchors."""
    least = max(1, heavy // REPORTED)

    def run(batches):
        held, count = [], 0

        def flush():
            gram, place = np.unique(np.concatenate([g for g, _ in held]), return_inverse=True)
            return gram, np.bincount(place, np.concatenate([n for _, n in held]), len(gram)).astype(np.int64)

        for batch in batches:
            own = np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype="<u8")
            held.append(np.unique(own, return_counts=True))
            count += len(held[-1][0])
            if count > FLUSH_ANCHORS:
                gram, n = flush()
                # What is rare so far starts anew.
                often = n >= least
                yield {"gram": gram[often].view(np.int64), "n": n[often]}
                held, count = [], 0
        if held:
            gram, n = flush()
            yield {"gram": gram[n >= least].view(np.int64), "n": n[n >= least]}

    found = arrow_map(marks.select("marks"), run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    return np.sort(found.where(F.col("n") > heavy).select("gram").toArrow()["gram"].to_numpy().view(np.uint64))


def window_keys(data: np.ndarray) -> np.ndarray:
    """Hash of the ``SIZE`` bytes from every place on."""
    step = [BYTE_CODE[data]]
    for width in (1, 2, 4, 8, 16):
        step.append(step[-1][:-width] * POWERS[width] + step[-1][width:])
    n = len(data) - SIZE + 1
    return mix(step[5][:n] * POWERS[18] + step[4][32: 32 + n] * POWERS[2] + step[1][48: 48 + n])


def heavy_windows(marked: DataFrame, heavy: np.ndarray) -> DataFrame:
    """Every string of ``SIZE`` bytes around an anchor of the heavy grams: its hash and where it is."""
    heavy = marked.sparkSession.sparkContext.broadcast(heavy)

    def run(batches):
        for batch in pieces(batches, "text", PIECE):
            data, offsets = text_bytes(batch.column(1))
            place, row, gram = anchors(data, offsets)
            ok = np.isin(gram, heavy.value)
            starts = (place[ok][:, None] - np.arange(BEFORE + 1)).ravel()
            row = np.repeat(row[ok], BEFORE + 1)
            inside = (starts >= offsets[row]) & (starts + SIZE <= offsets[row + 1])
            starts, at = np.unique(starts[inside], return_index=True)
            row = row[inside][at]
            if len(starts):
                yield {
                    "window": window_keys(data)[starts].view(np.int64), "doc_id": batch.column(0).to_numpy()[row],
                    "check": batch.column(2).to_numpy()[row], "begin": starts - offsets[row],
                }

    return arrow_map(marked, run, "window long, doc_id long, check long, begin int")


def heavy_spans(marked: DataFrame, heavy: np.ndarray, width: int) -> DataFrame:
    """What the heavy grams' strings remove, packed for the buckets of their documents."""
    windows = heavy_windows(marked, heavy)
    first = windows.groupBy("window").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    later = windows.join(first.select("window", "first"), "window").where("doc_id > first").select("doc_id", "check", "begin")

    def run(batches):
        held, count = [], 0

        def flush():
            doc, check, begin = (np.concatenate(x) for x in zip(*held))
            return _dealt(doc, [check.astype(np.uint32), begin.astype(np.uint32), (begin + SIZE).astype(np.uint32)], width)

        for batch in batches:
            held.append(tuple(batch.column(k).to_numpy() for k in range(3)))
            count += batch.num_rows
            if count > 500_000:
                yield flush()
                held, count = [], 0
        if held:
            yield flush()

    return arrow_map(later, run, "bucket int, value binary")


def suffix_runs(marked: DataFrame, width: int, heavy: np.ndarray | None = None) -> DataFrame:
    """Front-coded sorted runs of the suffixes at shared anchors of documents (doc_id, text, check, marks), without heavy grams."""
    heavy = None if heavy is None or not len(heavy) else marked.sparkSession.sparkContext.broadcast(heavy)

    def run(batches):
        held: list[tuple] = []
        for batch in pieces(batches, "text", PIECE):
            data, offsets = text_bytes(batch.column(1))
            place, row, gram = anchors(data, offsets)
            marks = [np.frombuffer(m, dtype="<u8") for m in batch.column(3).to_pylist()]
            keys = np.concatenate([mix(m + mix(np.array([r], dtype=np.uint64))) for r, m in enumerate(marks)])
            ok = np.isin(mix(gram + mix(row.astype(np.uint64))), keys)
            if heavy is not None:
                ok &= ~np.isin(gram, heavy.value)
            raw, ids, checks = data.tobytes(), batch.column(0).to_pylist(), batch.column(2).to_pylist()
            starts, ends = offsets[row[ok]].tolist(), offsets[row[ok] + 1].tolist()
            for q, r, g, a, b in zip(place[ok].tolist(), row[ok].tolist(), gram[ok].tolist(), starts, ends):
                held.append((raw[q: min(q + SIZE, b)], raw[max(a, q - BEFORE): q], ids[r], checks[r], q - a, g))
                if len(held) >= FLUSH_SUFFIXES:
                    yield _runs(held, width)
                    held = []
        if held:
            yield _runs(held, width)

    return arrow_map(marked, run, "bucket int, value binary")


def common_prefix(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which ``known`` bytes need no look."""
    n = min(len(a), len(b))
    if a[known:n] == b[known:n]:
        return n
    differ = int.from_bytes(a[known:n], "big") ^ int.from_bytes(b[known:n], "big")
    return known + (8 * (n - known) - differ.bit_length()) // 8


class Run:
    """A front-coded run that is decoded one suffix at a time."""

    def __init__(self, value: bytes) -> None:
        lcp, tail_sizes, tails, left_sizes, lefts, count, known, checks, number, self.places = unpack_arrays(value)
        self.lcp, self.tails, self.lefts = lcp.tolist(), tails.tobytes(), lefts.tobytes()
        self.tail_ends = np.cumsum(tail_sizes, dtype=np.int64).tolist()
        self.left_ends = [0, *np.cumsum(left_sizes, dtype=np.int64).tolist()]
        self.docs, self.checks = np.cumsum(known)[number], checks[number]
        self.starts = [0, *np.cumsum(count, dtype=np.int64).tolist()]
        self.at, self.key, self.tail_at = -1, b"", 0

    def advance(self) -> int | None:
        """Moves to the next suffix; what it shares with the one before, or None at the end."""
        self.at += 1
        if self.at >= len(self.lcp):
            self.key = None
            return None
        same, end = self.lcp[self.at], self.tail_ends[self.at]
        self.key = self.key[:same] + self.tails[self.tail_at: end]
        self.tail_at = end
        return same


def merged(runs: list[Run]) -> Iterator[tuple[int, Run]]:
    """Suffixes of all runs in order, each with what it shares with the one before.

    A tree of losers: every inner node holds the run that lost there and the length its head shares with the suffix that
    beat it. Of two heads the one that shares more with the last output is smaller; only equal lengths are compared, from
    that length on.
    """
    size = 1
    while size < len(runs):
        size *= 2
    shared = [0] * size
    for k, run in enumerate(runs):
        run.advance()
    keys: list[bytes | None] = [run.key for run in runs] + [None] * (size - len(runs))

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser; the loser's length then refers to the winner."""
        x, y = keys[a], keys[b]
        if y is None:
            return a, b
        if x is None:
            return b, a
        if shared[a] != shared[b]:
            return (a, b) if shared[a] > shared[b] else (b, a)
        known = shared[a]
        same = common_prefix(x, y, known)
        if same == len(x) or (same < len(y) and x[same] < y[same]):
            shared[b] = same
            return a, b
        shared[a] = same
        return b, a

    losers = [-1] * size

    def build(node: int) -> int:
        if node >= size:
            return node - size
        winner, losers[node] = play(build(2 * node), build(2 * node + 1))
        return winner

    top = build(1) if size > 1 else 0
    while keys[top] is not None:
        run = runs[top]
        yield shared[top], run
        same = run.advance()
        keys[top], shared[top] = run.key, same or 0
        node = (top + size) // 2
        # The same rule as ``play``, without a call for each match.
        x = keys[top]
        while node:
            other = losers[node]
            y = keys[other]
            if y is not None:
                if x is None:
                    losers[node], top, x = top, other, y
                else:
                    known, theirs = shared[top], shared[other]
                    if known == theirs:
                        same = common_prefix(x, y, known)
                        if same == len(x) or (same < len(y) and x[same] < y[same]):
                            shared[other] = same
                        else:
                            shared[top] = same
                            losers[node], top, x = top, other, y
                    elif known < theirs:
                        losers[node], top, x = top, other, y
            node //= 2


class Groups:
    """Collects merged suffixes of some runs that share a gram and finds who had each string first."""

    def __init__(self, runs: list[Run]) -> None:
        self.rows: list[tuple] = []
        self.group = 0
        self.spans: list[tuple[np.ndarray, ...]] = []
        self.count = 0
        # The occurrences of all runs lie one behind the other; a suffix names its own by their places there.
        none = np.zeros(0, dtype=np.int64)
        self.docs, self.checks, self.places = (np.concatenate([none, *[getattr(r, k) for r in runs]]) for k in ("docs", "checks", "places"))
        base = 0
        for r in runs:
            r.base = base
            base += len(r.docs)

    def add(self, same: int, run: Run) -> None:
        if same < GRAM:
            self.group += 1
            if len(self.rows) >= GROUP_ROWS:
                self.settle()
        at = run.at
        self.rows.append((
            self.group, run.key, run.lefts[run.left_ends[at]: run.left_ends[at + 1]], run.base + run.starts[at], run.starts[at + 1] - run.starts[at],
        ))

    def settle(self) -> None:
        """Spans of all occurrences collected so far."""
        if not self.rows:
            return
        group, rights, lefts, starts, sizes = zip(*self.rows)
        self.rows = []
        n = len(group)
        group, sizes = np.array(group, dtype=np.uint64), np.array(sizes, dtype=np.int64)
        row = np.repeat(np.arange(n), sizes)
        first = np.cumsum(sizes) - sizes
        occurrence = np.arange(len(row)) + np.repeat(np.array(starts, dtype=np.int64) - first, sizes)
        doc, place = self.docs[occurrence], self.places[occurrence]
        least = np.minimum.reduceat(doc, first)
        left_size, right_size = np.array([len(x) for x in lefts]), np.array([len(x) for x in rights])
        low, high = np.full(n, SIZE), np.full(n, -1)
        # Only where the suffixes of a group differ in their smallest document can one take a string from another.
        opens = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        mixed = np.minimum.reduceat(least, opens) < np.maximum.reduceat(least, opens)
        some = np.flatnonzero(np.repeat(mixed, np.diff(np.append(opens, n))))
        if len(some):
            self._earlier(some, group[some], [rights[k] for k in some.tolist()], [lefts[k] for k in some.tolist()], left_size[some], right_size[some], least[some], low, high)
        # A later document of the same run has the whole window of the run's smallest one.
        whole = doc > least[row]
        begin = place - np.where(whole, left_size[row], high[row])
        end = place - np.where(whole, np.maximum(0, SIZE - right_size[row]), low[row]) + SIZE
        keep = np.where(whole, left_size[row] + right_size[row] >= SIZE, high[row] >= 0)
        self.spans.append((doc[keep], self.checks[occurrence][keep], begin[keep], end[keep]))
        self.count += int(keep.sum())

    @staticmethod
    def _earlier(some, group, rights, lefts, left_size, right_size, least, low, high) -> None:
        """Sets for the rows ``some`` how far back from the anchor the first and last string starts that a smaller document has."""
        n = len(some)
        window = np.frombuffer(b"".join([a.rjust(BEFORE, b"\0") + b.ljust(SIZE, b"\0") for a, b in zip(lefts, rights)]), dtype=np.uint8).reshape(n, BEFORE + SIZE)
        # One row a byte position, so that a string's hash is the difference of two rows that lie together.
        total = np.zeros((BEFORE + SIZE + 1, n), dtype=np.uint64)
        for k in range(BEFORE + SIZE):
            np.add(total[k], BYTE_CODE[window[:, k]] * POWERS[k], out=total[k + 1])
        salt = mix(group)
        for back in range(BEFORE + 1):
            ok = np.flatnonzero((left_size >= back) & (right_size >= SIZE - back))
            if not len(ok):
                continue
            key = mix(total[BEFORE + SIZE - back] - total[BEFORE - back] + salt)[ok]
            order = np.argsort(key)
            key, own = key[order], least[ok[order]]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            owner = np.repeat(np.minimum.reduceat(own, first), np.diff(np.append(first, len(key))))
            later = some[ok[order[owner < own]]]
            low[later], high[later] = np.minimum(low[later], back), np.maximum(high[later], back)

    def take(self, width: int) -> dict:
        """All spans found, packed for the buckets of their documents."""
        none = np.zeros(0, dtype=np.int64)
        doc, check, begin, end = (np.concatenate(x) for x in zip(*self.spans)) if self.spans else (none,) * 4
        self.spans, self.count = [], 0
        return _dealt(doc, [check.astype(np.uint32), begin.astype(np.uint32), end.astype(np.uint32)], width)


def repeated_spans(runs: DataFrame, width: int, others: DataFrame | None = None) -> DataFrame:
    """Merges the runs of each bucket; spans to remove as packed (start, end) per document, with those in ``others``."""
    def merge(values: list[bytes]):
        runs = [Run(v) for v in values]
        groups = Groups(runs)
        for same, run in merged(runs):
            groups.add(same, run)
            if groups.count > 500_000:
                yield groups.take(width)
        groups.settle()
        yield groups.take(width)

    def run(batches):
        current, held = None, []
        for batch in batches:
            for bucket, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if bucket != current and held:
                    yield from merge(held)
                    held = []
                current = bucket
                held.append(value)
        if held:
            yield from merge(held)

    dealt = runs.repartition(width, "bucket").sortWithinPartitions("bucket")
    found = arrow_map(dealt, run, "bucket int, value binary")
    return _collected(found if others is None else found.union(others), width, _span_lists, "doc_id long, check long, spans binary")


def without_spans(docs: DataFrame) -> DataFrame:
    """Documents (doc_id, text, spans) with the bytes outside all spans."""
    def run(batches):
        for batch in pieces(batches, "text", PIECE):
            data, offsets = text_bytes(batch.column(1))
            out: dict[str, list] = {"doc_id": batch.column(0).to_pylist(), "n_bytes": np.diff(offsets), "n_removed": [], "n_spans": [], "kept": []}
            for r, spans in enumerate(batch.column(2).to_pylist()):
                own = data[offsets[r]: offsets[r + 1]]
                if not spans:
                    out["n_removed"].append(0)
                    out["n_spans"].append(0)
                    out["kept"].append(own.tobytes())
                    continue
                pair = np.frombuffer(spans, dtype="<i4").reshape(-1, 2)
                edges = np.zeros(len(own) + 1, dtype=np.int64)
                np.add.at(edges, pair[:, 0], 1)
                np.add.at(edges, pair[:, 1], -1)
                gone = np.cumsum(edges)[:-1] > 0
                out["n_removed"].append(int(gone.sum()))
                out["n_spans"].append(int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()))
                out["kept"].append(own[~gone].tobytes())
            yield out

    return arrow_map(docs, run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def remove_repeats(docs: DataFrame, width: int | None = None, heavy_docs: int = HEAVY_DOCS) -> DataFrame:
    """For every row its number of bytes, of removed bytes and of removed runs, and the bytes that are kept.

    A byte goes if some string of 50 bytes over it also starts in a document with a smaller id. Texts are compared as UTF-8
    bytes and never across documents, so a cut may part a character: ``kept`` is binary. Strings are compared by 64-bit
    hashes within groups that share their anchor's bytes. Null and empty texts have no bytes; rows without an id stay
    whole and remove nothing; rows that share an id do not remove each other's bytes but all lose what earlier documents
    have; other columns are ignored; an empty table gives no rows.
    """
    # A checksum of the text tells rows apart that share an id.
    rows = _docs(docs).withColumn("check", F.crc32(F.col("text").cast("binary")))
    if not width:
        size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        width = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    marks = stored(shared_grams(docs, width), "shared-grams")
    heavy = heavy_grams(marks, heavy_docs)
    marked = rows.join(marks, "doc_id").select("doc_id", "text", "check", "marks")
    others = heavy_spans(marked, heavy, width) if len(heavy) else None
    spans = stored(repeated_spans(suffix_runs(marked, width, heavy), width, others), "repeated-spans")
    return without_spans(rows.join(spans, ["doc_id", "check"], "left").select("doc_id", "text", "spans"))
