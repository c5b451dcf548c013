"""Vectors as short codes: each of 16 parts becomes the number of its nearest codebook entry.

Components become integers ``floor(scale * x)``, so all sums and distances are exact whatever the partitioning. The nearest
entry of a part is looked up by the coarse cell that holds it: the smallest and largest possible distance from the cell's box
to each entry rule out the entries that some other entry beats everywhere in the box; what is left is remembered for the cell,
and only those entries are evaluated for the parts in it. Entries at equal distance stay, so ties go to the lower number.

Defined results for odd rows: vectors that are null, empty, or hold null or non-finite components are left out, as are
vectors of another length than that of the smallest kept id, and vectors with a component of ``2 ** 19`` or more in
size, whose error could exceed a long. A length that the parts do not divide is filled up with zeros. Null and repeated
ids are rows like others; null ids come last and rows of the same id in order of their components when the first
codebooks are chosen. With fewer rows than entries the codebooks have as many entries as rows. An empty table gives no
rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_map, stored

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
LARGEST = 1 << 19

#: Bits of a component inside a cell; remembered cells of one part before the memory starts anew.
CELL_BITS = 5
MEMORY_CELLS = 1 << 16


def _whole(batch: pa.RecordBatch, name: str, length: int | None, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows with a usable vector, and their integer components; without ``length`` one row at a time may differ."""
    column = batch.column(name)
    if pa.types.is_fixed_size_list(column.type) or pa.types.is_large_list(column.type):
        column = column.cast(pa.list_(column.type.value_type))
    offsets = column.offsets.to_numpy()
    sizes, values = np.diff(offsets), column.values
    numbers = values.fill_null(float("nan")).to_numpy(zero_copy_only=False).astype(np.float64)
    rows = np.flatnonzero((sizes == length) & np.asarray(column.is_valid()))
    if not len(rows) or not length:
        return np.zeros(0, dtype=np.int64), np.zeros((0, length or 0), dtype=np.int64)
    taken = numbers[offsets[:-1][rows][:, None] + np.arange(length)]
    good = (np.abs(taken) < LARGEST).all(axis=1)
    return rows[good], np.floor(taken[good] * scale).astype(np.int64)


def integer_vectors(vectors: DataFrame, embedding: str = "embedding", carried: tuple[str, ...] = ("vec_id", "label"), scale: int = SCALE) -> DataFrame:
    """The carried columns and ``parts``: the components of every usable vector as 32-bit integers, part by part."""
    order = carried[0]
    fine = F.forall(embedding, lambda x: x.isNotNull() & (F.abs(x) < LARGEST))  # NaN is greater than any number here
    first = vectors.where(F.col(embedding).isNotNull() & (F.size(embedding) > 0) & fine).select(
        F.size(embedding).alias("n"), F.col(order).alias("id"), F.col(embedding).alias("e")
    ).orderBy(F.col("id").asc_nulls_last(), "e").first()
    length = first["n"] if first else 0
    width = -(-length // PARTS) * PARTS if length else 0

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            rows, whole = _whole(batch, embedding, length, scale)
            if not len(rows):
                continue
            filled = np.zeros((len(rows), width), dtype="<i4")
            filled[:, :length] = whole
            chosen = batch.take(pa.array(rows))
            yield {c: chosen.column(c) for c in carried} | {"parts": [r.tobytes() for r in filled]}

    kinds = ", ".join(f"`{c}` {vectors.schema[c].dataType.simpleString()}" for c in carried)
    return arrow_map(vectors.select(*[F.col(f"`{c}`") for c in (*carried, embedding)]), body, f"{kinds}, parts binary")


def unpacked(column: pa.Array) -> np.ndarray:
    """Rows x parts x components."""
    rows = [np.frombuffer(v, dtype="<i4") for v in column.to_pylist()]
    return np.stack(rows).reshape(len(rows), PARTS, -1).astype(np.int64)


def first_codebooks(whole: DataFrame, order: str = "vec_id", entries: int = ENTRIES) -> np.ndarray:
    """Parts x entries x components: the vectors of the smallest ids."""
    chosen = whole.orderBy(F.col(order).asc_nulls_last(), "parts").select("parts").limit(entries).collect()
    if not chosen:
        return np.zeros((PARTS, 0, 0), dtype=np.int64)
    return unpacked(pa.array([bytes(r["parts"]) for r in chosen])).transpose(1, 0, 2).copy()


class CellMemory:
    """Nearest entries of one part position, looked up by coarse cells."""

    def __init__(self, entries: np.ndarray, bits: int = CELL_BITS, limit: int = MEMORY_CELLS) -> None:
        self.entries, self.bits, self.limit = entries, bits, limit
        self.known: dict[bytes, np.ndarray] = {}

    def _candidates(self, cells: np.ndarray) -> Iterator[np.ndarray]:
        """Entries of each cell that no other entry beats at every point of its box."""
        for start in range(0, len(cells), 1024):
            low = cells[start: start + 1024, None, :] << self.bits
            below, above = low - self.entries, self.entries - (low + (1 << self.bits) - 1)
            least = np.square(np.maximum(np.maximum(below, above), 0)).sum(axis=2)
            most = np.square(np.maximum(np.abs(below), np.abs(above))).sum(axis=2)
            for near in least <= most.min(axis=1)[:, None]:
                yield np.flatnonzero(near).astype(np.int32)

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of the nearest entry of each row."""
        cells, places = np.unique(parts >> self.bits, axis=0, return_inverse=True)
        keys = [c.tobytes() for c in cells]
        new = [k for k, key in enumerate(keys) if key not in self.known]
        if len(self.known) + len(new) > self.limit:
            self.known.clear()
            new = list(range(len(keys)))
        for k, found in zip(new, self._candidates(cells[new])):
            self.known[keys[k]] = found
        lists = [self.known[key] for key in keys]
        sizes = np.array([len(x) for x in lists], dtype=np.int64)
        flat, starts = np.concatenate(lists), np.concatenate([[0], np.cumsum(sizes)[:-1]])
        numbers, distances = np.empty(len(parts), dtype=np.int64), np.empty(len(parts), dtype=np.int64)
        places = places.reshape(-1)
        for size in np.unique(sizes):  # rows whose cells have equally many candidates form one array
            rows = np.flatnonzero(sizes[places] == size)
            for part in np.array_split(rows, -(-len(rows) * int(size) // 200_000)):
                tried = flat[starts[places[part]][:, None] + np.arange(size)]
                far = np.square(parts[part][:, None, :] - self.entries[tried]).sum(axis=2)
                best = far.argmin(axis=1)
                numbers[part], distances[part] = tried[np.arange(len(part)), best], far[np.arange(len(part)), best]
        return numbers, distances


def _summed(whole: DataFrame, books: np.ndarray) -> DataFrame:
    """Sums and counts of the parts nearest to each entry, added up in every task first."""
    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        memories = [CellMemory(b) for b in books]
        sums, counts = np.zeros(books.shape, dtype=np.int64), np.zeros(books.shape[:2], dtype=np.int64)
        for batch in batches:
            parts = unpacked(batch.column("parts")) if batch.num_rows else np.zeros((0, PARTS, books.shape[2]), dtype=np.int64)
            for p, memory in enumerate(memories):
                if len(parts):
                    numbers, _ = memory.nearest(parts[:, p])
                    np.add.at(sums[p], numbers, parts[:, p])
                    counts[p] += np.bincount(numbers, minlength=books.shape[1])
        used = np.argwhere(counts)
        yield {"part": used[:, 0], "entry": used[:, 1], "n": counts[tuple(used.T)], "total": list(sums[tuple(used.T)])}

    tasks = arrow_map(whole.select("parts"), body, "part int, entry int, n long, total array<bigint>")
    sums = [F.sum(F.get("total", F.lit(d))).alias(f"d{d}") for d in range(books.shape[2])]
    return tasks.groupBy("part", "entry").agg(F.sum("n").alias("n"), *sums)


def improved(whole: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks with every used entry replaced by the floor of the mean of its parts."""
    out = books.copy()
    for row in _summed(whole, books).collect():  # at most parts x entries rows
        out[row["part"], row["entry"]] = [row[f"d{d}"] // row["n"] for d in range(books.shape[2])]
    return out


def codebooks_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def train_codebooks(whole: DataFrame, order: str = "vec_id", entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (parts x entries x components) after the given rounds over all rows."""
    books = first_codebooks(whole, order, entries)
    for _ in range(rounds if books.size else 0):
        books = improved(whole, books)
    return books


def encode(whole: DataFrame, books: np.ndarray, carried: tuple[str, ...] = ("vec_id", "label")) -> DataFrame:
    """The carried columns, ``code`` (two hexadecimal digits a part) and ``error`` (squared distances over all parts)."""
    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        memories = [CellMemory(b) for b in books]
        for batch in batches:
            if not batch.num_rows:
                continue
            parts = unpacked(batch.column("parts"))
            found = [m.nearest(parts[:, p]) for p, m in enumerate(memories)]
            codes = np.stack([f[0] for f in found], axis=1).astype(np.uint8)
            yield {c: batch.column(c) for c in carried} | {"code": [r.tobytes().hex() for r in codes], "error": np.sum([f[1] for f in found], axis=0)}

    kinds = ", ".join(f"`{c}` {whole.schema[c].dataType.simpleString()}" for c in carried)
    return arrow_map(whole, body, f"{kinds}, code string, error long")


def decode(codes: DataFrame, books: np.ndarray, code: str = "code") -> DataFrame:
    """Adds ``decoded``: the integer components that each code stands for."""
    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            rows = [books[np.arange(PARTS), np.frombuffer(bytes.fromhex(c), dtype=np.uint8)].reshape(-1) for c in batch.column(code).to_pylist()]
            yield {c: batch.column(c) for c in batch.schema.names} | {"decoded": rows}

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in codes.schema)
    return arrow_map(codes, body, f"{kinds}, decoded array<bigint>")


def compress(vectors: DataFrame, embedding: str = "embedding", order: str = "vec_id", group: str = "label") -> tuple[DataFrame, np.ndarray]:
    """Codes of all usable vectors with their errors and the errors summed over equal groups, and the codebooks."""
    whole = stored(integer_vectors(vectors, embedding, (order, group)), "parts")
    books = train_codebooks(whole, order)
    coded = stored(encode(whole, books, (order, group)), "codes")
    sums = coded.groupBy(F.col(group).alias("__group")).agg(F.sum("error").alias("group_error"))
    joined = coded.join(sums, F.col(group).eqNullSafe(F.col("__group"))).drop("__group")
    return joined.withColumn("codebooks_sha256", F.lit(codebooks_digest(books))), books
