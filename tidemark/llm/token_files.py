"""Token files with random access: one zstandard frame per document, an index of documents and a seek table.

A file is a row of zstandard frames, each decodable by itself with ids as little-endian unsigned 16-bit numbers
(32-bit where the vocabulary needs it). A skippable frame then holds the index (document ids and token counts), and a
last skippable frame the seek table of the public seekable format: compressed size, decompressed size and checksum of
every frame, so that a reader fetches the tail and then only the frames it wants.
"""

from __future__ import annotations

import json
import struct

import numpy as np
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_map, pieces, stored
from tidemark.llm.token_ids import encoder, vocabulary_path

# Fixed values of the seekable zstandard format.
SKIPPABLE_MAGIC = 0x184D2A5E
INDEX_MAGIC = 0x184D2A50
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

END_ID = 2
MANIFEST = "file string, part int, n_docs long, n_tokens long, min_doc long, max_doc long"
TOKENS = "doc_id long, start long, n_tokens long, ids binary"


def _checksum(raw: bytes) -> int:
    return xxhash.xxh64(raw).intdigest() & 0xFFFFFFFF


class FrameWriter:
    """Writes one file frame by frame; only sizes and checksums stay in memory."""

    def __init__(self, sink, width: int, level: int = 3) -> None:
        self.sink, self.width, self.codec = sink, width, zstandard.ZstdCompressor(level=level)
        self.frames: list[tuple[int, int, int]] = []
        self.docs: list[int | None] = []
        self.counts: list[int] = []

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        raw = ids.astype(f"<u{self.width}").tobytes()
        frame = self.codec.compress(raw)
        self.sink.write(frame)
        self.frames.append((len(frame), len(raw), _checksum(raw)))
        self.docs.append(doc)
        self.counts.append(len(ids))

    def finish(self) -> None:
        index = self.codec.compress(json.dumps({"width": self.width, "docs": self.docs, "counts": self.counts}).encode())
        self.sink.write(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
        self.frames.append((len(index) + 8, 0, _checksum(b"")))
        table = np.array(self.frames, dtype="<u4").tobytes() + struct.pack("<IBI", len(self.frames), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        self.sink.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)


class FrameReader:
    """Reads the tail of a file, then single documents by their place."""

    def __init__(self, source) -> None:
        self.source, size = source, source.size()
        n, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE_MAGIC or not flags & CHECKSUM_FLAG:
            raise ValueError("no seek table with checksums at the end of the file")
        self.table = np.frombuffer(self._at(size - 9 - 12 * n, 12 * n), dtype="<u4").reshape(n, 3).astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.table[:, 0])])
        self.codec = zstandard.ZstdDecompressor()
        index = self._at(int(self.starts[n - 1]) + 8, int(self.table[n - 1, 0]) - 8)
        found = json.loads(self.codec.decompress(index))
        self.width, self.docs, self.counts = found["width"], found["docs"], found["counts"]
        self.bytes_read = 0

    def _at(self, start: int, length: int) -> bytes:
        self.source.seek(start)
        return self.source.read(length)

    def read(self, place: int) -> np.ndarray:
        """Ids of the document at ``place``; only its frame is fetched and decompressed."""
        packed, size, checksum = self.table[place].tolist()
        data = self._at(int(self.starts[place]), packed)
        self.bytes_read += packed
        raw = self.codec.decompress(data, max_output_size=size)
        if len(raw) != size or _checksum(raw) != checksum:
            raise ValueError(f"frame {place} does not match its checksum")
        return np.frombuffer(raw, dtype=f"<u{self.width}").astype(np.uint32)


def write_token_files(
    docs: DataFrame, folder: str, end_id: int = END_ID, vocabulary: str | None = None, partitions: int | None = None,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """Encodes all documents into files under ``folder`` in ascending order of document id; returns the manifest.

    The texts are dealt out by ranges of (id, text hash), so files follow each other in id order and rows that share an id
    are spread too. A task writes under a name of its own attempt and moves the file to its final name when it is complete;
    a repeated task replaces it by the same content. Null texts are empty documents (the end id alone), null ids come
    first, repeated rows are written each, an empty table gives no file; other columns are ignored.
    """
    spark = docs.sparkSession
    path = vocabulary or vocabulary_path()
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    width = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(width, F.col("doc_id").asc_nulls_first(), "tie")
    dealt = dealt.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie", "text").select("doc_id", "text")

    def run(batches):
        task = TaskContext.get()
        fs, base = pafs.FileSystem.from_uri(folder)
        code = encoder(path)
        size = 2 if max(code.size - 1, end_id) < 65_536 else 4
        name = f"part-{task.partitionId():06d}.tok"
        draft, sink, writer = f"{base}/_draft-{name}-{task.taskAttemptId()}", None, None
        for batch in pieces(batches, "text"):
            if sink is None:
                fs.create_dir(base, recursive=True)
                sink = fs.open_output_stream(draft)
                writer = FrameWriter(sink, size)
            for doc, ids in zip(batch.column(0).to_pylist(), code.encode(batch.column(1).to_pylist())):
                writer.add(doc, np.append(ids, np.uint32(end_id)))
        if sink is not None:
            writer.finish()
            sink.close()
            fs.move(draft, f"{base}/{name}")
            known = [d for d in writer.docs if d is not None]
            yield {
                "file": [name], "part": [task.partitionId()], "n_docs": [len(writer.docs)], "n_tokens": [sum(writer.counts)],
                "min_doc": [min(known, default=None)], "max_doc": [max(known, default=None)],
            }

    return stored(arrow_map(dealt, run, MANIFEST), "token-manifest")


def file_starts(manifest: DataFrame) -> DataFrame:
    """The manifest with the number of ids in all files before each; it has one row per file."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("file_start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).cast("long"))


def read_token_files(spark: SparkSession, manifest: DataFrame, folder: str, doc_ids: list[int] | None = None) -> DataFrame:
    """Documents from token files, all or those with the given ids: one row each with its ids and their
    number and place among the ids of all files.

    Files whose range of ids holds none of the wanted are not opened; in the others only wanted frames are read.
    """
    wanted = None if doc_ids is None else frozenset(doc_ids)
    files = file_starts(manifest)
    if wanted is not None:
        hits = F.exists(F.array(*[F.lit(x).cast("long") for x in sorted(wanted)]), lambda x: (x >= F.col("min_doc")) & (x <= F.col("max_doc")))
        files = files.where(hits if wanted else F.lit(False))
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        fs, base = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, position in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with fs.open_input_file(f"{base}/{name}") as source:
                    reader = FrameReader(source)
                    group, held = [], 0
                    for place, (doc, count) in enumerate(zip(reader.docs, reader.counts)):
                        if wanted is None or doc in wanted:
                            ids = reader.read(place).astype("<u4").tobytes()
                            group.append((doc, position, count, ids))
                            held += len(ids)
                        position += count
                        if held > 4_000_000:
                            yield _token_rows(group)
                            group, held = [], 0
                    if group:
                        yield _token_rows(group)

    return arrow_map(files.select("file", "file_start").repartition(width, "file"), run, TOKENS)


def _token_rows(group: list[tuple]) -> dict:
    doc, position, count, ids = zip(*group)
    return {"doc_id": list(doc), "start": list(position), "n_tokens": list(count), "ids": list(ids)}


def token_digests(tokens: DataFrame) -> DataFrame:
    """Start, number and checksum of each document's ids as read back from the files."""
    return tokens.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
