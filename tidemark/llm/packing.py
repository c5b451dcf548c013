"""Harmonic packing of documents into training sequences of a fixed number of tokens."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_map, pieces
from tidemark.llm.token_ids import encoder, vocabulary_path

CAPACITY = 1024
END_ID = 0
SEQUENCES = """sequence_id long, n_tokens int, n_padding int, ids binary,
    pieces array<struct<doc_id: long, start: long, length: long, offset: long, doc_tokens: long>>"""
TASK_SEQUENCES = 2**32
EMIT = 512


def piece_lengths(length: int, capacity: int) -> list[int]:
    """Cuts of a document of ``length`` tokens.

    Whole sequences come first. A rest of r tokens belongs to class k = capacity // r, whose bins take k
    pieces; where that would leave more than a 64th of the bin empty, the largest piece of class k + 1 is
    cut off, which fills its bins, and the remainder is looked at again.
    """
    lengths = [capacity] * (length // capacity)
    rest = length % capacity
    while rest:
        k = capacity // rest
        piece = rest if capacity - k * rest <= capacity // 64 else capacity // (k + 1)
        lengths.append(piece)
        rest -= piece
    return lengths


@dataclass
class Harmonic:
    """The open bins of one worker: class k holds up to k pieces of at most capacity / k tokens."""

    capacity: int
    bins: dict[int, list[tuple]] = field(default_factory=dict)

    def add(self, piece: tuple) -> list[tuple] | None:
        """A full bin, if this piece (ids, doc, start, doc tokens) fills one."""
        k = self.capacity // len(piece[0])
        held = self.bins.setdefault(k, [])
        held.append(piece)
        return self.bins.pop(k) if len(held) == k else None

    def close(self) -> Iterator[list[tuple]]:
        """The pieces of bins that stayed open, poured together into full sequences.

        At most one bin per class is open, so they hold less than two sequences' tokens per class. What is
        left after the last full sequence is cut by powers of two, which need no padding.
        """
        room, current = self.capacity, []
        for _, held in sorted(self.bins.items()):
            for ids, doc, start, total in held:
                while len(ids):
                    part = ids[:room]
                    current.append((part, doc, start, total))
                    ids, start, room = ids[room:], start + len(part), room - len(part)
                    if room == 0:
                        yield current
                        room, current = self.capacity, []
        self.bins.clear()
        left = self.capacity - room
        room = 1 << (left.bit_length() - 1) if left else 0
        tail: list[tuple] = []
        for ids, doc, start, total in current:
            while len(ids):
                part = ids[:room]
                tail.append((part, doc, start, total))
                ids, start, room, left = ids[room:], start + len(part), room - len(part), left - len(part)
                if room == 0:
                    yield tail
                    room, tail = 1 << (left.bit_length() - 1) if left else 0, []


def _rows(sequences: list[list[tuple]], capacity: int, first: int) -> dict:
    out: dict[str, list] = {name: [] for name in ("sequence_id", "n_tokens", "n_padding", "ids", "pieces")}
    for number, held in enumerate(sequences):
        lengths = [len(p[0]) for p in held]
        filled = sum(lengths)
        padding = 0 if filled & (filled - 1) == 0 else capacity - filled
        offsets = np.concatenate([[0], np.cumsum(lengths)[:-1]]).tolist()
        out["sequence_id"].append(first + number)
        out["n_tokens"].append(filled)
        out["n_padding"].append(padding)
        out["ids"].append(np.concatenate([*(p[0] for p in held), np.zeros(padding, dtype=np.uint32)]).astype("<u4").tobytes())
        out["pieces"].append([
            {"doc_id": p[1], "start": p[2], "length": n, "offset": at, "doc_tokens": p[3]}
            for p, n, at in zip(held, lengths, offsets)
        ])
    return out


def pack_documents(
    docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, vocabulary: str | None = None, id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Sequences of at most ``capacity`` tokens from all documents, each ended by ``end_id``.

    One row per sequence: its ids as little-endian unsigned 32-bit numbers with zeros as padding (none where the
    number of tokens is a power of two), and the pieces in it with their place in document and sequence.
    Every partition of the input packs its own documents; nothing is shuffled and no bin is shared. Sequence numbers
    are unique, not contiguous. Null texts count as empty (one end id); a null id stays null; repeated rows are packed
    each; an empty table gives no sequence; other columns are ignored.
    """
    path = vocabulary or vocabulary_path()

    def run(batches):
        encode, bins = encoder(path).encode, Harmonic(capacity)
        task = TaskContext.get()
        number = (task.partitionId() if task else 0) * TASK_SEQUENCES
        full: list[list[tuple]] = []
        for batch in pieces(batches, text_column):
            names = batch.column(0).to_pylist()
            for doc, ids in zip(names, encode(batch.column(1).to_pylist())):
                ids = np.append(ids, np.uint32(end_id))
                start = 0
                for length in piece_lengths(len(ids), capacity):
                    done = bins.add((ids[start: start + length], doc, start, len(ids)))
                    start += length
                    if done:
                        full.append(done)
                if len(full) >= EMIT:
                    yield _rows(full, capacity, number)
                    number, full = number + len(full), []
        full.extend(bins.close())
        if full:
            yield _rows(full, capacity, number)

    return arrow_map(docs.select(F.col(id_column).cast("long"), F.col(text_column).cast("string")), run, SEQUENCES)


def packed_pieces(sequences: DataFrame) -> DataFrame:
    """One row per piece with the checksum of its ids, read from the sequence that holds it."""
    return sequences.select("sequence_id", "ids", F.explode("pieces").alias("p")).select(
        "p.doc_id", "p.start", "p.length",
        F.crc32(F.substring("ids", (F.col("p.offset") * 4 + 1).cast("int"), (F.col("p.length") * 4).cast("int"))).alias("ids_crc32"),
        "p.doc_tokens", "sequence_id", "p.offset",
    )
