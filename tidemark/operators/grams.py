"""Short byte strings of texts, as numbers: the index that names are looked up in."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

GRAM = 4
CUT = 1 << 21
# Names in a table that is sent as one row; bits of what tells wanted numbers from others.
PACKED = 200_000
FILTER_BITS = 23


def places(texts: DataFrame, keep: Sequence[str], body: str) -> DataFrame:
    """``keep``, ``__gram``, ``__next`` and ``__left`` for every place of a text with ``GRAM`` bytes of its UTF-8 form to come.

    ``__gram`` is these bytes, ``__next`` as many after them, zero where the text ends, and ``__left`` all bytes to come, at
    most twice ``GRAM``.
    """
    return _mapped(texts, keep, body, ["__gram", "__next", "__left"])


def gram_counts(texts: DataFrame, body: str) -> DataFrame:
    """``__gram`` and ``__times``, the places in all texts that hold it; a task adds up each cut of its texts first."""
    return _mapped(texts, [], body, ["__gram", "__times"]).groupBy("__gram").agg(F.sum("__times").alias("__times"))


def _mapped(texts: DataFrame, keep: Sequence[str], body: str, columns: Sequence[str]) -> DataFrame:
    given = texts.where(F.col(body).isNotNull()).select(*keep, F.col(body).cast("binary").alias("__bytes"))
    shape = T.StructType([*given.schema[:-1], *[T.StructField(c, T.LongType()) for c in columns]])
    target, most, cut = to_arrow_schema(shape), GRAM, CUT

    # Nested, so that workers get it with the task and need no copy of this package.
    def run(batches):
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            if not len(column) or column.buffers()[2] is None:
                continue
            width = np.int64 if pa.types.is_large_binary(column.type) else np.int32
            edges = np.frombuffer(column.buffers()[1], width)[column.offset: column.offset + len(column) + 1].astype(np.int64)
            data = np.frombuffer(column.buffers()[2], np.uint8)
            for low in range(int(edges[0]), int(edges[-1]), cut):
                high = min(low + cut, int(edges[-1]))
                window = np.zeros(high - low + 2 * most - 1, np.uint32)
                seen = data[low: min(high + 2 * most - 1, int(edges[-1]))]
                window[: len(seen)] = seen
                first, last = np.searchsorted(edges, low, "right") - 1, np.searchsorted(edges, high, "left")
                lengths = np.minimum(edges[first + 1: last + 1], high) - np.maximum(edges[first:last], low)
                row = np.repeat(np.arange(first, last), lengths)
                left = edges[row + 1] - np.arange(low, high)
                number = np.zeros(high - low + most, np.uint32)
                for step in range(most):
                    number = number << np.uint32(8) | window[step: step + high - low + most]
                whole = left >= most
                gram = number[: high - low][whole]
                if "__times" in columns:
                    values, at = np.unique(gram, return_counts=True), None
                else:
                    rest = np.minimum(left[whole] - most, most)
                    # What lies beyond the text's end is another text's.
                    after = number[most:][whole] >> (8 * (most - rest)) << (8 * (most - rest))
                    values, at = [gram, after, rest + most], row[whole]
                kept = [batch.column(i).take(pa.array(at)) for i in range(len(keep))]
                found = [*kept, *[pa.array(v.astype(np.int64)) for v in values]]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(found, target)], schema=target)

    return given.mapInArrow(run, shape)


def packed_names(names: DataFrame) -> DataFrame:
    """``__names``: tables of ``name``, ``needle``, ``__gram`` and ``__then`` as bytes, of up to ``PACKED`` names each."""
    limit = PACKED

    def run(batches):
        held, count = [], 0

        def packed():
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, held[0].schema) as out:
                for batch in held:
                    out.write_batch(batch)
            return pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["__names"])

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                count += batch.num_rows
            if count >= limit:
                yield packed()
                held, count = [], 0
        if held:
            yield packed()

    given = names.select("name", F.col("needle").cast("binary").alias("needle"), F.col("__gram").cast("long"), F.col("__then").cast("long"))
    return given.mapInArrow(run, "__names binary")


def names_in_texts(texts: DataFrame, row_keys: Sequence[str], body: str, names: DataFrame) -> DataFrame:
    """``row_keys`` and ``name``, each once, for every name of ``packed_names`` whose needle is in a text.

    The names go to the texts, since what is found may be many times either: the texts are dealt by their keys, so that a
    task sees all texts of a key one after the other and tells what it has given for it. The first row of a task brings the
    names. A needle is looked up by its ``__gram``, with ``__then`` after it where that is known, and compared in full; one of
    fewer than ``GRAM`` bytes is looked up as it is.
    """
    shape = T.StructType([*[texts.schema[k] for k in row_keys], T.StructField("name", T.StringType())])
    target, most, cut, bits, keys = to_arrow_schema(shape), GRAM, CUT, FILTER_BITS, len(row_keys)
    dealt = texts.where(F.col(body).isNotNull()).select(*row_keys, F.col(body).cast("binary").alias("__bytes"))
    dealt = dealt.repartition(*row_keys).sortWithinPartitions(*row_keys)
    first = F.when(F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0, 1)
    given = dealt.withColumn("__first", first).join(F.broadcast(names.withColumn("__first", F.lit(1))), "__first", "left").drop("__first")

    # Nested, so that workers get it with the task and need no copy of this package.
    def run(batches):
        class Lookup:
            """Needles by a number of theirs, behind a bit for every number that one of them has."""

            def __init__(self, number, needle):
                order = np.argsort(number, kind="stable")
                self.number, self.needle = number[order], needle[order]
                self.bits = np.zeros(1 << bits - 3, np.uint8)
                place = self.place(self.number)
                np.bitwise_or.at(self.bits, place >> np.uint64(3), np.uint8(1) << (place & np.uint64(7)).astype(np.uint8))

            def place(self, number):
                return number * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)

            def find(self, number):
                """Places in ``number`` and needles that have the number there."""
                place = self.place(number)
                at = np.flatnonzero(self.bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & np.uint8(1))
                low = np.searchsorted(self.number, number[at])
                times = np.searchsorted(self.number, number[at], "right") - low
                inside = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                return np.repeat(at, times), self.needle[np.repeat(low, times) + inside]

        class Names:
            def __init__(self, blobs):
                table = pa.concat_tables([pa.ipc.open_stream(b).read_all() for b in blobs]).combine_chunks()
                coded = table["name"].combine_chunks().dictionary_encode()
                self.names, self.name = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
                needles = table["needle"].to_pylist()
                self.size = np.array([len(x) for x in needles])
                self.start = np.cumsum(self.size) - self.size
                self.bytes = np.frombuffer(b"".join(needles), np.uint8)
                gram, then = (table[c].to_numpy() for c in ("__gram", "__then"))
                has_gram, has_then = ~np.isnan(gram.astype(float)), ~np.isnan(then.astype(float))
                head = [b"" if not g else int(a).to_bytes(most, "big") + (int(b).to_bytes(most, "big") if t else b"")
                        for g, t, a, b in zip(has_gram, has_then, gram, then)]
                # Where the needle is looked up.
                self.inside = np.array([x.index(h) for x, h in zip(needles, head)])
                number = np.array([int.from_bytes(h if g else x, "big") for g, h, x in zip(has_gram, head, needles)], np.uint64)
                size = np.where(has_then, 2 * most, np.where(has_gram, most, self.size))
                self.lookups = [(int(n), Lookup(number[size == n], np.flatnonzero(size == n))) for n in np.unique(size)]

            def found(self, data, edges, low, high):
                """Rows and names found at places from ``low`` to ``high``, each once, by row; ``edges`` says where the rows' texts start."""
                begin = max(low, 0)
                row = np.searchsorted(edges, np.arange(begin, high), "right") - 1
                number, out = {0: np.zeros(high - low, np.uint64)}, []
                window = np.zeros(high - low + 2 * most, np.uint64)
                seen = data[low: high + 2 * most]
                window[: len(seen)] = seen
                for step in range(2 * most):
                    number = {step + 1: number[step] << np.uint64(8) | window[step: step + high - low]}
                    for lookup in [x for n, x in self.lookups if n == step + 1]:
                        at, needle = lookup.find(number[step + 1])
                        begins, own = at + low - self.inside[needle], row[at]
                        ok = (begins >= edges[own]) & (begins + self.size[needle] <= edges[own + 1])
                        begins, own, needle = begins[ok], own[ok], needle[ok]
                        if step + 1 >= most:
                            for k in range(int(self.size[needle].max(initial=0))):
                                ok = self.size[needle] <= k
                                ok[~ok] = data[begins[~ok] + k] == self.bytes[self.start[needle[~ok]] + k]
                                if not ok.all():
                                    begins, own, needle = begins[ok], own[ok], needle[ok]
                        out.append(np.unique(own << 32 | self.name[needle]))
                return np.unique(np.concatenate(out))

        def read():
            """Rows with the names, which come before any other rows; the first row comes once for every table of names."""
            blobs, waiting = [], []
            for batch in batches:
                if not batch.num_rows:
                    continue
                if names is None:
                    brings = np.flatnonzero(batch.column(keys + 1).is_valid().to_numpy(zero_copy_only=False))
                    blobs += batch.column(keys + 1).take(pa.array(brings)).to_pylist()
                    if len(brings) and not waiting:
                        waiting.append(batch.slice(0, 1))
                    batch = batch.slice(len(brings))
                    if not batch.num_rows:
                        continue
                    yield blobs, waiting
                yield None, [batch]
            if names is None:
                yield blobs, waiting

        names, key, given = None, None, np.zeros(0, np.int64)
        for blobs, own in read():
            if blobs is not None:
                names = Names(blobs) if blobs else False
            for batch in own if names else []:
                column = batch.column(keys)
                width = np.int64 if pa.types.is_large_binary(column.type) else np.int32
                edges = np.frombuffer(column.buffers()[1], width)[column.offset: column.offset + len(column) + 1].astype(np.int64)
                data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
                rows = [repr(x) for x in zip(*[batch.column(i).to_pylist() for i in range(keys)])]
                # Rows of one key have one number, that of the first; the first may go on from the batch before.
                group = np.maximum.accumulate([0 if k and rows[k] == rows[k - 1] else k for k in range(len(rows))])
                now = 0
                if rows[0] != key:
                    given = np.zeros(0, np.int64)
                for low in range(int(edges[0]), int(edges[-1]), cut):
                    pair = names.found(data, edges, low, min(low + cut, int(edges[-1])))
                    pair = np.unique(group[pair >> 32] << 32 | pair & 0xFFFFFFFF)
                    last = int(group[np.searchsorted(edges, min(low + cut, int(edges[-1])) - 1, "right") - 1])
                    of_open = pair >> 32 == now
                    fresh = pair[~of_open | ~np.isin(pair & 0xFFFFFFFF, given)]
                    given = np.concatenate([given if last == now else given[:0], fresh[fresh >> 32 == last] & 0xFFFFFFFF])
                    now = last
                    kept = [batch.column(i).take(pa.array(fresh >> 32)) for i in range(keys)]
                    result = [*kept, names.names.take(pa.array(fresh & 0xFFFFFFFF))]
                    yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(result, target)], schema=target)
                if group[-1] != now:
                    given = given[:0]
                key = rows[-1]

    return given.mapInArrow(run, shape)
