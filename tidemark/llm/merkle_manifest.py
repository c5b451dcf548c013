"""Merkle manifest of a dataset: one tree per group of rows, one tree over the groups' roots, a proof for every row.

A row's leaf is the SHA-256 of its fields, each ``-`` if null, else its UTF-8 byte count, ``:`` and its value. Within a
group leaves stand in ascending order of the id. Their places come from bitmaps, not from a sort: every task marks ids in
words of 64 bits, words are merged by bitwise or, and directories of counts over chunks of 4,096 ids and over runs of
chunks turn a word into a rank. Nodes then go by place into arrays of ``BLOCK`` slots, and one shuffle reduces six levels.

Defined results for odd rows: a null group is a group of its own and comes first; rows without an id come before all ids;
rows that share an id stand in order of their leaves, equal rows one after the other, each a leaf of its own. Null and
empty texts differ (``-`` and ``0:``). An empty table has no rows and no root. Other columns are not read. Ids are integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_map, stored

FANOUT = 3
ROUND_LEVELS = 6
BLOCK = FANOUT**ROUND_LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

# Ids are cut into 18 + 17 + 17 bits of chunk number and 12 bits within a chunk, so a directory has at most 2 ** 18 rows.
_NO_ID = -(1 << 51) - 1


def leaf_digest(values: Sequence[Column]) -> Column:
    """Lower-case hexadecimal SHA-256 of the fields."""
    def field(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[field(v) for v in values]).cast("binary"), 256)


def _leaves(docs: DataFrame, fields: Sequence[str], group: str, order: str, claimed: dict[str, Column]) -> DataFrame:
    own = {f: F.col(f"`{f}`") for f in fields}
    name = F.col(f"`{group}`").cast("string")
    return docs.select(
        F.when(name.isNull(), "0").otherwise(F.concat(F.lit("1"), name)).alias("tree"),
        F.col(f"`{order}`").cast("long").alias("id"),
        F.unhex(leaf_digest(list(own.values()))).alias("leaf"),
        F.unhex(leaf_digest([claimed.get(f, c) for f, c in own.items()])).alias("claim"),
    )


def _addressed(rows: DataFrame) -> DataFrame:
    """Chunk, word in the chunk and bit in the word of each id."""
    return rows.withColumns({
        "chunk": F.coalesce(F.expr("shiftright(id, 12)"), F.lit(_NO_ID)),
        "word": F.coalesce(F.expr("cast(shiftright(id, 6) & 63 as int)"), F.lit(0)),
        "bit": F.coalesce(F.expr("cast(id & 63 as int)"), F.lit(0)),
    })


def _before(keys: list[str], order: str, count: str) -> Column:
    """Sum over the rows of the same keys that come earlier."""
    return F.coalesce(F.sum(count).over(Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def bitmap_index(leaves: DataFrame) -> DataFrame:
    """One row per tree and chunk of ids: the words that hold ids, their counts, and the rows of the tree before them.

    ``words`` lists only words with ids; ``present`` marks which of the 64 these are. ``more`` of a word has the bits that
    several rows share, with the rows beyond the first.
    """
    marked = _addressed(leaves.select("tree", "id"))
    cells = stored(
        marked.groupBy("tree", "chunk", "word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"), F.count(F.lit(1)).alias("n")), "cells"
    )
    shared = cells.where("n > bit_count(bits)").select("tree", "chunk", "word")
    more = (
        marked.join(shared, ["tree", "chunk", "word"], "left_semi").groupBy("tree", "chunk", "word", "bit").agg((F.count(F.lit(1)) - 1).alias("extra"))
        .where("extra > 0").groupBy("tree", "chunk", "word").agg(F.collect_list(F.struct("bit", "extra")).alias("more"))
    )
    nothing = F.expr("cast(array() as array<struct<bit: int, extra: bigint>>)")
    full = cells.join(more, ["tree", "chunk", "word"], "left").withColumn("more", F.coalesce("more", nothing))
    chunks = (
        full.withColumn("before", _before(["tree", "chunk"], "word", "n")).groupBy("tree", "chunk").agg(
            F.sum("n").alias("n"), F.bit_or(F.expr("shiftleft(1L, word)")).alias("present"),
            F.sort_array(F.collect_list(F.struct("word", "bits", "before", "more"))).alias("words"),
        )
    )
    return _with_bases(stored(chunks, "chunks"))


def _with_bases(chunks: DataFrame) -> DataFrame:
    """``base``: rows of the tree in lower chunks, by directories over three parts of the chunk number; ``nodes``: its rows."""
    parts = chunks.select("tree", "chunk", "n", F.expr("shiftright(chunk, 34)").alias("top"), F.expr("shiftright(chunk, 17) & 131071").alias("upper"))
    upper = parts.groupBy("tree", "top", "upper").agg(F.sum("n").alias("n"))
    top = upper.groupBy("tree", "top").agg(F.sum("n").alias("n"))
    whole = top.groupBy("tree").agg(F.sum("n").alias("nodes"))
    high = top.withColumn("b0", _before(["tree"], "top", "n")).drop("n").join(whole, "tree")
    middle = upper.withColumn("b1", _before(["tree", "top"], "upper", "n")).drop("n").join(high, ["tree", "top"])
    low = parts.withColumn("b2", _before(["tree", "top", "upper"], "chunk", "n")).drop("n").join(middle, ["tree", "top", "upper"])
    bases = low.select("tree", "chunk", F.expr("b0 + b1 + b2").alias("base"), "nodes")
    return chunks.drop("n").join(bases, ["tree", "chunk"])


def ranked(leaves: DataFrame, index: DataFrame) -> DataFrame:
    """The leaves with their place in the tree (``place``) and the tree's size (``nodes``)."""
    found = (
        _addressed(leaves).join(index, ["tree", "chunk"])
        .withColumn("cell", F.expr("words[cast(bit_count(present & ~shiftleft(-1L, word)) as int)]"))
        .withColumn("place", F.expr(
            "base + cell.before + bit_count(cell.bits & ~shiftleft(-1L, bit)) + aggregate(cell.more, 0L, (s, m) -> s + if(m.bit < bit, m.extra, 0L))"
        ))
        .withColumn("tied", F.expr("exists(cell.more, m -> m.bit = bit)"))
    )
    kept = stored(found.select("tree", "id", "leaf", "claim", "place", "nodes", "tied"), "ranked")
    return kept.where("not tied").drop("tied").unionByName(_tied(kept.where("tied").drop("tied")))


def _tied(rows: DataFrame) -> DataFrame:
    """Rows that share an id take consecutive places in order of their leaves; equal rows are counted, not listed."""
    counted = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("copies")).withColumn("head", F.expr("substring(leaf, 1, 2)"))
    heads = counted.groupBy("tree", "place", "head").agg(F.sum("copies").alias("copies"))
    heads = heads.withColumn("lower", _before(["tree", "place"], "head", "copies")).drop("copies")
    inside = Window.partitionBy("tree", "place", "head").orderBy("leaf", "claim").rowsBetween(Window.unboundedPreceding, -1)
    stepped = counted.withColumn("inside", F.coalesce(F.sum("copies").over(inside), F.lit(0))).join(heads, ["tree", "place", "head"])
    each = stepped.withColumn("copy", F.explode(F.expr("sequence(0L, copies - 1)")))
    return each.withColumn("place", F.expr("place + lower + inside + copy")).select(*rows.columns)


def _hashed(digests: list[bytes]) -> bytes:
    return hashlib.sha256(b"".join(digests)).hexdigest().encode()


def levels_of(nodes: int) -> int:
    """Levels until one node is left, at most those of one round."""
    levels = 0
    while nodes > 1 and levels < ROUND_LEVELS:
        nodes, levels = -(-nodes // FANOUT), levels + 1
    return levels


def _tree(digests: list[bytes], levels: int) -> list[list[bytes]]:
    rows = [digests]
    for _ in range(levels):
        low = rows[-1]
        rows.append([_hashed(low[i: i + FANOUT]) for i in range(0, len(low), FANOUT)])
    return rows


def _slots(batch: pa.RecordBatch, row: int, name: str) -> list:
    """Values of one field of a block, by slot."""
    cells = batch.column("slots")[row].values
    out: list = [None] * len(cells)
    for slot, value in zip(cells.field("slot").to_pylist(), cells.field(name).to_pylist()):
        out[slot] = value
    return out


def _digests(batch: pa.RecordBatch, row: int, name: str) -> list[bytes]:
    return [d.hex().encode() for d in _slots(batch, row, name)]


def _reduced(nodes: DataFrame, name: str) -> DataFrame:
    """Nodes (tree, place, nodes, id, leaf, claim) in blocks with keyed slots, and the digest of each block's top."""
    slot = F.struct(F.expr(f"cast(place % {BLOCK} as int)").alias("slot"), "id", "leaf", "claim")
    blocks = nodes.groupBy("tree", F.expr(f"place div {BLOCK}").alias("block")).agg(F.max("nodes").alias("nodes"), F.collect_list(slot).alias("slots"))

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            tops = [
                bytes.fromhex(_tree(_digests(batch, row, "leaf"), levels_of(n))[-1][0].decode())
                for row, n in enumerate(batch.column("nodes").to_pylist())
            ]
            yield {name: batch.column(name) for name in batch.schema.names} | {"top": tops}

    shape = "tree string, block long, nodes long, slots array<struct<slot: int, id: bigint, leaf: binary, claim: binary>>, top binary"
    return stored(arrow_map(blocks, body, shape), name)


def _rounds(nodes: DataFrame, most: int, name: str) -> list[DataFrame]:
    """Block tables from the leaves up, until every tree has one node; ``most`` is the size of the largest tree."""
    tables = [_reduced(nodes, name)]
    while (most := -(-most // BLOCK)) > 1:
        up = tables[-1].select("tree", F.col("block").alias("place"), F.expr(f"(nodes + {BLOCK - 1}) div {BLOCK}").alias("nodes"),
                               F.lit(None).cast("long").alias("id"), F.col("top").alias("leaf"), F.col("top").alias("claim"))
        tables.append(_reduced(up, name))
    return tables


_STEPS = "array<struct<before: string, after: string>>"


def _own_steps(rows: list[list[bytes]], slot: int) -> list[tuple[bytes, bytes]]:
    """The siblings to the left and to the right of a slot's path through its block."""
    steps = []
    for row in rows[:-1]:
        first = slot - slot % FANOUT
        steps.append((b"".join(row[first:slot]), b"".join(row[slot + 1: first + FANOUT])))
        slot //= FANOUT
    return steps


def _given_steps(value: list[dict]) -> list[tuple[bytes, bytes]]:
    return [(s["before"].encode(), s["after"].encode()) for s in value]


def _listed(steps: list[tuple[bytes, bytes]]) -> list[dict]:
    return [{"before": a.decode(), "after": b.decode()} for a, b in steps]


def _descend(blocks: DataFrame, tails: DataFrame) -> DataFrame:
    """Path of every node of ``blocks``, whose places are the blocks of the round below."""
    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for row in range(batch.num_rows):
                tail, start = batch.column("steps")[row].as_py(), batch.column("block")[row].as_py() * BLOCK
                digests = _digests(batch, row, "leaf")
                rows = _tree(digests, levels_of(batch.column("nodes")[row].as_py()))
                n = len(digests)
                yield {
                    "tree": [batch.column("tree")[row].as_py()] * n, "block": list(range(start, start + n)),
                    "steps": [_listed(_own_steps(rows, k)) + tail for k in range(n)], "subroot": [batch.column("subroot")[row].as_py()] * n,
                }

    joined = blocks.join(tails, ["tree", "block"])
    return arrow_map(joined, body, f"tree string, block long, steps {_STEPS}, subroot string")


@dataclass(frozen=True)
class Manifest:
    """Block tables of the leaves, paths of their blocks up to the root, and the root (null for an empty table)."""

    blocks: DataFrame
    tails: DataFrame
    root: str | None

    def proofs(self, paths: bool = False) -> DataFrame:
        """One row per leaf: id, leaf, subroot, root, checksum of its siblings, the root folded from the claimed leaf.

        ``paths`` adds the tree's name, the place and the siblings themselves, level by level.
        """
        extra = f", tree string, place long, path {_STEPS}" if paths else ""

        def body(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            for batch in batches:
                for row in range(batch.num_rows):
                    yield _proved(batch, row, paths)

        shape = f"id long, leaf string, claim string, subroot string, proof_sha256 string, folded_root string{extra}"
        found = arrow_map(self.blocks.join(self.tails, ["tree", "block"]), body, shape)
        return found.withColumn("root", F.lit(self.root).cast("string")).withColumn("verified", F.col("folded_root") == F.col("root"))


def _proved(batch: pa.RecordBatch, row: int, paths: bool) -> dict:
    digests, claims = _digests(batch, row, "leaf"), _digests(batch, row, "claim")
    rows = _tree(digests, levels_of(batch.column("nodes")[row].as_py()))
    tail = _given_steps(batch.column("steps")[row].as_py())
    ending = b"".join([a + b for a, b in tail])
    proofs, folded, own = [], [], []
    for slot, claim in enumerate(claims):
        steps = _own_steps(rows, slot)
        proofs.append(hashlib.sha256(b"".join([a + b for a, b in steps]) + ending).hexdigest())
        for a, b in steps + tail:
            claim = hashlib.sha256(a + claim + b).hexdigest().encode()
        folded.append(claim.decode())
        own.append(steps)
    n, start = len(digests), batch.column("block")[row].as_py() * BLOCK
    out = {
        "id": _slots(batch, row, "id"), "leaf": [d.decode() for d in digests], "claim": [d.decode() for d in claims],
        "subroot": [batch.column("subroot")[row].as_py()] * n, "proof_sha256": proofs, "folded_root": folded,
    }
    if paths:
        out |= {"tree": [batch.column("tree")[row].as_py()] * n, "place": list(range(start, start + n)), "path": [_listed(s + tail) for s in own]}
    return out


def _placed_trees(roots: DataFrame) -> DataFrame:
    """The trees' roots as leaves of one more tree, in bytewise order of their names (null first)."""
    spread = stored(roots.orderBy("tree").withColumn("at", F.monotonically_increasing_id()), "trees")
    parts = spread.groupBy(F.expr("shiftright(at, 33)").alias("part")).agg(F.count(F.lit(1)).alias("n"))
    starts = parts.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"))
    places = spread.withColumn("part", F.expr("shiftright(at, 33)")).join(starts, "part")
    return places.select("tree", "top", F.expr("start + (at & 8589934591)").alias("place"))


def build_manifest(
    docs: DataFrame, fields: Sequence[str] = FIELDS, group: str = "source", order: str = "doc_id", claimed: dict[str, Column] | None = None
) -> Manifest:
    """The manifest of ``docs``.

    ``claimed`` gives the values that some fields are claimed to have, to be checked against the manifest; the others, and
    all without it, are claimed as they are.
    """
    leaves = stored(_leaves(docs, fields, group, order, claimed or {}), "leaves")
    index = stored(bitmap_index(leaves), "index")
    most = index.agg(F.max("nodes")).first()[0]
    rounds = _rounds(ranked(leaves, index), most or 0, "blocks")
    trees = stored(_placed_trees(rounds[-1].select("tree", "top")), "roots")
    count = trees.count()
    upper = _rounds(
        trees.select(F.lit("").alias("tree"), "place", F.lit(count).cast("long").alias("nodes"), F.lit(None).cast("long").alias("id"),
                     F.col("top").alias("leaf"), F.col("top").alias("claim")), count, "top",
    )
    top = upper[-1].select(F.lower(F.hex("top"))).first()
    nowhere = F.expr(f"cast(array() as {_STEPS})")
    above = upper[-1].select("tree", "block", nowhere.alias("steps"), F.lit("").alias("subroot"))
    for table in reversed(upper):
        above = _descend(table, above)
    tails = trees.join(above.select(F.col("block").alias("place"), "steps"), "place").select(
        "tree", F.lit(0).cast("long").alias("block"), "steps", F.lower(F.hex("top")).alias("subroot")
    )
    for table in reversed(rounds[1:]):
        tails = _descend(table, tails)
    return Manifest(rounds[0], stored(tails, "tails"), top[0] if top else None)


def check_documents(docs: DataFrame, proofs: DataFrame, fields: Sequence[str] = FIELDS, order: str = "doc_id") -> DataFrame:
    """Whether each document leads to its proof's root; ``proofs`` come from ``Manifest.proofs(paths=True)``.

    Ids without a proof get null. Ids that occur more than once are compared with every proof of the id.
    """
    own = docs.select(F.col(f"`{order}`").cast("long").alias("id"), leaf_digest([F.col(f"`{f}`") for f in fields]).alias("own"))
    folded = F.aggregate("path", F.col("own"), lambda d, s: F.sha2(F.concat(s["before"], d, s["after"]).cast("binary"), 256))
    return own.join(proofs.select("id", "path", "root"), "id", "left").select("id", (folded == F.col("root")).alias("verified"))
