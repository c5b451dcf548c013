"""Near duplicates among embeddings of equal label, by range searches in a robust-pruned flat graph.

1. Equal vectors of a label become one *point* with a number of copies.
2. Points of a label are split into shards by nearest pivots, again and again until a shard has at most ``SHARD`` points;
   a point also enters the shard of its second nearest pivot, so shards overlap. Pivots are fitted on a
   hash sample of about ``PIVOT_SAMPLE`` points of a shard; every point is assigned.
3. Inside a shard, points within half the link angle of a leader form its *ball*. All members of a ball are linked with
   each other by the triangle inequality, so a crowd of near copies is one node and its pairs are never listed.
4. Leaders of a shard get a pruned adjacency list each; a leader's lists from all its shards are united.
5. Every leader searches the graph of its home shard, from the medoid of that shard, widened by the near neighbours that
   united lists name outside it. The beam keeps growing while there are new leaders in range.
6. Pairs of balls found are verified: all or no members are linked where their radii decide, and members are compared block
   by block where they don't, always in double precision.
7. Recall is audited against brute force for ``AUDIT`` points chosen by hash; below ``LEAST_RECALL`` the search is run
   again with a beam twice as wide.

Defined results for odd rows: vectors that are null, empty or zero, hold null or non-finite components, or have no label or
no id link with nothing; their component is their own id, and they are kept (a missing id is a null component, kept).
Vectors of different lengths don't link. Rows are vectors, so equal rows are linked copies of each other. Empty tables give
no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_map, reach_workers, stored
from tidemark.llm.components import connected_components

COSINE = 0.93
SHARD = 1_024
PIVOT_SAMPLE = 2_048
MOST_PIVOTS = 64
MOST_ROUNDS = 16
DEGREE = 24
POOL = 48
SPREAD = 16
ALPHA = 1.2
BEAM = 32
OPENED = 4
AUDIT = 256
LEAST_RECALL = 0.95
MEMBERS = 256
_SAFE = 1e-9


def _unit(rows: list[bytes]) -> np.ndarray:
    """Rows as unit vectors in double precision."""
    found = np.stack([np.frombuffer(r, dtype="<f8") for r in rows])
    return found / np.linalg.norm(found, axis=1)[:, None]


def usable(vectors: DataFrame, embedding: str, id: str, label: str) -> DataFrame:
    """``id``, ``label`` as text and ``vector``: doubles of a usable vector, else null."""
    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            column = batch.column("vector")
            numbers = column.values.fill_null(float("nan")).to_numpy(zero_copy_only=False).astype("<f8") + 0.0
            offsets, out = column.offsets.to_numpy(), []
            named = np.asarray(batch.column("label").is_valid()) & np.asarray(batch.column("id").is_valid()) & np.asarray(column.is_valid())
            for k in range(batch.num_rows):
                own = numbers[offsets[k]: offsets[k + 1]]
                top = np.abs(own).max() if named[k] and len(own) else 0.0
                # Scaling by the largest component changes no cosine and keeps the norm finite.
                out.append((own / top).tobytes() if 0 < top < np.inf else None)
            yield {"id": batch.column("id"), "label": batch.column("label"), "vector": out}

    own = vectors.select(F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{label}`").cast("string").alias("label"), F.col(f"`{embedding}`").alias("vector"))
    return arrow_map(own, body, "id long, label string, vector binary")


def _points(rows: DataFrame) -> DataFrame:
    """One row per label and vector: number, smallest id, copies, and the shard it starts in (label and length)."""
    grouped = rows.where("vector is not null").groupBy("label", "vector").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"))
    start = F.concat_ws("/", F.length("vector").cast("string"), "label")
    return stored(grouped.select(F.monotonically_increasing_id().alias("node"), "label", "vector", "least", "copies", start.alias("shard")), "points")


def _pivots(points: DataFrame, large: DataFrame) -> DataFrame:
    """Pivots of every large shard, from a bounded sample of it: few sweeps of spherical k-means."""
    def fit(table: pa.Table) -> pa.Table:
        table = table.take(pa.array(np.argsort(table.column("node").to_numpy(), kind="stable")))
        sample = _unit(table.column("vector").to_pylist())
        k = min(len(sample), MOST_PIVOTS, -(-2 * table.column("points")[0].as_py() // SHARD))
        pivots = sample[np.linspace(0, len(sample) - 1, k).astype(int)]
        for _ in range(4):
            nearest = (sample @ pivots.T).argmax(axis=1)
            sums = np.zeros_like(pivots)
            np.add.at(sums, nearest, sample)
            norms = np.linalg.norm(sums, axis=1)
            pivots = np.where(norms[:, None] > 0, sums / np.maximum(norms, 1e-300)[:, None], pivots)
        return pa.table({"shard": [table.column("shard")[0].as_py()], "pivots": pa.array([pivots.astype("<f8").tobytes()], pa.binary())})

    reach_workers(points.sparkSession)
    # Hashes are even, so a threshold gives about the wanted number without a window over the shard.
    hashed = points.join(large, "shard").withColumn("hash", F.xxhash64("node") / F.lit(2.0**64) + 0.5)
    drawn = hashed.where(F.col("hash") <= F.lit(float(PIVOT_SAMPLE)) / F.col("points"))
    return drawn.select("shard", "points", "node", "vector").groupBy("shard").applyInArrow(fit, "shard string, pivots binary")


def _dealt(points: DataFrame, pivots: DataFrame) -> DataFrame:
    """The points of large shards in the shards of their nearest and, for home points, second nearest pivot."""
    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            if not batch.num_rows:
                continue
            shards = np.array(batch.column("shard").to_pylist(), dtype=object)
            home = np.asarray(batch.column("home"))
            taken, names, homes = [], [], []
            for shard in dict.fromkeys(shards):
                rows = np.flatnonzero(shards == shard)
                own = _unit(batch.column("vector").take(pa.array(rows)).to_pylist())
                centres = np.frombuffer(batch.column("pivots")[int(rows[0])].as_py(), dtype="<f8").reshape(-1, own.shape[1])
                order = np.argsort(-(own @ centres.T), axis=1, kind="stable")[:, :2]
                for rank in range(order.shape[1]):
                    chosen = np.ones(len(rows), dtype=bool) if rank == 0 else home[rows]
                    taken.append(rows[chosen])
                    names += [f"{shard}.{c}" for c in order[chosen, rank]]
                    homes.append(home[rows[chosen]] & (rank == 0))
            kept = batch.take(pa.array(np.concatenate(taken)))
            yield {"node": kept.column("node"), "vector": kept.column("vector"), "shard": names, "home": np.concatenate(homes)}

    return arrow_map(points.join(pivots, "shard"), body, "node long, vector binary, shard string, home boolean")


def shards(points: DataFrame, most: int = SHARD) -> DataFrame:
    """``node, vector, shard, home``: overlapping shards of at most ``most`` points each."""
    rest, done = points.select("node", "vector", "shard", F.lit(True).alias("home")), []
    for step in range(MOST_ROUNDS):
        sizes = stored(rest.groupBy("shard").agg(F.count(F.lit(1)).alias("points")), "shard-sizes")
        large = sizes.where(F.col("points") > most)
        done.append(rest.join(large, "shard", "left_anti"))
        if large.isEmpty():
            break
        if step == MOST_ROUNDS - 1:  # pivots no longer part what is left; cut it by hash, so that no task holds it whole
            cut = rest.join(large, "shard").withColumn("shard", F.concat_ws("#", "shard", F.expr(f"pmod(xxhash64(node), 1 + points div {most // 2})")))
            done.append(cut.select(*rest.columns))
            break
        rest = stored(_dealt(rest, stored(_pivots(rest, large), "pivots")), "dealt")
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return stored(out, "shards")


def _grouped(df: DataFrame, key: str, body, shape: str) -> DataFrame:
    reach_workers(df.sparkSession)
    return df.groupBy(key).applyInArrow(body, shape)


def _blocks(vectors: np.ndarray, size: int = 512) -> Iterator[tuple[int, np.ndarray]]:
    for start in range(0, len(vectors), size):
        yield start, vectors[start: start + size] @ vectors.T


def balls(sharded: DataFrame, cosine: float = COSINE) -> DataFrame:
    """``node, leader, near``: the leader of each point and the cosine to it; half the link angle bounds a ball."""
    bound = np.cos(np.arccos(cosine) / 2) + _SAFE

    def lead(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("node").to_numpy(), kind="stable")
        table = table.take(pa.array(order))
        nodes, own = table.column("node").to_numpy(), _unit(table.column("vector").to_pylist())
        leader, near = np.full(len(nodes), -1), np.zeros(len(nodes))
        for k in range(len(nodes)):
            if leader[k] < 0:
                cosines = own @ own[k]
                inside = (leader < 0) & (cosines >= bound)
                inside[k] = True
                leader[inside], near[inside] = nodes[k], np.minimum(cosines[inside], 1.0)
        return pa.table({"node": nodes, "leader": leader, "near": near})

    return stored(_grouped(sharded.where("home").select("shard", "node", "vector"), "shard", lead, "node long, leader long, near double"), "balls")


def prune(cosines: np.ndarray, degree: int = DEGREE, pool: int = POOL, alpha: float = ALPHA) -> list[np.ndarray]:
    """Robust-pruned neighbours of every point of a shard, given all cosines inside it.

    Of the ``pool`` nearest and ``SPREAD`` points spread over the shard, the nearest is taken, and every other one that is
    ``alpha`` times nearer to it than to the point goes; and so on up to ``degree``.
    """
    n = len(cosines)
    far = np.sqrt(np.maximum(2 - 2 * cosines, 0))
    spread = np.unique(np.linspace(0, n - 1, min(n, SPREAD)).astype(int))
    out: list[np.ndarray] = []
    for start in range(0, n, 128):
        rows = np.arange(start, min(n, start + 128))
        own = far[rows].copy()
        own[np.arange(len(rows)), rows] = np.inf
        nearest = np.argpartition(own, min(pool, n - 1), axis=1)[:, :pool] if n > pool else np.tile(np.arange(n), (len(rows), 1))
        pools = np.concatenate([nearest, np.tile(spread, (len(rows), 1))], axis=1)
        left = np.take_along_axis(own, pools, axis=1)
        between = far[pools[:, :, None], pools[:, None, :]]
        chosen = np.full((len(rows), degree), -1)
        reach = left.copy()
        for step in range(degree):
            best = left.argmin(axis=1)
            open_rows = np.flatnonzero(np.isfinite(left[np.arange(len(rows)), best]))
            if not len(open_rows):
                break
            chosen[open_rows, step] = pools[open_rows, best[open_rows]]
            taken = between[open_rows, best[open_rows]]
            left[open_rows] = np.where(alpha * taken <= reach[open_rows], np.inf, left[open_rows])
            left[open_rows, best[open_rows]] = np.inf
        out += [c[c >= 0] for c in chosen]
    return out


def _graph(leaders: DataFrame) -> DataFrame:
    """United adjacency lists, ``node, links`` (each with its cosine), of leaders (shard, node, vector)."""
    def build(table: pa.Table) -> pa.Table:
        nodes = table.column("node").to_numpy()
        own = _unit(table.column("vector").to_pylist())
        cosines = np.concatenate([b for _, b in _blocks(own)])
        lists: list[set[int]] = [set(x.tolist()) for x in prune(cosines)]
        for k, neighbours in enumerate([list(x) for x in lists]):
            for other in neighbours:
                if len(lists[other]) < 2 * DEGREE:
                    lists[other].add(k)
        medoid = int(cosines.sum(axis=1).argmax())
        reached, front = {medoid}, [medoid]
        while len(reached) < len(nodes):  # what the medoid does not reach hangs on its nearest reached point
            while front:
                front = [x for k in front for x in lists[k] if x not in reached and not reached.add(x)]
            lost = [k for k in range(len(nodes)) if k not in reached][:1]
            for k in lost:
                known = np.fromiter(reached, dtype=np.int64)
                lists[int(known[cosines[k, known].argmax()])].add(k)
                reached.add(k)
                front.append(k)
        links = [[{"to": int(nodes[x]), "near": round(float(cosines[k, x]), 6)} for x in sorted(own_links)] for k, own_links in enumerate(lists)]
        return pa.table({"node": nodes, "links": pa.array(links, pa.list_(pa.struct([("to", pa.int64()), ("near", pa.float64())])))})

    built = _grouped(leaders.select("shard", "node", "vector"), "shard", build, "node long, links array<struct<to: bigint, near: double>>")
    return stored(built.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("links"))).alias("links")), "graph")


def _walk(own: np.ndarray, links: np.ndarray, start: int, queries: np.ndarray, reach: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (place in queries, point) whose cosine is at least the query's reach, by beams that grow with what is in range."""
    n, count = len(own), len(queries)
    cosines = np.full((count, n + 1), -np.inf)  # the last column stands for no neighbour
    waiting = np.full((count, n + 1), -np.inf)  # cosines of seen points that are not opened yet
    for column, value in ((np.full(count, start), own[queries] @ own[start]), (queries, np.ones(count))):
        cosines[np.arange(count), column] = waiting[np.arange(count), column] = value
    active = np.arange(count)
    while len(active):
        seen, ahead = cosines[active, :n], waiting[active, :n]
        # A beam is the best points seen; what is in range widens it, so a crowd is opened as a whole.
        floor = -np.partition(-seen, beam - 1, axis=1)[:, beam - 1] if n > beam else np.full(len(active), -np.inf)
        in_range = (seen >= reach[active, None]).sum(axis=1)
        for row in np.flatnonzero(in_range):
            wide = min(beam + 2 * int(in_range[row]), n)
            floor[row] = -np.partition(-seen[row], wide - 1)[wide - 1]
        top = np.argpartition(-ahead, min(OPENED, n) - 1, axis=1)[:, :OPENED]
        best = np.take_along_axis(ahead, top, axis=1)
        rows, places = np.nonzero(np.isfinite(best) & (best >= floor[:, None]))
        chosen = top[rows, places]
        waiting[active[rows], chosen] = -np.inf
        flat = links[chosen].reshape(-1)
        asking = np.repeat(active[rows], links.shape[1])
        pairs = np.unique((asking * (n + 1) + flat)[(flat < n) & np.isneginf(cosines[asking, flat])])
        asking, flat = pairs // (n + 1), pairs % (n + 1)
        found = np.einsum("ij,ij->i", own[queries[asking]], own[flat])
        cosines[asking, flat] = waiting[asking, flat] = found
        active = active[np.unique(rows)]
    return np.nonzero(cosines[:, :n] >= reach[:, None])


def _searched(leaders: DataFrame, graph: DataFrame, cosine: float, beam: int) -> DataFrame:
    """Pairs of leaders ``a < b`` whose balls may hold linked members, with their cosine.

    A neighbour outside the shard only helps where it and the point that names it can both be in range of one query, so
    longer edges do not widen a shard; inside the shard they guide the search.
    """
    lists = leaders.join(graph, "node")
    inside = lists.select("shard", "node", "vector", "home", "wide", F.col("links.to").alias("links"))
    widest = 2 * float(np.arccos(cosine)) + 2 * F.col("wide")
    named = lists.select("shard", "wide", F.explode("links").alias("l")).where(F.col("l.near") >= F.cos(F.least(widest, F.lit(np.pi))))
    outer = (
        named.select("shard", F.col("l.to").alias("node")).distinct().join(leaders.select("shard", "node"), ["shard", "node"], "left_anti")
        .join(leaders.where("home").drop("shard", "home"), "node").join(graph, "node")
        .select("shard", "node", "vector", F.lit(False).alias("home"), "wide", F.col("links.to").alias("links"))
    )
    link = np.arccos(cosine)

    def search(table: pa.Table) -> pa.Table:
        nodes, home = table.column("node").to_numpy(), np.asarray(table.column("home"))
        own, wide = _unit(table.column("vector").to_pylist()), table.column("wide").to_numpy()
        place = {int(v): k for k, v in enumerate(nodes)}
        known = [[place[v] for v in x if v in place] for x in table.column("links").to_pylist()]
        links = np.full((len(nodes), max(map(len, known), default=0)), len(nodes))
        for k, x in enumerate(known):
            links[k, : len(x)] = x
        a, b, near = [], [], []
        widest = float(wide.max())
        queries = np.flatnonzero(home)
        centre = own[queries].sum(axis=0) if len(queries) else own.sum(axis=0)
        start = int(queries[(own[queries] @ centre).argmax()]) if len(queries) else 0
        for at in range(0, len(queries), 256):
            part = queries[at: at + 256]
            reach = np.cos(np.minimum(link + wide[part] + widest, np.pi)) - 1e-7
            q, found = _walk(own, links, start, part, reach, beam)
            q = part[q]
            cosines = np.einsum("ij,ij->i", own[q], own[found])
            apart = np.arccos(np.clip(cosines, -1, 1))
            keep = (q != found) & (apart <= link + wide[q] + wide[found] + 1e-7)
            a.append(nodes[q[keep]])
            b.append(nodes[found[keep]])
            near.append(cosines[keep])
        one, two = np.concatenate(a or [np.zeros(0, dtype=np.int64)]), np.concatenate(b or [np.zeros(0, dtype=np.int64)])
        return pa.table({"a": np.minimum(one, two), "b": np.maximum(one, two), "near": np.concatenate(near or [np.zeros(0)])})

    pairs = _grouped(inside.unionByName(outer), "shard", search, "a long, b long, near double")
    return stored(pairs.groupBy("a", "b").agg(F.max("near").alias("near")), "pairs")


def _member_blocks(members: DataFrame) -> DataFrame:
    """Balls in blocks of at most ``MEMBERS`` members: ``leader, block, nodes, vectors, copies``."""
    place = F.expr(f"pmod(xxhash64(node), 1 + size div {MEMBERS // 2})")
    return members.groupBy("leader", place.alias("block")).agg(
        F.collect_list(F.struct("node", "vector", "copies")).alias("rows")
    ).select("leader", "block", F.col("rows.node").alias("nodes"), F.col("rows.vector").alias("vectors"), F.col("rows.copies").alias("copies"))


def _verified(pairs: DataFrame, ball_sizes: DataFrame, members: DataFrame, cosine: float) -> tuple[DataFrame, DataFrame]:
    """Links of members to other balls, ``node, n``, and links between leaders, ``a, b``."""
    link = float(np.arccos(cosine))
    sizes = ball_sizes.select("leader", "wide", "total")
    known = pairs.join(sizes.toDF("a", "wide_a", "total_a"), "a").join(sizes.toDF("b", "wide_b", "total_b"), "b")
    apart = F.acos(F.least(F.col("near"), F.lit(1.0)))
    single = (F.col("wide_a") == 0) & (F.col("wide_b") == 0)
    judged = known.withColumn("apart", apart).withColumn(
        "sure", F.when(~single & (F.col("apart") + F.col("wide_a") + F.col("wide_b") <= link - 1e-7), True)
        .when(F.col("apart") - F.col("wide_a") - F.col("wide_b") > link + 1e-7, False)
    )
    judged = stored(judged.where("sure is null or sure"), "judged")
    sure = judged.where("sure")
    given = sure.select(F.col("a").alias("leader"), F.col("total_b").alias("n")).union(sure.select("b", "total_a"))
    whole = given.groupBy("leader").agg(F.sum("n").alias("n")).join(members.select("leader", "node"), "leader").select("node", "n")

    blocks = stored(_member_blocks(members), "members")
    open_pairs = judged.where("sure is null").select("a", "b")
    sided = [blocks.select(F.col("leader").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("nodes", "vectors", "copies")]) for s in "ab"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for row in range(batch.num_rows):
                at = {c: batch.column(c)[row].as_py() for c in batch.schema.names}
                linked = _unit(at["vectors_a"]) @ _unit(at["vectors_b"]).T >= cosine
                if linked.any():
                    n_a, n_b = linked @ np.array(at["copies_b"]), np.array(at["copies_a"]) @ linked
                    size = len(n_a) + len(n_b)
                    yield {"a": [at["a"]] * size, "b": [at["b"]] * size, "node": at["nodes_a"] + at["nodes_b"], "n": np.concatenate([n_a, n_b])}

    compared = stored(arrow_map(open_pairs.join(sided[0], "a").join(sided[1], "b"), compare, "a long, b long, node long, n long"), "compared")
    links = whole.unionByName(compared.select("node", "n")).groupBy("node").agg(F.sum("n").alias("n"))
    return links, sure.select("a", "b").unionByName(compared.select("a", "b").distinct())


def audit(points: DataFrame, counts: DataFrame, cosine: float = COSINE, most: int = AUDIT) -> float | None:
    """Share of the true links of at most ``most`` points, chosen by hash among all, that ``counts`` (node, n_links) has."""
    chosen = points.orderBy(F.xxhash64("node")).limit(most).join(counts, "node").select("node", "shard", "vector", "n_links").collect()
    if not chosen:
        return None
    by_shard: dict[str, list] = {}
    for row in chosen:
        by_shard.setdefault(row["shard"], []).append(row)
    asked = {s: (np.array([r["node"] for r in rows]), _unit([bytes(r["vector"]) for r in rows])) for s, rows in by_shard.items()}

    def true_links(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            names = np.array(batch.column("shard").to_pylist(), dtype=object)
            copies = batch.column("copies").to_numpy()
            for shard in set(names.tolist()) & set(asked):
                rows = np.flatnonzero(names == shard)
                nodes, own = asked[shard]
                linked = own @ _unit(batch.column("vector").take(pa.array(rows)).to_pylist()).T >= cosine
                same = nodes[:, None] == batch.column("node").to_numpy()[rows][None, :]
                yield {"node": nodes, "n": (linked | same) @ copies[rows] - same.sum(axis=1)}

    truth = arrow_map(points.select("node", "shard", "vector", "copies"), true_links, "node long, n long").groupBy("node").agg(F.sum("n").alias("n")).collect()
    wanted, got = {r["node"]: r["n"] for r in truth}, {r["node"]: r["n_links"] for r in chosen}
    total = sum(wanted.values())
    return sum(min(got[k], n) for k, n in wanted.items()) / total if total else 1.0


def near_duplicates(
    vectors: DataFrame, embedding: str = "embedding", id: str = "vec_id", label: str = "label", cosine: float = COSINE, beam: int = BEAM
) -> DataFrame:
    """One row per vector: id, ``n_links``, ``component_id``, ``kept``, and ``recall`` of the audit.

    A pair is linked only if its cosine was compared or follows from the ball's radius; which pairs are found is the
    search's, measured by the audit.
    """
    rows = stored(usable(vectors, embedding, id, label), "vectors")
    points = _points(rows)
    sharded = shards(points)
    members = stored(balls(sharded, cosine).join(points.select("node", "vector", "copies"), "node"), "ball-members")
    wide = F.acos(F.least(F.min("near"), F.lit(1.0)))
    # A leader's cosine to itself may miss 1 by rounding; a ball of one point has no radius.
    sizes = members.groupBy("leader").agg(
        F.count(F.lit(1)).alias("size"), F.sum("copies").alias("total"), F.when(F.count(F.lit(1)) > 1, wide + 1e-7).otherwise(0.0).alias("wide")
    )
    sizes = stored(sizes, "ball-sizes")
    leaders = stored(sharded.join(sizes.select(F.col("leader").alias("node"), "wide"), "node"), "leaders")
    graph = _graph(leaders)
    sized = members.join(sizes.select("leader", "size"), "leader")
    while True:
        pairs = _searched(leaders, graph, cosine, beam)
        outside, bridges = _verified(pairs, sizes, sized, cosine)
        known = members.select("node", "leader", "copies").join(outside, "node", "left").join(sizes.select("leader", "total"), "leader")
        counts = stored(known.select("node", "leader", (F.col("total") - 1 + F.coalesce("n", F.lit(0))).alias("n_links")), "counts")
        recall = audit(points, counts.select("node", "n_links"), cosine)
        if recall is None or recall >= LEAST_RECALL or beam > 8 * BEAM:
            break
        beam *= 2
    roots = connected_components(bridges).toDF("leader", "root")
    rooted = counts.join(roots, "leader", "left").withColumn("root", F.coalesce("root", "leader")).join(points.select("node", "label", "vector", "least"), "node")
    rooted = stored(rooted.select("root", "n_links", "label", "vector", "least"), "rooted")
    named = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("label", "vector", "n_links", "component_id")
    good = rows.where("vector is not null").join(named, ["label", "vector"]).select("id", "n_links", "component_id")
    alone = rows.where("vector is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    every = good.unionByName(alone).withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)))
    return every.withColumnRenamed("id", id).withColumn("recall", F.lit(recall).cast("double"))
