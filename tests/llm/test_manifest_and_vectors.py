"""Merkle manifest, embedding near duplicates and vector codes against brute force, and on odd rows."""

import random
from collections import Counter

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import embedding_neardup, merkle_manifest, vector_codes
from tidemark.llm.queries import llm_queries

DOCS = "doc_id long, source string, lang string, n_chars long, text string, id string, tree string, leaf int"
VECTORS = "vec_id long, embedding array<float>, label int, vector string, node string, parts int"


def folder_of(tmp_path, frame, name):
    frame.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def plain(value):
    return (value is not None, value) if not isinstance(value, tuple) else tuple(plain(v) for v in value)


def documents():
    rng = random.Random(2)
    ids = [rng.choice([k, k * 5_000, -k, k << 40]) for k in range(900)]
    rows = [(i, rng.choice(["a", "a", "a", "b", "é", "Z"]), "en", len(str(i)), f"line {i}\nnext {i % 7}\n") for i in ids]
    rows += [(1, "solo", None, None, None), (7, "", "x", 0, ""), (8, None, "x", 3, "a\nb"), (-(2**63), None, None, None, "low\n"), (2**63 - 1, "a", None, 1, "high")]
    rows += [(None, "a", "n", k % 3, f"t{k % 40}\n") for k in range(200)] + [(5, "b", None, None, f"same id {k}") for k in range(300)]
    rows += [(6, "b", "en", 1, "equal\nrow")] * 50 + [(9, "long", None, 30_000, "x\n" * 15_000)]
    rng.shuffle(rows)
    return rows


def test_manifest_query_equals_brute_force(spark, tmp_path):
    rows = documents()
    frame = spark.createDataFrame([(*r, "clash", "clash", 0) for r in rows], DOCS).repartition(7)
    got = llm_queries()["op11_merkle_manifest"](spark, folder_of(tmp_path, frame, "documents")).collect()
    assert Counter(map(tuple, got)) == Counter(brute.merkle(rows))


@pytest.mark.parametrize("count", [1, 2, 3, 4, 729, 730, 2200])
def test_manifest_sizes_of_one_group(spark, tmp_path, count):
    rows = [(k * 3, "s", None, None, f"{k}\n") for k in range(count)]
    frame = spark.createDataFrame([(*r, None, None, None) for r in rows], DOCS)
    got = llm_queries()["op11_merkle_manifest"](spark, folder_of(tmp_path, frame, "documents")).collect()
    assert sorted(map(tuple, got)) == sorted(brute.merkle(rows))


def test_manifest_of_nothing_and_documents_checked_against_proofs(spark):
    none = merkle_manifest.build_manifest(spark.createDataFrame([], DOCS))
    assert none.root is None and none.proofs(paths=True).collect() == []
    rows = [(k, f"s{k % 3}", None, None, f"text {k}", None, None, None) for k in range(40)]
    frame = spark.createDataFrame(rows, DOCS)
    proofs = merkle_manifest.build_manifest(frame).proofs(paths=True)
    changed = frame.withColumn("text", F.when(F.col("doc_id") % 4 == 0, F.lit("other")).otherwise(F.col("text")))
    seen = {r["id"]: r["verified"] for r in merkle_manifest.check_documents(changed, proofs).collect()}
    assert seen == {k: k % 4 != 0 for k in range(40)}
    places = {(r["tree"], r["place"]): r["id"] for r in proofs.collect()}
    assert [places["1s1", k] for k in range(13)] == [3 * k + 1 for k in range(13)]


def vectors():
    rng = np.random.default_rng(4)
    rows = []
    for label, crowd in ((1, 300), (2, 20), (None, 30)):
        centre = rng.normal(size=32)
        for _ in range(crowd):
            rows.append((centre + rng.normal(size=32) * rng.choice([0.02, 0.2, 0.35])).tolist())
            rows[-1] = (len(rows) - 1, rows[-1], label)
        for _ in range(400):
            own = rng.normal(size=32)
            rows.append((len(rows), own.tolist(), label))
            if rng.random() < 0.2:
                rows.append((len(rows), (own * rng.choice([1.0, 3.0]) + rng.normal(size=32) * 0.1).tolist(), label))
    rows = [(k, np.float32(e).tolist(), label) for k, e, label in rows]
    rows += [(5_000 + k, rows[0][1], 1) for k in range(40)] + [(6_000, None, 1), (6_001, [], 1), (6_002, [0.0] * 32, 1), (6_003, [1.0] * 16, 1), (6_004, [1.0] * 16, 1)]
    rows += [(6_005, [float("nan")] * 32, 1), (6_006, [float("inf")] * 32, 2), (6_007, [None] * 32, 2), (6_008, [1e30] * 32, 2), (6_009, [1e30] * 32, 2)]
    return rows + [rows[3], rows[3]]


def framed(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", 1) for r in rows], VECTORS).repartition(5)


def test_near_duplicate_embeddings_equal_brute_force(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(embedding_neardup, "SHARD", 128)
    rows = vectors()
    found = embedding_neardup.near_duplicates(framed(spark, rows)).collect()
    want = brute.cosine_groups(rows)
    got = Counter((r["vec_id"], r["n_links"], r["component_id"]) for r in found)
    assert found[0]["recall"] >= 0.9 and all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found)
    links = {k: n for k, n, _ in want}
    assert Counter(r["vec_id"] for r in found) == Counter(r[0] for r in rows)
    assert all(r["n_links"] <= links[r["vec_id"]] for r in found)
    assert sum(r["n_links"] for r in found) >= 0.9 * sum(n for _, n, _ in want)
    assert len(got & Counter(want)) >= 0.9 * len(rows)


def test_near_duplicate_query_on_whole_shards_is_exact(spark, tmp_path):
    rows = vectors()
    found = llm_queries()["op12_embedding_neardup"](spark, folder_of(tmp_path, framed(spark, rows), "embeddings")).collect()
    assert Counter((r["vec_id"], r["n_links"], r["component_id"]) for r in found) == Counter(brute.cosine_groups(rows))


def test_near_duplicate_odd_tables(spark):
    assert embedding_neardup.near_duplicates(framed(spark, []).limit(0)).collect() == []
    rows = [(None, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], None)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_neardup.near_duplicates(framed(spark, rows)).collect()}
    assert got == {None: (0, None, True), 1: (1, 1, True), 2: (1, 1, False), 3: (0, 3, True)}


def test_pruning_keeps_a_short_way_and_drops_what_a_neighbour_covers():
    angles = np.radians([0, 1, 2, 90, 91])
    own = np.stack([np.cos(angles), np.sin(angles)], axis=1)
    lists = embedding_neardup.prune(own @ own.T, degree=4, pool=4)
    assert sorted(lists[0].tolist())[:1] == [1] and 2 not in lists[0] and set(lists[0].tolist()) & {3, 4}


def test_codes_equal_brute_force(spark, tmp_path):
    rows = [r for r in vectors() if r[1] is None or len(r[1]) != 16 and r[0] not in (6_008, 6_009)]
    rows += [(None, [0.5] * 32, 3), (None, None, 3)]
    got = llm_queries()["op13_vector_codes"](spark, folder_of(tmp_path, framed(spark, rows), "embeddings")).collect()
    want, digest = brute.codes(rows)
    assert Counter((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in got) == Counter(want)
    assert {r["codebooks_sha256"] for r in got} == {digest}


def test_codes_of_few_rows_ties_and_odd_lengths(spark):
    rows = [(4, [0.5, -0.25, 0.125], 1), (2, [0.5, -0.25, 0.125], 1), (3, [9.0] * 4, 1), (5, [float("inf"), 0.0, 0.0], None), (6, [2.0**20, 0.0, 0.0], None)]
    coded, books = vector_codes.compress(framed(spark, rows))
    got = {r["vec_id"]: (r["code"], r["error"], r["group_error"]) for r in coded.collect()}
    assert got == {2: ("00" * 16, 0, 0), 4: ("00" * 16, 0, 0)} and books.shape == (16, 2, 1)
    back = vector_codes.decode(coded, books).where("vec_id = 2").first()["decoded"]
    assert back[:3] == [128, -64, 32] and not any(back[3:])
    assert vector_codes.compress(framed(spark, []).limit(0))[0].collect() == []


def test_cell_memory_equals_full_search():
    rng = np.random.default_rng(1)
    entries = rng.integers(-60, 60, size=(64, 4))
    entries[40] = entries[3]
    parts = rng.integers(-90, 90, size=(5_000, 4))
    memory = vector_codes.CellMemory(entries, limit=500)
    for _ in range(2):
        numbers, distances = memory.nearest(parts)
        far = np.square(parts[:, None, :] - entries).sum(axis=2)
        assert (numbers == far.argmin(axis=1)).all() and (distances == far.min(axis=1)).all()
    assert vector_codes.unpacked(pa.array([np.arange(32, dtype="<i4").tobytes()])).shape == (1, 16, 2)
