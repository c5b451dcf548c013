"""Every operator against its brute-force version, and on nulls, empty tables, repeated rows and clashing columns."""

import math
import random
import resource
import tracemalloc
import zlib
from collections import Counter
from pathlib import Path

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import (
    components, decontamination, language_model, length_histogram, ngram_join, packing, personal_data, quality_rules, secret_scan, suffix_dedup,
    token_files, token_ids,
)
from tidemark.llm.bytework import run_hashes, runs
from tidemark.llm.common import arrow_map, scratch_folder
from tidemark.llm.spans import span_digest


def by_id(frame, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in frame.collect()}


def test_token_ids_equal_the_library(rows):
    rng = random.Random(1)
    bits = ["a", "B", "it's", " ", "  ", "\n", "\t", "é", "1", "!", "<|endoftext|>", "\x1c", "日本", "'ll", " "]
    texts = [t or "" for _, t, *_ in rows] + ["".join(rng.choice(bits) for _ in range(rng.randint(0, 12))) for _ in range(500)]
    got = token_ids.encoder(token_ids.vocabulary_path()).encode(texts)
    assert [x.tolist() for x in got] == brute.encoded(texts)


@pytest.mark.parametrize("length", [1, 2, 17, 500, 512, 513, 700, 1023, 1024, 1025, 5000])
def test_piece_lengths_cover_the_document(length):
    cuts = packing.piece_lengths(length, 1024)
    assert sum(cuts) == length and all(1024 - 1024 // c * c <= 1024 // 64 for c in cuts)


def test_packing(docs, rows):
    pieces = packing.packed_pieces(packing.pack_documents(docs)).collect()
    ids = {d: x + [0] for (d, *_), x in zip(rows, brute.encoded([r[1] for r in rows]))}
    for doc, own in ids.items():
        at = 0
        for p in sorted((p for p in pieces if p["doc_id"] == doc), key=lambda p: p["start"]):
            assert (p["start"], p["doc_tokens"], p["ids_crc32"]) == (at, len(own), brute.crc(own[at:at + p["length"]]))
            at += p["length"]
        assert at == len(own)
    fill = Counter()
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        assert p["offset"] == fill[p["sequence_id"]]
        fill[p["sequence_id"]] += p["length"]
    padding = sum(0 if n & (n - 1) == 0 else 1024 - n for n in fill.values())
    assert max(fill.values()) <= 1024 and padding <= 0.02 * sum(fill.values())


def test_packing_odd_rows(odd, none):
    assert packing.pack_documents(none).count() == 0
    pieces = packing.packed_pieces(packing.pack_documents(odd))
    assert pieces.agg(F.sum("length")).first()[0] == pieces.where("start = 0").agg(F.sum("doc_tokens")).first()[0]
    assert pieces.where("start = 0 and doc_id is null").count() == 2


def test_quality_counts(docs, rows):
    got = by_id(quality_rules.score_quality(docs, None), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    assert got == {d: (*(want := brute.quality(t)), not want[-1]) for d, t, *_ in rows}


def test_quality_model_separates_held_out_rows(spark):
    rng = random.Random(8)
    pool = ["".join(rng.choice("abcdefghij") for _ in range(4)) for _ in range(200)]
    rows, labels = [], []
    for k in range(300):
        good = k % 3 > 0
        rows.append((k, " ".join(rng.choice(pool) + ("" if good else rng.choice(["***", "&&&"])) for _ in range(60))))
        labels.append((k, int(good), 0))
    frame, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = quality_rules.fit(frame, marks.where("doc_id < 200"))
    got = by_id(quality_rules.score_quality(frame, model).where("doc_id >= 200"), "kept")
    assert sum(got[k][0] == bool(q) for k, q, _ in labels[200:]) >= 97
    assert quality_rules.fit(frame, marks.where("quality = 1")) is None


def test_quality_memory_does_not_follow_the_batch(spark, monkeypatch):
    taken = []
    monkeypatch.setattr(quality_rules, "arrow_map", lambda rows, body, schema: taken.append((rows, body)))
    model = {"weights": np.arange(quality_rules.DIMENSIONS) / 1e5, "slope": 1.0, "intercept": 0.0}
    quality_rules.score_quality(spark.createDataFrame([(1, "x")], "doc_id long, text string"), model)
    (rows, body), = taken
    assert rows.columns == ["doc_id", "text"]  # the text goes to the tasks once
    texts = [None, "", *[f"word{k} and more words of row {k * k}, " * 40 for k in range(2000)]]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    tracemalloc.start()
    got = [(x["text"].to_pylist(), x["n_words"].tolist()) for x in body(iter([batch]))]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [t for own, _ in got for t in own] == texts and [n for _, own in got for n in own] == [len((t or "").split()) for t in texts]
    assert peak < 60_000_000


def test_quality_odd_rows(odd, none):
    assert quality_rules.score_quality(none, None).count() == 0
    assert quality_rules.score_quality(odd, None).count() == 6


def test_personal_data(docs, rows):
    found = personal_data.find_personal_data(docs)
    kinds = list(personal_data.BASE_KINDS)
    got = by_id(span_digest(found, personal_data.BASE_KINDS), *[f"n_{k}" for k in kinds], "base_sha256")
    assert got == {d: brute.span_row(brute.personal(t), kinds) for d, t, *_ in rows}
    values = [s["value"] for r in found.collect() for s in r["spans"] if s["kind"] in ("iban", "national_id")]
    assert sorted(values) == ["123-45-6789", "DE89 3704 0044 0532 0130 00"]


def test_secrets(docs, rows):
    found = secret_scan.find_secrets(docs)
    kinds = list(secret_scan.BASE_KINDS)
    got = by_id(span_digest(found, secret_scan.BASE_KINDS), *[f"n_{k}" for k in kinds], "base_sha256")
    assert got == {d: brute.span_row(brute.secrets(t), kinds) for d, t, *_ in rows}
    assert [s["value"] for r in found.collect() for s in r["spans"] if s["kind"] == "random"] == ["Zx81kQpL0vRt3YbNm7Wc2Hd9"]


def test_masking_keeps_rows_and_columns(docs, odd, none):
    masked = secret_scan.mask_secrets(docs)
    assert masked.columns == docs.columns and masked.count() == docs.count()
    assert not [r for r in masked.collect() if r["text"] and ("AKIAIOSF" in r["text"] or "hunter2" in r["text"] or "Zx81" in r["text"])]
    assert sorted(map(str, secret_scan.mask_secrets(odd).collect())) == sorted(map(str, odd.collect()))
    assert secret_scan.mask_secrets(none).count() == 0


def test_length_histogram(docs, rows, none):
    lengths = sorted(len(x) for x in brute.encoded([r[1] for r in rows]))
    suffixes = length_histogram.suffix_table(length_histogram.length_histogram(length_histogram.token_lengths(docs)), block=64)
    for r in suffixes.collect():
        limit = r["n_tokens"]
        assert r["docs_from"] == sum(n >= limit for n in lengths) and r["tokens_from"] == sum(n for n in lengths if n >= limit)
        assert r["truncated_tokens"] == sum(min(n, limit) for n in lengths) and r["docs_within"] == sum(n <= limit for n in lengths)
        assert r["tokens_within"] == sum(n for n in lengths if n <= limit) and r["tokens_total"] == sum(lengths)
    assert {r[0]: (r[1], r[2]) for r in length_histogram.truncated_totals(suffixes, [3, 77]).collect()} == {
        limit: (sum(min(n, limit) for n in lengths), sum(n > limit for n in lengths)) for limit in (3, 77)
    }
    assert length_histogram.length_quantiles(suffixes, [0.5]).first()["n_tokens"] == lengths[math.ceil(len(lengths) / 2) - 1]
    assert length_histogram.suffix_table(length_histogram.length_histogram(length_histogram.token_lengths(none))).count() == 0


@pytest.mark.parametrize("block", [7, 500_000])
def test_contamination(spark, docs, rows, none, block):
    rng = random.Random(2)
    long = [t for _, t, *_ in rows if t and len(t.split()) > 40]
    items = [(k, " ".join(t.upper().split()[3:3 + rng.randint(5, 25)])) for k, t in enumerate(long[:12])]
    items += [(100, "one two"), (101, ""), (102, None), (103, "spam ham spam"), (104, items[0][1]), (None, items[1][1]), (105, "x")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.find_contamination(docs, benchmark, block_windows=block)
    assert set(docs.columns) <= set(found.columns)
    got = by_id(decontamination.contamination_digest(found), "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert got == brute.contamination([(d, t) for d, t, *_ in rows], [i for i in items if i[0] is not None])
    assert decontamination.find_contamination(docs, benchmark.limit(0)).where("contaminated").count() == 0
    assert decontamination.find_contamination(none, benchmark).count() == 0


def test_ngram_join_with_a_crowd(docs, rows):
    got = by_id(ngram_join.near_duplicate_groups(docs), "n_shingles", "component_id")
    want = brute.jaccard_components([(d, t) for d, t, *_ in rows])
    assert got == want and max(Counter(c for _, c in want.values()).values()) > 32


def test_ngram_join_memory_does_not_follow_the_batch(spark, monkeypatch):
    taken = []
    monkeypatch.setattr(ngram_join, "arrow_map", lambda rows, body, schema: taken.append(body))
    frame = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    ngram_join.sketches(frame)
    ngram_join.prefix_rows(frame, (np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint64)))
    texts = [None, "", *[f"word{k} and more words of row {k * k}, " * 40 for k in range(2000)]]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    tracemalloc.start()
    sizes = [n for x in taken[0](iter([batch])) for n in x["n_shingles"].tolist()]
    nodes = [n for x in taken[1](iter([batch])) for n in x["node"].tolist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sizes == [0, 0, *[7] * 2000] and len(set(nodes)) == 2000
    assert peak < 40_000_000


def resident():
    return int(Path("/proc/self/statm").read_text().split()[1]) * resource.getpagesize()


def test_tasks_return_their_memory(spark, monkeypatch):
    taken, pins, seen = [], [], []
    frame = spark.createDataFrame([(1,)], "n long")
    monkeypatch.setattr(type(frame), "mapInArrow", lambda rows, body, schema: taken.append(body))

    def body(batches):
        held = [np.ones(1000) for _ in range(40_000)]
        pins.append(np.ones(1000))
        seen.append(resident())
        del held
        yield {"n": [1]}

    arrow_map(frame, body, "n long")
    before = resident()
    assert [b.num_rows for b in taken[0](iter([]))] == [1]
    assert seen[0] - before > 250_000_000 and resident() - before < 100_000_000


def passages(seed=8):
    """Documents that share one of a few passages in two thirds of their words, which links none of them."""
    rng = random.Random(seed)
    shared = [" ".join(f"p{k}x{i}" for i in range(60)) for k in range(3)]
    rows = [(k, f"{shared[k % 3]} " + " ".join(f"w{rng.randrange(10**9)}" for _ in range(30))) for k in range(180)]
    return [*rows, (1000, rows[5][1] + " end"), (1001, rows[6][1] + " end")]


def test_ngram_join_ranks_passages_of_some_documents_last(spark, monkeypatch):
    crowds = []
    monkeypatch.setattr(ngram_join, "member_blocks", lambda *x, own=ngram_join.member_blocks: crowds.append(own(*x)) or crowds[-1])
    rows = passages()
    got = by_id(ngram_join.near_duplicate_groups(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)), "n_shingles", "component_id")
    assert got == brute.jaccard_components(rows) and {5, 6} == {c for d, (_, c) in got.items() if d >= 1000}
    assert crowds[0].count() == 4


def test_ngram_join_bounds_what_is_common(spark, monkeypatch):
    docs = spark.createDataFrame([(k, "a b c d e f" if k < 6 else f"a b c d x{k}") for k in range(10)], "doc_id long, text string").coalesce(1)
    tokens, levels = ngram_join.common_shingles(docs)
    assert sorted(levels.tolist()) == [5, 5, 6] and (np.diff(tokens.astype(object)) > 0).all()
    monkeypatch.setattr(ngram_join, "COMMON_MOST", 2)
    assert ngram_join.common_shingles(docs)[1].tolist() == [6]


def test_ngram_join_in_small_blocks(docs, rows, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_NODES", 8)
    got = by_id(ngram_join.near_duplicate_groups(docs), "n_shingles", "component_id")
    assert got == brute.jaccard_components([(d, t) for d, t, *_ in rows])


def test_ngram_join_takes_the_prefixes_of_many_blocks_at_once(spark, monkeypatch):
    taken, calls = [], []
    monkeypatch.setattr(ngram_join, "arrow_map", lambda rows, body, schema: taken.append(body))
    monkeypatch.setattr(ngram_join.Order, "prefixes", lambda *x, own=ngram_join.Order.prefixes: calls.append(1) or own(*x))
    none = np.zeros(0, dtype=np.uint64)
    rows = spark.createDataFrame([(1, 1)], "work long, node long")
    ngram_join.linked_blocks(rows, spark.createDataFrame([(1, b"")], "node long, tokens binary"), (none, none))
    rng, works, tokens = np.random.default_rng(4), np.repeat(np.arange(300), 2), []
    for work in range(300):
        value = np.sort(rng.integers(0, 2**48, 50, dtype=np.uint64))
        tokens += ngram_join._packed(value, np.array([0, 50])) + ngram_join._packed(value[: 48 if work % 3 else 20], np.array([0, 48 if work % 3 else 20]))
    batch = pa.RecordBatch.from_pydict({"work": works, "node": np.arange(600), "tokens": tokens})
    got = [pair for x in taken[0](iter([batch.slice(0, 101), batch.slice(101)])) for pair in zip(x["b"], x["a"])]
    assert sorted(map(sorted, got)) == [[2 * w, 2 * w + 1] for w in range(300) if w % 3] and len(calls) <= 4


def test_ngram_join_packs_sketches_and_prefixes_in_one_pass(docs, odd, monkeypatch):
    none = np.zeros(0, dtype=np.uint64)
    monkeypatch.setattr(ngram_join, "PACKED_ROWS", 100)
    monkeypatch.setattr(ngram_join, "LIST_ROWS", 3)
    for frame in (docs.coalesce(1), odd.coalesce(1)):
        got = ngram_join.packed_prefixes(frame, (none, none.astype(np.uint8)))
        own = sorted(map(str, ngram_join.sketches(frame).collect()))
        assert sorted(map(str, got.where("bucket is null").select("doc_id", "n_shingles", "node").collect())) == own
        packed = got.where("bucket is not null").collect()
        rows = [x for r in packed for x in zip(*[c.tolist() for c in ngram_join._unpacked([r["rows"]])])]
        want = [tuple(r) for r in ngram_join.prefix_rows(frame, (none, none.astype(np.uint8))).collect()]
        assert sorted(rows) == sorted(want) and len(packed) < len(rows)
        met = Counter()
        for r in ngram_join.token_lists(got.where("bucket is not null")).where("b is not null").collect():
            met[r["a"], r["b"]] += r["hits"]
        lists = {}
        for token, n, node in set(want):
            lists.setdefault(token, []).append((n, node))
        pairs = Counter((x[1], y[1]) for own in lists.values() if len(own) <= 32 for k, x in enumerate(sorted(own)) for y in sorted(own)[k + 1:] if x[0] * 100 >= 85 * y[0])
        assert met == pairs


def test_hashes_of_runs_at_any_place():
    texts = ["", "a b " + "c" * 70_000 + " a", "b" * 65_536 + " a b", "é a  b " * 50_000, "a b"]
    data = np.frombuffer("".join(texts).encode(), dtype=np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    starts, ends, row = runs(data != 32, offsets)
    hashes, seen = run_hashes(data, starts, ends), {}
    assert row.tolist() == (np.searchsorted(offsets, starts, side="right") - 1).tolist() and set(row.tolist()) == {1, 2, 3, 4}
    for a, b, value in zip(starts.tolist(), ends.tolist(), hashes.tolist()):
        assert seen.setdefault(data[a:b].tobytes(), value) == value
    assert len(seen) == 5 == len(set(seen.values()))
    short = ends - starts < 65_537
    assert run_hashes(data, starts[short], ends[short]).tolist() == hashes[short].tolist()


def test_ngram_join_odd_rows(odd, none):
    assert ngram_join.near_duplicate_groups(none).count() == 0
    got = sorted(map(tuple, ngram_join.near_duplicate_groups(odd).collect()), key=str)
    assert len(got) == 6 and (9, 77, 7) in got and (None, 77, None) in got and (9, 0, 9) in got


@pytest.mark.parametrize("edges", [[(k, k + 1) for k in range(300)], [(0, k) for k in range(1, 200)] + [(500, 501)], []])
def test_components(spark, edges):
    frame = spark.createDataFrame(edges, "a long, b long").repartition(5)
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    assert {r[0]: r[1] for r in components.connected_components(frame).collect()} == {n: root(n) for n in parent if root(n) != n}


def test_suffix_dedup(docs, rows):
    got = by_id(suffix_dedup.remove_repeats(docs).withColumn("sha", F.sha2("kept", 256)), "n_bytes", "n_removed", "n_spans", "sha")
    assert got == brute.repeated_bytes([(d, t) for d, t, *_ in rows])


def test_suffix_dedup_in_small_runs(docs, rows, monkeypatch):
    for name, value in (("FLUSH_SUFFIXES", 40), ("FLUSH_ANCHORS", 100), ("GROUP_ROWS", 10), ("PIECE", 3000)):
        monkeypatch.setattr(suffix_dedup, name, value)
    got = by_id(suffix_dedup.remove_repeats(docs, width=5).withColumn("sha", F.sha2("kept", 256)), "n_bytes", "n_removed", "n_spans", "sha")
    assert got == brute.repeated_bytes([(d, t) for d, t, *_ in rows])


def test_suffix_dedup_packs_what_many_tasks_sent():
    # Forty tasks each send two rows to one bucket: what they share goes on in a row a bucket, not in one for every sender.
    rng = np.random.default_rng(3)
    sent = [suffix_dedup._gram_rows(rng.integers(0, 300, 400), rng.integers(0, 500, 400).astype(np.uint64), 1) for _ in range(40)]
    schema = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("value", pa.binary())])
    given = list(suffix_dedup._compared(iter([pa.RecordBatch.from_pydict(x, schema=schema) for x in sent]), 8))
    assert 0 < sum(len(x["bucket"]) for x in given) <= 8


@pytest.mark.parametrize("heavy_docs", [1, 25])
def test_suffix_dedup_splits_grams_of_many_documents(spark, docs, rows, heavy_docs):
    # A phrase of many documents between words of their own.
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefgh") for _ in range(8)) for _ in range(400)]
    more = [(1000 + k, " ".join([words[rng.randrange(400)], words[k % 7], "this common phrase is in one third of all documents", words[k % 5], words[rng.randrange(400)]]), "en", "b", "c") for k in range(60)]
    frame = docs.union(spark.createDataFrame(more, docs.schema).repartition(3))
    marks = suffix_dedup.shared_grams(frame, 5)
    heavy = suffix_dedup.heavy_grams(marks, heavy_docs)
    assert len(heavy)
    # Only what few documents share is left to the groups of one task.
    marked = suffix_dedup._docs(frame).join(marks, "doc_id").select("doc_id", "text", F.crc32(F.col("text").cast("binary")).alias("check"), "marks")
    windows = suffix_dedup.heavy_windows(marked, heavy)
    assert windows.where("doc_id >= 1000").select("doc_id").distinct().count() == 60
    for row in suffix_dedup.suffix_runs(marked, 1, heavy).collect():
        run = suffix_dedup.Run(row["value"])
        groups = Counter()
        while run.advance() is not None:
            groups[run.key[:suffix_dedup.GRAM]] += 1
        assert not groups or max(groups.values()) < 60
    got = by_id(suffix_dedup.remove_repeats(frame, 5, heavy_docs).withColumn("sha", F.sha2("kept", 256)), "n_bytes", "n_removed", "n_spans", "sha")
    assert got == brute.repeated_bytes([(d, t) for d, t, *_ in [*rows, *more]])


def test_suffix_dedup_odd_rows(odd, none):
    assert suffix_dedup.remove_repeats(none).count() == 0
    got = sorted((r["doc_id"] or -1, r["n_removed"] > 0) for r in suffix_dedup.remove_repeats(odd).collect())
    assert got == [(-1, False), (-1, False), (7, False), (7, False), (9, False), (9, True)]


def test_merge_never_compares_known_prefixes():
    rng = random.Random(4)
    keys = [sorted(bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 12))) for _ in range(rng.randint(1, 30))) for _ in range(5)]

    class Plain:
        def __init__(self, own):
            self.own, self.at, self.key = own, -1, b""

        def advance(self):
            self.at += 1
            last, self.key = self.key, self.own[self.at] if self.at < len(self.own) else None
            return None if self.key is None else suffix_dedup.common_prefix(last, self.key, 0)

    out, last = [], b""
    for same, run in suffix_dedup.merged([Plain(k) for k in keys]):
        assert same == suffix_dedup.common_prefix(last, run.key, 0)
        last = run.key
        out.append(last)
    assert out == sorted(x for k in keys for x in k)


def test_language_model(docs, rows):
    tokens = {d: [w.translate(brute.LOWER) for w in brute.WORDS.findall(t or "")] + [None] for d, t, *_ in rows}
    held = {d: zlib.crc32(str(d).encode()) % 10 == 0 for d in tokens}
    count = Counter(w for d, own in tokens.items() if not held[d] for w in own)
    total, distinct = sum(count.values()), len(count)
    frame = language_model.score_documents(docs).collect()
    assert len(frame) == len(rows)
    for r in frame:
        own = tokens[r["doc_id"]]
        base = sum(math.log10((count[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in own)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[r["doc_id"]], len(own), sum(w in count for w in own), total)
        assert abs(r["base_score"] - base) < 1e-6 * abs(base) and r["score"] < 0


def test_spelling_probabilities_sum_to_one():
    cells, starts = language_model.spelled(np.frombuffer(b"abbaabcab", dtype=np.uint8), np.array([0, 4, 6]), np.array([4, 6, 9]))
    assert len(starts) == 3 and len(cells) == 12
    key, n = np.unique(cells, return_counts=True)
    model = language_model.sample_spelling(key, n * 50)
    assert np.allclose((10.0 ** model.logs.astype(float)).sum(axis=1), 1, atol=1e-4)
    assert np.allclose((10.0 ** model.shorter.astype(float)).sum(axis=1), 1, atol=1e-4)


def test_language_model_reads_word_contexts(spark):
    held = [d for d in range(1000) if zlib.crc32(str(d).encode()) % 10 == 0]
    train = [d for d in range(1000) if d not in held][:60]
    rows = [(d, "the cat sat on the mat and the dog ran to the door") for d in train]
    rows += [(held[0], "the dog ran to the door"), (held[1], "door the to ran dog the")]
    got = by_id(language_model.score_documents(spark.createDataFrame(rows, "doc_id long, text string")), "score")
    assert got[held[0]][0] > got[held[1]][0] + 3


def test_language_model_sums_to_one(spark):
    rng = random.Random(2)
    pool = ["ab", "ba", "cab", "dd", "e", "fog"]
    rows = spark.createDataFrame([(d, " ".join(rng.choice(pool) for _ in range(rng.randint(1, 9)))) for d in range(80)], "doc_id long, text string")
    words = language_model.training_words(rows)
    model = language_model.fitted(rows, words)
    # The whole vocabulary and one word that is not known, after every two words of the corpus and after unknown ones.
    known = language_model._spelled_words(words, model.spelling).select("word", "spell")
    wanted = known.union(spark.createDataFrame([(5, 1e-9)], "word long, spell double"))
    contexts = model.grams.select("two", "one").distinct().union(spark.createDataFrame([(1, 2)], "two long, one long"))
    got = model.scored(contexts.crossJoin(wanted)).groupBy("two").agg(
        F.sum(F.when(F.col("word") != 5, F.pow(F.lit(10.0), "logp"))).alias("known"), F.max(F.when(F.col("word") == 5, F.pow(F.lit(10.0), "logp"))).alias("new")).collect()
    left = 1 - known.agg(F.sum("spell")).first()[0]
    assert len(got) > 20 and all(abs(r["known"] + r["new"] / 1e-9 * left - 1) < 1e-4 for r in got)


def test_language_model_passes_tables_down(spark, monkeypatch):
    monkeypatch.setattr(language_model, "BURN_IN", 1)
    monkeypatch.setattr(language_model, "SAMPLES", 1)
    rng = random.Random(6)
    rows = spark.createDataFrame([(d, " ".join(rng.choice(["ab", "ba", "cab"]) for _ in range(30))) for d in range(60)], "doc_id long, text string")
    model = language_model.fitted(rows, language_model.training_words(rows))
    pairs, words = model.pairs.collect(), model.words.collect()
    many = Counter({(r["one"], r["word"]): r["single"] for r in pairs})
    for r in model.many.collect():
        many[r["one"], r["word"]] += r["t"]
    assert {(r["one"], r["word"]): r["c"] for r in pairs} == many
    passed = Counter()
    for r in pairs:
        passed[r["word"]] += r["t"]
    assert {r["word"]: r["c"] for r in words} == passed
    # Each symbol of a word has as many customers as the word has tables, and these are more than one.
    ends = sum(r["t"] for r in words)
    top = model.letters.levels[0]
    assert ends > len(words) and top["customers"][top["symbol"] == language_model.END_SYMBOL].sum() == ends
    assert top["customers"].sum() == sum(r["t"] * (len(r["letters"]) + 1) for r in words)


def test_language_model_odd_rows(odd, none):
    assert language_model.score_documents(none).count() == 0
    got = language_model.score_documents(odd)
    assert got.count() == 6 and got.where("doc_id is null and held_out").count() == 2


def test_token_files(spark, docs, rows):
    place = scratch_folder(spark, "tokens")
    manifest = token_files.write_token_files(docs, place, partitions=4)
    got = by_id(token_files.token_digests(token_files.read_token_files(spark, manifest, place)), "start", "n_tokens", "ids_crc32")
    want, at = {}, 0
    ordered = sorted(rows)
    for (d, *_), ids in zip(ordered, brute.encoded([r[1] for r in ordered])):
        ids = ids + [2]
        want[d] = (at, len(ids), brute.crc(ids))
        at += len(ids)
    assert got == want
    some = token_files.read_token_files(spark, manifest, place, [5, 40, 10**9]).collect()
    assert {r["doc_id"]: (r["n_tokens"], brute.crc(np.frombuffer(r["ids"], dtype="<u4"))) for r in some} == {d: want[d][1:] for d in (5, 40)}


def test_token_files_read_only_what_is_asked(tmp_path):
    import pyarrow.fs as pafs

    fs = pafs.LocalFileSystem()
    with fs.open_output_stream(str(tmp_path / "x.tok")) as sink:
        writer = token_files.FrameWriter(sink, 2)
        for k in range(20):
            writer.add(k, np.arange(k * 100, dtype=np.uint32) % 60_000)
        writer.finish()
    with fs.open_input_file(str(tmp_path / "x.tok")) as source:
        reader = token_files.FrameReader(source)
        assert reader.read(7).tolist() == list(range(700)) and reader.bytes_read == reader.table[7, 0]
    raw = bytearray((tmp_path / "x.tok").read_bytes())
    raw[int(reader.starts[7]) + 12] ^= 1
    (tmp_path / "y.tok").write_bytes(raw)
    with fs.open_input_file(str(tmp_path / "y.tok")) as source, pytest.raises(Exception):  # noqa: B017
        token_files.FrameReader(source).read(7)


def test_token_files_odd_rows(spark, odd, none):
    for frame, n in ((odd, 6), (none, 0)):
        place = scratch_folder(spark, "tokens")
        manifest = token_files.write_token_files(frame, place, partitions=3)
        assert token_files.read_token_files(spark, manifest, place).count() == n


@pytest.mark.parametrize("text, want", [
    ("BE68 5390 0754 7034 CALL now account", ["BE68 5390 0754 7034"]), ("iban DE89370400440532013000", ["DE89370400440532013000"]),
    ("account BE68 5390 0754 7034 DE89 3704 0044 0532 0130 00 end", ["BE68 5390 0754 7034", "DE89 3704 0044 0532 0130 00"]),
    ("XK11 BE68 5390 0754 7034 bank", ["BE68 5390 0754 7034"]), ("BE68 5390 0754 7035 WORD bank", []), ("NO93 8601 1117 947 transfer", ["NO93 8601 1117 947"]),
])
def test_accounts_end_where_the_checksum_holds(text, want):
    assert [text[a:b] for kind, a, b in personal_data.added_spans(text) if kind == "iban"] == want


def test_fit_widens_few_entries_at_once(monkeypatch):
    """The fit holds little beside its sparse rows, and blocks do not change a bit of the weights."""
    rng = np.random.default_rng(3)
    at = [np.sort(rng.choice(2**16, n, replace=False)).astype("<i4") for n in rng.integers(1, 16_000, 250)]
    x = [rng.random(len(a)).astype("<f4") for a in at]
    y = (rng.random(len(at)) < 0.7).astype(np.float64)
    monkeypatch.setattr(quality_rules, "EPOCHS", 3)
    whole = quality_rules._train(at, x, y, 2**16)
    monkeypatch.setattr(quality_rules, "FIT_ENTRIES", 10_000)
    tracemalloc.start()
    blocks = quality_rules._train(at, x, y, 2**16)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.array_equal(whole, blocks)
    assert peak < 8 * sum(map(len, at)) + 8_000_000
