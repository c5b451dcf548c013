import json
import math
import random
import statistics
from datetime import date, timedelta

from dateutil.relativedelta import relativedelta
from pyspark.sql import functions as F

from tidemark.functions.dates import month_range
from tidemark.operators import aggregates as a
from tidemark.operators import joins as j
from tidemark.operators import picks as p
from tidemark.operators import quality as q
from tidemark.operators import reshape as r
from tidemark.operators import series as s
from tidemark.plans.rankings import new_brand_log


def test_exact_median_matches_statistics(spark):
    rnd = random.Random(3)
    rows = []
    for g in ("a", "b", None):
        rows += [(g, rnd.choice([0.0, -1.5, 7.25, rnd.uniform(-1e6, 1e6), rnd.uniform(0, 1e-9), 2.0**-1060])) for _ in range(rnd.randint(3, 400))]
    rows += [("one", 4.0), ("a", None), ("b", math.nan), ("empty", None), ("two", 1.0), ("two", 2.0), ("inf", math.inf), ("inf", -math.inf), ("inf", 1.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    want = {}
    for g in {x[0] for x in rows}:
        vals = [v for h, v in rows if h == g and v is not None and not math.isnan(v)]
        if vals:
            want[g] = (statistics.median(vals), len(vals))
    for bits in ((46, 30), (56, 40, 20)):
        got = {x.g: (x.median, x.n) for x in a.exact_median(df, ["g"], "v", bits=bits).collect()}
        assert got == want


def test_exact_median_of_a_hot_group(spark):
    df = spark.range(100_001).select((F.col("id") * 37 % 100_001).cast("double").alias("v"))
    got = a.exact_median(df, [], "v").first()
    assert (got.median, got.n) == (50_000.0, 100_001)


def test_pack_rows_keeps_every_row_in_bounded_records(spark):
    df = spark.range(1000).select(F.lit("d").alias("g"), "id")
    packed = a.pack_rows(df, ["g"], ["id"], "items", rows_per_record=50)
    assert packed.count() >= 15
    back = a.explode_events(packed, "items", "id:bigint")
    assert sorted(x.id for x in back.collect()) == list(range(1000))


def fold(chunks, fill):
    """Sequential stitching of [(chunk, {day: value})]."""
    result = {}
    for i, (_, values) in enumerate(chunks):
        if i == 0:
            result = dict(values)
            continue
        both = [d for d in values if d in result]
        scale = 1.0
        if both:
            ref, own = (sum(x[d] for d in both) / len(both) for x in (result, values))
            scale = ref / own if own > 0 else 1.0
        last = max(result)
        result.update({d: v * scale for d, v in values.items() if (d > last if fill == "tail" else d not in result)})
    return result


def test_stitch_equals_a_sequential_fold(spark):
    base = date(2024, 1, 1)
    for seed in range(6):
        rnd = random.Random(seed)
        chunks, start = [], 0
        for c in range(6):
            size = rnd.randint(5, 12)
            values = {base + timedelta(days=start + i): float(rnd.randint(0, 9)) for i in range(size) if rnd.random() < 0.85}
            values = values or {base + timedelta(days=start): 1.0}
            if c == 3:
                values = {d: 0.0 if i < 4 else v for i, (d, v) in enumerate(sorted(values.items()))}
            chunks.append((c, values))
            start += rnd.randint(1, size + 1)  # may reach two chunks back, or leave a hole
        df = spark.createDataFrame([("x", c, d, v) for c, vs in chunks for d, v in vs.items()], "k string, c int, d date, v double")
        for fill in ("missing", "tail"):
            got = {x.d: x.v for x in s.stitch(df, ["k"], "c", "d", "v", fill).collect()}
            want = fold(chunks, fill)
            assert set(got) == set(want)
            assert all(abs(got[d] - want[d]) < 1e-9 * max(1, abs(want[d])) for d in want)


def test_chunk_windows_equal_a_loop(spark):
    start, end, want = date(2016, 1, 31), date(2024, 5, 17), []
    cur = start
    while cur < end:
        stop = min(cur + relativedelta(months=24), end)
        want.append((cur, stop))
        cur = stop - relativedelta(months=3)
        if cur <= want[-1][0] or stop == end:
            break
    one = spark.range(1).select(F.explode(s.chunk_windows(F.lit(start), F.lit(end), 24, 3)).alias("w")).select("w.*")
    got = [(x.chunk_start, x.chunk_end) for x in one.orderBy("chunk").collect()]
    assert got[: len(want)] == want


def test_month_mean_is_dense_and_rounds_half_even(spark):
    df = spark.createDataFrame([(date(2024, 1, 5), 1), (date(2024, 1, 9), 2), (date(2024, 3, 1), 4)], "d date, v int")
    got = [(x.month, x.v) for x in s.to_month(df, "d", "v", scale=0).orderBy("month").collect()]
    assert got == [(date(2024, 1, 31), 2), (date(2024, 2, 29), None), (date(2024, 3, 31), 4)]


def test_contains_agrees_with_brute_force(spark):
    rnd = random.Random(5)
    letters = "abå x😀"
    texts = [(i, "".join(rnd.choice(letters) for _ in range(rnd.choice([0, 1, 3, 40, 700])))) for i in range(60)] + [(60, None), (61, "ab")]
    docs = spark.createDataFrame(texts, "id long, t string")
    few = ["a", "ab", "ba x", "abåabå", "Å X", "xx xx", "bbbbbbbb", "missing name", "", None, "a😀", "x😀a b"]
    many = ["".join(rnd.choice(letters) for _ in range(rnd.randint(1, 7))) for _ in range(5_000)]
    for names in (few, few[:1], many + few):
        dim = spark.createDataFrame([(n,) for n in names], "n string")
        want = sorted({(i, n) for i, t in texts if t for n in names if n and n.lower() in t.lower()})
        assert sorted((x.id, x.name) for x in j.match_contains(docs, "t", dim, "n", ["id"]).collect()) == want
    core = spark.createDataFrame([("Acme AB",)], "n string")
    hits = j.match_contains(spark.createDataFrame([(1, "ACME wins"), (2, "other")], "id long, t string"), "t", core, "n", ["id"], with_core=True)
    assert [(x.id, x.name) for x in hits.collect()] == [(1, "Acme AB")]
    assert j.match_contains(docs, "t", dim.limit(0), "n", ["id"]).collect() == []


def test_contains_reads_texts_in_cuts_and_never_broadcasts_their_places(spark, monkeypatch):
    monkeypatch.setattr("tidemark.operators.grams.CUT", 5)
    texts = [(1, "north wind and æther, northwards"), (1, "second text of one key"), (None, "north"), (2, ""), (3, "nor"), (4, "th wind")]
    docs = spark.createDataFrame(texts, "id long, t string")
    names = ["north", "NORTHWARDS", "wind and", "ther", "æ", "or", "key", "d", "northern", "text of one key", "northwind", "wind"]
    found = j.match_contains(docs, "t", spark.createDataFrame([(n,) for n in names], "n string"), "n", ["id"])
    want = {(i, n) for i, t in texts if i for n in names if n.lower() in t.lower()}
    assert sorted((x.id, x.name) for x in found.collect()) == sorted(want)
    # The places of a text are many times its size, which Spark does not see: a shuffle joins them to the names.
    assert "SortMergeJoin" in found._jdf.queryExecution().executedPlan().toString()


def test_contains_shuffles_texts_but_not_what_it_finds(spark, monkeypatch):
    monkeypatch.setattr("tidemark.operators.grams.CUT", 7)
    monkeypatch.setattr("tidemark.operators.grams.PACKED", 2)
    rnd = random.Random(3)
    # Two keys; all texts of a pair of keys are in several batches and cuts.
    texts = [((k % 3, "x" if k % 2 else "y"), "".join(rnd.choice("ab é") for _ in range(rnd.choice([0, 2, 30])))) for k in range(90)]
    docs = spark.createDataFrame([(a, b, t) for (a, b), t in texts] + [(None, "x", "ab ab ab ab"), (1, None, "ab")], "a long, b string, t string")
    names = ["".join(rnd.choice("aAb é") for _ in range(rnd.randint(1, 12))) for _ in range(300)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2)
    try:
        found = j.match_contains(docs, "t", spark.createDataFrame([(n,) for n in names], "n string"), "n", ["a", "b"])
        got = sorted((*x,) for x in found.collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == sorted({(*k, n) for k, t in texts for n in names if n.lower() in t.lower()}) and len(got) > 200
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan[: plan.index("MapInArrow")]


def test_contains_plans_without_a_job(spark):
    started = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "planning")
    docs = spark.createDataFrame([(1, "x")], "id long, t string")
    j.match_contains(docs, "t", spark.createDataFrame([("x",)], "n string"), "n", ["id"])
    assert list(started.getJobIdsForGroup("planning")) == []


def test_ranks_split_anywhere_stay_the_same(spark):
    rnd = random.Random(7)
    rows = [(1, rnd.randint(1, 3), i, rnd.randint(1, 80)) for i in range(300)]
    df = spark.createDataFrame(rows, "l long, page long, pos long, item long")
    seen, want = set(), {}
    for _, _, _, item in sorted(rows):
        if item not in seen:
            seen.add(item)
            want[item] = len(seen)
    for span in (None, 7):
        got = {x.item: x.rank for x in j.rank_first_seen(df, ["l"], "page", "pos", "item", span).collect()}
        assert got == want


def test_first_by_priority_and_ties(spark):
    df = spark.createDataFrame([("k", "SE", 1, 0.0), ("k", "DE", 9, 0.0), ("k", "DE", 10, 5.0), ("k", "XX", 0, 9.0)],
                               "key string, market string, o long, price double")
    got = p.first_by_priority(df, ["key"], "market", ["DE", "SE"], "o", prefer=F.col("price") > 0).first()
    assert (got.market, got.o) == ("DE", 10)


def test_status_order_puts_bad_dates_last(spark):
    df = spark.createDataFrame([("Active", "2024-01-01"), ("Historical", "soon"), ("Historical", "2024-05-01"), ("Historical", "2024-02-01")],
                               "s string, d string")
    got = [x.d for x in p.status_order(df, "s", {"Historical": 0, "Active": 1}, "d").collect()]
    assert got == ["2024-02-01", "2024-05-01", "soon", "2024-01-01"]


def test_report_columns_follow_the_latest_day(spark):
    df = spark.createDataFrame([("d1", "a", 9), ("d1", "b", 1), ("d2", "b", 5), ("d2", "c", 7)], "d string, m string, v long")
    members = [x.m for x in r.latest_order(df, "d", "m", "v").orderBy("position").collect()]
    wide = r.pivot_by_latest(df, "d", "m", {"v": "Sell"}, members)
    assert wide.columns == ["d", "c (Sell)", "b (Sell)", "a (Sell)"]
    assert sorted(map(tuple, wide.collect())) == [("d1", 0, 1, 9), ("d2", 7, 5, 0)]


def test_long_report_has_no_limit_of_members(spark):
    df = spark.range(3_000).select(F.lit("d1").alias("d"), F.concat(F.lit("m"), "id").alias("m"), F.col("id").alias("v"))
    df = df.union(spark.createDataFrame([("d0", None, 7), ("d1", None, 5_000)], "d string, m string, v long"))
    got = {(x.d, x.m): (x.position, x.v) for x in r.long_by_latest(df, "d", "m", ["v"], "v").collect()}
    assert len(got) == 3_002 and got["d1", "m2999"] == (2, 2999) and got["d1", "m0"] == (3_001, 0)
    assert got["d0", None] == (1, 7)


def test_medians_of_levels_and_of_all(spark):
    rows = [("x", c, v) for c, vs in {"a": [1, 2, 9], "b": [4], None: [6, 8]}.items() for v in vs] + [("y", "a", None), ("y", "b", 3)]
    df = spark.createDataFrame(rows, "g string, c string, v long")
    of = sorted(map(str, ((x.g, x.c, x.median, x.n) for x in a.median_levels(df, ["g"], "c", "v").collect())))
    assert of == sorted(map(str, [("x", "a", 2.0, 3), ("x", "b", 4.0, 1), ("x", None, 7.0, 2), ("x", None, 4.0, 3), ("y", "b", 3.0, 1), ("y", None, 3.0, 1)]))
    pooled = sorted(map(str, ((x.g, x.c, x.median, x.n) for x in a.median_levels(df, ["g"], "c", "v", "pooled").collect())))
    assert pooled == sorted(map(str, [("x", "a", 2.0, 3), ("x", "b", 4.0, 1), ("x", None, 7.0, 2), ("x", None, 5.0, 6), ("y", "b", 3.0, 1), ("y", None, 3.0, 1)]))


def test_counts_and_months_of_null_keys(spark):
    lots = spark.createDataFrame([(None, 1), (None, 2), (3, 1)], "lot long, t long")
    assert {x.lot: (x.num_tenders, x.num_winners) for x in a.lot_counts(lots, lots.where("t = 1"), ["lot"], "t").collect()} == {None: (2, 1), 3: (1, 1)}
    df = spark.createDataFrame([(None, date(2024, 1, 5), 1), (None, date(2024, 3, 9), 2)], "k string, d date, v int")
    assert [x.v for x in s.to_month(df, "d", "v", ["k"]).orderBy("month").collect()] == [1.0, None, 2.0]


def test_records_of_equal_rows_stay_bounded(spark):
    df = spark.range(95).select(F.lit("g").alias("g"), F.when(F.col("id") < 80, 1).otherwise(F.col("id")).alias("v"))
    packed = a.pack_rows(df, ["g"], ["v"], "items", rows_per_record=10).collect()
    lists = [json.loads(x["items"]) for x in packed]
    assert sum(map(len, lists)) == 95 and max(map(len, lists)) <= 25 and sum(i["v"] == 1 for x in lists for i in x) == 80


def test_month_range_reaches_the_scan(spark, tmp_path):
    for kind in ("timestamp", "date", "timestamp_ntz"):
        place = f"{tmp_path}/{kind}"
        days = ["2024-01-31", "2024-02-01", "2024-03-31", "2024-04-01", None]
        spark.createDataFrame([(x,) for x in days], "d string").select(F.col("d").cast(kind).alias("d")).write.parquet(place)
        df = spark.read.parquet(place)
        kept = df.where(month_range(df, "d", "2024-02", "2024-03"))
        assert sorted(str(x.d)[:10] for x in kept.collect()) == ["2024-02-01", "2024-03-31"]
        plan = kept._jdf.queryExecution().executedPlan().toString()
        pushed = plan[plan.index("PushedFilters"):]
        assert "GreaterThanOrEqual(d" in pushed and "LessThan(d" in pushed


def test_day_sketches_merge(spark):
    df = spark.range(40_000).select((F.col("id") % 9_000).alias("k"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 5).cast("int")).alias("d"))
    got = q.audit_days(q.day_sketches(df, "d", ["k"]), "d").first()
    assert (got.rows, got.dates) == (40_000, 5) and abs(got["keys"] - 9_000) < 4 * 1.04 / 64 * 9_000
    assert q.audit_days(q.day_sketches(df.limit(0), "d", ["k"]), "d").first().rows is None


def test_pinned_order_and_zero_days(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("z", 3)], "brand string, n long")
    assert [x.brand for x in p.pinned_order(df, "brand", "z").collect()] == ["z", "a", "b"]
    days = spark.createDataFrame([(1, 0), (1, 0), (2, 0), (2, 4)], "d long, v long")
    assert [x.d for x in q.zero_days(days, "d", ["v"]).collect()] == [1]


def test_first_run_only_seeds(spark):
    now = spark.createDataFrame([("New Brand",), ("Old",)], "brand string")
    none = now.limit(0)
    assert new_brand_log(now, none).count() == 0
    known = spark.createDataFrame([("Old",)], "brand string")
    assert [tuple(x) for x in new_brand_log(now, known).collect()] == [("New Brand", "new-brand", "New Brand")]
