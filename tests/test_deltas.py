import random
from datetime import date, datetime, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from tidemark.operators.deltas import date_calendar, date_pair_delta, previous_row, snapshot_delta
from tidemark.plans.stock import availability_daily_sales, category_flows, delta_metrics, store_daily_sales

DAY = date(2024, 1, 1)


def day(n):
    return DAY + timedelta(days=n)


def snapshots(spark, rows):
    return spark.createDataFrame(rows, "store string, variant_id long, snapshot_date date, quantity long, price decimal(10,2)")


def random_facts(spark, seed, keys=12, days=40):
    rnd = random.Random(seed)
    rows = [("s", k, day(d), rnd.randint(0, 30), Decimal("2.50")) for k in range(keys) for d in range(days) if rnd.random() < 0.7]
    return rows, snapshots(spark, rows)


def test_missing_day_counts_nothing(spark):
    # Absent on one day only: the two-day change must not become one day's sale.
    df = snapshots(spark, [("a", 1, day(0), 10, Decimal(3)), ("a", 1, day(2), 4, Decimal(3)), ("a", 2, day(1), 9, Decimal(2)),
                           ("a", 2, day(2), 7, Decimal(5))])
    got = {r.snapshot_date: (r.est_sold_units, float(r.est_sold_revenue)) for r in store_daily_sales(df).collect()}
    assert got == {day(2): (2, 10.0)}


def test_gap_row_alone_is_a_zero_row(spark):
    df = snapshots(spark, [("a", 1, day(0), 10, Decimal(3)), ("a", 1, day(5), 4, Decimal(3))])
    got = [(r.snapshot_date, r.est_sold_units) for r in store_daily_sales(df).collect()]
    assert got == [(day(5), 0)]


def test_guard_is_by_calendar_day_not_by_hours(spark):
    rows = [(datetime(2025, 11, 16, 22, 5), 1, 50, 10.0, date(2025, 11, 16)), (datetime(2025, 11, 18, 22, 0), 1, 13, 10.0, date(2025, 11, 18)),
            (datetime(2025, 11, 17, 22, 0), 2, 5, None, date(2025, 11, 17)), (datetime(2025, 11, 18, 22, 0), 2, 1, None, date(2025, 11, 18))]
    df = spark.createDataFrame(rows, "captured_at timestamp, product_id long, available long, price double, day date")
    got = {r.day: r for r in availability_daily_sales(df).collect()}
    assert got[date(2025, 11, 18)].units_sold == 0  # 47.9 h is two calendar days; the other drop has no price
    assert got[date(2025, 11, 18)].aov is None
    assert got[date(2025, 11, 17)].new_variants == 1
    assert abs(got[date(2025, 11, 17)].hours_since_prev_snapshot - (24 - 5 / 60)) < 1e-9


def test_calendar_dedupes_before_lag(spark):
    df = spark.createDataFrame([(day(0),), (day(0),), (day(3),), (day(3),), (day(3),)], "d date")
    assert sorted((r.d, r.prev_date, r.next_date) for r in date_calendar(df, "d").collect()) == [
        (day(0), None, day(3)), (day(3), day(0), None)]


def test_segments_give_the_same_previous_row(spark):
    rows, df = random_facts(spark, 1)
    cut = F.floor(F.datediff("snapshot_date", F.lit(DAY)) / 5)
    whole = previous_row(df, ["variant_id"], "snapshot_date", {"p": "quantity"})
    parts = previous_row(df, ["variant_id"], "snapshot_date", {"p": "quantity"}, segment=cut)
    assert sorted(map(str, whole.collect())) == sorted(map(str, parts.select(*whole.columns).collect()))
    assert parts.count() == len(rows)


def test_pair_forms_agree_with_a_dict_model(spark):
    rows, df = random_facts(spark, 2)
    by_day = {}
    for _, k, d, q, _ in rows:
        by_day.setdefault(d, {})[k] = q
    days = sorted(by_day)
    want = sorted((b, k, by_day[b].get(k, 0) - by_day[a].get(k, 0)) for a, b in zip(days, days[1:]) for k in {*by_day[a], *by_day[b]})
    for form in ("union_sum", "full_outer"):
        got = date_pair_delta(df, ["variant_id"], "snapshot_date", "quantity", form)
        assert sorted((r.snapshot_date, r.variant_id, r.delta) for r in got.collect()) == want


def test_no_netting_between_locations(spark):
    stock = spark.createDataFrame([(day(0), "x", "w1", 10), (day(0), "x", "w2", 0), (day(1), "x", "w1", 5), (day(1), "x", "w2", 5)],
                                  "snapshot_date date, article string, warehouse_id string, quantity long")
    article = spark.createDataFrame([("y", "Dimmer")], "article string, category string")
    got = category_flows(stock, article).first()
    assert (got.category, got.sales_out, got.sales_in) == ("Övrigt", 5, 5)


def test_modes(spark):
    df = snapshots(spark, [("a", 1, day(i), q, Decimal(2)) for i, q in enumerate([5, 15, 20, 18, 18])])
    kinds = snapshot_delta(df, ["variant_id"], "snapshot_date", "quantity", mode="three_way")
    assert [(r.kind, r.sold) for r in kinds.orderBy("snapshot_date").collect()] == [
        ("first", 0), ("restock", 0), ("return", -5), ("sale", 2), ("sale", 0)]
    grown = snapshot_delta(df, ["variant_id"], "snapshot_date", "quantity", mode="growth", first_as_zero=True)
    assert [r.growth for r in grown.orderBy("snapshot_date").collect()] == [5, 10, 5, 0, 0]


def test_forget_and_remember(spark):
    # Key 1 is absent on the middle captured day.
    df = snapshots(spark, [("a", 1, day(0), 9, Decimal(1)), ("a", 2, day(0), 1, Decimal(1)), ("a", 2, day(1), 1, Decimal(1)),
                           ("a", 1, day(2), 4, Decimal(1)), ("a", 2, day(2), 0, Decimal(1))])
    def run(remember):
        rows = delta_metrics(df, ["variant_id"], "snapshot_date", "quantity", "price", remember=remember).collect()
        return {r.snapshot_date: (r.new_variants, r.sold_units) for r in rows}
    assert run(True)[day(2)] == (0, 6)
    assert run(False)[day(2)] == (1, 1)
