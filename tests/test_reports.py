"""Odd rows of the composite reports: absent days and members, NULLs, empty inputs, reruns."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.plans import prices, rankings, reviews
from tidemark.sources import tables as m

A, B, C = date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 5)
TRACKED = {"country": ["DE"], "gender": ["MEN"]}


def _summary(spark, aggregates, ratings, **more):
    counts = spark.createDataFrame([(A, 1, "p", "c", 5), (B, 1, "p", "c", 99), (B, 2, "p", "c", 7), (C, 1, "q", "c", 2)],
                                   "snapshot_date date, run int, product string, channel string, count long")
    known = spark.createDataFrame([("p", 10.0)], "product string, price double")
    a = spark.createDataFrame(aggregates, "snapshot_date date, run int, dimension string, member string, count long")
    r = spark.createDataFrame(ratings, "snapshot_date date, run int, rating double, count long")
    rows = reviews.review_summary(counts, known, a, r, TRACKED, {"country": {"u1": "DE", "u2": "DE"}}, {"country": "new_other_country"},
                                  {"country": "new_channels", "language": "new_languages"}, **more)
    return {x.snapshot_date: x for x in rows.collect()}


def test_review_summary(spark):
    got = _summary(spark, [
        (A, 1, "country", "u1", 3), (A, 1, "country", None, 1), (A, 1, "gender", "MEN", 4),
        (B, 1, "country", "gone", 50), (B, 2, "country", "u1", 2), (B, 2, "country", "u2", 4), (B, 2, "country", "new", 6), (B, 2, "language", "sv", 1),
        (C, 1, "country", "u1", 8), (C, 1, "country", None, 5), (C, 1, "language", "sv", 2), (C, 1, "language", "fi", 2), (C, 1, "language", "de", 2),
    ], [(A, 1, 1.0, 1), (A, 1, 0.5, 3), (A, 1, None, 9), (B, 1, 0.0, 9), (B, 2, 0.0, 0)])
    assert [(got[d].total_reviews, got[d].total_new_reviews, got[d].proxy_value) for d in (A, B, C)] == [(5, 5, 50.0), (7, 2, 20.0), (2, 2, 0.0)]
    # u1 falls on the second day; the gender is absent there and the channel without a code counts as other.
    assert [(got[d].new_DE, got[d].new_other_country, got[d].new_MEN) for d in (A, B, C)] == [(3, 1, 4), (4, 6, 0), (6, 5, 0)]
    # Replaced runs leave no member; the first day of each dimension seeds it.
    assert [(got[d].new_channels, got[d].new_languages) for d in (A, B, C)] == [("", ""), ("new,u2", ""), ("", "de,fi")]
    assert [(got[d].avg_rating, got[d].pct_top) for d in (A, B, C)] == [(3.125, 25.0), (None, 0.0), (None, None)]


def test_review_summary_without_aggregates(spark):
    got = _summary(spark, [], [])
    assert [(got[d].new_DE, got[d].new_other_country, got[d].new_channels, got[d].avg_rating) for d in (A, B, C)] == [(0, 0, "", None)] * 3


def test_review_summary_refuses_clashing_columns(spark):
    none = spark.createDataFrame([], "snapshot_date date")
    with pytest.raises(ValueError, match="share a name"):
        reviews.review_summary(none, none, none, none, {"country": ["UK"], "brand": ["UK"]})


def test_wide_price_report(spark):
    rows = spark.createDataFrame([("d1", "x", "10 SEK"), ("d1", "x", "20 SEK"), ("d1", "y", "none"), ("d2", "z", "5 SEK"), ("d3", None, "1 SEK")],
                                 "day string, shop string, text string")
    stats = prices.source_price_stats(rows, ["day", "shop"], "text")
    wide = prices.wide_price_report(stats, "day", "shop", {"b": "y", "a": "x"})
    assert wide.columns == ["day", "average_price_b", "average_price_a", "median_price_b", "median_price_a"]
    assert sorted(tuple(r) for r in wide.collect()) == [
        ("d1", None, 15.0, None, 15.0), ("d2", None, None, None, None), ("d3", None, None, None, None)]


def test_rate_table(spark):
    defaults = {"EUR": 11.5, "NOK": 0.97}

    def rates(rows, **more):
        quotes = spark.createDataFrame(rows, "currency string, quote double")
        return {r.currency: r.rate for r in prices.rate_table(quotes, ["EUR", "NOK", "XXX", "SEK", "EUR"], "SEK", "EUR", defaults, **more).collect()}

    assert rates([("SEK", 11.0), ("NOK", 10.0), ("NOK", 22.0), ("CHF", 1.0)]) == {"EUR": 11.0, "NOK": 0.5, "XXX": 1.0, "SEK": 1.0}
    # No quotes at all, none of the home currency, or zero and NULL quotes: the defaults.
    none = {"EUR": 11.5, "NOK": 0.97, "XXX": 1.0, "SEK": 1.0}
    assert rates([]) == rates([("NOK", 10.0), (None, 3.0)]) == none
    assert rates([("SEK", 0.0), ("NOK", None)]) == none
    daily = spark.createDataFrame([("a", "SEK", 11.0), ("b", "NOK", 9.0)], "day string, currency string, quote double")
    got = prices.rate_table(daily, ["EUR"], "SEK", "EUR", defaults, ["day"]).collect()
    assert sorted(tuple(r) for r in got) == [("a", "EUR", 11.0), ("b", "EUR", 11.5)]


def test_listing_ranks_do_not_depend_on_the_span(spark):
    rows = [("l", i % 4, i * 7 % 50, f"k{i * i % 31}") for i in range(200)]
    listings = spark.createDataFrame(rows, "list string, page int, position int, link string")
    titles = listings.select("link", F.concat(F.lit("The "), "link").alias("title")).distinct()
    aliases = {"k1": ["k4"], "k9": []}

    def ranks(**more):
        found = rankings.listing_ranks(listings, ["list"], "page", "position", "link", "title", aliases, titles=titles, **more)
        return sorted(tuple(r) for r in found.collect())

    titled = listings.join(titles, "link")
    assert ranks() == ranks(span=3) == ranks(span=1000) == sorted(
        tuple(r) for r in rankings.listing_ranks(titled, ["list"], "page", "position", "link", "title", aliases).collect())


def test_brand_log(spark):
    def table(column, *values):
        return spark.createDataFrame([(v,) for v in values], f"{column} string")

    pages = spark.createDataFrame([
        ("new-one", "/b/new-one/led-lamps.html /b/new-one/cable.html /b/new-one/cable.html /b/other/x1.html"), ("no-page", "/b/no-page/cable.html"),
        ("empty", None), ("a.c", "/b/abc/cable.html"), (None, "/b//cable.html")], "slug string, html string")
    categories = rankings.brand_categories(pages, "slug", "html", "/b/")
    assert {r.slug: r.categories for r in categories.collect()} == {"new-one": ["Cable", "Led Lamps"], "no-page": ["Cable"]}
    brands, featured = table("brand", "New One", "No Page", "Old", "New One"), table("slug", "new-one", "old", "fresh")
    log = rankings.brand_log(brands, table("brand", "Old"), featured, table("slug", "old"), categories)
    assert sorted((r.kind, r.brand or "", r.slug, tuple(r.categories)) for r in log.collect()) == [
        ("brand", "New One", "new-one", ("Cable", "Led Lamps")), ("brand", "No Page", "no-page", ()),
        ("page", "", "fresh", ()), ("page", "", "new-one", ())]
    # The first run only seeds; one known page is enough to say that there was a run.
    assert rankings.brand_log(brands, table("brand"), featured, table("slug"), categories).count() == 0
    assert rankings.brand_log(brands, table("brand"), featured, table("slug", "old"), categories).count() == 5


def test_backfill_report(spark, tmp_path):
    path = str(tmp_path / "report")
    with pytest.raises(ValueError, match="no complete generation"):
        m.backfill_report(spark, path, "ts", ["k"])
    rows = spark.sql("SELECT * FROM VALUES (DATE '2024-01-01', TIMESTAMP '2024-01-09 10:00:00Z', 1), (NULL, TIMESTAMP '2024-01-01 23:30:00Z', 1), "
                     "(NULL, TIMESTAMP '2024-01-03 10:00:00Z', NULL), (NULL, TIMESTAMP '2024-01-03 10:00:00Z', NULL) AS t(snapshot_date, ts, k)")
    m.save_generation(rows, path, 1)
    assert m.backfill_report(spark, path, "ts", ["k"]) == 2
    number, found = m.latest_generation(spark, path)
    assert number == 2
    assert sorted((str(r.snapshot_date), r.k or 0) for r in found.collect()) == [("2024-01-01", 1), ("2024-01-02", 1), ("2024-01-03", 0), ("2024-01-03", 0)]
    # Two captures of a key on one local day, and a row without date and time, stop the next one; nothing is written.
    worse = rows.unionByName(spark.sql("SELECT CAST(NULL AS DATE) AS snapshot_date, TIMESTAMP '2024-01-02 08:00:00Z' AS ts, 1 AS k")).unionByName(
        spark.sql("SELECT CAST(NULL AS DATE) AS snapshot_date, CAST(NULL AS TIMESTAMP) AS ts, 2 AS k"))
    m.save_generation(worse, path, 3)
    with pytest.raises(ValueError, match="no date: 1 rows; repeated key: 2 rows"):
        m.backfill_report(spark, path, "ts", ["k"])
    assert m.latest_generation(spark, path)[0] == 3
