"""Marketplace ranks, bought counts and brand lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import abbreviated_count, best_rank, bought_in_html
from tidemark.functions.text import link_values, path_slugs, slug, unslug
from tidemark.operators.joins import best_rank_by_alias, enrich, rank_first_seen
from tidemark.operators.picks import new_elements


def listing_ranks(
    listings: DataFrame, lists: Sequence[str], page: str, position: str, link: str, title: str,
    aliases: Mapping[str, Sequence[str]], span: int | None = None, titles: DataFrame | None = None,
) -> DataFrame:
    """Rank of each target in paged listings: repeated links dropped, first match wins.

    ``span`` cuts long pages into runs of so many positions that are numbered apart. ``titles`` (link, title) is joined after
    repeated links are gone; without it the listings carry the title.
    """
    ranked = rank_first_seen(listings, lists, page, position, link, span)
    return best_rank_by_alias(ranked if titles is None else enrich(ranked, titles, [link], "inner"), lists, title, aliases)


def marketplace_rows(pages: DataFrame, keys: Sequence[str], badge: str, html: str, rank_text: str) -> DataFrame:
    """Bought count (badge text first, raw page as fallback) and best rank per product page; 0 = not found."""
    shown = abbreviated_count(F.col(badge))
    return pages.select(
        *keys, F.when(shown > 0, shown).otherwise(bought_in_html(F.col(html))).alias("bought_past_month"),
        best_rank(F.col(rank_text)).alias("best_sellers_rank"),
    )


def brand_rows(pages: DataFrame, html: str, pattern: str, keys: Sequence[str] = ()) -> DataFrame:
    """Distinct brands linked from stored pages."""
    return pages.select(*keys, F.explode(link_values(F.col(html), pattern)).alias("brand")).distinct()


def new_brand_log(current: DataFrame, known: DataFrame) -> DataFrame:
    """Brands that are not known yet with their slug; nothing while the known set is empty (first run seeds it)."""
    seeded = known.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    fresh = new_elements(current.select("brand"), known, ["brand"]).where(seeded > 0)
    return fresh.select("brand", slug(F.col("brand")).alias("slug"), unslug(slug(F.col("brand"))).alias("title"))


def featured_slugs(pages: DataFrame, html: str, folder: str, keys: Sequence[str] = ()) -> DataFrame:
    """Distinct slugs of the brands that have a page of their own under ``folder``, a pattern."""
    return pages.select(*keys, F.explode(path_slugs(F.col(html), folder)).alias("slug")).distinct()


def brand_categories(pages: DataFrame, slug_column: str, html: str, folder: str) -> DataFrame:
    """Sorted category names per brand slug, read from the links below the slug on the brand's own page."""
    below = F.concat(F.lit(folder), F.col(slug_column), F.lit(r"/([a-z0-9][a-z0-9-]+)\.html"))
    plain = F.col(slug_column).rlike(r"\A[A-Za-z0-9-]+\z")
    links = pages.where(plain).select(F.col(slug_column).alias("slug"), F.explode(F.regexp_extract_all(F.col(html), below, F.lit(1))).alias("c"))
    names = links.distinct().groupBy("slug").agg(F.array_sort(F.collect_list("c")).alias("c"))
    return names.select("slug", F.transform("c", unslug).alias("categories"))


def brand_log(
    brands: DataFrame, known_brands: DataFrame, featured: DataFrame, known_featured: DataFrame, categories: DataFrame
) -> DataFrame:
    """What a run adds: new brands with the categories of their own page, and brand pages that are new.

    ``kind`` is ``brand`` or ``page``. A brand whose slug has no featured page has no categories, whatever ``categories``
    (slug, categories) holds; a page row names its slug only. While both known sets are empty, the run only seeds them and logs nothing.
    """
    def rows_of(df: DataFrame):
        return df.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()

    seeded = (rows_of(known_brands) + rows_of(known_featured)) > 0
    none = F.array().cast("array<string>")
    named = new_elements(brands.select("brand"), known_brands, ["brand"]).withColumn("slug", slug(F.col("brand")))
    listed = categories.join(featured.select("slug").distinct(), "slug", "left_semi")
    fresh = named.join(listed, "slug", "left").select(
        F.lit("brand").alias("kind"), "brand", "slug", F.coalesce("categories", none).alias("categories"))
    pages = new_elements(featured.select("slug"), known_featured, ["slug"]).select(
        F.lit("page").alias("kind"), F.lit(None).cast("string").alias("brand"), "slug", none.alias("categories"))
    return fresh.unionByName(pages).where(seeded)
