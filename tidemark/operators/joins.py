"""Dimension joins, market flags and entity matching.

Dimension joins carry no broadcast hint: Spark broadcasts a side whose measured size is under
``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles, with AQE splitting hot keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.once import let
from tidemark.functions.text import canonical, strip_suffix
from tidemark.operators.grams import GRAM, gram_counts, names_in_texts, packed_names, places
from tidemark.operators.picks import first_by

def enrich(
    fact: DataFrame, dim: DataFrame, on: Sequence[str], how: str = "left", defaults: Mapping[str, object] | None = None
) -> DataFrame:
    """Fact joined to a dimension; missing attributes get their default."""
    joined = fact.join(dim, list(on), how)
    for name, value in (defaults or {}).items():
        joined = joined.withColumn(name, F.coalesce(F.col(name), F.lit(value)))
    return joined


def with_rate(fact: DataFrame, rates: DataFrame, detected: str, expected: str, name: str = "rate") -> DataFrame:
    """Exchange rate of the detected, else the expected currency; unknown currencies count as 1."""
    wanted = fact.withColumn("__ccy", F.upper(F.coalesce(F.col(detected), F.col(expected))))
    table = rates.select(F.col("currency").alias("__ccy"), F.col("rate").alias(name))
    return enrich(wanted, table, ["__ccy"], "left", {name: 1.0}).drop("__ccy")


def presence_flags(df: DataFrame, keys: Sequence[str], market: str, markets: Sequence[str]) -> DataFrame:
    """One 0/1 column per market and the number of markets that list the key."""
    flags = [F.max(F.when(F.col(market) == m, 1).otherwise(0)).alias(f"in_{m}") for m in markets]
    wide = df.groupBy(*keys).agg(*flags)
    return wide.withColumn("listed_count", sum((F.col(f"in_{m}") for m in markets), F.lit(0)))


def mark_exists(df: DataFrame, ids: DataFrame, on: Sequence[str], name: str) -> DataFrame:
    """Flag rows whose key occurs in ``ids``; no row is multiplied."""
    known = ids.select(*on).distinct().withColumn(name, F.lit(True))
    return df.join(known, list(on), "left").withColumn(name, F.coalesce(F.col(name), F.lit(False)))


def overlaps(df: DataFrame, array_column: str, ids: DataFrame, id_column: str, row_keys: Sequence[str]) -> DataFrame:
    """Rows of which any array item is a tracked id: explode, semi-join, then back to whole rows."""
    items = df.select(*row_keys, F.explode(array_column).alias(id_column)).distinct()
    hits = items.join(ids.select(id_column).distinct(), id_column, "left_semi").select(*row_keys).distinct()
    return df.join(hits, list(row_keys), "left_semi")


def match_contains(df: DataFrame, text: str, names: DataFrame, name: str, row_keys: Sequence[str], with_core: bool = False) -> DataFrame:
    """(row keys, name), each once, for every name that occurs anywhere in the text, in any case.

    ``with_core`` also tries each name without its corporate form. A name is looked up by one of its strings of four
    bytes, the one that is rarest in the texts, and verified in full; a name with a string that no text holds drops out at
    once. A shorter name is looked up whole. It takes one pass over the texts to count strings and one to look the names up,
    to which all names are sent; names of any number and length go the same way.
    """
    needles = F.array(F.lower(name), strip_suffix(F.col(name))) if with_core else F.array(F.lower(name))
    wanted = names.where(F.col(name) != "").select(F.col(name).alias("name"), F.explode(F.array_distinct(needles)).alias("needle"))
    wanted = wanted.where("needle <> ''").distinct()
    keyed = reduce(lambda a, k: a & F.col(k).isNotNull(), row_keys, F.lit(True))
    texts = df.where(keyed).select(*row_keys, F.lower(F.col(text)).alias("__body"))

    # A place in a long name that another four bytes follow is better: these are compared, too.
    long = F.octet_length("needle") >= 2 * GRAM
    # Spark takes the strings of the texts for as small as their file and would broadcast them: they are joined by a shuffle.
    known = places(wanted, ["name", "needle"], "needle").join(gram_counts(texts, "__body").hint("merge"), "__gram", "left")
    best = F.struct(long & (F.col("__left") < 2 * GRAM), "__times", "__gram", "__next")
    weighed = known.groupBy("name", "needle").agg(
        F.min_by(F.struct("__gram", "__next"), best).alias("__at"), F.count_if(F.col("__times").isNull()).alias("__lacking"))
    anchors = weighed.where("__lacking = 0").select(
        "name", "needle", F.col("__at.__gram").alias("__gram"), F.when(long, F.col("__at.__next")).alias("__then"))

    # What is found may be many times the texts, so it is not shuffled: the texts are, once, and the names go to all of them.
    short = wanted.where(F.octet_length("needle") < GRAM).select("name", "needle", F.lit(None).alias("__gram"), F.lit(None).alias("__then"))
    return names_in_texts(texts, row_keys, "__body", packed_names(anchors.unionByName(short)))


def rank_first_seen(
    df: DataFrame, lists: Sequence[str], page: str, position: str, key: str, span: int | None = None
) -> DataFrame:
    """Items of paged listings numbered in order of first appearance; repeated keys are dropped.

    The number is the count of new items on earlier pages plus the place on the item's own page, so a
    long list is not ordered in one task. ``span`` cuts long pages further, into runs of that many
    positions.
    """
    run = F.lit(0) if span is None else F.floor(F.col(position) / span)
    fresh = first_by(df, [*lists, key], page, position).withColumn("__run", run)
    per_run = fresh.groupBy(*lists, page, "__run").agg(F.count(F.lit(1)).alias("__n"))
    runs = Window.partitionBy(*lists).orderBy(page, "__run")
    before = per_run.select(*lists, page, "__run", (F.sum("__n").over(runs) - F.col("__n")).alias("__before"))
    place = F.row_number().over(Window.partitionBy(*lists, page, "__run").orderBy(position, key))
    return (
        fresh.withColumn("__place", place).join(before, [*lists, page, "__run"])
        .withColumn("rank", (F.col("__before") + F.col("__place")).cast("bigint")).drop("__before", "__place", "__run")
    )


def best_rank_by_alias(
    ranked: DataFrame, lists: Sequence[str], title: str, aliases: Mapping[str, Sequence[str]]
) -> DataFrame:
    """Lowest rank per target whose canonical name or alias occurs in the canonical title."""
    names = F.array(*[
        F.struct(F.lit(target).alias("target"), F.array(*[canonical(F.lit(a)) for a in (target, *others)]).alias("a"))
        for target, others in aliases.items()
    ])
    hit = let(canonical(F.col(title)), lambda plain: F.filter(names, lambda t: F.exists(t["a"], lambda a: F.contains(plain, a))))
    hits = ranked.select(*lists, "rank", F.explode(F.transform(hit, lambda t: t["target"])).alias("target"))
    return hits.groupBy(*lists, "target").agg(F.min("rank").alias("rank"))


def link_graph(
    orgs: DataFrame, parties: DataFrame, tenders: DataFrame, lots: DataFrame, results: DataFrame,
    winners: DataFrame, contracts: DataFrame, company: Column, doc: str = "doc_id",
) -> DataFrame:
    """A company's tenders with lot, result and contract, over tables keyed by document.

    company -> organisations -> parties -> tenders, then lot data by left joins. Every join leads
    with the document id, so the chain keeps one partitioning.
    """
    ours = orgs.where(company).select(doc, "org_id").distinct()
    our_parties = parties.join(ours, [doc, "org_id"], "left_semi").select(doc, "party_id").distinct()
    ours_won = winners.select(doc, "lot_id", "tender_id").distinct().withColumn("is_winner", F.lit(True))
    return (
        tenders.join(our_parties, [doc, "party_id"], "left_semi")
        .join(lots, [doc, "lot_id"], "left")
        .join(results, [doc, "lot_id"], "left")
        .join(ours_won, [doc, "lot_id", "tender_id"], "left")
        .join(contracts, [doc, "tender_id"], "left")
        .withColumn("is_winner", F.coalesce("is_winner", F.lit(False)))
    )
