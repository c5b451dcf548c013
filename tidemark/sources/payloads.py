"""Stored payloads (JSON documents, catalog pages, product pages, rank graphs) to rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.numbers import discount_pct, first_price, price_field
from tidemark.functions.text import deepest_label, has_badge, pick_name

PARENT_SCHEMA = """
    products array<struct<
        display_names: map<string,string>,
        products: array<struct<
            product_id: string, name: string, sku: string, length: string, width: string, size: string,
            price: string, sale_prices: map<string,string>, regular_prices: map<string,string>,
            available: string, eta: string, url: string>>>>
"""

_BADGES = "array<struct<theme:string>>"
_LABELS = "array<struct<label:string>>"
CATALOG_SCHEMA = f"""
    primaryList struct<
        totalHits: bigint,
        productGroups: array<struct<
            products: array<struct<
                key: string, brand: string, title: string, name: string,
                sellingPrice: string, listPrice: string,
                badges: struct<primary: {_BADGES}, secondary: {_BADGES}>,
                custom: struct<categoryNode: {_LABELS}, categorybreadcrumb: array<struct<id:string>>>,
                variants: array<struct<
                    key: string, stockNumber: string, label: string, size: string,
                    sellingPrice: string, listPrice: string,
                    custom: struct<historic_lowest_selling_price: string,
                                   sale_last_week: {_LABELS}, sale_last_days: {_LABELS}>>>>>>>>
"""

STORE_SCHEMA = """
    product struct<title: string, variants: array<struct<
        id: string, title: string, sku: string, price: string, available: boolean,
        inventory_management: string, inventory_quantity: bigint, price_currency: string>>>,
    variantInventory map<string, struct<inventory_quantity: bigint>>
"""

# The embedded block: type attribute first, then the section type.
EMBEDDED_BLOCK = (
    r"(?is)<script[^>]+type=[\"']application/json[\"'][^>]+data-section-type=[\"']product[\"'][^>]*>(.*?)</script>"
)


def whole_number(text: Column) -> Column:
    """Integer of numeric text (a fraction is cut off); NULL when it is no number."""
    return F.coalesce(text.try_cast("bigint"), text.try_cast("double").try_cast("bigint"))


def explode_state(df: DataFrame, column: str, levels: Sequence[str], value: str = "quantity") -> DataFrame:
    """Nested maps to long rows, one explode per level.

    A level written ``field.name`` first steps into the struct field, then explodes the map under it.
    """
    kept = [c for c in df.columns if c != column]
    names: list[str] = []
    out = df.withColumnRenamed(column, "__m")
    for level in levels:
        field, _, name = level.rpartition(".")
        source = F.col("__m")[field] if field else F.col("__m")
        out = out.select(*kept, *names, F.explode(source).alias(name, "__v")).withColumnRenamed("__v", "__m")
        names.append(name)
    return out.withColumnRenamed("__m", value)


def read_dated_json(spark: SparkSession, path: str, fields: str, key: str = "product_id") -> DataFrame:
    """Directory of ``YYYY-MM-DD.json`` files, each an object {key: fields}.

    ``captured_at`` is the row's ``snapshot_time``, else midnight UTC of the file's date;
    ``snapshot_date`` is the date written in that time.
    """
    files = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_name").alias("file_name"))
    return dated_rows(files, "value", "file_name", fields, key)


def dated_rows(df: DataFrame, text: str, file_name: str, fields: str, key: str = "product_id") -> DataFrame:
    """The rows of ``read_dated_json`` from a table of (file name, text)."""
    rows = df.select(
        F.regexp_extract(file_name, r"(\d{4}-\d{2}-\d{2})", 1).alias("file_date"),
        F.explode(F.from_json(text, f"map<string,struct<snapshot_time:string,{fields}>>")).alias(key, "v"),
    )
    stamp = F.coalesce(F.nullif(F.col("v.snapshot_time"), F.lit("")), F.concat("file_date", F.lit("T00:00:00+00:00")))
    return rows.select(
        "file_date", F.to_timestamp(stamp).alias("captured_at"), F.to_date(F.substring(stamp, 1, 10)).alias("snapshot_date"),
        key, "v.*",
    ).drop("snapshot_time")


def latest_file(df: DataFrame, file_date: str) -> DataFrame:
    """Rows of the most recent cumulative document only."""
    newest = df.agg(F.max(file_date).alias("d")).select("d").scalar()
    return df.where(F.col(file_date) == newest)


def explode_variants(df: DataFrame, payload: str, currency: str = "SEK") -> DataFrame:
    """Parent pages to variant rows; variants without an id are skipped, bad numbers become NULL."""
    kept = [c for c in df.columns if c != payload]
    parents = df.select(*kept, F.explode(F.from_json(payload, PARENT_SCHEMA)["products"]).alias("p"))
    rows = parents.select(
        *kept, pick_name(F.col("p.display_names"), ("sv", "en"), F.lit(None).cast("string")).alias("parent_name"),
        F.explode("p.products").alias("v"),
    ).where(F.col("v.product_id").isNotNull())
    price = first_price(
        F.col("v.price"), F.try_element_at("v.sale_prices", F.lit(currency)),
        F.try_element_at("v.regular_prices", F.lit(currency)),
    )
    return rows.select(
        *kept, "parent_name", F.col("v.name").alias("variant_name"), whole_number(F.col("v.product_id")).alias("product_id"),
        "v.sku", whole_number(F.col("v.length")).alias("length_cm"), whole_number(F.col("v.width")).alias("width_cm"),
        F.col("v.size").alias("size_label"), price.alias("price"), whole_number(F.col("v.available")).alias("available"),
    )


def explode_catalog(df: DataFrame, payload: str) -> DataFrame:
    """Catalog pages to one row per size variant, with prices falling back to the product's.

    A price of 0 counts as missing. Nothing is shuffled: page, group, product and variant are three
    explodes of the same row.
    """
    kept = [c for c in df.columns if c != payload]
    groups = df.select(*kept, F.explode(F.from_json(payload, CATALOG_SCHEMA)["primaryList"]["productGroups"]).alias("g"))
    products = groups.select(*kept, F.explode("g.products").alias("p"))
    rows = products.select(*kept, "p", F.explode("p.variants").alias("v")).where(F.coalesce("v.key", F.lit("")) != "")

    def filled(raw: str) -> Column:
        return F.nullif(price_field(F.col(raw)), F.lit(0.0))

    none = F.array().cast(_BADGES)
    badges = F.concat(F.coalesce("p.badges.primary", none), F.coalesce("p.badges.secondary", none))
    sell = F.coalesce(filled("v.sellingPrice"), filled("p.sellingPrice"), F.lit(0.0))
    listed = F.coalesce(filled("v.listPrice"), filled("p.listPrice"), sell)
    labels = F.transform(F.coalesce("p.custom.categoryNode", F.array().cast(_LABELS)), lambda n: n["label"])

    def counter(name: str) -> Column:
        return F.coalesce(F.get(F.col("v.custom")[name], F.lit(0))["label"].try_cast("bigint"), F.lit(0))

    flat = rows.select(
        *kept, F.col("v.key").alias("variant_key"), F.coalesce("p.key", F.lit("")).alias("product_key"),
        F.coalesce("p.brand", F.lit("")).alias("brand"),
        F.coalesce(F.nullif(F.col("p.title"), F.lit("")), "p.name", F.lit("")).alias("title"),
        deepest_label(labels).alias("category"),
        F.get("p.custom.categorybreadcrumb", F.lit(0))["id"].alias("breadcrumb"),
        F.coalesce(F.nullif(F.col("v.label"), F.lit("")), "v.size", F.lit("")).alias("size"),
        F.coalesce(F.col("v.stockNumber").try_cast("bigint"), F.lit(0)).alias("stock"),
        sell.alias("sell"), listed.alias("listed"),
        F.coalesce(F.col("v.custom.historic_lowest_selling_price").try_cast("double"), F.lit(0.0)).alias("low"),
        counter("sale_last_week").alias("sale_last_week"), counter("sale_last_days").alias("sale_last_days"),
        has_badge(badges, "NEW").alias("is_new"), has_badge(badges, "DISCOUNT").alias("has_discount"),
    )
    return flat.select(
        *[c for c in flat.columns if c not in ("sell", "listed", "low")],
        F.bround("sell", 2).alias("sell_price"), F.bround("listed", 2).alias("list_price"),
        F.bround("low", 2).alias("historic_low"), discount_pct(F.col("sell"), F.col("listed")).alias("discount_pct"),
        (F.col("stock") > 0).alias("in_stock"),
    )


def html_inventory(df: DataFrame, html: str, currency: str = "?") -> DataFrame:
    """Product pages with an embedded JSON block to (variant, quantity) rows with title, SKU and price.

    Pages without a readable block give no row; variants without a quantity are dropped.
    """
    kept = [c for c in df.columns if c != html]
    block = F.nullif(F.regexp_extract(html, EMBEDDED_BLOCK, 1), F.lit(""))
    pages = df.select(*kept, F.from_json(block, STORE_SCHEMA).alias("d"))
    rows = pages.select(*kept, "d", F.explode("d.variantInventory").alias("variant_id", "stock"))
    known = F.get(F.filter("d.product.variants", lambda v: v["id"] == F.col("variant_id")), F.lit(0))
    return (
        rows.where(F.col("stock.inventory_quantity").isNotNull())
        .select(*kept, "variant_id", F.col("d.product.title").alias("product_title"),
                F.col("stock.inventory_quantity").alias("quantity"), known.alias("v"))
        .select(*kept, "variant_id", "product_title", F.coalesce("v.title", F.lit("")).alias("variant_title"),
                F.coalesce("v.sku", F.lit("")).alias("sku"),
                F.coalesce(F.col("v.price").try_cast("double"), F.lit(0.0)).alias("price"),
                F.lit(currency).alias("currency"), "quantity")
    )


def json_inventory(df: DataFrame, payload: str, owner: str, currency: str = "") -> DataFrame:
    """Product JSON endpoints to stock rows; only variants managed by ``owner`` with a quantity."""
    kept = [c for c in df.columns if c != payload]
    rows = df.select(*kept, F.from_json(payload, STORE_SCHEMA)["product"].alias("p")).select(
        *kept, F.col("p.title").alias("product_title"), F.explode("p.variants").alias("v")
    )
    rows = rows.where((F.col("v.inventory_management") == owner) & F.col("v.inventory_quantity").isNotNull())
    return rows.select(
        *kept, F.col("v.id").alias("variant_id"), "product_title", F.coalesce("v.title", F.lit("")).alias("variant_title"),
        F.coalesce("v.sku", F.lit("")).alias("sku"), F.coalesce(F.col("v.price").try_cast("double"), F.lit(0.0)).alias("price"),
        F.coalesce(F.nullif(F.lit(currency), F.lit("")), F.nullif(F.col("v.price_currency"), F.lit("")), F.lit("?")).alias("currency"),
        F.col("v.inventory_quantity").alias("quantity"),
    )


def explode_graph(
    df: DataFrame, keys: Sequence[str], country: str, points: str, countries: Sequence[str]
) -> DataFrame:
    """Epoch point lists per country to (date, country, rank), each seen date padded to all countries.

    The last point of a day wins. The padding explodes a literal list per date; nothing is crossed.
    """
    flat = df.select(*keys, country, F.posexplode(points).alias("__at", "p")).select(
        *keys, F.col(country).alias("country"),
        F.to_date(F.convert_timezone(
            F.current_timezone(), F.lit("UTC"), F.timestamp_seconds(F.col("p")[0]).cast("timestamp_ntz")
        )).alias("snapshot_date"),
        F.col("p")[1].cast("bigint").alias("rank"), "__at",
    ).where(F.col("country").isin(*countries))
    ranks = flat.groupBy(*keys, "snapshot_date", "country").agg(F.max_by("rank", "__at").alias("rank"))
    padded = ranks.select(*keys, "snapshot_date").distinct().withColumn(
        "country", F.explode(F.array(*[F.lit(c) for c in countries]))
    )
    return padded.join(ranks, [*keys, "snapshot_date", "country"], "left")
