"""Check queries: payload scans, merge rules, sinks and the incremental delta.

The payload texts are built by Spark from the provided tables, one document per row, so their
number grows with the tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import cut_lineage, shared_folder
from tidemark.sources import buckets
from tidemark.sources import payloads as p
from tidemark.sources import tables as m
from tidemark.sources.notices import notice_tables, parse_notices, read_notices, stored_notices
from tidemark.operators.joins import link_graph
from tidemark.operators.picks import union_labelled
from tidemark.functions.once import keep_if
from tidemark.functions.text import may_name_company, names_company
from tidemark.streaming.incremental import incremental_delta, read_deltas
from tidemark.workload import bindings as b
from tidemark.workload.registry import query, table


def new_folder(spark: SparkSession) -> str:
    """A new folder in the shared one."""
    return f"{shared_folder(spark)}/tidemark-{uuid.uuid4().hex}"


# --- scans ---------------------------------------------------------------------------------

@query("s1_nested_state_map", f"""
    SELECT snapshot_date::VARCHAR AS snapshot_date, article::VARCHAR AS article, warehouse_id, quantity FROM ({b.STOCK_SNAPSHOT})""")
def s1(spark, d):
    text = F.concat(F.lit('{"snapshots":{"'), "snapshot_date", F.lit('":{"'), "article", F.lit('":{"warehouses":{"'),
                    "warehouse_id", F.lit('":'), "quantity", F.lit("}}}}}"))
    schema = "snapshots map<string,map<string,struct<warehouses:map<string,bigint>>>>"
    docs = b.stock_snapshot(spark, d).select(F.from_json(text, schema)["snapshots"].alias("state"))
    return p.explode_state(docs, "state", ["snapshot_date", "article", "warehouses.warehouse_id"])


@query("s2_dated_documents", f"""
    SELECT product_id::VARCHAR AS product_id, strftime(CASE WHEN product_id % 3 = 0 THEN day::TIMESTAMP ELSE date_trunc('second', captured_at) END,
           '%Y-%m-%d %H:%M:%S') AS captured_at, (CASE WHEN product_id % 3 = 0 THEN day ELSE captured_at::DATE END)::VARCHAR AS snapshot_date,
           available FROM ({b.VARIANT_CAPTURES})""")
def s2(spark, d):
    stamp = F.when(F.col("product_id") % 3 == 0, "null").otherwise(
        F.concat(F.lit('"'), F.date_format("captured_at", "yyyy-MM-dd'T'HH:mm:ss"), F.lit('+00:00"')))
    text = F.concat(F.lit('{"'), "product_id", F.lit('":{"snapshot_time":'), stamp, F.lit(',"available":'), "available", F.lit("}}"))
    files = b.variant_captures(spark, d).select(F.concat("day", F.lit(".json")).alias("file_name"), text.alias("value"))
    rows = p.dated_rows(files, "value", "file_name", "available:bigint")
    return rows.select("product_id", F.date_format("captured_at", "yyyy-MM-dd HH:mm:ss").alias("captured_at"), "snapshot_date", "available")


@query("s3_latest_document_only", """
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE date_trunc('month', o_orderdate) = (SELECT date_trunc('month', max(o_orderdate)) FROM orders)""")
def s3(spark, d):
    docs = table(spark, d, "orders").withColumn("file_date", F.date_format("o_orderdate", "yyyy-MM"))
    return p.latest_file(docs, "file_date").select("o_orderkey", "o_totalprice")


def catalog_pages(spark, d):
    """One catalog page per part: a product with two sizes, prices as numbers, strings or ranges."""
    kind, key = F.col("p_partkey") % 4, F.col("p_partkey").cast("string")
    own = F.when(kind == 0, F.concat(F.lit('{"min":'), "p_retailprice", F.lit("}"))).when(
        kind == 1, F.concat(F.lit('"'), "p_retailprice", F.lit('"'))).when(kind == 2, "0").otherwise("null")
    text = F.concat(
        F.lit('{"primaryList":{"totalHits":2,"productGroups":[{"products":[{"key":"'), key, F.lit('","brand":"'), "p_brand",
        F.lit('","title":"'), "p_name", F.lit('","sellingPrice":50,"listPrice":{"max":1,"min":1000},'
              '"badges":{"primary":[{"theme":"New"}]},"custom":{"categoryNode":[{"label":"All"},{"label":"'), "p_type",
        F.lit('"}]},"variants":[{"key":"'), key, F.lit('-S","stockNumber":"'), "p_size", F.lit('","label":"S","sellingPrice":'), own,
        F.lit(',"custom":{"sale_last_week":[{"label":"'), "p_size", F.lit('"}]}},{"key":"'), key,
        F.lit('-M","stockNumber":"many","size":"M"},{"key":null,"stockNumber":1}]}]}]}}'))
    return table(spark, d, "part").select(F.col("p_partkey").alias("page"), text.alias("payload"))


@query("s4_catalog_pages", """
    SELECT p_partkey AS page, p_partkey || '-' || size AS variant_key, p_partkey::VARCHAR AS product_key, p_brand AS brand, p_name AS title,
           p_type AS category, size, CASE size WHEN 'S' THEN p_size ELSE 0 END::BIGINT AS stock,
           CASE size WHEN 'S' THEN p_size ELSE 0 END::BIGINT AS sale_last_week, 1::BIGINT AS is_new, 0::BIGINT AS has_discount,
           CASE WHEN size = 'S' AND p_partkey % 4 < 2 THEN p_retailprice ELSE 50 END::DOUBLE AS sell_price, 1000.0::DOUBLE AS list_price,
           round_even(100.0::DOUBLE * (1.0::DOUBLE - CASE WHEN size = 'S' AND p_partkey % 4 < 2 THEN p_retailprice ELSE 50 END / 1000.0::DOUBLE), 1)
               AS discount_pct
    FROM part CROSS JOIN (SELECT unnest(['S', 'M']) AS size)""")
def s4(spark, d):
    return p.explode_catalog(catalog_pages(spark, d), "payload").drop(
        "breadcrumb", "sale_last_days", "historic_low", "in_stock")


@query("s4_parent_pages", """
    SELECT p_partkey AS page, CASE WHEN p_size % 2 = 0 THEN p_name ELSE p_brand END AS parent_name, p_type AS variant_name, p_partkey AS product_id,
           'sku' || p_partkey AS sku, p_size::DOUBLE AS length_cm, NULL::DOUBLE AS width_cm, 'L' AS size_label,
           CASE p_size % 3 WHEN 0 THEN p_retailprice WHEN 1 THEN p_size + 0.5::DOUBLE END AS price, (p_size % 7)::BIGINT AS available FROM part""")
def s4_parents(spark, d):
    names = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit('{"en":"x","sv":"'), "p_name", F.lit('"}'))).otherwise(
        F.concat(F.lit('{"de":"'), "p_brand", F.lit('"}')))
    price = F.when(F.col("p_size") % 3 == 0, F.concat(F.lit('"price":'), "p_retailprice")).when(
        F.col("p_size") % 3 == 1, F.concat(F.lit('"price":null,"regular_prices":{"SEK":'), F.col("p_size") + 0.5, F.lit("}"))).otherwise('"price":"soon"')
    text = F.concat(F.lit('{"products":[{"display_names":'), names, F.lit(',"products":[{"product_id":'), "p_partkey", F.lit(',"name":"'), "p_type",
                    F.lit('","sku":"sku'), "p_partkey", F.lit('","length":"'), "p_size", F.lit('.7","width":"wide","size":"L",'), price,
                    F.lit(',"available":'), F.col("p_size") % 7, F.lit('},{"product_id":null,"name":"ghost"}]}]}'))
    pages = table(spark, d, "part").select(F.col("p_partkey").alias("page"), text.alias("payload"))
    rows = p.explode_variants(pages, "payload")
    return rows.withColumns({"length_cm": F.col("length_cm").cast("double"), "width_cm": F.col("width_cm").cast("double")})


@query("s5_embedded_inventory", """
    SELECT p_partkey AS page, v AS variant_id, p_name AS product_title, CASE v WHEN 'a' THEN p_type ELSE '' END AS variant_title,
           CASE v WHEN 'a' THEN 'sku' ELSE '' END AS sku, CASE v WHEN 'a' THEN p_retailprice ELSE 0 END::DOUBLE AS price, 'SEK' AS currency,
           p_size::BIGINT AS quantity
    FROM part CROSS JOIN (SELECT unnest(['a', 'b']) AS v) WHERE p_partkey % 9 <> 0""")
def s5(spark, d):
    block = F.concat(
        F.lit('<html><script type="application/json" class="x" data-section-type="product" id="1">{"product":{"title":"'), "p_name",
        F.lit('","variants":[{"id":"a","title":"'), "p_type", F.lit('","sku":"sku","price":'), "p_retailprice",
        F.lit('}]},"variantInventory":{"a":{"inventory_quantity":'), "p_size", F.lit('},"b":{"inventory_quantity":'), "p_size",
        F.lit('},"c":{"inventory_quantity":null}}}</script></html>'))
    html = F.when(F.col("p_partkey") % 9 == 0, "<html>sold out</html>").otherwise(block)
    return p.html_inventory(table(spark, d, "part").select(F.col("p_partkey").alias("page"), html.alias("html")), "html", "SEK")


@query("s5_json_inventory", """
    SELECT p_partkey AS page, p_partkey::VARCHAR AS variant_id, p_name AS product_title, p_type AS variant_title, '' AS sku,
           p_retailprice AS price, CASE WHEN p_size % 2 = 0 THEN 'NOK' ELSE '?' END AS currency, p_size::BIGINT AS quantity FROM part""")
def s5_json(spark, d):
    text = F.concat(
        F.lit('{"product":{"title":"'), "p_name", F.lit('","variants":[{"id":'), "p_partkey", F.lit(',"title":"'), "p_type", F.lit('","price":"'),
        "p_retailprice", F.lit('","inventory_management":"shopify","inventory_quantity":'), "p_size",
        F.when(F.col("p_size") % 2 == 0, ',"price_currency":"NOK"').otherwise(""),
        F.lit('},{"id":1,"inventory_quantity":5},{"id":2,"inventory_management":"shopify"}]}}'))
    return p.json_inventory(table(spark, d, "part").select(F.col("p_partkey").alias("page"), text.alias("payload")), "payload", "shopify")


NOTICE_NAMESPACES = (
    'xmlns="urn:oasis:names:specification:ubl:schema:xsd:ContractAwardNotice-2" '
    'xmlns:cac="urn:oasis:names:specification:ubl:schema:xsd:CommonAggregateComponents-2" '
    'xmlns:cbc="urn:oasis:names:specification:ubl:schema:xsd:CommonBasicComponents-2" '
    'xmlns:ext="urn:oasis:names:specification:ubl:schema:xsd:CommonExtensionComponents-2" '
    'xmlns:efac="http://data.europa.eu/p27/eforms-ubl-extension-aggregate-components/1" '
    'xmlns:efbc="http://data.europa.eu/p27/eforms-ubl-extension-basic-components/1" '
    'xmlns:efext="http://data.europa.eu/p27/eforms-ubl-extensions/1"'
)


def notice_documents(spark, d):
    """One XML notice per order: two lots, three tenders, three organisations.

    The customer's segment names the first organisation; the first lot is won by tender 1 or 2. The orders are one small
    file, so the documents are spread by their key, as many stored files would be, and each is built once.
    """
    def el(*parts):
        return F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])

    def org(i, name):
        return el(f"<efac:Organization><efac:Company><cac:PartyIdentification><cbc:ID>ORG-{i}</cbc:ID></cac:PartyIdentification>"
                  "<cac:PartyName><cbc:Name>", name, "</cbc:Name></cac:PartyName></efac:Company></efac:Organization>")

    def party(i, *orgs):
        tenderers = "".join(f"<efac:Tenderer><cbc:ID>ORG-{o}</cbc:ID></efac:Tenderer>" for o in orgs)
        return f"<efac:TenderingParty><cbc:ID>TPA-{i}</cbc:ID>{tenderers}</efac:TenderingParty>"

    def tender(i, lot, party_id, amount):
        return el(f"<efac:LotTender><cbc:ID>TEN-{i}</cbc:ID><cac:LegalMonetaryTotal><cbc:PayableAmount currencyID=\"SEK\">", amount,
                  f"</cbc:PayableAmount></cac:LegalMonetaryTotal><efac:TenderingParty><cbc:ID>TPA-{party_id}</cbc:ID></efac:TenderingParty>"
                  f"<efac:TenderLot><cbc:ID>LOT-{lot}</cbc:ID></efac:TenderLot></efac:LotTender>")

    def result(lot, winner, fa):
        return el("<efac:LotResult><cbc:TenderResultCode>selec-w</cbc:TenderResultCode>", fa, "<efac:LotTender><cbc:ID>", winner,
                  f"</cbc:ID></efac:LotTender><efac:TenderLot><cbc:ID>LOT-{lot}</cbc:ID></efac:TenderLot></efac:LotResult>")

    def lot(i, title):
        return el(f"<cac:ProcurementProjectLot><cbc:ID>LOT-{i}</cbc:ID><cac:ProcurementProject><cbc:Name>", title,
                  "</cbc:Name><cac:PlannedPeriod><cbc:StartDate>", F.date_format("o_orderdate", "yyyy-MM-dd"),
                  "+02:00</cbc:StartDate><cbc:EndDate>2003-01-01Z</cbc:EndDate></cac:PlannedPeriod></cac:ProcurementProject></cac:ProcurementProjectLot>")

    odd = F.col("o_orderkey") % 2 == 1
    fa = F.when(F.col("o_orderkey") % 5 == 0, el(
        '<efac:FrameworkAgreementValues><cbc:MaximumValueAmount currencyID="EUR">', F.col("o_orderkey") % 100,
        "</cbc:MaximumValueAmount></efac:FrameworkAgreementValues>")).otherwise("")
    body = el(
        f"<ContractAwardNotice {NOTICE_NAMESPACES}><ext:UBLExtensions><ext:UBLExtension><ext:ExtensionContent><efext:EformsExtension>"
        "<efac:NoticeResult><cbc:TotalAmount currencyID=\"SEK\">", F.col("o_totalprice"), "</cbc:TotalAmount>",
        result(1, F.when(odd, "TEN-1").otherwise("TEN-2"), fa), result(2, "TEN-3", ""),
        tender(1, 1, 1, F.col("o_custkey") + 0.5), tender(2, 1, 2, F.lit("7")), tender(3, 2, 1, F.lit("9.25")),
        "<efac:SettledContract><cbc:ID>CON-1</cbc:ID><cac:Contract><cbc:Title>", F.col("o_orderpriority"),
        "</cbc:Title></cac:Contract><efac:LotTender><cbc:ID>TEN-3</cbc:ID></efac:LotTender></efac:SettledContract>",
        party(1, 1, 3), party(2, 2),
        "</efac:NoticeResult><efac:Publication><efbc:NoticePublicationID>", F.col("o_orderkey"),
        "</efbc:NoticePublicationID></efac:Publication><efac:Organizations>", org(1, F.concat("c_mktsegment", F.lit(" AB"))), org(2, F.lit("Other Ltd")),
        org(3, F.lit("Partner Oy")), "</efac:Organizations></efext:EformsExtension></ext:ExtensionContent></ext:UBLExtension></ext:UBLExtensions>",
        "<cac:ProcurementProject><cac:RequestedTenderTotal><cbc:EstimatedOverallContractAmount currencyID=\"NOK\">1000</cbc:EstimatedOverallContractAmount>"
        "</cac:RequestedTenderTotal></cac:ProcurementProject>",
        lot(1, F.col("o_orderpriority")), lot(2, F.lit("second")), "</ContractAwardNotice>")
    empty = F.lit(f"<ContractAwardNotice {NOTICE_NAMESPACES}><cbc:ID>planned</cbc:ID></ContractAwardNotice>")
    orders = table(spark, d, "orders").join(
        table(spark, d, "customer"), F.col("c_custkey") == F.col("o_custkey")).repartition(spark.sparkContext.defaultParallelism, "o_orderkey")
    return orders.select(F.col("o_orderkey").cast("string").alias("publication_number"),
                         keep_if(F.when(F.col("o_orderstatus") == "P", empty).otherwise(body), lambda x: x.isNotNull()).alias("xml"))


_AWARDED = "(SELECT * FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderstatus <> 'P')"


def _notice_sums(parsed):
    return parsed.select(
        "publication_number", *[F.size(c).alias(c) for c in ("orgs", "parties", "lots", "tenders")],
        F.aggregate("tenders", F.lit(0.0), lambda acc, t: acc + t["tender_value"]).alias("value_sum"),
        "total_awarded_value", "total_awarded_currency")


_NOTICE_SUMS = f"""
    SELECT o_orderkey::VARCHAR AS publication_number, 3::BIGINT AS orgs, 2::BIGINT AS parties, 2::BIGINT AS lots, 3::BIGINT AS tenders,
           o_custkey + 0.5::DOUBLE + 16.25::DOUBLE AS value_sum, o_totalprice AS total_awarded_value, 'SEK' AS total_awarded_currency
    FROM {_AWARDED}"""


@query("s6_notice_documents", _NOTICE_SUMS)
def s6(spark, d):
    return _notice_sums(parse_notices(notice_documents(spark, d)))


def notice_files(spark, d) -> str:
    """The notices as a folder of XML files, those of a thousand order numbers in one, and a file that breaks off in a notice.

    The files are packed, by the fastest level of gzip.
    """
    folder = new_folder(spark)
    docs = notice_documents(spark, d).withColumn("file", F.expr("cast(publication_number as bigint) div 1000"))
    files = docs.groupBy("file").agg(F.concat(F.lit("<Notices>"), F.array_join(F.collect_list("xml"), ""), F.lit("</Notices>")).alias("xml"))
    packed = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
    files.repartition("file").write.options(**packed).partitionBy("file").text(folder)
    cut = docs.agg(F.max("publication_number").alias("n")).where("n is not null").select(
        F.lit("<Notices><ContractAwardNotice><ProcurementProject>").alias("xml"), F.lit(-1).alias("file"))
    cut.write.mode("append").partitionBy("file").text(folder)
    return folder


@query("s6_notice_files", _NOTICE_SUMS)
def s6_files(spark, d):
    return _notice_sums(stored_notices(read_notices(spark, notice_files(spark, d))))


@query("s6_broken_notices", """
    SELECT 'whole' AS state, count(*) AS notices FROM orders JOIN customer ON c_custkey = o_custkey
    UNION ALL SELECT 'broken', 1 WHERE EXISTS (FROM orders)""")
def s6_broken(spark, d):
    found = read_notices(spark, notice_files(spark, d))
    return found.groupBy(F.when(F.col("broken").isNull(), "whole").otherwise("broken").alias("state")).agg(F.count("publication_number").alias("notices"))


@query("j10_reference_chain", f"""
    SELECT o_orderkey::VARCHAR AS publication_number, tender_id, lot_id, CASE lot_id WHEN 'LOT-1' THEN o_orderpriority ELSE 'second' END AS lot_title,
           CASE tender_id WHEN 'TEN-1' THEN o_custkey + 0.5::DOUBLE ELSE 9.25 END AS tender_value,
           (tender_id = 'TEN-3' OR o_orderkey % 2 = 1)::BIGINT AS is_winner, CASE tender_id WHEN 'TEN-3' THEN o_orderpriority END AS contract_title
    FROM {_AWARDED} CROSS JOIN (SELECT unnest(['TEN-1', 'TEN-3']) AS tender_id, unnest(['LOT-1', 'LOT-2']) AS lot_id)
    WHERE c_mktsegment = 'BUILDING'""")
def j10(spark, d):
    # Seven tables come from one parse: it is kept instead of being repeated for each. Documents whose text cannot name the
    # company end no chain and are not parsed.
    company = F.lit("Building GmbH")
    candidates = notice_documents(spark, d).where(may_name_company(F.col("xml"), company))
    t = notice_tables(cut_lineage(parse_notices(candidates)), "publication_number")
    rows = link_graph(
        t["orgs"], t["parties"], t["tenders"], t["lots"], t["results"].select("publication_number", "lot_id").distinct(),
        t["winners"], t["contracts"], names_company(F.col("name"), company), "publication_number")
    return rows.select("publication_number", "tender_id", "lot_id", "lot_title", "tender_value", "is_winner", "contract_title")


@query("s7_rank_graph_points", """
    WITH pts AS (SELECT event_id, event_type AS country, ts::DATE + off AS snapshot_date, (user_id + off)::BIGINT AS rank
                 FROM events CROSS JOIN (SELECT unnest([0, 1]) AS off))
    SELECT snapshot_date::VARCHAR AS snapshot_date, k.country, count(*) AS points, coalesce(sum(rank), 0)::BIGINT AS ranks
    FROM (SELECT DISTINCT event_id, snapshot_date FROM pts)
    CROSS JOIN (SELECT unnest(['click', 'view', 'signup', 'error', 'purchase']) AS country) k
    LEFT JOIN pts USING (event_id, snapshot_date, country) GROUP BY ALL""")
def s7(spark, d):
    day = F.unix_seconds(F.col("ts").cast("timestamp")).cast("double")
    user = F.col("user_id").cast("double")
    points = F.array(F.array(day, user + 5.0), F.array(day, user), F.array(day + 86400.0, user + 1))
    rows = table(spark, d, "events").select("event_id", "event_type", points.alias("points"))
    graph = p.explode_graph(rows, ["event_id"], "event_type", "points", ["click", "view", "signup", "error", "purchase"])
    return graph.groupBy("snapshot_date", "country").agg(
        F.count(F.lit(1)).alias("points"), F.coalesce(F.sum("rank"), F.lit(0)).alias("ranks"))


@query("s8_wide_history", """
    SELECT c_mktsegment, count(*) AS n, sum(c_acctbal::DECIMAL(18,2))::DOUBLE AS balance FROM customer GROUP BY ALL""")
def s8(spark, d):
    wide = m.read_wide(spark, f"{d}/customer.parquet", "c_custkey bigint, c_mktsegment string, c_acctbal double", "parquet")
    return wide.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("c_acctbal").cast("decimal(18,2)")).alias("balance"))


@query("s9_read_or_default", "SELECT n_name, n_regionkey::BIGINT AS n_regionkey FROM nation")
def s9(spark, d):
    default = table(spark, d, "nation").select("n_name", "n_regionkey")
    return m.read_or_default(spark, "tidemark_tracked_companies", default)


@query("s9_three_cases", """
    SELECT 'missing' AS state, n_name AS company FROM nation WHERE n_regionkey = 0 UNION ALL SELECT 'empty', n_name FROM nation WHERE n_regionkey = 0
    UNION ALL SELECT 'filled', s_name FROM supplier""")
def s9_cases(spark, d):
    """The default where the configured table is missing or has no row, else the table."""
    default = table(spark, d, "nation").where("n_regionkey = 0").select(F.col("n_name").alias("company"))
    tracked = table(spark, d, "supplier").select(F.col("s_name").alias("company"))
    tracked.where("false").createOrReplaceTempView("tidemark_tracked_empty")
    tracked.createOrReplaceTempView("tidemark_tracked_filled")
    return union_labelled({s: m.read_or_default(spark, f"tidemark_tracked_{s}", default) for s in ("missing", "empty", "filled")}, "state")


# --- merges --------------------------------------------------------------------------------

def captured_events(spark, d) -> DataFrame:
    """Every event as an incoming capture; days repeat per key, so a batch holds duplicates."""
    return table(spark, d, "events").select(
        F.to_date("ts").alias("snapshot_date"), F.col("event_type").alias("store"), F.col("user_id").alias("variant_id"),
        F.col("value").cast("bigint").alias("quantity"), F.col("event_id").alias("ordinal"))


_MERGED = f"""
    SELECT snapshot_date, store, variant_id, quantity FROM ({b.STORE_SNAPSHOT}) WHERE snapshot_date <= DATE '2024-01-15'
    UNION ALL
    SELECT ts::DATE, event_type, user_id, trunc(arg_min(value, event_id))::BIGINT FROM events
    WHERE ts::DATE > DATE '2024-01-15' GROUP BY ts::DATE, event_type, user_id"""


@query("k1_insert_absent", f"SELECT snapshot_date::VARCHAR AS snapshot_date, store, variant_id, quantity FROM ({_MERGED})")
def k1(spark, d):
    target = b.store_snapshot(spark, d).drop("price").where("snapshot_date <= date'2024-01-15'")
    return m.insert_absent(target, captured_events(spark, d), ["snapshot_date", "store", "variant_id"], "ordinal")


@query("k1_append_absent_twice", f"""
    SELECT snapshot_date::VARCHAR AS snapshot_date, store, variant_id, quantity, (SELECT count(*) FROM ({_MERGED}))
           - (SELECT count(*) FROM ({b.STORE_SNAPSHOT}) WHERE snapshot_date <= DATE '2024-01-15') AS inserted, 0::BIGINT AS inserted_again
    FROM ({_MERGED})""")
def k1_table(spark, d):
    """The same merge into a stored table; loading the batch again inserts nothing."""
    path, keys = new_folder(spark) + "/snapshot", ["snapshot_date", "store", "variant_id"]
    first = b.store_snapshot(spark, d).drop("price").where("snapshot_date <= date'2024-01-15'").withColumn("ordinal", F.lit(0))
    m.append_absent(first, path, keys, "ordinal", "snapshot_date")
    one = m.append_absent(captured_events(spark, d), path, keys, "ordinal", "snapshot_date")
    two = m.append_absent(captured_events(spark, d), path, keys, "ordinal", "snapshot_date")
    return spark.read.parquet(path).select(*keys, "quantity", F.lit(one).alias("inserted"), F.lit(two).alias("inserted_again"))


_UPSERTED = """
    SELECT coalesce(c_custkey, o_custkey) AS key, c_mktsegment AS segment, coalesce(o_status, 'new') AS status, o_total AS total
    FROM customer FULL JOIN (SELECT o_custkey, arg_max(o_orderstatus, o_orderkey) AS o_status, arg_max(o_totalprice, o_orderkey) AS o_total
                             FROM orders GROUP BY ALL) ON o_custkey = c_custkey"""


def customer_state(spark, d):
    return table(spark, d, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("segment"), F.lit("new").alias("status"), F.lit(None).cast("double").alias("total"))


def order_updates(spark, d):
    return table(spark, d, "orders").select(
        F.col("o_custkey").alias("key"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("total"), F.col("o_orderkey").alias("ordinal"))


@query("k2_upsert", _UPSERTED)
def k2(spark, d):
    return m.upsert(customer_state(spark, d), order_updates(spark, d), ["key"], "ordinal")


@query("k2_upsert_collisions", "SELECT o_custkey AS key, count(*) AS copies FROM orders GROUP BY ALL HAVING count(*) > 1")
def k2_collisions(spark, d):
    return m.upsert_collisions(order_updates(spark, d), ["key"])


@query("k3_guarded_writes", """
    SELECT 'customers' AS "table", 'written' AS status, (SELECT count(*) FROM customer)::DOUBLE AS rows
    UNION ALL SELECT 'orders', 'written', (SELECT count(DISTINCT o_custkey) FROM orders)::DOUBLE
    UNION ALL SELECT 'broken', 'failed', NULL""")
def k3(spark, d):
    folder = new_folder(spark)
    state = customer_state(spark, d).withColumn("ordinal", F.lit(0))
    outcomes = {
        "customers": m.try_write(lambda: buckets.upsert_table(state, folder + "/state", ["key"], "ordinal")),
        "orders": m.try_write(lambda: buckets.upsert_table(order_updates(spark, d), folder + "/state", ["key"], "ordinal")),
        "broken": m.try_write(lambda: buckets.upsert_table(state, folder + "/other", ["no_such_key"], "ordinal")),
    }
    return m.run_status(spark, outcomes).select("table", "status", F.col("rows").cast("double").alias("rows"))


@query("k2_upsert_table", _UPSERTED)
def k2_table(spark, d):
    path = new_folder(spark) + "/state"
    buckets.upsert_table(customer_state(spark, d).withColumn("ordinal", F.lit(0)), path, ["key"], "ordinal")
    buckets.upsert_table(order_updates(spark, d), path, ["key"], "ordinal")
    return buckets.read_table(spark, path)


@query("k4_append_report", """
    SELECT month, n, NULL::DOUBLE AS total FROM (SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM orders GROUP BY ALL)
    UNION ALL SELECT strftime(l_shipdate, '%Y-%m'), count(*), sum(l_quantity) FROM lineitem GROUP BY ALL""")
def k4(spark, d):
    path = new_folder(spark) + "/report"
    month = F.date_format("o_orderdate", "yyyy-MM").alias("month")
    m.append_report(table(spark, d, "orders").groupBy(month).agg(F.count(F.lit(1)).alias("n")), path)
    shipped = table(spark, d, "lineitem").groupBy(F.date_format("l_shipdate", "yyyy-MM").alias("month")).agg(
        F.sum("l_quantity").alias("total"), F.count(F.lit(1)).alias("n"))
    m.append_report(shipped, path)
    return m.read_report(spark, path).select("month", "n", "total")


@query("k5_overwrite_report", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY ALL")
def k5(spark, d):
    path = new_folder(spark) + "/report"
    m.overwrite_report(table(spark, d, "orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n")), path)
    m.overwrite_report(table(spark, d, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n")), path)
    return spark.read.parquet(path)


@query("k6_update_changed", """
    SELECT key, segment, coalesce(s, status) AS status, (s IS DISTINCT FROM status AND k IS NOT NULL)::BIGINT AS was_changed
    FROM (SELECT c_custkey AS key, c_mktsegment AS segment, CASE WHEN c_nationkey % 2 = 0 THEN 'O' ELSE 'F' END AS status FROM customer)
    LEFT JOIN (SELECT o_custkey AS k, arg_max(o_orderstatus, o_orderkey) AS s FROM orders GROUP BY ALL) ON k = key""")
def k6(spark, d):
    target = table(spark, d, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("segment"),
        F.when(F.col("c_nationkey") % 2 == 0, "O").otherwise("F").alias("status"))
    source = order_updates(spark, d).groupBy("key").agg(F.max_by("status", "ordinal").alias("status"))
    return m.update_changed(target, source, ["key"], ["status"])


@query("k7_derive_snapshot_date", """
    SELECT snapshot_date::VARCHAR AS snapshot_date, count(*) AS n FROM (
        SELECT CASE WHEN user_id % 2 = 0 THEN DATE '2023-12-31' ELSE ((ts AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Stockholm')::DATE END
               AS snapshot_date FROM events) GROUP BY ALL""")
def k7(spark, d):
    rows = table(spark, d, "events").withColumn("snapshot_date", F.when(F.col("user_id") % 2 == 0, F.lit("2023-12-31").cast("date")))
    return m.derive_snapshot_date(rows, "ts").groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("n"))


@query("k7_backfill_violations", """
    SELECT snapshot_date::VARCHAR AS snapshot_date, user_id, count(*) AS rows, CASE WHEN snapshot_date IS NULL THEN 'no date' ELSE 'repeated key' END AS fault
    FROM (SELECT CASE WHEN event_id % 50 <> 0 THEN CASE WHEN user_id % 2 = 0 THEN DATE '2023-12-31' ELSE ((ts AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Stockholm')::DATE END END
                 AS snapshot_date, CASE WHEN event_id % 7 <> 0 THEN user_id END AS user_id FROM events)
    GROUP BY ALL HAVING snapshot_date IS NULL OR (user_id IS NOT NULL AND count(*) > 1)""")
def k7_violations(spark, d):
    known = F.when((F.col("user_id") % 2 == 0) & (F.col("event_id") % 50 != 0), F.lit("2023-12-31").cast("date"))
    rows = table(spark, d, "events").select(
        known.alias("snapshot_date"), F.when(F.col("event_id") % 50 != 0, F.col("ts")).alias("ts"), F.when(F.col("event_id") % 7 != 0, F.col("user_id")).alias("user_id"))
    return m.backfill_violations(rows, "ts", ["user_id"])


@query("q8_run_status", """
    SELECT 'report' AS "table", 'written' AS status, (SELECT count(DISTINCT o_custkey) FROM orders)::DOUBLE AS rows""")
def q8(spark, d):
    path = new_folder(spark) + "/state"
    done = m.try_write(lambda: buckets.upsert_table(order_updates(spark, d), path, ["key"], "ordinal"))
    return m.run_status(spark, {"report": done}).select("table", "status", F.col("rows").cast("double").alias("rows"))


# --- incremental ---------------------------------------------------------------------------

def stream_deltas(spark, d, on_absent: str) -> DataFrame:
    """Captures, several a day, arrive in two batches of whole days; the second run resumes from the state."""
    folder = new_folder(spark)
    facts = captured_events(spark, d)
    middle = facts.select((F.min(F.unix_date("snapshot_date")) + F.max(F.unix_date("snapshot_date"))).alias("s")).select(
        F.date_from_unix_date(F.floor(F.col("s") / 2).cast("int")).alias("m")).select("m").scalar()
    keys = ["store", "variant_id"]
    for part in (F.col("snapshot_date") <= middle, F.col("snapshot_date") > middle):
        facts.where(part).write.mode("append").parquet(folder + "/in")
        stream = spark.readStream.schema(facts.schema).parquet(folder + "/in")
        writer = incremental_delta(stream, keys, "snapshot_date", "quantity", "ordinal", folder + "/state", folder + "/out", on_absent, buckets=16)
        run = writer.option("checkpointLocation", folder + "/offsets").trigger(availableNow=True).start()
        run.awaitTermination()
    return read_deltas(spark, folder + "/out", keys, "snapshot_date").select(
        "snapshot_date", *keys, "quantity", F.col("delta").cast("double").alias("delta"))


@query("x1_incremental_remember", f"""
    SELECT snapshot_date::VARCHAR AS snapshot_date, store, variant_id, quantity,
           (quantity - lag(quantity) OVER (PARTITION BY store, variant_id ORDER BY snapshot_date))::DOUBLE AS delta FROM ({b.STORE_SNAPSHOT})""")
def x1(spark, d):
    return stream_deltas(spark, d, "remember")


@query("x1_incremental_forget", f"""
    WITH s AS ({b.STORE_SNAPSHOT}), k AS (SELECT d, lag(d) OVER (ORDER BY d) AS before FROM (SELECT DISTINCT snapshot_date AS d FROM s))
    SELECT c.snapshot_date::VARCHAR AS snapshot_date, c.store, c.variant_id, c.quantity, (c.quantity - o.quantity)::DOUBLE AS delta
    FROM s c JOIN k ON k.d = c.snapshot_date
    LEFT JOIN s o ON o.snapshot_date = k.before AND o.store = c.store AND o.variant_id = c.variant_id""")
def x1_forget(spark, d):
    return stream_deltas(spark, d, "forget")
