import json
import random
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.functions.text import names_company
from tidemark.operators.deltas import date_pair_delta, snapshot_delta
from tidemark.operators.picks import last_wins
from tidemark.sources import buckets
from tidemark.sources import payloads as p
from tidemark.sources import tables as m
from tidemark.sources.notices import lot_tenders, notice_tables, parse_notices, read_notices, stored_notices
from tidemark.streaming.incremental import incremental_delta, read_deltas
from tidemark.workload import payloads
from tidemark.workload.payloads import NOTICE_NAMESPACES
from tidemark.workload.views import v12


def test_dated_files(spark, tmp_path):
    (tmp_path / "2024-01-02.json").write_text(json.dumps({"7": {"available": 3, "snapshot_time": "2024-01-01T23:30:00+01:00"}, "8": {"available": None}}))
    rows = p.read_dated_json(spark, str(tmp_path), "available:bigint").orderBy("product_id").collect()
    assert [(r.product_id, str(r.snapshot_date), r.available) for r in rows] == [("7", "2024-01-01", 3), ("8", "2024-01-02", None)]
    assert rows[0].captured_at == datetime(2024, 1, 1, 22, 30) and rows[1].captured_at == datetime(2024, 1, 2)


def test_state_maps_and_latest_file(spark):
    docs = spark.createDataFrame([("2024-01-01", {"d": {"a": {"w": 1}}}), ("2024-01-02", {"d": {"a": {"w": 2, "v": 0}}})],
                                 "f string, s map<string,map<string,map<string,bigint>>>")
    rows = p.explode_state(p.latest_file(docs, "f"), "s", ["day", "article", "warehouse"]).collect()
    assert sorted((r.warehouse, r.quantity) for r in rows) == [("v", 0), ("w", 2)]


def test_graph_is_padded(spark):
    df = spark.createDataFrame([("app", "SE", [[1704067200.0, 5.0], [1704067300.0, 4.0]]), ("app", "DE", [[1704153600.0, 9.0]])],
                               "app string, cc string, pts array<array<double>>")
    got = {(str(r.snapshot_date), r.country): r.rank for r in p.explode_graph(df, ["app"], "cc", "pts", ["SE", "DE", "FI"]).collect()}
    assert got == {("2024-01-01", "SE"): 4, ("2024-01-01", "DE"): None, ("2024-01-01", "FI"): None,
                   ("2024-01-02", "SE"): None, ("2024-01-02", "DE"): 9, ("2024-01-02", "FI"): None}


@pytest.mark.parametrize("seed", range(3))
def test_merges_equal_a_dict(spark, seed):
    rnd = random.Random(seed)
    old = {k: (rnd.randint(0, 9), "t") for k in range(20)}
    batch = [(rnd.randint(10, 40), rnd.randint(0, 9), i) for i in range(60)]
    target = spark.createDataFrame([(k, *v) for k, v in old.items()], "k long, v long, note string")
    source = spark.createDataFrame(batch, "k long, v long, ordinal long")
    first, last = dict(old), dict(old)
    for k, v, _ in batch:
        first.setdefault(k, (v, None))
        last[k] = (v, old[k][1] if k in old else None)
    assert {r.k: (r.v, r.note) for r in m.insert_absent(target, source, ["k"], "ordinal").collect()} == first
    assert {r.k: (r.v, r.note) for r in m.upsert(target, source, ["k"], "ordinal").collect()} == last


def test_upsert_may_set_null(spark):
    target = spark.createDataFrame([(1, "x")], "k long, v string")
    source = spark.createDataFrame([(1, None, 0)], "k long, v string, ordinal long")
    assert m.upsert(target, source, ["k"], "ordinal").first().v is None


def test_append_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    batch = spark.createDataFrame([(date(2024, 1, 1), 1, 5, 0), (date(2024, 1, 1), 1, 6, 1), (date(2024, 1, 2), 1, 7, 2)],
                                  "d date, k long, v long, ordinal long")
    assert m.append_absent(batch, path, ["d", "k"], "ordinal", "d") == 2
    assert m.append_absent(batch, path, ["d", "k"], "ordinal", "d") == 0
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [5, 7]


def test_append_counts_nothing_after_a_shuffled_join(spark, tmp_path):
    """A table too large to broadcast: the empty result of the join is found only while the write runs."""
    path = str(tmp_path / "t")
    batch = spark.range(50).selectExpr("date'2024-01-01' + cast(id % 5 as int) as d", "id as k", "id as ordinal")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert [m.append_absent(batch, path, ["d", "k"], "ordinal", "d") for _ in range(3)] == [50, 0, 0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert spark.read.parquet(path).count() == 50


def folders(path, depth):
    return {str(x.relative_to(path)) for x in path.glob("/".join(["*=*"] * depth))}


def test_upsert_rewrites_only_touched_buckets(spark, tmp_path):
    path, keys = str(tmp_path / "s"), ["k"]
    rows = spark.createDataFrame([(k, f"v{k}", k % 3, 0) for k in range(200)], "k long, v string, note int, ordinal long")
    assert buckets.read_table(spark, path) is None
    assert buckets.upsert_table(rows, path, keys, "ordinal", buckets=16) == 200
    first = folders(tmp_path / "s", 3)
    one = spark.createDataFrame([(7, "old", 1), (7, "new", 2)], "k long, v string, ordinal long")
    assert buckets.upsert_table(one, path, keys, "ordinal") == 1
    assert len(folders(tmp_path / "s", 3) - first) == 1
    got = {r.k: (r.v, r.note) for r in buckets.read_table(spark, path).collect()}
    assert len(got) == 200 and got[7] == ("new", 1) and got[8] == ("v8", 2)
    more = spark.createDataFrame([(500, "x", 5.0, 1)], "k long, v string, extra double, ordinal long")
    assert buckets.upsert_table(more, path, keys, "ordinal") == 1
    assert {r.k: r.extra for r in buckets.read_table(spark, path).where("k >= 199").collect()} == {199: None, 500: 5.0}
    assert buckets.drop_old_versions(spark, path, 4) in (1, 2) and buckets.read_table(spark, path).count() == 201
    assert buckets.upsert_table(one.limit(0), path, keys, "ordinal") == 0 and buckets.read_table(spark, path).count() == 201


def test_upsert_refuses_a_second_writer_and_survives_a_dead_one(spark, tmp_path):
    path = str(tmp_path / "s")
    rows = spark.createDataFrame([(k, k, 0) for k in range(20)], "k long, v long, ordinal long")
    buckets.upsert_table(rows, path, ["k"], "ordinal", buckets=4)
    # A writer that died: its claim stands, half of its buckets are written, nothing of it is in view.
    (tmp_path / "s" / "_commits" / "claim-2").touch()
    buckets.write_buckets(rows.where("k < 5").drop("ordinal").withColumn("v", F.lit(-1)), path, ["k"], 4, 2)
    assert sorted(r.v for r in buckets.read_table(spark, path).collect()) == list(range(20))
    with pytest.raises(RuntimeError, match="another writer"):
        buckets.upsert_table(rows, path, ["k"], "ordinal")
    assert buckets.release(spark, path) and not buckets.release(spark, path)
    assert buckets.upsert_table(rows.withColumn("v", F.col("v") + 100), path, ["k"], "ordinal") == 20
    assert sorted(r.v for r in buckets.read_table(spark, path).collect()) == list(range(100, 120))
    with pytest.raises(ValueError, match="whole key"):
        buckets.upsert_table(spark.createDataFrame([(None, 1, 1)], "k long, v long, ordinal long"), path, ["k"], "ordinal")
    count, error = m.try_write(lambda: buckets.upsert_table(rows, path, ["nope"], "ordinal"))
    assert count is None and "nope" in error


def test_update_changed_counts_only_differences(spark):
    target = spark.createDataFrame([(1, "a"), (2, None), (3, "c"), (4, "d")], "k long, v string")
    source = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k long, v string")
    got = {r.k: (r.v, r.was_changed) for r in m.update_changed(target, source, ["k"], ["v"]).collect()}
    assert got == {1: ("a", False), 2: ("b", True), 3: (None, True), 4: ("d", False)}


def notice(results="", contracts="", total="<cbc:TotalAmount currencyID='SEK'>5</cbc:TotalAmount>"):
    def tender(i, lot, party):
        return (f"<efac:LotTender><cbc:ID>T{i}</cbc:ID><cac:LegalMonetaryTotal><cbc:PayableAmount currencyID='SEK'>{i}0</cbc:PayableAmount>"
                f"</cac:LegalMonetaryTotal><efac:TenderingParty><cbc:ID>P{party}</cbc:ID></efac:TenderingParty><efac:TenderLot><cbc:ID>L{lot}</cbc:ID>"
                "</efac:TenderLot></efac:LotTender>")
    def org(i, name):
        return (f"<efac:Organization><efac:Company><cac:PartyIdentification><cbc:ID>O{i}</cbc:ID></cac:PartyIdentification><cac:PartyName>"
                f"<cbc:Name>{name}</cbc:Name></cac:PartyName></efac:Company></efac:Organization>")
    return (f"<ContractAwardNotice {NOTICE_NAMESPACES}><ext:UBLExtensions><ext:UBLExtension><ext:ExtensionContent><efext:EformsExtension>"
            f"<efac:NoticeResult>{total}{results}{tender(1, 1, 1)}{tender(2, 1, 2)}{tender(3, 2, 1)}{contracts}"
            "<efac:TenderingParty><cbc:ID>P1</cbc:ID><efac:Tenderer><cbc:ID>O1</cbc:ID></efac:Tenderer></efac:TenderingParty>"
            "<efac:TenderingParty><cbc:ID>P2</cbc:ID><efac:Tenderer><cbc:ID>O2</cbc:ID></efac:Tenderer></efac:TenderingParty></efac:NoticeResult>"
            f"<efac:Organizations>{org(1, 'Acme Sverige')}{org(2, 'Other')}</efac:Organizations></efext:EformsExtension></ext:ExtensionContent>"
            "</ext:UBLExtension></ext:UBLExtensions><cac:ProcurementProjectLot><cbc:ID>L1</cbc:ID><cac:ProcurementProject><cbc:Name>One</cbc:Name>"
            "<cac:PlannedPeriod><cbc:StartDate>2024-01-01+01:00</cbc:StartDate><cbc:EndDate>2026-01-01Z</cbc:EndDate></cac:PlannedPeriod>"
            "</cac:ProcurementProject></cac:ProcurementProjectLot></ContractAwardNotice>")


def result(lot, *winners, fa=""):
    fa = f"<efac:FrameworkAgreementValues><cbc:MaximumValueAmount currencyID='EUR'>{fa}</cbc:MaximumValueAmount></efac:FrameworkAgreementValues>" if fa else ""
    refs = "".join(f"<efac:LotTender><cbc:ID>{w}</cbc:ID></efac:LotTender>" for w in winners)
    return f"<efac:LotResult><cbc:TenderResultCode>x</cbc:TenderResultCode>{fa}{refs}<efac:TenderLot><cbc:ID>L{lot}</cbc:ID></efac:TenderLot></efac:LotResult>"


def test_lot_tenders(spark):
    contract = ("<efac:SettledContract><cbc:ID>C</cbc:ID><efbc:ContractFrameworkIndicator>true</efbc:ContractFrameworkIndicator><cac:Contract><cbc:Title>Deal"
                "</cbc:Title></cac:Contract><efac:LotTender><cbc:ID>T3</cbc:ID></efac:LotTender></efac:SettledContract>")
    docs = spark.createDataFrame([
        ("n1", notice(result(1, "T1") + result(1, "T2") + result(2, "T3"), contract)),  # repeated results: winners are merged
        ("n2", notice(result(1, "T2", fa="7") + result(2))),
        ("n3", "<ContractAwardNotice><a/></ContractAwardNotice>"), ("n4", "not xml"),
    ], "doc_id string, xml string")
    parsed = parse_notices(docs)
    got = {(r.doc_id, r.tender_id): r for r in lot_tenders(parsed, F.lit("Acme AB")).collect()}
    assert set(got) == {("n1", "T1"), ("n1", "T3"), ("n2", "T1"), ("n2", "T3")}
    a, b, c = got["n1", "T1"], got["n1", "T3"], got["n2", "T1"]
    assert (a.result, a.winners_on_lot, a.num_tenders_on_lot, a.is_framework, a.lots_won) == ("Won", 2, 2, "Yes", 2)
    assert (a.lot_title, a.start_date, a.end_date, a.duration_years, a.total_lots) == ("One", "2024-01-01", "2026-01-01", 2.0, 1)
    assert (b.contract_title, b.is_framework, b.lot_title, b.duration_years) == ("Deal", "Yes", "", None)
    assert (c.result, c.fa_max_value, c.fa_max_currency, c.is_framework, c.total_awarded_value) == ("Lost", 7.0, "EUR", "Yes", 5.0)
    assert got["n2", "T3"].is_framework == "No"
    tables = notice_tables(parsed, "doc_id")
    assert tables["winners"].count() == 4 and tables["orgs"].where(names_company(F.col("name"), F.lit("Acme AB"))).count() == 2


def captures(spark, days=(1, 2, 4, 5, 6)):
    """Several captures of a key and day; key 0 is away on two days."""
    rnd = random.Random(11)
    rows = [(date(2024, 1, d), k, d * 1000 + rnd.randint(0, 900), rnd.randint(0, 20)) for d in days for k in range(30)
            for _ in range(rnd.choice([0, 1, 1, 3])) if not (k == 0 and d in (2, 4))]
    return spark.createDataFrame(rows, "d date, k long, at long, q long").dropDuplicates(["d", "k", "at"])


def whole_history(facts, on_absent):
    kept = last_wins(facts, ["d", "k"], "at")
    return snapshot_delta(kept, ["k"], "d", "q", max_gap_days=None, mode="diff", adjacent=on_absent == "forget")


def run_stream(spark, folder, schema, on_absent):
    stream = spark.readStream.schema(schema).parquet(folder + "/in")
    writer = incremental_delta(stream, ["k"], "d", "q", "at", folder + "/state", folder + "/out", on_absent, buckets=8)
    writer.option("checkpointLocation", folder + "/ckpt").trigger(availableNow=True).start().awaitTermination()


@pytest.mark.parametrize("on_absent", ["remember", "forget"])
def test_stream_day_by_day_equals_history(spark, tmp_path, on_absent):
    facts, folder = captures(spark).cache(), str(tmp_path)
    for d in (1, 2, 4, 5, 6):
        facts.where(F.col("d") == date(2024, 1, d)).coalesce(1).write.mode("append").parquet(folder + "/in")
        run_stream(spark, folder, facts.schema, on_absent)
        if d in (2, 5):  # the driver dies after the state is written and before the batch is recorded: it runs again
            last = max(int(x.name) for x in (tmp_path / "ckpt" / "commits").glob("[0-9]*"))
            for name in (str(last), f".{last}.crc"):
                (tmp_path / "ckpt" / "commits" / name).unlink(missing_ok=True)
            run_stream(spark, folder, facts.schema, on_absent)
    got = [str((r.d, r.k, r.q, r.delta)) for r in read_deltas(spark, folder + "/out", ["k"], "d").collect()]
    assert sorted(got) == sorted(str((r.d, r.k, r.q, r.delta)) for r in whole_history(facts, on_absent).collect())


def test_stream_corrects_the_last_day_and_writes_only_touched_buckets(spark, tmp_path):
    folder, shape = str(tmp_path), "d date, k long, at long, q long"
    parts = [[(date(2024, 1, 1), k, 1, 10) for k in range(40)], [(date(2024, 1, 2), k, 2, 4) for k in range(40)],
             [(date(2024, 1, 2), 3, 5, 9)], [(date(2024, 1, 3), 3, 6, 8)]]
    for part in parts:
        spark.createDataFrame(part, shape).coalesce(1).write.mode("append").parquet(folder + "/in")
        run_stream(spark, folder, spark.createDataFrame(part, shape).schema, "forget")
    written = [len({x.parent for x in (tmp_path / "state").glob(f"buckets=8/bucket=*/version={v}/*.parquet")}) for v in range(4)]
    assert written == [8, 8, 1, 1]
    got = {(r.d.day, r.k): r.delta for r in read_deltas(spark, folder + "/out", ["k"], "d").collect()}
    assert got[2, 3] == -1 and got[2, 4] == -6 and got[3, 3] == -1 and len(got) == 81
    with pytest.raises(Exception, match="another checkpoint"):
        stream = spark.readStream.schema(shape).parquet(folder + "/in")
        writer = incremental_delta(stream, ["k"], "d", "q", "at", folder + "/state", folder + "/out", buckets=8)
        writer.option("checkpointLocation", folder + "/other").trigger(availableNow=True).start().awaitTermination()


def test_folder_of_notice_files(spark, tmp_path):
    note = ("<ContractAwardNotice xmlns:a='urn:a'><UBLExtensions><UBLExtension><ExtensionContent><a:EformsExtension><a:NoticeResult>"
            "<a:LotTender><ID>T1</ID></a:LotTender></a:NoticeResult>{}</a:EformsExtension></ExtensionContent></UBLExtension></UBLExtensions></ContractAwardNotice>")
    (tmp_path / "77-2024.xml").write_text(note.format(""))
    (tmp_path / "many.xml").write_text("<all>" + note.format("<a:Publication><NoticePublicationID>5</NoticePublicationID></a:Publication>") * 2 + "</all>")
    (tmp_path / "planned.xml").write_text("<ContractAwardNotice><ID>x</ID></ContractAwardNotice>")
    (tmp_path / "cut.xml").write_text(note.format("")[:120])
    (tmp_path / "empty.xml").write_text("")
    found = read_notices(spark, str(tmp_path))
    assert [r.publication_number for r in found.where("broken is not null").collect()] == ["cut"]
    rows = stored_notices(found).select("publication_number", "tenders.tender_id").collect()
    assert sorted((r.publication_number, r.tender_id) for r in rows) == [("5", ["T1"]), ("5", ["T1"]), ("77-2024", ["T1"])]


def test_date_pair_forms_agree_on_null_keys(spark):
    rows = [(date(2024, 1, 1), None, 3), (date(2024, 1, 2), None, 5), (date(2024, 1, 2), 1, 2)]
    df = spark.createDataFrame(rows, "d date, k long, q long")
    one, two = (sorted(map(str, date_pair_delta(df, ["k"], "d", "q", form).collect())) for form in ("full_outer", "union_sum"))
    assert one == two and len(one) == 2


@pytest.fixture
def orders(spark, tmp_path):
    spark.sql("select id as o_orderkey, id % 5 as o_custkey, 'F' as o_orderstatus, id + 0.5d as o_totalprice, timestamp'1999-01-02' as o_orderdate, "
              "'1-URGENT' as o_orderpriority from range(400)").write.parquet(str(tmp_path / "orders.parquet"))
    spark.sql("select id as c_custkey, cast(id as int) as c_nationkey, 'BUILDING' as c_mktsegment from range(5)").write.parquet(
        str(tmp_path / "customer.parquet"))
    return str(tmp_path)


def test_notice_files_are_packed(spark, orders):
    folder = payloads.notice_files(spark, orders)
    files = [f for f in Path(folder.removeprefix("file://")).rglob("part-*") if "file=-1" not in str(f)]
    plain = payloads.notice_documents(spark, orders).selectExpr("sum(octet_length(xml))").collect()[0][0]
    assert sum(f.stat().st_size for f in files) * 10 < plain
    found = read_notices(spark, folder)
    assert found.where("broken is null").select("publication_number").distinct().count() == 400 and found.where("broken is not null").count() == 1


def test_notices_are_parsed_once_before_the_upsert(spark, orders):
    rows = v12(spark, orders)
    assert rows.count() == 400 and rows.where("status = 'outdated'").count() == 0
    assert "parse_json" not in rows._jdf.queryExecution().optimizedPlan().toString().lower()


def test_reference_chain_parses_only_documents_that_may_name_the_company(spark, orders, monkeypatch):
    spark.sql("select id as c_custkey, cast(id as int) as c_nationkey, if(id = 3, 'BUILDING', 'MACHINERY') as c_mktsegment from range(5)").write.mode(
        "overwrite").parquet(orders + "/customer.parquet")
    parsed = []
    monkeypatch.setattr(payloads, "cut_lineage", lambda df: parsed.append(df.count()) or df)
    assert payloads.j10(spark, orders).count() == 160 and parsed == [80]
