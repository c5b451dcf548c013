"""Procurement notices in XML: one parse per document, then relational tables or in-row results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import duration_years, without_zone
from tidemark.functions.once import keep_if
from tidemark.functions.rules import framework_flag
from tidemark.functions.text import names_company

_ID = "ID: string"
_REF = f"struct<{_ID}>"
_MONEY = "struct<_VALUE: double, _currencyID: string>"

# Element names of the public notice standard, namespace prefixes dropped by the reader.
NOTICE_SCHEMA = f"""
    UBLExtensions struct<UBLExtension: struct<ExtensionContent: struct<EformsExtension: struct<
        NoticeResult: struct<
            TotalAmount: {_MONEY},
            OverallMaximumFrameworkContractsAmount: {_MONEY},
            LotResult: array<struct<
                TenderResultCode: string, TenderLot: {_REF}, LotTender: array<{_REF}>,
                FrameworkAgreementValues: struct<MaximumValueAmount: {_MONEY}>>>,
            LotTender: array<struct<
                {_ID}, TenderLot: {_REF}, TenderingParty: {_REF},
                LegalMonetaryTotal: struct<PayableAmount: {_MONEY}>>>,
            SettledContract: array<struct<
                {_ID}, Contract: struct<Title: string>, ContractFrameworkIndicator: string, LotTender: array<{_REF}>>>,
            TenderingParty: array<struct<{_ID}, Tenderer: array<{_REF}>>>>,
        Publication: struct<NoticePublicationID: string>,
        Organizations: struct<Organization: array<struct<Company: struct<
            PartyIdentification: {_REF}, PartyName: struct<Name: string>>>>>>>>>,
    ProcurementProject struct<RequestedTenderTotal: struct<EstimatedOverallContractAmount: {_MONEY}>>,
    ProcurementProjectLot array<struct<
        {_ID}, ProcurementProject: struct<Name: string, PlannedPeriod: struct<StartDate: string, EndDate: string>>>>
"""


_OPTIONS = {"ignoreNamespace": "true", "rowTag": "ContractAwardNotice"}
_FORM = "UBLExtensions.UBLExtension.ExtensionContent.EformsExtension"


def read_notices(spark: SparkSession, path: str) -> DataFrame:
    """Notices of a folder of XML files by Spark's XML source: ``publication_number, d, broken``.

    A file may hold several notices. The number is the notice's own, else the file's name. What is no whole notice is one
    row with its text in ``broken``.
    """
    reader = spark.read.schema(f"{NOTICE_SCHEMA}, __broken string").options(**_OPTIONS, mode="PERMISSIVE", columnNameOfCorruptRecord="__broken")
    found = reader.xml(path)
    named = F.regexp_extract("_metadata.file_path", r"([^/]+?)(?:\.xml)?$", 1)
    own = F.col(f"{_FORM}.Publication.NoticePublicationID")
    number = F.coalesce(F.nullif(F.trim(own), F.lit("")), named)
    return found.select(
        number.alias("publication_number"), F.struct("UBLExtensions", "ProcurementProject", "ProcurementProjectLot").alias("d"),
        # Spark refuses queries of the broken text alone; it never equals a number, which makes them read both.
        F.nullif(F.col("__broken"), own).alias("broken"),
    )


def stored_notices(read: DataFrame) -> DataFrame:
    """What ``parse_notices`` gives, from the whole notices that ``read_notices`` found."""
    return _shaped(read.where(F.col("broken").isNull() & F.col(f"d.{_FORM}.NoticeResult").isNotNull()), ["publication_number"])


def parse_notices(df: DataFrame, xml: str = "xml") -> DataFrame:
    """Parse each document of a column once into arrays of organisations, parties, lots, tenders, results, contracts.

    Documents without a result section are dropped.
    """
    kept = [c for c in df.columns if c != xml]

    # A plain filter on the result would be pushed below the parse and run it a second time.
    def has_result(doc: Column) -> Column:
        for name in f"{_FORM}.NoticeResult".split("."):
            doc = doc[name]
        return doc.isNotNull()

    return _shaped(df.select(*kept, keep_if(F.from_xml(xml, NOTICE_SCHEMA, _OPTIONS), has_result).alias("d")), kept)


def _shaped(parsed: DataFrame, kept: list[str]) -> DataFrame:
    form, result = f"d.{_FORM}", f"d.{_FORM}.NoticeResult"

    def items(path: str, shape) -> Column:
        return F.transform(F.coalesce(F.col(path), F.expr("array()").cast(_type_of(parsed, path))), shape)

    total = F.coalesce(f"{result}.TotalAmount", f"{result}.OverallMaximumFrameworkContractsAmount")
    estimate = "d.ProcurementProject.RequestedTenderTotal.EstimatedOverallContractAmount"
    return parsed.select(
        *kept,
        items(f"{form}.Organizations.Organization", lambda o: F.struct(
            o["Company"]["PartyIdentification"]["ID"].alias("org_id"),
            F.coalesce(o["Company"]["PartyName"]["Name"], F.lit("")).alias("name"))).alias("orgs"),
        items(f"{result}.TenderingParty", lambda p: F.struct(
            p["ID"].alias("party_id"),
            F.transform(p["Tenderer"], lambda t: t["ID"]).alias("org_ids"))).alias("parties"),
        items("d.ProcurementProjectLot", lambda x: F.struct(
            x["ID"].alias("lot_id"), F.coalesce(x["ProcurementProject"]["Name"], F.lit("")).alias("lot_title"),
            F.coalesce(without_zone(x["ProcurementProject"]["PlannedPeriod"]["StartDate"]), F.lit("")).alias("start_date"),
            F.coalesce(without_zone(x["ProcurementProject"]["PlannedPeriod"]["EndDate"]), F.lit("")).alias("end_date"),
        )).alias("lots"),
        items(f"{result}.LotTender", lambda t: F.struct(
            t["ID"].alias("tender_id"), F.coalesce(t["TenderLot"]["ID"], F.lit("")).alias("lot_id"),
            F.coalesce(t["TenderingParty"]["ID"], F.lit("")).alias("party_id"),
            t["LegalMonetaryTotal"]["PayableAmount"]["_VALUE"].alias("tender_value"),
            F.coalesce(t["LegalMonetaryTotal"]["PayableAmount"]["_currencyID"], F.lit("")).alias("currency"),
        )).alias("tenders"),
        items(f"{result}.LotResult", lambda r: F.struct(
            r["TenderLot"]["ID"].alias("lot_id"), r["TenderResultCode"].alias("result_code"),
            F.transform(r["LotTender"], lambda t: t["ID"]).alias("winner_ids"),
            r["FrameworkAgreementValues"]["MaximumValueAmount"]["_VALUE"].alias("fa_max_value"),
            r["FrameworkAgreementValues"]["MaximumValueAmount"]["_currencyID"].alias("fa_max_currency"),
        )).alias("results"),
        items(f"{result}.SettledContract", lambda c: F.struct(
            F.coalesce(c["Contract"]["Title"], F.lit("")).alias("contract_title"),
            F.coalesce(F.lower(F.trim(c["ContractFrameworkIndicator"])) == "true", F.lit(False)).alias("is_framework"),
            F.transform(c["LotTender"], lambda t: t["ID"]).alias("tender_ids"),
        )).alias("contracts"),
        F.col(estimate)["_VALUE"].alias("proc_estimated_value"),
        F.coalesce(F.col(estimate)["_currencyID"], F.lit("")).alias("proc_estimated_currency"),
        total["_VALUE"].alias("total_awarded_value"),
        F.coalesce(total["_currencyID"], F.lit("")).alias("total_awarded_currency"),
    )


def _type_of(df: DataFrame, path: str) -> str:
    return df.select(path).schema[0].dataType.simpleString()


def notice_tables(parsed: DataFrame, doc: str) -> dict[str, DataFrame]:
    """The parsed arrays as six relational tables keyed by document."""
    def rows(column: str) -> DataFrame:
        return parsed.select(doc, F.posexplode(column).alias("ordinal", "x")).select(doc, "ordinal", "x.*")

    parties, results, contracts = rows("parties"), rows("results"), rows("contracts")
    return {
        "orgs": rows("orgs").drop("ordinal"),
        "parties": parties.select(doc, "party_id", F.explode("org_ids").alias("org_id")),
        "lots": rows("lots").drop("ordinal"),
        "tenders": rows("tenders").drop("ordinal"),
        "results": results.where(F.col("lot_id").isNotNull()),
        "winners": results.where(F.col("lot_id").isNotNull())
        .select(doc, "lot_id", F.explode("winner_ids").alias("tender_id")).distinct(),
        "contracts": contracts.select(doc, "contract_title", "is_framework", F.explode("tender_ids").alias("tender_id")),
    }


def lot_tenders(parsed: DataFrame, company: Column) -> DataFrame:
    """One row per tender of the company, with lot, result, contract and notice totals.

    Organisation, party, tender, lot and result refer to each other only inside one document, so the
    whole reference chain is followed inside the row and the scan stays free of shuffles.
    """
    base = [c for c in parsed.columns if c not in ("orgs", "parties", "lots", "tenders", "results", "contracts")]
    org_ids = F.transform(F.filter("orgs", lambda o: o["org_id"].isNotNull() & names_company(o["name"], company)),
                          lambda o: o["org_id"])
    ours = parsed.withColumn("__orgs", org_ids).where(F.size("__orgs") > 0)
    party_ids = F.transform(F.filter("parties", lambda p: F.arrays_overlap(p["org_ids"], F.col("__orgs"))),
                            lambda p: p["party_id"])
    ours = ours.withColumn("__parties", party_ids)
    winner_ids = F.array_distinct(F.flatten(F.transform("results", lambda r: F.coalesce(
        r["winner_ids"], F.array().cast("array<string>")))))
    mine = F.filter("tenders", lambda t: t["tender_id"].isNotNull() & F.array_contains(F.col("__parties"), t["party_id"]))
    ours = ours.withColumns({"__winners": winner_ids, "__mine": mine}).where(F.size("__mine") > 0)

    def of_lot(results: str, lot: Column) -> Column:
        return F.filter(results, lambda r: r["lot_id"] == lot)

    def lot_winners(lot: Column) -> Column:
        lists = F.transform(of_lot("results", lot), lambda r: F.coalesce(r["winner_ids"], F.array().cast("array<string>")))
        return F.array_distinct(F.flatten(lists))

    def last_set(lot: Column, name: str) -> Column:
        filled = F.filter(of_lot("results", lot), lambda r: r["fa_max_value"].isNotNull())
        return F.try_element_at(filled, F.lit(-1))[name]

    won = F.size(F.filter("__mine", lambda t: F.array_contains(lot_winners(t["lot_id"]), t["tender_id"])))
    rows = ours.withColumns({"lots_won": won, "total_lots": F.size("lots")}).withColumn("t", F.explode("__mine"))
    lot, tender = F.col("t.lot_id"), F.col("t.tender_id")
    rows = rows.withColumns({
        "__lot": F.try_element_at(F.filter("lots", lambda x: x["lot_id"] == lot), F.lit(-1)),
        "__lot_winners": lot_winners(lot),
        "__contracts": F.filter("contracts", lambda c: F.array_contains(c["tender_ids"], tender)),
        "num_tenders_on_lot": F.size(F.filter("tenders", lambda x: x["lot_id"] == lot)),
        "fa_max_value": last_set(lot, "fa_max_value"),
        "fa_max_currency": F.coalesce(last_set(lot, "fa_max_currency"), F.lit("")),
    }).withColumn("winners_on_lot", F.size("__lot_winners"))
    marked = F.exists("__contracts", lambda c: c["is_framework"])
    framework = framework_flag(marked, F.col("fa_max_value"), F.col("winners_on_lot"), F.col("num_tenders_on_lot"))
    start, end = F.coalesce("__lot.start_date", F.lit("")), F.coalesce("__lot.end_date", F.lit(""))
    return rows.select(
        *base, lot.alias("lot_id"), tender.alias("tender_id"), F.coalesce("__lot.lot_title", F.lit("")).alias("lot_title"),
        "t.tender_value", "t.currency",
        F.when(F.array_contains("__lot_winners", tender), "Won").otherwise("Lost").alias("result"),
        F.when(framework, "Yes").otherwise("No").alias("is_framework"), "winners_on_lot",
        F.coalesce(F.try_element_at("__contracts", F.lit(-1))["contract_title"], F.lit("")).alias("contract_title"),
        "num_tenders_on_lot", "fa_max_value", "fa_max_currency", start.alias("start_date"), end.alias("end_date"),
        duration_years(start, end).alias("duration_years"), "total_lots", "lots_won",
    )
