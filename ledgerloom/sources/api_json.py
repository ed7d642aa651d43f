"""API transaction and report documents (SRC9-SRC11, SRC15, PRJ3, PRJ4).

Readers take whole documents as text, one row each; a document fits one task, a folder of
them is spread over all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.stage import computed

TX = ("id: string, amount: string, direction: string, description: string, transactionDate: string, "
      "postDate: string, subClass: string, enrich: string")
ITEM = "id: string, description: string, amount: string, date: string"
GROUP = (f"id: string, analysis: struct<amount: struct<total: string>>, transactions: array<struct<{ITEM}>>, "
         f"subgroup: array<struct<transactions: array<struct<{ITEM}>>>>")


def read_documents(spark: SparkSession, path, **options) -> DataFrame:
    """Text documents with their path."""
    return (spark.read.options(**options).text(path, wholetext=True)
            .select("value", F.col("_metadata.file_path").alias("path")))


def rejected_documents(docs: DataFrame, value: str = "value") -> DataFrame:
    """Documents whose text is not JSON, without the text, with a reason; the row readers skip
    them, so a caller that must not lose any writes these beside the rows."""
    doc = F.trim(F.coalesce(value, F.lit("")))
    keep = [c for c in docs.columns if c != value]
    return docs.filter((doc == "") | F.try_parse_json(doc).isNull()).select(*keep, F.lit("malformed document").alias("reason"))


def _filled(*options: Column) -> Column:
    return F.coalesce(*[F.nullif(o, F.lit("")) for o in options], F.lit(""))


def transaction_items(docs: DataFrame, value: str = "value") -> DataFrame:
    """SRC9: one row per transaction; the list is under data, under transactions, or bare."""
    doc = F.trim(F.col(value))
    bare = doc.startswith("[")
    keep = [c for c in docs.columns if c != value]
    # Parsed once: an expression that names it again, and the filter made for a generator, parse again.
    parsed = computed(docs, {"_bare": F.when(bare, F.from_json(doc, f"array<struct<{TX}>>")), "_doc": F.when(
        ~bare, F.from_json(doc, f"struct<data: array<struct<{TX}>>, transactions: array<struct<{TX}>>>"))}).drop(value)
    first = F.when(F.size("_doc.data") > 0, F.col("_doc.data")).otherwise(F.col("_doc.transactions"))
    return parsed.select(*keep, F.posexplode(F.coalesce("_bare", first)).alias("pos", "tx")).select(*keep, "pos", "tx.*")


def enrichment(enrich: Column, sub_class: Column) -> dict[str, Column]:
    """PRJ3/PRJ4: merchant, clean text, industry group and subclass, with alternate names."""
    def at(c, path):
        return F.get_json_object(c, path)

    group = at(enrich, "$.anzsic.group")
    is_struct = group.isNull() | group.startswith("{")
    return {
        "clean_description": _filled(at(enrich, "$.cleanDescription"), at(enrich, "$.clean_description"), at(enrich, "$.clean")),
        "merchant_name": _filled(at(enrich, "$.merchant.name")),
        "anzsic_group_code": F.when(is_struct, _filled(at(enrich, "$.anzsic.group.code"))).otherwise(_filled(at(enrich, "$.anzsic.groupCode"))),
        "anzsic_group_title": F.when(is_struct, _filled(at(enrich, "$.anzsic.group.title"))).otherwise(_filled(at(enrich, "$.anzsic.groupTitle"))),
        "subclass_code": _filled(at(sub_class, "$.code")), "subclass_title": _filled(at(sub_class, "$.title"))}


def api_transactions(docs: DataFrame, value: str = "value") -> DataFrame:
    """SRC9 + PRJ3: rows in the shape ``labels.label_transactions`` reads. Needs run_id and path."""
    rows = transaction_items(docs, value)
    text = {"tx_id": "id", "amount": "amount", "direction": "direction", "description": "description",
            "transaction_date": "transactionDate", "post_date": "postDate"}
    return rows.select("run_id", "path", "pos",
                       *[F.coalesce(F.col(f), F.lit("")).alias(n) for n, f in text.items()],
                       *[c.alias(n) for n, c in enrichment(F.col("enrich"), F.col("subClass")).items()])


def report_groups(docs: DataFrame, value: str = "value") -> DataFrame:
    """SRC10: one row per group of a report."""
    keep = [c for c in docs.columns if c != value]
    parsed = computed(docs, {"_doc": F.from_json(F.col(value), f"struct<data: struct<groups: array<struct<{GROUP}>>>>")}).drop(value)
    return parsed.select(*keep, F.posexplode("_doc.data.groups").alias("group_no", "g")).filter(
        F.coalesce("g.id", F.lit("")) != "")


def report_records(docs: DataFrame, value: str = "value") -> DataFrame:
    """SRC10: transactions of groups and subgroups in document order, with the group's code."""
    keep = [c for c in docs.columns if c != value]
    empty = F.array().cast(f"array<struct<{ITEM}>>")
    sub = F.flatten(F.transform(F.coalesce("g.subgroup", F.array().cast(
        f"array<struct<transactions: array<struct<{ITEM}>>>>")),
        lambda s: F.coalesce(s["transactions"], empty)))
    items = F.concat(F.coalesce("g.transactions", empty), sub)
    rows = report_groups(docs, value).select(*keep, "group_no", "g.id", F.posexplode(items).alias("n", "t"))
    return rows.select(*keep, (F.col("group_no").cast("bigint") * 1_000_000_000 + F.col("n")).alias("pos"),
                       F.col("t.id").alias("tx_id"), F.col("t.description").alias("description"),
                       F.col("t.amount").alias("amount"), F.col("t.date").alias("date"), F.col("id").alias("code"))


def report_totals_raw(docs: DataFrame, value: str = "value") -> DataFrame:
    """SRC10: the total each group states, as text."""
    keep = [c for c in docs.columns if c != value]
    return report_groups(docs, value).select(*keep, F.col("g.id").alias("code"),
                                             F.col("g.analysis.amount.total").alias("total"))


def persona_name(doc: Column) -> Column:
    """SRC15: full name, else first and last; the profile is on top or under data."""
    def field(name):
        return F.coalesce(F.get_json_object(doc, f"$.profile.{name}"), F.get_json_object(doc, f"$.data.profile.{name}"))

    both = F.trim(F.concat_ws(" ", F.nullif(field("firstName"), F.lit("")), F.nullif(field("lastName"), F.lit(""))))
    return F.coalesce(F.nullif(field("fullName"), F.lit("")), F.nullif(both, F.lit("")))


RUN_INDEX = ("run_id string, run_prefix string, part int, parts int, paths map<string, array<string>>, "
             "tx_files array<string>, account_files array<string>, verify_files array<string>, "
             "affordability_files array<string>, credit_assessment_files array<string>, "
             "loan_agreement_files array<string>, other_files array<string>, persona string, "
             "run_created_at string, has_affordability_report boolean")


def read_run_index(spark: SparkSession, path) -> DataFrame:
    """SRC11: run index, one record per run. A run that was written in parts is put together."""
    parts = spark.read.schema(RUN_INDEX).json(path)
    lists = [f.name for f in parts.schema if f.dataType.simpleString() == "array<string>"]
    once = [c for c in parts.columns if c not in (*lists, "run_id", "paths", "part", "parts")]
    types = F.array_distinct(F.flatten(F.transform("_maps", F.map_keys)))
    paths = F.map_from_entries(F.transform(types, lambda t: F.struct(t, F.array_sort(F.flatten(F.transform(
        "_maps", lambda m: F.coalesce(F.try_element_at(m, t), F.array().cast("array<string>"))))))))
    return (parts.groupBy("run_id").agg(*[F.array_sort(F.flatten(F.collect_list(c))).alias(c) for c in lists],
                                        *[F.first(c, ignorenulls=True).alias(c) for c in once], F.collect_list("paths").alias("_maps"))
            .withColumns({"paths": paths, "part": F.lit(0), "parts": F.lit(1)}).select(*parts.columns))
