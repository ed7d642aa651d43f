"""Documents, files and round trips through the writers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import functions as F

from ..functions import values as V
from ..operators import labels
from ..operators.stage import shared_folder
from .. import tables
from ..plans import jobs
from ..sources import api_json, files, runs, sinks, statements, tables as table_files
from .base import sql, table, transactions
from .dataset import API, DEDUP, FOLD, LABEL, api, records, rsql
from .learning import DICT, dictionary
from .registry import query
from .shaping import day_text, money_text, seq

DOC = 40  # rows per derived document
STATEMENT = 4000  # rows per derived statement file: files are created, moved and listed one by one


def scratch(spark) -> str:
    """A new folder for one round trip, below the shared folder. Only a local master, whose
    executors are the driver, may do without one."""
    shared = shared_folder(spark)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="ledgerloom-")
    return f"{shared.rstrip('/')}/ledgerloom/{uuid.uuid4().hex}"


# -- provider statements -------------------------------------------------------------------

def provider_rows(spark, sf):
    """Rows as a provider exports them, with bad numbers and flags."""
    return transactions(spark, sf).select(
        F.lit("savings").alias("accountType"), F.lit("").alias("accountHolder"), F.lit("x, \"y\"").alias("accountName"),
        F.lit("012345").alias("bsb"), F.col("tx_id").alias("accountNumber"), day_text().alias("date"), "description",
        F.when(seq() % 10 == 0, "").when(seq() % 10 == 1, "bad").otherwise(money_text()).alias("amount"),
        F.when(seq() % 10 == 2, "").otherwise("10.5").alias("Balance"), F.col("provider_category").alias("Category"),
        F.lit("").alias("thirdParty"), F.lit("").alias("transactionType"),
        F.when(seq() % 4 == 0, "Pending").otherwise("").alias("pending"), seq().alias("seq"))


CANON = """SELECT tx_id AS account_number, CASE WHEN seq % 10 < 2 THEN 0.0 ELSE cents / 100.0 END AS amount,
  CASE WHEN seq % 10 = 2 THEN 0.0 ELSE 10.5 END AS balance, coalesce(provider_category, '') AS category,
  seq % 4 = 0 AS pending, strftime(tx_date, '%Y-%m-%d') AS date, description FROM tx"""


def shown(df):
    return df.select("account_number", F.col("amount").cast("double").alias("amount"), F.col("balance").cast("double").alias("balance"),
                     "category", "pending", "date", "description")


@query("src1_statement_csv", sql(CANON.replace("10.5 END", "CAST(10.5 AS DOUBLE) END")))
def src1(spark, sf):
    path = scratch(spark) + "/statements"
    sinks.write_csv(provider_rows(spark, sf).drop("seq"), path)
    return shown(statements.read_statement_csv(spark, path))


def json_documents(spark, sf, wrapped=True, per_document=DOC):
    """Some dozen rows per document, as an array or wrapped."""
    rows = provider_rows(spark, sf).withColumn("category_key", F.col("Category"))
    item = F.struct("accountType", "accountNumber", "date", "description", "amount", F.col("Balance").alias("balance"),
                    F.when(seq() % 2 == 0, F.col("Category")).alias("category"),
                    F.when(seq() % 2 == 1, F.col("category_key")).alias("Category_"), (seq() % 4 == 0).alias("pending"))
    docs = rows.groupBy(F.floor(seq() / per_document).alias("doc_id")).agg(F.collect_list(item).alias("items"))
    text = F.when(F.col("doc_id") % 2 == 0, F.to_json("items")).otherwise(
        F.to_json(F.struct(F.col("items").alias("transactions"))))
    return docs.select("doc_id", F.regexp_replace(text, '"Category_"', '"Category"').alias("value"))


@query("src2_statement_json", sql(CANON.replace("10.5 END", "CAST(10.5 AS DOUBLE) END")))
def src2(spark, sf):
    return shown(statements.statement_json_rows(json_documents(spark, sf)))


@query("src3_statement_folder", sql("""SELECT count(*) AS n, count(DISTINCT account_number) AS accounts, CAST(sum(CAST(round(amount * 100) AS BIGINT)) AS BIGINT)
  AS cents, 1 AS rejected FROM (""" + CANON + " UNION ALL " + CANON + ")"))
def src3(spark, sf):
    root = scratch(spark)
    sinks.write_csv(provider_rows(spark, sf).drop("seq"), root + "/a")
    docs = json_documents(spark, sf, per_document=STATEMENT)
    # The text writer gives one file per partition folder, that is one document per file; one more is
    # broken, and one more CSV file has other columns and no rows.
    docs.unionByName(spark.createDataFrame([(-1, '{"transactions": [')], "doc_id bigint, value string")).write.partitionBy("doc_id").text(root + "/text")
    sinks.write_csv(spark.createDataFrame([("x", "y")], "other string, description string").filter("false"), root + "/b")
    json = statements.read_statements(spark, root + "/text", "json")
    both = statements.read_statements(spark, root + "/[ab]", "auto").unionByName(json, allowMissingColumns=True)
    lost = api_json.rejected_documents(api_json.read_documents(spark, root + "/text", recursiveFileLookup=True))
    return both.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("account_number").alias("accounts"),
                    F.sum(V.cents(F.col("amount"))).alias("cents")).withColumn("rejected", lost.agg(F.count(F.lit(1)).cast("int").alias("n")).scalar())


@query("src7_categorised_csv", sql("""SELECT CAST(customer_id AS VARCHAR) AS customer_id, strftime(tx_date, '%Y-%m-%d') AS tx_date, description, cents, code
  FROM tx WHERE seq % 10 <> 0"""))
def src7(spark, sf):
    return categorised_round_trip(spark, sf)[0].select(
        "customer_id", F.date_format("tx_date", "yyyy-MM-dd").alias("tx_date"), "description", "cents", "code")


@query("src8_rejected_rows", sql("SELECT CAST(customer_id AS VARCHAR) AS customer_id, count(*) AS n FROM tx WHERE seq % 10 = 0 GROUP BY 1"))
def src8(spark, sf):
    return categorised_round_trip(spark, sf)[1].groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"))


def categorised_round_trip(spark, sf):
    path = scratch(spark) + "/categorised"
    rows = transactions(spark, sf).select(
        "customer_id", F.date_format("tx_date", "dd/MM/yyyy").alias("date"), "description",
        F.when(seq() % 10 == 0, "n/a").otherwise(money_text()).alias("amount"), F.col("code").alias("category_code"))
    sinks.write_csv(rows, path)
    return statements.read_categorised(spark, path, glob="*.csv")


# -- API documents ---------------------------------------------------------------------------

def api_documents(spark, sf):
    item = F.struct(F.col("tx_id").alias("id"), "amount", "direction", "description",
                    F.col("transaction_date").alias("transactionDate"), F.col("post_date").alias("postDate"),
                    F.struct(F.lit("411").alias("code"), F.lit("x").alias("title")).alias("subClass"))
    docs = api(spark, sf).groupBy("run_id", "path", F.floor(F.col("pos") / DOC).alias("doc")).agg(F.collect_list(item).alias("l"))
    n = F.col("doc") % 3
    text = F.when(n == 0, F.to_json(F.struct(F.col("l").alias("data")))).when(
        n == 1, F.to_json(F.struct(F.col("l").alias("transactions")))).otherwise(F.to_json("l"))
    return docs.select("run_id", "path", text.alias("value"))


@query("src9_api_transactions", sql("""SELECT run_id, tx_id, path, amount, direction, description, transaction_date, post_date,
  '411' AS subclass_code FROM api""", API))
def src9(spark, sf):
    return api_json.api_transactions(api_documents(spark, sf)).select(
        "run_id", "tx_id", "path", "amount", "direction", "description", "transaction_date", "post_date", "subclass_code")


def report_documents(spark, sf):
    """Reports with a group per code; odd rows sit in a subgroup."""
    item = F.struct(F.col("tx_id").alias("id"), "description", "amount", "date")
    rec = records(spark, sf).withColumn("doc", F.floor(F.col("pos") / 400))
    odd = F.col("pos") % 4 == 1
    per_code = rec.groupBy("run_id", "report_path", "doc", "code").agg(
        F.collect_list(F.when(~odd, item)).alias("top"), F.collect_list(F.when(odd, item)).alias("sub"),
        F.sum(F.col("amount").cast("decimal(18,2)")).cast("string").alias("total"))
    group = F.struct(F.col("code").alias("id"), F.struct(F.struct("total").alias("amount")).alias("analysis"),
                     F.col("top").alias("transactions"), F.array(F.struct(F.col("sub").alias("transactions"))).alias("subgroup"))
    docs = per_code.groupBy("run_id", "report_path", "doc").agg(F.collect_list(group).alias("groups"))
    return docs.select("run_id", "report_path", F.to_json(F.struct(F.struct("groups").alias("data"))).alias("value"))


@query("src10_report_records", sql("SELECT run_id, report_path, tx_id, description, amount, date, code FROM rec", API))
def src10(spark, sf):
    return api_json.report_records(report_documents(spark, sf)).select(
        "run_id", "report_path", "tx_id", "description", "amount", "date", "code")


@query("agg15_report_totals", sql("""SELECT run_id, report_path, code, CAST(sum(CAST(round(CAST(amount AS DOUBLE) * 100) AS BIGINT)) AS BIGINT) / 100.0
  AS report_total FROM rec GROUP BY 1, 2, 3""", API))
def agg15_reports(spark, sf):
    return labels.report_totals(api_json.report_totals_raw(report_documents(spark, sf))).withColumn(
        "report_total", F.col("report_total").cast("double"))


def written_documents(spark, sf):
    """Transaction documents and reports as files, one each, and their run index: (root, index)."""
    root = scratch(spark)
    item = F.struct(F.col("tx_id").alias("id"), "amount", "direction", "description", F.col("transaction_date").alias("transactionDate"), F.col("post_date").alias("postDate"))
    tx = api(spark, sf).groupBy("run_id", "path").agg(F.to_json(F.struct(F.sort_array(F.collect_list(F.struct("pos", item.alias("i")))).getField("i").alias("data"))).alias("value"))
    one = F.struct(F.col("code").alias("id"), F.struct(F.struct(F.col("amount").alias("total")).alias("amount")).alias("analysis"),
                   F.array(F.struct(F.col("tx_id").alias("id"), "description", "amount", "date")).alias("transactions"))
    reports = records(spark, sf).groupBy("run_id", F.lpad(F.col("report_seq").cast("string"), 6, "0").alias("path")).agg(
        F.to_json(F.struct(F.struct(F.sort_array(F.collect_list(F.struct("pos", one.alias("g")))).getField("g").alias("groups")).alias("data"))).alias("value"))
    rows = tx.withColumns({"kind": F.lit("tx"), "path": F.element_at(F.split("path", "/"), -1)}).unionByName(reports.withColumn("kind", F.lit("report")))
    # The text writer gives one file per partition folder: a folder is a document.
    rows.select("value", F.replace("run_id", F.lit("/"), F.lit(".")).alias("run"), "kind", F.col("path").alias("doc")).write.partitionBy("run", "kind", "doc").text(root + "/docs")
    at = F.split("relative_path", "/")
    listed = files.list_files(spark, root + "/docs", ["*.txt"]).select(
        F.replace(F.split_part(F.get(at, F.lit(0)), F.lit("="), F.lit(2)), F.lit("."), F.lit("/")).alias("run_id"), (F.get(at, F.lit(1)) == "kind=tx").alias("tx"), "relative_path")
    index = listed.groupBy("run_id").agg(F.collect_list(F.when(F.col("tx"), F.col("relative_path"))).alias("tx_files"),
                                         F.collect_list(F.when(~F.col("tx"), F.col("relative_path"))).alias("affordability_files"))
    sinks.write_json(index.withColumn("has_affordability_report", F.size("affordability_files") > 0), root + "/index")
    return root + "/docs", api_json.read_run_index(spark, root + "/index")


@query("dst4_from_files", rsql("""SELECT run_id, tx_id, direction, amount, description, label_source, label_group_code,
  CASE WHEN report_path = '' THEN '' ELSE lpad(regexp_extract(report_path, 'report_([0-9]+)', 1), 6, '0') END AS report FROM done""", API, DEDUP, FOLD, LABEL))
def dst4_files(spark, sf):
    """Raw files and a run index to the dataset."""
    root, index = written_documents(spark, sf)
    asked = spark.createDataFrame(list(labels.DEFAULTS.items()), "kind string, code string")
    out = jobs.dataset_from_files(spark, root, index, tables.taxonomy(spark), asked, "*.txt")["dataset"]
    return out.select("run_id", "tx_id", "direction", F.col("amount").cast("double").alias("amount"), "description", "label_source", "label_group_code",
                      F.regexp_extract("report_path", "doc=([0-9]+)", 1).alias("report"))


@query("src10_run_totals", sql("""SELECT run_id, lpad(CAST(report_seq AS VARCHAR), 6, '0') AS report, code,
  CAST(sum(CAST(round(CAST(amount AS DOUBLE) * 100) AS BIGINT)) AS BIGINT) / 100.0 AS report_total FROM rec GROUP BY 1, 2, 3""", API))
def src10_totals(spark, sf):
    root, index = written_documents(spark, sf)
    out = labels.report_totals(runs.report_groups(runs.run_documents(spark, root, index, "*.txt")))
    return out.select("run_id", F.regexp_extract("report_path", "doc=([0-9]+)", 1).alias("report"), "code", F.col("report_total").cast("double").alias("report_total"))


@query("src15_persona", sql("""SELECT customer_id, CASE customer_id % 4 WHEN 0 THEN 'Full ' || customer_id WHEN 1 THEN 'First' WHEN 2 THEN 'A B' END AS persona
  FROM (SELECT DISTINCT customer_id FROM tx)"""))
def src15(spark, sf):
    from .base import users

    u = F.col("user_id")
    full = F.struct(F.struct(F.concat(F.lit("Full "), u).alias("fullName")).alias("profile"))
    first = F.struct(F.struct(F.struct(F.lit("First").alias("firstName")).alias("profile")).alias("data"))
    both = F.struct(F.struct(F.lit("A").alias("firstName"), F.lit("B").alias("lastName")).alias("profile"))
    doc = (F.when(u % 4 == 0, F.to_json(full)).when(u % 4 == 1, F.to_json(first)).when(u % 4 == 2, F.to_json(both)).otherwise("broken"))
    return users(spark, sf).select(u.alias("customer_id"), api_json.persona_name(doc).alias("persona"))


# -- files ---------------------------------------------------------------------------------------

FILES = """fl AS (SELECT CASE WHEN e % 50 = 49 THEN 'loose_' || e || '.txt' ELSE 'org' || (e % 3) || '/run' || (user_id % 40) || '/' || CASE e % 8
    WHEN 0 THEN 'StatementCapture/retrieve-transactions_' || d || '_' || e || '.json' WHEN 1 THEN 'StatementCapture/retrieve-accounts_' || d || '_' || e || '.json'
    WHEN 2 THEN 'StatementCapture/verify-credentials_' || d || '_' || e || '.json' WHEN 3 THEN 'AffordabilityReports/r' || e || '.json'
    WHEN 4 THEN 'CreditAssessment/c' || e || '.pdf' WHEN 5 THEN 'LoanAgreement/l' || e || '.pdf' WHEN 6 THEN 'StatementCapture/zz' || e || '.json'
    ELSE 'Misc/m' || e || '.bin' END END AS relative_path, e AS size_bytes, DATE '2025-03-01' + CAST(e % 90 AS INTEGER) AS modified, d, e
  FROM (SELECT event_id AS e, user_id, strftime(DATE '2024-02-01' + CAST(event_id % 300 AS INTEGER), '%Y%m%d') AS d FROM events)),
  ty AS (SELECT *, split_part(relative_path, '/', 1) || '/' || split_part(relative_path, '/', 2) AS run_id, CASE e % 8 WHEN 0 THEN 'StatementCapture/retrieve-transactions'
    WHEN 1 THEN 'StatementCapture/retrieve-accounts' WHEN 2 THEN 'StatementCapture/verify-credentials' WHEN 3 THEN 'AffordabilityReports' WHEN 4 THEN 'CreditAssessment'
    WHEN 5 THEN 'LoanAgreement' WHEN 6 THEN 'StatementCapture/other' ELSE 'Misc' END AS artifact_type,
    CASE WHEN e % 8 < 3 THEN strptime(d, '%Y%m%d') ELSE CAST(modified AS TIMESTAMP) END AS created FROM fl WHERE e % 50 <> 49)"""


def file_list(spark, sf):
    e = F.col("event_id")
    d = F.date_format(F.date_add(F.lit("2024-02-01").cast("date"), (e % 300).cast("int")), "yyyyMMdd")
    kinds = ["StatementCapture/retrieve-transactions_", "StatementCapture/retrieve-accounts_", "StatementCapture/verify-credentials_"]
    name = F.when(e % 8 == 7, F.concat(F.lit("Misc/m"), e, F.lit(".bin")))
    for i, k in enumerate(kinds):
        name = name.when(e % 8 == i, F.concat(F.lit(k), d, F.lit("_"), e, F.lit(".json")))
    for i, (k, ext) in enumerate([("AffordabilityReports/r", ".json"), ("CreditAssessment/c", ".pdf"), ("LoanAgreement/l", ".pdf"),
                                  ("StatementCapture/zz", ".json")]):
        name = name.when(e % 8 == i + 3, F.concat(F.lit(k), e, F.lit(ext)))
    path = F.when(e % 50 == 49, F.concat(F.lit("loose_"), e, F.lit(".txt"))).otherwise(F.concat(
        F.lit("org"), e % 3, F.lit("/run"), F.col("user_id") % 40, F.lit("/"), name))
    return table(spark, sf, "events").select(
        path.alias("relative_path"), e.alias("size_bytes"),
        F.date_add(F.lit("2025-03-01").cast("date"), (e % 90).cast("int")).cast("timestamp").alias("modified_at"))


def names(spark, sf):
    doc = F.concat(F.lit('{"profile": {"fullName": "P'), F.length("run_id"), F.lit('"}}'))
    docs = files.classify_files(file_list(spark, sf)).filter(F.col("artifact_type").endswith("verify-credentials"))
    return files.personas(docs.withColumn("value", F.when(F.col("size_bytes") % 3 == 1, doc)))


FACTS = """facts AS (SELECT run_id, count(*) AS files, count(*) FILTER (e % 8 = 0) AS tx_files, count(*) FILTER (e % 8 = 1) AS account_files,
  count(*) FILTER (e % 8 = 2) AS verify_files, count(*) FILTER (e % 8 = 3) AS affordability_files, count(*) FILTER (e % 8 = 4) AS credit_assessment_files,
  count(*) FILTER (e % 8 = 5) AS loan_agreement_files, count(*) FILTER (e % 8 > 5) AS other_files, strftime(min(created), '%Y-%m-%d') AS run_created_at,
  count(*) FILTER (e % 8 = 3) > 0 AS has_affordability_report,
  CASE WHEN count(*) FILTER (e % 8 = 2 AND e % 3 = 1) > 0 THEN 'P' || length(run_id) END AS persona FROM ty GROUP BY 1)"""


@query("str16_artefact_type", sql("SELECT relative_path, run_id, artifact_type FROM ty", FILES))
def str16(spark, sf):
    return files.classify_files(file_list(spark, sf)).select("relative_path", "run_id", "artifact_type")


@query("str15_file_time", sql("SELECT relative_path, strftime(created, '%Y-%m-%d %H:%M:%S') AS created_at FROM ty", FILES))
def str15(spark, sf):
    return files.classify_files(file_list(spark, sf)).select(
        "relative_path", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created_at"))


@query("flt6_path_globs", sql("""SELECT relative_path FROM fl WHERE split_part(relative_path, '/', -1) LIKE '%.pdf'
  OR (starts_with(relative_path, 'org1/') AND contains(relative_path, '/StatementCapture/') AND relative_path LIKE '%.json')""", FILES))
def flt6(spark, sf):
    return file_list(spark, sf).filter(V.path_included(
        F.col("relative_path"), ["*.pdf", "org1/*/StatementCapture/*.json"])).select("relative_path")


@query("agg17_run_facts", sql("SELECT * FROM facts", FILES, FACTS))
def agg17(spark, sf):
    return files.run_facts(file_list(spark, sf), names(spark, sf)).withColumn("run_created_at", F.date_format("run_created_at", "yyyy-MM-dd"))


@query("agg17_run_index", sql("""SELECT run_id, CAST(CAST(sum(part) AS BIGINT) AS VARCHAR) AS tx_files, CAST(any_value(files) AS BIGINT) AS files FROM
  (SELECT run_id, count(*) FILTER (e % 8 = 0) AS part, count(*) AS files FROM ty GROUP BY 1) GROUP BY 1""", FILES))
def agg17_index(spark, sf):
    index = files.run_index(file_list(spark, sf), per_record=20)
    total = F.aggregate(F.map_values("paths"), F.lit(0), lambda a, x: a + F.size(x))
    return index.groupBy("run_id").agg(F.sum(F.size("tx_files")).cast("string").alias("tx_files"), F.sum(total).alias("files"))


@query("agg18_index_summary", sql("""SELECT count(*) AS run_count, count(*) FILTER (has_affordability_report) AS runs_with_affordability,
  count(*) FILTER (tx_files > 0) AS runs_with_transactions, count(*) FILTER (tx_files = 0) AS runs_missing_transactions,
  count(persona) AS persona_available FROM facts""", FILES, FACTS))
def agg18(spark, sf):
    return files.index_summary(files.run_facts(file_list(spark, sf), names(spark, sf)))


@query("agg18_artefact_counts", sql("SELECT artifact_type, count(*) AS n FROM ty GROUP BY 1", FILES))
def agg18_types(spark, sf):
    return files.artefact_counts(file_list(spark, sf))


QUALITY = """q AS (SELECT *, CAST(40 * (tx_files > 0)::INT + 40 * (affordability_files > 0)::INT + 10 * (verify_files > 0)::INT + 5 * (account_files > 0)::INT
  + 5 * (credit_assessment_files > 0)::INT AS INTEGER) AS completeness, tx_files * 500 AS estimated_transactions FROM facts)"""


def quality(spark, sf):
    return files.run_quality(files.run_facts(file_list(spark, sf), names(spark, sf)))


@query("agg19_run_quality", sql("SELECT run_id, completeness, estimated_transactions FROM q", FILES, FACTS, QUALITY))
def agg19(spark, sf):
    return quality(spark, sf).select("run_id", "completeness", "estimated_transactions")


@query("agg20_persona_summary", sql("""SELECT coalesce(persona, 'unknown') AS persona, count(*) AS run_count, CAST(sum(estimated_transactions) AS BIGINT) AS estimated_transactions,
  round(sum(completeness) / count(*) / 100, 3) AS avg_completeness, count(*) FILTER (has_affordability_report) AS runs_with_affordability,
  min(run_created_at) AS first_run, any_value(best) AS best FROM q JOIN (SELECT coalesce(persona, 'unknown') AS p, string_agg(run_id, ',' ORDER BY rn) AS best FROM
   (SELECT *, row_number() OVER (PARTITION BY persona ORDER BY completeness DESC, estimated_transactions DESC, run_id) AS rn FROM q) WHERE rn <= 5 GROUP BY 1)
  ON p = coalesce(persona, 'unknown') GROUP BY 1""", FILES, FACTS, QUALITY))
def agg20(spark, sf):
    out = files.persona_summary(quality(spark, sf))
    return out.select("persona", "run_count", "estimated_transactions", "avg_completeness", "runs_with_affordability",
                      F.date_format("first_run", "yyyy-MM-dd").alias("first_run"), F.array_join("best_runs.run_id", ",").alias("best"))


@query("top3_best_runs", sql("""SELECT persona, run_id, rank FROM (SELECT *, row_number() OVER (PARTITION BY persona ORDER BY completeness DESC,
  estimated_transactions DESC, run_id) AS rank FROM q) WHERE rank <= 5""", FILES, FACTS, QUALITY))
def top3(spark, sf):
    return files.best_runs(quality(spark, sf)).select("persona", "run_id", "rank")


@query("src13_file_inventory")
def src13(spark, sf):
    """Inventory of the table files themselves."""
    return files.list_files(spark, sf, ["*.parquet"]).select("relative_path", "size_bytes")


@query("src14_manifest")
def src14(spark, sf):
    return files.manifest(spark, sf, include_hash=True)


@query("snk3_run_index_files", sql("""SELECT run_id, tx_files, other_files, coalesce(persona, '') AS persona, has_affordability_report FROM facts""", FILES, FACTS))
def snk3(spark, sf):
    """SNK3 and SRC11: the index written as JSON lines and read again."""
    root = scratch(spark)
    sinks.write_run_index(file_list(spark, sf), root, names(spark, sf))
    return api_json.read_run_index(spark, root + "/runs").groupBy("run_id", "persona", "has_affordability_report").agg(
        F.sum(F.size("tx_files")).alias("tx_files"), F.sum(F.size("other_files")).alias("other_files")).withColumn(
            "persona", F.coalesce("persona", F.lit("")))


@query("snk1_snk2_writers", sql("SELECT tx_id, description, cents, code FROM tx"))
def snk12(spark, sf):
    """Half through CSV, half through JSON, and back."""
    root, tx = scratch(spark), transactions(spark, sf).select("tx_id", "description", "cents", "code")
    sinks.write_csv(tx.filter("cents > 0"), root + "/csv")
    sinks.write_json(tx.filter("cents <= 0"), root + "/json")
    schema = "tx_id string, description string, cents bigint, code string"
    return (spark.read.schema(schema).options(header=True, escape='"').csv(root + "/csv")
            .unionByName(spark.read.schema(schema).json(root + "/json")))


@query("lrn11_snapshots", sql("SELECT pattern, category, CAST(confidence AS DOUBLE) AS confidence FROM d1", *DICT))
def lrn11(spark, sf):
    """Two snapshots; the newest one is read."""
    root = scratch(spark) + "/dictionary"
    empty = table_files.read_patterns(spark, root)
    table_files.write_patterns(empty, root)
    table_files.write_patterns(dictionary(spark, sf), root)
    return table_files.read_patterns(spark, root).select("pattern", "category", "confidence")
