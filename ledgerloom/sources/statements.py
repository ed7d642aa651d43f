"""Statement files (SRC1-SRC8): readers with explicit schemas and the row shaping they share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.values import iso_date, iso_timestamp, money, parse_amount
from ..operators.stage import written

PROVIDER_FIELDS = ["accountType", "accountHolder", "accountName", "bsb", "accountNumber", "date",
                   "description", "amount", "Balance", "Category", "thirdParty", "transactionType", "pending"]

JSON_ROW = ", ".join(f"{f}: string" for f in (
    "accountType", "accountHolder", "accountName", "bsb", "accountNumber", "date", "description",
    "amount", "balance", "thirdParty", "transactionType", "pending"))


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def _number(c: Column) -> Column:
    """Blank or invalid numbers are zero."""
    return F.coalesce(money(c), F.lit(0).cast("decimal(18,2)"))


def canonical_rows(raw: DataFrame, balance: str = "Balance", category: Column | None = None,
                   pending: Column | None = None) -> DataFrame:
    """SRC1/SRC2: canonical statement rows from text columns of the provider's names."""
    category = _text(F.col("Category")) if category is None else category
    pending = F.lower(_text(F.col("pending"))) == "pending" if pending is None else pending
    names = {"account_type": "accountType", "account_holder": "accountHolder", "account_name": "accountName",
             "bsb": "bsb", "account_number": "accountNumber", "date": "date", "description": "description",
             "third_party": "thirdParty", "transaction_type": "transactionType"}
    extra = [c for c in raw.columns if c in ("customer_id", "doc_id", "source_file", "pos")]
    return raw.select(*extra, *[_text(F.col(f)).alias(n) for n, f in names.items()],
                      _number(F.col("amount")).alias("amount"), _number(F.col(balance)).alias("balance"),
                      category.alias("category"), pending.alias("pending"))


# A separator no statement holds: lines are read whole, less each file's header.
LINE = {"header": True, "sep": "\uffff", "quote": "", "enforceSchema": True}
BROADCAST_BYTES = 64 << 20


def csv_headers(spark: SparkSession, path, **options) -> DataFrame:
    """file and header: the first line with text of each file, as data. A path that does not exist is
    an error; a folder without files, and files without text, give no rows."""
    lines = spark.read.options(**options).text(path)
    first = lines.select(F.col("_metadata.file_path").alias("source_file"), "value", F.monotonically_increasing_id().alias("n"),
                         F.col("_metadata.file_block_start").alias("at")).filter((F.col("at") == 0) & (F.trim("value") != ""))
    return first.groupBy("source_file").agg(F.min_by("value", "n").alias("header"))


def csv_rows(spark: SparkSession, path, fields: list[str], keep: Column | None = None, **options) -> DataFrame:
    """The named text columns of CSV files, whatever columns each file has and in whatever order;
    and ``source_file`` and ``line``.

    Headers are data: every line is split by ``from_csv`` into as many texts as the widest header
    has, meets the header of its file by path, and gives the texts at the places where this
    header has the fields. So the plan is the same for one header or thousands, and paths stay in
    tables. A name is looked up as written, then in any case; of equal names the first counts. A
    field that a file lacks is null. ``keep`` (over ``source_file``) picks files.
    """
    chosen = F.lit(True) if keep is None else keep
    headers = written(csv_headers(spark, path, **options).filter(chosen))
    files, size, width = headers.agg(F.count(F.lit(1)), F.sum(F.length("source_file") + 8 * len(fields)), F.max(F.size(F.split("header", ",")))).first()
    columns = ", ".join(f"c{i} string" for i in range(width or 1))

    def split(line: str) -> Column:
        # The limit on columns is the parser's own guard; here the widest header sets it.
        parsed = F.from_csv(line, columns, {"escape": '"', "maxColumns": str(max(20_480, 2 * (width or 1)))})
        return F.array(*[parsed[f"c{i}"] for i in range(width or 1)])

    def place(name: str) -> Column:
        exact, any_case = F.array_position("names", F.lit(name)), F.array_position(F.transform("names", F.lower), F.lit(name.lower()))
        return F.when(exact > 0, exact).otherwise(any_case)

    known = headers.select("source_file", split("header").alias("names"))
    # Null names would hide the others from array_position.
    known = known.withColumn("names", F.transform("names", lambda n: F.coalesce(n, F.lit(""))))
    known = known.select("source_file", F.array(*[place(f) for f in fields]).alias("places"))
    if (size or 0) <= BROADCAST_BYTES:
        known = F.broadcast(known)
    lines = (spark.read.options(**LINE, **options).schema("line string").csv(path)
             .select("line", F.col("_metadata.file_path").alias("source_file")).filter(chosen))
    rows = lines.join(known, "source_file").withColumn("_t", split("line"))
    return rows.select("source_file", "line", *[F.when(F.col("places")[i] > 0, F.get("_t", (F.col("places")[i] - 1).cast("int"))).alias(f) for i, f in enumerate(fields)])


def read_statement_csv(spark: SparkSession, path, **options) -> DataFrame:
    """SRC1: provider CSV files."""
    return canonical_rows(csv_rows(spark, path, PROVIDER_FIELDS, **options))


def statement_json_rows(texts: DataFrame, value: str = "value") -> DataFrame:
    """SRC2: one row per transaction from JSON documents, an array or {"transactions": [...]}."""
    doc = F.trim(F.col(value))
    items = F.when(doc.startswith("["), F.from_json(doc, "array<string>")).otherwise(
        F.from_json(doc, "struct<transactions: array<string>>")["transactions"])
    keep = [c for c in texts.columns if c != value]
    rows = texts.select(*keep, F.posexplode(items).alias("pos", "_item"))
    rows = rows.withColumn("_t", F.from_json("_item", f"struct<{JSON_ROW}>")).select(
        *keep, "pos", "_t.*", "_item")
    category = F.coalesce(F.nullif(F.get_json_object("_item", "$.category"), F.lit("")),
                          F.get_json_object("_item", "$.Category"), F.lit(""))
    pending = F.lower(_text(F.col("pending"))).isin("pending", "true")
    return canonical_rows(rows, "balance", category, pending)


def read_statement_json(spark: SparkSession, path, **options) -> DataFrame:
    """SRC2: provider JSON files; one file is one document."""
    texts = (spark.read.options(**options).text(path, wholetext=True)
             .withColumn("source_file", F.col("_metadata.file_path")))
    return statement_json_rows(texts)


def read_statements(spark: SparkSession, path: str, format: str = "auto") -> DataFrame:
    """SRC3: a folder of statements; ``auto`` takes .json files as JSON and all others as CSV."""
    if format == "csv":
        return read_statement_csv(spark, path)
    if format == "json":
        return read_statement_json(spark, path)
    csv = canonical_rows(csv_rows(spark, path, PROVIDER_FIELDS, ~F.lower("source_file").endswith(".json"), recursiveFileLookup=True))
    json = read_statement_json(spark, path, pathGlobFilter="*.[jJ][sS][oO][nN]", recursiveFileLookup=True)
    return csv.unionByName(json, allowMissingColumns=True)


# fixed values: header names of card exports, best first
CARD_DESCRIPTION = ["Description", "description", "Transaction Details", "Merchant"]
CARD_AMOUNT = ["Amount", "amount", "Debit", "Credit"]
CARD_DATE = ["Date", "date", "Transaction Date"]


def first_filled(df: DataFrame, names: list[str], default: str | None) -> Column:
    """First non-empty of the columns that exist; names differ in case only at times."""
    options = [F.nullif(F.col(f"`{n}`"), F.lit("")) for n in names if n in df.columns]
    return F.coalesce(*options, F.lit(default))


def card_amount(c: Column) -> Column:
    """SRC4: $ and commas dropped, (x) is negative."""
    t = F.trim(F.regexp_replace(c, r"[$,]", ""))
    return parse_amount(F.regexp_replace(t, r"^\((.*)\)$", "-$1"))


def card_rows(raw: DataFrame) -> DataFrame:
    """SRC4: card statement rows from any of the known header names; bad amounts drop the row."""
    extra = [c for c in raw.columns if c in ("customer_id", "source_file", "tx_id")]
    return raw.select(
        *extra, first_filled(raw, CARD_DESCRIPTION, "").alias("description"),
        card_amount(first_filled(raw, CARD_AMOUNT, "0")).try_cast("decimal(18,2)").alias("amount"),
        first_filled(raw, CARD_DATE, "").alias("date")).filter(F.col("amount").isNotNull())


def read_card_csv(spark: SparkSession, path, **options) -> DataFrame:
    """SRC4: card CSV files of any banks, each with its own header."""
    # Names that differ in case only are one column here.
    names = list({n.lower(): n for n in [*CARD_DESCRIPTION, *CARD_AMOUNT, *CARD_DATE]}.values())
    return card_rows(csv_rows(spark, path, names, **options).drop("line"))


def provider_match_rows(raw: DataFrame) -> DataFrame:
    """SRC5: provider rows for matching; a bad amount or date skips the row."""
    extra = [c for c in raw.columns if c in ("customer_id", "tx_id", "seq")]
    return raw.select(
        *extra, _text(F.col("description")).alias("description"),
        parse_amount(F.regexp_replace(F.coalesce("amount", F.lit("0")), ",", "")).try_cast("decimal(18,2)").alias("amount"),
        iso_date(F.col("date")).alias("date"), _text(F.col("Category")).alias("provider_category"),
        _text(F.col("thirdParty")).alias("third_party"), _text(F.col("accountType")).alias("account_type"),
    ).filter(F.col("amount").isNotNull() & F.col("date").isNotNull())


def labelled_match_rows(raw: DataFrame) -> DataFrame:
    """SRC6: labelled rows with an ISO timestamp; empty or bad dates skip the row."""
    extra = [c for c in raw.columns if c in ("customer_id", "seq")]
    return raw.select(
        *extra, "transaction_id", _text(F.col("description")).alias("description"),
        parse_amount(F.coalesce("amount", F.lit("0"))).try_cast("decimal(18,2)").alias("amount"),
        iso_timestamp(F.nullif("transaction_date", F.lit(""))).alias("ts"),
        _text(F.col("label_group_code")).alias("code"), _text(F.col("label_source")).alias("label_source"),
    ).filter(F.col("amount").isNotNull() & F.col("ts").isNotNull())


CATEGORISED_FIELDS = ["customer_id", "date", "description", "amount", "balance", "provider_category",
                      "code", "category_code"]


def categorised_rows(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """SRC7/SRC8: (metric input, rejected rows). The customer defaults to the file name's stem."""
    from ..functions.values import cents, day_first_date

    stem = F.regexp_replace(F.element_at(F.split("source_file", "/"), -1), r"\.[^.]*$", "")
    amount = parse_amount(F.col("amount")).try_cast("decimal(18,2)")
    code = F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in ("code", "category_code") if c in raw.columns])
    customer = F.nullif(F.col("customer_id"), F.lit("")) if "customer_id" in raw.columns else F.lit(None)
    rows = raw.select(
        F.coalesce(customer, stem).alias("customer_id"),
        F.concat_ws(":", "source_file", "row_hash", "row_no").alias("tx_id"),
        day_first_date(F.col("date")).alias("tx_date"), F.col("description"),
        cents(amount).alias("cents"), code.alias("code"))
    return rows.filter(F.col("cents").isNotNull()), rows.filter(F.col("cents").isNull())


def read_categorised(spark: SparkSession, folder: str,
                     glob: str = "*categorized*.csv") -> tuple[DataFrame, DataFrame]:
    """SRC8: every customer's file of a folder in one read; bad rows come back apart.

    A row is named by its file, a hash of its line and its number among equal rows of the
    file, which are interchangeable: the name does not depend on blocks, packing or cluster.
    """
    raw = csv_rows(spark, folder, CATEGORISED_FIELDS, pathGlobFilter=glob).withColumn("row_hash", F.hex(F.xxhash64("line"))).drop("line")
    copy = W.partitionBy("source_file", "row_hash").orderBy(F.monotonically_increasing_id())
    return categorised_rows(raw.withColumn("row_no", F.row_number().over(copy)))
