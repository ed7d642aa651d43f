"""Text functions on the transaction descriptions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import text as T
from .base import literal, sql, transactions
from .registry import query


def on_text(name, fn):
    def run(spark, sf):
        return transactions(spark, sf).select("tx_id", fn(F.col("description")).alias(name))

    return run


def words(items):
    return "|".join(items)


def q(pattern):
    return literal(pattern)


def prefix_sql(c):
    """Strip one leading phrase per step, in list order, until none is left."""
    return f"regexp_replace({c}, {q('^((' + words(K.LEADING_PHRASES) + ') *)+')}, '')"


def refs_sql(c):
    for p in (r"\b\d{5,}\b", r"\{\d+\}", r"ref\s*\d+", r"reference\s*\d+"):
        c = f"regexp_replace({c}, {q(p)}, '', 'gi')"
    return c


def places_sql(c):
    places = "[" + ", ".join(q(w) for w in K.PLACE_WORDS) + "]"
    return (f"array_to_string([w for w in string_split(regexp_replace(trim({c}), '\\s+', ' ', 'g'), ' ') "
            f"if NOT list_contains({places}, w)], ' ')")


def suffix_sql(c):
    return f"regexp_replace({c}, {q('( *(' + words(K.TRAILING_PHRASES) + '))+$')}, '')"


def squeeze_sql(c):
    return f"trim(regexp_replace({c}, '\\s+', ' ', 'g'))"


def short_sql(c):
    known = " ".join(f"WHEN starts_with({c}, {q(n)}) THEN {q(n)}" for n in K.KNOWN_NAMES)
    return (f"CASE WHEN length({c}) - length(replace({c}, ' ', '')) < 2 THEN {c} {known} "
            f"ELSE split_part({c}, ' ', 1) || ' ' || split_part({c}, ' ', 2) END")


LOW = "trim(lower(description))"
CLEAN = [f"p1 AS (SELECT *, trim({prefix_sql(LOW)}) AS a FROM tx)",
         f"p2 AS (SELECT *, {places_sql(refs_sql('a'))} AS b FROM p1)",
         f"p3 AS (SELECT *, {squeeze_sql(suffix_sql('''regexp_replace(b, '[^a-z0-9 ]', ' ', 'g')'''))} AS c FROM p2)",
         f"pat AS (SELECT * EXCLUDE (a, b, c), {short_sql('c')} AS pattern FROM p3)"]

query("str1_merchant_pattern", sql("SELECT tx_id, pattern FROM pat", *CLEAN))(
    on_text("pattern", T.merchant_pattern))
query("str2_leading_phrases", sql(f"SELECT tx_id, trim({prefix_sql(LOW)}) AS text FROM tx"))(
    on_text("text", lambda c: T.strip_leading_phrases(F.lower(c))))
query("str3_references", sql(f"SELECT tx_id, {refs_sql('description')} AS text FROM tx"))(
    on_text("text", T.strip_references))
query("str4_places", sql(f"SELECT tx_id, {places_sql('lower(description)')} AS text FROM tx"))(
    on_text("text", lambda c: T.strip_places(F.lower(c))))
query("str5_trailing_phrases", sql(f"SELECT tx_id, {suffix_sql('lower(description)')} AS text FROM tx"))(
    on_text("text", lambda c: T.strip_trailing_phrases(F.lower(c))))
query("str6_short_name", sql(f"SELECT tx_id, {short_sql('lower(description)')} AS text FROM tx"))(
    on_text("text", lambda c: T.short_name(F.lower(c))))


@query("str7_pattern_variants", sql("""SELECT tx_id, CASE WHEN length(split_part(pattern, ' ', 1)) >= 3
  AND pattern <> split_part(pattern, ' ', 1) THEN pattern || '|' || split_part(pattern, ' ', 1)
  ELSE pattern END AS variants FROM pat""", *CLEAN))
def str7(spark, sf):
    p = transactions(spark, sf).select("tx_id", T.merchant_pattern(F.col("description")).alias("p"))
    return p.select("tx_id", F.array_join(T.pattern_variants(F.col("p")), "|").alias("variants"))


RAW_PREFIX = "^(" + words(K.PAYMENT_PREFIXES) + ")"
MERCHANT = [
    f"m1 AS (SELECT *, trim(regexp_extract(trim(description), {q(RAW_PREFIX)}, 0, 'i')) AS prefix, "
    f"trim(regexp_replace(trim(description), {q(RAW_PREFIX)}, '', 'i')) AS a FROM tx)",
    r"m2 AS (SELECT *, trim(regexp_replace(trim(regexp_replace(trim(regexp_replace(a, '\s+Card\s+Used\s+\d+', '', 'gi')),"
    r" '\s+AU$', '', 'i')), '\s+Card\s+\d+$', '', 'i')) AS b FROM m1)",
    """m3 AS (SELECT * EXCLUDE (a, b), CASE WHEN length(b) < 3 THEN description ELSE b END AS merchant,
  CASE WHEN prefix = '' THEN 'UNKNOWN' WHEN contains(lower(prefix), 'pending') THEN 'PENDING'
    WHEN contains(lower(prefix), 'pos') THEN 'POS'
    WHEN contains(lower(prefix), 'visa') OR contains(lower(prefix), 'mastercard') THEN 'CARD'
    WHEN contains(lower(prefix), 'atm') THEN 'ATM'
    WHEN contains(lower(prefix), 'direct debit') OR starts_with(lower(prefix), 'dd') THEN 'DIRECT_DEBIT'
    WHEN contains(lower(prefix), 'salary') OR contains(lower(prefix), 'pay/') THEN 'SALARY'
    WHEN contains(lower(prefix), 'interest') THEN 'INTEREST'
    WHEN contains(lower(prefix), 'transfer') THEN 'TRANSFER' ELSE 'OTHER' END AS tx_type FROM m2)""",
]


@query("str8_payment_prefix", sql("SELECT tx_id, merchant, tx_type FROM m3", *MERCHANT))
def str8(spark, sf):
    d = F.col("description")
    return transactions(spark, sf).select("tx_id", T.merchant_text(d).alias("merchant"),
                                          T.payment_type(d).alias("tx_type"))


@query("str9_payment_type", sql("SELECT tx_type, count(*) AS n FROM m3 GROUP BY 1", *MERCHANT))
def str9(spark, sf):
    return (transactions(spark, sf).groupBy(T.payment_type(F.col("description")).alias("tx_type"))
            .agg(F.count(F.lit(1)).alias("n")))


query("str10_merchant", sql("SELECT tx_id, merchant FROM m3", *MERCHANT))(
    on_text("merchant", T.merchant_text))
query("str11_match_form", sql(f"""SELECT tx_id, {squeeze_sql("regexp_replace(lower(description), '[^a-z0-9 ]', '', 'g')")}
  AS text FROM tx"""))(on_text("text", T.match_form))
query("str12_merchant_key", sql("SELECT tx_id, trim(lower(description)) AS text FROM tx"))(
    on_text("text", T.merchant_key))

# The three account patterns, read one by one, as a sorted list.
ACCOUNTS_SQL = r"""list_distinct(list_concat([regexp_replace(x, '[- ]', '') for x in
  regexp_extract_all({d}, '\b\d{{3}}[- ]?\d{{6,9}}\b', 0, 'i')], regexp_extract_all({d}, '(TO|FROM)\s+(\d{{6,9}})\b', 2, 'i'),
  regexp_extract_all({d}, 'TRANSFER\s+\d+\s+(TO|FROM)\s+(\d{{6,9}})', 2, 'i')))"""


@query("str13_account_numbers", sql(
    "SELECT tx_id, array_to_string(list_sort(" + ACCOUNTS_SQL.format(d="description") + "), ',') AS accounts FROM tx"))
def str13(spark, sf):
    return transactions(spark, sf).select("tx_id", F.array_join(F.array_sort(
        T.account_numbers(F.col("description"))), ",").alias("accounts"))


@query("str14_transfer_words", sql("""SELECT tx_id, contains(upper(description), 'TFER') OR contains(upper(description), 'TRANSFER')
  OR contains(upper(description), 'M-BANKING FUNDS') OR contains(upper(description), 'INTERNET BANKING PAYMENT')
  OR contains(upper(description), 'MOBILE BANKING PAYMENT') AS worded,
  coalesce(contains(provider_category, 'Internal Transfer'), false)
  OR coalesce(contains(third_party, 'Internal Transfer'), false) AS hinted FROM tx"""))
def str14(spark, sf):
    return transactions(spark, sf).select(
        "tx_id", T.is_transfer_worded(F.col("description")).alias("worded"),
        T.has_internal_hint(F.col("provider_category"), F.col("third_party")).alias("hinted"))


@query("str17_request_key", sql("""SELECT tx_id, md5(description || '|' || CAST(CAST(cents AS DECIMAL(18,2)) / 100 AS DECIMAL(18,2))
  || '|' || coalesce(provider_category, '')) AS request_key FROM tx"""))
def str17(spark, sf):
    amount = F.col("cents").cast("decimal(18,2)") / 100
    return transactions(spark, sf).select("tx_id", T.request_key(
        F.col("description"), amount, F.col("provider_category")).alias("request_key"))


@query("str20_place_removal", sql(f"""SELECT tx_id, {places_sql('lower(description)')} AS without_places,
  pattern AS lookup_form FROM pat""", *CLEAN))
def str20(spark, sf):
    d = F.col("description")
    return transactions(spark, sf).select("tx_id", T.remove_places(d).alias("without_places"),
                                          T.lookup_form(d).alias("lookup_form"))


@query("prj7_redaction", sql(r"""SELECT tx_id, CASE WHEN length(t) <= 6 THEN '[REDACTED]'
  ELSE substr(t, 1, 3) || '...' || substr(t, length(t) - 2) END AS redacted
  FROM (SELECT tx_id, trim(regexp_replace(description, '\s+', ' ', 'g')) AS t FROM tx)"""))
def prj7(spark, sf):
    return transactions(spark, sf).select("tx_id", T.redact(F.col("description")).alias("redacted"))
