"""Matching provider rows to labelled rows and learning mappings (JN3, AGG8-AGG11, LRM1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import MatchParams
from ..functions.text import match_form
from .filters import gold_rows, split_by_confidence
from .learning import first_k
from .rules import category_by_name
from .skew import attach
from .stage import written

SIG = ["customer_id", "cents", "day", "words"]


def word_set(description: Column) -> Column:
    """SET5: sorted distinct words of the fuzzy form."""
    return F.array_sort(F.array_distinct(F.filter(
        F.split(match_form(F.coalesce(description, F.lit(""))), " "), lambda w: w != "")))


def whole_day(ts: Column) -> Column:
    """Day on which a date lies zero floored days before ``ts``: a time of day counts as the next."""
    day = F.to_date(ts)
    return F.date_add(day, F.when(ts > day.cast("timestamp_ntz"), 1).otherwise(0))


def fuzzy_match(left: DataFrame, right: DataFrame, params: MatchParams = MatchParams()) -> DataFrame:
    """JN3: for each left row the first right row (by ``seq``) of the same customer with
    amounts at most a cent apart, at most two floored days apart, and enough common words.

    left(customer_id, tx_id, tx_date, cents, description), right(customer_id, seq, ts, cents,
    description, code). Adds match_seq, match_code, match_description, match_ts.

    Enough means ceil(0.4 * smaller set), so two rows match on one common word when either has
    at most two words, and on two when either has at most five. Those cases need no pairs: the
    right side is reduced to the first ``seq`` per (day, amount, word) or (.., two words). Where
    both sides have six or more words a prefix filter picks what is compared (``_long_matches``).
    Equal rows are one signature on each side.
    """
    num, den = params.overlap_num, params.overlap_den
    lw = left.select("*", F.col("tx_date").alias("day"), word_set(F.col("description")).alias("words"))
    counts = lw.filter(F.size("words") > 0).groupBy(*SIG).agg(F.count(F.lit(1)).alias("_n"))
    rw = right.select("customer_id", "seq", "ts", "cents", "code", "description",
                      whole_day(F.col("ts")).alias("near_day"), word_set(F.col("description")).alias("words"))
    best_right = F.min(F.struct(
        "seq", F.col("code").alias("match_code"), F.col("description").alias("match_description"),
        F.col("ts").alias("match_ts")))
    place = ["customer_id", "cents", "near_day"]
    rrows = _need(rw.filter(F.size("words") > 0), num, den).withColumnRenamed("cents", "r_cents")
    # Amounts and days are widened as bare keys, without words and matches: few rows meet another of
    # the same customer, amount and days, and only those are taken apart. As they are read several
    # times they are written where a shared folder exists.
    lkey, rkey = ["customer_id", "cents", "day"], ["customer_id", "r_cents", "near_day"]
    lplaces = lw.filter(F.size("words") > 0).select(*lkey).distinct().withColumn("near_day", F.explode(F.sequence(
        F.date_sub("day", params.days), F.date_add("day", params.days))))
    rplaces = _needed(rrows, rkey, "r").withColumn("cents", F.explode(F.sequence(
        F.col("r_cents") - params.cents, F.col("r_cents") + params.cents)))
    both = rplaces.groupBy(*place).agg(*[F.max(c).alias(c) for c in ("r1", "r2")])
    near = written(_merged(_need(counts, num, den), _merged(lplaces, both, place), lkey))
    rsig = rrows.groupBy(*rkey, "words", "need").agg(best_right.alias("m"))
    rnear = written(_merged(rsig, _merged(rplaces.select(*rkey, "cents"), _needed(near, place, "l"), place), rkey).drop("r_cents"))
    key = [*place, "k", "key"]
    just = F.col("need") == F.col("k")
    # A row is the first of its own or of the longer ones, never sent as both.
    table = (rnear.withColumn("e", F.explode(_keys("l"))).select("*", "e.*")
             .groupBy(*key).agg(F.min(F.when(just, F.col("m"))).alias("own"), F.min(F.when(~just, F.col("m"))).alias("longer")))
    asks = near.withColumn("e", F.explode(_keys("r"))).select("*", "e.*")
    found = _merged(asks, table, key).select(
        *SIG, F.when(just, F.least("own", "longer")).otherwise(F.col("own")).alias("m"))
    owners, big = _long_matches(near.filter(F.col("need") >= 3), rnear.filter(F.col("need") >= 3))
    big = _merged(owners, big, [*place, "shared", "need"]).select(*SIG, "m")
    best = (found.unionByName(big).filter(F.col("m").isNotNull())
            .groupBy(*SIG).agg(F.min("m").alias("m")))
    return attach(lw, best, SIG, ["tx_id"], "left", counts=counts, hint="merge").select(
        *left.columns, F.col("m.seq").alias("match_seq"), "m.match_code", "m.match_description",
        "m.match_ts")


def _long_matches(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Set-similarity join of rows that need three or more common words.

    left(*SIG, near_day, need), right(customer_id, cents, near_day, words, need, m): the left rows with
    the words they ``shared`` with any right row of their place, and (place, shared, need, m), the
    first right row for each such set.

    Words that the other side has nowhere at that place cannot count, so rows that differ in
    those only are one set. Of the rest, rarest first, all but the last ``t - 1`` must hold a common
    word if ``t`` are common: sets meet on that prefix only, where ``t`` is the smaller need, so a word
    that all texts have joins nobody but those that have little else.
    """
    place = ["customer_id", "cents", "near_day"]
    lw = left.select(*SIG, "near_day", "need", F.explode("words").alias("word"))
    rw = right.select(*place, "words", "need", "m", F.explode("words").alias("word"))
    common = (_merged(lw.groupBy(*place, "word").agg(F.count(F.lit(1)).alias("l_n")),
                      rw.groupBy(*place, "word").agg(F.count(F.lit(1)).alias("r_n")), [*place, "word"])
              .select(*place, "word", (F.col("l_n") + F.col("r_n")).alias("held")))

    def sets(rows: DataFrame, keys: list[str], *more: Column) -> DataFrame:
        ordered = F.sort_array(F.collect_list(F.struct("held", "word")))
        out = _merged(rows, common, [*place, "word"]).groupBy(*keys, "need").agg(ordered.alias("o"), *more)
        return out.filter(F.size("o") >= 3).withColumn("shared", F.col("o.word")).drop("o")

    owners = sets(lw, [*SIG, "near_day"])
    rights = sets(rw, [*place, "words"], F.min("m").alias("m")).groupBy(*place, "shared", "need").agg(F.min("m").alias("m"))

    def prefix(rows: DataFrame, side: str) -> DataFrame:
        """A word usable up to ``t``: at place i of n words it is in the prefix if t <= n - i."""
        return (rows.select("*", F.posexplode(F.slice("shared", 1, F.size("shared") - 2)).alias("i", "word"))
                .withColumn(f"{side}_most", F.size("shared") - F.col("i")).drop("i")
                .withColumnsRenamed({"need": f"{side}_need", "shared": f"{side}_shared"}))

    t = F.least("l_need", "r_need")
    met = (_merged(prefix(owners.select(*place, "shared", "need").distinct(), "l"), prefix(rights, "r"), [*place, "word"])
           .filter((t <= F.col("l_most")) & (t <= F.col("r_most")))
           .filter(F.size(F.array_intersect("l_shared", "r_shared")) >= t))
    return owners, met.groupBy(*place, F.col("l_shared").alias("shared"), F.col("l_need").alias("need")).agg(F.min("m").alias("m"))


def _merged(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Join by sorted rows. Both sides grow with the input; a few MB of their files or shuffles unfold
    to hundreds in the driver, were one broadcast."""
    return left.join(right.hint("merge"), keys)


def _needed(rows: DataFrame, keys: list[str], side: str) -> DataFrame:
    """Whether rows of a key need just one common word, and just two."""
    return rows.groupBy(*keys).agg(*[F.max(F.col("need") == k).alias(f"{side}{k}") for k in (1, 2)])


def _keys(other: str) -> Column:
    """Single words as k = 1 and pairs of words as k = 2, where they decide a match: if the row needs
    just ``k``, or needs more and the ``other`` side has a row at its place that needs just ``k``."""
    none = F.array().cast("array<struct<k:int,key:string>>")

    def tagged(c, k):
        use = (F.col("need") == k) | ((F.col("need") > k) & F.col(f"{other}{k}"))
        return F.when(use, F.transform(c, lambda x: F.struct(F.lit(k).alias("k"), x.alias("key")))).otherwise(none)

    return F.concat(tagged(F.col("words"), 1), tagged(_pairs(F.col("words")), 2))


def _need(df: DataFrame, num: int, den: int) -> DataFrame:
    return df.withColumn("need", F.expr(f"(size(words) * {num} + {den - 1}) div {den}"))


def _pairs(words: Column) -> Column:
    return F.flatten(F.transform(words, lambda a, i: F.transform(
        F.slice(words, i + 2, F.size(words)), lambda b: F.concat_ws(" ", a, b))))


def mode_by(df: DataFrame, key: str, value: str, seq: str) -> DataFrame:
    """AGG8: most frequent value per key, the first seen on a tie, with its count and the total."""
    counts = df.groupBy(key, value).agg(F.count(F.lit(1)).alias("n"), F.min(seq).alias("first"))
    best = counts.groupBy(key).agg(
        F.min(F.struct((-F.col("n")).alias("m"), "first", value)).alias("b"), F.sum("n").alias("total"))
    return best.select(key, F.col(f"b.{value}").alias(value), (-F.col("b.m")).alias("n"), "total")


def learn_category_mapping(matched: DataFrame, params: MatchParams = MatchParams()) -> DataFrame:
    """AGG10: provider category to code from matches, else from its name, else by mean sign.

    ``matched`` is the output of ``fuzzy_match`` with provider_category and a left order ``seq``.
    """
    rows = matched.filter(F.coalesce("provider_category", F.lit("")) != "")
    totals = rows.groupBy("provider_category").agg(
        F.count(F.lit(1)).alias("total_count"), F.sum("cents").alias("_sum"))
    hits = rows.filter(F.col("match_seq").isNotNull())
    best = mode_by(hits.withColumnRenamed("match_code", "matched_code"), "provider_category",
                   "matched_code", "seq").drop("total").withColumnRenamed("n", "matched_count")
    samples = (first_k(hits, ["provider_category", "match_code"], [F.asc("seq")], params.samples)
               .groupBy("provider_category", F.col("match_code").alias("matched_code"))
               .agg(F.array_sort(F.collect_list(F.struct(
                   "seq", "description", "match_description", "cents", "tx_date", "match_ts")))
                   .alias("sample_matches")))
    name = category_by_name(F.col("provider_category"))
    out = (totals.join(best, "provider_category", "left")
           .join(samples, ["provider_category", "matched_code"], "left").withColumn("_name", name))
    matched_ = F.col("matched_code").isNotNull()
    return out.select(
        "provider_category",
        F.coalesce("matched_code", "_name", F.when(F.col("_sum") > 0, "INC-007").otherwise("EXP-039")).alias("code"),
        F.when(matched_, F.col("matched_count") / F.col("total_count"))
        .when(F.col("_name").isNotNull(), 0.5).otherwise(0.3).alias("confidence"),
        F.coalesce("matched_count", F.lit(0)).alias("matched_count"), "total_count",
        F.when(matched_, "transaction_match").when(F.col("_name").isNotNull(), "semantic")
        .otherwise("fallback").alias("provenance"), "sample_matches")


def mapping_report(mapping: DataFrame) -> DataFrame:
    """AGG11: counts by provenance and confidence band."""
    c, p = F.col("confidence"), F.col("provenance")
    return mapping.agg(
        F.count(F.lit(1)).alias("total_categories"),
        F.count_if(p == "transaction_match").alias("transaction_match"),
        F.count_if(p == "semantic").alias("semantic"), F.count_if(p == "fallback").alias("fallback"),
        F.count_if(c >= 0.8).alias("high_confidence"),
        F.count_if((c >= 0.5) & (c < 0.8)).alias("medium_confidence"),
        F.count_if(c < 0.5).alias("low_confidence"))


def learn_subclass_mapping(labelled: DataFrame, samples: int = 5) -> DataFrame:
    """LRM1: subclass to code from gold rows, with title, confidence and sample texts.

    labelled(seq, subclass_code, subclass_title, label_group_code, label_source, description).
    """
    gold = gold_rows(labelled).withColumns({c: F.trim(c) for c in (
        "subclass_code", "subclass_title", "label_group_code", "description")})
    best = mode_by(gold, "subclass_code", "label_group_code", "seq")
    titles = mode_by(gold.filter(F.coalesce("subclass_title", F.lit("")) != ""), "subclass_code",
                     "subclass_title", "seq").select("subclass_code", "subclass_title")
    texts = (first_k(gold, ["subclass_code", "label_group_code"], [F.asc("seq")], samples)
             .groupBy("subclass_code", "label_group_code")
             .agg(F.array_sort(F.collect_list(F.struct("seq", "description"))).alias("_s")))
    return (best.join(titles, "subclass_code", "left")
            .join(texts, ["subclass_code", "label_group_code"])
            .select("subclass_code", F.coalesce("subclass_title", F.lit("")).alias("subclass_title"),
                    "label_group_code", (F.col("n") / F.col("total")).alias("confidence"),
                    F.col("total").alias("transaction_count"),
                    F.col("_s.description").alias("sample_descriptions")))


def subclass_outputs(mapping: DataFrame, threshold: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """LRM1/FLT9: (high confidence, low confidence with a note)."""
    high, low = split_by_confidence(mapping, threshold)
    return high, low.drop("sample_descriptions").withColumn(
        "note", F.lit("several codes observed - review manually"))
