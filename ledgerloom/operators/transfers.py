"""Transfers between a customer's own accounts (TRF1-TRF4, JN4, JN5, SET1, SET2).

Tables: tx(customer_id, tx_id, tx_date, description, cents, provider_category, third_party,
account_number, bsb). Everything is keyed by customer and account; no pair of rows is formed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import account_numbers, has_internal_hint, is_transfer_worded
from .skew import attach
from .stage import written

OWN = ["customer_id", "account"]


def _exploded(tx: DataFrame, *more: str) -> DataFrame:
    return tx.select("customer_id", *more,
                     F.explode(account_numbers(F.col("description"))).alias("account"))


def _dated(tx: DataFrame) -> DataFrame:
    return tx.filter(F.col("tx_date").isNotNull())


def two_way_accounts(tx: DataFrame) -> DataFrame:
    """SET2: accounts named in both credits and debits of a customer."""
    seen = _exploded(_dated(tx), "cents").groupBy(*OWN).agg(
        F.max(F.col("cents") > 0).alias("credit"), F.max(F.col("cents") <= 0).alias("debit"))
    return seen.filter("credit AND debit").select(*OWN)


def paired_accounts(tx: DataFrame) -> DataFrame:
    """JN4: accounts of transfers that have an opposite transfer of equal size that day.

    A row has a partner exactly when its (customer, day, size) group holds both signs, so two
    grouped maxima replace the self-join.
    """
    group = ["customer_id", "tx_date", "size"]
    worded = (_dated(tx).filter(is_transfer_worded(F.col("description")) & (F.col("cents") != 0))
              .withColumn("size", F.abs("cents")))
    both = (worded.groupBy(*group).agg(F.max(F.col("cents") > 0).alias("plus"),
                                       F.max(F.col("cents") < 0).alias("minus"))
            .filter("plus AND minus").select(*group))
    named = _exploded(worded, "tx_date", "size").distinct()
    return attach(named, both, group, ["account"]).select(*OWN).distinct()


def hinted_accounts(tx: DataFrame) -> DataFrame:
    """TRF2: accounts named in rows the provider marks as internal; undated rows count."""
    hint = has_internal_hint(F.col("provider_category"), F.col("third_party"))
    return _exploded(tx.filter(hint)).distinct()


def declared_accounts(tx: DataFrame) -> DataFrame:
    number = F.nullif(F.col("account_number"), F.lit(""))
    return (_dated(tx).filter(number.isNotNull())
            .select("customer_id", F.concat(F.coalesce("bsb", F.lit("")), number).alias("account"))
            .distinct())


def own_accounts(tx: DataFrame) -> DataFrame:
    """TRF1/TRF4/SET1: accounts that belong to each customer.

    One pass names every account with the kinds of evidence its row gives; one grouping then
    decides what ``declared_accounts``, ``two_way_accounts`` and ``hinted_accounts`` decide apart.
    Only opposite transfers need a grouping of their own.
    """
    dated = F.col("tx_date").isNotNull()
    number = F.nullif(F.col("account_number"), F.lit(""))
    no, yes = F.lit(False), F.lit(True)

    def named(account, credit, debit, hint, declared):
        return F.struct(account.alias("account"), *[F.coalesce(c, no).alias(n) for c, n in (
            (credit, "credit"), (debit, "debit"), (hint, "hint"), (declared, "declared"))])

    hint = has_internal_hint(F.col("provider_category"), F.col("third_party"))
    said = F.transform(account_numbers(F.col("description")), lambda a: named(
        a, dated & (F.col("cents") > 0), dated & (F.col("cents") <= 0), hint, no))
    own = named(F.concat(F.coalesce("bsb", F.lit("")), number), no, no, no, yes)
    rows = tx.select("customer_id", F.explode(F.concat(said, F.when(dated & number.isNotNull(), F.array(own)).otherwise(
        F.array().cast("array<struct<account:string,credit:boolean,debit:boolean,hint:boolean,declared:boolean>>")))).alias("e"))
    kinds = rows.groupBy("customer_id", "e.account").agg(*[F.max(F.col(f"e.{c}")).alias(c) for c in ("credit", "debit", "hint", "declared")])
    return (kinds.filter("declared OR hint OR (credit AND debit)").select(*OWN)
            .unionByName(paired_accounts(tx)).distinct())


def _substrings(c: Column, least: int) -> Column:
    """All distinct substrings from ``least`` characters up to the whole text."""
    def of_length(n):
        return F.transform(F.sequence(F.lit(1), F.length(c) - n + 1), lambda i: F.substr(c, i, n))

    sizes = F.when(F.length(c) >= least, F.sequence(F.lit(least), F.length(c))).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.flatten(F.transform(sizes, of_length)))


# An account is found inside a longer own account from six digits on.
SHORTEST = 6


def matching_accounts(accounts: DataFrame, own: DataFrame) -> DataFrame:
    """JN5: accounts equal to, inside, or around an own account of the same customer.

    Containment becomes equality on substrings; the joined tables have distinct keys.
    """
    accounts = accounts.select(*OWN).distinct()
    own = own.select("customer_id", F.col("account").alias("part")).distinct()
    around = (accounts.withColumn("part", F.explode(_substrings(F.col("account"), 1)))
              .join(own, ["customer_id", "part"], "left_semi").select(*OWN))
    inside = accounts.join(
        own.select("customer_id", F.explode(_substrings(F.col("part"), SHORTEST))
                   .alias("account")).distinct(), OWN, "left_semi")
    return around.unionByName(inside).distinct()


def flag_own_transfers(tx: DataFrame, learn: bool = True, own: DataFrame | None = None,
                       column: str = "is_own_transfer") -> DataFrame:
    """TRF3: adds a flag. Without learning only the provider's hints count.

    Only rows that name an account in a transfer pass through the join.
    """
    hint = has_internal_hint(F.col("provider_category"), F.col("third_party"))
    if not learn and own is None:
        return tx.withColumn(column, hint)
    own = own_accounts(tx) if own is None else own
    asks = (~hint & is_transfer_worded(F.col("description"))
            & (F.size(account_numbers(F.col("description"))) > 0))
    candidates = tx.filter(asks)
    named = written(_exploded(candidates, "tx_id"))
    hits = matching_accounts(named, own)
    ids = (attach(named, hits, OWN, ["tx_id"]).select("tx_id").distinct()
           .withColumn(column, F.lit(True)))
    joined = (candidates.join(ids, "tx_id", "left")
              .withColumn(column, F.coalesce(F.col(column), F.lit(False))))
    return tx.filter(~asks).withColumn(column, hint).unionByName(joined)
