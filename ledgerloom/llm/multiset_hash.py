"""Homomorphic multiset hash of a text's paragraphs, with a likeness of two fingerprints.

A paragraph (a line of the text) hashes to a wide vector of 32-bit lanes: 16 lanes of its
SHA-512, which make equality hard to fake, and 128 narrow lanes that add up, over its pieces,
128 hashed bits of each. Pieces are all pairs of neighbouring words, and the last word alone, so
a word put in or taken out touches two pieces and leaves the others. A text's fingerprint is the lane-wise sum over its paragraphs
modulo 2^32. So order does not matter, equal multisets of paragraphs have equal fingerprints,
and a paragraph enters or leaves by adding or subtracting its own vector.

A narrow lane counts ones among as many fair bits as the text has pieces: 2 * ones - pieces is
a sum of +1 and -1, and the scaled inner product of two such vectors estimates how many pieces
two texts share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, text_of

WIDE = 16
SHIFTS = 32
SEEDS = (101, 202)
TWO_BITS = (1 << 32) + 1
LANE = (1 << 32) - 1
WORD = r"[^\x20\x09-\x0D]++"


def _unsigned(c: Column, bits: int = 32) -> Column:
    return c.bitwiseAND(F.lit((1 << bits) - 1))


def fingerprints(texts: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """One row per row of ``texts``: ``keys``, ``pieces``, ``wide`` (16 lanes) and ``narrow`` (64
    words of two 32-bit lanes). Null text is the empty text, which is one empty paragraph.
    ``keys`` must tell rows apart; rows with the same keys are added up. All other columns are
    ignored, and an empty table gives no rows.

    The sums begin in the task that reads a text, so a shuffle carries one row per text and
    task, however long the text is.
    """
    # A paragraph's digest comes as a row without words before its pieces.
    line = F.transform(F.split(text_of(text_col), "\n"), lambda x: F.struct(
        F.unhex(F.sha2(x, 512)).alias("digest"), F.regexp_extract_all(x, F.lit(WORD), F.lit(0)).alias("words")))
    lines = texts.select(*keys, F.explode(line).alias("line")).select(*keys, "line.digest", "line.words")
    piece = lambda d, a, b: F.struct(d.alias("digest"), a.alias("a"), b.alias("b"))
    none = F.lit(None)
    pairs = F.zip_with("words", F.slice("words", 2, F.size("words")), lambda a, b: piece(none.cast("binary"), a, b))
    units = F.concat(F.array(piece(F.col("digest"), none.cast("string"), none.cast("string"))), pairs)
    rows = lines.select(*keys, F.explode(units).alias("u")).select(*keys, "u.digest", "u.a", "u.b")
    narrow = []
    for j, seed in enumerate(SEEDS):
        rows = rows.withColumn(f"h{j}", F.when(F.col("a").isNotNull(), F.xxhash64(F.lit(seed), "a", "b")).otherwise(F.lit(0)))
        narrow += [F.sum(F.shiftrightunsigned(f"h{j}", s).bitwiseAND(F.lit(TWO_BITS))).alias(f"n{j}_{s}") for s in range(SHIFTS)]
    wide = [F.sum(F.conv(F.hex(F.substring("digest", 4 * i + 1, 4)), 16, 10).cast("bigint")).alias(f"w{i}") for i in range(WIDE)]
    sums = rows.groupBy(*keys).agg(F.count("a").alias("pieces"), *wide, *narrow)
    return sums.select(*keys, "pieces", F.array(*[_unsigned(F.col(f"w{i}")) for i in range(WIDE)]).alias("wide"),
                       F.array(*[F.col(f"n{j}_{s}") for j in range(len(SEEDS)) for s in range(SHIFTS)]).alias("narrow"))


def as_text(f: str | None = None) -> Column:
    """The fingerprint as a hex string of all lanes, 8 digits each, after the piece count."""
    at = (lambda c: F.col(f"{f}.{c}")) if f else F.col
    hexed = lambda c, n: F.lpad(F.hex(c), n, "0")
    return F.lower(F.concat(hexed(_unsigned(at("pieces")), 8), F.array_join(F.transform(at("wide"), lambda x: hexed(x, 8)), ""),
                            F.array_join(F.transform(at("narrow"), lambda x: hexed(x, 16)), "")))


def combine(a: str, b: str, sign: int = 1) -> Column:
    """Fingerprint struct of the union of two multisets, or with ``sign=-1`` of their difference:
    what insertion and deletion of paragraphs come to. Lanes are taken modulo 2^32."""
    s = F.lit(sign).cast("bigint")
    low = lambda x: x.bitwiseAND(F.lit(LANE))
    high = lambda x: F.shiftrightunsigned(x, 32)
    both = lambda x, y: F.shiftleft(low(high(x) + s * high(y)), 32).bitwiseOR(low(low(x) + s * low(y)))
    return F.struct((F.col(f"{a}.pieces") + s * F.col(f"{b}.pieces")).alias("pieces"),
                    F.zip_with(f"{a}.wide", f"{b}.wide", lambda x, y: low(x + s * y)).alias("wide"),
                    F.zip_with(f"{a}.narrow", f"{b}.narrow", both).alias("narrow"))


def likeness(a: str, b: str) -> Column:
    """Estimated cosine of two texts' piece counts, cut to 0..1: 1 for equal fingerprints, about
    0 for texts without common pieces. Texts without pieces are like equal texts only."""
    def lanes(x):
        signed = lambda ones: F.lit(2) * ones - F.col(f"{x}.pieces")
        return F.concat(F.transform(f"{x}.narrow", lambda v: signed(v.bitwiseAND(F.lit(LANE)))),
                        F.transform(f"{x}.narrow", lambda v: signed(F.shiftrightunsigned(v, 32)))).cast("array<double>")

    dot = lambda u, v: F.aggregate(F.zip_with(u, v, lambda p, q: p * q), F.lit(0.0), lambda acc, t: acc + t)
    norms = F.sqrt(dot(lanes(a), lanes(a)) * dot(lanes(b), lanes(b)))
    same = (F.col(f"{a}.pieces") == F.col(f"{b}.pieces")) & (F.col(f"{a}.wide") == F.col(f"{b}.wide")) & (F.col(f"{a}.narrow") == F.col(f"{b}.narrow"))
    cosine = F.when(norms > 0, dot(lanes(a), lanes(b)) / norms).otherwise(0.0)
    return F.when(same, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), cosine)))


def successors(docs: DataFrame, scratch: Scratch, bucket_rows: int = 20_000) -> tuple[DataFrame, bool]:
    """For every id, the next greater id (after the greatest, the least): rows (doc_id, next_id);
    and whether each id has one row. Ids are range-partitioned; the last id of a range finds its
    successor in the list of ranges, one row each."""
    ids = scratch.write(docs.filter("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")), "ids")
    n, most = ids.agg(F.count(F.lit(1)), F.max("rows")).first()
    parts = max(1, -(-n // bucket_rows))
    ids = scratch.write(ids.select("doc_id").repartitionByRange(parts, "doc_id").withColumn("part", F.spark_partition_id()), "ranges")
    firsts = ids.groupBy("part").agg(F.min("doc_id").alias("first"))
    # One row per range of about 20,000 ids.
    order = Window.orderBy("part")
    firsts = firsts.select(F.col("part").alias("p"), F.coalesce(F.lead("first").over(order),
                           F.min("first").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("after"))
    inside = F.lead("doc_id").over(Window.partitionBy("part").orderBy("doc_id"))
    return (ids.withColumn("inside", inside).join(firsts, F.col("part") == F.col("p"))
            .select("doc_id", F.coalesce("inside", "after").alias("next_id"))), (most or 1) == 1


def with_next(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, text, next_text): each document beside the next one's text (its least text,
    if an id has several rows). Texts are shuffled once by id and once to their predecessors.
    Rows without ``doc_id`` have no successor: null."""
    scratch = Scratch(docs.sparkSession)
    nexts, single = successors(docs, scratch)
    nexts = scratch.write(nexts, "next")
    plain = docs.select("doc_id", text_of("text").alias("text"))
    # One exchange, read by both joins below.
    keyed = plain.filter("doc_id is not null").repartition(F.col("doc_id"))
    sent = keyed.join(nexts.select(F.col("next_id").alias("doc_id"), F.col("doc_id").alias("for_id")), "doc_id").select("for_id", F.col("text").alias("next_text"))
    if not single:
        sent = sent.groupBy("for_id").agg(F.min("next_text").alias("next_text"))
    out = keyed.join(sent, F.col("doc_id") == F.col("for_id"), "left").select("doc_id", "text", "next_text")
    # Without a union the rows stay dealt by id, and what follows groups them where they are.
    nameless = plain.filter("doc_id is null")
    return out if nameless.isEmpty() else out.union(nameless.select("doc_id", "text", F.lit(None).cast("string")))


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Every document's fingerprint, that of its edited text, and their likeness, and the likeness
    to the next document's: rows (doc_id, n_chars, edited_sha256, own, other, near_edited,
    near_next). In the edited text the last quarter is replaced by the first as many characters
    of the next document (all of it, if shorter). Rows without ``doc_id`` lose the quarter and
    have no ``near_next``. Rows that repeat an id are fingerprinted each."""
    rows = with_next(docs).withColumn("row", F.monotonically_increasing_id())
    k = F.floor(F.length("text") / 4).cast("int")
    edited = F.concat(F.col("text").substr(F.lit(1), F.length("text") - k), F.coalesce(F.col("next_text").substr(F.lit(1), k), F.lit("")))
    version = lambda i, t: F.struct(F.lit(i).alias("which"), t.alias("text"))
    rows = rows.select("doc_id", "row", F.length("text").cast("bigint").alias("n_chars"), "next_text", "text", edited.alias("edited"))
    rows = rows.select("doc_id", "row", "n_chars", F.col("next_text").isNotNull().alias("followed"), F.sha2("edited", 256).alias("sha"),
                       F.explode(F.array(version(0, F.col("text")), version(1, F.col("edited")), version(2, F.col("next_text")))).alias("v"))
    keys = ["doc_id", "row", "n_chars", "followed", "sha"]
    prints = fingerprints(rows.select(*keys, "v.which", "v.text"), [*keys, "which"])
    pick = lambda i: F.max(F.when(F.col("which") == i, F.struct("pieces", "wide", "narrow")))
    out = prints.groupBy(*keys).agg(pick(0).alias("own"), pick(1).alias("other"), pick(2).alias("after"))
    return out.select("doc_id", "n_chars", F.col("sha").alias("edited_sha256"), "own", "other",
                      likeness("own", "other").alias("near_edited"), F.when(F.col("followed"), likeness("own", "after")).alias("near_next"))
