"""Near duplicates with HyperMinHash: compressed registers, banding, estimate, verification."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import Scratch, components, map_texts

SHINGLE = 5
BUCKETS = 256           # registers, picked by the top 8 bits of a shingle's hash
MANTISSA = 10           # bits kept after the leading one; 6 more hold the count of zeros
MISS = 1e-5             # bound on the probability that a pair at the threshold shares no band
MARGIN = 6.0            # standard errors below the threshold at which an estimate rules a pair out
EMPTY = np.uint64(2**64 - 1)
BROADCAST_IDS = 1 << 22   # ids (32 MB) that go to the texts; beyond, texts are shuffled to them
PARITY = 1024           # bits, each the parity of a set's hashes that fall on it


def banding(least: float) -> tuple[int, int]:
    """Bands and registers in each: the longest bands of which a pair at similarity ``least``
    shares none with probability ``MISS`` at most: 36 of 7 (9e-7) at 0.85, 42 of 6 (3e-6) at 0.8.
    Where no length holds that bound, below about 0.044, each register is a band."""
    for rows in range(16, 1, -1):
        if (1 - least**rows) ** (BUCKETS // rows) <= MISS:
            return BUCKETS // rows, rows
    return BUCKETS, 1


BANDS, ROWS = banding(0.85)

_rank = np.random.default_rng(2024).permuted(np.tile(np.arange(BUCKETS, dtype=np.uint16), (BUCKETS, 1)), axis=1)
_starts = np.arange(BUCKETS, dtype=np.uint64) << np.uint64(56)


def registers(u: np.ndarray) -> np.ndarray:
    """256 16-bit registers of a sorted set of 64-bit hashes: the least remainder of each bucket
    as its count of leading zeros and the next ten bits. A bucket without elements takes the
    register of the filled bucket that comes first in its own fixed random order, so that small
    sets are compared by what they have."""
    at = np.searchsorted(u, _starts)
    low = u[np.minimum(at, len(u) - 1)]
    filled = (at < len(u)) & ((low >> np.uint64(56)) == np.arange(BUCKETS, dtype=np.uint64))
    rest = (low & np.uint64(2**56 - 1)) >> np.uint64(3)  # 53 bits, exact as a float
    length = np.frexp(rest.astype(np.float64))[1]
    zeros = np.where(rest == 0, 53, 53 - length).astype(np.uint64)
    mantissa = ((rest << (zeros + np.uint64(1))) >> np.uint64(53 - MANTISSA)) & np.uint64(2**MANTISSA - 1)
    out = ((zeros << np.uint64(MANTISSA)) | mantissa).astype(np.uint16)
    if not filled.all():
        have = np.flatnonzero(filled)
        gaps = np.flatnonzero(~filled)
        out[gaps] = out[have[np.argmin(_rank[gaps][:, have], axis=1)]]
    return out


def band_keys(regs: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    cut = regs[: bands * rows].reshape(bands, rows).astype(np.uint64) + np.uint64(1)
    with np.errstate(over="ignore"):
        return tokens.mix((cut * tokens.ODD[:rows]).sum(axis=1) + np.arange(bands, dtype=np.uint64) * tokens.ODD[50])


def parity(u: np.ndarray) -> np.ndarray:
    """Which of PARITY places an odd number of hashes falls on, as 64-bit words. Two sets differ in at
    least as many elements as their words differ in bits."""
    odd = np.bincount((u & np.uint64(PARITY - 1)).astype(np.int64), minlength=PARITY) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def estimate(equal: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard estimate from the number of equal registers, corrected for those that are equal
    by chance: 0.1699 * buckets / 2^mantissa * phi of them are expected in unrelated sets of n
    and m elements, phi = 4 r / (1 + r)^2, r = n / m (the published HyperMinHash bound)."""
    r = np.minimum(n, m) / np.maximum(n, m)
    chance = 0.169919487159739093975315012348 * BUCKETS / 2**MANTISSA * 4 * r / (1 + r) ** 2
    return np.clip((equal - chance) / (BUCKETS - chance), 0, 1)


def _sketches(bands: int, rows: int):
    def run(texts: list) -> dict:
        out = {"n": [], "same": [], "regs": [], "bands": [], "parity": []}
        for text in texts:
            w = tokens.split(text, lower=True)
            u = tokens.shingles(tokens.hashes(w), SHINGLE)
            regs = registers(u) if len(u) else None
            out["n"].append(len(u))
            out["same"].append(tokens.identity(w) if len(u) else None)
            out["regs"].append(regs.tobytes() if len(u) else None)
            out["bands"].append(band_keys(regs, bands, rows).view(np.int64) if len(u) else None)
            out["parity"].append(parity(u) if len(u) else None)
        return out

    return run


def _sets(texts: list) -> dict:
    words = [tokens.split(t, lower=True) for t in texts]
    # The number of a class as Spark's xxhash64 gives it.
    nodes = [xxhash.xxh64_intdigest(tokens.identity(w), 42) for w in words]
    return {"node": [n - (1 << 64) if n >> 63 else n for n in nodes], "set": [tokens.shingles(tokens.hashes(w), SHINGLE).view(np.int64) for w in words]}


def _ruled_in(least: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        slack = MARGIN * np.sqrt(least * (1 - least) / BUCKETS)
        for p in batches:
            equal = np.array([np.count_nonzero(np.frombuffer(a, np.uint16) == np.frombuffer(b, np.uint16)) for a, b in zip(p["ra"], p["rb"])], dtype=float)
            yield p.loc[estimate(equal, p["na"].to_numpy(), p["nb"].to_numpy()) >= least - slack, ["a", "b"]] if len(p) else p[["a", "b"]]

    return run


def link(docs: DataFrame, num: int = 85, den: int = 100) -> DataFrame:
    """Near-duplicate groups: rows (doc_id, n_shingles, component_id, kept) for every document.

    Documents are linked if den * |A and B| >= num * |A or B| for their sets of five-word
    shingles (words lower-cased in A-Z; fewer than five words are one shingle), confirmed on
    the full sets. ``component_id`` is the least id reachable, ``kept`` marks it.

    Word sequences that are equal are one class, whose least id stands for it. Classes that
    share a band key of their compressed registers meet (``banding`` fits the bands to the threshold); pairs whose corrected estimate is six
    standard errors below the threshold are let go. A band's members are not paired with each
    other: hubs (first one, then eight times as many each round) are compared with all
    members, then leave the band; members already in one component are not compared, and a
    pair is compared once, however many bands both have. Hubs come from a band's smaller components first, and among these from the texts with
    the most shingles that others have as well. Rounds end when no band holds two components, so no link
    between different texts is left out, and a band of m texts that merge costs about m comparisons.
    Where members stay apart, every hub still looks at every member's bounds (below).

    A shingle that only one of the candidate texts has is in no intersection. So two texts of n
    and m shingles with u and v own ones share at most min(n - u, m - v). And they differ in at
    least as many shingles as their parity words (``parity``) in bits. Pairs that cannot reach the
    threshold by either bound are not formed, whatever bands they share, so a group of texts
    that all stay apart costs a look at a few words for each member and hub, and no pairs.

    No words or null text: n_shingles 0, linked with nothing. Rows without ``doc_id`` come back
    with null ``component_id``, kept. Rows that repeat an id are one document, which is linked with
    what any of its texts is linked with. Other columns are ignored; an empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("bigint"), "text")
    kept = "n bigint, same binary, regs binary, bands array<bigint>, parity array<bigint>"
    all_ = scratch.write(map_texts(texts, _sketches(*banding(num / den)), kept, ["doc_id"]), "sketches")
    # A class is known by a number of its own: one id may stand for several classes.
    classes = scratch.write(all_.filter("doc_id is not null and n > 0").groupBy("same").agg(F.min("doc_id").alias("rep"))
                            .withColumn("node", F.xxhash64("same")), "classes")

    heads = classes.select(F.col("rep").alias("doc_id"), "same", "node")
    banded = all_.join(heads, ["doc_id", "same"]).select(F.col("node").alias("doc_id"), "n", "regs", "bands", "parity").dropDuplicates(["doc_id"])
    banded = scratch.write(banded, "banded")
    keys = banded.select(F.explode("bands").alias("band"), F.col("doc_id").alias("id"))
    shared = keys.groupBy("band").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("band")
    members = scratch.write(keys.join(shared, "band"), "bands")
    ids = members.select("id").distinct()
    known = scratch.write(banded.join(ids, F.col("doc_id") == F.col("id"), "left_semi").select("doc_id", "n", "regs", "parity"), "registers")
    scratch.drop(banded)
    wanted = heads.join(ids, F.col("node") == F.col("id"), "left_semi").select("doc_id").distinct()
    wanted = scratch.write(wanted, "wanted")
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    # Other texts of a wanted id come along; their sets only weaken the bound on own shingles.
    sets = map_texts(texts.join(wanted, "doc_id", "left_semi"), _sets, "node bigint, set array<bigint>", []).withColumnRenamed("node", "doc_id")
    sets = scratch.write(sets.dropDuplicates(["doc_id"]), "sets")
    alone = (sets.select("doc_id", F.explode("set").alias("s")).groupBy("s").agg(F.count(F.lit(1)).alias("c"), F.min("doc_id").alias("id"))
             .filter("c = 1").groupBy("id").agg(F.count(F.lit(1)).alias("own")))
    share = sets.select(F.col("doc_id").alias("id"), F.size("set").alias("n")).join(alone, "id", "left").select(
        "id", "n", F.coalesce("own", F.lit(0)).alias("own")).filter((F.col("n") - F.col("own")) * den >= F.col("n") * num)
    keyed = known.select(F.col("doc_id").alias("id"), "parity")
    members = scratch.write(members.join(share, "id").join(keyed, "id"), "members")

    links, found = [], scratch.write(docs.sparkSession.createDataFrame([], "id bigint, component bigint"), "none")
    # The texts of one id belong together from the start.
    nodes = all_.filter("doc_id is not null and n > 0").join(classes, "same").select("doc_id", "node")
    several = nodes.groupBy("doc_id").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo < hi")
    of_id = scratch.write(nodes.join(several, "doc_id").filter("node > lo").select(F.col("lo").alias("a"), F.col("node").alias("b")).distinct(), "ids")
    if not of_id.isEmpty():
        links.append(of_id)
        found = scratch.write(components(of_id, scratch), "components")
    hubs_per_band = 1
    while True:
        placed = members.join(found, "id", "left").select("band", "id", "n", "own", "parity", F.coalesce("component", "id").alias("component"))
        mixed = placed.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi").select("band")
        placed = scratch.write(placed.join(mixed, "band"), "placed")
        if placed.isEmpty():
            break
        slot = F.pmod(F.xxhash64("id", "band"), F.lit(hubs_per_band))
        sized = placed.withColumn("size", F.lit(1).cast("bigint"))
        if links:
            sizes = placed.groupBy("band", "component").agg(F.count(F.lit(1)).alias("size"))
            sized = placed.join(sizes, ["band", "component"])
        hubs = scratch.write(sized.groupBy("band", slot.alias("slot")).agg(F.min(F.struct("size", (F.col("own") - F.col("n")).alias("rank"), "id", "n", "own", "component")).alias("h"))
                             .select("band", F.col("h.id").alias("hub"), F.col("h.n").alias("hub_n"), F.col("h.own").alias("hub_own"),
                                     F.col("h.component").alias("hub_component"))
                             .join(keyed.select(F.col("id").alias("hub"), F.col("parity").alias("hub_parity")), "hub"), "hubs")
        most = F.least(F.col("n") - F.col("own"), F.col("hub_n") - F.col("hub_own"))
        reach = most * den >= (F.col("n") + F.col("hub_n") - most) * num
        both_n = F.col("n") + F.col("hub_n")
        differ = reduce(lambda x, y: x + y, [F.bit_count(F.col("parity")[i].bitwiseXOR(F.col("hub_parity")[i])) for i in range(PARITY // 64)])
        reach = reach & ((both_n - differ) * den >= (both_n + differ) * num)
        pairs = (placed.join(hubs, "band").filter((F.col("component") != F.col("hub_component")) & reach)
                 .select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")).distinct())
        pairs = scratch.write(pairs, "pairs")
        side = lambda s: known.select(F.col("doc_id").alias(s), F.col("n").alias(f"n{s}"), F.col("regs").alias(f"r{s}"))
        near = pairs.join(side("a"), "a").join(side("b"), "b").filter(F.least("na", "nb") * den >= F.greatest("na", "nb") * num)
        near = near.mapInPandas(_ruled_in(num / den), "a bigint, b bigint")
        both = near.join(sets.select(F.col("doc_id").alias("a"), F.col("set").alias("sa")), "a").join(
            sets.select(F.col("doc_id").alias("b"), F.col("set").alias("sb")), "b")
        common = F.size(F.array_intersect("sa", "sb"))
        linked = both.filter(common * den >= (F.size("sa") + F.size("sb") - common) * num).select("a", "b")
        linked = scratch.write(linked, "links")
        if not links or not linked.isEmpty():
            links.append(linked)
            found = scratch.write(components(reduce(DataFrame.union, links), scratch), "components")
        gone = hubs.select("band", F.col("hub").alias("id"))
        members = scratch.write(placed.select("band", "id", "n", "own", "parity").join(gone, ["band", "id"], "left_anti"), "members")
        hubs_per_band *= 8

    scratch.keep_only(all_, classes, found)
    # A component is called by the least id of its classes.
    of_class = classes.join(found, F.col("node") == F.col("id"), "left").select("same", "rep", F.coalesce("component", "node").alias("component"))
    least = of_class.groupBy("component").agg(F.min("rep").alias("least"))
    of_class = of_class.join(least, "component").select("same", "least")
    out = all_.select("doc_id", F.col("n").alias("n_shingles"), "same").join(of_class, "same", "left")
    # A text without words lies with the other texts of its id.
    by_id = out.filter("doc_id is not null").groupBy("doc_id").agg(F.min("least").alias("of_id"))
    out = out.join(by_id, "doc_id", "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("of_id", "doc_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id"), F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept"))
