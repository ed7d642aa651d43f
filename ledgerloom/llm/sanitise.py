"""Personal data and the terms that give it away: patterns, then information-theoretic disclosure."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import Scratch, map_texts, text_of

KINDS = ("email", "ip", "card", "phone")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits is tried from its first one only: what fails there fails from the others.
IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]")
COUNT_BYTES = 8 << 20    # text whose terms a task counts before it gives them away


@dataclass(frozen=True)
class Params:
    """``window`` terms on either side of an entity are seen with it. A term is judged where at least
    ``contexts`` different surroundings of the entity hold it, and reveals the entity if it gives
    ``threshold`` of the entity's information. ``prefix`` characters stay of a generalised term."""

    window: int = 8
    contexts: int = 3
    threshold: float = 0.95
    prefix: int = 3


def emails(text: str) -> list[tuple[int, int]]:
    """Spans of addresses. The part before an ``@`` is the whole run before it, from the end of the
    last address on; where no domain follows, no start of that run matches."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            end = found.end()
            out.append((start, end))
        at = text.find("@", max(at + 1, end))
    return out


def luhn(digits: str) -> bool:
    doubled = (int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits)))
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def entities(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) by kind and start; equal values are one entity however they are written."""
    out = [("email", s, e, text[s:e].lower()) for s, e in emails(text)]
    out += [("ip", m.start(), m.end(), ".".join(p.lstrip("0") or "0" for p in m[0].split("."))) for m in IP.finditer(text)
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
    for kind, pattern, least, most in (("card", CARD, 13, 19), ("phone", PHONE, 9, 15)):
        for m in pattern.finditer(text):
            # Only as many characters as can hold the most digits and their separators need a look.
            digits = "".join(DIGITS.findall(m[0]))
            if least <= len(digits) <= most and (kind == "phone" or luhn(digits)):
                out.append((kind, m.start(), m.end(), digits))
    return out


def near(text: str, found: list[tuple[str, int, int, str]], window: int) -> list[dict]:
    """The terms around every entity that lie in no entity themselves, with a hash of the surroundings."""
    covered = sorted((s, e) for _, s, e, _ in found)
    spans, i, end = [], 0, -1
    for m in TERM.finditer(text):
        while i < len(covered) and covered[i][0] < m.end():
            end = max(end, covered[i][1])
            i += 1
        if m.start() >= end:
            spans.append(m.span())
    starts = [s for s, _ in spans]
    out = []
    for kind, s, e, value in found:
        around = spans[max(0, bisect_left(starts, s) - window):bisect_left(starts, s)] + spans[(j := bisect_left(starts, e)):j + window]
        terms = [b"".join(tokens.terms(text[x:y])).decode() for x, y in around]
        context = xxhash.xxh3_64_intdigest(" ".join(terms)) - (1 << 63)
        out += [{"entity": f"{kind}:{value}", "term": t, "start": x, "end": y, "context": context} for (x, y), t in zip(around, terms)]
    return out


FOUND = ("n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, base array<struct<kind:string,start:bigint,end:bigint>>, "
         "near array<struct<entity:string,term:string,start:bigint,end:bigint,context:bigint>>")


def as_text(found: list[tuple]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e, *_ in found)


def _find(window: int):
    def run(texts: list[str | None]) -> dict:
        out: dict = {f.split(" ")[0]: [] for f in re.split(r", (?=\w+ )", FOUND)}
        for text in texts:
            found = entities(text or "")
            n = Counter(k for k, *_ in found)
            for k in KINDS:
                out[f"n_{k}"].append(n[k])
            out["base_sha256"].append(hashlib.sha256(as_text(found).encode()).hexdigest())
            out["base"].append([{"kind": k, "start": s, "end": e} for k, s, e, _ in found])
            out["near"].append(near(text, found, window) if found else [])
        return out

    return run


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows(seen):
        return pa.RecordBatch.from_arrays([pa.array([t.decode("utf-8", "replace") for t in seen], pa.string()), pa.array(list(seen.values()), pa.int64())], names=["term", "n"])

    seen, held = Counter(), 0
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            for text in batch.column("text").slice(at, 256).to_pylist():
                seen.update(tokens.terms(text))
                held += len(text or "")
            if held > COUNT_BYTES:
                yield rows(seen)
                seen, held = Counter(), 0
    yield rows(seen)


def disclosure(both, term, entity, total):
    """Pointwise mutual information of term and entity over the entity's own information: 1 where the
    term stands nowhere but near the entity, 0 or less where it tells nothing of it."""
    known = F.log2(F.lit(total) / entity)
    return F.when(known > 0, F.log2(both * total / (term * entity)) / known).otherwise(0.0)


def revealing(docs: DataFrame, found: DataFrame, params: Params, scratch: Scratch) -> DataFrame:
    """Rows (entity, term, disclosure, general): the terms that reveal an entity, and what may stand in
    their place: the term's beginning where that reveals less than the threshold, else null.

    Pairs are counted over all entities of the corpus, terms over all texts. Surroundings that are
    word for word the same (copies) are one context. Counts are added up in the tasks before they
    are shuffled, so neither a frequent term nor a frequent entity gathers in one task."""
    each = found.select(F.explode("near").alias("x")).select("x.entity", "x.term", "x.context")
    pairs = scratch.write(each.groupBy("entity", "term", "context").count().groupBy("entity", "term")
                          .agg(F.sum("count").alias("both"), F.count(F.lit(1)).alias("contexts")), "pairs")
    counts = scratch.write(docs.select("text").mapInArrow(_count, "term string, n bigint").groupBy("term").agg(F.sum("n").alias("n")), "terms")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    own = pairs.groupBy("entity").agg(F.sum("both").alias("around"))
    tell = disclosure(F.col("both"), F.col("n"), F.col("around"), float(total))
    judged = pairs.filter(F.col("contexts") >= params.contexts).join(counts, "term").join(own, "entity")
    judged = judged.select("entity", "term", "around", tell.alias("disclosure")).filter(F.col("disclosure") >= params.threshold)
    judged = scratch.write(judged.withColumn("begin", F.substring("term", 1, params.prefix)), "judged")
    begins = judged.select("begin").distinct()
    all_begin = counts.withColumn("begin", F.substring("term", 1, params.prefix)).join(begins, "begin", "left_semi").groupBy("begin").agg(F.sum("n").alias("n"))
    both_begin = (pairs.withColumn("begin", F.substring("term", 1, params.prefix)).join(judged.select("entity", "begin").distinct(), ["entity", "begin"], "left_semi")
                  .groupBy("entity", "begin").agg(F.sum("both").alias("both")))
    wide = judged.join(both_begin, ["entity", "begin"]).join(all_begin, "begin")
    vague = (F.length("term") > params.prefix) & (disclosure(F.col("both"), F.col("n"), F.col("around"), float(total)) < params.threshold)
    return wide.select("entity", "term", "disclosure", F.when(vague, F.concat("begin", F.lit("*"))).alias("general"))


def find(docs: DataFrame, params: Params = Params(), text: bool = False) -> DataFrame:
    """Per document: doc_id (and ``text``), counts by kind, ``base_sha256`` of the base spans, and ``spans``, an
    array of (kind, start, end, general): base spans by kind as listed and start, then ``term`` spans
    by start. Offsets are code points. ``general`` is null but for generalised terms.

    A term span is an occurrence, within the window of an entity, of a term that reveals this
    entity (``revealing``). Documents without an entity have no spans. Null text is empty; every row
    is a document, also one that repeats another; null ids come back; other columns are ignored; an
    empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("bigint"), "text")
    keep = ["doc_id", "text"] if text else ["doc_id"]
    found = scratch.write(map_texts(rows, _find(params.window), FOUND, keep).withColumn("row", F.monotonically_increasing_id()), "found")
    known = scratch.write(revealing(rows, found, params, scratch), "revealing")
    seen = found.select("row", F.explode("near").alias("x")).select("row", "x.entity", "x.term", "x.start", "x.end")
    # One span may reveal several entities: it is generalised only if that hides it from all.
    hits = (seen.join(known, ["entity", "term"]).groupBy("row", "start", "end")
            .agg(F.when(F.count("general") == F.count(F.lit(1)), F.min("general")).alias("general"))
            .groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "end", "general"))).alias("hits")))
    span = "struct<kind:string,start:bigint,end:bigint,general:string>"
    base = F.transform("base", lambda b: F.struct(b["kind"].alias("kind"), b["start"].alias("start"), b["end"].alias("end"), F.lit(None).cast("string").alias("general")).cast(span))
    terms = F.transform(F.coalesce("hits", F.array().cast("array<struct<start:bigint,end:bigint,general:string>>")),
                        lambda h: F.struct(F.lit("term").alias("kind"), h["start"].alias("start"), h["end"].alias("end"), h["general"].alias("general")).cast(span))
    return found.join(hits, "row", "left").select(*keep, *(f"n_{k}" for k in KINDS), "base_sha256", F.concat(base, terms).alias("spans"))


def replace(text: str, spans: list) -> str:
    """Entities give way to their kind in brackets, revealing terms to their general form, or they go.
    Of overlapping spans the stretch they cover gives way once, to the first one's replacement."""
    out, at = [], 0
    for kind, start, end, general in sorted(((s["kind"], s["start"], s["end"], s["general"]) for s in spans), key=lambda s: (s[1], -s[2], KINDS.index(s[0]) if s[0] in KINDS else len(KINDS))):
        if start >= at:
            out += [text[at:start], (general or "") if kind == "term" else f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def sanitise(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """Rows (doc_id, text, spans, clean_text): the texts (null: empty) without their entities and revealing terms."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("general", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                b = batch.slice(at, 256)
                texts, spans = b.column("text").to_pylist(), b.column("spans").to_pylist()
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text"), pa.array(spans, kind), pa.array(list(map(replace, texts, spans)), pa.string())],
                                                 names=["doc_id", "text", "spans", "clean_text"])

    rows = find(docs.withColumn("text", text_of("text")), params, text=True).select("doc_id", "text", "spans")
    return rows.mapInArrow(run, "doc_id bigint, text string, spans array<struct<kind:string,start:bigint,end:bigint,general:string>>, clean_text string")
