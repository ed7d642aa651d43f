"""Toxicity scores by non-negative positive-unlabelled learning."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, map_texts, text_of

# ASCII punctuation separates words, A-Z become small; other bytes stay.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else 32 if c < 48 or 57 < c < 65 or 90 < c < 97 or 122 < c < 128 else c for c in range(256))


@dataclass(frozen=True)
class Params:
    positives: int = 4_000       # bound on the confirmed examples that the classifier is fitted on
    unlabelled: int = 20_000     # bound on the unlabelled texts of the fit
    candidates: int = 4_096      # words most frequent in confirmed examples that are counted everywhere
    features: int = 512          # of them, those that set the examples apart most
    least_apart: float = 4.0     # standard errors
    min_examples: int = 3        # confirmed examples that a word must occur in
    prior: float = 0.05          # share of toxic texts where the labels do not tell
    epochs: int = 1500
    rate: float = 0.3
    decay: float = 1e-6
    tolerance: float = 0.2       # share of the prior by which the negatives' risk may fall below zero


def _terms(text: str) -> np.ndarray:
    """64-bit hashes of the distinct words of a whole text."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, set(text.encode("utf-8", "surrogatepass").translate(_TABLE).split())), dtype=np.uint64)


def _vocabulary(terms: np.ndarray):
    """Sorted terms and a function from a text to the places of its words among them."""
    def places(text: str) -> np.ndarray:
        return np.flatnonzero(np.isin(terms, _terms(text)))

    return places


def _term_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        found = [_terms(t) for t in b["text"]]
        terms, n = np.unique(np.concatenate(found), return_counts=True) if found else (np.empty(0, np.uint64), np.empty(0, int))
        yield pd.DataFrame({"term": terms.view(np.int64), "n": n})


def _known_counts(terms: np.ndarray):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        places = _vocabulary(terms)
        for b in batches:
            n = np.zeros(len(terms), dtype=np.int64)
            for t in b["text"]:
                n[places(t)] += 1
            yield pd.DataFrame({"term": terms[n > 0].view(np.int64), "n": n[n > 0]})

    return run


def _rows(terms: np.ndarray):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        places = _vocabulary(terms)
        for b in batches:
            yield pd.DataFrame({"positive": b["positive"], "at": [places(t) for t in b["text"]]})

    return run


def fit_nnpu(p: np.ndarray, u: np.ndarray, prior: float, params: Params = Params()) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic classifier from rows of positives ``p`` and unlabelled ``u``.

    The risk is prior * E_p[l(+)] + max(0, E_u[l(-)] - prior * E_p[l(-)]): unlabelled rows stand
    for negatives once the share of positives among them is taken out. Where that estimate of
    the negatives' risk falls below zero by more than the tolerance, the step climbs it instead
    (non-negative PU learning), which keeps the classifier from fitting the unlabelled rows one
    by one. At the minimum the mean score of unlabelled rows is the prior; the bias is set so.
    """
    w, b = np.zeros(p.shape[1]), float(np.log(prior / (1 - prior)))
    speed = np.zeros(p.shape[1] + 1)
    for _ in range(params.epochs):
        sp, su = 1 / (1 + np.exp(-(p @ w + b))), 1 / (1 + np.exp(-(u @ w + b)))
        negative = np.mean(-np.log1p(-np.minimum(su, 1 - 1e-12))) - prior * np.mean(-np.log1p(-np.minimum(sp, 1 - 1e-12)))
        # Gradients of the mean losses in the scores: of l(+), sp - 1; of l(-), s.
        g_pos, g_neg = (sp - 1) / len(sp), (su / len(su), -prior * sp / len(sp))
        if negative >= -params.tolerance * prior:
            gw, gb = prior * (p.T @ g_pos) + u.T @ g_neg[0] + p.T @ g_neg[1], prior * g_pos.sum() + g_neg[0].sum() + g_neg[1].sum()
        else:
            gw, gb = -(u.T @ g_neg[0] + p.T @ g_neg[1]), -(g_neg[0].sum() + g_neg[1].sum())
        g = np.append(gw + params.decay * w, gb)
        speed = 0.9 * speed + 0.1 * g * g
        step = params.rate * g / (np.sqrt(speed) + 1e-4) / 10
        w, b = w - step[:-1], b - step[-1]
    low, high = -30.0, 30.0
    for _ in range(60):
        b = (low + high) / 2
        low, high = (b, high) if np.mean(1 / (1 + np.exp(-(u @ w + b)))) < prior else (low, b)
    return w, float(b)


def _bounded(ids: DataFrame, most: int, scratch: Scratch) -> DataFrame:
    """About ``most`` distinct ids at most, picked by a hash, fit for a broadcast: their number is
    counted again after the pick."""
    n = ids.count()
    if n > most:
        ids = ids.filter(F.pmod(F.xxhash64(F.lit(41), "doc_id"), F.lit(1_000_000)) < int(1_000_000 * most / n))
    ids = scratch.write(ids.distinct(), "picked")
    return F.broadcast(ids) if ids.count() <= 2 * most else ids


@dataclass(frozen=True)
class Model:
    terms: np.ndarray
    weights: np.ndarray
    bias: float


def train(docs: DataFrame, labels: DataFrame, may_learn: Column, params: Params = Params()) -> Model:
    """A model from the documents whose row satisfies ``may_learn`` (an expression of ``doc_id``).

    Confirmed examples are those labelled toxic (a bounded pick of them), and the class prior is
    the labels' share of toxic rows. Words enter by how much more of the examples than of the
    other texts they occur in, in standard errors; the counts of the others cover all documents.
    Only the bounded picks meet the texts in a join, as a broadcast of ids. The driver gets counts of at most ``candidates`` words and the feature rows of the
    bounded fit. Without examples or unlabelled texts the model is the prior alone.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    known = labels.filter(may_learn).filter("toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = scratch.write(known.withColumn("labelled", F.lit(True)), "known")
    toxic, rows = known.agg(F.sum("toxic"), F.count(F.lit(1))).first()
    prior = min(0.9, max(0.001, toxic / rows)) if toxic else params.prior
    texts = docs.filter(may_learn).select("doc_id", text_of("text").alias("text"))
    picked = _bounded(known.filter("toxic = 1").select("doc_id"), params.positives, scratch)
    p = scratch.write(texts.join(picked, "doc_id", "left_semi"), "examples")
    # Unlabelled are ids without a label.
    ids = scratch.write(texts.select("doc_id").join(known.select("doc_id"), "doc_id", "left_anti"), "unlabelled")
    n_p, n_u = p.count(), ids.count()
    blank = Model(np.empty(0, np.uint64), np.empty(0), float(np.log(prior / (1 - prior))))
    if not n_p or not n_u:
        return blank
    count = "term bigint, n bigint"
    frequent = p.select("text").mapInPandas(_term_counts, count).groupBy("term").agg(F.sum("n").alias("n")).filter(F.col("n") >= params.min_examples)
    frequent = frequent.orderBy(F.desc("n"), "term").limit(params.candidates).toPandas().sort_values("term")
    if frequent.empty:
        return blank
    terms = np.sort(frequent["term"].to_numpy().view(np.uint64))
    # Over all documents that may be learned from, labelled ones included; examples are taken out.
    everywhere = texts.select("text").mapInPandas(_known_counts(terms), count).groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    in_p = pd.Series(frequent["n"].to_numpy(), index=frequent["term"].to_numpy().view(np.uint64)).reindex(terms).to_numpy(dtype=float)
    in_all = pd.Series(everywhere["n"].to_numpy(), index=everywhere["term"].to_numpy().view(np.uint64)).reindex(terms).fillna(0).to_numpy(dtype=float)
    n_all = n_u + rows
    share_u = np.clip((in_all - in_p) / max(1, n_all - n_p), 0, 1)
    # One more example than chance is added to the spread, or rare words would pass by luck.
    expected = n_p * share_u
    apart = (in_p - expected) / np.sqrt(expected + 1)
    chosen = np.sort(np.argsort(-apart, kind="stable")[: params.features])
    chosen = chosen[apart[chosen] > params.least_apart]
    if not len(chosen):
        return blank
    terms = terms[chosen]

    sample_p = p.select("text", F.lit(True).alias("positive"))
    sample_u = texts.join(_bounded(ids, params.unlabelled, scratch), "doc_id", "left_semi").select("text", F.lit(False).alias("positive"))
    got = sample_p.union(sample_u).mapInPandas(_rows(terms), "positive boolean, at array<int>").toPandas()
    x = np.zeros((len(got), len(terms)))
    for i, at in enumerate(got["at"]):
        x[i, at] = 1
    positive = got["positive"].to_numpy(dtype=bool)
    if positive.all() or not positive.any():
        return blank
    w, b = fit_nnpu(x[positive], x[~positive], prior, params)
    scratch.keep_only()
    return Model(terms, w, b)


def score(docs: DataFrame, model: Model, columns: list[str], into: str = "score") -> DataFrame:
    """``columns`` of ``docs`` and the score (0 to 1, as column ``into``) of every whole text; null and empty texts
    have no words, so their score is the bias."""
    def run(texts):
        places = _vocabulary(model.terms)
        z = np.array([model.bias + model.weights[places(t or "")].sum() for t in texts], dtype=float)
        return {into: 1 / (1 + np.exp(-z))}

    return map_texts(docs, run, f"{into} double", columns)


def detect(docs: DataFrame, labels: DataFrame, held_out: Column, threshold: float = 0.3, params: Params = Params()) -> DataFrame:
    """Rows (doc_id, held_out, score, predicted) for every document. Rows for which ``held_out``
    (an expression of ``doc_id``; null counts as held out) holds are never learned from. Repeated
    rows are scored each; other columns are ignored; an empty table gives no rows."""
    out = F.coalesce(held_out, F.lit(True))
    model = train(docs, labels, ~out, params)
    scored = score(docs.select("doc_id", "text"), model, ["doc_id"])
    return scored.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
