"""Packing, token counts, near duplicates, substring dedup, toxicity and the pipeline."""

import collections
import itertools
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerloom.llm import near_dup, packing, substring_dedup, token_counts, tokens, toxicity
from ledgerloom.llm.encoders import Encoder

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ODD_TEXTS = ["", " ", "  a  b ", "it's we'll I'M x've", "a\n\n b\t\tc \r\n", "naïve Ünder ÀÉ 12ab34", "x<|endoftext|>y", "<|startoftext|> z", "日本語 text", "é ́x",
             "a\x85b c d\x1ce", "²³ ½ Ⅷ", "ΑΣ ΣΑΣ", "word " * 300, "!!!???...", "\x00\x7f", "İI ıi", "a​b", "🙂🙂 🙂"]


@pytest.fixture(scope="module")
def encoders():
    return Encoder(BYTES), Encoder(WORDS)


def test_encoders_equal_the_library(encoders):
    b, w = encoders
    assert b.pieces and w.by_word
    assert [list(x) for x in b.ids(ODD_TEXTS)] == [e.ids for e in Tokenizer.from_file(BYTES).encode_batch(ODD_TEXTS, add_special_tokens=False)]
    assert w.counts(ODD_TEXTS) == [len(e.ids) for e in Tokenizer.from_file(WORDS).encode_batch(ODD_TEXTS, add_special_tokens=False)]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from(list("abcAB12 '.,\n\t<|>éßÑ "))), max_size=60))
def test_encoders_equal_the_library_on_any_text(text):
    for path in (BYTES, WORDS):
        enc = _shared.setdefault(path, Encoder(path))
        want = enc.tokenizer.encode(text, add_special_tokens=False).ids
        assert (list(enc.ids([text])[0]) == want) if path == BYTES else (enc.counts([text]) == [len(want)])


_shared: dict = {}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 64), min_size=1, max_size=80))
def test_packing_is_sound_and_tight(lengths):
    bins, offset = packing.best_two_fit(np.array(lengths), 64)
    fill = collections.defaultdict(list)
    for x, b, o in zip(lengths, bins, offset):
        fill[b].append((o, x))
    for members in fill.values():
        at = 0
        for o, x in sorted(members):
            assert o == at
            at += x
        assert at <= 64
    # A greedy bin leaves no room for anything that is packed later.
    assert len(fill) <= 2 * -(-sum(lengths) // 64) + 1


def test_two_replace_the_smallest():
    # Greedy takes 6 and 3 of 10; 3 goes back for 2 and 2.
    bins, _ = packing.best_two_fit(np.array([6, 3, 2, 2]), 10)
    assert bins[0] == bins[2] == bins[3] != bins[1]


def test_pack_cuts_and_places(spark, odd, odd_rows, empty):
    got = packing.pack(odd, BYTES, length=512, bucket_pieces=8).collect()
    tok = Tokenizer.from_file(BYTES)
    want = collections.Counter()
    for i, text, *_ in odd_rows:
        ids = tok.encode(text or "", add_special_tokens=False).ids + [0]
        first = (len(ids) - 1) % 512 + 1
        for p, (x, y) in enumerate(itertools.pairwise([0, *range(first, len(ids) + 1, 512)])):
            want[(i, p, x, tuple(ids[x:y]))] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, tuple(np.frombuffer(bytes(r.ids), "<u4").tolist())) for r in got) == want
    seqs = collections.defaultdict(list)
    for r in got:
        assert r.length == len(r.ids) // 4
        seqs[r.sequence_id].append((r.offset, r.length))
    for s in seqs.values():
        s.sort()
        assert [o for o, _ in s] == [0, *itertools.accumulate(n for _, n in s)][:-1] and sum(n for _, n in s) <= 512
    assert packing.pack(empty, BYTES).count() == 0


@pytest.mark.parametrize(("chunk", "overlap"), [(1 << 15, 256), (40, 4), (64, 1)])
def test_spliced_counts(spark, odd, odd_rows, empty, chunk, overlap):
    texts = [(100 + i, t) for i, t in enumerate(ODD_TEXTS)] + [(200, "nospace" * 60), (201, "a<|endoftext|>" * 30)]
    df = odd.select("doc_id", "text", "n", "row").union(spark.createDataFrame(texts, "doc_id bigint, text string").withColumn("n", F.lit("x")).withColumn("row", F.lit("x")))
    tok = Tokenizer.from_file(WORDS)
    want = collections.Counter((i, len((t or "").encode()), len(tok.encode(t or "", add_special_tokens=False).ids)) for i, t in [(r[0], r[1]) for r in odd_rows] + texts)
    assert collections.Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in token_counts.token_counts(df, WORDS, chunk, overlap).collect()) == want
    assert token_counts.token_counts(empty, WORDS).count() == 0


def near_truth(rows, num=85):
    sets, up = {}, {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        sets.setdefault(i, set()).update(tuple(w[j:j + 5]) for j in range(len(w) - 4)) if len(w) >= 5 else sets.setdefault(i, set()).update({tuple(w)} if w else set())
        up[i] = i

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in itertools.combinations([i for i in sets if sets[i]], 2):
        k = len(sets[a] & sets[b])
        if 100 * k >= num * (len(sets[a]) + len(sets[b]) - k):
            x, y = find(a), find(b)
            up[max(x, y)] = min(x, y)
    return sets, {i: find(i) for i in up}


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for g in range(14):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([4, 6, 20, 90, 300]))]
        for _ in range(rng.choice([1, 3, 14])):
            copy = list(base)
            for _ in range(rng.randrange(0, max(1, len(base) // 40) + 1)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(copy)))
    rng.shuffle(rows)
    sets, want = near_truth(rows)
    got = near_dup.link(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert all(r.n_shingles == len(sets[r.doc_id]) and r.kept == (r.doc_id == want[r.doc_id]) for r in got)


def test_near_duplicates_of_odd_rows(odd, odd_rows, empty):
    sets, want = near_truth([(r[0], r[1]) for r in odd_rows if r[0] is not None])
    got = near_dup.link(odd).collect()
    assert len(got) == len(odd_rows) and {r.doc_id: r.component_id for r in got if r.doc_id is not None} == want
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)]
    assert near_dup.link(empty).count() == 0


def test_estimate_is_near_the_truth():
    rng = np.random.default_rng(4)
    for n, share in ((40, 0.9), (3000, 0.85), (3000, 0.3)):
        found = []
        for _ in range(40):
            u = rng.integers(0, 2**64, size=2 * n, dtype=np.uint64)
            k = int(n * 2 * share / (1 + share))
            a, b = np.sort(u[:n]), np.sort(u[n - k:2 * n - k])
            same = np.count_nonzero(near_dup.registers(a) == near_dup.registers(b))
            found.append(near_dup.estimate(np.array([same], float), np.array([n]), np.array([n]))[0] - k / (2 * n - k))
        assert abs(np.mean(found)) < 0.03


def repeats_truth(rows, length):
    docs = {i: (t or "").encode().split() for i, t in rows}
    first = {}
    for i in sorted(docs):
        for j in range(len(docs[i]) - length + 1):
            first.setdefault(tuple(docs[i][j:j + length]), i)
    out = {}
    for i, w in docs.items():
        gone = set()
        for j in range(len(w) - length + 1):
            if first[tuple(w[j:j + length])] < i:
                gone |= set(range(j, j + length))
        out[i] = (len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode())
    return out


def test_repeats_equal_brute_force(spark):
    rng = random.Random(2)
    shared = [[f"p{k}_{i}" for i in range(rng.choice([49, 50, 51, 75, 130]))] for k in range(6)]
    rows = []
    for i in range(60):
        w = []
        for _ in range(rng.randrange(1, 5)):
            w += [f"u{rng.randrange(40)}" for _ in range(rng.randrange(30))]
            if rng.random() < 0.7:
                p = rng.choice(shared)
                a = rng.randrange(len(p) // 3)
                w += p[a:] if rng.random() < 0.5 else p
        rows.append((i, " ".join(w)))
    rows += [(60, rows[3][1]), (61, rows[3][1]), (62, "z " * 200), (63, "z " * 120)]
    got = substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in got} == repeats_truth(rows, 50)


def test_repeats_of_odd_rows(odd, odd_rows, empty):
    want = repeats_truth([(r[0], r[1]) for r in odd_rows if r[0] is not None], 50)
    got = substring_dedup.remove_repeats(odd).collect()
    assert len(got) == len(odd_rows)
    for r in got:
        if r.doc_id is None:
            assert r.n_removed == 0
        else:
            assert (r.n_words, r.n_removed, r.kept_text) == want[r.doc_id]
    assert substring_dedup.remove_repeats(empty).count() == 0
    cut = substring_dedup.cut_repeats(odd)
    assert cut.columns == odd.columns
    assert {r.doc_id for r in cut.collect()} == {r[0] for r in odd_rows} - {i for i, v in want.items() if v[0] and v[0] == v[1]}


def test_rolling_hashes_tell_sequences():
    h = tokens.hashes([b"a", b"b", b"a", b"b", b"a", b"c"])
    for k in (1, 2, 3, 5):
        r = tokens.rolling(h, k)
        grams = [tuple(h[i:i + k]) for i in range(len(h) - k + 1)]
        assert len(r) == len(grams) and len(set(r.tolist())) == len(set(grams))
        assert [grams.index(g) for g in grams] == [r.tolist().index(x) for x in r.tolist()]
    assert len(tokens.rolling(h, 7)) == 0


def test_toxic_words_are_learned(spark, odd, empty):
    rng = random.Random(8)
    docs, labels = [], []
    for i in range(900):
        w = [f"w{rng.randrange(300)}" for _ in range(60)]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(3):
                w[rng.randrange(60)] = rng.choice(["Vile!", "nasty,", "foul"])
        docs.append((i, " ".join(w)))
        if i % 2 and i < 300 or toxic and i < 300:
            labels.append((i, int(toxic)))
    d, lab = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")
    got = toxicity.detect(d.union(odd.select("doc_id", "text")), lab, F.col("doc_id") >= 500).collect()
    unseen = [r for r in got if r.held_out and r.doc_id is not None]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got) and len(unseen) == 400
    assert sum(r.predicted != (r.doc_id % 6 == 0) for r in unseen) <= 8
    assert all(r.score < 0.3 for r in toxicity.detect(d, lab.filter("false"), F.lit(False)).collect())
    assert toxicity.detect(empty, lab, F.lit(False)).count() == 0


def test_non_negative_risk_keeps_the_prior():
    rng = np.random.default_rng(1)
    p = np.c_[np.ones(200), rng.integers(0, 2, (200, 5))].astype(float)
    hidden = rng.random(2000) < 0.2
    u = np.c_[hidden, rng.integers(0, 2, (2000, 5))].astype(float)
    w, b = toxicity.fit_nnpu(p, u, 0.2)
    s = 1 / (1 + np.exp(-(u @ w + b)))
    assert s[hidden].mean() > 0.9 and s[~hidden].mean() < 0.05 and s.mean() == pytest.approx(0.2, abs=1e-3)


def test_pipeline_stages_on_odd_rows(spark, odd, empty, tmp_path):
    spark.createDataFrame([(1, 0)], "doc_id bigint, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for docs in (odd, empty):
        for name, stage in corpus_pipeline.STAGES:
            docs.write.mode("overwrite").parquet(str(tmp_path / f"in_{name}"))
            docs = stage(spark, spark.read.parquet(str(tmp_path / f"in_{name}")), str(tmp_path))
            if name != corpus_pipeline.STAGES[-1][0]:
                assert docs.columns == odd.columns
    assert docs.count() == 0


def test_pipeline_equals_its_stages_by_brute_force(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = corpus_pipeline.drop_toxic(spark, docs, sf)
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    _, group = near_truth(rows, 80)
    near = corpus_pipeline.drop_near_duplicates(spark, kept, sf)
    rest = [(r.doc_id, r.text) for r in near.collect()]
    assert sorted(rest) == sorted((i, t) for i, t in rows if group[i] == i)
    cut = {r.doc_id: r.text for r in corpus_pipeline.drop_repeats(spark, near, sf).collect()}
    want = repeats_truth(rest, 50)
    assert cut == {i: (t if not want[i][1] else want[i][2]) for i, t in rest if not want[i][1] or want[i][2]}


def test_unlike_sets_share_no_band():
    rng = np.random.default_rng(6)
    keys = [near_dup.band_keys(near_dup.registers(np.sort(rng.integers(0, 2**64, size=500, dtype=np.uint64)))) for _ in range(400)]
    assert len(np.unique(np.concatenate(keys))) == 400 * near_dup.BANDS
