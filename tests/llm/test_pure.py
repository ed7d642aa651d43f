"""Sharding, mixing, multiset hash, chat formatting, decision lists."""

import collections
import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.llm import chat_format as cf
from ledgerloom.llm import decision_list as dl
from ledgerloom.llm import mixing, sharding
from ledgerloom.llm import multiset_hash as mh
from ledgerloom.llm.common import Scratch, components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_shards_hold_all_rows_evenly(spark, odd, odd_rows, empty):
    got = sharding.shuffle_into_shards(odd, shards=4, bucket_rows=3)
    rows = got.select("record.doc_id", "record.text", "record.shard", F.col("shard").alias("s"), "slot").collect()
    assert sorted((str(r[0]), str(r[1])) for r in rows) == sorted((str(r[0]), str(r[1])) for r in odd_rows)
    assert {r[2] for r in rows} == {"extra"}
    per = collections.defaultdict(list)
    for r in rows:
        per[r.s].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in per.values())
    assert max(map(len, per.values())) - min(map(len, per.values())) <= 1
    again = {(r.doc_id, r.s, r.slot) for r in sharding.shuffle_into_shards(odd, shards=4, bucket_rows=3).select("record.doc_id", F.col("shard").alias("s"), "slot").collect()}
    assert again == {(r.doc_id, r.s, r.slot) for r in rows}
    assert sharding.shuffle_into_shards(empty).count() == 0


def test_shards_are_written_in_slot_order(spark, odd, tmp_path):
    ids = spark.range(200).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    got = sharding.shuffle_into_shards(ids, shards=4, bucket_rows=20)
    sharding.write_shards(got, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 200 and back.select("_shard").distinct().count() == 4
    order = [r.doc_id for r in got.filter("shard = 0").orderBy("slot").select("record.doc_id").collect()]
    assert order != sorted(order)


def test_targets_share_the_excess():
    t = mixing.targets({"a": 10, "b": 1000, "c": 1000, None: 0})
    assert t["a"] == 20 and t[None] == 0
    assert sum(t.values()) == pytest.approx(1.5 * 2010) and all(v <= 2 * s for v, s in ((t["b"], 1000), (t["c"], 1000)))
    assert mixing.targets({}) == {}


def test_permutation_is_one(spark):
    for n in (1, 2, 7, 64, 101):
        got = [r[0] for r in spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("bigint"), F.lit(3), F.lit(5))).collect()]
        assert sorted(got) == list(range(n))


def test_mix_takes_whole_words_near_targets(spark, odd, odd_rows, empty):
    placed, spans = mixing.mix(odd, block=8)
    got = mixing.taken(placed, spans).collect()
    assert len(got) == len(odd_rows)
    words = {}
    for r in odd_rows:
        words[r[3]] = words.get(r[3], 0) + len(WORD.findall(r[1] or ""))
    taken, target = collections.Counter(), {}
    for r in got:
        assert r.taken <= 2 * r.size and r.source_size == words[r.source]
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) <= 8 for s in target)
    assert sum(target.values()) == pytest.approx(1.5 * sum(words.values()))
    docs = mixing.mixed_documents(odd, spans)
    assert docs.columns == odd.columns
    text = {r[0]: WORD.findall(r[1] or "") for r in odd_rows}
    for r in docs.collect():
        it = iter(text[r.doc_id])
        assert all(w in it for w in WORD.findall(r.text)) and r.n_chars == len(r.text)
    assert sum(len(WORD.findall(r.text)) for r in docs.collect()) <= sum(taken.values())
    assert mixing.taken(*mixing.mix(empty)).count() == 0


def test_multiset_hash_is_homomorphic(spark):
    rows = [(1, "a b c\nd e\nd e"), (2, "d e\na b c\nd e"), (3, "d e"), (4, "a b c\nd e"), (5, None), (6, ""), (7, "a b c\n\nd e")]
    f = {r.k: r for r in mh.fingerprints(spark.createDataFrame(rows, "k int, text string"), ["k"]).collect()}
    key = lambda r: (r.pieces, tuple(r.wide), tuple(r.narrow))
    assert key(f[1]) == key(f[2]) != key(f[4]) and key(f[5]) == key(f[6]) and key(f[7]) != key(f[4])
    p = mh.fingerprints(spark.createDataFrame(rows, "k int, text string"), ["k"]).select("k", F.struct("pieces", "wide", "narrow").alias("f"))
    three = p.filter("k = 3").select(F.col("f").alias("x"))
    four = p.filter("k = 4").select(F.col("f").alias("y"))
    one = p.filter("k = 1").select(F.col("f").alias("z"))
    r = four.join(three).join(one).select(mh.combine("x", "y").alias("sum"), mh.combine("z", "x", -1).alias("less"), "y", "z").first()
    assert r.sum == r.z and r.less == r.y


def test_edits_and_likeness(spark, odd, odd_rows, empty):
    out = mh.fingerprint_edits(odd).withColumn("f", mh.as_text("own")).collect()
    assert len(out) == len(odd_rows)
    by_id = collections.defaultdict(set)
    for r in odd_rows:
        by_id[r[0]].add(r[1] or "")
    ids = sorted(i for i in by_id if i is not None)
    prints = {}
    for r in out:
        text = next(t for t in by_id[r.doc_id] if len(t) == r.n_chars)
        k = len(text) // 4
        head = min(by_id[ids[(ids.index(r.doc_id) + 1) % len(ids)]]) if r.doc_id is not None else ""
        assert r.edited_sha256 == hashlib.sha256((text[: len(text) - k] + head[:k]).encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and (r.near_next is None) == (r.doc_id is None)
        assert prints.setdefault(text, r.f) == r.f
    assert len(set(prints.values())) == len(prints)
    assert next(r for r in out if r.doc_id == 1).near_next == 1.0
    assert next(r for r in out if r.doc_id == 9).near_edited > 0.6
    assert mh.fingerprint_edits(empty).count() == 0


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(alphabet="<|\\>im_endsa \n", max_size=12), min_size=1, max_size=20))
def test_escape_round_trip(spark, texts):
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", cf.escape(F.col("t")).alias("e")).withColumn("u", cf.unescape(F.col("e"))).collect()
    assert all(r.u == r.t and "<|" not in r.e for r in got)


def test_chats_read_back(spark):
    rng = random.Random(5)
    parts = ["<|im_end|>", "<|im_start|>", "assistant", "<\\|", "x", "\n", "<", "é", "<|im_sep|>", "<|nl|>"]
    rows = [(c, t, rng.choice(["user", "assistant", "assistant", None, "sys\ntem", "<|nl|>"]), rng.choice([None, "".join(rng.choices(parts, k=rng.randrange(9)))]))
            for c in (1, 2, 3, None) for t in range(rng.randrange(1, 9))] + [(4, None, "user", "b"), (4, None, "user", "a"), (4, 0, "user", "a"), (4, 0, "user", "a")]
    rows += [(5, i, "assistant" if i % 3 else "user", f"t{i}") for i in range(1300)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("turns", F.lit("extra")).withColumn("mask", F.lit(0))
    for r in cf.read_back(cf.format_conversations(df)).collect():
        own = sorted(((t is not None, t or 0, ro or "", x or "") for c, t, ro, x in rows if c == r.conv_id))
        assert [(x.role, x.text) for x in r.turns] == [(o[2], o[3]) for o in own]
        assert r.loss_text == "".join(o[3] for o in own if o[2] == "assistant")
    assert cf.format_conversations(df.filter("false")).count() == 0
    merged = cf.format_conversations(spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "user", "b")], "conv_id int, turn int, role string, text string")).first()
    assert merged.formatted == "<|im_start|>user\na<|im_sep|>b<|im_end|>\n" and merged["mask"] == []


def test_base_statistics(spark, odd, odd_rows):
    got = {(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in dl.statistics(odd).collect()}
    want = set()
    for i, text, *_ in odd_rows:
        text = text or ""
        w = WORD.findall(text)
        c = collections.Counter(zip(w, w[1:], w[2:]))
        covered = {k for j in range(len(w) - 2) if c[tuple(w[j:j + 3])] > 1 for k in (j, j + 1, j + 2)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        want.add((i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)))
    assert got == want


def test_learned_rules_find_the_marked_rows(spark, empty):
    rng = random.Random(1)
    docs, labels = [], []
    for i in range(600):
        bad = i % 5 == 0
        docs.append((i, " ".join(f"word{rng.randrange(5000)}" + ("###" if bad and i % 2 else "!!!" if bad else "") for _ in range(80))))
        if i < 400:
            labels.append((i, 0 if bad else 1))
    d, lab = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, quality int")
    got = dl.judge(d, lab).collect()
    unseen = [r for r in got if r.doc_id >= 400]
    assert sum(r.kept == (r.doc_id % 5 == 0) for r in unseen) <= 6 and all(r.kept for r in unseen if r.doc_id % 5)
    assert len({r.rule for r in got}) >= 2
    assert all(r.kept for r in dl.judge(d, lab.filter("false")).collect()) and dl.judge(empty, lab).count() == 0


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1100)] + [(2000, i) for i in range(1900, 1990)]
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            up[max(x, y)] = min(x, y)
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint"), Scratch(spark)).collect()}
    assert got == {x: find(x) for x in list(up)}
