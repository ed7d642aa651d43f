"""Alignment of two tokenizers against a plain version of the contract."""

import collections
import hashlib
import itertools

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerloom.llm import alignment
from ledgerloom.llm.queries import QUERIES

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"
ODD = ["", " ", "  ", "a ", "a  b  ", "  lead", "x\n  y\n", "\n", "tab\t\tb \n c", "naïve Ünder ÀÉ", "<s> </s> <|endoftext|> <0x0A>", "a▁b", "日本 語 text", "it's we'll",
       "🙂 🙂", "\x00 \x7f", "nospace" * 80, "é ́x", "²³ ½", " a", "w " * 300, "word\r\nnext", "\t", "a\x85b c", "12 345 6789"]


class Plain:
    def __init__(self):
        self.a, self.b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
        self.a.encode_special_tokens = True
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.byte = {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in printable)}

    def __call__(self, text):
        """(ids of A, ids of B, groups as pairs of lists, links as pairs of ids) or None."""
        if not text:
            return None
        ids = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        pieces = ([bytes(self.byte[c] for c in self.a.id_to_token(i)) for i in ids[0]],
                  [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids[1], map(self.b.id_to_piece, ids[1]))])
        if any(b"".join(p) != (" " + text).encode() for p in pieces):
            return None
        ends = [list(itertools.accumulate(map(len, p))) for p in pieces]
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups, i, j = [], 0, 0
        at = [{e: k + 1 for k, e in enumerate(x)} for x in ends]
        for c in cuts:
            x, y = at[0][c], at[1][c]
            groups.append((ids[0][i:x], ids[1][j:y]))
            i, j = x, y
        spans = [list(zip([0, *e], e)) for e in ends]
        links, j = [], 0
        for (s, e), a in zip(spans[0], ids[0]):
            while spans[1][j][1] <= s:
                j += 1
            for (t, f), b in zip(itertools.islice(spans[1], j, None), itertools.islice(ids[1], j, None)):
                if t >= e:
                    break
                assert max(s, t) < min(e, f)
                links.append((a, b))
        return ids[0], ids[1], groups, links


@pytest.fixture(scope="module")
def plain():
    return Plain()


def truth(plain, rows):
    found = [(i, plain(t)) for i, t in rows]
    n = collections.Counter(x for _, f in found if f for x in f[3])
    most = collections.Counter()
    for (_, b), k in n.items():
        most[b] = max(most[b], k)
    out = collections.Counter()
    for i, f in found:
        if f is None:
            out[(i, 0, 0, 0, 0, 0, 0, "")] += 1
            continue
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in f[2])
        out[(i, len(f[0]), len(f[1]), len(f[2]), len(f[3]), sum(n[x] == most[x[1]] for x in f[3]), sum(n[x] for x in f[3]), hashlib.sha256(text.encode()).hexdigest())] += 1
    return out, n


def rows_of(df):
    return collections.Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect())


def test_alignment_equals_the_plain_version(spark, plain, odd, odd_rows, empty):
    rows = [(100 + i, t) for i, t in enumerate(ODD)]
    df = odd.select("doc_id", "text", "n").union(spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id bigint, text string, n string"))
    everything = [(r[0], r[1]) for r in odd_rows] + rows
    want, n = truth(plain, everything)
    assert rows_of(alignment.align(df, A, B)) == want
    assert {(r.a, r.b): r.n for r in alignment.links(df, A, B).collect()} == n
    got = [(r.doc_id, r.groups and [(list(g.a), list(g.b)) for g in r.groups]) for r in alignment.groups(df, A, B).collect()]
    assert sorted(got, key=str) == sorted(((i, f and f[2]) for i, f in ((i, plain(t)) for i, t in everything)), key=str)
    assert alignment.align(empty, A, B).count() == 0 and alignment.links(empty, A, B).count() == 0


def test_blocks_do_not_matter(plain, monkeypatch):
    two = alignment.Pair(A, B)
    texts = [t for t in ODD if t] * 2
    monkeypatch.setattr(alignment, "CACHE", 7)
    for t in texts:
        units = two.units(t)
        assert "".join(units) == " " + t
        found, want = two.look_up(units), plain(t)
        if want is None:
            assert None in found
            continue
        got = b"".join(x[4] for x in found).decode()
        assert got == "".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) + ";" for x, y in want[2])
        assert [sum(x[k] for x in found) for k in range(4)] == [len(want[0]), len(want[1]), len(want[2]), len(want[3])]


_two: list = []


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from(list("abcAB12 '.,\n\t<|>éßÑ  "))), max_size=60))
def test_units_equal_whole_texts(text):
    if not _two:
        _two.extend((alignment.Pair(A, B), Plain()))
    two, plain = _two
    want = plain(text)
    found = two.look_up(two.units(text))
    if want is None:
        assert not found or None in found
    else:
        assert b"".join(x[4] for x in found).decode() == "".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) + ";" for x, y in want[2])


def test_query(spark, plain):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").filter("length(text) < 6000").collect()]
    whole = {(r[0], *r[1:5], r[7]) for r in rows_of(QUERIES["op11_alignment"](spark, SF))}
    part, _ = truth(plain, texts)
    assert {(r[0], *r[1:5], r[7]) for r in part} <= whole and len(whole) == spark.read.parquet(f"{SF}/documents.parquet").count()
