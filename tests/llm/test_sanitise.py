"""Personal data: patterns against re, disclosure against a plain computation."""

import collections
import hashlib
import math
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import sanitise
from ledgerloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    total = 0
    for i, c in enumerate(d[::-1]):
        v = int(c) * (2 if i % 2 else 1)
        total += v // 10 + v % 10
    return total % 10 == 0


def base(text):
    digits = lambda m: re.sub(r"[^0-9]", "", m[0])
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]


@settings(max_examples=600, deadline=None)
@given(st.one_of(st.text(alphabet=list("ab1@.-_ +é%"), max_size=40), st.text(alphabet=list("0123459. -+()a"), max_size=60),
                 st.lists(st.sampled_from(["a@b.c", "@", "x.y-z@d.e.f", "1.2.3.4", "256.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 010-9999", "+12", " ", "é", ".", "9"]), max_size=8).map("".join)))
def test_spans_equal_the_patterns(text):
    assert [f[:3] for f in sanitise.entities(text)] == base(text)


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000 + "@", "1" * 300_000 + ".", "+" + "1" * 300_000, "a.b@" * 50_000, "1." * 100_000, "+1" * 100_000):
        sanitise.entities(text)


def plain(rows, p):
    """(row, start, end) of revealing terms by the definition."""
    total, n, both, contexts, around, seen = 0, collections.Counter(), collections.Counter(), collections.defaultdict(set), collections.Counter(), []
    low = lambda s: s.translate({i: i + 32 for i in range(65, 91)})
    for k, (_, text) in enumerate(rows):
        text = text or ""
        words = [(low(m[0]), *m.span()) for m in sanitise.TERM.finditer(text)]
        n.update(w for w, *_ in words)
        total += len(words)
        found = sanitise.entities(text)
        free = [w for w in words if not any(s < w[2] and w[1] < e for _, s, e, _ in found)]
        for kind, s, e, value in found:
            near = [w for w in free if w[1] < s][-p.window:] + [w for w in free if w[1] >= e][:p.window]
            for w, x, y in near:
                key = (f"{kind}:{value}", w)
                both[key] += 1
                around[key[0]] += 1
                contexts[key].add(tuple(v for v, *_ in near))
                seen.append((k, x, y, key))

    def tell(b, t, e):
        return math.log2(b * total / (t * around[e])) / math.log2(total / around[e]) if total > around[e] else 0.0

    good = {}
    for (e, w), b in both.items():
        if len(contexts[e, w]) >= p.contexts and tell(b, n[w], e) >= p.threshold:
            begin = w[:p.prefix]
            vague = len(w) > p.prefix and tell(sum(c for (f, v), c in both.items() if f == e and v.startswith(begin) and (len(v) >= p.prefix or v == begin)),
                                               sum(c for v, c in n.items() if v[:p.prefix] == begin), e) < p.threshold
            good[e, w] = begin + "*" if vague else None
    return {(k, x, y) for k, x, y, key in seen if key in good}, good


def made():
    rng = random.Random(4)
    rows = []
    for i in range(240):
        w = [f"word{rng.randrange(60)}" for _ in range(40)]
        if i % 8 == 0:
            w[20] = "Margalit"                       # stands near this address only
            w[22] = "marg.lit@mail.example"
        elif i % 8 == 1:
            w[21], w[10] = "+1 (555) 010-9999", "wordless"
        elif i % 8 == 2:
            w[5] = "margin"
        rows.append((1000 + i, " ".join(w)))
    copy = "Zacharias lives at zach@mail.example and nowhere else"
    return rows + [(1300 + i, copy) for i in range(30)]  # copies are one context: no evidence


def test_terms_that_reveal(spark, odd, odd_rows, empty):
    rows = [(r[0], r[1]) for r in odd_rows] + made()
    df = odd.select("doc_id", "text", "n").union(spark.createDataFrame([(i, t, "x") for i, t in made()], "doc_id bigint, text string, n string")).repartition(4)
    for p in (sanitise.Params(), sanitise.Params(window=3, contexts=2, threshold=0.6, prefix=2)):
        hits, good = plain(rows, p)
        want = collections.Counter()
        for k, (i, text) in enumerate(rows):
            spans = base(text or "") + sorted(("term", x, y) for j, x, y in hits if j == k)
            want[i, tuple(spans)] += 1
        out = sanitise.find(df, p).collect()
        assert collections.Counter((r.doc_id, tuple((s.kind, s.start, s.end) for s in r.spans)) for r in out) == want
        assert {s.general for r in out for s in r.spans if s.kind == "term"} == set(good.values())
    _, good = plain(rows, sanitise.Params())
    assert ("email:marg.lit@mail.example", "margalit") in good and not any("zach" in e for e, _ in good)
    clean = {r.doc_id: r.clean_text for r in sanitise.sanitise(df).collect()}
    assert "Margalit" not in clean[1000] and "mar*" in clean[1000] and "[EMAIL]" in clean[1000] and "[PHONE]" in clean[1001] and clean[1300].startswith("Zacharias lives at [EMAIL]")
    assert clean[1002] == dict(made())[1002] and clean[4] == ""
    assert sanitise.find(empty).count() == 0 and sanitise.sanitise(empty).count() == 0


def test_replacements_do_not_overlap():
    span = lambda k, s, e, g=None: {"kind": k, "start": s, "end": e, "general": g}
    assert sanitise.replace("ab cd ef", [span("term", 3, 5), span("card", 0, 2), span("phone", 1, 4)]) == "[CARD] ef"
    assert sanitise.replace("ab cd ef", [span("term", 3, 5, "c*")]) == "ab c* ef"


def test_query(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op12_sanitisation"](spark, SF).collect()
    assert {r.doc_id for r in got} == set(texts) and len(got) == len(texts)
    for r in got:
        want = base(texts[r.doc_id])
        text = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        n = collections.Counter(k for k, *_ in want)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(n[k] for k in sanitise.KINDS) and r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert r.spans == text or r.spans.startswith(text + ",term:") or not text and not r.spans
