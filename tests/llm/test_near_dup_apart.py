"""Near duplicates: groups whose members stay apart, and ids with several texts."""

import random

import numpy as np
import pytest

from ledgerloom.llm import near_dup
from ledgerloom.llm.common import Scratch


def apart(m, changed=5, length=300):
    rng = random.Random(m)
    base = [f"b{i}" for i in range(length)]
    rows = []
    for i in range(m):
        w = list(base)
        for p in rng.sample(range(length), changed):
            w[p] = f"x{rng.randrange(300)}"
        rows.append((i, " ".join(w)))
    return rows


def test_texts_that_stay_apart_are_not_paired(spark, monkeypatch):
    formed = []
    write = Scratch.write

    def counted(self, df, name):
        out = write(self, df, name)
        if name == "pairs":
            formed[-1] += out.count()
        return out

    monkeypatch.setattr(Scratch, "write", counted)
    for m in (200, 400):
        rows = apart(m)
        formed.append(0)
        got = {r.doc_id: r.component_id for r in near_dup.link(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
        sets = [frozenset(zip(*(w[k:] for k in range(5)))) for w in (t.split() for _, t in rows)]
        up = list(range(m))

        def find(x):
            while up[x] != x:
                x = up[x]
            return x

        for a in range(m):
            for b in range(a):
                k = len(sets[a] & sets[b])
                if 100 * k >= 85 * (len(sets[a]) + len(sets[b]) - k):
                    x, y = find(a), find(b)
                    up[max(x, y)] = min(x, y)
        assert got == {i: find(i) for i in range(m)}
    assert formed[1] < 400 * 399 / 2 / 20 and formed[1] <= 3 * max(formed[0], 400)


@pytest.mark.parametrize("n", [1, 40, 3000])
def test_parity_words_bound_the_difference(n):
    rng = np.random.default_rng(n)
    for share in (0.0, 0.5, 0.95, 1.0):
        k = int(n * share)
        u = rng.integers(0, 2**64, size=2 * n - k, dtype=np.uint64)
        a, b = np.sort(u[:n]), np.sort(u[n - k:])
        bits = sum(int(x).bit_count() for x in (near_dup.parity(a) ^ near_dup.parity(b)).view(np.uint64))
        assert bits <= 2 * (n - k) and len(near_dup.parity(a)) == near_dup.PARITY // 64


def test_an_id_with_several_texts_keeps_their_links(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(80)) for c in "ab")
    rows = [(1, a), (1, b), (2, a + " tail"), (3, b + " tail"), (4, "alone " * 3), (5, a), (6, "z1 z2 z3 z4 z5 z6"), (6, None), (6, a + " tail")]
    got = near_dup.link(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()
    assert len(got) == len(rows) and {r.doc_id: r.component_id for r in got} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 1, 6: 1}
    assert {(r.doc_id, r.kept) for r in got} == {(1, True), (2, False), (3, False), (4, True), (5, False), (6, False)}
