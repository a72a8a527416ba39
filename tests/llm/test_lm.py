from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallymart.llm import lm as L


def brute(rows):
    """Base and Kneser-Ney scores of (doc_id, text) rows with plain counters."""
    split = lambda t: ["<s>", *[w for w in (t or "").encode().lower().split()], "</s>"]
    out_of = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0
    train = [split(t) for i, t in rows if not out_of(i)]
    c = Counter(w for t in train for w in t[1:])
    n, v = sum(c.values()), len(c)
    pairs = Counter(p for t in train for p in zip(t, t[1:]))
    ends = Counter(b for _, b in pairs)
    often, end_often = Counter(pairs.values()), Counter(ends.values())
    d = L.discounts(tuple(often[k] for k in (1, 2, 3, 4)))
    e = L.discounts(tuple(end_often[k] for k in (1, 2, 3, 4)))
    totals, kinds = Counter(), defaultdict(Counter)
    for (a, _), k in pairs.items():
        totals[a] += k
        kinds[a][min(k, 3)] += 1
    all_ends = sum(ends.values())

    freed = sum(e[min(k, 3)] for k in ends.values()) / max(all_ends, 1)

    def single(w):
        if not all_ends:
            return 1 / (v + 1)
        return max(ends[w] - e[min(ends[w], 3)], 0) / all_ends + freed / (v + 1)

    def p(a, w):
        if not totals[a]:
            return single(w)
        k = pairs[a, w]
        rest = sum(d[j] * m for j, m in kinds[a].items()) / totals[a]
        return max(k - d[min(k, 3)], 0) / totals[a] + rest * single(w)

    for a in ["<s>", *list(c)[:5]]:
        assert math.isclose(sum(p(a, w) for w in c) + p(a, "unseen"), 1, rel_tol=1e-9)
    out = []
    for i, t in rows:
        s = split(t)
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in s[1:])
        out.append((i, out_of(i), len(s) - 1, sum(w in c for w in s[1:]), n, base, sum(math.log10(p(a, b)) for a, b in zip(s, s[1:]))))
    return out


def same(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:7] for g in got], [w[5:7] for w in want], rtol=1e-9)


def score(docs, ranges=None):
    model = L.train(docs.where(~L.held_out()).select("text"), ranges)
    return [
        (r.doc_id, r.h, r.n_tokens, r.n_known, model.tokens, r.base_score, r.score)
        for r in L.score_texts(docs, model).withColumn("h", L.held_out()).collect()
    ]


def test_whole_table(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = [tuple(r)[:7] for r in L.op7_lm_scoring(spark, sf_dir).collect()]
    same(got, brute(rows))


@pytest.mark.parametrize("ranges", [1, 2, 64])
def test_unusual_rows(docs, ranges):
    rows = [(i, t) for i, t in enumerate(["a b a B", None, "", "a\x0bb\u00a0c É é", "z " * 5000, "a b", "a b", "b a b c d"])]
    rows += [(None, "a q"), (3, "a\x0bb\u00a0c É é"), (60, "a new b"), (61, "never seen at all")]
    same(score(docs(*rows).repartition(3), ranges), brute(rows))


def test_empty_tables(docs):
    assert score(docs((1, "a")).limit(0)) == []
    only_held_out = [(i, "a b") for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0][:2]
    same(score(docs(*only_held_out)), brute(only_held_out))


def test_arrays():
    x = np.random.default_rng(1).integers(0, 1 << 63, 1000).astype(np.uint64)
    assert (L.unmix(L.mix(x)) == x).all()
    assert L.discounts((0, 0, 0, 0)).tolist() == [0, 0.5, 0.5, 0.5]
    rows = np.zeros(4, L.PAIR)
    rows["key"], rows["count"] = [5, 1, 5, 1 << 63], [1, 2, (1 << 32) - 2, 1]
    assert L.merged([rows], "key")["count"].tolist() == [2, (1 << 32) - 1, 1]
    with pytest.raises(OverflowError):
        L.merged([rows, rows], "key")
    assert [p for p, _ in L.split_ranges(L.merged([rows], "key"), 4)] == [0, 2]
