from __future__ import annotations

import numpy as np
import pytest
import xxhash

from tallymart.llm import simhash
from tallymart.llm.components import connected_components


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_codewords_of_words_one_bit_apart():
    rng = np.random.default_rng(3)
    words = rng.integers(0, 1 << 23, 3000)
    own = simhash.codeword_keys(words)
    assert sorted({len(set(r)) for r in own.tolist()}) == [1, 6]
    for bit in range(23):
        other = simhash.codeword_keys(words ^ (1 << bit))
        assert (own == other[:, :1]).any(axis=1).all()
        assert (other == own[:, :1]).any(axis=1).all()


@pytest.mark.parametrize("text", ["", "One two", "A b C d e  f\tg h ÉÀ"])
def test_fingerprint(text):
    words = [w.encode() for w in "".join(c.lower() if c.isascii() else c for c in text).replace("\t", " ").split(" ") if w]
    runs = [b" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert simhash.fingerprint(text) == want


def test_classes_of_planted_fingerprints(spark):
    """Chains and dense groups of fingerprints, all error patterns over the segments, against all pairs."""
    rng = np.random.default_rng(5)
    fps = list(rng.integers(0, 1 << 63, 150, dtype=np.uint64))
    for _ in range(40):
        word = fps[rng.integers(len(fps))]
        for bits in (1, 2, 3, 4, 4, 5):
            fps.append(word ^ np.bitwise_or.reduce(np.uint64(1) << rng.choice(64, bits, replace=False).astype(np.uint64)))
        for places in ((3, 30, 50), (3, 30, 50, 51), (1, 2, 30, 50), (25, 26, 50, 51)):
            fps.append(word ^ sum(np.uint64(1 << p) for p in places))
    center = np.uint64(0x0123456789ABCDEF)
    fps += [center ^ (np.uint64(1) << np.uint64(a)) ^ (np.uint64(1) << np.uint64(b)) for a in range(0, 64, 3) for b in range(a)]
    fps = np.unique(np.asarray(fps, np.uint64))
    signed = fps.view(np.int64)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4
    want = roots(signed.tolist(), [(int(signed[i]), int(signed[j])) for i, j in zip(*np.nonzero(near)) if i < j])
    frame = spark.createDataFrame([(int(x),) for x in signed], "fp long").repartition(4)
    got = {r.fp: r["class"] for r in simhash.fingerprint_classes(frame).collect()}
    assert got == want


def test_group_links_leave_no_all_pairs():
    fps = np.asarray([7 ^ (1 << b) for b in range(60)], np.uint64)
    found, root = simhash.group_links(fps)
    assert len(found) == 59 and set(root.tolist()) <= set(fps.tolist())


def test_unusual_rows(docs):
    base = " ".join(f"w{i}" for i in range(300))
    frame = docs((5, base), (3, base), (9, None), (8, ""), (None, base), (4, base + " x"), (3, base), (7, "other words here are few"))
    rows = simhash.near_duplicate_groups(frame).collect()
    assert len(rows) == 8
    component = {r.doc_id: r.component_id for r in rows}
    assert component[5] == component[3] == 3 and component[8] == component[9] == 8
    assert component[None] is None and component[7] == 7
    kept = simhash.drop_near_duplicates(frame)
    assert kept.columns == frame.columns
    ids = sorted(r.doc_id if r.doc_id is not None else -1 for r in kept.collect())
    assert ids == sorted([-1, *{component[i] for i in (3, 4, 7, 8)}])
    assert simhash.near_duplicate_groups(frame.limit(0)).collect() == []


def test_clashing_names_and_shuffles(docs):
    """Names of helper columns may be in use; the texts are dealt out once."""
    frame = docs((1, "a b c"), (2, "a b c"), (1, "a b c"), (1, "other text"), (None, "x"), extra=("_id", "_TEXT", "_n", "__n", "fp"))
    kept = simhash.drop_near_duplicates(frame)
    assert kept.columns == frame.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 1]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    between = plan.split("Window ", 1)[1].split("Join ", 1)[0]
    assert "Exchange" not in between


def test_an_id_with_unlike_texts_keeps_both_groups(docs):
    one, two = (" ".join(f"{w}{i}" for i in range(300)) for w in "ab")
    kept = simhash.drop_near_duplicates(docs((1, one), (1, two), (2, two), (3, one), (1, two)))
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(1, one), (1, two)]


def test_whole_table_against_all_pairs(spark, sf_dir):
    rows = simhash.op6_simhash_near_dedup(spark, sf_dir).collect()
    fps = {r.doc_id: int(r.fingerprint, 16) for r in rows}
    links = [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 4]
    assert {r.doc_id: r.component_id for r in rows} == roots(fps, links)


def test_components_of_a_long_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(100, 130)] + [(500, i) for i in range(501, 540)] + [(7, 7), (9, 8), (8, 9)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "u long, v long")).collect()}
    want = {n: r for n, r in roots({x for l in links for x in l}, links).items() if n != r}
    assert {n: r for n, r in got.items() if n != r} == want
