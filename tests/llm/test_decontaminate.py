from __future__ import annotations

import re
from collections import Counter

import pytest

from tallymart.llm import decontaminate as D


def words(text):
    return [w for w in re.split(r"[^\w]+|_", (text or "").lower()) if w]


def brute(pairs, items, size=5, least=0.8):
    """Every window of every text, aligned or not, by exact similarity."""
    out = {}
    for doc, text in pairs:
        w = words(text)
        for item, line in items:
            v = words(line)
            m, s = len(v), min(len(v), size)
            if not m:
                continue
            want = Counter(tuple(v[i : i + s]) for i in range(m - s + 1))
            for start in range(max(1, len(w) - m + 1)):
                part = w[start : start + m]
                have = Counter(tuple(part[i : i + s]) for i in range(len(part) - s + 1))
                both = sum((want & have).values())
                similarity = both / (sum(want.values()) + sum(have.values()) - both)
                if similarity >= least and similarity > out.get((doc, item), (0, 0))[0]:
                    out[doc, item] = (similarity, start)
    return out


ITEM = " ".join(f"term{i}" for i in range(40))
FILL = " ".join(f"fill{i}" for i in range(300))


@pytest.fixture
def benchmark(spark):
    rows = [(1, ITEM, 0), (2, "Short one", 0), (3, None, 0), (4, " .,", 0), (5, "a b a b a b a b a b a", 0), (1, ITEM, 0)]
    return spark.createDataFrame(rows, "item_id long, text string, number int")


def test_against_all_windows(docs, benchmark):
    edited = ITEM.split()
    edited[3] = "changed"  # an early word: 36 shingles of 36 become 32, similarity 32/40
    half = " ".join(ITEM.split()[:20])
    inserted = " ".join([*ITEM.split()[:38], "new", *ITEM.split()[38:]])
    texts = [
        (10, FILL + " " + ITEM.upper() + "! " + FILL), (11, FILL), (12, None), (13, ""), (14, ITEM),
        (15, FILL + "\n" + " ".join(edited)), (16, half), (17, "x short, ONE y"), (18, "a b a b a b a b a b a"),
        (19, inserted), (20, "fill " + "a b " * 50), (None, ITEM), (10, FILL + " " + ITEM.upper() + "! " + FILL),
    ]
    got = {(r.doc_id, r.item_id): (r.similarity, r.start) for r in D.find_contamination(docs(*texts), benchmark).collect()}
    items = [(1, ITEM), (2, "Short one"), (5, "a b a b a b a b a b a")]
    assert got == brute(texts, items)
    assert {d for d, _ in got} == {None, 10, 14, 15, 17, 18, 19, 20}


def test_items_in_another_order(spark, docs):
    """Windows count wherever they lie, not only where a shingle would align the item."""
    item, fill = [f"term{i}" for i in range(60)], FILL.split()[:35]
    short = [f"part{i}" for i in range(50)]
    swapped = [*item[30:], *item[:30]]
    moved = [*short[10:], *short[:10]]
    texts = [
        (1, " ".join([*fill, *swapped, *fill])), (2, " ".join([*fill, *moved, *fill])), (3, " ".join(swapped)),
        (4, " ".join(moved)), (5, " ".join([*fill, *item[20:], *item[:20:2], *fill])), (6, " ".join([*fill, *short[:49], *fill])),
        (7, " ".join(moved[:48])),
    ]
    items = [(1, " ".join(item)), (2, " ".join(short))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.similarity, r.start) for r in D.find_contamination(docs(*texts), benchmark).collect()}
    assert got == brute(texts, items)
    assert {(1, 1), (2, 2), (3, 1), (4, 2)} <= set(got)
    assert {r.doc_id for r in D.drop_contaminated(docs(*texts), benchmark).collect()} == set(range(1, 8)) - {d for d, _ in got}


def test_filter_and_empty_tables(docs, benchmark):
    frame = docs((1, ITEM), (2, FILL), (3, None), (None, FILL), (2, FILL))
    kept = D.drop_contaminated(frame, benchmark)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 2, 2, 3]
    assert D.find_contamination(frame.limit(0), benchmark).collect() == []
    assert D.find_contamination(frame, benchmark.limit(0)).collect() == []
    assert D.drop_contaminated(frame, benchmark.where("text is null")).count() == 5


def test_clashing_names(docs, benchmark):
    frame = docs((1, ITEM), (2, FILL), extra=("_key", "__KEY", "text_key", "item_id", "m"))
    kept = D.drop_contaminated(frame, benchmark)
    assert kept.columns == frame.columns and [r.doc_id for r in kept.collect()] == [2]
    assert [(r.doc_id, r.item_id) for r in D.find_contamination(frame, benchmark).collect()] == [(1, 1)]


def test_blocks_guarantee_the_radius(spark):
    """Two words within the radius share a block, however the unlike bits lie."""
    from pyspark.sql import functions as F

    rows = [(seed,) for seed in range(64)]
    unlike = sum(1 << (3 * k + 1) for k in range(20))
    frame = spark.createDataFrame(rows, "n long").select(F.xxhash64("n").alias("a"))
    frame = frame.withColumn("b", F.col("a").bitwiseXOR(F.lit(unlike)))
    shared = F.size(F.array_intersect(D.blocks(F.col("a"), 20), D.blocks(F.col("b"), 20)))
    assert frame.where(shared == 0).count() == 0


def test_simhash(spark):
    from pyspark.sql import functions as F

    hashes = [5, -1, 1 << 62, 12345678901234567]
    got = spark.createDataFrame([(hashes,)], "h array<long>").select(D.simhash(F.col("h"))).first()[0]
    mask = (1 << 64) - 1
    want = sum(1 << b for b in range(64) if 2 * sum((h & mask) >> b & 1 for h in hashes) > len(hashes))
    assert got & mask == want


def test_no_python_in_the_plan(spark, sf_dir):
    df = D.op5_benchmark_decontamination(spark, sf_dir)
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", df._jdf.queryExecution().executedPlan().toString())
