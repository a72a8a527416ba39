from __future__ import annotations

import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallymart.llm import sharding as S


@pytest.mark.parametrize("dims,bits", [(1, 3), (2, 1), (2, 4), (3, 3)])
def test_curve_visits_neighbours(spark, dims, bits):
    axes = [F.shiftright("c", bits * i).bitwiseAND(F.lit((1 << bits) - 1)) for i in range(dims)]
    grid = spark.range(1 << (dims * bits)).select(F.col("id").cast("int").alias("c"))
    rows = grid.select(S.hilbert_index(axes, bits).alias("h"), *[a.alias(f"x{i}") for i, a in enumerate(axes)]).collect()
    points = {r.h: tuple(r)[1:] for r in rows}
    assert sorted(points) == list(range(1 << (dims * bits)))
    for h in range(1, len(points)):
        assert sum(abs(a - b) for a, b in zip(points[h], points[h - 1])) == 1


def check(rows, total):
    assert len(rows) == total
    counts = Counter(r.shard for r in rows)
    assert all(0 <= s < S.SHARDS for s in counts)
    sizes = [counts.get(s, 0) for s in range(S.SHARDS)]
    assert max(sizes) - min(sizes) <= 1
    for s in counts:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s]))
    ordered = [r.curve_index for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    assert ordered == sorted(ordered)


def test_whole_table(spark, sf_dir):
    rows = S.op8_hilbert_sharding(spark, sf_dir).collect()
    texts = {r.doc_id: r.text.encode() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    check(rows, len(texts))
    assert all(r["size"] == len(texts[r.doc_id]) + 1 and r.text_crc32 == zlib.crc32(texts[r.doc_id]) for r in rows)


def test_unusual_rows(spark):
    rows = [(1, "a", "en", "s", "x")] * 5 + [(None, None, None, None, None)] * 3 + [(2, "", "fr", None, "y"), (3, "é" * 90_000, "en", "s", "z")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, shard string")
    got = S.shard_documents(frame.repartition(3)).collect()
    check(got, 10)
    assert {(r.doc_id, r["size"], r.text_crc32) for r in got} == {
        (1, 2, zlib.crc32(b"a")), (None, 1, 0), (2, 1, 0), (3, 180_001, zlib.crc32("é".encode() * 90_000)),
    }
    assert S.shard_documents(frame.limit(0)).collect() == []
    assert len(S.shard_documents(frame.limit(1)).collect()) == 1


def test_clashing_names(spark):
    names = ["_cell", "_part", "_n", "_rank", "_place", "_total", "_row", "SLOT", "a.b"]
    frame = spark.createDataFrame([tuple(range(i, i + 9)) for i in range(20)], names)
    got = S.hilbert_shards(frame, {"x": F.col("_n") % 16}, shards=3)
    assert got.columns == [*names[:7], "a.b", "curve_index", "shard", "slot"]
    rows = got.collect()
    assert sorted(r["_cell"] for r in rows) == list(range(20))
    assert Counter(r.shard for r in rows) == {0: 7, 1: 7, 2: 6}


def test_runs_prune(spark, sf_dir):
    """A shard spans fewer codes of each dimension than the table."""
    rows = S.shard_documents(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect()
    spans = [len({r.lang for r in rows if r.shard == s}) for s in range(S.SHARDS)]
    assert sum(spans) < S.SHARDS * len({r.lang for r in rows})


def test_grid_is_bounded(spark):
    with pytest.raises(ValueError):
        S.hilbert_shards(spark.range(3), {str(i): F.lit(0) for i in range(5)}, bits=4)
