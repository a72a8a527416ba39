from __future__ import annotations

import corpus_pipeline as pipeline
from tallymart.llm import decontaminate, packing, quality, simhash
from tallymart.session import written


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    kept = [docs]
    for name, stage in pipeline.STAGES:
        kept.append(written(stage(spark, kept[-1], sf_dir), name.replace(" ", "-")))
    assert all(k.columns == columns for k in kept[:-1])
    sizes = [k.count() for k in kept[:-1]]
    assert sizes == sorted(sizes, reverse=True)
    # each stage does what its operator says of its own input
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    want = {r.doc_id for r in quality.quality_verdicts(docs, model).where("kept").collect()}
    assert {r.doc_id for r in kept[1].collect()} == want
    groups = simhash.near_duplicate_groups(kept[1]).collect()
    assert {r.doc_id for r in kept[2].collect()} == {r.component_id for r in groups}
    held = decontaminate.find_contamination(kept[2], spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    assert {r.doc_id for r in kept[3].collect()} == {r.doc_id for r in kept[2].collect()} - {r.doc_id for r in held.collect()}
    assert {r.doc_id for r in kept[4].collect()} == {r.doc_id for r in kept[3].collect()}
    whole = pipeline.run(spark, sf_dir)
    assert whole.columns == packing.piece_digests(packing.pack_documents(docs)).columns
    pieces = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
    assert sorted(map(tuple, whole.select(*pieces).collect())) == sorted(map(tuple, kept[4].select(*pieces).collect()))
