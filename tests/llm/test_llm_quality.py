from __future__ import annotations

from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tallymart.llm import quality


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=60))
def test_repeated_words(words):
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 8)}
    assert quality.repeated_words(words) == len(covered)


def test_counts():
    c = quality.count_text("a  bé #\n\n x\nx\nx \n x")
    assert (c.n_words, c.word_chars, c.n_symbols, c.n_dup_lines) == (7, 8, 1, 1)
    assert quality.count_text(None).failed and quality.count_text("").n_words == 0


def test_verdicts_of_unusual_rows(docs):
    good = " ".join(f"word{i}" for i in range(40))
    model = quality.train([], [])
    frame = docs((1, good), (2, None), (3, ""), (None, good), (1, good), (4, "same " * 40), (5, "w " * 19))
    rows = {(r.doc_id, r.n_words, r.kept) for r in quality.quality_verdicts(frame, model).collect()}
    assert rows == {(1, 40, True), (2, 0, False), (3, 0, False), (None, 40, True), (4, 40, False), (5, 19, False)}
    kept = quality.quality_filter(frame, model)
    assert kept.schema == frame.schema
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 1]
    assert quality.quality_filter(frame.limit(0), model).collect() == []


def test_held_out_accuracy(spark, sf_dir):
    """Fitted on half of the labelled rows of one size, right on rows it has not seen."""
    root = sf_dir.rsplit("/", 1)[0]
    docs = spark.read.parquet(f"{root}/sf0.01/documents.parquet")
    labels = spark.read.parquet(f"{root}/sf0.01/labels.parquet")
    model = quality.fit(docs, labels.where("doc_id % 2 = 0"))
    test = labels.where("doc_id % 2 = 1").join(docs, "doc_id").select("text", "quality").toPandas()
    kept = np.asarray([not quality.count_text(t).failed and model.probability(t) >= quality.KEEP_PROBABILITY for t in test.text])
    long = np.asarray([quality.count_text(t).n_words >= quality.MIN_WORDS for t in test.text])
    good = test.quality.to_numpy() == 1
    assert kept[good & long].mean() > 0.97
    assert kept[~good].mean() < 0.15


def test_fit_without_two_classes_or_documents(spark, docs):
    frame = docs((1, "a b"), (2, None))
    labels = spark.createDataFrame([(1, 1, 0), (None, 0, 0), (9, 0, 0), (2, None, 0)], "doc_id long, quality int, toxic int")
    assert quality.fit(frame, labels).probability("anything") > 0.9
    assert quality.fit(frame, labels.limit(0)).probability(None) > 0.9


def test_fit_reads_whole_texts_and_distinct_labels(spark, docs, monkeypatch):
    """Texts that differ only after a long common start are told apart; copies take no place of the sample."""
    start = " ".join(f"w{i}" for i in range(2_000))
    good, bad = (start + f" {word} line" * 400 for word in ("fine", "spam"))
    frame = docs(*[(i, bad if i % 2 else good) for i in range(40)], (0, good), (1, bad))
    labels = spark.createDataFrame([(i, 1 - i % 2, 0) for i in range(40)] * 3, "doc_id long, quality int, toxic int")
    model = quality.fit(frame, labels)
    assert model.probability(good) > 0.5 > model.probability(bad)
    sizes = []
    monkeypatch.setattr(quality, "train_vectors", lambda rows, labels: sizes.append((len(rows), sum(labels))))
    quality.fit(frame, labels, sample_rows=8)
    assert sizes == [(8, 4)]
