"""Quality rules: fixed text rules, then a hashed n-gram classifier with calibrated scores.

Features are the frequencies of hashed words, word pairs and character n-grams
of the whole text, so a score is a mean of weights over the text's n-grams and
needs no feature vector: time is linear in the text and memory is a slice of it.

``fit`` trains on a bounded sample of the labelled rows; everything else reads
all rows.  Scoring runs in Arrow batches.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.llm.util import table, text_slices

#: Most labelled rows that the classifier is fitted on: those with the smallest hash of their id.
SAMPLE_ROWS = 4_000
BITS = 15
CHAR_GRAMS = (2, 3, 4)
#: A text is kept if its calibrated probability of good quality is at least this.
KEEP_PROBABILITY = 0.5
# Fixed values of the text rules.
MIN_WORDS = 20
REPEAT_WINDOW = 8
MAX_REPEAT_PERCENT = 30
SYMBOLS = re.compile(r"[#*$%&|<>]")

GROUPS = 2 + len(CHAR_GRAMS)
VERDICT = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long,"
    " n_repeat_words long, base_failed boolean, quality double, kept boolean"
)


# ------------------------------------------------------------------ text rules


@dataclass(frozen=True)
class TextCounts:
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int

    @property
    def failed(self) -> bool:
        return (
            self.n_words < MIN_WORDS
            or 100 * self.n_repeat_words > MAX_REPEAT_PERCENT * self.n_words
        )


def repeated_words(words: list[bytes], width: int = REPEAT_WINDOW) -> int:
    """Words that lie in a window of ``width`` words found twice or more, the first included."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    codes = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    if len(ids) == len(words):
        return 0
    windows = np.zeros(n, np.int64)
    # ranks of ever longer windows, so that equal ranks mean equal words: 1, 2, 4, 8
    rank, span = codes, 1
    while span < width:
        step = min(span, width - span)
        pairs = rank[: len(rank) - step] * np.int64(len(words) + 1) + rank[step:]
        rank = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
        span += step
    windows = rank[:n]
    repeated = np.bincount(windows)[windows] > 1
    edges = np.zeros(len(words) + 1, np.int64)
    edges[:n] += repeated
    edges[width : width + n] -= repeated
    return int((np.cumsum(edges[:-1]) > 0).sum())


def count_text(text: str | None) -> TextCounts:
    """The counts of the fixed rules over a whole text; a null text has no words."""
    if not text:
        return TextCounts(0, 0, 0, 0, 0)
    words = text.encode("utf-8", "surrogatepass").split()
    seen: set[str] = set()
    n_dup = 0
    for line in text.split("\n"):
        if line.strip("\t\n\v\f\r "):
            n_dup += line in seen
            seen.add(line)
    spaces = sum(map(text.count, "\t\n\v\f\r "))
    return TextCounts(
        len(words), len(text) - spaces, len(SYMBOLS.findall(text)), n_dup, repeated_words(words)
    )


# ------------------------------------------------------------------ classifier


def gram_buckets(text: str) -> list[np.ndarray]:
    """Hash buckets of the words, word pairs and character n-grams of a text, one array a group."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    known: dict[bytes, int] = {}
    hashes = np.fromiter(
        (known.get(w) or known.setdefault(w, xxhash.xxh64_intdigest(w) | 1) for w in words),
        np.uint64,
        len(words),
    )
    shift = np.uint64(64 - BITS)
    mix = np.uint64(0x9E3779B97F4A7C15)
    pairs = ((hashes[:-1] * np.uint64(31) + hashes[1:]) * mix) >> shift
    pairs[hashes[:-1] == hashes[1:]] = 0  # any word said twice in a row
    groups = [(hashes * mix) >> shift, pairs]
    codes = np.frombuffer(data, np.uint8).astype(np.uint32)
    # bytes, not code points: a window of n bytes, packed into 32 bits and multiplied
    for n in CHAR_GRAMS:
        m = max(0, len(codes) - n + 1)
        packed = np.zeros(m, np.uint32)
        for i in range(n):
            packed |= codes[i : i + m] << np.uint32(8 * i)
        groups.append((packed * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS))
    return [g.astype(np.int32) for g in groups]


def gram_vector(text: str) -> list[tuple[np.ndarray, np.ndarray]]:
    """Buckets and their shares of a whole text, a pair for each group: at most 2 ** BITS entries each."""
    row = []
    for buckets in gram_buckets(text):
        at, count = np.unique(buckets, return_counts=True)
        row.append((at.astype(np.int16), (count / max(1, len(buckets))).astype(np.float32)))
    return row


@dataclass(frozen=True)
class QualityModel:
    """Weights by group and bucket, a bias, and the line that calibrates the raw score."""

    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def raw(self, text: str) -> float:
        total = self.bias
        for weights, buckets in zip(self.weights, gram_buckets(text)):
            if len(buckets):
                total += float(weights[buckets].mean())
        return total

    def probability(self, text: str | None) -> float:
        raw = self.raw(text or "")
        return float(_sigmoid(np.float64(self.slope * raw + self.offset)))


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -50, 50)))


def train(texts: list[str], labels: list[int], epochs: int = 12, rate: float = 0.5) -> QualityModel:
    return train_vectors([gram_vector(text) for text in texts], labels, epochs, rate)


def train_vectors(rows: list, labels: list[int], epochs: int = 12, rate: float = 0.5) -> QualityModel:
    """Logistic regression by AdaGrad over single rows in a fixed order, then Platt's calibration.

    A fifth of the rows is held out of the weights and only fits the calibration.
    With no rows of one of the two classes the model gives every text that class's side.
    """
    y = np.asarray(labels, np.float64)
    if not len(y) or y.min() == y.max():
        constant = float(y[0]) if len(y) else 1.0
        return QualityModel(np.zeros((GROUPS, 1 << BITS)), 0.0, 0.0, 4.0 if constant else -4.0)
    order = np.random.default_rng(7).permutation(len(rows))
    held = order[: len(rows) // 5]
    fit = order[len(rows) // 5 :]
    share = {c: 0.5 / max(1, (y[fit] == c).sum()) * len(fit) for c in (0.0, 1.0)}
    weights = np.zeros((GROUPS, 1 << BITS))
    squares = np.full((GROUPS, 1 << BITS), 1e-8)
    bias, bias_square = 0.0, 1e-8

    def score(row) -> float:
        return bias + sum(float(w[at] @ x) for w, (at, x) in zip(weights, row))

    for _ in range(epochs):
        for i in fit:
            slope = (_sigmoid(score(rows[i])) - y[i]) * share[y[i]]
            bias_square += slope * slope
            bias -= 0.1 * rate * slope / np.sqrt(bias_square)
            for g, (at, x) in enumerate(rows[i]):
                step = slope * x
                squares[g, at] += step * step
                weights[g, at] -= rate * step / np.sqrt(squares[g, at])
    scores = np.asarray([score(rows[i]) for i in held])
    slope, offset = _platt(scores, y[held])
    return QualityModel(weights, bias, slope, offset)


def _platt(scores: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the log odds by Newton steps, with Platt's smoothed targets."""
    good, bad = float((y == 1).sum()), float((y == 0).sum())
    target = np.where(y == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    a, b = 1.0, 0.0
    for _ in range(60):
        p = _sigmoid(a * scores + b)
        d, w = p - target, np.maximum(p * (1 - p), 1e-9)
        ga, gb = float(d @ scores) + 1e-3 * (a - 1), float(d.sum())
        haa, hab, hbb = float(w @ scores**2) + 1e-3, float(w @ scores), float(w.sum())
        det = haa * hbb - hab * hab
        if det < 1e-12:
            break
        step_a, step_b = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        size = max(1.0, abs(step_a), abs(step_b))
        a, b = a - step_a / size, b - step_b / size
        if abs(step_a) + abs(step_b) < 1e-9:
            break
    return (a, b) if a > 0 else (1.0, 0.0)


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> QualityModel:
    """The model from at most ``sample_rows`` labelled documents.

    Half of the bound is given to each class, in the order of a hash of the id,
    so the choice depends on neither partitions nor size.  Labels without a
    document, null labels and null ids are left out; of repeated rows one counts,
    and takes one place of the bound.  Whole texts are counted in tasks; the
    driver gets a text's shares of the buckets.
    """
    wanted = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
        .groupBy("doc_id").agg(F.min("quality").alias("quality"))
    )
    half = max(1, sample_rows // 2)
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    chosen = wanted.where("quality = 0").orderBy(*order).limit(half)
    chosen = chosen.unionByName(wanted.where("quality = 1").orderBy(*order).limit(half))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    sample = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
        .join(F.broadcast(chosen), "doc_id")  # at most sample_rows ids
        .groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            for i, whole in enumerate(batch.column("text").to_pylist()):
                row = gram_vector(whole)
                columns = [
                    batch.column("doc_id").slice(i, 1), batch.column("quality").slice(i, 1),
                    pa.array([[len(at) for at, _ in row]], pa.list_(pa.int32())),
                    pa.array([b"".join(at.tobytes() for at, _ in row)], pa.binary()),
                    pa.array([b"".join(x.tobytes() for _, x in row)], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "quality", "sizes", "places", "shares"])

    kinds = "doc_id long, quality int, sizes array<int>, places binary, shares binary"
    rows = {}
    for r in sample.mapInArrow(count, kinds).toLocalIterator():
        ends = np.cumsum(r["sizes"])[:-1]
        places, shares = np.frombuffer(r["places"], np.int16), np.frombuffer(r["shares"], np.float32)
        rows[r["doc_id"]] = (list(zip(np.split(places, ends), np.split(shares, ends))), r["quality"])
    ordered = [rows[doc_id] for doc_id in sorted(rows)]
    return train_vectors([row for row, _ in ordered], [label for _, label in ordered])


# ------------------------------------------------------------------ DataFrames


def _model_source(spark, model: QualityModel):
    """The model as a broadcast value: 2 ** BITS weights a group, whatever the input."""
    return spark.sparkContext.broadcast(model)


def quality_verdicts(
    docs: DataFrame, model: QualityModel, keep_probability: float = KEEP_PROBABILITY
) -> DataFrame:
    """Counts, rule result, probability and verdict of every row of ``docs``.

    Reads ``doc_id`` and ``text`` only.  A null or empty text has no words and
    fails the rules; a null ``doc_id`` is kept as null; repeated rows give
    repeated verdicts; an empty table gives no rows.
    """
    shared = _model_source(docs.sparkSession, model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in text_slices(batches):
            out = []
            ids_text = zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())
            for doc_id, text in ids_text:
                c = count_text(text)
                p = model.probability(text)
                out.append(
                    (doc_id, c.n_words, c.word_chars, c.n_symbols, c.n_dup_lines, c.n_repeat_words,
                     c.failed, p, not c.failed and p >= keep_probability)
                )
            kinds = [pa.int64()] * 6 + [pa.bool_(), pa.float64(), pa.bool_()]
            names = [c.split()[0] for c in VERDICT.split(", ")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names
            )

    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return narrow.mapInArrow(judge, VERDICT)


def quality_filter(
    docs: DataFrame, model: QualityModel, keep_probability: float = KEEP_PROBABILITY
) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns; no shuffle and no join."""
    shared = _model_source(docs.sparkSession, model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in text_slices(batches):
            mask = []
            for text in batch.column("text").to_pylist():
                mask.append(
                    not count_text(text).failed and model.probability(text) >= keep_probability
                )
            yield batch.filter(pa.array(mask, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def op9_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_verdicts(docs, fit(docs, table(spark, sf_dir, "labels")))
