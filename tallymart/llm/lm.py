"""Interpolated modified Kneser-Ney word-pair model, counted in Spark, memory-mapped to score.

Three passes over the texts, each a scan without a shuffle of text:

1. words are counted; a word's id is its place in the sorted array of word hashes;
2. word pairs are counted; a pair's key is a one-to-one mix of both ids, so the
   sorted key array can be turned back into ids and has no collisions;
3. texts are scored against the arrays.

What tasks count is merged within the task and leaves it as packed sorted
arrays, one row for each key range, so a frequent word or pair is one entry of a
task however often it occurs.  A range is merged by one task and written as one
array file in the folder that all machines share.  Ranges are of equal width in
hash space, and their number grows with the shuffle width.  A new name in each
attempt and a manifest keep retried tasks from counting twice.

Workers map the files and look up a whole slice of text at once in key order,
so an array is read forwards; its pages are shared by all workers of a machine.
"""

from __future__ import annotations

import mmap
import tempfile
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm.util import ascii_lower_words, file_system, shared_folder, stored, table, text_slices

#: Texts whose crc32(doc_id as text) leaves no rest by this number are held out of training.
HELD_OUT_PART = 10
#: Entries that a task merges before it hands them on.
TASK_ENTRIES = 3_000_000
#: Base model: what is added to each count.
ADDED = 0.1
END_HASH = xxhash.xxh64_intdigest(b"")  # no word is empty

MANIFEST = "kind string, part int, path string, n long, total long, n1 long, n2 long, n3 long, n4 long, packed binary"
WORD = np.dtype([("key", "<u8"), ("count", "<u8")])
PAIR = np.dtype([("key", "<u8"), ("count", "<u4")])
#: By word id: counts of the pairs it starts, how many of them occur once, twice or
#: oftener, and how many pairs it ends.
CONTEXT = np.dtype([("total", "<u8"), ("n1", "<u4"), ("n2", "<u4"), ("n3", "<u4"), ("ends", "<u4")])
PARTIAL = np.dtype([("id", "<u8"), *[(n, CONTEXT[n]) for n in CONTEXT.names]])


# ------------------------------------------------------------------ arrays


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one mix of 64-bit numbers (multiplications by odd numbers and shifted xors)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_BACK = np.uint64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))


def unmix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * _BACK
    x = x ^ (x >> np.uint64(32))
    x = x * _BACK
    return x ^ (x >> np.uint64(32))


def merged(parts: list[np.ndarray], key: str) -> np.ndarray:
    """Entries with equal keys added up, sorted by key.  A sum beyond its field is an error, never cut."""
    rows = np.concatenate(parts)
    rows = rows[np.argsort(rows[key], kind="stable")]
    if not len(rows):
        return rows
    starts = np.flatnonzero(np.concatenate([[True], rows[key][1:] != rows[key][:-1]]))
    out = rows[starts]
    for name in rows.dtype.names:
        if name != key:
            limit = np.iinfo(out.dtype[name]).max
            sums = np.add.reduceat(rows[name].astype(np.uint64), starts)
            if sums.max() > limit:
                raise OverflowError(f"a merged {name} of {sums.max()} is beyond {limit}")
            out[name] = sums
    return out


def split_ranges(rows: np.ndarray, ranges: int) -> Iterator[tuple[int, bytes]]:
    """Slices of entries sorted by 64-bit key, by key range; ``ranges`` is a power of two."""
    shift = np.uint64(64 - ranges.bit_length() + 1)
    part = (rows["key"] >> shift).astype(np.int64) if ranges > 1 else np.zeros(len(rows), np.int64)
    edges = np.flatnonzero(np.diff(part)) + 1
    for a, b in zip([0, *edges], [*edges, len(rows)]):
        if b > a:
            yield int(part[a]), rows[a:b].tobytes()


def write_array(folder: str, rows: np.ndarray) -> str:
    path = f"{folder}/{uuid.uuid4().hex}"
    files, at = file_system(path)
    files.create_dir(at.rpartition("/")[0], recursive=True)
    with files.open_output_stream(at, compression=None) as out:
        out.write(rows.tobytes())
    return path


def map_array(path: str, dtype: np.dtype) -> np.ndarray:
    """The array of a file, mapped; a file of a remote store is fetched to an unnamed file first."""
    files, at = file_system(path)
    if isinstance(files, fs.LocalFileSystem):
        return np.memmap(at, dtype, "r")
    with tempfile.TemporaryFile() as local, files.open_input_stream(at, compression=None) as source:
        while data := source.read(1 << 24):
            local.write(data)
        local.flush()
        return np.frombuffer(mmap.mmap(local.fileno(), 0, access=mmap.ACCESS_READ), dtype)


class Arrays:
    """Sorted entries in the files of all key ranges, looked up as one array."""

    def __init__(self, files: tuple[tuple[int, str, int], ...], ranges: int, dtype: np.dtype):
        self.shift = np.uint64(64 - ranges.bit_length() + 1)
        self.ranges = ranges
        self.files = {part: map_array(path, dtype) for part, path, n in files if n}
        at = 0
        self.first = {}
        for part, _, n in sorted(files):
            self.first[part], at = at, at + n
        self.size = at

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For sorted distinct keys: the place among all entries, or -1, and the count or 0."""
        place = np.full(len(keys), -1, np.int64)
        count = np.zeros(len(keys), np.int64)
        part = (keys >> self.shift).astype(np.int64) if self.ranges > 1 else np.zeros(len(keys), np.int64)
        edges = np.flatnonzero(np.diff(part)) + 1
        for a, b in zip([0, *edges], [*edges, len(keys)]):
            rows = self.files.get(int(part[a])) if b > a else None
            if rows is None:
                continue
            own = rows["key"]
            at = np.minimum(np.searchsorted(own, keys[a:b]), len(own) - 1)
            hit = own[at] == keys[a:b]
            place[a:b][hit] = at[hit] + self.first[int(part[a])]
            count[a:b][hit] = rows["count"][at[hit]]
        return place, count


# ------------------------------------------------------------------ counting


def _merge_ranges(rows: DataFrame, ranges: int, finish, kinds: str) -> DataFrame:
    """``finish(part, blobs)`` for each range; a task holds the entries of one range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, blobs = None, []
        for batch in batches:
            for p, blob in zip(batch.column("part").to_pylist(), batch.column("packed").to_pylist()):
                if p != part and blobs:
                    yield from finish(part, blobs)
                    blobs = []
                part = p
                blobs.append(blob)
        if blobs:
            yield from finish(part, blobs)

    dealt = rows.select("part", "packed").repartition(ranges, "part").sortWithinPartitions("part")
    return dealt.mapInArrow(run, kinds)


def _packed(pairs: list[tuple[int, bytes]]) -> pa.RecordBatch:
    parts, blobs = zip(*pairs)
    return pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(blobs, pa.binary())], names=["part", "packed"])


def _listing(kind: str, part: int, path: str | None, n: int, total: int, often=(0, 0, 0, 0), packed=None) -> dict:
    names = ("n1", "n2", "n3", "n4")
    return dict(kind=kind, part=part, path=path, n=n, total=total, packed=packed, **dict(zip(names, map(int, often))))


def _listings(rows: list[dict]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int32(), pa.string(), *[pa.int64()] * 6, pa.binary()]
    names = [c.split()[0] for c in MANIFEST.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in zip(names, kinds)], names=names)


def _once_to_four(counts: np.ndarray) -> list[int]:
    return [int((counts == k).sum()) for k in (1, 2, 3, 4)]


def count_words(texts: DataFrame, folder: str, ranges: int) -> DataFrame:
    """The manifest of the word arrays; every text adds one end."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flush() -> pa.RecordBatch:
            rows = np.zeros(len(counts), WORD)
            rows["key"] = [END_HASH if w is None else xxhash.xxh64_intdigest(w) for w in counts]
            rows["count"] = list(counts.values())
            counts.clear()
            return _packed(list(split_ranges(merged([rows], "key"), ranges)))

        for batch in text_slices(batches):
            for text in batch.column("text").to_pylist():
                counts.update(ascii_lower_words(text))
                counts[None] += 1
            if len(counts) > TASK_ENTRIES // 6:
                yield flush()
        if counts:
            yield flush()

    def finish(part: int, blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
        rows = merged([np.frombuffer(b, WORD) for b in blobs], "key")
        path = write_array(f"{folder}/words", rows)
        yield _listings([_listing("words", part, path, len(rows), int(rows["count"].sum()))])

    packed = texts.select("text").mapInArrow(count, "part int, packed binary")
    return _merge_ranges(packed, ranges, finish, MANIFEST)


def word_ids(texts: list[str | None], words: Arrays) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per token of all texts, ends included: id or -1, count, and where each text starts."""
    local: dict[bytes | None, int] = {None: 0}
    codes: list[int] = []
    starts = []
    for text in texts:
        starts.append(len(codes))
        codes += [local.setdefault(w, len(local)) for w in ascii_lower_words(text)]
        codes.append(0)
    hashes = np.asarray([END_HASH if w is None else xxhash.xxh64_intdigest(w) for w in local], np.uint64)
    keys, back = np.unique(hashes, return_inverse=True)
    place, count = words.find(keys)
    at = back[np.asarray(codes, np.int64)]
    return place[at], count[at], np.asarray(starts, np.int64), np.diff([*starts, len(codes)])


def contexts(ids: np.ndarray, starts: np.ndarray, start_id: int) -> np.ndarray:
    """The id before each token; ``start_id`` before a text's first."""
    before = np.empty_like(ids)
    before[1:] = ids[:-1]
    before[starts] = start_id
    return before


def pair_keys(before: np.ndarray, ids: np.ndarray) -> np.ndarray:
    return mix(before.astype(np.uint64) << np.uint64(32) | ids.astype(np.uint64))


@dataclass(frozen=True)
class Files:
    """Array files of one kind: (range, path, entries) each, and the number of ranges."""

    files: tuple[tuple[int, str, int], ...]
    ranges: int


@lru_cache(maxsize=4)
def _words(files: Files) -> Arrays:
    return Arrays(files.files, files.ranges, WORD)


@lru_cache(maxsize=2)
def _pairs(files: Files) -> Arrays:
    return Arrays(files.files, files.ranges, PAIR)


def _id_ranges(vocabulary: int, ranges: int) -> int:
    """Ids in each of ``ranges`` ranges of word ids; the start of a text has the id after the last word."""
    return max(1, -(-(vocabulary + 1) // ranges))


def count_pairs(texts: DataFrame, words: Files, vocabulary: int, folder: str) -> DataFrame:
    """The manifest of the pair arrays, and what each range adds to the contexts."""
    ranges = words.ranges
    width = _id_ranges(vocabulary, ranges)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            return _packed(list(split_ranges(merged(held, "key"), ranges)))

        for batch in text_slices(batches):
            ids, _, starts, _ = word_ids(batch.column("text").to_pylist(), _words(words))
            keys, counts = np.unique(pair_keys(contexts(ids, starts, vocabulary), ids), return_counts=True)
            rows = np.zeros(len(keys), PAIR)
            rows["key"], rows["count"] = keys, counts
            held.append(rows)
            size += len(rows)
            if size > TASK_ENTRIES:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    def finish(part: int, blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
        rows = merged([np.frombuffer(b, PAIR) for b in blobs], "key")
        path = write_array(f"{folder}/pairs", rows)
        counts = rows["count"]
        yield _listings([_listing("pairs", part, path, len(rows), int(counts.sum(dtype=np.uint64)), _once_to_four(counts))])
        both = unmix(rows["key"])
        started = np.zeros(len(rows), PARTIAL)
        started["id"], started["total"] = both >> np.uint64(32), counts
        started["n1"], started["n2"], started["n3"] = counts == 1, counts == 2, counts > 2
        ended = np.zeros(len(rows), PARTIAL)
        ended["id"], ended["ends"] = both & np.uint64(0xFFFFFFFF), 1
        # ends and starts are merged on their own first: each is one entry a word at most
        partial = merged([merged([started], "id"), merged([ended], "id")], "id")
        at = (partial["id"] // np.uint64(width)).astype(np.int64)
        edges = np.flatnonzero(np.diff(at)) + 1
        for a, b in zip([0, *edges], [*edges, len(partial)]):
            yield _listings([_listing("contexts", int(at[a]), None, b - a, 0, packed=partial[a:b].tobytes())])

    packed = texts.select("text").mapInArrow(count, "part int, packed binary")
    return _merge_ranges(packed, ranges, finish, MANIFEST)


def merge_contexts(partials: DataFrame, ranges: int, vocabulary: int, folder: str) -> DataFrame:
    """The manifest of dense arrays by word id."""
    width = _id_ranges(vocabulary, ranges)

    def finish(part: int, blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
        rows = merged([np.frombuffer(b, PARTIAL) for b in blobs], "id")
        dense = np.zeros(min(width, vocabulary + 1 - part * width), CONTEXT)
        at = (rows["id"] - np.uint64(part * width)).astype(np.int64)
        for name in CONTEXT.names:
            dense[name][at] = rows[name]
        path = write_array(f"{folder}/contexts", dense)
        ends = dense["ends"]
        yield _listings([_listing("contexts", part, path, len(dense), int(ends.sum(dtype=np.uint64)), _once_to_four(ends))])

    return _merge_ranges(partials, ranges, finish, MANIFEST)


# ------------------------------------------------------------------ model


def discounts(often: tuple[int, int, int, int]) -> np.ndarray:
    """What is taken from counts of 1, 2 and 3 or more, from how many counts are 1, 2, 3 and 4.

    Where the numbers are too small for the estimate it is 0.5, and always between 0 and the count.
    """
    n1, n2, n3, n4 = often
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    out = [0.0]
    for k, (n, more) in enumerate(((n1, n2), (n2, n3), (n3, n4)), start=1):
        out.append(min(max(k - (k + 1) * y * more / n, 0.0), float(k)) if n else 0.5)
    return np.asarray(out)


@dataclass(frozen=True)
class PairModel:
    """Where the arrays lie, and the few numbers beside them."""

    words: Files
    pairs: Files
    contexts: Files
    vocabulary: int
    tokens: int
    endings: int
    pair_often: tuple[int, int, int, int]
    ending_often: tuple[int, int, int, int]

    @property
    def width(self) -> int:
        return _id_ranges(self.vocabulary, self.contexts.ranges)


def train(texts: DataFrame, ranges: int | None = None) -> PairModel:
    """A model of all rows of ``texts`` (text); a null or empty text counts its end only.

    ``ranges`` is a power of two; by default the next one to the session's
    shuffle width, at least 16.  Only the manifests, a few numbers for each
    range, come to the driver.
    """
    spark = texts.sparkSession
    if ranges is None:
        wanted = max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
        ranges = 1 << (wanted - 1).bit_length()
    folder = shared_folder(spark, "lm")

    def files(manifest: DataFrame, kind: str) -> tuple[Files, list]:
        rows = manifest.where(F.col("kind") == kind).where("path is not null").drop("packed").collect()
        return Files(tuple(sorted((r["part"], r["path"], r["n"]) for r in rows)), ranges), rows

    def often(rows: list) -> tuple[int, int, int, int]:
        return tuple(sum(r[n] for r in rows) for n in ("n1", "n2", "n3", "n4"))

    words, listed = files(stored(count_words(texts, folder, ranges), folder, "word-manifest"), "words")
    vocabulary, tokens = sum(r["n"] for r in listed), sum(r["total"] for r in listed)
    if vocabulary >= (1 << 32) - 1:
        raise ValueError("word ids take 32 bits")
    pairs_manifest = stored(count_pairs(texts, words, vocabulary, folder), folder, "pair-manifest")
    pairs, pair_rows = files(pairs_manifest, "pairs")
    partials = pairs_manifest.where("kind = 'contexts'")
    manifest = stored(merge_contexts(partials, ranges, vocabulary, folder), folder, "context-manifest")
    ctx, ctx_rows = files(manifest, "contexts")
    endings = sum(r["total"] for r in ctx_rows)
    return PairModel(words, pairs, ctx, vocabulary, tokens, endings, often(pair_rows), often(ctx_rows))


class _ContextArrays:
    def __init__(self, model: PairModel):
        self.width = model.width
        self.files = {part: map_array(path, CONTEXT) for part, path, n in model.contexts.files if n}

    def find(self, ids: np.ndarray) -> np.ndarray:
        """Entries of sorted ids."""
        out = np.zeros(len(ids), CONTEXT)
        part = ids // self.width
        edges = np.flatnonzero(np.diff(part)) + 1
        for a, b in zip([0, *edges], [*edges, len(ids)]):
            if b > a and (rows := self.files.get(int(part[a]))) is not None:
                out[a:b] = rows[ids[a:b] - int(part[a]) * self.width]
        return out


@lru_cache(maxsize=2)
def _contexts(model: PairModel) -> _ContextArrays:
    return _ContextArrays(model)


def token_probabilities(model: PairModel, before: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """P(token | word before) of each token; an id of -1 is a word not seen in training."""
    needed, back = np.unique(np.concatenate([before, ids]), return_inverse=True)
    known = needed >= 0
    entries = np.zeros(len(needed), CONTEXT)
    entries[known] = _contexts(model).find(needed[known])
    of_before, of_ids = entries[back[: len(ids)]], entries[back[len(ids) :]]

    taken = discounts(model.ending_often)
    ends = of_ids["ends"].astype(np.int64)
    n1, n2, n3 = model.ending_often[0], model.ending_often[1], 0
    total = max(model.endings, 1)
    kept = (np.maximum(ends - taken[np.minimum(ends, 3)], 0.0)) / total
    # what the discounts free goes evenly to all words and one unseen word
    n3 = _words_with_endings(model) - n1 - n2
    freed = (taken[1] * n1 + taken[2] * n2 + taken[3] * n3) / total if model.endings else 1.0
    single = kept + freed / (model.vocabulary + 1)

    taken = discounts(model.pair_often)
    seen = (before >= 0) & (ids >= 0)
    keys, back = np.unique(pair_keys(before[seen], ids[seen]), return_inverse=True)
    count = np.zeros(len(ids), np.int64)
    if len(keys):
        count[seen] = _pairs(model.pairs).find(keys)[1][back]
    totals = of_before["total"].astype(np.float64)
    started = totals > 0
    safe = np.where(started, totals, 1.0)
    freed = (taken[1] * of_before["n1"] + taken[2] * of_before["n2"] + taken[3] * of_before["n3"]) / safe
    own = np.maximum(count - taken[np.minimum(count, 3)], 0.0) / safe
    return np.where(started, own + freed * single, single)


def _words_with_endings(model: PairModel) -> int:
    """Every word of the vocabulary ends some pair: a text's first word follows its start."""
    return model.vocabulary


def score_texts(docs: DataFrame, model: PairModel) -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score) of every row.

    ``score`` is the log10 probability of the text's words and its end;
    ``base_score`` that of the smoothed word frequencies.  A null or empty text
    is its end alone; a null doc_id is kept; repeated rows are scored as often as
    they come; an empty table gives no rows; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # paths and numbers

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        bottom = model.tokens + ADDED * (model.vocabulary + 1)
        for batch in text_slices(batches):
            ids, count, starts, lengths = word_ids(batch.column("text").to_pylist(), _words(model.words))
            before = contexts(ids, starts, model.vocabulary)
            p = token_probabilities(model, before, ids)
            base = np.log10((count + ADDED) / bottom)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(lengths, pa.int64()),
                    pa.array(np.add.reduceat((count > 0).astype(np.int64), starts)),
                    pa.array(np.add.reduceat(base, starts)),
                    pa.array(np.add.reduceat(np.log10(p), starts)),
                ],
                names=["doc_id", "n_tokens", "n_known", "base_score", "score"],
            )

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(score, "doc_id long, n_tokens long, n_known long, base_score double, score double")


def held_out(doc_id=None):
    """True for ids whose text has a CRC-32 without rest by ten; a null id counts as an empty text."""
    text = F.coalesce((F.col("doc_id") if doc_id is None else doc_id).cast("long").cast("string"), F.lit(""))
    return F.crc32(F.encode(text, "UTF-8")) % HELD_OUT_PART == 0


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs.where(~held_out()).select(F.col("text").cast("string").alias("text")))
    return score_texts(docs, model).select(
        "doc_id", held_out().alias("held_out"), "n_tokens", "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
