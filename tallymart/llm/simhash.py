"""Near-duplicate groups by SimHash fingerprints and Golay-code fuzzy keys.

A 64-bit fingerprint is cut into segments of 22, 21 and 21 bits.  Two
fingerprints with at most four unlike bits fall under one of two cases:

* some segment is equal in both: they share that segment's value as a key;
* every segment has an error: then at least two segments have exactly one.

For the second case each segment, padded to 23 bits, is decoded in the perfect
binary Golay code.  Codewords lie 7 bits apart and every word has one within 3
bits, so a word one bit away from ``x`` has a nearest codeword within 4 bits of
``x``.  ``x`` has 1 or 6 codewords within 4 bits; two segments that differ in one
bit share keys in both directions.  A key joins two segments: the nearest
codeword of the first with each near codeword of the second on the left side,
and the other way round on the right side.  That is about 5 keys a pair and side
with 24 bits each, and every match is verified by its unlike bits.

Only distinct fingerprints take part, so copies cost nothing here.  The first
case is solved first, by a search that touches each group of near copies about
once; its classes are known to the join of the second case, which therefore
yields links between unlike classes only and never all pairs of a group.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymart.llm.components import connected_components
from tallymart.llm.util import ascii_lower_words, fresh_names, shared_folder, table, text_slices

SHINGLE_WORDS = 4
MAX_BITS = 4
# Fixed value: the seed of the shingle hash.
SEED = 42
#: (shift, width) of the three segments.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
PAIRS = ((0, 1), (1, 2), (0, 2))

# ------------------------------------------------------------------ fingerprints


def shingle_hashes(words: list[bytes], size: int = SHINGLE_WORDS) -> np.ndarray:
    """XXH64 of every run of ``size`` words joined by spaces, or of all words if fewer."""
    if not words:
        return np.zeros(0, np.uint64)
    data = b" ".join(words)
    if len(words) <= size:
        return np.asarray([xxhash.xxh64_intdigest(data, SEED)], np.uint64)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist())
    return np.fromiter((digest(data[a:b], SEED) for a, b in spans), np.uint64)


def fingerprint(text: str | None, size: int = SHINGLE_WORDS) -> int:
    """A bit is set if it is set in over half of the hashes; no words give zero."""
    hashes = shingle_hashes(ascii_lower_words(text), size)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, text_hash, fp) of every row; ``fp`` holds the 64 bits as a signed long."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            fps = np.asarray(
                [fingerprint(t, size) for t in batch.column("text").to_pylist()], np.uint64
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(fps.view(np.int64))],
                names=["doc_id", "text_hash", "fp"],
            )

    text = F.col("text").cast("string")
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(text).alias("text_hash"),
        text.alias("text"),
    )
    return narrow.mapInArrow(sign, "doc_id long, text_hash long, fp long")


# ------------------------------------------------------------------ Golay code

# Fixed value: a generator polynomial of the binary Golay code of length 23.
GENERATOR = 0b101011100011


@lru_cache(maxsize=1)
def golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """Syndromes by the high and low bits of a word, and errors of weight 4 or less by syndrome.

    Row ``s`` of the second table starts with the one error of weight 3 or less
    and goes on with those of weight 4, six in all or one; unused places repeat
    the first.
    """

    def syndrome(word: int) -> int:
        for bit in range(22, 10, -1):
            if word >> bit & 1:
                word ^= GENERATOR << (bit - 11)
        return word

    unit = np.asarray([syndrome(1 << b) for b in range(23)])
    low = np.zeros(1 << 12, np.int32)
    high = np.zeros(1 << 11, np.int32)
    for b in range(12):
        low[np.arange(1 << 12) >> b & 1 == 1] ^= unit[b]
    for b in range(11):
        high[np.arange(1 << 11) >> b & 1 == 1] ^= unit[12 + b]
    errors: dict[int, list[int]] = defaultdict(list)
    words = [(0, 0, -1)]
    for _ in range(5):
        longer = []
        for word, s, last in words:
            errors[int(s)].append(word)
            longer += [(word | 1 << b, s ^ unit[b], b) for b in range(last + 1, 23)]
        words = longer
    near = np.zeros((1 << 11, 6), np.int32)
    for s, found in errors.items():
        near[s] = [*found, *[found[0]] * (6 - len(found))]
    return np.concatenate([low, high]), near


def codeword_keys(segment: np.ndarray) -> np.ndarray:
    """Indices of the codewords within 4 bits of each 23-bit word, the nearest first, (n, 6)."""
    tables, near = golay_tables()
    syndromes = tables[segment & 0xFFF] ^ tables[(1 << 12) + (segment >> 12)]
    return (segment[:, None] ^ near[syndromes]) >> 11


def segments(fps: np.ndarray) -> list[np.ndarray]:
    return [
        (fps >> np.uint64(shift) & np.uint64((1 << width) - 1)).astype(np.int64)
        for shift, width in SEGMENTS
    ]


def fuzzy_keys(fps: np.ndarray, left: bool) -> tuple[np.ndarray, np.ndarray]:
    """Keys of one side and, for each, the position of its fingerprint."""
    keys, rows = [], []
    codes = [codeword_keys(s) for s in segments(fps)]
    for number, (i, j) in enumerate(PAIRS):
        first, second = (codes[i][:, :1], codes[j]) if left else (codes[i], codes[j][:, :1])
        key = (np.int64(number) << 24) | first.astype(np.int64) << 12 | second.astype(np.int64)
        fresh = np.ones(key.shape, bool)
        fresh[:, 1:] = key[:, 1:] != key[:, :1]  # repeats of the first are unused places
        keys.append(key[fresh])
        rows.append(np.nonzero(fresh)[0])
    return np.concatenate(keys), np.concatenate(rows)


# ------------------------------------------------------------------ links


def group_links(fps: np.ndarray, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect exactly what is linked within a group: each found word to its root.

    A word leaves the group when it is found, so a dense group is passed once
    or twice, not once for each of its words.
    """
    found_all, roots = [], []
    left = fps
    while len(left) > 1:
        root, left = left[0], left[1:]
        waiting = [root]
        while waiting and len(left):
            near = np.bitwise_count(left ^ waiting.pop()) <= max_bits
            if near.any():
                found = left[near]
                left = left[~near]
                found_all.append(found)
                roots.append(np.full(len(found), root))
                waiting.extend(found)
    if not roots:
        return fps[:0], fps[:0]
    return np.concatenate(found_all), np.concatenate(roots)


def _segment_links(distinct: DataFrame, max_bits: int) -> DataFrame:
    """Links between fingerprints that have a segment in common."""
    keys = [
        F.shiftleft(F.lit(n).cast("long"), 32)
        + F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1))
        for n, (shift, width) in enumerate(SEGMENTS)
    ]
    keyed = distinct.select(F.explode(F.array(*keys)).alias("key"), "fp")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_keys, held = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def links(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
            at = np.flatnonzero(np.diff(keys)) + 1
            starts, ends = np.concatenate([[0], at]), np.concatenate([at, [len(keys)]])
            u, v = [], []
            for i in np.flatnonzero(ends - starts > 1):
                found, root = group_links(fps[starts[i] : ends[i]].view(np.uint64), max_bits)
                u.append(found)
                v.append(root)
            u = np.concatenate(u) if u else np.zeros(0, np.uint64)
            v = np.concatenate(v) if v else np.zeros(0, np.uint64)
            return pa.RecordBatch.from_arrays(
                [pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"]
            )

        for batch in batches:
            keys = np.concatenate([held_keys, batch.column("key").to_numpy(zero_copy_only=False)])
            fps = np.concatenate([held, batch.column("fp").to_numpy(zero_copy_only=False)])
            if not len(keys):
                continue
            cut = int(np.searchsorted(keys, keys[-1]))  # the last group may go on
            held_keys, held = keys[cut:], fps[cut:]
            if cut:
                yield links(keys[:cut], fps[:cut])
        if len(held_keys):
            yield links(held_keys, held)

    return (
        keyed.repartition("key").sortWithinPartitions("key").mapInArrow(search, "u long, v long")
    )


def _fuzzy_side(classed: DataFrame, left: bool) -> DataFrame:
    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy(zero_copy_only=False)
            classes = batch.column("class").to_numpy(zero_copy_only=False)
            keys, rows = fuzzy_keys(fps.view(np.uint64), left)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), pa.array(fps[rows]), pa.array(classes[rows])],
                names=["key", "fp", "class"],
            )

    return classed.mapInArrow(expand, "key long, fp long, class long")


def _fuzzy_links(classed: DataFrame, max_bits: int) -> DataFrame:
    """Links between unlike classes of fingerprints that share a fuzzy key."""
    a, b = _fuzzy_side(classed, True).alias("a"), _fuzzy_side(classed, False).alias("b")
    unlike = F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp")))
    linked = (
        (F.col("a.key") == F.col("b.key"))
        & (F.col("a.fp") < F.col("b.fp"))
        & (F.col("a.class") != F.col("b.class"))
        & (unlike <= max_bits)
    )
    return a.join(b, linked).select(F.col("a.class").alias("u"), F.col("b.class").alias("v")).distinct()


def fingerprint_classes(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, class) for distinct fingerprints: the smallest fingerprint that each one reaches.

    ``max_bits`` may be 0 to 4; the keys guarantee no more.
    """
    if not 0 <= max_bits <= 4:
        raise ValueError("the keys guarantee distances of 0 to 4 bits")
    spark = distinct.sparkSession
    folder = shared_folder(spark, "fingerprints")
    first = connected_components(_segment_links(distinct, max_bits))
    classed = (
        distinct.join(first.withColumnRenamed("node", "fp"), "fp", "left")
        .select("fp", F.coalesce("root", "fp").alias("class"))
    )
    classed.write.parquet(f"{folder}/classed")
    classed = spark.read.schema("fp long, class long").parquet(f"{folder}/classed")
    second = connected_components(_fuzzy_links(classed, max_bits))
    return (
        classed.join(second.withColumnRenamed("node", "class"), "class", "left")
        .select("fp", F.coalesce("root", "class").alias("class"))
    )


def near_duplicate_groups(
    docs: DataFrame, size: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """(doc_id, text_hash, fingerprint, component_id, class) of every row.

    ``class`` tells groups apart that have one smallest doc_id, as ids may repeat.

    ``component_id`` is the smallest doc_id reachable over links of at most
    ``max_bits`` unlike bits.  A null or empty text has fingerprint zero and is
    linked like any other; a row with a null doc_id has its fingerprint but no
    component and links nothing; repeated rows are returned as often as they
    come; other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    folder = shared_folder(spark, "simhash")
    fingerprints(docs, size).write.parquet(f"{folder}/signed")
    signed = spark.read.schema("doc_id long, text_hash long, fp long").parquet(f"{folder}/signed")
    least = (
        signed.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("least"))
    )
    least.write.parquet(f"{folder}/least")
    least = spark.read.schema("fp long, least long").parquet(f"{folder}/least")
    classes = least.join(fingerprint_classes(least.select("fp"), max_bits), "fp")
    roots = classes.groupBy("class").agg(F.min("least").alias("component_id"))
    labels = classes.join(roots, "class").select("fp", "component_id", "class")
    return signed.join(labels, "fp", "left").select(
        "doc_id",
        "text_hash",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
        "class",
    )


def drop_near_duplicates(
    docs: DataFrame, size: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """One row of each near-duplicate group, the one with the smallest doc_id, with all columns.

    Rows with a null doc_id belong to no group and stay.  Of rows with equal id
    and text one stays, the first by a hash of their other columns; an id that
    comes with unlike texts may stay for several groups.  Other columns may have
    any names.
    """
    own_id, own_text, number = fresh_names(docs, "_id", "_text", "_n")
    groups = near_duplicate_groups(docs, size, max_bits).where("doc_id = component_id")
    kept = groups.groupBy("class").agg(F.min("doc_id").alias(own_id), F.min("text_hash").alias(own_text))
    kept = kept.select(own_id, own_text)
    # equality of the texts as a range: the join deals rows by doc_id alone, and so
    # the window needs no second shuffle of the texts
    text_hash = F.xxhash64(F.col("text").cast("string"))
    same_text = text_hash.between(F.col(own_text), F.col(own_text))
    named = docs.where("doc_id is not null").join(
        kept, (F.col("doc_id").cast("long") == F.col(own_id)) & same_text, "left_semi"
    )
    rest = [f.name for f in docs.schema if f.name != "text" and f.dataType.typeName() != "map"]
    order = Window.partitionBy(F.col("doc_id").cast("long"), text_hash).orderBy(F.xxhash64(*rest))
    named = named.withColumn(number, F.row_number().over(order)).where(F.col(number) == 1).drop(number)
    return named.unionByName(docs.where("doc_id is null"))


def op6_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    groups = near_duplicate_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "fingerprint", "component_id")
