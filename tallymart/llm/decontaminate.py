"""Benchmark decontamination with DataFrame functions only.

Windows of a text that are as long as an item are fingerprinted by SimHash, a
multi-index over Hamming blocks finds all items within a radius, and the exact
weighted similarity of the word shingles decides.

A window's similarity is bounded by the number of its shingles that occur in
items of its length.  So every window that holds enough of them to reach the
threshold is fingerprinted, in whatever order they come; all others are below it.
The texts' shingles are probed against the items' shingles inside the scan; only
matches leave it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm.util import broadcast_if_small, fresh_names, shared_folder, stored, table

SHINGLE_WORDS = 5
MIN_SIMILARITY = 0.8
#: Unlike fingerprint bits up to which every pair is found.  At a similarity of 0.8
#: about 10 of 64 bits are unlike, with a deviation of 3.
RADIUS = 20


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    parts = F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.array_remove(parts, "")


def shingle_hashes(hashes: Column, size: int) -> Column:
    """The hash of each run of ``size`` neighbours of an array column of word hashes.

    ``hashes`` has to be a stored column of the row below, not an expression:
    it is read once for every element.
    """
    if size == 1:
        return F.transform(hashes, lambda h: F.xxhash64(h))
    runs = F.transform(
        hashes, lambda h, i: F.xxhash64(h, *[F.get(hashes, i + k) for k in range(1, size)])
    )
    return F.slice(runs, F.lit(1), F.greatest(F.size(hashes) - (size - 1), F.lit(0)))


def simhash(hashes: Column) -> Column:
    """64 bits as a long: one is set if it is set in over half of the hashes, repeats included."""
    ones = F.aggregate(
        hashes,
        F.array_repeat(F.lit(0), 64),
        lambda acc, h: F.transform(acc, lambda n, bit: n + F.getbit(h, bit)),
    )
    one = F.lit(1).cast("long")
    return F.aggregate(
        F.transform(
            ones,
            lambda n, bit: F.when(
                2 * n > F.size(hashes), F.call_function("shiftleft", one, bit)
            ).otherwise(F.lit(0).cast("long")),
        ),
        F.lit(0).cast("long"),
        lambda acc, bit: acc.bitwiseOR(bit),
    )


def blocks(fingerprint: Column, radius: int) -> Column:
    """``radius`` + 1 numbered bit blocks: two words within the radius share one at least."""
    edges = [64 * k // (radius + 1) for k in range(radius + 2)]
    return F.array(
        *[
            F.struct(
                F.lit(k).alias("number"),
                F.shiftrightunsigned(fingerprint, lo)
                .bitwiseAND(F.lit((1 << (hi - lo)) - 1 if hi - lo < 63 else -1).cast("long"))
                .alias("value"),
            )
            for k, (lo, hi) in enumerate(zip(edges, edges[1:]))
        ]
    )


def weighted_similarity(left: Column, right: Column) -> Column:
    """Sum of the smaller counts over the sum of the larger counts of two shingle arrays."""
    both = F.aggregate(
        F.array_intersect(left, right),
        F.lit(0),
        lambda acc, s: acc
        + F.least(F.size(F.filter(left, lambda x: x == s)), F.size(F.filter(right, lambda x: x == s))),
    )
    return both / (F.size(left) + F.size(right) - both)


def shingles(word_array: Column, size: int) -> Column:
    """Runs of ``size`` words as text; ``word_array`` has to be a stored column."""
    runs = F.transform(
        word_array,
        lambda w, i: F.concat_ws(" ", w, *[F.get(word_array, i + k) for k in range(1, size)]),
    )
    return F.slice(runs, F.lit(1), F.greatest(F.size(word_array) - (size - 1), F.lit(0)))


def _with_shingles(df: DataFrame, sizes: list[int], longest: int) -> DataFrame:
    """Adds ``shingles`` and ``fp`` to rows of ``words`` and ``m``, for each shingle size that occurs."""
    parts = []
    for size in sizes:
        fits = F.col("m") >= longest if size == longest else F.col("m") == size
        part = df.where(fits).withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
        part = part.withColumn("codes", shingle_hashes(F.col("hashes"), size))
        parts.append(
            part.withColumn("fp", simhash(F.col("codes")))
            .withColumn("shingles", shingles(F.col("words"), size))
            .drop("hashes")
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def reachable_starts(places: Column, n: Column, m: Column, size: Column, min_similarity: float) -> Column:
    """Starts of all windows of ``m`` words that can be as similar as ``min_similarity``.

    ``places`` has the sorted positions of a text of ``n`` words where a shingle
    of ``size`` words of an item of ``m`` words begins.  Two bags of a and b
    shingles with c in common have similarity c / (a + b - c), and c is at most
    the window's places.  A window holds c places if it holds the first and the
    last of c neighbours.  All columns have to be stored columns.
    """
    both = (m - size + 1) + (F.least(n, m) - size + 1)
    least = F.ceil(both * min_similarity / (1 + min_similarity) - 1e-9).cast("int")
    last = F.greatest(least, F.lit(1)) - 1
    starts = F.transform(
        places,
        lambda place, i: F.struct(
            F.greatest(F.lit(0), F.get(places, i + last) - (m - size)).alias("lo"),
            F.greatest(F.lit(0), F.least(place, n - m)).alias("hi"),
        ),
    )
    # past the last place ``get`` gives null, which greatest() skips
    ranges = F.filter(F.slice(starts, F.lit(1), F.greatest(F.size(places) - last, F.lit(0))), lambda r: r.lo <= r.hi)
    return F.array_distinct(F.flatten(F.transform(ranges, lambda r: F.sequence(r.lo, r.hi))))


def contaminated_texts(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = SHINGLE_WORDS,
    min_similarity: float = MIN_SIMILARITY,
    radius: int = RADIUS,
) -> DataFrame:
    """(text_key, item_id, start, n_words, similarity): each text's best window of each item.

    All windows of the text count that are as long as the item.
    ``text_key`` is the XXH64 of the text, so copies are searched once.  ``start``
    counts words from 0; of equally similar windows the first is given.  Items
    of fewer than ``size`` words are one shingle.  Texts and items without words
    match nothing.
    """
    spark = docs.sparkSession
    folder = shared_folder(spark, "decontaminate")
    raw_items = (
        benchmark.select("item_id", words(F.col("text")).alias("words"))
        .withColumn("m", F.size("words")).where("m > 0").distinct()
    )
    raw_items = stored(raw_items, folder, "items")
    # at most ``size`` values
    lengths = raw_items.select(F.least("m", F.lit(size)).alias("s")).distinct().collect()
    sizes = sorted(r["s"] for r in lengths) or [size]
    items = stored(_with_shingles(raw_items, sizes, size), folder, "item-shingles")

    keyed = docs.select(
        F.xxhash64(F.col("text").cast("string")).alias("text_key"), F.col("text").cast("string").alias("text")
    )
    # where a shingle of an item of m words occurs in a text
    hashed = keyed.select("text_key", words(F.col("text")).alias("words"))
    hashed = hashed.select(
        "text_key", F.size("words").alias("n"), F.transform("words", lambda w: F.xxhash64(w)).alias("hashes")
    )
    found = []
    for s in sizes:
        fits = F.col("m") >= size if s == size else F.col("m") == s
        wanted = items.where(fits).select("m", F.explode("codes").alias("code")).distinct()
        wanted = broadcast_if_small(stored(wanted, folder, f"codes-{s}"))
        probes = hashed.where(F.col("n") >= s).select(
            "text_key", "n", F.posexplode(shingle_hashes(F.col("hashes"), s)).alias("pos", "code")
        )
        found.append(probes.join(wanted, "code").select("text_key", "n", "m", "pos"))
    hits = found[0]
    for part in found[1:]:
        hits = hits.unionByName(part)
    # copies of a text are merged before its places are gathered
    hits = stored(hits.distinct(), folder, "hits")
    places = hits.groupBy("text_key", "n", "m").agg(F.array_sort(F.collect_list("pos")).alias("places"))
    places = stored(places, folder, "places")
    starts = reachable_starts(
        F.col("places"), F.col("n"), F.col("m"), F.least("m", F.lit(size)), min_similarity
    )
    anchors = stored(places.select("text_key", "m", F.explode(starts).alias("start")), folder, "anchors")

    held = broadcast_if_small(stored(anchors.select("text_key").distinct(), folder, "texts"))
    texts = (
        keyed.join(held, "text_key", "left_semi").groupBy("text_key").agg(F.first("text").alias("text"))
        .select("text_key", words(F.col("text")).alias("words"))
    )
    windows = texts.join(anchors, "text_key").select(
        "text_key", "start", "m", F.slice("words", F.col("start") + 1, F.col("m")).alias("words")
    )
    # a text that is shorter than the item is compared as a whole
    windows = stored(windows, folder, "windows")
    windows = stored(_with_shingles(windows, sizes, size), folder, "signed")

    left = windows.select("text_key", "start", "m", "fp", "shingles", F.inline(blocks(F.col("fp"), radius)))
    right = items.select(
        "item_id", "m", F.col("fp").alias("item_fp"), F.col("shingles").alias("item_shingles"),
        F.inline(blocks(F.col("fp"), radius)),
    )
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius
    pairs = (
        left.drop("shingles").join(right.drop("item_shingles"), ["m", "number", "value"]).where(near)
        .select("text_key", "start", "m", "item_id").distinct()
    )
    similarity = weighted_similarity(F.col("shingles"), F.col("item_shingles"))
    checked = (
        pairs.join(windows.select("text_key", "start", "m", "shingles"), ["text_key", "start", "m"])
        .join(
            items.select(
                F.col("item_id").alias("same_id"), F.col("m").alias("same_m"),
                F.col("shingles").alias("item_shingles"),
            ),
            F.col("item_id").eqNullSafe(F.col("same_id")) & (F.col("m") == F.col("same_m")),
        )
        .select("text_key", "item_id", "start", "m", similarity.alias("similarity"))
        .where(F.col("similarity") >= min_similarity)
    )
    best = F.max(F.struct("similarity", (-F.col("start")).alias("back"), "m"))
    return checked.groupBy("text_key", "item_id").agg(best.alias("b")).select(
        "text_key", "item_id", (-F.col("b.back")).alias("start"), F.col("b.m").alias("n_words"), "b.similarity"
    )


def find_contamination(docs: DataFrame, benchmark: DataFrame, **limits) -> DataFrame:
    """(doc_id, item_id, start, n_words, similarity) of every row that holds an item.

    A null text holds nothing; a null doc_id or item_id is reported as null;
    repeated rows are reported as often as they come; an empty table on either
    side gives no rows; other columns are ignored.
    """
    folder = shared_folder(docs.sparkSession, "contamination")
    hits = stored(contaminated_texts(docs, benchmark, **limits), folder, "hits")
    owners = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("text_key")
    )
    return owners.join(broadcast_if_small(hits), "text_key").select(
        "doc_id", "item_id", "start", "n_words", "similarity"
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **limits) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns, whatever their names; null texts stay."""
    (key,) = fresh_names(docs, "_key")
    folder = shared_folder(docs.sparkSession, "contamination")
    hits = contaminated_texts(docs, benchmark, **limits).select(F.col("text_key").alias(key)).distinct()
    hits = broadcast_if_small(stored(hits, folder, "keys"))
    return docs.join(hits, F.xxhash64(F.col("text").cast("string")) == F.col(key), "left_anti")


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: Every aligned window by its exact similarity: what the fingerprints must not lose.
OP5_SQL = r"""
WITH item_words AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS words
  FROM benchmark),
items AS (
  SELECT item_id, words, len(words) AS m, least(len(words), 5) AS s FROM item_words WHERE len(words) > 0),
item_shingles AS (
  SELECT item_id, m, s, o - 1 AS off, array_to_string(words[o:o + s - 1], ' ') AS sh
  FROM items, unnest(range(1, m - s + 2)) AS r(o)),
doc_words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS words
  FROM documents),
doc_shingles AS (
  SELECT doc_id, len(words) AS n, s, o - 1 AS pos, array_to_string(words[o:o + s - 1], ' ') AS sh
  FROM doc_words, (SELECT DISTINCT s FROM items) AS sizes, unnest(range(1, len(words) - s + 2)) AS r(o)),
anchors AS (
  SELECT DISTINCT doc_id, item_id, m, d.s, greatest(0, least(pos - off, n - m)) AS start
  FROM doc_shingles d JOIN item_shingles i ON d.sh = i.sh AND d.s = i.s),
window_counts AS (
  SELECT a.doc_id, a.item_id, a.start, a.m, a.s, d.sh, count(*) AS c
  FROM anchors a JOIN doc_shingles d ON a.doc_id = d.doc_id AND a.s = d.s
   AND d.pos BETWEEN a.start AND a.start + a.m - a.s
  GROUP BY ALL),
item_counts AS (SELECT item_id, sh, count(*) AS c FROM item_shingles GROUP BY ALL),
sizes AS (
  SELECT doc_id, item_id, start, m, s, sum(c) AS held FROM window_counts GROUP BY ALL),
shared AS (
  SELECT w.doc_id, w.item_id, w.start, sum(least(w.c, i.c)) AS in_both
  FROM window_counts w JOIN item_counts i ON w.item_id = i.item_id AND w.sh = i.sh GROUP BY ALL),
scored AS (
  SELECT z.doc_id, z.item_id, z.start, z.m,
    CAST(in_both AS DOUBLE) / CAST(held + (z.m - z.s + 1) - in_both AS DOUBLE) AS similarity
  FROM sizes z JOIN shared h ON z.doc_id = h.doc_id AND z.item_id = h.item_id AND z.start = h.start)
SELECT doc_id, item_id, CAST(start AS INTEGER) AS start, CAST(m AS INTEGER) AS n_words, similarity
FROM scored WHERE similarity >= 0.8
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) = 1
"""
