"""Hard negatives by exact inner-product search over lists that clusters of anchors share.

Anchors are clustered by direction.  For a cluster, candidates are sorted once
by an upper bound of their score with any member: the angle between candidate
and centre, less the widest angle between a member and the centre, is the least
angle the two can have.  Every member walks that one list and ends when the
bound has fallen below what could still enter its result (the angular lists of
Abuzaid et al., "To Index or Not to Index", 2019).

Two walks are made: the best rows of an anchor's label, then, for each distinct
score of a positive, the best rows of other labels within its window.  Rows are
dealt into tiles of bounded size and requests into blocks of bounded size; each
pair of a tile and a block is one task's work, and the tiles' results are merged
by a window whose limit Spark applies before its shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.llm.util import shared_folder, stored, table

#: Positives of an anchor, and negatives of a positive.
POSITIVES = NEGATIVES = 5
#: A negative's score is at least this many hundredths of the positive's.
LOW_PERCENT = 80
#: Components are multiplied by this and rounded down.
SCALE = 256
#: Candidates of a tile and requests of a block, at most (on average; both are dealt by hash).
TILE_ROWS = 262_144
BLOCK_ROWS = 65_536
#: Fewer candidates are still dealt into this many tiles.
TILES = 32
#: Anchors that the centres are fitted on, centres, and rounds of fitting.
SAMPLE_ROWS = 2_000
CENTRES = 16
ROUNDS = 5
#: Candidates of a step of the walk, and members that step together.
STEP = 2_048
MEMBERS = 256

FOUND = "anchor_id long, high long, vec_id long, score long"


# ------------------------------------------------------------------ the walk


def best(slot: np.ndarray, score: np.ndarray, vec_id: np.ndarray, k: int) -> np.ndarray:
    """Indexes of the first ``k`` rows of each slot: higher scores first, then smaller ids."""
    order = np.lexsort((vec_id, -score, slot))
    ordered = slot[order]
    first = np.r_[True, ordered[1:] != ordered[:-1]] if len(order) else np.zeros(0, bool)
    starts = np.flatnonzero(first)
    rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
    return order[rank < k]


def bounds(vectors: np.ndarray, centre: np.ndarray, widest: float) -> np.ndarray:
    """The largest inner product of each row with a unit vector within ``widest`` of ``centre``."""
    length = np.linalg.norm(vectors, axis=1)
    cosine = np.divide(vectors @ centre, length, out=np.ones(len(length)), where=length > 0)
    angle = np.arccos(np.clip(cosine, -1.0, 1.0)) - widest
    # rounding must never end a walk early
    return length * np.cos(np.clip(angle, 0.0, math.pi)) * (1 + 1e-9) + length * 1e-6


def widest_angle(members: np.ndarray, centre: np.ndarray) -> float:
    length = np.linalg.norm(members, axis=1)
    cosine = np.divide(members @ centre, length, out=np.ones(len(length)), where=length > 0)
    return float(np.arccos(np.clip(cosine, -1.0, 1.0)).max(initial=0.0)) + 1e-6


def walk(
    members: np.ndarray,
    own: np.ndarray,
    low: np.ndarray,
    high: np.ndarray,
    vectors: np.ndarray,
    ids: np.ndarray,
    limit: np.ndarray,
    k: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(member, vec_id, score) of the best ``k`` of each member; rows come by falling ``limit``.

    ``low`` and ``high`` bound the scores; ``own`` is the member's own id.  A
    member ends at the first step whose largest bound is below ``low`` or below
    its ``k``-th score: an equal score may have a smaller id.
    """
    length = np.linalg.norm(members, axis=1)
    need = low.astype(float)
    slot, vec_id, score = (np.zeros(0, np.int64) for _ in range(3))
    for start in range(0, len(ids), STEP):
        live = np.flatnonzero(length * limit[start] + 1e-6 >= need)
        if not len(live):
            break
        step = slice(start, start + STEP)
        products = np.rint(members[live] @ vectors[step].T)
        fits = (products >= need[live, None]) & (products <= high[live, None])
        fits &= ids[None, step] != own[live, None]
        row, col = np.nonzero(fits)
        slot = np.r_[slot, live[row]]
        vec_id = np.r_[vec_id, ids[step][col]]
        score = np.r_[score, products[row, col].astype(np.int64)]
        kept = best(slot, score, vec_id, k)
        slot, vec_id, score = slot[kept], vec_id[kept], score[kept]
        full = np.bincount(slot, minlength=len(members)) == k
        worst = np.full(len(members), np.iinfo(np.int64).max)
        np.minimum.at(worst, slot, score)
        need = np.where(full, np.maximum(need, worst), need)
    return slot, vec_id, score


def _matrix(packed: pd.Series) -> np.ndarray:
    """Rows of doubles from packed vectors; shorter ones end in zeros."""
    rows = [np.frombuffer(b, np.float64) for b in packed]
    wide = max((len(r) for r in rows), default=0)
    if all(len(r) == wide for r in rows):
        return np.array(rows).reshape(len(rows), wide)
    out = np.zeros((len(rows), wide))
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def _widen(matrix: np.ndarray, wide: int) -> np.ndarray:
    return np.pad(matrix, ((0, 0), (0, wide - matrix.shape[1])))


def _search(asked: pd.DataFrame, rows: pd.DataFrame, centres: np.ndarray, same: bool, k: int) -> pd.DataFrame:
    """The best rows of one tile for the requests of one block."""
    columns = ["anchor_id", "high", "vec_id", "score"]
    found = []
    if len(asked) and len(rows):
        vectors, wanted = _matrix(rows["packed"]), _matrix(asked["packed"])
        wide = max(vectors.shape[1], wanted.shape[1], centres.shape[1])
        vectors, wanted, middles = (_widen(m, wide) for m in (vectors, wanted, centres))
        ids, labels = rows["vec_id"].to_numpy(np.int64), rows["label"].to_numpy(np.int64)
        anchor, high, low, label, cluster = (
            asked[c].to_numpy(np.int64) for c in ("anchor_id", "high", "low", "label", "cluster")
        )
        for c in np.unique(cluster):
            group = np.flatnonzero(cluster == c)
            limit = bounds(vectors, middles[c], widest_angle(wanted[group], middles[c]))
            order = np.argsort(-limit, kind="stable")  # the list of the cluster, sorted once
            for one in np.unique(label[group]):
                mine = group[label[group] == one]
                alike = labels[order] == one
                part = order[alike] if same else order[~alike]
                listed, names, falling = vectors[part], ids[part], limit[part]
                for start in range(0, len(mine), MEMBERS):
                    m = mine[start : start + MEMBERS]
                    slot, vec_id, score = walk(
                        wanted[m], anchor[m], low[m], high[m], listed, names, falling, k
                    )
                    found.append(pd.DataFrame(dict(zip(columns, (anchor[m][slot], high[m][slot], vec_id, score)))))
    return pd.concat(found) if found else pd.DataFrame(columns=columns)


# ------------------------------------------------------------------ in Spark


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, packed) of the rows that take part; components as whole numbers.

    Rows with a null id, label or vector, or with a component that is null or not
    finite, take no part.  Of rows with one id, one takes part: the least by
    label and components.
    """
    vec_id = F.col("vec_id").cast("long")
    label = F.col("label").cast("long")
    raw = F.col("embedding").cast("array<double>")
    parts = F.transform(raw, lambda x: F.floor(F.lit(float(SCALE)) * x))
    bad = F.exists(raw, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = vectors.where(vec_id.isNotNull() & label.isNotNull() & F.col("embedding").isNotNull() & ~bad)
    label = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = kept.select(vec_id.alias("vec_id"), F.struct(label.alias("label"), parts.alias("parts")).alias("r"))
    rows = rows.groupBy("vec_id").agg(F.min("r").alias("r")).select("vec_id", "r.label", "r.parts")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [np.asarray(p, np.float64).tobytes() for p in batch.column("parts").to_pylist()]
            columns = [batch.column("vec_id"), batch.column("label"), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "packed"])

    return rows.mapInArrow(lambda batches: pack(batches), "vec_id long, label long, packed binary")


def centres_of(anchors: DataFrame) -> np.ndarray:
    """Unit centres of the anchors' directions, fitted on ``SAMPLE_ROWS`` of them at most."""
    sample = anchors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).select("packed").toPandas()
    points = _matrix(sample["packed"])
    length = np.linalg.norm(points, axis=1, keepdims=True)
    points = np.divide(points, length, out=np.zeros_like(points), where=length > 0)
    centres = np.unique(points, axis=0)
    centres = centres[:: max(1, len(centres) // CENTRES)][:CENTRES]
    for _ in range(ROUNDS):
        nearest = np.argmax(points @ centres.T, axis=1) if len(points) else np.zeros(0, int)
        for c in range(len(centres)):
            middle = points[nearest == c].sum(axis=0)
            size = np.linalg.norm(middle)
            if size > 0:
                centres[c] = middle / size
    return centres


def clustered(anchors: DataFrame, centres: np.ndarray) -> DataFrame:
    """Anchors with the number of the nearest centre."""

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            points = _matrix(batch["packed"])
            wide = max(points.shape[1], centres.shape[1])
            cosine = _widen(points, wide) @ _widen(centres, wide).T
            yield batch.assign(cluster=np.argmax(cosine, axis=1) if len(batch) else [])

    schema = "vec_id long, label long, packed binary, cluster long"
    return anchors.mapInPandas(lambda batches: assign(batches), schema)


def searched(
    requests: DataFrame, rows: DataFrame, centres: np.ndarray, same: bool, k: int, tiles: int, blocks: int
) -> DataFrame:
    """(anchor_id, high, vec_id, score): for each request its best ``k`` rows of the same or another label.

    ``requests`` has (anchor_id, low, high, label, cluster, packed): scores from ``low`` to ``high``.
    """

    def dealt(key: str, n: int) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")

    def each(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    asked = requests.withColumn("block", dealt("anchor_id", blocks)).withColumn("tile", each(tiles))
    tiled = rows.withColumn("tile", dealt("vec_id", tiles)).withColumn("block", each(blocks))
    found = (
        asked.groupBy("tile", "block")
        .cogroup(tiled.groupBy("tile", "block"))
        .applyInPandas(lambda a, r: _search(a, r, centres, same, k), FOUND)
    )
    place = Window.partitionBy("anchor_id", "high").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("place", F.row_number().over(place)).where(F.col("place") <= k)


def hard_negatives(
    vectors: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, tiles: int = TILES
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchors`` says which ids are anchors.  A score is the inner product of
    the whole-numbered components, exact while it stays below 2 ** 53; of
    vectors of unlike lengths the shorter one ends in zeros.  Higher scores
    come first, equal ones by smaller id.  For what takes no part see
    ``usable``; other columns are ignored.  An anchor without another row of
    its label, or without a row in a window, has no rows; an empty table gives
    none.
    """
    folder = shared_folder(vectors.sparkSession, "negatives")
    rows = stored(usable(vectors), folder, "rows")
    chosen = stored(rows.where(anchors), folder, "anchors")
    tiles = max(tiles, -(-rows.count() // TILE_ROWS))
    asked = chosen.count()
    centres = centres_of(chosen)
    named = stored(clustered(chosen, centres), folder, "clustered").withColumnRenamed("vec_id", "anchor_id")

    # any score: beyond what a double holds exactly
    whole = named.withColumn("low", F.lit(-(1 << 62))).withColumn("high", F.lit(1 << 62))
    nearest = searched(whole, rows, centres, True, positives, tiles, max(1, -(-asked // BLOCK_ROWS)))
    nearest = nearest.select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    nearest = stored(nearest, folder, "positives")

    # a window for each distinct score; below zero it is empty
    windows = nearest.where("positive_score >= 0").select("anchor_id", F.col("positive_score").alias("high")).distinct()
    low = F.ceil(F.col("high") * LOW_PERCENT / 100).cast("long")
    low = F.when(low * 100 < F.col("high") * LOW_PERCENT, low + 1).otherwise(low)  # rounding of the quotient
    windows = windows.withColumn("low", low).join(named, "anchor_id")
    blocks = max(1, -(-asked * positives // BLOCK_ROWS))
    hard = searched(windows, rows, centres, False, negatives, tiles, blocks)
    hard = hard.select(
        "anchor_id",
        F.col("high").alias("positive_score"),
        F.col("place").alias("rank"),
        F.col("vec_id").alias("negative_id"),
        F.col("score").alias("negative_score"),
    )
    return nearest.join(hard, ["anchor_id", "positive_score"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int"), "negative_id", "positive_score", "negative_score"
    )


def op12_hard_negatives(spark, sf_dir: str) -> DataFrame:
    """Anchors are the rows whose id is divisible by 100."""
    return hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


OP12_SQL = f"""
WITH usable AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END::BIGINT AS label,
        list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS parts
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
        list_inner_product(a.parts, b.parts)::BIGINT AS score
    FROM usable a JOIN usable b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES}
)
SELECT p.anchor_id, p.positive_id,
    row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank,
    n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scores n ON n.anchor_id = p.anchor_id AND NOT n.same
    AND {LOW_PERCENT} * p.positive_score <= 100 * n.score AND n.score <= p.positive_score
QUALIFY rank <= {NEGATIVES}
"""
