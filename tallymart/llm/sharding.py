"""Hilbert-ordered sharding with DataFrame functions only.

Several metadata dimensions are quantised to a grid, the grid's cells are put
in the order of a Hilbert curve, and the ordered rows are cut into runs.  Rows
of a shard are neighbours in all dimensions, so a reader's filter on any of
them meets few shards.

A row's place is the sum of three counts: rows in earlier cells (a running sum
over the grid, at most ``2 ** (bits * dimensions)`` rows), rows of its cell in
earlier parts (cells are split by a hash of the row, so that a hot cell is many
tasks' work), and rows before it in its part.  Counts move, rows do not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymart.llm.util import shared_folder, stored, table

SHARDS = 8
BITS = 4
#: Parts a cell is split into; a hot cell's part is a thousandth of it.
PARTS = 1024


def hash_code(value: Column, bits: int) -> Column:
    """A text dimension: equal values have equal codes; null is code 0."""
    codes = F.pmod(F.xxhash64(value), F.lit(1 << bits)).cast("int")
    return F.when(value.isNull(), F.lit(0)).otherwise(codes)


def log_code(value: Column, bits: int) -> Column:
    """A size dimension: a code for each doubling from 32 on, the last for all that is larger."""
    doublings = F.length(F.bin(F.greatest(value.cast("long"), F.lit(1)))) - 6
    return F.least(F.greatest(doublings, F.lit(0)), F.lit((1 << bits) - 1))


def hilbert_index(codes: list[Column], bits: int) -> Column:
    """Place of a grid point on the Hilbert curve through 2 ** bits points a dimension.

    The bit planes are unfolded from the top, one dimension at a time, each
    either inverting or exchanging the lower bits; the Gray code of the result is
    then read across the dimensions.
    """
    n = len(codes)
    steps = F.array(
        *[
            F.struct(F.lit(1 << b).alias("q"), F.lit(i).alias("i"))
            for b in range(bits - 1, 0, -1)
            for i in range(n)
        ]
    )

    def unfold(point: Column, step: Column) -> Column:
        own, first = F.get(point, step["i"]), F.get(point, F.lit(0))
        low = step["q"] - 1
        swap = first.bitwiseXOR(own).bitwiseAND(low)
        invert = own.bitwiseAND(step["q"]) != 0
        return F.transform(
            point,
            lambda x, j: F.when(invert & (j == 0), x.bitwiseXOR(low))
            .when(~invert & ((j == 0) | (j == step["i"])) & (step["i"] != 0), x.bitwiseXOR(swap))
            .otherwise(x),
        )

    point = F.aggregate(steps, F.array(*[c.cast("int") for c in codes]), unfold) if bits > 1 else (
        F.array(*[c.cast("int") for c in codes])
    )
    # Gray code over the dimensions: each one takes in all before it
    gray = F.aggregate(
        point,
        F.array().cast("array<int>"),
        lambda acc, x: F.concat(
            acc, F.array(x.bitwiseXOR(F.coalesce(F.get(acc, F.size(acc) - 1), F.lit(0))))
        ),
    )

    def finish(point: Column) -> Column:
        last = F.get(point, F.lit(n - 1))
        turn = F.aggregate(
            F.array(*[F.lit(1 << b) for b in range(bits - 1, 0, -1)]).cast("array<int>"),
            F.lit(0),
            lambda t, q: F.when(last.bitwiseAND(q) != 0, t.bitwiseXOR(q - 1)).otherwise(t),
        )
        return F.transform(point, lambda x: x.bitwiseXOR(turn))

    final = F.transform(F.array(gray), finish)[0]
    planes = F.array(
        *[
            F.struct(F.lit(b).alias("b"), F.lit(i).alias("i"))
            for b in range(bits - 1, -1, -1)
            for i in range(n)
        ]
    )
    whole = F.transform(
        F.array(final),
        lambda p: F.aggregate(
            planes,
            F.lit(0).cast("long"),
            lambda acc, s: acc * 2 + F.getbit(F.get(p, s["i"]).cast("long"), s["b"]),
        ),
    )
    return whole[0]


def hilbert_shards(
    rows: DataFrame,
    dimensions: dict[str, Column],
    shards: int = SHARDS,
    bits: int = BITS,
    parts: int = PARTS,
) -> DataFrame:
    """``rows`` with ``curve_index``, ``shard`` and ``slot``: runs of equal row counts along the curve.

    ``dimensions`` maps names to integer columns from 0 to 2 ** bits - 1; a null
    code counts as 0.  Counts of shards differ by one at most and ``slot`` numbers a shard's
    rows without gaps from 0, in curve order.  Equal rows take neighbouring
    places; which of them comes first has no effect on what a shard holds.  Columns
    of ``rows`` with the added names are replaced; others may have any names.
    """
    n_dims = len(dimensions)
    if not dimensions or n_dims * bits > 16:
        raise ValueError("the grid takes 1 to 16 bits in all")
    folder = shared_folder(rows.sparkSession, "sharding")
    kept = [f"`{c}`" for c in rows.columns if c.lower() not in ("curve_index", "shard", "slot")]
    codes = [F.coalesce(c, F.lit(0)) for c in dimensions.values()]
    cell = F.lit(0)
    for code in codes:
        cell = cell * (1 << bits) + code
    part = F.pmod(F.xxhash64(*kept), F.lit(parts)).cast("int")
    placed = stored(
        rows.select(F.struct(*kept).alias("_row"), cell.cast("int").alias("_cell"), part.alias("_part")), folder, "placed"
    )

    # at most 2 ** (bits * dimensions) cells of at most ``parts`` parts, whatever the rows
    counts = stored(placed.groupBy("_cell", "_part").agg(F.count("*").alias("_n")), folder, "counts")
    in_cell = Window.partitionBy("_cell").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    part_start = counts.select(
        "_cell", "_part", F.coalesce(F.sum("_n").over(in_cell), F.lit(0)).alias("_part_start")
    )
    axes = [
        F.shiftright("_cell", bits * (n_dims - 1 - i)).bitwiseAND(F.lit((1 << bits) - 1)) for i in range(n_dims)
    ]
    cells = counts.groupBy("_cell").agg(F.sum("_n").alias("_n")).withColumn("curve_index", hilbert_index(axes, bits))
    along = Window.orderBy("curve_index").rowsBetween(Window.unboundedPreceding, -1)
    cell_start = cells.select(
        "_cell", "curve_index", F.coalesce(F.sum("_n").over(along), F.lit(0)).alias("_cell_start"),
        F.sum("_n").over(Window.partitionBy()).alias("_total"),
    )
    starts = stored(part_start.join(cell_start, "_cell"), folder, "starts")

    in_part = Window.partitionBy("_cell", "_part").orderBy("_row")
    ranked = placed.withColumn("_rank", F.row_number().over(in_part) - 1)
    place = F.col("_cell_start") + F.col("_part_start") + F.col("_rank")
    # run k holds the places p with floor(p * shards / total) = k
    return (
        ranked.join(starts, ["_cell", "_part"])
        .withColumn("_place", place)
        .withColumn("shard", F.expr(f"cast((_place * {shards}) div _total as int)"))
        .withColumn("slot", F.expr(f"_place - (shard * _total + {shards} - 1) div {shards}"))
        .select("_row.*", "curve_index", "shard", "slot")
    )


def document_dimensions(bits: int = BITS) -> dict[str, Column]:
    return {
        "lang": hash_code(F.col("lang").cast("string"), bits),
        "source": hash_code(F.col("source").cast("string"), bits),
        "size": log_code(F.col("size"), bits),
    }


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """All documents in ``shards`` runs of equal row counts along a curve over language, source and size.

    Returns doc_id, size, text_crc32, lang, source, curve_index, shard and slot.
    A null text has size 1 and the checksum of no bytes; null metadata has codes of its own;
    null ids and repeated rows are placed like any other; an empty table gives no
    rows; other columns are ignored.
    """
    data = F.encode(F.coalesce(F.col("text").cast("string"), F.lit("")), "UTF-8")
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(data) + 1).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
        F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
    )
    return hilbert_shards(narrow, document_dimensions(), shards)


def op8_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "curve_index",
    )
