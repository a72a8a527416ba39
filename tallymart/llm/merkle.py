"""Merkle manifest of a dataset: leaves, subroots by source, a root, proofs and their folding.

Every tree has runs of three: three consecutive nodes become the hash of their
digests, a last run has what is left.  A tree is worked in superblocks of
``3 ** HEIGHT`` consecutive nodes:

* up: each superblock is reduced to one node, and these are the nodes of the
  next round, until every group has one;
* down: the nodes of a round and the outer siblings that their superblock needs
  are cogrouped by superblock, which finishes the local reduction, joins each
  proof from its local and its outer part, and folds a leaf along it.

A task holds one superblock, so neither a hot source nor a long list of sources
meets in one task.  Rounds are stored in the shared folder.
"""

from __future__ import annotations

from hashlib import sha256


import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.llm.util import broadcast_if_small, shared_folder, stored, table

#: Nodes of a run.
ARITY = 3
#: Levels of a superblock, which has ``ARITY ** HEIGHT`` nodes at most.
HEIGHT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

NODES = "grp long, pos long, size long, node string"
OUTER = "grp long, pos long, at array<int>, others array<string>"
PROOFS = (
    "doc_id string, leaf string, subroot string, root string, proof_sha256 string,"
    " folded_root string, verified boolean, at array<int>, others array<string>"
)


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


# ------------------------------------------------------------------ one superblock


def levels_of(nodes: list[str], height: int | None) -> list[list[str]]:
    """The nodes of each level from ``nodes`` up: ``height`` reductions, or until one is left."""
    levels = [nodes]
    while len(levels) <= height if height is not None else len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([digest("".join(below[i : i + ARITY])) for i in range(0, len(below), ARITY)])
    return levels


def siblings_of(levels: list[list[str]], index: int) -> tuple[list[int], list[str]]:
    """For each level but the last: the node's place in its run, and the run's other digests."""
    at, others = [], []
    for level in levels[:-1]:
        first = index - index % ARITY
        run = level[first : first + ARITY]
        at.append(index - first)
        others.append("".join(run[: index - first] + run[index - first + 1 :]))
        index //= ARITY
    return at, others


def fold(leaf: str, at: list[int], others: list[str]) -> str:
    """The digest that a leaf and its siblings lead to."""
    for place, other in zip(at, others):
        cut = 64 * place
        leaf = digest(other[:cut] + leaf + other[cut:])
    return leaf


# ------------------------------------------------------------------ trees


def _height(size: int, height: int) -> int | None:
    """A superblock of a group with more than one is reduced by its full height."""
    return height if size > ARITY**height else None


def _block(height: int) -> Column:
    return F.floor(F.col("pos") / F.lit(ARITY**height)).cast("long")


def _reduce(nodes: DataFrame, height: int) -> DataFrame:
    """The nodes of the next round, one for each superblock."""

    def up(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("pos")
        first = block.iloc[0]
        size = int(first["size"])
        top = levels_of(block["node"].tolist(), _height(size, height))[-1][0]
        wide = ARITY**height
        row = (int(first["grp"]), int(first["pos"]) // wide, -(-size // wide), top)
        return pd.DataFrame([row], columns=["grp", "pos", "size", "node"])

    blocks = nodes.groupBy("grp", _block(height).alias("block"))
    return blocks.applyInPandas(lambda block: up(block), NODES)


def grow(nodes: DataFrame, largest: int, folder: str, height: int = HEIGHT) -> list[DataFrame]:
    """Stored rounds of a set of trees (grp, pos, size, node), from the leaves to one node a group.

    ``size`` is the number of nodes of the group, ``largest`` the largest of these.
    """
    rounds = [nodes]
    while largest > 1:
        rounds.append(stored(_reduce(rounds[-1], height), folder, f"round-{len(rounds)}"))
        largest = -(-largest // ARITY**height)
    return rounds


def _descend(nodes: DataFrame, outer: DataFrame, height: int) -> DataFrame:
    """Sibling lists of a round's nodes from those of their superblocks."""

    def join(block: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("pos", ignore_index=True)
        levels = levels_of(block["node"].tolist(), _height(int(block["size"][0]), height))
        far_at, far = list(above["at"][0]), list(above["others"][0])
        rows = []
        for i, pos in enumerate(block["pos"]):
            at, others = siblings_of(levels, i)
            rows.append((block["grp"][0], pos, at + far_at, others + far))
        return pd.DataFrame(rows, columns=["grp", "pos", "at", "others"])

    blocks = nodes.groupBy("grp", _block(height))
    return blocks.cogroup(outer.groupBy("grp", "pos")).applyInPandas(
        lambda block, above: join(block, above), OUTER
    )


def outer_paths(rounds: list[DataFrame], above: DataFrame, folder: str, height: int = HEIGHT) -> DataFrame:
    """Stored sibling lists (grp, pos, at, others) of the superblocks of the first round.

    ``above`` has the lists of each group's top node, as (grp, pos = 0, at, others).
    """
    for n in range(len(rounds) - 1, 0, -1):
        above = stored(_descend(rounds[n], above, height), folder, f"outer-{n}")
    return above


# ------------------------------------------------------------------ places


def placed(df: DataFrame, order: list[Column], folder: str, name: str) -> DataFrame:
    """``df`` stored in a total order, with the place of each row from 0 as ``place``.

    Rows are dealt by ranges of the whole order, so equal leading keys spread;
    the counts added up are one for each partition.
    """
    number = F.monotonically_increasing_id()
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_number", number)
    rows = stored(ordered, folder, name)
    part = F.shiftright("_number", 33)
    counts = sorted(map(tuple, rows.groupBy(part.alias("p")).count().collect()))  # one row a partition
    starts, total = [], 0
    for p, n in counts:
        starts.append((p, total))
        total += n
    offsets = df.sparkSession.createDataFrame(starts, "_part long, _start long")
    place = F.col("_start") + F.col("_number").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        rows.join(F.broadcast(offsets), part == F.col("_part"))  # as many rows as partitions
        .withColumn("place", place)
        .drop("_number", "_part", "_start")
    )


# ------------------------------------------------------------------ manifest


def encoded(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def signed(docs: DataFrame, seen: dict[str, Column] | None = None) -> DataFrame:
    """(doc_id, source, leaf, seen): leaves by built-in functions, the text is not kept.

    ``seen`` is the leaf of the row with some fields as a reader found them.
    """
    kinds = {"doc_id": "long", "n_chars": "long"}
    cells = {c: F.col(c).cast(kinds.get(c, "string")) for c in FIELDS}
    leaf, found = (
        F.sha2(F.concat(*map(encoded, row.values())), 256) for row in (cells, cells | (seen or {}))
    )
    return docs.select(
        cells["doc_id"].alias("doc_id"), cells["source"].alias("source"), leaf.alias("leaf"), found.alias("seen")
    )


def manifest(
    docs: DataFrame,
    seen: dict[str, Column] | None = None,
    proofs: bool = True,
    height: int = HEIGHT,
) -> DataFrame:
    """Leaf, subroot, root, proof and folded root of every row.

    ``seen`` gives fields as a reader found them; a row whose leaf they change
    folds to another root and is not ``verified``.  With ``proofs`` a row has
    its proof: the node's place in its run and the run's other digests, level
    by level (``at``, ``others``); their digest is there in any case.

    A row with a null doc_id comes first in its source.  Rows of one doc_id are ordered by leaf, so equal rows are
    neighbours with proofs of their own; a null source is a source, the first
    one; empty and null texts differ.  Other columns are ignored; an empty table
    gives no rows.
    """
    spark = docs.sparkSession
    folder = shared_folder(spark, "merkle")
    rows = signed(docs, seen).withColumn("row", F.monotonically_increasing_id())
    rows = stored(rows, folder, "signed")

    # sources in order, each with its size and the place of its first row
    sizes = rows.groupBy("source").agg(F.count("*").alias("size"))
    sources = placed(sizes, [F.asc_nulls_first("source")], folder, "sources")
    sources = sources.withColumnRenamed("place", "grp")
    leaves = placed(
        rows,
        [F.asc_nulls_first("source"), F.asc_nulls_first("doc_id"), F.asc("leaf"), F.asc("row")],
        folder,
        "leaves",
    )
    firsts = leaves.groupBy("source").agg(F.min("place").alias("first"))
    same = F.col("s.source").eqNullSafe(F.col("f.source"))
    sources = stored(
        sources.alias("s").join(firsts.alias("f"), same).select("s.source", "grp", "size", "first"),
        folder,
        "placed-sources",
    )
    total = sources.agg(F.count("*").alias("n"), F.max("size").alias("largest")).first()
    if not total["n"]:
        return _shown(spark.createDataFrame([], PROOFS), proofs)
    near = F.col("l.source").eqNullSafe(F.col("s.source"))
    leaves = (
        leaves.alias("l")
        .join(broadcast_if_small(sources).alias("s"), near)
        .select(
            "grp",
            (F.col("place") - F.col("first")).alias("pos"),
            "size",
            F.col("leaf").alias("node"),
            F.col("doc_id").cast("string").alias("doc_id"),  # pandas has no null long
            "seen",
        )
    )
    leaves = stored(leaves, folder, "nodes")

    # up: one node for each source, then one for all
    by_source = grow(leaves.select("grp", "pos", "size", "node"), total["largest"], folder, height)
    subroots = by_source[-1].select(
        F.lit(0).cast("long").alias("grp"),
        F.col("grp").alias("pos"),
        F.lit(total["n"]).cast("long").alias("size"),
        "node",
    )
    subroots = stored(subroots, folder, "subroots")
    over_all = grow(subroots, total["n"], f"{folder}/all", height)
    root = over_all[-1].first()["node"]

    # down: the siblings of subroots, of superblocks, of leaves
    top = spark.createDataFrame([(0, 0, [], [])], OUTER)
    of_blocks = outer_paths(over_all, top, f"{folder}/all", height)
    of_sources = stored(_descend(subroots, of_blocks, height), folder, "outer-sources")
    # a subroot's own place is 0, the only one of its group in the last round
    of_tops = of_sources.select(F.col("pos").alias("grp"), F.lit(0).cast("long").alias("pos"), "at", "others")
    outer = outer_paths(by_source, of_tops, folder, height)
    named = subroots.select(F.col("pos").alias("grp"), F.col("node").alias("subroot"))
    outer = outer.join(broadcast_if_small(named), "grp")
    return _shown(_proofs(leaves, outer, root, proofs, height), proofs)


def _shown(proved: DataFrame, proofs: bool) -> DataFrame:
    proved = proved.withColumn("doc_id", F.col("doc_id").cast("long"))
    return proved if proofs else proved.drop("at", "others")


def _proofs(leaves: DataFrame, outer: DataFrame, root: str, proofs: bool, height: int) -> DataFrame:
    names = [c.split()[0] for c in PROOFS.split(", ")]

    def finish(block: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("pos", ignore_index=True)
        nodes = block["node"].tolist()
        levels = levels_of(nodes, _height(int(block["size"][0]), height))
        far_at, far = list(above["at"][0]), list(above["others"][0])
        subroot, tail = above["subroot"][0], "".join(far)
        rows = []
        for i, (doc_id, leaf, seen) in enumerate(zip(block["doc_id"], nodes, block["seen"])):
            at, others = siblings_of(levels, i)
            proof = digest("".join(others) + tail)
            folded = fold(seen, at + far_at, others + far)
            whole = (at + far_at, others + far) if proofs else (None, None)
            rows.append((doc_id, leaf, subroot, root, proof, folded, folded == root, *whole))
        return pd.DataFrame(rows, columns=names)

    blocks = leaves.groupBy("grp", _block(height))
    return blocks.cogroup(outer.groupBy("grp", "pos")).applyInPandas(
        lambda block, above: finish(block, above), PROOFS
    )


def op13_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    """Every second document, by its id's CRC-32, is seen without its line feeds."""
    docs = table(spark, sf_dir, "documents")
    text = F.col("text").cast("string")
    even = F.crc32(F.col("doc_id").cast("long").cast("string")) % 2 == 0
    seen = F.when(even, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)
    return manifest(docs, {"text": seen}, proofs=False)


OP13_SQL = r"""
WITH RECURSIVE fields AS (
    SELECT doc_id, source, text,
        CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(doc_id::VARCHAR) || ':' || doc_id END
        || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
        || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END
        || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(n_chars::VARCHAR) || ':' || n_chars END AS head,
        list_reduce(
            list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
            lambda crc, byte: list_reduce(
                list_concat([xor(crc, byte)], range(8)),
                lambda r, k: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384::BIGINT) ELSE r >> 1 END
            )
        ) AS crc
    FROM documents
), seen AS (
    SELECT *, CASE WHEN (crc & 1) = 1 THEN replace(text, chr(10), '') ELSE text END AS found FROM fields
), leaves AS (
    SELECT doc_id, source,
        sha256(head || CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END) AS node,
        sha256(head || CASE WHEN found IS NULL THEN '-' ELSE strlen(found) || ':' || found END) AS found
    FROM seen
), numbered AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, node) - 1 AS pos,
        dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS grp
    FROM leaves
), inner_tree AS (
    SELECT grp, 0 AS level, pos, node, count(*) OVER (PARTITION BY grp) AS n FROM numbered
    UNION ALL
    SELECT grp, level + 1, pos // 3, sha256(string_agg(node, '' ORDER BY pos)), (n + 2) // 3
    FROM inner_tree WHERE n > 1 GROUP BY grp, level, pos // 3, n
), subroots AS (
    SELECT grp, level AS height, node AS subroot FROM inner_tree WHERE n = 1
), outer_tree AS (
    SELECT 0 AS level, grp AS pos, subroot AS node, count(*) OVER () AS n FROM subroots
    UNION ALL
    SELECT level + 1, pos // 3, sha256(string_agg(node, '' ORDER BY pos)), (n + 2) // 3
    FROM outer_tree WHERE n > 1 GROUP BY level, pos // 3, n
), inner_runs AS (
    SELECT a.grp, a.level, a.pos,
        coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS before,
        coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS after
    FROM inner_tree a JOIN inner_tree b ON a.grp = b.grp AND a.level = b.level AND a.pos // 3 = b.pos // 3
    WHERE a.n > 1 GROUP BY a.grp, a.level, a.pos
), outer_runs AS (
    SELECT a.level, a.pos,
        coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS before,
        coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS after
    FROM outer_tree a JOIN outer_tree b ON a.level = b.level AND a.pos // 3 = b.pos // 3
    WHERE a.n > 1 GROUP BY a.level, a.pos
), folds AS (
    SELECT doc_id, grp, pos AS leaf_pos, node AS leaf, 0 AS level, pos AS at, found AS folded, '' AS proof, false AS above
    FROM numbered
    UNION ALL
    SELECT f.doc_id, f.grp, f.leaf_pos, f.leaf,
        CASE WHEN f.above OR f.level < s.height THEN f.level + 1 ELSE 0 END,
        CASE WHEN f.above OR f.level < s.height THEN f.at // 3 ELSE f.grp END,
        CASE WHEN f.above THEN sha256(o.before || f.folded || o.after)
            WHEN f.level < s.height THEN sha256(i.before || f.folded || i.after) ELSE f.folded END,
        CASE WHEN f.above THEN f.proof || o.before || o.after
            WHEN f.level < s.height THEN f.proof || i.before || i.after ELSE f.proof END,
        f.above OR f.level >= s.height
    FROM folds f
    JOIN subroots s ON s.grp = f.grp
    LEFT JOIN inner_runs i ON NOT f.above AND i.grp = f.grp AND i.level = f.level AND i.pos = f.at
    LEFT JOIN outer_runs o ON f.above AND o.level = f.level AND o.pos = f.at
    WHERE NOT f.above OR o.level IS NOT NULL
)
SELECT f.doc_id, f.leaf, s.subroot, r.node AS root, sha256(f.proof) AS proof_sha256,
    f.folded AS folded_root, f.folded = r.node AS verified
FROM folds f JOIN subroots s ON s.grp = f.grp, (SELECT node, level FROM outer_tree WHERE n = 1) r
WHERE f.above AND f.level = r.level
"""
