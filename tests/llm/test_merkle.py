"""The manifest against plain recursion over whole lists, and what a wrong copy does to it."""

from __future__ import annotations

import random
from binascii import crc32
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from tallymart.llm import merkle

KINDS = "text string, doc_id long, source string, lang string, n_chars long, leaf string, grp int, pos int, root string"


def h(text):
    return sha256(text.encode()).hexdigest()


def cell(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(row, text):
    return h("".join(map(cell, (row["doc_id"], row["source"], row["lang"], row["n_chars"], text))))


def reduced(nodes, members):
    """The top of a list; ``members`` maps each node's place to [path, ...] lists that grow."""
    places = {i: [i] for i in range(len(nodes))}
    while len(nodes) > 1:
        parents = []
        for first in range(0, len(nodes), 3):
            run = nodes[first : first + 3]
            for k in range(len(run)):
                for leaf in [x for x, at in places.items() if at[-1] == first + k]:
                    members[leaf].append((k, run[:k] + run[k + 1 :]))
            parents.append(h("".join(run)))
        for at in places.values():
            at.append(at[-1] // 3)
        nodes = parents
    return nodes[0]


def brute(rows):
    by_source = {}
    for row in rows:
        by_source.setdefault(row["source"], []).append(row)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    tops, found = [], []
    for source in order:
        group = [(leaf_of(r, r["text"]), r) for r in by_source[source]]
        group.sort(key=lambda x: (x[1]["doc_id"] is not None, x[1]["doc_id"] or 0, x[0]))
        paths = [[] for _ in group]
        tops.append(reduced([x for x, _ in group], paths))
        found.append([(r, leaf, path) for (leaf, r), path in zip(group, paths)])
    above = [[] for _ in order]
    root = reduced(tops, above)
    out = []
    for k, group in enumerate(found):
        for row, leaf, path in group:
            path = path + above[k]
            text, doc_id = row["text"], row["doc_id"]
            if text is not None and doc_id is not None and crc32(str(doc_id).encode()) % 2 == 0:
                text = text.replace("\n", "")
            folded = leaf_of(row, text)
            for at, others in path:
                folded = h("".join(others[:at]) + folded + "".join(others[at:]))
            proof = h("".join(x for _, others in path for x in others))
            out.append((doc_id, leaf, tops[k], root, proof, folded, folded == root))
    return sorted(out, key=str)


def frame(spark, rows):
    fields = ("text", "doc_id", "source", "lang", "n_chars")
    return spark.createDataFrame([(*[r[f] for f in fields], "x", 1, 1, "y") for r in rows], KINDS)


def proved(docs, height):
    text = F.col("text")
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    seen = {"text": F.when(even, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)}
    found = merkle.manifest(docs, seen, height=height).collect()
    for row in found:  # each proof leads from its leaf to the root
        assert merkle.fold(row["leaf"], row["at"], row["others"]) == row["root"]
    return sorted((tuple(r)[:7] for r in found), key=str)


@pytest.mark.parametrize("height", [1, 2, 8])
def test_equals_recursion(spark, height):
    rng = random.Random(height)
    sources = [None, "", "a", "ab", "é", "z", "hot"]
    rows = []
    for i in range(120):
        source = "hot" if i % 3 == 0 else rng.choice(sources)
        text = rng.choice([None, "", "a\nb", "one line", "x" * 5000 + "\n", f"t{i}"])
        rows.append({"doc_id": i, "source": source, "lang": rng.choice([None, "en"]), "n_chars": rng.choice([None, 3]), "text": text})
    rows += [dict(rows[5]), dict(rows[5]), dict(rows[6], text="other"), dict(rows[7], doc_id=None), dict(rows[8], doc_id=None, text="q\n")]
    rows.append(dict(rows[9], doc_id=2**62 + 1))
    assert proved(frame(spark, rows), height) == brute(rows)


def test_one_row_and_none(spark):
    row = {"doc_id": -7, "source": None, "lang": None, "n_chars": None, "text": None}
    assert proved(frame(spark, [row]), 8) == brute([row])
    one = brute([row])[0]
    assert one[1] == one[2] == one[3] and one[4] == h("") and one[6]
    assert merkle.manifest(frame(spark, [])).collect() == []


def test_any_changed_field_fails(spark):
    rows = [{"doc_id": i, "source": "s", "lang": "en", "n_chars": 1, "text": "t"} for i in range(9)]
    docs = frame(spark, rows)
    for field in ("lang", "n_chars", "source"):
        changed = F.when(F.col("doc_id") == 4, F.lit(None)).otherwise(F.col(field))
        bad = merkle.manifest(docs, {field: changed}, proofs=False).where("not verified").collect()
        assert [r["doc_id"] for r in bad] == [4]
