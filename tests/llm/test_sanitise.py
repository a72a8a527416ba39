"""Base spans against the plain patterns; disclosing terms and spans against counts by hand."""

from __future__ import annotations

import math
import random
import re
import string
import time
import tracemalloc
from collections import defaultdict
from hashlib import sha256

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from tallymart.llm import sanitise as s

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
            ok = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else None,
                "card": 16 <= len(digits) <= 19 and sum(d // 10 + d % 10 for d in doubled) % 10 == 0,
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if ok:
                out.append((kind, *m.span()))
    return out


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet="ab9.@-+% (10245é\n", max_size=60))
def test_base_spans_are_those_of_the_patterns(text):
    assert s.base_spans(text) == plain(text)


def test_known_values():
    text = "Card 4111 1111-1111 1111, ip 10.0.0.255 and 10.0.0.256, +44 (20) 7946-0958 x@y.z.w@q.r é"
    assert s.base_spans(text) == plain(text)
    assert {k for k, _, _ in s.base_spans(text)} == set(s.KINDS)


def test_long_runs_take_linear_time():
    start = time.time()
    for run in ("a", "1", "@", "1.", "+", "1-", "a.", "+1(", "a@"):
        s.base_spans(run * 300_000)
    assert time.time() - start < 30


def brute(pairs):
    """Spans of each text, by counting sets of documents."""
    texts = [t or "" for _, t in pairs]
    total, near, around = len(texts), defaultdict(set), defaultdict(set)
    words, holds = defaultdict(set), defaultdict(set)
    placed = []
    for i, text in enumerate(texts):
        spans, cores = plain(text), []
        for m in re.finditer(r"[^\x20\x09-\x0D]+", text):
            core = m.group().strip(string.punctuation)
            term = "".join(c.lower() if c.isascii() else c for c in core)
            start = text.index(core, m.start()) if core else 0
            if core:
                words[term].add(i)
                if all(start >= e or start + len(core) <= b for _, b, e in spans):
                    cores.append((term, start, start + len(core)))
        placed.append((spans, cores))
        once = set()
        for kind, b, e in spans:
            value = text[b:e]
            name = (kind, value.lower() if kind == "email" else value if kind == "ip" else re.sub("[^0-9]", "", value))
            holds[name].add(i)
            left = [t for t, x, _ in cores if x < b][-6:]
            right = [t for t, x, _ in cores if x >= e][:6]
            for t in left + right:
                if len(t) > 1 and any(c.isalpha() for c in t) and (t, name) not in once:
                    once.add((t, name))
                    near[t, name].add(i)
                    around[t, name].add(tuple(left + right))
    bad = set()
    for (t, name), both in near.items():
        content = math.log(total / len(holds[name]))
        if content > 0 and len(around[t, name]) >= 3 and len(both) >= len(words[t]) / 2:
            if math.log(total * len(both) / len(words[t]) / len(holds[name])) / content >= 0.8:
                bad.add(t)
    out = []
    for (doc_id, _), (spans, cores) in zip(pairs, placed):
        base = [f"{k}:{b}:{e}" for k, b, e in spans]
        terms = [f"term:{b}:{e}" for t, b, e in cores if t in bad]
        counts = [sum(k == kind for k, _, _ in spans) for kind in PLAIN]
        out.append((doc_id, *counts, sha256(",".join(base).encode()).hexdigest(), ",".join(base + terms)))
    return sorted(out, key=str), bad


def corpus():
    rng = random.Random(5)
    common = [f"word{i}" for i in range(40)]

    def some(n):
        return " ".join(rng.choice(common) for _ in range(n))

    out = []
    for i in range(12):  # Zorbaxx stands by one address only
        out.append((i, f"{some(20)} {some(2)} Zorbaxx, {some(2)} jo@mail.example.com {some(30)}"))
    out += [(100 + i, f"{some(5)} zorbaxx. {some(5)}") for i in range(3)]  # without the address
    out += [(200, f"quibble copies rare@one.example.org {some(3)}")] * 9  # copies: one surrounding
    out += [(300 + i, f"{some(4)} mail u{i}@example.org {some(4)} +1 555 010 {i:04d}") for i in range(40)]
    out += [(400 + i, some(30)) for i in range(100)]
    out += [(500, None), (501, ""), (None, "É 10.0.0.1 Ünï"), (502, "x" * 50_000 + " zorbaxx"), (503, "zorbaxx@a.b zorbaxx")]
    return out


def test_query_equals_counts_by_hand(spark, docs, tmp_path):
    pairs = corpus()
    expected, bad = brute(pairs)
    assert bad == {"zorbaxx"}
    docs(*pairs).write.parquet(str(tmp_path / "documents.parquet"))
    found = s.op11_pii_disclosure(spark, str(tmp_path))
    assert sorted(map(tuple, found.collect()), key=str) == expected


def test_whole_table(spark, sf_dir):
    pairs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, s.op11_pii_disclosure(spark, sf_dir).collect()), key=str) == brute(pairs)[0]


def test_sanitised_texts_hold_nothing(spark, docs):
    made = docs(*corpus(), extra=("base_spans", "_row"))
    out = s.sanitise(made)
    assert out.columns == made.columns and out.count() == made.count()
    for row in out.collect():
        text = row["text"] or ""
        assert plain(text) == [] and "zorbaxx" not in text.lower()
    assert s.sanitise(docs()).collect() == []


class Task:
    """A table whose only batch is read here, as a task would."""

    def __init__(self, *texts):
        self.batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
        self.schema = T.StructType().add("text", "string")

    def select(self, *columns):
        return self

    def mapInArrow(self, read, schema):
        return read(iter([self.batch]))


def test_memory_of_a_task_does_not_follow_its_rows(spark):
    """Texts full of addresses give 25 times their size in neighbours; a slice of them is never held."""
    texts = [" ".join(f"word{i % 97} u{k}x{i}@ex{i % 89}.org" for i in range(1000)) for k in range(20)]
    found = T.StructType().add("term", "string").add("entity", "string").add("around", "long")
    rows = 0
    tracemalloc.start()
    try:
        for batch in s._each_slice(Task(*texts), s._all_neighbours, found):
            rows += batch.num_rows
            assert batch.num_rows <= 10_000
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows == sum(1 for text in texts for _ in s.neighbours(text)) > 200_000
    assert peak < 16e6


def test_neighbours_are_those_of_the_first_place():
    text = "aa jo@x.org bb 10.0.0.1 cc JO@X.org aa dd +1 555 010 0199 bb jo@x.org ee"
    spans, expected = plain(text), set()
    busy = [(b, e) for _, b, e in spans]
    cores = [(m.group(), m.start()) for m in re.finditer(r"\S+", text) if not any(b <= m.start() < e for b, e in busy)]
    for kind, b, e in spans:
        name = s.entity(kind, text[b:e])
        near = [t for t, x in cores if x < b][-6:] + [t for t, x in cores if x >= e][:6]
        around = s.xxh64_intdigest(" ".join(near).encode()) - (1 << 63)
        known = {(t, n) for t, n, _ in expected}
        expected |= {(t, name, around) for t in near if (t, name) not in known} | {(None, name, None)}
    found = list(s.neighbours(text))
    assert set(found) == expected and len(found) == len(expected) > 12


def test_places_as_arrow_lists(spark):
    texts = ["no data", "10.0.0.1 aa u@x.org, bb", "", None, "aa"]
    task = Task(*texts)
    batches = list(s._tagged(task, ["text"], "text", ["base", "hits"], b"\xff" * (s.FILTER_BITS // 8)))
    rows = [row for batch in batches for row in batch.to_pylist()]
    assert [row["text"] for row in rows] == texts
    assert [[tuple(p.values()) for p in row["base"]] for row in rows] == [s.base_spans(t or "") for t in texts]
    assert [[p["term"] for p in row["hits"]] for row in rows] == [["no", "data"], ["aa", "bb"], [], [], ["aa"]]
    empty = list(s._tagged(Task("", None), [], "text", ["base", "hits"], bytes(s.FILTER_BITS // 8)))
    assert [row for batch in empty for row in batch.to_pylist()] == [{"base": [], "hits": []}] * 2
