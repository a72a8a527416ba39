"""Personal data by pattern, and the terms that give it away by what they co-occur with.

Protected entities are the values of email addresses, IP addresses, card and
phone numbers.  Over all documents a term ``t`` near an entity ``e`` discloses

    D(t; e) = PMI(t; e) / IC(e),  PMI = log(N n(t, e) / (n(t) n(e))),  IC = log(N / n(e))

of what there is to know about ``e`` (C-sanitisation: Sanchez and Batet, 2016):
``n`` counts documents, ``n(t, e)`` those with ``t`` within ``WINDOW`` words of
``e``.  D is 1 where whoever reads the term knows the entity.  A term is
sanitised wherever it stands if, for some entity, D and the share of the term's
documents that hold the entity reach their thresholds, over ``SUPPORT`` unlike
surroundings at least: chance neighbours and exact copies reveal nothing.  Terms
of at least ``REMOVE`` are removed, others generalised to their kind of entity.

Texts are read three times and never shuffled: for neighbours of entities, for
document counts of candidate terms, for spans.  Which terms to look for goes to
the tasks as ``FILTER_BITS`` bits, whatever their number; a join settles it.
"""

from __future__ import annotations

import re
import string
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import accumulate, groupby, islice
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from tallymart.llm.util import (
    ascii_lower_words,
    broadcast_if_small,
    fresh_names,
    shared_folder,
    stored,
    table,
    text_slices,
)

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
#: Words on either side of an entity.
WINDOW = 6
#: Unlike surroundings in which a term must stand near an entity.
SUPPORT = 3
#: Share of an entity's information, and of a term's documents, from which a term is sanitised.
DISCLOSURE = 0.8
POSTERIOR = 0.5
#: From this disclosure on a term is removed.
REMOVE = 0.95
#: Bits of the filter of terms.
FILTER_BITS = 1 << 20
#: Rows that a task makes before it hands them on; a text full of data gives many times its size in them.
BATCH_ROWS = 10_000

# ------------------------------------------------------------------ patterns
# Each reads a text once, also where it is one long run of fitting characters.

LOCAL = frozenset(string.ascii_letters + string.digits + "._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DIGIT = re.compile(r"[^0-9]+")

Span = tuple[str, int, int]


def emails(text: str) -> Iterator[tuple[int, int]]:
    """From each ``@``: the run before it, back to the last match, and the domain behind it."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(done, at + 1))


def small_part(digits: str) -> bool:
    digits = digits.lstrip("0")
    return len(digits) <= 3 and int(digits or "0") <= 255


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) by kind, then start, in code points."""
    spans = [("email", *span) for span in emails(text)]
    for m in IP.finditer(text):
        if all(map(small_part, m.group().split("."))):
            spans.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        digits = DIGIT.sub("", m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            spans.append(("card", *m.span()))
    for m in PHONE.finditer(text):
        if 8 <= len(DIGIT.sub("", m.group())) <= 15:
            spans.append(("phone", *m.span()))
    return spans


def entity(kind: str, value: str) -> str:
    """One name for all spellings of a value."""
    plain = value.lower() if kind == "email" else value if kind == "ip" else DIGIT.sub("", value)
    return f"{kind}:{plain}"


# ------------------------------------------------------------------ terms


def term_of(word: str) -> str:
    """A word without ASCII punctuation around it, A-Z lower-cased."""
    return word.strip(string.punctuation).encode().lower().decode()


def terms_with_spans(text: str, spans: list[Span]) -> list[tuple[str, int, int]]:
    """Terms outside of ``spans``, in order, with their places."""
    busy, end = [], -1
    for start, stop in sorted((s, e) for _, s, e in spans):
        if start < end:
            busy[-1] = end = max(end, stop)
        else:
            busy += [start, stop]
            end = stop
    found = []
    for m in WORD.finditer(text):
        word = m.group()
        core = word.strip(string.punctuation)
        if core:
            start = m.start() + len(word) - len(word.lstrip(string.punctuation))
            i = bisect_left(busy, start + 1)  # odd: starts within a span
            if i % 2 == 0 and (i == len(busy) or busy[i] >= start + len(core)):
                found.append((term_of(word), start, start + len(core)))
    return found


def neighbours(text: str) -> Iterator[tuple[str | None, str, int | None]]:
    """(term, entity, surroundings) once for each term and entity of a text; the entity itself without term."""
    spans = base_spans(text)
    if not spans:
        return
    terms = terms_with_spans(text, spans)
    starts = [start for _, start, _ in terms]
    # entity by entity, so that what was given is held for one of them only
    named = sorted((entity(kind, text[start:end]), start, end) for kind, start, end in spans)
    for name, places in groupby(named, itemgetter(0)):
        yield None, name, None
        seen = set()
        for _, start, end in places:
            first, behind = bisect_left(starts, start), bisect_left(starts, end)
            near = [t for t, _, _ in terms[max(0, first - WINDOW) : first] + terms[behind : behind + WINDOW]]
            around = xxh64_intdigest(" ".join(near).encode()) - (1 << 63)
            for t in near:
                if len(t) > 1 and any(map(str.isalpha, t)) and t not in seen:
                    seen.add(t)
                    yield t, name, around


def _bit(term: bytes) -> int:
    return xxh64_intdigest(term, 42) & (FILTER_BITS - 1)


def term_filter(terms: DataFrame) -> np.ndarray:
    """Which hash values the terms of a table have: ``FILTER_BITS`` flags for any number of terms."""
    bits = terms.select(F.xxhash64("term").bitwiseAND(F.lit(FILTER_BITS - 1)).alias("bit")).distinct()
    flags = np.zeros(FILTER_BITS, bool)
    flags[bits.toArrow().column("bit").to_numpy()] = True
    return np.packbits(flags)


def possible(text: str, bits: bytes) -> set[bytes]:
    """The distinct terms of a text that pass the filter."""
    punctuation = string.punctuation.encode()
    distinct = {word.strip(punctuation) for word in set(ascii_lower_words(text))}
    return {t for t in distinct if t and bits[(b := _bit(t)) >> 3] >> (7 - (b & 7)) & 1}


# ------------------------------------------------------------------ corpus


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("text").cast("string").alias("text"))


def _each_slice(
    docs: DataFrame, rows_of: Callable[[list[str]], Iterator[tuple]], schema: T.StructType
) -> DataFrame:
    """The rows that ``rows_of`` gives for the texts of each slice, ``BATCH_ROWS`` at a time."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            rows = rows_of([t for t in part.column("text").to_pylist() if t])
            while some := list(islice(rows, BATCH_ROWS)):
                columns = [pa.array(c, f.type) for c, f in zip(zip(*some), arrow)]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return _texts(docs).mapInArrow(lambda batches: read(batches), schema)


def _all_neighbours(texts: list[str]) -> Iterator[tuple[str | None, str, int | None]]:
    return (row for text in texts for row in neighbours(text))


def _counted(texts: list[str], bits: bytes) -> Iterator[tuple[str, int]]:
    """(term, texts that hold it) for the terms that pass the filter."""
    counts = Counter(t for text in texts for t in possible(text, bits))
    return ((t.decode(), n) for t, n in counts.items())


def disclosing_terms(docs: DataFrame, folder: str) -> DataFrame:
    """Stored (term, kind, disclosure): terms over the thresholds, with their most disclosed entity's kind."""
    found = T.StructType().add("term", "string").add("entity", "string").add("around", "long")
    near = stored(_each_slice(docs, _all_neighbours, found), folder, "neighbours")
    held = near.where("term is null").groupBy("entity").agg(F.count("*").alias("n_entity"))
    joint = (
        near.where("term is not null")
        .groupBy("term", "entity", "around")
        .count()  # copies meet here, so a hot surrounding is one row beyond
        .groupBy("term", "entity")
        .agg(F.sum("count").alias("n_both"), F.count("*").alias("support"))
        .where(F.col("support") >= SUPPORT)
    )
    joint = stored(joint.join(held, "entity"), folder, "joint")
    bits = term_filter(joint).tobytes()
    part = T.StructType().add("term", "string").add("n", "long")
    seen = _each_slice(docs, lambda texts: _counted(texts, bits), part)
    # added up before the join, which then meets each term once
    counts = seen.groupBy("term").agg(F.sum("n").alias("n_term"))

    total = F.lit(float(docs.count()))
    pmi = F.log(total * F.col("n_both") / (F.col("n_term") * F.col("n_entity")))
    content = F.log(total / F.col("n_entity"))
    disclosure = F.when(content > 0, pmi / content).otherwise(0.0)
    scored = joint.join(counts, "term").withColumn("disclosure", disclosure)
    over = (F.col("disclosure") >= DISCLOSURE) & (F.col("n_both") >= F.col("n_term") * POSTERIOR)
    worst = F.max(F.struct("disclosure", F.substring_index("entity", ":", 1).alias("kind"))).alias("worst")
    terms = scored.where(over).groupBy("term").agg(worst).select("term", "worst.kind", "worst.disclosure")
    return stored(terms, folder, "terms")


def _placed(name: str) -> T.ArrayType:
    """A list of named places."""
    return T.ArrayType(T.StructType().add(name, "string").add("start", "integer").add("end", "integer"))


def _places(rows: list[list[tuple]], kind: pa.ListType) -> pa.Array:
    """A list of places for each row."""
    flat = [place for row in rows for place in row]
    fields = list(kind.value_type)
    columns = [pa.array(c, f.type) for c, f in zip(zip(*flat) if flat else [()] * len(fields), fields)]
    offsets = pa.array(accumulate(map(len, rows), initial=0), pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(columns, fields=fields), type=kind)


def _tagged(docs: DataFrame, kept: list[str], text: str, names: list[str], bits: bytes) -> DataFrame:
    """Columns ``kept`` of ``docs``, base spans and the terms that pass the filter."""
    from pyspark.sql.pandas.types import to_arrow_type

    base, hits = names
    shape = T.StructType([docs.schema[c] for c in kept]).add(base, _placed("kind")).add(hits, _placed("term"))
    kinds = [to_arrow_type(shape[c].dataType) for c in names]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, text):
            found, terms = [], []
            for value in part.column(text).to_pylist():
                spans = base_spans(value or "")
                some = {t.decode() for t in possible(value, bits)} if value else ()
                placed = terms_with_spans(value, spans) if some else ()
                found.append(spans)
                terms.append([p for p in placed if p[0] in some])
            columns = [part.column(c) for c in kept] + [_places(c, k) for c, k in zip((found, terms), kinds)]
            yield pa.RecordBatch.from_arrays(columns, [*kept, *names])

    return docs.mapInArrow(lambda batches: read(batches), shape)


def personal_spans(docs: DataFrame, kept: list[str]) -> DataFrame:
    """Columns ``kept`` of every row, and ``base_spans``, ``term_spans``.

    Base spans are (kind, start, end) by kind and start; term spans are (term,
    kind, disclosure, start, end) by start, and never touch a base span.  A null
    or empty text has none; repeated rows are returned as often as they come,
    and null or repeated ids change nothing.  Other columns may have any names
    (the new ones get underscores where a kept one is alike); an empty table
    gives no rows.
    """
    folder = shared_folder(docs.sparkSession, "sanitise")
    terms = disclosing_terms(docs, folder)
    bits = term_filter(terms).tobytes()
    base, near, row, hits, text = fresh_names(docs, "base_spans", "term_spans", "_row", "_hits", "_text")
    read = docs.select(*kept, F.col("text").cast("string").alias(text))
    tagged = _tagged(read, kept, text, [base, hits], bits).withColumn(row, F.monotonically_increasing_id())
    tagged = stored(tagged, folder, "tagged")
    # only rows with a possible term meet the terms; the others have theirs settled
    some = F.size(hits) > 0
    each = tagged.where(some).select(row, F.explode(hits).alias("hit")).select(row, "hit.*")
    span = F.struct("start", "end", "term", "kind", "disclosure")
    real = each.join(broadcast_if_small(terms), "term").groupBy(row).agg(F.sort_array(F.collect_list(span)).alias(near))
    empty = F.array().cast(real.schema[near].dataType)
    without = tagged.where(~some).withColumn(near, empty)
    within = tagged.where(some).join(real, row, "left").withColumn(near, F.coalesce(near, empty))
    columns = [*kept, base, near]
    return without.select(*columns).unionByName(within.select(*columns))


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of ``text`` replaced: ``[kind]`` for data and generalised terms, nothing for removed ones."""
    base, near = fresh_names(docs, "base_spans", "term_spans")
    found = personal_spans(docs, docs.columns).withColumn("text", F.col("text").cast("string"))
    shape = T.StructType([found.schema[c] for c in docs.columns])

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            spans = zip(part.column(base).to_pylist(), part.column(near).to_pylist())
            texts = [
                _replaced(text, *two) if text else text for text, two in zip(part.column("text").to_pylist(), spans)
            ]
            columns = [pa.array(texts, pa.string()) if c == "text" else part.column(c) for c in shape.names]
            yield pa.RecordBatch.from_arrays(columns, shape.names)

    return found.mapInArrow(lambda batches: replace(batches), shape)


def _replaced(text: str, base: list, near: list) -> str:
    spans = [(s["start"], s["end"], f"[{s['kind']}]") for s in base]
    spans += [(s["start"], s["end"], "" if s["disclosure"] >= REMOVE else f"[{s['kind']}]") for s in near]
    out, done = [], 0
    for start, end, mark in sorted(spans):
        if start >= done:
            out += [text[done:start], mark]
        done = max(done, end)
    return "".join([*out, text[done:]])


def op11_pii_disclosure(spark, sf_dir: str) -> DataFrame:
    """Spans of all documents; ``term`` is the kind of the terms that disclose."""
    found = personal_spans(table(spark, sf_dir, "documents"), ["doc_id"])

    def joined(spans: str, kind) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kind(s), s.start, s.end)), ",")

    base = joined("base_spans", lambda s: s.kind)
    near = F.when(F.size("term_spans") > 0, joined("term_spans", lambda s: F.lit(TERM)))
    every = F.concat_ws(",", F.when(F.size("base_spans") > 0, base), near)
    kinds = F.transform("base_spans", lambda s: s.kind)
    # what an array loses without one of its values
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), every.alias("spans"))
