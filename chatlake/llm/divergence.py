"""Audit of how sources differ in their words, after collapsing duplicate texts.

Rows with one language and text are grouped first, by 128 bits of hash, with how many rows each
source has of the text. Every distinct text is split into terms once; its counts are added to
each of its sources times that multiplicity, and its terms get the number of its rows as document
frequency. A task sends one row per language and term, with the sources that have it; these
are merged in sorted order. A language keeps the terms that ``min_docs`` of its rows have.

Shares are whole numbers: p = 1 + floor(SCALE * (count + 1) / (N + V)), with N the words of the
group that are kept terms and V the number of kept terms. The divergence of a group from another
distribution q sums f(p, q) = floor((p - q)^2 / q) over all kept terms. A term that neither group
has contributes the same f(p0, q0) each time, with p0 and q0 the shares of a count of zero, so

    sum = V f(p0, q0) + sum over terms of P of [f(p, q0) - f(p0, q0)]
                      + sum over terms of Q of [f(p0, q) - f(p0, q0)]
                      + sum over common terms of [f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)]

The first two sums need only how many terms a group has of each count; the last one runs over
the sources of one term at a time and adds up inside the task. All of it is exact.

Null text, language and source count as ''. Every row is a document, whatever its id; repeated
rows count each time. Texts without terms make their group occur, but add no term; where a
language keeps none, all its pairs have the value 0. An empty table gives no rows. Texts are
read in pieces, so long ones need memory for their distinct terms only. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatlake.session import checkpointed, lookup, staged_path

SCALE = 1_000_000_000
MIN_DOCS = 3
TOP_TERMS = 200

# Terms are runs of ASCII letters and code points from 128 on: in UTF-8, of these bytes.
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))
# Bytes of a text split at a time, terms counted together, entries that a task holds before they
# are sent on, and pairs of sources evaluated at a time.
PIECE_BYTES = 1 << 22
COUNT_AT_ONCE = 1 << 20
HELD_ENTRIES = 1 << 20
PAIRS_AT_ONCE = 1 << 20
# Counts up to this are scaled in 64 bits.
_SMALL = (1 << 63) // SCALE - 2

_TERMS = "lang string, term string, docs long, by array<struct<group:long,n:long>>"


class _Ids(dict):
    """A number for every term."""

    def __missing__(self, term: bytes) -> int:
        self[term] = len(self)
        return self[term]


def _starts(*sorted_keys: np.ndarray) -> np.ndarray:
    """Where a run of equal keys begins."""
    new = np.ones(len(sorted_keys[0]), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in sorted_keys])
    return np.flatnonzero(new)


def _added(values: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, ...]:
    """The distinct keys in order and the sums of their values."""
    if not len(values):
        return *keys, values
    order = np.lexsort(keys[::-1])
    keys = tuple(k[order] for k in keys)
    at = _starts(*keys)
    return *(k[at] for k in keys), np.add.reduceat(values[order], at)


def _batch(lang: pa.Array, term: pa.Array, docs: np.ndarray, sizes: np.ndarray, group: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    by = pa.ListArray.from_arrays(pa.array(bounds), pa.StructArray.from_arrays([pa.array(group), pa.array(n)], ["group", "n"]))
    return pa.RecordBatch.from_arrays([lang, term, pa.array(docs), by], ["lang", "term", "docs", "by"])


class _Language:
    """Counts of one language in one task."""

    def __init__(self) -> None:
        none = np.zeros(0, np.int64)
        self.ids = _Ids()
        self.documents = none, none  # term, rows
        self.words = none, none, none  # term, group, words
        self.texts: list[tuple[np.ndarray, np.ndarray | None, np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, text: bytes, group: np.ndarray, n: np.ndarray) -> None:
        find = self.ids.__getitem__
        if len(text) <= PIECE_BYTES:
            terms, times = np.array(list(map(find, text.split())), np.int64), None
        else:
            terms = times = np.zeros(0, np.int64)
            at = 0
            while at < len(text):
                end = text.find(b" ", at + PIECE_BYTES)
                end = len(text) if end < 0 else end
                more = np.array(list(map(find, text[at:end].split())), np.int64)
                terms, times = _added(np.concatenate([times, np.ones(len(more), np.int64)]), np.concatenate([terms, more]))
                at = end
        self.texts.append((terms, times, group, n))
        self.waiting += len(terms)
        if self.waiting >= COUNT_AT_ONCE:
            self.count()

    def count(self) -> None:
        if not self.texts:
            return
        terms = np.concatenate([t[0] for t in self.texts])
        times = np.concatenate([np.ones(len(t[0]), np.int64) if t[1] is None else t[1] for t in self.texts])
        text = np.repeat(np.arange(len(self.texts)), [len(t[0]) for t in self.texts])
        terms, text, times = _added(times, terms, text)
        group, n = (np.concatenate([t[i] for t in self.texts]) for i in (2, 3))
        width = np.array([len(t[2]) for t in self.texts])
        first, total = np.cumsum(width) - width, np.array([t[3].sum() for t in self.texts])
        self.documents = _added(*map(np.concatenate, ((self.documents[1], total[text]), (self.documents[0], terms))))
        wide = width[text]
        at = np.repeat(first[text], wide) + np.arange(wide.sum()) - np.repeat(np.cumsum(wide) - wide, wide)
        found = np.repeat(terms, wide), group[at], np.repeat(times, wide) * n[at]
        held = [np.concatenate(x) for x in zip(self.words, found)]
        self.words = _added(held[2], held[0], held[1])
        self.texts, self.waiting = [], 0

    def rows(self, lang: str) -> Iterator[pa.RecordBatch]:
        self.count()
        names = pa.array(list(self.ids), pa.binary()).cast(pa.string())
        term, docs = self.documents
        sizes = np.bincount(self.words[0], minlength=len(names))[term]
        if len(term):
            yield _batch(pa.repeat(lang, len(term)), names.take(pa.array(term)), docs, sizes, self.words[1], self.words[2])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, _Language] = {}
    for batch in batches:
        langs, texts, by = batch.column(0).to_pylist(), batch.column(1), batch.column(2)
        bounds = by.offsets.to_numpy()
        group, n = (by.values.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        for i, lang in enumerate(langs):
            own = slice(bounds[i], bounds[i + 1])
            text = texts[i].as_buffer().to_pybytes().translate(_LOWER)
            held.setdefault(lang, _Language()).add(text, group[own], n[own])
        if sum(len(x.words[0]) + len(x.ids) for x in held.values()) > HELD_ENTRIES:
            for lang, own in held.items():
                yield from own.rows(lang)
            held = {}
    for lang, own in held.items():
        yield from own.rows(lang)


def _joined(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Rows of one term that follow each other, added up to one row."""
    lang, term, by = batch.column(0), batch.column(1), batch.column(3)
    change = np.ones(batch.num_rows, bool)
    change[1:] = pc.or_(pc.not_equal(lang[1:], lang[:-1]), pc.not_equal(term[1:], term[:-1])).to_numpy(zero_copy_only=False)
    at = np.flatnonzero(change)
    docs = np.add.reduceat(batch.column(2).to_numpy(), at)
    bounds = by.offsets.to_numpy()
    group, n = (by.values.field(i).to_numpy(zero_copy_only=False)[bounds[0] : bounds[-1]] for i in (0, 1))
    row, group, n = _added(n, np.repeat(np.cumsum(change) - 1, np.diff(bounds)), group)
    return _batch(lang.take(pa.array(at)), term.take(pa.array(at)), docs, np.bincount(row, minlength=len(at)), group, n)


def _merged(batches: Iterator[pa.RecordBatch], min_docs: int) -> Iterator[pa.RecordBatch]:
    """One row per term that enough documents have, from rows in order of language and term."""

    def kept(rows: pa.RecordBatch) -> pa.RecordBatch:
        return rows.filter(pc.greater_equal(rows.column(2), min_docs))

    last = None
    for batch in batches:
        if batch.num_rows:
            rows = _joined(pa.concat_batches([last, batch.cast(last.schema)]) if last is not None else batch)
            yield kept(rows.slice(0, rows.num_rows - 1))
            last = rows.slice(rows.num_rows - 1)
    if last is not None:
        yield kept(last)


def _collapsed(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang``, ``text`` and ``by`` (structs of group and n, its number of rows with the text), one row
    per language and distinct text. The texts are sent once."""
    key = ["lang", "h", "g"]
    counted = docs.groupBy("lang", "source", "h", "g").agg(F.count("*").alias("n")).join(lookup(groups.select("lang", "source", "group")), ["lang", "source"])
    by = counted.groupBy(*key).agg(F.collect_list(F.struct("group", "n")).alias("by"))
    return docs.groupBy(*key).agg(F.first("text").alias("text")).join(by, key).select("lang", "text", "by")


def _plain(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    named = docs.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    return named.withColumns({"h": F.xxhash64("text"), "g": F.xxhash64(F.lit(1), "text")})


def _staged(df: DataFrame, label: str) -> DataFrame:
    path = staged_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def share(count: Column, words: Column, terms: Column) -> Column:
    """p of a count, exact for any count."""
    count = count.cast("long")
    wide = (count + 1).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    wide = F.call_function("div", wide, (words + terms).cast("decimal(20,0)")).cast("long")
    return F.when(count <= _SMALL, F.call_function("div", (count + 1) * SCALE, words + terms)).otherwise(wide) + 1


def distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = p - q
    return d * d // q


def _summed(ones: np.ndarray, others: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums of the values of equal pairs (one, other)."""
    names, code = np.unique(np.concatenate([ones, others]), return_inverse=True)
    keys, back = np.unique(code[: len(ones)] * len(names) + code[len(ones) :], return_inverse=True)
    total = np.zeros(len(keys), np.int64)
    np.add.at(total, back, values)
    return names[keys // len(names)], names[keys % len(names)], total


def _common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums over common terms for every two groups, from rows of structs (group, p, p0)."""
    empty = np.zeros(0, np.int64)
    held = empty, empty, empty

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(list(map(pa.array, held)), ["one", "other", "value"])

    for batch in batches:
        lists = batch.column(0)
        bounds = lists.offsets.to_numpy().astype(np.int64)
        group, p, p0 = (lists.values.field(i).to_numpy(zero_copy_only=False) for i in range(3))
        sizes = np.diff(bounds)
        # entry by entry: each stands against all entries of its row
        entry = np.arange(bounds[0], bounds[-1])
        width, first = np.repeat(sizes, sizes), np.repeat(bounds[:-1], sizes)
        steps = np.cumsum(width)
        at = 0
        while at < len(entry):
            done = steps[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(steps, done + PAIRS_AT_ONCE, "right")))
            w = width[at:end]
            one = np.repeat(entry[at:end], w)
            other = np.repeat(first[at:end], w) + np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w)
            apart = one != other
            one, other = one[apart], other[apart]
            value = _f(p[one], p[other]) - _f(p[one], p0[other]) - _f(p0[one], p[other]) + _f(p0[one], p0[other])
            parts = _summed(group[one], group[other], value)
            held = _summed(*(np.concatenate(x) for x in zip(held, parts)))
            if len(held[0]) > HELD_ENTRIES:
                yield out()
                held = empty, empty, empty
            at = end
    if len(held[0]):
        yield out()


class Audit:
    """Counts of a corpus, and the reports on them.

    ``groups``: group (a number), lang, source, words (N), terms (V), p0.
    ``kept``: one row per kept term with at, lang, term, n (in its language), q and ``by``, its groups."""

    def __init__(self, docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_docs: int = MIN_DOCS) -> None:
        plain = _plain(docs, text_col, lang_col, source_col)
        occurring = checkpointed(plain.select("lang", "source").distinct().withColumn("group", F.monotonically_increasing_id()))
        counted = _collapsed(plain, occurring).mapInArrow(_count, _TERMS)
        ordered = counted.repartition("lang", "term").sortWithinPartitions("lang", "term")
        merged = ordered.mapInArrow(lambda batches: _merged(batches, min_docs), _TERMS)
        terms = _staged(merged.select(F.monotonically_increasing_id().alias("at"), "lang", "term", "by"), "kept-terms")
        terms = terms.withColumn("n", F.expr("aggregate(by, 0L, (s, x) -> s + x.n)"))
        langs = checkpointed(terms.groupBy("lang").agg(F.sum("n").alias("lang_words"), F.count("*").alias("terms")))
        words = terms.select(F.inline("by")).groupBy("group").agg(F.sum("n").alias("words"))
        groups = occurring.join(words, "group", "left").join(langs.drop("lang_words"), "lang", "left")
        numbers = {"words": F.coalesce("words", F.lit(0)), "terms": F.coalesce("terms", F.lit(0))}
        p0 = F.when(F.col("terms") > 0, share(F.lit(0), F.col("words"), F.col("terms")))
        self.groups = checkpointed(groups.withColumns(numbers).withColumn("p0", p0).select("group", "lang", "source", "words", "terms", "p0"))
        q = share(F.col("n"), F.col("lang_words"), F.col("terms"))
        self.kept = terms.join(lookup(langs), "lang").select("at", "lang", "term", q.alias("q"), "by")

    def _each(self, *columns: str) -> DataFrame:
        """One row per kept term and group that has it, with its share p and that of a count of zero."""
        own = self.groups.select("group", "words", "terms", "p0", "source")
        each = self.kept.select(*columns, F.inline("by")).join(lookup(own), "group")
        return each.select(*columns, "group", "source", share(F.col("n"), F.col("words"), F.col("terms")).alias("p"), "p0")

    def _against(self) -> DataFrame:
        """Every two groups of a language, as ``one`` and ``other`` with their numbers."""
        names = ["group", "lang", "source", "terms", "p0"]
        one = self.groups.select(*[F.col(c).alias(f"one_{c}") for c in names])
        other = self.groups.select(*[F.col(c).alias(f"other_{c}") for c in names])
        return one.join(other, (F.col("one_lang") == F.col("other_lang")) & (F.col("one_source") != F.col("other_source")))

    def pairs(self) -> DataFrame:
        """``lang``, ``source``, ``other`` and ``value``: the divergence of each source from each other
        one of its language."""
        wide = "decimal(38,0)"
        pairs = checkpointed(self._against())
        p0, q0 = F.col("one_p0"), F.col("other_p0")
        base = pairs.select(F.col("one_group").alias("one"), F.col("other_group").alias("other"), F.coalesce(F.col("one_terms") * distance(p0, q0).cast(wide), F.lit(0).cast(wide)).alias("value"))
        levels = checkpointed(self._each().groupBy("group", "p").agg(F.count("*").alias("m")))
        left = levels.join(lookup(pairs), F.col("group") == F.col("one_group"))
        left = left.select(F.col("one_group").alias("one"), F.col("other_group").alias("other"), (F.col("m") * (distance(F.col("p"), q0) - distance(p0, q0)).cast(wide)).alias("value"))
        right = levels.join(lookup(pairs), F.col("group") == F.col("other_group"))
        right = right.select(F.col("one_group").alias("one"), F.col("other_group").alias("other"), (F.col("m") * (distance(p0, F.col("p")) - distance(p0, q0)).cast(wide)).alias("value"))
        lists = self._each("at").groupBy("at").agg(F.collect_list(F.struct("group", "p", "p0")).alias("by")).where("size(by) > 1").select("by")
        common = lists.mapInArrow(_common, "one long, other long, value long").withColumn("value", F.col("value").cast(wide))
        every = base.union(left).union(right).union(common)
        values = checkpointed(every.groupBy("one", "other").agg(F.sum("value").cast("long").alias("value")))
        named = values.join(pairs, (F.col("one") == F.col("one_group")) & (F.col("other") == F.col("other_group")))
        return named.select(F.col("one_lang").alias("lang"), F.col("one_source").alias("source"), F.col("other_source").alias("other"), "value")

    def terms(self) -> DataFrame:
        """``lang``, ``source``, ``term`` and ``value``: terms that a source has more often than its language."""
        p, q = F.col("p"), F.col("q")
        return self._each("lang", "term", "q").where(p > q).select("lang", "source", "term", distance(p, q).alias("value"))

    def report(self, top_terms: int = TOP_TERMS) -> DataFrame:
        """``lang``, ``source``, ``part``, ``item``, ``value`` and ``rank``: all pairs, and the first terms."""
        rank = F.expr("row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)").alias("rank")
        pairs = self.pairs().withColumnRenamed("other", "item").select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank)
        terms = self.terms().withColumnRenamed("term", "item").select("lang", "source", F.lit("term").alias("part"), "item", "value", rank)
        return pairs.union(terms.where(F.col("rank") <= top_terms))
