"""Substring deduplication by relative Lempel-Ziv parsing.

Every document is parsed against the blocks of the documents with smaller ids. A block is a run of
words whose windows of WINDOW words stand nowhere before, so each window is indexed once, with
its first document and place. Parsing is greedy: where the window at a word is indexed, the factor
is the longest run of words that goes on inside that block, and the next factor starts at the first
window beyond it; words outside all factors are literals. Neighbouring factors may overlap
by less than a window: a window across their boundary counts just if the index has it, so removal
follows the windows exactly.

To index only text that can occur twice, each window is represented by its anchor, the run of ANCHOR
words in it with the least hash: equal windows have equal anchors, so windows whose anchor stands
in one document only cannot be copied and are never sent.

Words are runs of bytes other than space and the five control characters behind tab. A window is
known by 96 bits of two sums of word hashes times odd constants. Documents with the same
text as one with a smaller id are wholly copied if they have a window at all; they are set
apart first, so large groups of copies are neither indexed nor compared.

What one step leaves for the next is written, and the files of finished steps go before the next
one begins: at most one shuffle of texts and those of the windows are on disk at a time. Texts go to
Python in batches of bounded bytes, so an executor needs little memory besides its heap.

Null and empty texts have no words, and texts under WINDOW words lose none. Repeated rows
with one id and text are one document to each other and lose nothing by that. A text without
an id, and every text of an id that has several, is a document behind all that have an id,
in the order of the hash of its text. An empty table gives no rows. Only the id and text
columns are read. Ids are below 2^62.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatlake.llm.common import release, small_batches, staged, text_of
from chatlake.session import lookup

WINDOW = 13
ANCHOR = 4
# Rows of windows that a task hands on at once, or more if one text has more.
WINDOW_ROWS = 1 << 16
# Keys from here on stand for texts without an id of their own.
APART = 1 << 62
FACTORS = "factors array<struct<start:int,words:int,source:long,source_start:int>>"
_FACTOR = pa.struct([("start", pa.int32()), ("words", pa.int32()), ("source", pa.int64()), ("source_start", pa.int32())])

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_ODD = np.random.default_rng(20250101).integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
# Constants of the second hash of a window start here.
_CHECK = 32


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def _grams(words: np.ndarray, length: int) -> np.ndarray:
    """A hash for every run of ``length`` words."""
    n = len(words) - length + 1
    total = np.zeros(n, np.uint64)
    for i in range(length):
        total += words[i : i + n] * _ODD[i]
    return _mixed(total)


def _anchors(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ANCHOR words, and the place of each window's anchor."""
    grams = _grams(words, ANCHOR)
    span = WINDOW - ANCHOR + 1
    least = grams[: len(grams) - span + 1].copy()
    place = np.arange(len(least))
    for i in range(1, span):
        other = grams[i : i + len(least)]
        lower = other < least
        least[lower] = other[lower]
        place[lower] = np.flatnonzero(lower) + i
    return grams, place


def _hashes(text: bytes) -> np.ndarray:
    return np.array(list(map(xxhash.xxh64_intdigest, text.split())), np.uint64)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _texts(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """``id`` (the key by which documents are told apart and ordered), ``own_id`` and ``text``."""
    base = docs.select(F.col(id_col).cast("long").alias("own_id"), text_of(text_col).alias("text"), *more)
    hashed = base.where("own_id is not null").select(F.col("own_id").alias("again"), F.xxhash64("text").alias("h"))
    several = hashed.groupBy("again").agg(F.min("h").alias("low"), F.max("h").alias("high")).where("low < high")
    several = lookup(staged(several.select("again"), "ids-of-several-texts"))
    apart = F.xxhash64("text").bitwiseAND(F.lit(APART - 1)).bitwiseOR(F.lit(APART))
    key = F.when(F.col("own_id").isNull() | F.col("again").isNotNull(), apart).otherwise(F.col("own_id"))
    return base.join(several, F.col("own_id") == F.col("again"), "left").withColumn("id", key).drop("again")


def copies(texts: DataFrame) -> DataFrame:
    """``id`` of every document that has the text of one with a smaller id, and ``copy_of``, the least of these."""
    hashed = texts.select("id", F.xxhash64("text").alias("h"), F.xxhash64(F.lit(1), "text").alias("g"))
    first = hashed.groupBy("h", "g").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last")
    return hashed.join(first.select("h", "g", "first"), ["h", "g"]).where("id > first").select("id", F.col("first").alias("copy_of")).distinct()


def _emit_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), batch.column(1)
        hashes, owners, size = [], [], 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(owners)), _signed(np.concatenate(hashes))], ["id", "anchor"])

        for i, key in enumerate(ids):
            words = _hashes(texts[i].as_buffer().to_pybytes())
            if len(words) < WINDOW:
                continue
            grams, place = _anchors(words)
            own = np.unique(grams[place])
            hashes.append(own)
            owners.append(np.full(len(own), key, np.int64))
            size += len(own)
            if size > 1 << 18:
                yield out()
                hashes, owners, size = [], [], 0
        if size:
            yield out()


def _emit_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    made: list[tuple[np.ndarray, ...]] = []
    size = 0

    def out() -> pa.RecordBatch:
        w, own, spot = (np.concatenate(c) for c in zip(*made))
        return pa.RecordBatch.from_arrays([_signed(w), pa.array(own), _signed(spot)], ["w", "id", "spot"])

    for batch in batches:
        ids, texts, known = batch.column(0).to_pylist(), batch.column(1), batch.column(2)
        for i, key in enumerate(ids):
            words = _hashes(texts[i].as_buffer().to_pybytes())
            grams, place = _anchors(words)
            shared = known[i].values.to_numpy(zero_copy_only=False).view(np.uint64)
            at = np.flatnonzero(np.isin(grams[place], shared))
            whole, check = np.zeros(len(at), np.uint64), np.zeros(len(at), np.uint64)
            for k in range(WINDOW):
                word = words[at + k]
                whole += word * _ODD[k]
                check += word * _ODD[_CHECK + k]
            spot = (at.astype(np.uint64) << np.uint64(32)) | (_mixed(check) >> np.uint64(32))
            made.append((_mixed(whole), np.full(len(at), key, np.int64), spot))
            size += len(at)
            if size > WINDOW_ROWS:
                yield out()
                made, size = [], 0
    if size:
        yield out()


def _shared_anchors(texts: DataFrame, copied: DataFrame) -> DataFrame:
    """``id`` and ``anchors``: those that stand in another document too. Copies are left out."""
    anchors = texts.join(lookup(copied), "id", "left_anti").mapInArrow(_emit_anchors, "id long, anchor long")
    found = anchors.groupBy("anchor").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high")
    # both sides of the join are plain exchanges, so an anchor in very many documents is split
    found = staged(found.select("anchor"), "shared-anchors")
    release(texts.sparkSession)
    lists = staged(anchors.join(found, "anchor", "left_semi").groupBy("id").agg(F.collect_list("anchor").alias("anchors")), "anchor-lists")
    release(texts.sparkSession, found)
    return lists


def _windows(texts: DataFrame, lists: DataFrame) -> DataFrame:
    """``w``, ``id`` and ``spot`` (place, and a second hash in the low half) of windows with a shared anchor."""
    made = staged(texts.join(lists, "id").select("id", "text", "anchors").mapInArrow(_emit_windows, "w long, id long, spot long"), "windows")
    release(texts.sparkSession, lists)
    return made.select("w", F.col("spot").bitwiseAND((1 << 32) - 1).alias("check"), "id", F.shiftright("spot", 32).cast("int").alias("at"))


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = batch.column(1)
        bounds = found.offsets.to_numpy()
        at, source, there = (found.values.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3))
        pieces = [factors(at[a:b], source[a:b], there[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([list(map(tuple, p.tolist())) for p in pieces], pa.list_(_FACTOR))], ["id", "factors"])


def matches(texts: DataFrame) -> DataFrame:
    """``id``, ``copy_of`` (the first document with the whole text, if it is a copy) and the ``factors``
    of a document, as structs of start, words, source and start there."""
    spark = texts.sparkSession
    with small_batches(spark):
        copied = staged(copies(texts), "copies")
        windows = _windows(texts, _shared_anchors(texts, copied))
        first = windows.groupBy("w", "check").agg(F.min("id").alias("source"), F.min_by("at", "id").alias("source_at"), F.max("id").alias("last"))
        # joined by another key than they were grouped by: again two plain exchanges
        turned = F.bitwise_not("w").alias("v")
        first = first.where("source < last").select(turned, "check", "source", "source_at")
        found = windows.select(turned, "check", "id", "at").join(first, ["v", "check"]).where("id > source")
        found = found.groupBy("id").agg(F.collect_list(F.struct("at", "source", "source_at")).alias("found"))
        parsed = staged(found.mapInArrow(_parse, f"id long, {FACTORS}"), "factors")
        release(spark, windows)
    return parsed.join(copied, "id", "full").select("id", "copy_of", "factors")


def factors(at: np.ndarray, source: np.ndarray, there: np.ndarray) -> np.ndarray:
    """Greedy factors, as rows of start, words, source and start there, from the indexed windows of a
    document: each goes on while the next word continues the same block."""
    at, first = np.unique(at, return_index=True)
    if not len(at):
        return np.zeros((0, 4), np.int64)
    source, there = source[first], there[first]
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) != 1) | (np.diff(source) != 0) | (np.diff(there) != 1)
    begin = np.flatnonzero(new)
    words = np.diff(np.append(begin, len(at))) + WINDOW - 1
    return np.stack([at[begin], words, source[begin], there[begin]], axis=1)


def covered(n: int, pieces: list[dict]) -> np.ndarray:
    """Which of ``n`` words go."""
    mask = np.zeros(n, bool)
    for piece in pieces:
        mask[piece["start"] : piece["start"] + piece["words"]] = True
    return mask


def _parsed(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    texts = _texts(docs, id_col, text_col, *more)
    # not by broadcast where factors are few: what a text costs is the same at every size
    return texts.join(matches(texts.select("id", "text")), "id", "left")


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[bytes, list[dict], np.ndarray]]:
    """Text, factors and mask of the words that go, for each row of id, text, copy_of, factors."""
    texts, copy = batch.column(1), batch.column(2).to_pylist()
    for i in range(batch.num_rows):
        text = texts[i].as_buffer().to_pybytes()
        n = len(text.split())
        pieces = batch.column(3)[i].as_py() or []
        if copy[i] is not None:
            pieces = [{"start": 0, "words": n, "source": copy[i], "source_start": 0}] if n >= WINDOW else []
        yield text, pieces, covered(n, pieces)


def removal(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, n_words, n_removed, kept_sha256 and the ``factors`` as structs of
    start, words, source and source_start. Sources without an id of their own have a number from
    2^62 on."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: tuple[list, ...] = ([], [], [], [])
            for text, pieces, mask in _rows(batch):
                kept = b" ".join([w for w, gone in zip(text.split(), mask.tolist()) if not gone])
                row = len(mask), int(mask.sum()), hashlib.sha256(kept).hexdigest(), pieces
                for column, value in zip(columns, row):
                    column.append(value)
            arrays = [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string(), pa.list_(_FACTOR))))]
            yield pa.RecordBatch.from_arrays(arrays, [id_col, "n_words", "n_removed", "kept_sha256", "factors"])

    ddl = f"`{id_col}` long, n_words long, n_removed long, kept_sha256 string, {FACTORS}"
    done = _parsed(docs, id_col, text_col).select("own_id", "text", "copy_of", "factors").mapInArrow(work, ddl)
    with small_batches(docs.sparkSession):
        return staged(done, "removal")


def cut(text: bytes, mask: np.ndarray) -> bytes:
    """The text without the masked words; what stays keeps its white space, and one blank
    stands where words went."""
    spans = [m.span() for m in _WORD.finditer(text)]
    kept: list[bytes] = []
    i = 0
    while i < len(spans):
        if mask[i]:
            i += 1
            continue
        j = i
        while j < len(spans) and not mask[j]:
            j += 1
        kept.append(text[spans[i][0] : spans[j - 1][1]])
        i = j
    return b" ".join(kept)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with repeated words cut out of ``text_col`` and ``n_chars``, if there is such a
    column, brought up to date. A text that loses nothing stays as it is; a document that
    loses every word goes. Ids keep their type and other columns pass through."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, stays = [], []
            for text, _, mask in _rows(batch):
                gone = mask.any()
                out.append((cut(text, mask) if gone else text).decode())
                stays.append(not gone or not mask.all())
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), pa.array(stays), batch.column(4)], ["__cut", "__stays", "__row"])

    names = docs.columns
    kept = F.struct(*[F.col(f"`{c}`") for c in names if c != text_col], F.col(text_col).isNull().alias("__null"))
    joined = _parsed(docs, id_col, text_col, kept.alias("__row")).select("id", "text", "copy_of", "factors", "__row")
    row = joined.schema["__row"].dataType
    done = joined.mapInArrow(work, f"__cut string, __stays boolean, __row {row.simpleString()}").where("__stays")
    new = F.when(~F.col("__row.__null"), F.col("__cut"))
    columns = [new.alias(c) if c == text_col else F.length("__cut").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(f"__row.`{c}`").alias(c) for c in names]
    return done.select(*columns)
