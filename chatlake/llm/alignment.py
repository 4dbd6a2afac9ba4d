"""Alignment of the tokens of two tokenizers over the bytes of each text.

A is a byte-level tokenizer of the tokenizers library, B a sentencepiece model that adds a space
before the text; A reads the text behind a space, so both cover the same bytes. Tokens stand at
byte offsets. Per batch pandas ``merge_asof`` finds for the start of each token the token of
the other side that covers it; the union of both directions is all pairs that overlap (the
links), and where starts are equal the tokens before end together, which cuts groups. The
documents of a batch lie one behind another on a single axis of offsets, which keys the merge by
document: a start never meets a token of another text.

The links stay packed with their row. Links of equal ids are counted over the corpus, and a
second pass adds the counts up per document: against a broadcast table of counts if it is
measured to be small, else by a shuffled join of each document's distinct pairs.

Neither tokenizer joins characters across a blank that follows other text, so a text is encoded
in units, each with the blank before it, and the ids of frequent units are remembered. That
B's vocabulary allows this is checked when it is loaded. Long texts are aligned in pieces that
end between units, where both sides end a token.

A null or empty text, and one whose joined token bytes of A or B differ from space and text, has
no tokens: zeros, and '' as hash. Rows are documents, whatever their ids: null and repeated
ids are kept, repeated rows count their links each time. An empty table gives no rows.
Only the id and text columns are read.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatlake.llm.common import remove_tree, runs, text_of
from chatlake.session import checkpointed, estimated_bytes, staged_path

# The code points that Unicode calls white space.
_WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_CUT = re.compile(f"(?<=[^{_WHITE}]) (?=[\\s\\S])")
# Blanks behind other white space; texts without them are cut at every blank.
_RUNS = [chr(c) + " " for c in [*range(9, 14), 32, 133, 160, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]]
_BYTE = re.compile("<0x([0-9A-F]{2})>")
# The mark of sentencepiece for a blank.
_BLANK = "\u2581"

PIECE_CHARS = 1 << 18
REMEMBERED = 1 << 17
# Words of letters below this are one piece of A's first step, so its model alone encodes them.
_LATIN = "\u0250"
COUNT_AT_ONCE = 1 << 20
# Counts are broadcast up to this size.
COUNTS_BYTES = 64 << 20
DIGEST = ["n_a", "n_b", "n_groups", "n_links"]


def _byte_characters() -> dict[str, int]:
    """The character by which byte-level vocabularies write each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class ByteLevel:
    """Side A: a tokenizer file of the tokenizers library with a byte-level vocabulary."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks are the parallelism
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        of = _byte_characters()
        self.written = {b: c for c, b in of.items()}
        vocabulary = self.tokenizer.get_vocab()
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes[i] = bytes(map(of.__getitem__, token)) if all(c in of for c in token) else token.encode()

    def encode(self, units: list[str]) -> list[list[int]]:
        """Ids of units, each behind its blank."""
        model, written, out = self.tokenizer.model, self.written, []
        for unit in units:
            if unit.isalpha() and max(unit) < _LATIN:
                whole = (" " + unit).encode().decode("latin-1").translate(written)
                out.append([t.id for t in model.tokenize(whole)])
            else:
                out.append(self.tokenizer.encode(" " + unit, add_special_tokens=False).ids)
        return out


class Pieces:
    """Side B: a sentencepiece model with byte fallback."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [bytes([int(m[1], 16)]) if (m := _BYTE.fullmatch(p)) else p.replace(_BLANK, " ").encode() for p in pieces]
        if any(_BLANK in p.lstrip(_BLANK) for p in pieces):
            raise ValueError("pieces of this model go across blanks, so its texts cannot be encoded in units")

    def encode(self, units: list[str]) -> list[list[int]]:
        return self.model.encode(units, num_threads=1)


class Units(dict):
    """Ids of both sides for a unit, packed, or None where they do not give its bytes; in two
    generations, of which the older one goes when the newer is full."""

    def __init__(self, a: ByteLevel, b: Pieces) -> None:
        self.a, self.b = a, b
        self.older: dict[str, tuple[bytes, bytes] | None] = {}

    def learn(self, units: set[str]) -> None:
        """Encode the units that are not known."""
        if len(self) > REMEMBERED:
            self.older = dict(self)
            self.clear()
        older, new = self.older, []
        for unit in units.difference(self):
            if unit in older:
                self[unit] = older[unit]
            else:
                new.append(unit)
        bytes_a, bytes_b = self.a.bytes, self.b.bytes
        for unit, ids_a, ids_b in zip(new, self.a.encode(new), self.b.encode(new) if new else []):
            whole = b" " + unit.encode()
            same = b"".join([bytes_a[i] for i in ids_a]) == whole and b"".join([bytes_b[i] for i in ids_b]) == whole
            self[unit] = (array("I", ids_a).tobytes(), array("I", ids_b).tobytes()) if same else None


def _cut(text: str) -> list[str]:
    """The units of a text without the blank before each."""
    if text[:1] == " " or text[-1:] == " " or any(run in text for run in _RUNS):
        return _CUT.split(text)
    return text.split(" ")


def _pieces(text: str) -> Iterator[list[str]]:
    """The units of a text, a bounded number of characters at a time (one unit at least)."""
    at = 0
    while at <= len(text):
        cut = _CUT.search(text, at + PIECE_CHARS) if len(text) - at > PIECE_CHARS else None
        end = cut.start() if cut else len(text)
        yield _cut(text[at:end])
        at = end + 1


def link_kind(n_a: int, n_b: int) -> str:
    """How links are packed: little-endian, in as many bytes as the vocabularies need."""
    return "<u4" if n_a * n_b < 1 << 32 else "<u8"


class Aligner:
    """Both tokenizers and what is needed to align tokens of a batch."""

    def __init__(self, a_path: str, b_path: str) -> None:
        a, b = ByteLevel(a_path), Pieces(b_path)
        self.units = Units(a, b)
        self.lengths = [np.array(list(map(len, side.bytes)), np.int64) for side in (a, b)]
        self.n_b = len(b.bytes)
        self.kind = link_kind(len(a.bytes), self.n_b)
        # how ids are written: the last token of A in a group ends with |, that of B with ;
        self.written = np.array([b"%d%s" % (i, end) for i in range(len(a.bytes)) for end in (b",", b"|")] + [b"%d%s" % (i, end) for i in range(self.n_b) for end in (b",", b";")], object)
        self.b_written = 2 * len(a.bytes)

    def align(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, ...]:
        """For the tokens of some texts laid one behind another: the token of B that covers the start of each
        token of A, the one of A for each of B, and which tokens begin a group on either side."""
        ends = [np.cumsum(lengths[ids]) for lengths, ids in zip(self.lengths, (a, b))]
        one, two = (pd.DataFrame({"start": end - lengths[ids], "token": np.arange(len(ids))}) for end, lengths, ids in zip(ends, self.lengths, (a, b)))
        b_of_a = pd.merge_asof(one[["start"]], two, on="start")["token"].to_numpy()
        a_of_b = pd.merge_asof(two[["start"]], one, on="start")["token"].to_numpy()
        starts = [frame["start"].to_numpy() for frame in (one, two)]
        return b_of_a, a_of_b, starts[0] == starts[1][b_of_a], starts[1] == starts[0][a_of_b]

    def packed(self, texts: list[list[str]]) -> list[tuple[bytes, bytes] | None]:
        """Ids of both sides for texts given as units; None where a unit does not give its bytes."""
        self.units.learn(set().union(*texts))
        out = []
        for units in texts:
            found = list(map(self.units.__getitem__, units))
            out.append(None if None in found else (b"".join([f[0] for f in found]), b"".join([f[1] for f in found])))
        return out

    def batch(self, packed: list[tuple[bytes, bytes]]) -> list[tuple[int, int, int, bytes, bytes]]:
        """Per text, as packed ids of both sides: number of tokens of A and B and of groups, groups
        as text with a semicolon behind each, links as packed numbers."""
        a, b = (np.frombuffer(b"".join([own[side] for own in packed]), "<u4").astype(np.int64) for side in (0, 1))
        sizes = [np.cumsum([0, *[len(own[side]) // 4 for own in packed]]) for side in (0, 1)]
        b_of_a, a_of_b, new_a, new_b = self.align(a, b)
        group_a, group_b = np.cumsum(new_a) - 1, np.cumsum(new_b) - 1
        per_a, per_b = np.bincount(group_a), np.bincount(group_b)
        # tokens of a group: those of A, then those of B
        at_a = np.arange(len(a)) + (np.cumsum(per_b) - per_b)[group_a]
        at_b = np.arange(len(b)) + np.cumsum(per_a)[group_b]
        codes = np.empty(len(a) + len(b), np.int64)
        codes[at_a] = 2 * a + np.append(new_a[1:], True)
        codes[at_b] = self.b_written + 2 * b + np.append(new_b[1:], True)
        words = self.written[codes]
        more = np.flatnonzero(~new_b)  # equal starts are linked from A already
        links = a * self.n_b + b[b_of_a], a[a_of_b[more]] * self.n_b + b[more]
        cuts = np.searchsorted(more, sizes[1])
        out = []
        for i in range(len(packed)):
            (la, ra), (lb, rb) = (s[i : i + 2] for s in sizes)
            own = np.concatenate([links[0][la:ra], links[1][cuts[i] : cuts[i + 1]]]).astype(self.kind)
            groups = int(group_a[ra - 1] - group_a[la] + 1)
            out.append((int(ra - la), int(rb - lb), groups, b"".join(words[la + lb : ra + rb].tolist()), own.tobytes()))
        return out


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    if (a_path, b_path) not in _aligners:
        _aligners[a_path, b_path] = Aligner(a_path, b_path)
    return _aligners[a_path, b_path]


def align_texts(own: Aligner, texts: list[str]) -> Iterator[tuple[int, int, int, int, str, bytes]]:
    """n_a, n_b, n_groups, n_links, groups_sha256 and packed links of each text."""
    nothing, width = (0, 0, 0, 0, "", b""), int(own.kind[2])
    short = [i for i, text in enumerate(texts) if 0 < len(text) <= PIECE_CHARS]
    packed = dict(zip(short, own.packed([_cut(texts[i]) for i in short])))
    known = [p for p in packed.values() if p is not None]
    found = iter(own.batch(known) if known else [])
    for i, text in enumerate(texts):
        if packed.get(i) is not None:
            n_a, n_b, groups, written, links = next(found)
            yield n_a, n_b, groups, len(links) // width, hashlib.sha256(written[:-1]).hexdigest(), links
        elif len(text) > PIECE_CHARS and all(own.packed([piece])[0] is not None for piece in _pieces(text)):
            digest, sums, parts = hashlib.sha256(), [0, 0, 0], []
            for piece in _pieces(text):
                n_a, n_b, groups, written, links = own.batch(own.packed([piece]))[0]
                digest.update(b";" * bool(parts) + written[:-1])
                parts.append(links)
                sums = [x + y for x, y in zip(sums, (n_a, n_b, groups))]
            links = b"".join(parts)
            yield *sums, len(links) // width, digest.hexdigest(), links
        else:
            yield nothing


def aligned(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, n_a, n_b, n_groups, n_links, groups_sha256 and ``links``: numbers a * size of B's
    vocabulary + b, packed as ``link_kind`` says, one for each two tokens that overlap."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(a_path, b_path)
        for batch in batches:
            column = batch.column(1)
            for start, end in runs(pc.binary_length(column).to_pylist(), PIECE_CHARS):
                rows = list(zip(*align_texts(own, column.slice(start, end - start).to_pylist())))
                arrays = [pa.array(x, kind) for x, kind in zip(rows, kinds)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, end - start), *arrays], [id_col, *names])

    names = [*DIGEST, "groups_sha256", "links"]
    kinds = [*[pa.int64()] * len(DIGEST), pa.string(), pa.binary()]
    ddl = ", ".join([f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}", *[f"{n} long" for n in DIGEST], "groups_sha256 string, links binary"])
    return docs.select(id_col, text_of(text_col).alias("text")).mapInArrow(work, ddl)


def _link_lists(batch: pa.RecordBatch, kind: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """A bounded number of rows at a time (one at least): the rows, all their links, how many each has.
    The links are the last column."""
    width = int(kind[2])
    sizes = pc.binary_length(batch.columns[-1]).to_pylist()
    for start, end in runs(sizes, width * COUNT_AT_ONCE):
        part = batch.slice(start, end - start)
        links = np.frombuffer(b"".join(part.columns[-1].to_pylist()), kind)
        yield part, links, np.array(sizes[start:end], np.int64) // width


def pair_counts(rows: DataFrame, n_b: int, kind: str) -> DataFrame:
    """``pair``, ``n`` (links with these two ids in all rows) and ``best`` (whether no pair with the same
    token of B has more)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            pairs, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(pairs.astype(np.int64)), pa.array(n.astype(np.int64))], ["pair", "n"])

        held, size = [], 0
        for batch in batches:
            for _, links, _ in _link_lists(batch, kind):
                held.append(links)
                size += len(links)
                if size >= COUNT_AT_ONCE:
                    yield out()
                    held, size = [], 0
        if size:
            yield out()

    counts = checkpointed(rows.select("links").mapInArrow(work, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")))
    most = counts.groupBy((F.col("pair") % n_b).alias("b")).agg(F.max("n").alias("most"))
    joined = counts.join(most, F.col("pair") % n_b == F.col("b"))
    return checkpointed(joined.select("pair", "n", (F.col("n") == F.col("most")).alias("best")))


def _by_broadcast(rows: DataFrame, counts: DataFrame, kind: str) -> DataFrame:
    known = counts.orderBy("pair").toArrow()
    table = rows.sparkSession.sparkContext.broadcast(
        (known["pair"].to_numpy().astype(kind), known["n"].to_numpy().copy(), known["best"].to_numpy().copy())
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, n, best = table.value
        for batch in batches:
            for part, links, sizes in _link_lists(batch, kind):
                at = np.searchsorted(pairs, links)
                after = np.cumsum(sizes)
                sums = [np.concatenate([[0], np.cumsum(x[at], dtype=np.int64)]) for x in (best, n)]
                arrays = [part.column(0), *[pa.array(s[after] - s[after - sizes]) for s in sums]]
                yield pa.RecordBatch.from_arrays(arrays, ["row", "n_best", "count_sum"])

    return rows.select("row", "links").mapInArrow(work, "row long, n_best long, count_sum long")


def _by_join(rows: DataFrame, counts: DataFrame, kind: str) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows_of, links = batch.column(0).to_numpy(), batch.column(1)
            for i in range(batch.num_rows):
                pairs, n = np.unique(np.frombuffer(links[i].as_buffer(), kind), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.repeat(rows_of[i], len(pairs)), pa.array(pairs.astype(np.int64)), pa.array(n.astype(np.int64))], ["row", "pair", "times"])

    each = rows.select("row", "links").mapInArrow(work, "row long, pair long, times long")
    joined = each.join(counts, "pair")
    sums = joined.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    every = rows.select("row").join(sums, "row", "left")
    return every.select("row", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")])


def alignment(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", counts_bytes: int = COUNTS_BYTES) -> DataFrame:
    """Per row of ``docs``: ``id_col``, n_a, n_b, n_groups, n_links, n_best (links whose two ids are linked
    most often, in the whole corpus, among the pairs with this token of B), count_sum (over the
    links, how often their two ids are linked) and groups_sha256."""
    spark = docs.sparkSession
    path = staged_path(spark, "links")
    # row numbers are fixed by writing them
    found = aligned(docs, a_path, b_path, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    found.write.option("compression", "zstd").parquet(path)
    rows = spark.read.parquet(path)
    n_a, n_b = len(ByteLevel(a_path).bytes), len(Pieces(b_path).bytes)
    kind = link_kind(n_a, n_b)
    counts = pair_counts(rows, n_b, kind)
    small = estimated_bytes(counts) <= counts_bytes
    sums = checkpointed((_by_broadcast if small else _by_join)(rows, counts, kind))
    digest = checkpointed(rows.drop("links"))
    remove_tree(spark, path)
    return digest.join(sums, "row").select(id_col, *DIGEST, "n_best", "count_sum", "groups_sha256")
