"""Token ids in files of independent zstandard frames with a trailing seek table.

A file holds, in this order: data frames, an index of documents and a seek table.
Each data frame holds the ids (little-endian unsigned 32-bit) of consecutive
documents and can be read without the others. The index and the seek table are
skippable frames, so a plain zstandard reader gives the ids of the whole file. The
seek table follows the published seekable format: compressed size, decompressed
size and checksum (low 32 bits of XXH64) per frame, then number of frames, flags and
magic number. Spark's text writer puts the files into any store, with its commit of
whole tasks only: each line is one frame and the line separator is an empty skippable
frame, which the sizes in the seek table include. Behind the seek table stands one
separator more.

Null texts count as empty. An empty text still has the end id. The names of special tokens inside a
text are taken for these tokens, as the library does unless told otherwise. Documents are in
ascending order of id, a null id first, equal ids in order of the hash of their text. No documents
give no data frames. Only the id and text columns are read.
"""

from __future__ import annotations

import math
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chatlake.llm.common import runs, text_of

# Decompressed bytes per data frame (one document at least), text per file.
FRAME_BYTES = 1 << 16
FILE_TEXT_BYTES = 64 << 20
SLICE_CHARS = 1 << 20
CACHE_WORDS = 1 << 18

# Fixed values of the zstandard formats.
SKIPPABLE_EMPTY = 0x184D2A50
SKIPPABLE_INDEX = 0x184D2A51
SKIPPABLE_SEEK = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

SEPARATOR = struct.pack("<II", SKIPPABLE_EMPTY, 0)


# Marks that may combine with an ASCII letter before the tokenizer takes letters to lower case.
_COMBINING = re.compile("[\u0300-\u036f]")
# Special tokens of such vocabularies begin with this; texts that have it are encoded whole.
_SPECIAL = "<|"
_PUNCTUATION = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


class Words(dict):
    """Ids of words, in two generations; a full one takes the place of the older, which goes.

    The tokenizer splits letters and digits from what follows them, so closing ASCII
    punctuation is encoded apart from the word and each form of a word costs one look-up.
    """

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.model = tokenizer.model
        self.older: dict[bytes, bytes] = {}

    def __missing__(self, word: bytes) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            body = word.rstrip(_PUNCTUATION)
            if body and len(body) < len(word) and body[-1:].isalnum():
                ids = self[body] + self[word[len(body) :]]
            else:
                # a lower-case ASCII word passes the library's first steps unchanged
                if word.isalpha() and word.islower():
                    found = [t.id for t in self.model.tokenize(word.decode())]
                else:
                    found = self.tokenizer.encode(word.decode(), add_special_tokens=False).ids
                ids = struct.pack(f"<{len(found)}I", *found)
        if len(self) >= CACHE_WORDS:
            self.older = dict(self)
            self.clear()
        self[word] = ids
        return ids


class WordEncoder:
    """Ids of texts by a tokenizer that takes letters to lower case and never joins characters
    across white space, so the library encodes each distinct word once while it is remembered."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if any(not t.content.startswith(_SPECIAL) for t in self.tokenizer.get_added_tokens_decoder().values()):
            raise ValueError("an added token of this vocabulary could stand in words that are encoded apart")
        self.words = Words(self.tokenizer)

    def encode(self, texts: list[str], end_id: int) -> list[bytes]:
        end, get = struct.pack("<I", end_id), self.words.__getitem__
        out = []
        for text in texts:
            if _SPECIAL in text:
                ids = self.tokenizer.encode(text, add_special_tokens=False).ids
                out.append(struct.pack(f"<{len(ids)}I", *ids) + end)
                continue
            data = text.encode()
            if not _COMBINING.search(text):
                data = data.lower()  # ASCII letters only
            out.append(b"".join([*map(get, data.split()), end]))
        return out


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks are the parallelism
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def _file_rows(documents: Iterator[tuple[int | None, bytes]]) -> Iterator[bytes]:
    """Frames of one file: data, then index and seek table in one."""
    press = zstandard.ZstdCompressor(level=3, write_checksum=True)
    seek, ids, counts, frames = [], [], [], []
    pending: list[bytes] = []
    size = 0

    def frame() -> bytes:
        data = b"".join(pending)
        packed = press.compress(data)
        seek.append(struct.pack("<III", len(packed) + len(SEPARATOR), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
        pending.clear()
        return packed

    for key, data in documents:
        if pending and size + len(data) > FRAME_BYTES:
            yield frame()
            size = 0
        ids.append(key)
        counts.append(len(data) // 4)
        frames.append(len(seek))
        pending.append(data)
        size += len(data)
    if pending:
        yield frame()
    if ids:
        known = np.array([k is not None for k in ids], np.uint8)
        keys = np.array([k or 0 for k in ids], "<i8")
        index = press.compress(known.tobytes() + keys.tobytes() + np.array(counts, "<i8").tobytes() + np.array(frames, "<i4").tobytes())
        table = b"".join(seek) + struct.pack("<IBI", len(seek), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        yield struct.pack("<II", SKIPPABLE_INDEX, len(index)) + index + struct.pack("<II", SKIPPABLE_SEEK, len(table)) + table


def write(docs: DataFrame, tokenizer_path: str, out: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text, append ``end_id``, and write files in ascending order of id.

    The texts are dealt out by ranges of id before they are encoded, as sampling for the
    ranges reads its input twice.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = max(1, math.ceil(total / FILE_TEXT_BYTES))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def documents() -> Iterator[tuple[int | None, bytes]]:
            own = encoder(tokenizer_path)
            for batch in batches:
                keys, column = batch.column(0).to_pylist(), batch.column(1)
                lengths = pc.binary_length(column).to_pylist()
                for a, b in runs(lengths, SLICE_CHARS):
                    yield from zip(keys[a:b], own.encode(column.slice(a, b - a).to_pylist(), end_id))

        for row in _file_rows(documents()):
            yield pa.RecordBatch.from_arrays([pa.array([row], pa.binary())], ["frame"])

    # the sample of the ranges holds hashes, not texts
    ordered = texts.withColumn("h", F.xxhash64("text")).repartitionByRange(files, "id", "h").sortWithinPartitions("id", "h", "text").drop("h")
    (
        ordered.mapInArrow(work, "frame binary")
        .select(F.col("frame").cast("string").alias("value"))
        .write.option("lineSep", SEPARATOR.decode())
        .option("compression", "none")
        .text(out)
    )


class Reader:
    """One file in memory; frames are decompressed when a document in them is asked for."""

    def __init__(self, content: bytes):
        self.content = content
        end = len(content) - len(SEPARATOR)
        n, flags, magic = struct.unpack_from("<IBI", content, end - 9)
        if magic != SEEKABLE_MAGIC or flags != CHECKSUM_FLAG:
            raise ValueError("no seek table")
        table = end - 9 - 12 * n
        self.sizes = np.frombuffer(content, "<u4", 3 * n, table).reshape(n, 3).astype(np.int64)
        self.at = np.concatenate([[0], np.cumsum(self.sizes[:, 0])])
        kind, size = struct.unpack_from("<II", content, int(self.at[-1]))
        if kind != SKIPPABLE_INDEX:
            raise ValueError("no document index")
        index = zstandard.decompress(content[int(self.at[-1]) + 8 : int(self.at[-1]) + 8 + size])
        docs = len(index) // 21
        known = np.frombuffer(index, np.uint8, docs)
        keys = np.frombuffer(index, "<i8", docs, docs)
        self.counts = np.frombuffer(index, "<i8", docs, 9 * docs)
        self.frames = np.frombuffer(index, "<i4", docs, 17 * docs)
        self.ids = [int(k) if x else None for k, x in zip(keys, known)]
        self.starts = np.concatenate([[0], np.cumsum(self.counts)])
        first = np.searchsorted(self.frames, np.arange(n))
        self.frame_starts = self.starts[first]
        self._open: tuple[int, bytes] = (-1, b"")

    def frame(self, i: int) -> bytes:
        """Decompressed bytes of frame ``i``, checked against its checksum."""
        if self._open[0] != i:
            packed = self.content[self.at[i] : self.at[i + 1] - len(SEPARATOR)]
            data = zstandard.ZstdDecompressor().decompress(packed, max_output_size=int(self.sizes[i, 1]) or 1)
            if len(data) != self.sizes[i, 1] or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != self.sizes[i, 2]:
                raise ValueError(f"frame {i} is damaged")
            self._open = i, data
        return self._open[1]

    def document(self, i: int) -> bytes:
        """Ids of the document in place ``i`` of the index."""
        frame = int(self.frames[i])
        begin = 4 * int(self.starts[i] - self.frame_starts[frame])
        return self.frame(frame)[begin : begin + 4 * int(self.counts[i])]


def read(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """``doc_id``, ``file``, ``place`` (in the file), ``file_start`` (ids of the file before
    it) and ``ids`` of every document or of those listed, whose frames alone are opened."""
    wanted = None if doc_ids is None else set(doc_ids)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not content:
                    continue
                file = Reader(content)
                chosen = [i for i, k in enumerate(file.ids) if wanted is None or k in wanted]
                for a, b in runs([4 * int(file.counts[i]) for i in chosen], 8 << 20):
                    part = chosen[a:b]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([file.ids[i] for i in part], pa.int64()),
                            pa.array([path] * len(part), pa.string()),
                            pa.array(part, pa.int64()),
                            pa.array([int(file.starts[i]) for i in part], pa.int64()),
                            pa.array([file.document(i) for i in part], pa.binary()),
                        ],
                        ["doc_id", "file", "place", "file_start", "ids"],
                    )

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(work, "doc_id long, file string, place long, file_start long, ids binary")


def positions(documents: DataFrame) -> DataFrame:
    """``documents`` as read (or a table made from them with ``n_tokens``) with ``start``, the
    number of ids in all documents before. One row per file goes through the running sum."""
    names = F.regexp_extract("file", r"part-(\d+)", 1).cast("long")
    files = documents.groupBy("file").agg(F.sum("n_tokens").alias("tokens")).withColumn("number", names)
    before = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))
    return documents.join(files, "file").withColumn("start", F.col("base") + F.col("file_start"))


