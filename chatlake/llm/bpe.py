"""Byte-level BPE encoding and decoding.

Pre-tokens are found without a regular expression. Every code point has a class;
every class is a function from the state before the character to the state after
it, and all functions that arise by chaining them form a small table. Prefix
compositions over that table (an associative scan in blocks) give the state at
every character of a batch at once, and state and class together say where a
pre-token starts. The slices go through a bounded cache of merged pairs.

Null texts count as empty. Empty texts have no ids and decode to nothing.
Repeated rows are encoded each. Only the id and text columns are read, so other
columns can have any name.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatlake.llm.common import runs, text_of

# Characters handled at once, and merged words remembered (twice as many at most), in one
# Python worker.
SLICE_CHARS = 1 << 20
CACHE_WORDS = 1 << 18

# Classes of characters: blank, other white space, letter, number, anything else, an
# apostrophe that could start a contraction of two or three characters, end of a text.
BLANK, SPACE, LETTER, NUMBER, OTHER, SHORT, LONG, END = range(8)
# States: next character starts a pre-token, a blank waits for a partner, inside a run of
# letters, numbers or others, one or two letters of a contraction still to come.
FRESH, WAIT, IN_LETTERS, IN_NUMBERS, IN_OTHER, ONE_LEFT, TWO_LEFT = range(7)

# What may follow an apostrophe in a contraction.
CONTRACTION_ENDS = ["s", "t", "re", "ve", "m", "ll", "d"]


def _step(state: int, kind: int) -> int:
    if kind == BLANK:
        return WAIT
    if kind in (SPACE, END):
        return FRESH
    if kind == LETTER:
        return {TWO_LEFT: ONE_LEFT, ONE_LEFT: FRESH}.get(state, IN_LETTERS)
    if kind == NUMBER:
        return IN_NUMBERS
    if kind == OTHER or state in (WAIT, IN_OTHER):
        return IN_OTHER
    return ONE_LEFT if kind == SHORT else TWO_LEFT


def _starts(state: int, kind: int) -> bool:
    """Whether a character other than white space opens a pre-token."""
    if kind == LETTER:
        return state in (FRESH, IN_NUMBERS, IN_OTHER)
    if kind == NUMBER:
        return state in (FRESH, IN_LETTERS, IN_OTHER)
    return state in (FRESH, IN_LETTERS, IN_NUMBERS)


class Scanner:
    """Pre-token boundaries of many texts by prefix composition."""

    BLOCK = 256

    def __init__(self, letters: str, numbers: str, spaces: str):
        self.kinds = np.full(0x110000, OTHER, np.uint8)
        for chars, kind in ((letters, LETTER), (numbers, NUMBER), (spaces, SPACE), (" ", BLANK)):
            self.kinds[np.frombuffer(chars.encode("utf-32-le"), np.uint32)] = kind
        generators = [tuple(_step(s, k) for s in range(7)) for k in range(8)]
        found = {f: i for i, f in enumerate(dict.fromkeys(generators))}
        queue = list(found)
        while queue:
            f = queue.pop()
            for g in generators:
                h = tuple(g[s] for s in f)
                if h not in found:
                    found[h] = len(found)
                    queue.append(h)
        n = len(found)
        self.size = n
        self.of_kind = np.array([found[g] for g in generators], np.uint16)
        self.after_fresh = np.array([f[FRESH] for f in found], np.uint8)
        self.chain = np.array([[found[tuple(g[s] for s in f)] for g in found] for f in found], np.uint16).ravel()
        self.opens = np.array([[_starts(s, k) for k in range(8)] for s in range(7)]).ravel()

    def prefixes(self, functions: np.ndarray) -> np.ndarray:
        """Composition of all functions up to each place."""
        n = len(functions)
        if n <= self.BLOCK:
            out = functions.copy()
            for i in range(1, n):
                out[i] = self.chain[int(out[i - 1]) * self.size + int(out[i])]
            return out
        blocks = -(-n // self.BLOCK)
        rows = np.full(blocks * self.BLOCK, functions[-1], np.uint16)
        rows[:n] = functions
        rows = rows.reshape(blocks, self.BLOCK).T.copy()
        for i in range(1, self.BLOCK):
            rows[i] = self.chain[rows[i - 1].astype(np.int32) * self.size + rows[i]]
        before = self.prefixes(rows[-1])[:-1].astype(np.int32) * self.size
        rows[:, 1:] = self.chain[before[None, :] + rows[:, 1:]]
        return rows.T.reshape(-1)[:n]

    def slices(self, texts: list[str]) -> tuple[str, np.ndarray, np.ndarray]:
        """The texts joined, where pre-tokens start in that, and for each text the number
        of starts up to its end. Behind every text stands one character that is a start of
        its own and no pre-token."""
        joined = "\n".join(texts) + "\n"
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        kinds = self.kinds[codes]
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        kinds[ends] = END
        for at in np.flatnonzero(codes == 0x27).tolist():
            for tail in CONTRACTION_ENDS:
                if joined.startswith(tail, at + 1):
                    kinds[at] = SHORT if len(tail) == 1 else LONG
                    break
        after = self.after_fresh[self.prefixes(self.of_kind[kinds])]
        before = np.empty_like(after)
        before[0], before[1:] = FRESH, after[:-1]
        opens = self.opens[before.astype(np.int32) * 8 + kinds]
        white = kinds <= SPACE
        solid = ~white & (kinds != END)
        first = white.copy()
        first[1:] &= ~white[:-1]
        last = white.copy()
        last[:-1] &= solid[1:]
        opens = np.where(white, first | last, opens)
        opens[ends] = True
        starts = np.flatnonzero(opens)
        return joined, starts, np.searchsorted(starts, ends)


class Codec:
    """Ranks of byte strings, with the merged form of words seen of late."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        # the classes are those of the library that the ids have to match
        single = {bytes([i]): i for i in range(256)}
        every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))

        def members(pattern: str) -> str:
            probe = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=single, special_tokens={})
            return bytes(probe.encode_ordinary(every)).decode()

        self.scanner = Scanner(members(r"\p{L}"), members(r"\p{N}"), members(r"\s"))
        ranks, merge = self.ranks, self._merge

        class Words(dict):
            """Two generations; a full one takes the place of the older, which goes."""

            older: dict[str, bytes] = {}

            def __missing__(self, word: str) -> bytes:
                if len(self) >= CACHE_WORDS:
                    self.older = dict(self)
                    self.clear()
                ids = self.older.get(word)
                if ids is None:
                    ids = np.array(merge(word.encode()), "<u4").tobytes()
                self[word] = ids
                return ids

        self.words = Words()
        size = max(ranks.values(), default=-1) + 1
        lengths = np.zeros(size + 1, np.int64)
        for word, rank in ranks.items():
            lengths[rank + 1] = len(word)
        self.offsets = np.cumsum(lengths)
        self.blob = np.zeros(int(self.offsets[-1]), np.uint8)
        for word, rank in ranks.items():
            self.blob[self.offsets[rank] : self.offsets[rank + 1]] = np.frombuffer(word, np.uint8)

    def _merge(self, word: bytes) -> list[int]:
        ranks = self.ranks
        if word in ranks:
            return [ranks[word]]
        parts = [word[i : i + 1] for i in range(len(word))]
        if len(parts) > 64:
            return self._merge_long(parts)
        pairs = [ranks.get(a + b, 1 << 60) for a, b in zip(parts, parts[1:])]
        while pairs:
            best = min(pairs)
            if best == 1 << 60:
                break
            i = pairs.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = ranks.get(parts[i] + parts[i + 1], 1 << 60)
            if i:
                pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], 1 << 60)
        return [ranks[p] for p in parts]

    def _merge_long(self, parts: list[bytes | None]) -> list[int]:
        """The same for very long words: a heap over linked parts."""
        ranks, n = self.ranks, len(parts)
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, bytes]] = []

        def push(i: int) -> None:
            if i >= 0 and right[i] < n:
                both = parts[i] + parts[right[i]]
                if both in ranks:
                    heapq.heappush(heap, (ranks[both], i, both))

        for i in range(n):
            push(i)
        while heap:
            _, i, both = heapq.heappop(heap)
            j = right[i]
            if parts[i] is None or j >= n or parts[i] + parts[j] != both:
                continue
            parts[i], parts[j] = both, None
            right[i] = right[j]
            if right[i] < n:
                left[right[i]] = i
            push(i)
            push(left[i])
        return [ranks[p] for p in parts if p is not None]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every text as little-endian unsigned 32-bit integers."""
        if not texts:
            return []
        joined, starts, stops = self.scanner.slices(texts)
        cuts = starts.tolist()
        pieces = [joined[a:b] for a, b in zip(cuts, cuts[1:])]
        out, at = [], 0
        for stop in stops.tolist():
            out.append(b"".join(map(self.words.__getitem__, pieces[at:stop])))
            at = stop + 1
        return out

    def ends(self, ids: bytes) -> np.ndarray:
        """Byte offset in the text at which each id ends."""
        numbers = np.frombuffer(ids, "<u4")
        return np.cumsum(self.offsets[numbers + 1] - self.offsets[numbers])

    def decode(self, ids: bytes) -> bytes:
        """Bytes of the ids, copied by their offsets in the vocabulary."""
        numbers = np.frombuffer(ids, "<u4").astype(np.int64)
        if not len(numbers):
            return b""
        begin = self.offsets[numbers]
        lengths = self.offsets[numbers + 1] - begin
        ends = np.cumsum(lengths)
        at = np.repeat(begin - ends + lengths, lengths)
        at += np.arange(len(at))
        return self.blob[at].tobytes()


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", offsets: bool = False) -> DataFrame:
    """``id_col``, ``ids`` (binary, little-endian unsigned 32-bit) and, if asked for,
    ``ends`` (binary, signed 64-bit: the byte of the text at which each id ends)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            keys, column = batch.column(0), batch.column(1)
            lengths = pc.binary_length(column).to_pylist()
            for a, b in runs(lengths, SLICE_CHARS):
                ids = own.encode(column.slice(a, b - a).to_pylist())
                out = [keys.slice(a, b - a), pa.array(ids, pa.binary())]
                if offsets:
                    out.append(pa.array([own.ends(x).tobytes() for x in ids], pa.binary()))
                yield pa.RecordBatch.from_arrays(out, names)

    names = [id_col, "ids"] + ["ends"] * offsets
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, ids binary" + ", ends binary" * offsets
    return docs.select(id_col, text_of(text_col).alias("text")).mapInArrow(work, schema)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """``encoded`` (an id column and ``ids``) with ``decoded``, the bytes of the ids."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            ids = batch.column(1)
            sizes = pc.binary_length(ids).to_pylist()
            for a, b in runs(sizes, 4 * SLICE_CHARS):
                part = batch.slice(a, b - a)
                out = pa.array([own.decode(x) for x in part.column(1).to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, out], [id_col, "ids", "decoded"])

    kind = encoded.schema[id_col].dataType.simpleString()
    return encoded.select(id_col, "ids").mapInArrow(work, f"`{id_col}` {kind}, ids binary, decoded binary")


def digest(encoded: DataFrame, path: str) -> DataFrame:
    """Length and hashes of ids and decoded bytes, per document."""
    return decode(encoded, path).select(
        "doc_id",
        F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
