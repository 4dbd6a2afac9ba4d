"""Language identification by cross-parsing entropy.

For each language a suffix automaton is built from a bounded sample of its labelled text.
A text is parsed into phrases, each the longest run that occurs in the sample; the fewer
phrases, the closer the language. With c phrases over n characters and a sample of N, the
estimate is c * log2(N) / n bits per character, and the language with the least wins.

The automaton is completed to a table of transitions in which a character that cannot go on
leads to the state after that character from the start, marked as the beginning of a phrase.
So a parse is one look-up per character and language, done for many stretches of STRETCH
characters side by side. A stretch that does not begin a text is parsed once more from the state
in which the one before it ended, until no such state changes: the phrases are those of the
text parsed as a whole.

Texts are composed (NFC), letters taken to lower case, marks kept with their letter; everything else
counts as one blank between words.
Every letter of the samples is told apart; one that is in no sample of a language is a phrase of
its own there. The most frequent letters have a dense table, the transitions by others are found
by their key in a sorted list; this is layout and does not change a parse. ``und`` with score 0
is given for null texts, texts without a letter and when nothing was learned. Ties go to the smaller language name. The score is the part of the
second best in the sum of the two best estimates, 0.5 for a tie, 1 for a sole language. The
sample is the labelled documents with the least hash of their id, SAMPLE_CHARS characters for
every language; room that documents which fit leave is filled from a longer one. So repeated
rows, the order of rows and their number do not change what is known.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatlake.llm.common import runs, text_of

# Characters of the sample per language. The dense table has the SYMBOLS most frequent letters,
# or as many as keep it below TABLE_ENTRIES. Up to MANY_LANGUAGES, 32 times the sample is drawn.
SAMPLE_CHARS = 40_000
SYMBOLS = 46
TABLE_ENTRIES = 1 << 26
MANY_LANGUAGES = 16

STRETCH = 1024
SLICE_CHARS = 1 << 20
UNKNOWN, BLANK = 0, 1
UNDECIDED = "und"
_BEGIN = np.int32(-(1 << 31))


def _letter_table() -> np.ndarray:
    """Code point of the lower-case form of every letter, that of every mark, a blank for everything else."""
    lower = np.full(0x110000, 0x20, np.uint32)
    for cp in range(0x110000):
        char = chr(cp)
        kind = unicodedata.category(char)[0]
        if kind == "L":
            small = char.lower()
            lower[cp] = ord(small[0])
        elif kind == "M":
            lower[cp] = cp
    return lower


def _codes(text: str) -> np.ndarray:
    """Code points of the composed text."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text)
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def has_letter(text: str) -> bool:
    return any(unicodedata.category(c)[0] == "L" for c in text)


_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    if not _letters:
        _letters.append(_letter_table())
    return _letters[0]


def _plain(text: str) -> str:
    """The text in lower-case letters with single blanks."""
    codes = letters()[_codes(text)]
    keep = (codes != 0x20) | np.append(True, codes[:-1] != 0x20)
    return codes[keep].astype("<u4").tobytes().decode("utf-32-le")


def suffix_automaton(symbols: list[int]) -> tuple[int, np.ndarray]:
    """Number of states, and transitions (state, symbol, next state); state 0 is the start."""
    following: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for s in symbols:
        new = len(following)
        following.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and s not in following[p]:
            following[p][s] = new
            p = link[p]
        if p >= 0:
            q = following[p][s]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                clone = len(following)
                following.append(dict(following[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and following[p].get(s) == q:
                    following[p][s] = clone
                    p = link[p]
                link[q] = link[new] = clone
        last = new
    steps = [(state, s, to) for state, own in enumerate(following) for s, to in own.items()]
    return len(following), np.array(steps, np.int64).reshape(-1, 3)


class Model:
    """Names, symbol of each code point, and the joined transitions: ``table`` by frequent
    symbols, ``keys`` and ``values`` by the others, ``first`` those from the start by the others."""

    def __init__(self, samples: dict[str, str]):
        self.names = sorted(samples)
        counts = Counter(c for text in samples.values() for c in text if c != " ")
        self.chosen = "".join(sorted(counts, key=lambda c: (-counts[c], c)))
        self.total = len(self.chosen) + 2
        symbol = {c: i + 2 for i, c in enumerate(self.chosen)} | {" ": BLANK}
        built = [suffix_automaton([symbol[c] for c in samples[name]]) for name in self.names]
        rows = sum(n for n, _ in built)
        self.alphabet = min(self.total, SYMBOLS + 2, max(2, TABLE_ENTRIES // max(1, rows)))
        rare = self.total - self.alphabet
        parts, keys, values, self.starts, self.bits, base = [], [], [], [], [], 0
        self.first = np.zeros((len(self.names), rare), np.int32)
        for at, (name, (n, steps)) in enumerate(zip(self.names, built)):
            dense = steps[:, 1] < self.alphabet
            table = np.full((n, self.alphabet), -1, np.int32)
            table[steps[dense, 0], steps[dense, 1]] = steps[dense, 2]
            first = np.where(table[0] >= 0, table[0], 0)
            begins = table < 0
            table = np.where(begins, first[None, :], table) + base
            begins[0] = True
            # next row of the joined table, with the sign as the mark of a phrase that begins
            parts.append(np.where(begins, (table * self.alphabet) | _BEGIN, table * self.alphabet).astype(np.int32))
            state, by, to = steps[~dense].T
            to = ((to + base) * self.alphabet).astype(np.int32)
            to = np.where(state == 0, to | _BEGIN, to)
            self.first[at] = np.int32(base * self.alphabet) | _BEGIN
            self.first[at, by[state == 0] - self.alphabet] = to[state == 0]
            keys.append((state + base) * self.total + by)
            values.append(to)
            self.starts.append(base * self.alphabet)
            self.bits.append(math.log2(max(2, len(samples[name]))))
            base += n
        self.table = np.concatenate(parts).ravel() if parts else np.zeros(0, np.int32)
        self.keys = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        order = np.argsort(self.keys, kind="stable")
        self.keys = self.keys[order]
        self.values = np.concatenate(values)[order] if values else np.zeros(0, np.int32)

    def symbols(self) -> np.ndarray:
        """Symbol of every code point."""
        lower = letters()
        of = np.zeros(0x110000, np.uint8 if self.total <= 256 else np.int32)
        of[0x20] = BLANK
        for i, c in enumerate(self.chosen):
            of[ord(c)] = i + 2
        return of[lower]

    def _next(self, state: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """Transitions of all languages, a row each, by one symbol per column."""
        seldom = np.flatnonzero(symbols >= self.alphabet)
        if not len(seldom):
            return self.table[state + symbols]
        to = self.table[state + np.where(symbols < self.alphabet, symbols, UNKNOWN)]
        by = symbols[seldom].astype(np.int64)
        key = state[:, seldom].astype(np.int64) // self.alphabet * self.total + by
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        to[:, seldom] = np.where(self.keys[at] == key, self.values[at], self.first[:, by - self.alphabet])
        return to

    def phrases(self, texts: list[str], of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Phrases of every text in every language, and its number of symbols."""
        rows, owners = [], []
        lengths = np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            s = of[_codes(text)]
            keep = np.ones(len(s), bool)
            keep[1:] = (s[1:] != BLANK) | (s[:-1] != BLANK)
            s = s[keep]
            lengths[i] = len(s)
            for a in range(0, len(s), STRETCH):
                rows.append(s[a : a + STRETCH])
                owners.append(i)
        total = np.zeros((len(texts), len(self.names)), np.int64)
        if not rows:
            return total, lengths
        sizes = np.array([len(r) for r in rows])
        order = np.argsort(-sizes, kind="stable")
        grid = np.zeros((int(sizes.max()), len(rows)), of.dtype)
        for column, r in enumerate(order.tolist()):
            grid[: sizes[r], column] = rows[r]
        alive = np.searchsorted(-sizes[order], -np.arange(1, len(grid) + 1), side="right")
        entered = np.repeat(np.array(self.starts, np.int32)[:, None], len(rows), axis=1)
        left, begun = self._parse(grid, alive, entered)
        # columns of the stretches that go on from another, and of those before them
        column = np.argsort(order)
        later = np.flatnonzero(np.diff(owners) == 0) + 1
        after, before = column[later], column[later - 1]
        while len(after):
            changed = np.flatnonzero((left[:, before] != entered[:, after]).any(axis=0))
            if not len(changed):
                break
            redo = after[changed]
            entered[:, redo] = left[:, before[changed]]
            redo = np.sort(redo)
            longest = int(sizes[order[redo[0]]])
            now = np.searchsorted(redo, alive[:longest])
            left[:, redo], begun[:, redo] = self._parse(grid[:longest, redo], now, entered[:, redo])
        np.add.at(total, np.array(owners)[order], begun.T)
        return total, lengths

    def _parse(self, grid: np.ndarray, alive: np.ndarray, entered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Last states, and phrases begun, of stretches in the columns of ``grid``, longest first: ``alive``
        columns have a symbol at each step."""
        state, begun = entered.copy(), np.zeros(entered.shape, np.int32)
        for step in range(len(grid)):
            n = int(alive[step])
            to = self._next(state[:, :n], grid[step, :n])
            begun[:, :n] += to < 0
            state[:, :n] = to & np.int32(0x7FFFFFFF)
        return state, begun

    def predict(self, texts: list[str], of: np.ndarray) -> tuple[list[str], list[float]]:
        phrases, lengths = self.phrases(texts, of)
        names, scores = [], []
        estimates = phrases * np.array(self.bits)
        for i, text in enumerate(texts):
            if not self.names or not lengths[i] or not has_letter(text):
                names.append(UNDECIDED)
                scores.append(0.0)
                continue
            row = estimates[i]
            best = int(row.argmin())
            names.append(self.names[best])
            others = np.delete(row, best)
            scores.append(float(others.min() / (others.min() + row[best])) if len(others) else 1.0)
        return names, scores


def learn(docs: DataFrame, allowed: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Build the model from rows that are ``allowed`` and have text and language.

    First the characters of the documents that fit into a sample are summed per language over
    all rows; then those below a hash threshold that leaves many times the wanted sample are
    read, and whole ones taken while they fit. Of every language the document with the least
    hash is read as well, whatever its length; a stretch of it from its first letter on fills
    the room that is left, so no language with a letter is missing.
    """
    lang, text = F.col(lang_col), F.col(text_col)
    labelled = docs.where(allowed & lang.isNotNull() & text.rlike(r"\p{L}")).select(
        F.col(id_col).cast("string").alias("id"), lang.alias("lang"), text.alias("text")
    )
    ticket = F.crc32(F.concat(F.lit("sample-"), F.coalesce("id", F.lit(""))).cast("binary"))
    sized = labelled.withColumns({"chars": F.length("text"), "ticket": ticket, "hash": F.xxhash64("text")})
    fitting = F.sum(F.when(F.col("chars") <= SAMPLE_CHARS, F.col("chars"))).alias("fitting")
    totals = {r["lang"]: r for r in sized.groupBy("lang").agg(fitting, F.min(F.struct("ticket", "hash")).alias("least")).collect()}
    if not totals:
        return Model({})
    times = max(4, 32 * MANY_LANGUAGES // max(MANY_LANGUAGES, len(totals)))
    below, least = F.lit(None), F.lit(False)
    for name, r in totals.items():
        part = min(1.0, times * SAMPLE_CHARS / max(1, r["fitting"] or 0))
        below = F.when(F.col("lang") == name, int((1 << 32) * part) + 1).otherwise(below)
        own = (F.col("ticket") == r["least"]["ticket"]) & (F.col("hash") == r["least"]["hash"])
        least = F.when(F.col("lang") == name, own).otherwise(least)
    fits = F.col("chars") <= SAMPLE_CHARS
    stretch = F.substring(F.col("text"), F.regexp_instr("text", F.lit(r"\p{L}")), F.lit(SAMPLE_CHARS))
    drawn = sized.where(fits & (F.col("ticket") < below)).select("lang", "ticket", "id", "text")
    longer = sized.where(~fits & least).select("lang", "ticket", "id", stretch.alias("text")).distinct()
    samples: dict[str, list[str]] = {}
    have: Counter = Counter()
    for r in sorted(drawn.collect(), key=lambda r: (r["lang"], r["ticket"], r["id"] or "", r["text"])):
        plain = _plain(r["text"]).strip()
        if plain and have[r["lang"]] + len(plain) <= SAMPLE_CHARS:
            samples.setdefault(r["lang"], []).append(plain)
            have[r["lang"]] += len(plain) + 1
    for r in sorted(longer.collect(), key=lambda r: (r["lang"], r["id"] or "")):
        plain = _plain(r["text"])[: max(0, SAMPLE_CHARS - have[r["lang"]])].strip()
        if plain:
            samples.setdefault(r["lang"], []).append(plain)
            have[r["lang"]] += len(plain) + 1
    return Model({name: " ".join(parts) for name, parts in samples.items()})


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``lang_pred`` and ``score`` per row. The model, of bounded size, is broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        of = own.symbols()
        for batch in batches:
            column = batch.column(1)
            for a, b in runs(pc.binary_length(column).to_pylist(), SLICE_CHARS):
                names, scores = own.predict(column.slice(a, b - a).to_pylist(), of)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(names, pa.string()), pa.array(scores, pa.float64())], [id_col, "lang_pred", "score"]
                )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_of(text_col).alias("text")).mapInArrow(work, f"`{id_col}` {kind}, lang_pred string, score double")
