"""Near-duplicate documents by SimHash and the pigeonring filter.

A fingerprint has 64 bits in a ring of segments. If two differ in at most d bits, then
some segment starts a chain in which, for every length l, the first l segments differ in
at most l * d / m bits. The chains short enough to allow no difference are looked up by
equality, the longer ones are counted before the whole distance is.

Fingerprints that share a very full bucket go another, exact way: two of them are within
two bits just if flipping at most one bit in each gives the same number, so each is
written with all its one-bit neighbours and the groups of equal neighbours are linked.
Neither way forms all pairs of a group.

Null and empty texts have the fingerprint zero. Equal texts, and rows with equal ids, have
equal fingerprints and one component. A null id is a member like any other and never
names a component that has another id. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatlake.llm.common import text_of
from chatlake.llm.components import components
from chatlake.session import checkpointed, gathered

SEED = 42
# Words in a shingle.
WIDTH = 3
SEGMENTS = 16
SEGMENT_BITS = 64 // SEGMENTS
DISTANCE = 2
# Members of a bucket up to which pairs are compared; fuller buckets go by neighbours.
FULL_BUCKET = 32


def run_hashes(text: bytes, width: int) -> np.ndarray:
    """Hash of every run of ``width`` words, in order; a shorter text is one run."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]).tolist()
    width = min(width, len(words))
    starts = [0, *ends[: len(words) - width]]
    digest, seed = xxhash.xxh64_intdigest, SEED
    return np.array([digest(joined[a : b - 1], seed) for a, b in zip(starts, ends[width - 1 :])], np.uint64)


def fingerprint(text: bytes, width: int) -> int:
    """Majority of the hashes of all runs of ``width`` words, as a signed number."""
    hashes = run_hashes(text, width).astype(">u8")
    if not len(hashes):
        return 0
    ones = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes)).view(">i8")[0])


def fingerprints(docs: DataFrame, width: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``fp``, the fingerprint as a signed 64-bit number."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            # one text at a time: a batch may hold very long ones
            found = [fingerprint(texts[i].as_buffer().to_pybytes(), width) for i in range(len(texts))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], [id_col, "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_of(text_col).alias("text")).mapInArrow(work, f"`{id_col}` {kind}, fp long")


def _turned(value: Column, segment: int) -> Column:
    """``value`` with the given segment in its lowest bits."""
    by = segment * SEGMENT_BITS
    if not by:
        return value
    return F.shiftrightunsigned(value, by).bitwiseOR(F.shiftleft(value, 64 - by))


def _low(bits: int) -> Column:
    return F.lit((1 << bits) - 1 if bits < 64 else -1).cast("long")


def free_chain() -> int:
    """Length of the longest chain whose budget is less than one bit."""
    return max(n for n in range(1, SEGMENTS + 1) if n * DISTANCE < SEGMENTS)


def chain_holds(a: Column, b: Column, segment: Column) -> Column:
    """Whether every chain from ``segment`` on stays within its share of the distance."""
    differing = a.bitwiseXOR(b)
    turned = F.lit(None)
    for s in range(SEGMENTS):
        turned = F.when(segment == s, _turned(differing, s)).otherwise(turned)
    checks = [n for n in range(1, SEGMENTS + 1) if n == SEGMENTS or (n + 1) * DISTANCE // SEGMENTS > n * DISTANCE // SEGMENTS]
    holds = F.lit(True)
    for n in checks:
        holds = holds & (F.bit_count(turned.bitwiseAND(_low(n * SEGMENT_BITS))) <= n * DISTANCE // SEGMENTS)
    return holds


def links(distinct: DataFrame) -> DataFrame:
    """Edges (a, b) that connect all fingerprints (column ``fp``, each once) within DISTANCE."""
    n = distinct.count()
    free = free_chain() * SEGMENT_BITS
    slots = F.array(
        *[_turned(F.col("fp"), s).bitwiseAND(_low(free)).bitwiseOR(F.lit(s << free).cast("long")) for s in range(SEGMENTS)]
    )
    placed = checkpointed(distinct.select("fp", F.explode(slots).alias("slot")))
    counted = placed.groupBy("slot").agg(F.count("*").alias("members")).where("members > 1")
    shared = gathered(placed.join(counted, "slot"), SEGMENTS * n)
    few = shared.where(F.col("members") <= FULL_BUCKET).groupBy("slot").agg(F.collect_list("fp").alias("fps"))
    pairs = few.select("slot", F.explode("fps").alias("a"), "fps").select("slot", "a", F.explode("fps").alias("b")).where("a < b")
    segment = F.shiftrightunsigned(F.col("slot"), free)
    close = pairs.where(chain_holds(F.col("a"), F.col("b"), segment))
    close = close.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= DISTANCE).select("a", "b").distinct()
    if DISTANCE != 2:
        raise ValueError("full buckets are linked by one-bit neighbours, which is exact for two bits only")
    full = shared.where(F.col("members") > FULL_BUCKET).select("fp").distinct()
    flips = F.array(F.lit(0).cast("long"), *[F.lit(1 << b if b < 63 else -(1 << 63)).cast("long") for b in range(64)])
    full = gathered(full, 65 * n)
    near = checkpointed(full.select("fp", F.explode(flips).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("z")))
    centre = near.groupBy("z").agg(F.min("fp").alias("b"), F.count("*").alias("n")).where("n > 1").select("z", "b")
    # a centre stands for two rows of near at least
    centre = gathered(centre, near.count() // 2)
    around = near.join(centre, "z").select(F.col("fp").alias("a"), "b").where("a <> b").distinct()
    return close.union(around)


def grouped(marked: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``marked`` (an id column and ``fp``) with ``component_id``, the least id reachable by ``links``."""
    n = marked.count()
    distinct = gathered(marked.groupBy("fp").agg(F.min(id_col).alias("least")), SEGMENTS * n)
    linked = components(links(distinct.select("fp")))
    whole = distinct.join(linked, distinct.fp == linked.node, "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")
    )
    whole = gathered(whole, n)
    names = whole.groupBy("component").agg(F.min("least").alias("component_id"))
    named = gathered(whole.join(names, "component").select("fp", "component_id"), n)
    return marked.join(named, "fp")


def near_duplicates(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``fp`` and ``component_id``."""
    return grouped(checkpointed(fingerprints(docs, width, id_col, text_col)), id_col)


def first_of_each(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id names their component. Rows with equal ids count as one
    document, which goes only if none of its texts stays; so do the rows without an id, whose
    texts stay where no member of the component has an id."""
    marked = checkpointed(fingerprints(docs, width, id_col, text_col))
    found = grouped(marked, id_col)
    names = F.col(id_col).eqNullSafe(F.col("component_id"))
    later = found.groupBy(F.col(id_col).alias("__later")).agg(F.bool_or(names).alias("stays")).where("not stays")
    later = gathered(later.select("__later"), marked.count())
    return docs.join(later, F.col(id_col).eqNullSafe(F.col("__later")), "left_anti")
