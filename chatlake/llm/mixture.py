"""Mixing sources to target weights by capped water-filling.

The mix has as many words as all sources together. Every source is to give its share by weight,
but no more than ``max_epochs`` times its own words: a source above that is clamped there and
what it lacks goes to the others by weight, until none is above. The clamped set only grows,
and each step is one aggregate over the sources, with whole numbers.

A source whose target is r times its size takes every document floor(r) times. The rest is one
more repetition of some documents: those whose seeded hash lies below a boundary, and a part of
the document at the boundary, so the taken words are the target to the word. The boundary
is found digit by digit: sums of words per source and digit of the hash, then the same inside
the one digit that holds the boundary. No source is sorted or collected, and a source with
a third of all rows is summed before anything is shuffled.

Rows that have one hash (the same id and tie-break) cannot be told apart and share what the
boundary leaves for them, each rounded down. Null sources are a source of their own, a null
weight counts as zero, and so does a source without a weight, which gives nothing. Empty
documents have size zero and give zero words. Ids may be null or repeated. If all sources with a
weight are clamped, the mix is smaller than its sources. An empty table gives no rows. Very long
texts are counted whole. Columns of the input named like a result column are replaced.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatlake.llm.common import text_of
from chatlake.operators.ordering import index_by_key
from chatlake.session import checkpointed, lookup

SEED = 42
# Bits of the hash that order documents, and bits looked at in one round.
KEY_BITS, ROUND_BITS = 60, 12
RESULT = ["source_size", "target", "copies", "part", "taken"]
_EXACT = "decimal(38,0)"


def word_count(column: str = "text") -> Column:
    """Number of words in a text, none in a null one."""
    return F.regexp_count(text_of(column), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def source_sizes(sized: DataFrame, source_col: str = "source", size_col: str = "size") -> DataFrame:
    """``source`` and ``source_size``, one row per source."""
    return sized.groupBy(F.col(source_col).alias("source")).agg(F.sum(size_col).cast("long").alias("source_size"))


def cyclic_weights(sources: DataFrame, cycle: list[int]) -> DataFrame:
    """``source`` and ``weight``: the sources by code point, null last, weigh as in ``cycle``, which repeats."""
    named = sources.select("source").withColumns({"__null": F.col("source").isNull(), "__name": F.coalesce("source", F.lit(""))})
    placed = index_by_key(named, ["__null", "__name"], "__place")
    weight = F.element_at(F.array(*[F.lit(w) for w in cycle]), (F.col("__place") % len(cycle) + 1).cast("int"))
    return placed.select("source", weight.alias("weight"))


def targets(sources: DataFrame, weights: DataFrame, max_epochs: int) -> DataFrame:
    """``source``, ``source_size``, ``target`` (double) and ``wanted`` (the target in whole words)."""
    given = weights.select(F.col("source").alias("__of"), F.col("weight").cast("decimal(12,0)").alias("weight"))
    known = sources.join(lookup(given), F.col("source").eqNullSafe(F.col("__of")), "left").select(
        "source",
        "source_size",
        F.greatest(F.coalesce("weight", F.lit(Decimal(0))), F.lit(Decimal(0))).alias("weight"),
        (F.col("source_size") * max_epochs).alias("cap"),
    )
    known = checkpointed(known)

    def number(value: int) -> Column:
        return F.lit(str(value)).cast(_EXACT)

    sums = known.agg(F.sum("source_size"), F.sum("weight")).first()
    total, all_weights = int(sums[0] or 0), int(sums[1] or 0)
    rest, weight = total, all_weights
    while True:
        level = F.col("weight").cast("decimal(18,0)") * number(rest).cast("decimal(20,0)")
        over = F.col("cap").cast("decimal(20,0)") * number(weight).cast("decimal(18,0)") <= level
        row = known.agg(F.sum(F.when(over, F.col("cap"))), F.sum(F.when(~over, F.col("weight")))).first()
        new = total - int(row[0] or 0), int(row[1] or 0)
        if new == (rest, weight):
            break
        rest, weight = new
        if not weight:  # every source that has a weight is clamped
            over = F.col("weight") > 0
            break
    share = F.when(F.lit(weight > 0), level).otherwise(F.lit(Decimal(0)))
    target = F.when(over, F.col("cap").cast("double")).otherwise(share.cast("double") / max(weight, 1))
    rounded = F.expr(f"({_sql(2)} * __share + {_sql(weight)}) div {_sql(2 * max(weight, 1))}")
    found = known.withColumn("__share", share.cast(_EXACT)).withColumn("target", F.when(F.col("weight") > 0, target).otherwise(F.lit(0.0)))
    wanted = F.when(F.col("weight") == 0, F.lit(0)).when(over, F.col("cap")).otherwise(rounded)
    return found.select("source", "source_size", "target", F.least(wanted, F.col("cap")).cast("long").alias("wanted"))


def _sql(value: int) -> str:
    return f"cast('{value}' as decimal(20,0))"


def _boundaries(keys: DataFrame, plan: DataFrame) -> DataFrame:
    """Per source with words left over: ``edge`` (the hash at the boundary), ``below`` (words of
    smaller hashes) and ``at`` (words of this hash). ``keys`` has __source, __size and __key."""
    state = checkpointed(
        plan.where("extra > 0").select(F.col("source").alias("__of"), "extra", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("below"))
    )
    found = None
    for shift in range(KEY_BITS - ROUND_BITS, -1, -ROUND_BITS):
        inside = F.col("__source").eqNullSafe(F.col("__of")) & (F.shiftright("__key", shift + ROUND_BITS) == F.col("prefix"))
        digit = F.shiftright("__key", shift).alias("digit")
        cells = keys.join(lookup(state), inside).groupBy("__of", "extra", "below", digit).agg(
            F.sum("__size").alias("at"), F.min("__key").alias("edge"), F.max("__key").alias("last")
        )
        # at most 2 ** ROUND_BITS rows of a source
        before = F.expr("coalesce(sum(at) OVER (PARTITION BY __of ORDER BY digit ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)")
        crossed = cells.withColumn("below", F.col("below") + before).where("below <= extra and extra < below + at")
        crossed = checkpointed(crossed.select("__of", "extra", F.col("digit").alias("prefix"), "below", "at", "edge", (F.col("edge") == F.col("last")).alias("single")))
        done = crossed.where("single").select("__of", "below", "at", "edge")
        found = done if found is None else found.union(done)
        state = crossed.where("not single").select("__of", "extra", "prefix", "below")
        if state.isEmpty():
            break
    return checkpointed(found)


def mix(
    sized: DataFrame,
    weights: DataFrame,
    max_epochs: int = 3,
    seed: int = SEED,
    id_col: str = "doc_id",
    source_col: str = "source",
    size_col: str = "size",
    tie: Column | None = None,
) -> DataFrame:
    """The columns of ``sized`` with ``source_size``, ``target`` (of the source), ``copies`` (whole
    repetitions), ``part`` (words of one more, unfinished one) and ``taken`` (all words).

    ``weights`` has ``source`` and ``weight``, a whole number. ``tie`` tells apart rows of one id,
    for instance a hash of the text. ``sized`` is read several times and must give the same rows
    each time, so pass stored columns.
    """
    plan = targets(checkpointed(source_sizes(sized, source_col, size_col)), weights, max_epochs)
    size = F.greatest(F.col("source_size"), F.lit(1))
    plan = plan.withColumn("whole", F.floor(F.expr("wanted div greatest(source_size, 1)")).cast("int"))
    plan = checkpointed(plan.withColumn("extra", F.col("wanted") - F.col("whole") * size))
    names = [c for c in sized.columns if c not in RESULT]
    key = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(f"`{id_col}`"), *([tie] if tie is not None else [])), 64 - KEY_BITS)
    row = F.struct(*[F.col(f"`{c}`") for c in names]).alias("__row")
    keyed = sized.select(row, F.col(f"`{source_col}`").alias("__source"), F.col(f"`{size_col}`").cast("long").alias("__size"), key.alias("__key"))
    edges = _boundaries(keyed.select("__source", "__size", "__key"), plan).withColumnRenamed("__of", "__edge_of")
    rules = plan.join(edges, F.col("source").eqNullSafe(F.col("__edge_of")), "left").select(
        F.col("source").alias("__of"), "source_size", "target", "whole", "extra", "below", "at", "edge"
    )
    rules = checkpointed(rules)
    again = F.coalesce(F.col("__key") < F.col("edge"), F.lit(False))
    shared = F.expr("cast(cast(__size as decimal(19,0)) * cast(extra - below as decimal(19,0)) div at as long)")
    part = F.when(F.coalesce(F.col("__key") == F.col("edge"), F.lit(False)), shared).otherwise(F.lit(0).cast("long"))
    joined = keyed.join(lookup(rules), F.col("__source").eqNullSafe(F.col("__of")))
    made = joined.withColumns({"copies": F.col("whole") + again.cast("int"), "part": part})
    return made.select(
        *[F.col(f"__row.`{c}`").alias(c) for c in names],
        "source_size",
        "target",
        "copies",
        "part",
        (F.col("__size") * F.col("copies") + F.col("part")).alias("taken"),
    )


def repetitions(mixed: DataFrame, size_col: str = "size") -> DataFrame:
    """One row per repetition of a document in the mix, with ``repetition`` (from 1) and ``words``:
    how many of its words this repetition has, all but for the unfinished one."""
    whole = F.transform(F.sequence(F.lit(1), F.greatest(F.col("copies"), F.lit(1))), lambda i: F.struct(i.alias("repetition"), F.col(size_col).cast("long").alias("words")))
    whole = F.when(F.col("copies") > 0, whole).otherwise(F.slice(whole, 1, 0))
    rest = F.array(F.struct((F.col("copies") + 1).alias("repetition"), F.col("part").alias("words")))
    every = F.concat(whole, F.when(F.col("part") > 0, rest).otherwise(F.slice(rest, 1, 0)))
    names = [F.col(f"`{c}`") for c in mixed.columns if c not in ("repetition", "words")]
    return mixed.withColumn("__each", F.explode(every)).select(*names, "__each.repetition", "__each.words")
