"""Shards of nearly equal size by histogram sort.

Rows are ordered by a key of two whole numbers (hash of the text, id), so equal texts
stand together and only a boundary inside a group can part them. Boundaries come from
exact histograms: each round counts size and rows below evenly spaced probes inside the
intervals that still hold an unsettled boundary, and a boundary is settled as soon as a
probe is within tolerance or the key cannot be divided further. Rows are then exchanged
once, straight to their part, and their place in the shard is the place in the part plus
the counted rows before it.

Every probe is a prefix of the key's bits, so a group of equal texts, however large, is
divided by the bits of the id. Rows that agree in hash and id cannot be divided; they
stay together. Null groups count as 0, null ids come
first, an empty table gives no rows. Extra columns pass through untouched, but for those
named shard and slot, in whose place the result's stand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatlake.session import checkpointed

# Bits of the key that one round of probes resolves.
ROUND_BITS = 12
# Allowed distance of a boundary from its ideal place: of a shard, of a part.
SHARD_TOLERANCE = 0.0005
PART_TOLERANCE = 0.1

_NAMES = ["__h", "__i", "__w"]


def _digits(column: Column, shift: int) -> Column:
    return F.shiftrightunsigned(column, shift)


def _boundaries(keys: DataFrame, targets: list[tuple[int, int, int, int]], id_bits: int) -> list[tuple[int, int, int]]:
    """For each target (factor of size, factor of rows, wanted total, tolerance) the smallest
    key at or above its boundary as (hash, id) in unsigned order, and the rows below it.

    What reaches the driver is one row per probe of an open interval: two to the power of
    ROUND_BITS for each target at most, whatever the number of rows.
    """
    spark = keys.sparkSession
    path = [(0, s) for s in [64 - b for b in range(ROUND_BITS, 64, ROUND_BITS)] + [0]]
    path += [(1, s) for s in [id_bits - b for b in range(ROUND_BITS, id_bits, ROUND_BITS)] + [0]]
    settled: dict[int, tuple[int, int, int]] = {}
    # open interval: (prefix of hash, prefix of id), size and rows below it, its targets
    open_at: dict[tuple[int, int], list] = {(0, 0): [0, 0, list(range(len(targets)))]}
    last_level, last_shift = 0, 64
    for level, shift in path:
        if not open_at:
            break
        width = (last_shift if level == last_level else id_bits) - shift
        hash_shift = last_shift if last_level == 0 else 0
        id_shift = last_shift if last_level else id_bits
        rows = keys
        if last_shift != 64 or last_level:
            schema = "ph long, pi long"
            wanted = spark.createDataFrame([(_signed(h), i) for h, i in open_at], schema)
            rows = keys.join(
                F.broadcast(wanted),
                (_digits(F.col("__h"), hash_shift) == F.col("ph")) & (_digits(F.col("__i"), id_shift) == F.col("pi")),
            )
        else:
            rows = keys.withColumns({"ph": F.lit(0).cast("long"), "pi": F.lit(0).cast("long")})
        digit = _digits(F.col("__h" if level == 0 else "__i"), shift).bitwiseAND(F.lit((1 << width) - 1))
        counted = rows.groupBy("ph", "pi", digit.alias("d")).agg(F.sum("__w").alias("w"), F.count("*").alias("n"))
        cells: dict[tuple[int, int], list] = {}
        for r in counted.collect():
            cells.setdefault((r["ph"] % (1 << 64), r["pi"]), []).append((r["d"], r["w"], r["n"]))
        following: dict[tuple[int, int], list] = {}
        final = (level, shift) == path[-1]
        for (ph, pi), (w, n, own) in open_at.items():
            own = sorted(own, key=lambda t: targets[t][2] / max(1, targets[t][0] + targets[t][1]))
            for d, dw, dn in sorted(cells.get((ph, pi), [])):
                if level == 0:
                    here, at = ((ph << width) | d, 0), (((ph << width) | d) << shift, 0)
                    after = (((ph << width) | d) + 1) << shift, 0
                else:
                    here, at = (ph, (pi << width) | d), (ph, ((pi << width) | d) << shift)
                    after = ph, (((pi << width) | d) + 1) << shift
                rest = []
                for t in own:
                    a, b, want, slack = targets[t]
                    low, high = a * w + b * n, a * (w + dw) + b * (n + dn)
                    if want > high + (0 if final else slack):
                        rest.append(t)
                    elif abs(want - low) <= slack or final and want - low <= high - want:
                        settled[t] = (*at, n)
                    elif abs(want - high) <= slack or final:
                        settled[t] = (*after, n + dn)
                    elif want <= high:
                        following.setdefault(here, [w, n, []])[2].append(t)
                    else:
                        rest.append(t)
                w, n, own = w + dw, n + dn, rest
            for t in own:  # at or beyond the last row of the interval
                settled[t] = (*after, n)
        open_at = following
        last_level, last_shift = level, shift
    return [settled[t] for t in range(len(targets))]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def shard_by_size(docs: DataFrame, n_shards: int, size: Column, group: Column, id_col: str = "doc_id", parts: int | None = None) -> DataFrame:
    """All columns of ``docs`` with ``shard`` (0 to ``n_shards`` - 1, sums of ``size`` near equal)
    and ``slot`` (gapless from 0 in each shard). ``group`` is a whole number, such as a hash of the text, whose
    equal values stand together.

    ``parts`` is the number of tasks that share the exchange, at least one per shard; by
    default the session's number of shuffle partitions.
    """
    spark = docs.sparkSession
    own = [f"`{c}`" for c in docs.columns if c not in ("shard", "slot")]
    parts = max(n_shards, parts or int(spark.conf.get("spark.sql.shuffle.partitions")))
    first = docs.agg(F.min(F.col(id_col).cast("long")), F.max(F.col(id_col).cast("long"))).first()
    low, high = (first[0] or 0), (first[1] or 0)
    id_bits = max(1, min(63, (high - low + 1).bit_length()))
    keyed = docs.withColumns(
        {
            "__h": F.coalesce(group.cast("long"), F.lit(0)),
            "__i": F.coalesce(F.col(id_col).cast("long") - F.lit(low) + 1, F.lit(0)).cast("long"),
            "__w": size.cast("long"),
        }
    ).drop("shard", "slot")
    keys = checkpointed(keyed.select(*_NAMES))
    total = keys.agg(F.sum("__w"), F.count("*")).first()
    weight, count = total[0] or 0, total[1]
    targets = [(1, 0, round(weight * k / n_shards), int(weight / n_shards * SHARD_TOLERANCE)) for k in range(1, n_shards)]
    both = 2 * weight * count
    targets += [(count, weight, both * k // parts, int(both / parts * PART_TOLERANCE)) for k in range(1, parts)]
    found = _boundaries(keys, targets, id_bits) if count else []
    shard_starts = sorted(found[: n_shards - 1])
    edges = sorted(set(found))
    # per part: shard and rows before the part within the shard
    parts_of = [(0, 0, 0)]
    for at, i, n in edges:
        shard = sum(s <= (at, i, n) for s in shard_starts)
        base = shard_starts[shard - 1][2] if shard else 0
        parts_of.append((len(parts_of), shard, n - base))
    # the first bits of the hash give the parts that start before; the rest is compared
    cells: dict[int, list] = {}
    for at, i, _ in edges:
        if at < 1 << 64:
            cells.setdefault(at >> (64 - ROUND_BITS), []).append((_signed(at ^ (1 << 63)), i))
    rows, before = [], 0
    for cell in range(1 << ROUND_BITS):
        inside = cells.get(cell, [])
        rows.append((cell, before, inside))
        before += len(inside)
    cell_type = T.StructType(
        [
            T.StructField("__cell", T.LongType()),
            T.StructField("__before", T.IntegerType()),
            T.StructField("__edges", T.ArrayType(T.StructType([T.StructField("h", T.LongType()), T.StructField("i", T.LongType())]))),
        ]
    )
    lookup = F.broadcast(spark.createDataFrame(rows, cell_type))
    place = F.broadcast(spark.createDataFrame(parts_of, "__part int, shard int, __base long"))
    flipped = F.col("__h").bitwiseXOR(F.lit(_signed(1 << 63)))
    below = F.size(F.filter("__edges", lambda e: e <= F.struct(flipped.alias("h"), F.col("__i").alias("i"))))
    dealt = (
        keyed.withColumn("__cell", _digits(F.col("__h"), 64 - ROUND_BITS))
        .join(lookup, "__cell")
        .withColumn("__part", F.col("__before") + F.when(F.size("__edges") == 0, 0).otherwise(below))
    )
    exchanged = dealt.repartitionById(len(parts_of), F.col("__part")).sortWithinPartitions("__part", flipped, "__i")
    placed = exchanged.withColumn("__at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    return placed.join(place, "__part").withColumn("slot", F.col("__base") + F.col("__at")).select(*own, "shard", "slot")
