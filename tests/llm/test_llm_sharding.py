"""Shards of near equal size, also when equal texts or one id hold much of the table."""

import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from cases import frame, odd_rows, prose, with_clashes
from chatlake.llm import sharding


def spread(docs, n):
    size = (F.octet_length(F.coalesce("text", F.lit(""))) + 1).cast("long")
    return sharding.shard_by_size(docs, n, size, F.xxhash64(F.coalesce("text", F.lit(""))))


def check(rows, n, largest, total):
    slots, sizes = defaultdict(list), defaultdict(int)
    for shard, slot, size in rows:
        assert 0 <= shard < n
        slots[shard].append(slot)
        sizes[shard] += size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    for shard in range(n):
        assert abs(sizes[shard] - total / n) <= 2 * largest + 0.002 * total / n + 1
    return slots


def test_hot_group_is_divided(spark):
    rng = random.Random(5)
    rows = [(i, prose(rng, 20)) for i in range(3000)] + [(i, "hot text of one group") for i in range(3000, 5000)]
    got = spread(with_clashes(frame(spark, rows)).drop("shard", "slot"), 16).select("shard", "slot", "text", "doc_id").collect()
    assert sorted(r["doc_id"] for r in got) == [r[0] for r in rows]
    sizes = [(r["shard"], r["slot"], len(r["text"]) + 1) for r in got]
    check(sizes, 16, max(s for _, _, s in sizes), sum(s for _, _, s in sizes))
    groups = defaultdict(set)
    for r in got:
        groups[r["text"]].add(r["shard"])
    assert all(len(g) == 1 for t, g in groups.items() if t != "hot text of one group")


def test_rows_of_one_key_stay_together(spark):
    got = spread(frame(spark, [(7, "same")] * 50), 4).collect()
    assert sorted(r["slot"] for r in got) == list(range(50))
    assert len({r["shard"] for r in got}) == 1


def test_odd_documents_and_clashing_names(spark):
    rows = odd_rows(random.Random(6))
    docs = with_clashes(frame(spark, rows))
    got = spread(docs, 4)
    assert sorted(got.columns) == sorted(docs.columns)
    found = got.select("doc_id", "text", "shard", "slot", "kept").collect()
    assert sorted([(r["doc_id"], r["text"]) for r in found], key=repr) == sorted([(r[0], r[1]) for r in rows], key=repr)
    assert {r["kept"] for r in found} == {"own kept"}
    slots = defaultdict(list)
    for r in found:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert spread(frame(spark, []), 4).count() == 0


@pytest.mark.parametrize("rows", [[(5, None)], [(None, "a"), (None, "b")], [(-(1 << 40), "a"), (1 << 40, "b"), (0, "c")]])
def test_few_rows(spark, rows):
    assert spread(frame(spark, rows), 8).count() == len(rows)


def test_query(spark, sf_dir):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = entry_points.queries()["op3_histogram_shards"](spark, sf_dir)
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    rows = got.collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    for r in rows:
        data = (docs[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(data) + 1, zlib.crc32(data), "bytes", None)
    check([(r["shard"], r["slot"], r["size"]) for r in rows], 16, max(r["size"] for r in rows), sum(r["size"] for r in rows))
