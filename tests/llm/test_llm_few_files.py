"""Small frames between steps are few files, however many partitions a shuffle has."""

import random
from collections import Counter
from pathlib import Path

import pytest
from cases import frame, prose
from chatlake.llm import decontam, outliers, simhash
from chatlake.session import staging_root

SETTINGS = {"spark.sql.shuffle.partitions": "24", "spark.sql.adaptive.coalescePartitions.enabled": "false"}


@pytest.fixture
def stored(spark):
    """Files of the checkpoints made since, by checkpoint."""
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    staging_root(spark)
    root = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    known = set(root.glob("rdd-*"))
    yield lambda: Counter(p.parent.name for p in root.glob("rdd-*/part-*") if p.parent not in known)
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def texts(n):
    rng = random.Random(5)
    return [(i, prose(rng, 80, 500), "en", "web") for i in range(n)]


def test_quality_rules(spark, stored):
    docs = frame(spark, texts(150)).coalesce(2)
    assert outliers.passing(docs).count() > 100
    assert max(stored().values()) <= 2


def test_near_duplicates(spark, stored):
    rows = texts(60)
    docs = frame(spark, rows + [(100 + i, *r[1:]) for i, r in enumerate(rows)]).coalesce(2)
    assert sorted(r[0] for r in simhash.first_of_each(docs).select("doc_id").collect()) == list(range(60))
    # but the edges, whose number is not known before they are made
    assert sorted(stored().values())[-2] <= 2


def test_items(spark, stored):
    known, values = decontam.item_windows(frame(spark, texts(20)).coalesce(2), "doc_id")
    assert known.count() == values.count() == 20 * 73
    assert max(stored().values()) <= 2
