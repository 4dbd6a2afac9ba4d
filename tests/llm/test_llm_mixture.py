"""Water-filling against fractions, and what the mix takes against its targets."""

import random
from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from cases import frame, odd_rows, prose, with_clashes, words
from chatlake.llm import mixture


def fill(sizes, weights, epochs):
    """Targets by the definition, as fractions."""
    total, clamped = sum(sizes.values()), set()
    while True:
        rest = total - sum(epochs * sizes[s] for s in clamped)
        weight = sum(weights[s] for s in sizes if s not in clamped)
        target = {s: Fraction(epochs * sizes[s]) if s in clamped else Fraction(rest * weights[s], weight or 1) for s in sizes}
        above = {s for s in sizes if target[s] > epochs * sizes[s]}
        if not above:
            return target
        clamped |= above


def cycle(sources):
    order = sorted((s for s in sources if s is not None)) + [None] * (None in sources)
    return {s: i % 3 + 1 for i, s in enumerate(order)}


def check(rows, got, epochs=3):
    """``rows`` are (id, source, size), ``got`` rows of the mix."""
    sizes = defaultdict(int)
    for _, source, size in rows:
        sizes[source] += size
    want = fill(sizes, cycle(sizes), epochs)
    taken, ties = defaultdict(int), defaultdict(int)
    for r in got:
        assert r["taken"] == r["copies"] * r["size"] + r["part"]
        assert 0 <= r["taken"] <= epochs * r["size"] and 0 <= r["part"] <= r["size"]
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(float(want[r["source"]]))
        taken[r["source"]] += r["taken"]
        ties[r["source"]] += r["part"] > 0
    for source, target in want.items():
        assert abs(taken[source] - target) <= max(1, ties[source]), source
    assert sorted(map(repr, ((r["doc_id"], r["source"], r["size"]) for r in got))) == sorted(map(repr, rows))


def mixed(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, source string, size long")
    weights = mixture.cyclic_weights(mixture.source_sizes(docs), [1, 2, 3])
    return mixture.mix(docs, weights, **options)


@pytest.mark.parametrize("seed", range(4))
def test_random_sources(spark, seed):
    rng = random.Random(seed)
    names = ["hot", None, "", "Ä", "z", *[f"s{i}" for i in range(rng.randrange(1, 9))]]
    scale = {n: rng.choice([1, 3, 60, 2000]) for n in names}
    rows = []
    for i in range(400):
        source = "hot" if rng.random() < 0.35 else rng.choice(names)
        rows.append((i, source, rng.randrange(scale[source])))
    got = mixed(spark, rows).collect()
    check(rows, got)
    again = spark.createDataFrame(rng.sample(rows, len(rows)), "doc_id long, source string, size long").repartition(5)
    weights = mixture.cyclic_weights(mixture.source_sizes(again), [1, 2, 3])
    assert sorted(map(repr, mixture.mix(again, weights).collect())) == sorted(map(repr, got))
    other = mixed(spark, rows, seed=7).collect()
    check(rows, other)
    assert sorted(map(repr, other)) != sorted(map(repr, got))


def test_clamped_sources_pass_on_what_they_lack(spark):
    rows = [(1, "a", 1000), (2, "b", 10), (3, "c", 400), (4, "d", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, size long")
    weights = spark.createDataFrame([("a", 1), ("b", 50), ("c", 9), ("d", 40)], "source string, weight int")
    got = {r["source"]: r for r in mixture.mix(docs, weights).collect()}
    assert {s: (r["target"], r["taken"]) for s, r in got.items()} == {"a": (170.0, 170), "b": (30.0, 30), "c": (1200.0, 1200), "d": (15.0, 15)}


def test_sources_without_weight_give_nothing(spark):
    docs = spark.createDataFrame([(1, "a", 10), (2, "b", 10), (3, None, 100)], "doc_id long, source string, size long")
    weights = spark.createDataFrame([("a", 1), ("b", None), ("x", 5)], "source string, weight int")
    got = {r["source"]: (r["target"], r["taken"]) for r in mixture.mix(docs, weights, max_epochs=2).collect()}
    assert got == {"a": (20.0, 20), "b": (0.0, 0), None: (0.0, 0)}


def test_rows_that_cannot_be_told_apart_share(spark):
    rows = [(None, "a", 30)] * 50 + [(1, "b", 3000)]
    got = mixed(spark, rows).collect()
    check(rows, got)
    assert len({r["taken"] for r in got if r["source"] == "a"}) == 1


def test_sizes_beyond_32_bits(spark):
    rows = [(i, f"s{i % 5}", 10**13 + 7 * i) for i in range(40)]
    check(rows, mixed(spark, rows).collect())


def test_repetitions_hold_all_taken_words(spark):
    rng = random.Random(9)
    rows = [(i, rng.choice("abc"), rng.randrange(50) * (5 if i % 7 else 1)) for i in range(60)]
    own = mixed(spark, rows)
    each = mixture.repetitions(own).collect()
    assert sum(r["words"] for r in each) == sum(r["taken"] for r in own.collect())
    assert len({(r["doc_id"], r["repetition"]) for r in each}) == len(each)
    assert all(r["words"] == r["size"] or r["words"] == r["part"] for r in each)


def test_words_are_counted_as_the_pattern_does(spark):
    rows = odd_rows(random.Random(44))
    got = frame(spark, rows).select(mixture.word_count().alias("n"), "text").collect()
    assert all(r["n"] == len(words(r["text"])) for r in got)


def test_odd_documents(spark):
    docs = with_clashes(frame(spark, odd_rows(random.Random(45)))).withColumns({"target": F.lit("own"), "__key": F.lit("own key"), "source_size": F.lit("own")})
    sized = docs.withColumn("size", mixture.word_count())
    out = mixture.mix(sized, mixture.cyclic_weights(mixture.source_sizes(sized), [1, 2, 3]), tie=F.xxhash64("text"))
    got = out.collect()
    assert {r["__key"] for r in got} == {"own key"} and {r["kept"] for r in got} == {"own kept"}
    check([(r["doc_id"], r["source"], len(words(r["text"]))) for r in docs.collect()], got)
    none = frame(spark, []).withColumn("size", mixture.word_count())
    assert mixture.mix(none, mixture.cyclic_weights(mixture.source_sizes(none), [1])).count() == 0


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    got = entry_points.queries()["op13_source_mixture"](spark, sf_dir)
    assert got.columns[:5] == ["doc_id", "size", "source_size", "target", "taken"]
    of = {r["doc_id"]: r["source"] for r in docs}
    rows = [{**r.asDict(), "source": of[r["doc_id"]]} for r in got.collect()]
    check([(r["doc_id"], r["source"], len(words(r["text"]))) for r in docs], rows)
