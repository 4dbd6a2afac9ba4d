"""Language identification: phrases against a plain search, held-out accuracy."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from cases import frame, odd_rows, remainder, with_clashes
from chatlake.llm import langid


def phrases(sample, text):
    """Longest runs that occur in the sample, one after the other."""
    n = at = 0
    while at < len(text):
        length = 1
        while at + length < len(text) and text[at : at + length + 1] in sample:
            length += 1
        at += length
        n += 1
    return n


def test_automaton_counts_longest_phrases():
    rng = random.Random(8)
    samples = {x: "".join(rng.choice("abcde ") for _ in range(300)) for x in ("p", "q")}
    samples = {k: " ".join(v.split()) for k, v in samples.items()}
    texts = [" ".join("".join(rng.choice("abcdef ") for _ in range(n)).split()) for n in (1, 5, 40, 200)]
    model = langid.Model(samples)
    got, lengths = model.phrases(texts, model.symbols())
    assert got.tolist() == [[phrases(samples[k], t) for k in ("p", "q")] for t in texts]
    assert lengths.tolist() == [len(t) for t in texts]


@pytest.mark.parametrize("stretch", [1, 3, 50, langid.STRETCH])
def test_long_texts_are_parsed_as_a_whole(monkeypatch, stretch):
    monkeypatch.setattr(langid, "STRETCH", stretch)
    rng = random.Random(10)
    samples = {"p": "abcabc" * 5, "q": "xyz", "r": " ".join("".join(rng.choice("abc") for _ in range(300)).split())}
    texts = ["abc" * 2000, "", "a", "".join(rng.choice("abcxyz") for _ in range(3000)), "ab" * 75, "cab" * 17]
    model = langid.Model(samples)
    got = model.phrases(texts, model.symbols())[0]
    assert got.tolist() == [[phrases(samples[k], t) if t else 0 for k in sorted(samples)] for t in texts]


def test_marks_stay_with_their_letters(spark):
    hindi, split = "हिन्दी भाषा में लिखा", "re\u0301sume\u0301 de\u0301compose\u0301"
    assert langid._plain(hindi) == hindi and langid._plain(split) == "résumé décomposé"
    assert langid._plain("ÉTÉ 1 a\u0327b") == "été a\u0327b"
    rows = [(i, hindi, "hi", "s") for i in range(3)] + [(10 + i, split, "fr", "s") for i in range(3)]
    model = langid.learn(frame(spark, rows), F.lit(True))
    texts = [(1, "भाषा में"), (2, "décomposé"), (3, "\u0301\u0301 12"), (4, "de\u0301compose\u0301")]
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify(frame(spark, texts), model).collect()}
    assert got == {1: "hi", 2: "fr", 3: "und", 4: "fr"}


def test_odd_documents(spark):
    docs = with_clashes(frame(spark, odd_rows(random.Random(9))))
    model = langid.learn(docs, F.lit(True))
    got = langid.identify(docs, model).collect()
    assert len(got) == docs.count()
    assert all(0 <= r["score"] <= 1 for r in got)
    found = {r["doc_id"]: r["lang_pred"] for r in got}
    assert {found[i] for i in (0, 1, 2)} == {"und"}
    assert langid.identify(frame(spark, []), model).count() == 0


def test_nothing_learned(spark):
    empty = langid.learn(frame(spark, []), F.lit(True))
    assert langid.identify(frame(spark, [(1, "some text")]), empty).collect()[0][1:] == ("und", 0.0)


def test_sample_is_bounded_and_ignores_order(spark):
    rows = [(i, f"text number {i} of many words " * 20, "aa" if i % 2 else "bb", "s") for i in range(400)]
    one = langid.learn(frame(spark, rows), F.lit(True))
    other = langid.learn(frame(spark, rows[::-1] + rows), F.lit(True))
    assert np.array_equal(one.table, other.table)
    assert max(one.bits) <= np.log2(langid.SAMPLE_CHARS + 1)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in entry_points.queries()["op4_cross_parsing_language"](spark, folder).collect()}
    truth = spark.read.parquet(f"{folder}/documents.parquet").where("lang is not null and text is not null").collect()
    assert all(r["held_out"] == (remainder(k, 4) == 2) for k, r in got.items())
    told = [(got[r["doc_id"]]["lang_pred"], r["lang"]) for r in truth if got[r["doc_id"]]["held_out"] and got[r["doc_id"]]["lang_pred"] != "und"]
    assert len(told) > 100
    assert np.mean([a == b for a, b in told]) > 0.93
