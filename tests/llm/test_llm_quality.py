"""Quality scores: gradients, held-out ranking, odd inputs."""

import math
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from cases import frame, odd_rows, remainder, with_clashes
from chatlake.llm import quality_mil


def test_passages_are_whole():
    text = ("word " * 64 + "Other! " * 10).encode()
    rows = quality_mil.encode(text)
    assert rows.shape == (2, quality_mil.WIDTH)
    assert rows[1, 7] > 0 and rows[0, 7] == 0
    assert not quality_mil.encode(b"").any()


def test_buckets_are_shares_of_words_and_byte_runs():
    rows = quality_mil.encode(b"a b a c")
    own = rows[0, quality_mil._COUNTS : quality_mil._COUNTS + quality_mil.BUCKETS]
    assert own[zlib.crc32(b"a") % quality_mil.BUCKETS] == np.float32(0.5**0.5) and np.isclose((own**2).sum(), 1)
    runs = rows[0, quality_mil._COUNTS + quality_mil.BUCKETS :]
    assert np.isclose((runs**2).sum(), 1) and (runs > 0).sum() > 2
    assert quality_mil.encode(b"a").shape == quality_mil.encode(b"ab").shape == (1, quality_mil.WIDTH)


def test_forward_pass_and_gradient():
    rng = np.random.default_rng(3)
    x, starts, labels = rng.normal(0, 1, (9, quality_mil.WIDTH)), np.array([0, 1, 4]), np.array([1.0, 0.0, 0.3])
    model = quality_mil.Model()
    for v in model.p.values():
        v += rng.normal(0, 0.3, v.shape)

    def plain():
        out = []
        for a, b in ((0, 1), (1, 4), (4, 9)):
            codes, weights = [], []
            for row in x[a:b]:
                h = np.tanh(row @ model.p["E"] + model.p["e"])
                codes.append(h)
                weights.append(math.exp(sum(model.p["w"] * np.tanh(h @ model.p["V"]) / (1 + np.exp(-h @ model.p["U"])))))
            z = sum(w * h for w, h in zip(weights, codes)) / sum(weights)
            out.append(1 / (1 + math.exp(-(z @ model.p["o"] + model.p["b"][0]))))
        return np.array(out)

    def loss():
        y = plain()
        return -np.mean(labels * np.log(y) + (1 - labels) * np.log(1 - y))

    assert np.allclose(model._forward(x, starts)[-1], plain())
    grad = model._gradient(x, starts, labels)
    for name, v in model.p.items():
        for i in rng.choice(v.size, min(6, v.size), replace=False).tolist():
            before = v.flat[i]
            v.flat[i] = before + 1e-5
            up = loss()
            v.flat[i] = before - 1e-5
            down = loss()
            v.flat[i] = before
            assert math.isclose((up - down) / 2e-5, grad[name].flat[i], rel_tol=1e-4, abs_tol=1e-8), name


def test_fit_lowers_the_loss_by_attention():
    rng = np.random.default_rng(1)
    bags, labels = [], []
    for i in range(200):
        bag = rng.normal(0, 1, (rng.integers(1, 8), quality_mil.WIDTH)).astype(np.float32)
        if i % 2:
            bag[rng.integers(len(bag)), 3] = 6  # one telling passage
        bags.append(bag)
        labels.append(i % 2)
    model = quality_mil.Model()
    model.fit(bags, np.array(labels, float))
    scores = model.score(bags)
    assert np.mean((scores > 0.5) == np.array(labels)) > 0.95
    starts = np.array([0])
    told = max((b for b, y in zip(bags, labels) if y and len(b) > 4), key=len)
    weights = model._forward((told - model.mean) / model.scale, starts)[3]
    assert weights.sum().round(6) == 1 and weights.argmax() == told[:, 3].argmax()


def test_odd_documents_and_labels(spark):
    rows = odd_rows(random.Random(11))
    docs = with_clashes(frame(spark, rows))
    labels = spark.createDataFrame([(101, 1), (101, 0), (300, 1), (200, 0), (None, 1), (4, None)], "doc_id long, quality int")
    model = quality_mil.learn(docs, labels, F.lit(True))
    got = quality_mil.score(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if r["doc_id"] is not None and 200 <= r["doc_id"] < 230}) == 1
    assert quality_mil.score(frame(spark, []), model).count() == 0
    none = quality_mil.learn(docs, labels.limit(0), F.lit(True))
    assert {r["score"] for r in quality_mil.score(docs, none).collect()} == {0.5}


def test_held_out_ranking(spark):
    folder = "/root/testdata/sf0.01"
    got = entry_points.queries()["op5_attention_quality"](spark, folder)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = {r["doc_id"]: r for r in got.collect()}
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(r["held_out"] == (remainder(k, 4) == 2) and r["predicted"] == int(r["score"] >= 0.7) for k, r in rows.items())
    labels = spark.read.parquet(f"{folder}/labels.parquet").where("quality is not null").collect()
    held = [(rows[x["doc_id"]]["score"], x["quality"]) for x in labels if rows[x["doc_id"]]["held_out"]]
    good, bad = [s for s, y in held if y], [s for s, y in held if not y]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad])
    assert auc > 0.9
