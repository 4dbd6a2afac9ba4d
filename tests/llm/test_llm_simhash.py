"""SimHash groups against all pairs on small inputs."""

import random
import re

import pytest
import xxhash

import __spark_entry__ as entry_points
from cases import WORD, frame, odd_rows, with_clashes
from chatlake.llm import components, simhash


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def fingerprint(text, width):
    words = WORD.findall(lower(text))
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + width]).encode(), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)


def classes(points):
    """Least fingerprint reachable for every one, by comparing all pairs."""
    points = sorted(set(points))
    parent = {p: p for p in points}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for i, a in enumerate(points):
        for b in points[i + 1 :]:
            if (a ^ b).bit_count() <= 2:
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return {p: root(p) for p in points}


def expected(rows, width):
    prints = [(r[0], fingerprint(r[1], width)) for r in rows]
    of = classes([p for _, p in prints])
    least = {}
    for key, p in prints:
        if key is not None:
            least[of[p]] = min(key, least.get(of[p], key))
    return sorted([(k, f"{p:016x}", least.get(of[p])) for k, p in prints], key=repr)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("full", [2, 32])
def test_links_of_planted_prints(spark, monkeypatch, full):
    monkeypatch.setattr(simhash, "FULL_BUCKET", full)
    rng = random.Random(12)
    points = set()
    for _ in range(40):
        centre = rng.getrandbits(64)
        points.add(centre)
        for _ in range(rng.randrange(12)):
            p = centre
            for b in rng.sample(range(64), rng.randrange(1, 5)):
                p ^= 1 << b
            points.add(p)
    hub = rng.getrandbits(64)
    points |= {hub ^ (1 << a) ^ (1 << b) for a in range(6) for b in range(58, 64)} | {0, 1, 1 << 63, (1 << 64) - 1}
    prints = spark.createDataFrame([(signed(p),) for p in points], "fp long")
    found = {r["node"] % (1 << 64): r["component"] % (1 << 64) for r in components.components(simhash.links(prints)).collect()}
    want = classes(points)
    groups = {}
    for p in points:
        groups.setdefault(found.get(p, p), set()).add(p)
    wanted = {}
    for p in points:
        wanted.setdefault(want[p], set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_chains_hold_for_all_close_pairs():
    """Pigeonring: of two prints within the distance some segment starts chains within budget."""
    rng = random.Random(13)
    n, d = simhash.SEGMENTS, simhash.DISTANCE
    for _ in range(300):
        differing = 0
        for b in rng.sample(range(64), rng.randrange(0, d + 1)):
            differing |= 1 << b
        each = [(differing >> s * simhash.SEGMENT_BITS & ((1 << simhash.SEGMENT_BITS) - 1)).bit_count() for s in range(n)]
        chains = [all(sum(each[(s + k) % n] for k in range(length)) * n <= length * d for length in range(1, n + 1)) for s in range(n)]
        assert any(chains)


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 400)] + [(500, 500), (None, 3), (601, 600), (600, 601)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 400)}, 600: 600, 601: 600}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_odd_documents(spark):
    rows = odd_rows(random.Random(14))
    docs = with_clashes(frame(spark, rows))
    got = simhash.near_duplicates(docs, width=3).collect()
    want = expected(rows, 3)
    assert sorted([(r["doc_id"], f"{r['fp'] % (1 << 64):016x}", r["component_id"]) for r in got], key=repr) == want
    stay = simhash.first_of_each(docs)
    assert stay.columns == docs.columns
    kept = [r["doc_id"] for r in stay.collect()]
    assert kept.count(200) == 1 and not set(range(201, 230)) & set(kept)
    assert kept.count(101) == 4 and 300 in kept and 0 in kept and 1 not in kept
    assert simhash.near_duplicates(frame(spark, [])).count() == 0
    assert simhash.first_of_each(frame(spark, [])).count() == 0


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = entry_points.queries()["op6_simhash"](spark, sf_dir)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, got.collect()), key=repr) == expected(docs, 3)
