"""Quality rules against counts in Python and a plain estimate in numpy."""

import math
import random
from collections import Counter, defaultdict

import numpy as np

import __spark_entry__ as entry_points
from cases import frame, odd_rows, prose, with_clashes, words
from chatlake.llm import outliers


def counts(text):
    own = words(text)
    windows = [tuple(own[i : i + 3]) for i in range(len(own) - 2)]
    often = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    n = len(own)
    return (
        n,
        sum(map(len, own)),
        sum((text or "").count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(repeated),
        n < 50 or 100 * len(repeated) > 50 * n,
    )


def vector(c):
    n, chars, symbols, lines, repeated, _ = c
    return [math.log(max(1, chars) / max(1, n)), math.log1p(100 * symbols / max(1, chars)), math.log1p(20 * repeated / max(1, n)), math.log1p(lines)]


def moments(x):
    centre = x.mean(0)
    return centre, (x.T @ x) / len(x) - np.outer(centre, centre) + np.diag(np.square(outliers.FLOORS))


def distances(x, centre, covariance):
    d = x - centre
    return np.einsum("ij,jk,ik->i", d, np.linalg.inv(covariance), d)


def estimate(x):
    """Concentration steps from both starts; the smaller determinant wins."""
    h = math.ceil(len(x) * outliers.SUBSET)
    q = (np.quantile(np.floor(x * outliers.QUARTILE_BINS), [0.25, 0.5, 0.75], axis=0, method="inverted_cdf") + 0.5) / outliers.QUARTILE_BINS
    starts = [moments(x), (q[1], np.diag(((q[2] - q[0]) / 1.349) ** 2 + np.square(outliers.FLOORS)))]
    best = []
    for centre, covariance in starts:
        least = math.inf
        while True:
            bins = np.floor(np.log(distances(x, centre, covariance) + 1e-9) * outliers.BINS_PER_E)
            new = moments(x[bins <= np.sort(bins)[h - 1]])
            size = np.linalg.slogdet(new[1])[1]
            if least < math.inf and not size < least - outliers.SETTLED * max(1, abs(least)):
                break
            least, (centre, covariance) = size, new
        best.append((least, centre, covariance))
    return min(best, key=lambda b: b[0])[1:]


def verdicts(rows):
    """kept, and the distance, per row of (id, text, lang, source)."""
    found = [counts(r[1]) for r in rows]
    passed = [i for i, c in enumerate(found) if not c[5]]
    sizes = Counter((rows[i][2], rows[i][3]) for i in passed)
    small = Counter(rows[i][2] for i in passed if sizes[rows[i][2], rows[i][3]] < outliers.MIN_ROWS)
    strata = defaultdict(list)
    for i in passed:
        lang, source = rows[i][2:4]
        own = sizes[lang, source] >= outliers.MIN_ROWS
        strata[(2, lang, source) if own else (1, lang) if small[lang] >= outliers.MIN_ROWS else (0,)].append(i)
    out = [(False, None)] * len(rows)
    for members in strata.values():
        x = np.array([vector(found[i]) for i in members])
        d = distances(x, *estimate(x)) / outliers.consistency() if len(members) >= outliers.MIN_ROWS else np.zeros(len(members))
        for i, v in zip(members, d):
            out[i] = bool(v <= outliers.CUTOFF), v
    return found, out


def compare(got, rows):
    found, out = verdicts(rows)
    want = defaultdict(list)
    for r, c, (kept, d) in zip(rows, found, out):
        want[r[0]].append((c, kept, d))
    assert len(got) == len(rows)
    for r in got:
        values = tuple(r[c] for c in [*outliers.STATISTICS, "base_failed"])
        hits = [w for w in want[r["doc_id"]] if w[0] == values]
        assert hits
        assert any(r["kept"] == kept or d is not None and abs(d / outliers.CUTOFF - 1) < 0.1 for _, kept, d in hits)


def corpus(rng):
    rows = [(i, prose(rng, rng.randrange(60, 200)), "en", "hot") for i in range(250)]
    rows += [(i, prose(rng, rng.randrange(60, 200)), "de", f"small{i % 3}") for i in range(300, 390)]
    rows += [(i, " ".join(f"{w} #$%|" for w in prose(rng, 80).split()), "en", "hot") for i in range(500, 505)]
    rows += [(510, " ".join("z" * 40 for _ in range(3)) + " " + " ".join(f"{i}{'q' * 60}" for i in range(60)), "en", "hot")]
    return rows


def test_planted_outliers_go_and_the_rest_stays(spark):
    rows = corpus(random.Random(15))
    docs = frame(spark, rows)
    counted = outliers.with_statistics(docs)
    got = outliers.Rules(counted).judge(counted).collect()
    compare(got, rows)
    gone = {r["doc_id"] for r in got if not r["kept"]}
    assert gone == {*range(500, 505), 510}


def test_odd_documents_and_clashing_names(spark):
    rng = random.Random(16)
    rows = [r if len(r) == 4 else (*r, "en", "web") for r in odd_rows(rng)] + [(1000 + i, prose(rng, 70), None, None) for i in range(70)]
    docs = with_clashes(frame(spark, rows))
    counted = outliers.with_statistics(docs)
    compare(outliers.Rules(counted).judge(counted).collect(), rows)
    stay = outliers.passing(docs)
    assert stay.columns == docs.columns
    kept = stay.collect()
    _, out = verdicts(rows)
    assert sorted(r["doc_id"] for r in kept) == sorted(r[0] for r, (k, _) in zip(rows, out) if k)
    assert {(r["n_words"], r["kept"], r["stratum"]) for r in kept} == {("own n_words", "own kept", "own stratum")}


def test_empty_and_small_tables(spark):
    assert outliers.passing(frame(spark, [])).count() == 0
    rng = random.Random(17)
    rows = [(i, prose(rng, 60)) for i in range(5)] + [(9, "# $ " * 40 + prose(rng, 60))]
    assert {r["doc_id"] for r in outliers.passing(frame(spark, rows)).collect()} == {0, 1, 2, 3, 4}
    same = frame(spark, [(i, prose(random.Random(1), 60)) for i in range(100)])
    assert outliers.passing(same).count() == 100


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang", "source").collect()]
    got = entry_points.queries()["op7_robust_outliers"](spark, folder)
    assert got.columns == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    compare(got.collect(), rows)
