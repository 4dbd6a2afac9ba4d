"""Every statistic alone can reject, and a third of junk in a stratum does not hide itself."""

import random

import pytest
from cases import frame, prose
from chatlake.llm import outliers
from test_llm_outliers import verdicts


def plain(rng, n=100):
    return prose(rng, n, 100_000)


def repeated(rng):
    """45 percent of the words in runs that stand twice."""
    run = plain(rng, 22)
    return f"{run} {plain(rng, 56)} {run}"


def lined(rng):
    """Twelve lines that stand twice, of two words, so that no three-word run need be the same."""
    lines = [plain(rng, 2) for _ in range(12)]
    return "\n".join(x for line in lines for x in (line, plain(rng, 3), line, plain(rng, 3)))


def symbols(rng):
    return " ".join(f"{w}{'#' if i % 2 else ''}" for i, w in enumerate(plain(rng).split()))


@pytest.mark.parametrize("odd", [repeated, lined, symbols])
def test_one_axis_rejects(odd):
    rng = random.Random(41)
    rows = [(i, plain(rng), "en", "web") for i in range(200)] + [(900 + i, odd(rng), "en", "web") for i in range(5)]
    counted, out = verdicts(rows)
    assert not any(c[5] for c in counted)
    assert {r[0] for r, (kept, _) in zip(rows, out) if not kept} == set(range(900, 905))


def test_a_third_of_junk_in_a_stratum(spark):
    rng = random.Random(42)
    rows = [(i, plain(rng)) for i in range(120)] + [(900 + i, (repeated, lined, symbols)[i % 3](rng)) for i in range(60)]
    assert {r["doc_id"] for r in outliers.passing(frame(spark, rows)).collect()} == set(range(120))
