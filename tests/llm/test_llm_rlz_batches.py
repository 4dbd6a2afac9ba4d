"""Texts reach Python in batches of bounded bytes, with all windows and the session as it was."""

import random

import pytest

from cases import frame, prose
from chatlake.llm import rlz
from test_llm_rlz import expected

KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded(work):
    def inner(batches):
        def held():
            for batch in batches:
                assert batch.nbytes < 4 << 20, f"a batch of {batch.nbytes} bytes"
                yield batch

        return work(held())

    return inner


@pytest.mark.parametrize("own", [None, "50000000"])
def test_texts_go_to_python_in_small_batches(spark, monkeypatch, own):
    rng = random.Random(33)
    passage = prose(rng, 40, 5000)
    rows = [(i, f"{prose(rng, 9_000, 5000)} {passage} end{i}") for i in range(120)]
    for name in ("_emit_anchors", "_emit_windows", "_parse"):
        monkeypatch.setattr(rlz, name, bounded(getattr(rlz, name)))
    if own:
        spark.conf.set(KEY, own)
    try:
        got = rlz.removal(frame(spark, rows).coalesce(1)).collect()
        assert spark.conf.get(KEY, None) == own
    finally:
        spark.conf.unset(KEY)
    assert sorted([tuple(r)[:4] for r in got], key=repr) == expected(rows)
