"""Windows are rows made by compiled code, with the places and slots of a search in Python."""

import random

from cases import frame, prose
from chatlake.llm import decontam
from test_llm_decontam import QUESTION, windows


def test_windows_of_several_lengths(spark):
    rng = random.Random(71)
    rows = [(1, QUESTION), (2, "5 7"), (3, "one two"), (4, ""), (5, None), (6, "Anna met Peter 12 times in 3 days, 5kg of 3/4 cup")]
    rows += [(i, prose(rng, rng.randrange(30)) + f" to Berlin {i} km") for i in range(10, 30)]
    found = decontam.windows(decontam.words(frame(spark, rows), "doc_id", "text"), [8, 2, 5])
    got = [(r["id"], r["at"], tuple(r["slots"]), r["h"]) for r in found.collect()]
    want = [(key, i, tuple(slots), t) for key, text in rows for n in (8, 2, 5) for i, t, slots in windows(text, n)]
    assert sorted(r[:3] for r in got) == sorted(r[:3] for r in want)
    # equal hashes for equal windows only
    assert len({r[3] for r in got}) == len({r[3] for r in want})


def test_windows_have_no_lambdas(spark):
    words = spark.createDataFrame([], "id long, values array<string>, template array<string>")
    plan = decontam.windows(words, [8])._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan and "explode" in plan
