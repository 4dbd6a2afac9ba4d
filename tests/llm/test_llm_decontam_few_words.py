"""Items without plain words are found by their real values."""

import random

from cases import frame, prose
from chatlake.llm import decontam
from test_llm_decontam import items_of


def test_number_rows_and_names(spark):
    rng = random.Random(61)
    row = "3 1 4 1 5 9 2 6 5 3 5 8 9 7 9 3"
    names = "x Anna Peter Maria Lukas Berta Hugo Clara Otto Emma Franz"
    items = [(1, row), (2, names), (None, "7 8 9 11")]
    around = lambda t: f"{prose(rng, 40)} then {t} and so on {prose(rng, 40)}"
    docs = [(10, around(row)), (11, around(row.replace("9", "8").replace("5", "6"))), (12, around(names[2:])), (13, around("7 8 9 11"))]
    docs += [(14, around("7 8 9 12")), (15, " ".join(str(rng.randrange(10)) for _ in range(300)))]
    got = {(r[0], r[1], r[5]) for r in decontam.leaks(frame(spark, docs), items_of(spark, items)).collect()}
    assert got == {(10, 1, False), (12, 2, False), (13, None, False)}
