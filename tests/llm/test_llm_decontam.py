"""Benchmark decontamination against a search over all windows in Python."""

import math
import random
from collections import Counter

import regex

import __spark_entry__ as entry_points
from cases import frame, odd_rows, prose, with_clashes
from chatlake.llm import decontam

MARK = decontam.NAME_MARK
NUMBER = regex.compile(r"[0-9]")


def templates(text):
    spaced = regex.sub(r"[\x20\x09-\x0D]+", " ", text or "")
    marked = regex.sub(r"(?<=[^ .!?:] )(?=\p{Lu}\p{Ll})", MARK, spaced)
    plain = regex.sub(rf"[^\p{{L}}\p{{N}} {MARK}.,/]|(?<![0-9])[.,/]|[.,/](?![0-9])", "", marked.lower())
    values, out = [], []
    for w in plain.split(" "):
        # letters behind digits are words of their own
        for k, v in enumerate(x for x in regex.split(r"(?<=[0-9])(?=\p{L})", w) if x):
            before = values[-1] if values else ""
            if NUMBER.match(v):
                out.append("<number>")
            elif v.startswith(MARK):
                out.append("<name>")
            elif k or v in decontam.UNITS and NUMBER.match(before):
                out.append("<unit>")
            else:
                out.append(v)
            values.append(v)
    return values, out


def windows(text, n):
    """Place, key and values in slots of all windows of n words."""
    values, template = templates(text)
    if n < decontam.LITERALS and len(values) != n:
        return
    for i in range(len(values) - n + 1):
        slots = [v for v, t in zip(values[i : i + n], template[i : i + n]) if v != t]
        few = n - len(slots) < decontam.LITERALS
        yield i, (n, few, tuple(values[i : i + n] if few else template[i : i + n])), slots


def classes(items):
    """Items of one form: length of windows, least id, ids, windows of the first, values of all."""
    found = {}
    for key, text in items:
        values, template = templates(text)
        if not values:
            continue
        n = min(len(values), decontam.WINDOW)
        own = list(windows(text, n))
        slots = [v for v, t in zip(values, template) if v != t]
        form = tuple(w[1] for w in own), tuple(map(slots.index, slots))
        entry = found.setdefault(form, (n, set(), own, {}))
        entry[1].add(key)
        for at, _, s in own:
            entry[3].setdefault(at, set()).add(tuple(s))
    return found.values()


def expected(docs, items):
    """(doc, least item, items, windows, found, changed) of all leaks."""
    out = set()
    for n, keys, own, values in classes(items):
        telling = sum(not w[1][1] for w in own)
        for doc, text in docs:
            here = {}
            for i, t, slots in windows(text, n):
                here.setdefault(t, []).append((i, slots))
            lines = {}
            for at, t, slots in own:
                for i, met in here.get(t, []):
                    lines.setdefault(i - at, []).append((at, list(zip(slots, met)), tuple(met) in values[at]))
            found, changed = set(), False
            for line in lines.values():
                votes = Counter(p for _, pairs, _ in line for p in pairs)
                won = {}
                for (a, b), c in votes.items():
                    won[a] = max(won.get(a, (0, False, "")), (c, a == b, b))
                for at, pairs, exact in line:
                    if exact or all(won[a][2] == b for a, b in pairs):
                        found.add(at)
                        changed |= not exact
            if found and len(found) >= min(decontam.RUN - decontam.WINDOW + 1, math.ceil((telling or len(own)) * decontam.SHARE)):
                known = [k for k in keys if k is not None]
                out.add((doc, min(known) if known else None, len(keys), len(own), len(found), changed))
    return sorted(out, key=repr)


QUESTION = "a train leaves the station of Berlin at 60 km per hour and Anna follows 3 hours later at 90 km per hour so when does Anna reach it"


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_planted_questions(spark):
    rng = random.Random(22)
    around = lambda t: f"{prose(rng, 40)} then {t} and so on {prose(rng, 40)}"
    changed = QUESTION.replace("60", "75").replace("90", "120.5").replace("Anna", "Peter").replace("Berlin", "Madrid").replace("km", "miles")
    crossed = "the first Anna follows 3 apples and takes the other 3 pears to the house of Anna near a wide river"
    items = [(1, QUESTION), (2, crossed), (3, "what is it"), (4, ""), (5, None), (6, "5 7")]
    docs = [
        (10, around(QUESTION)),
        (11, around(QUESTION.upper().lower())),
        (12, around(changed)),
        (13, around(crossed.replace("Anna follows", "Maria follows"))),
        (14, prose(rng, 200)),
        (15, around(" ".join(QUESTION.split()[:10]))),
        (16, around("so what is it")),
        (17, around("a train of 3/4 leaves nothing behind")),
        (18, around(QUESTION.replace("reach", "Clara reaches"))),
        (19, " 5, 7! "),
        (20, around("5 7")),
    ]
    got = decontam.leaks(frame(spark, docs), items_of(spark, items))
    assert got.columns == ["doc_id", "item_id", "n_items", "n_windows", "n_found", "reparameterised"]
    found = sorted(map(tuple, got.collect()), key=repr)
    assert found == expected(docs, items)
    pairs = {(r[0], r[1]): r[5] for r in found}
    assert pairs[10, 1] is False and pairs[12, 1] is True and (16, 3) in pairs
    # one value that contradicts the others costs its own windows only
    assert (13, 2) in pairs and (18, 1) in pairs
    assert not {14, 15, 17} & {d for d, _ in pairs}
    assert (19, 6) in pairs and (20, 6) not in pairs
    stay = decontam.without_leaks(with_clashes(frame(spark, docs)), items_of(spark, items))
    assert sorted(r["doc_id"] for r in stay.collect()) == [d for d, _ in docs if d not in {p[0] for p in pairs}]


def test_odd_documents_and_items(spark):
    rows = [(r[0], r[1]) for r in odd_rows(random.Random(23))]
    items = [(1, rows[-3][1]), (1, rows[-3][1]), (None, "a b c d"), (2, "same same same same same same same same same"), (3, " \n ")]
    docs = with_clashes(frame(spark, rows))
    got = decontam.leaks(docs, items_of(spark, items))
    assert {tuple(r)[:2] for r in got.collect()} == {tuple(r)[:2] for r in expected(rows, items)}
    stay = decontam.without_leaks(docs, items_of(spark, items))
    assert stay.columns == docs.columns
    for none in (frame(spark, []), docs):
        assert decontam.leaks(none, items_of(spark, [])).count() == 0
    assert decontam.without_leaks(docs, items_of(spark, [])).count() == len(rows)
    assert decontam.leaks(frame(spark, []), items_of(spark, items)).count() == 0


def test_numbers_with_units_and_fractions(spark):
    assert templates("5kg of 3/4 cup, 1,000.5 km") == (["5", "kg", "of", "3/4", "cup", "1,000.5", "km"], ["<number>", "<unit>", "of", "<number>", "cup", "<number>", "<unit>"])
    row = decontam.words(frame(spark, [(1, "5kg of 3/4 cup, 1,000.5 km in Berlin 7 Jahre")]), "doc_id", "text").first()
    assert (row["values"], row["template"]) == templates("5kg of 3/4 cup, 1,000.5 km in Berlin 7 Jahre")
    items = [(1, "wer 5kg Mehl mit 3/4 Liter Wasser mischt braucht wie viele Minuten")]
    docs = [(1, items[0][1]), (2, items[0][1].replace("5kg", "12 lb").replace("3/4", "2")), (3, items[0][1].replace("Minuten", "tage"))]
    got = {r["doc_id"]: r["reparameterised"] for r in decontam.leaks(frame(spark, docs), items_of(spark, items)).collect()}
    assert got == {1: False, 2: True, 3: False}


def test_items_of_one_template_are_one_class(spark):
    form = "how many of the {} apples are left when {} takes {} of them and gives back {} to the tree".format
    rng = random.Random(31)
    items = [(i, form(rng.randrange(10, 99), rng.choice(["Anna", "Peter"]), 5, 7)) for i in range(60)] + [(99, form(4, "Otto", 4, 4))]
    docs = [(i, f"{prose(rng, 20)} x {form(100 + i, 'Maria', 50, 70)} {prose(rng, 20)}") for i in range(20)]
    docs += [(50, f"{prose(rng, 9)} {items[3][1]}"), (51, f"{prose(rng, 9)} {form(8, 'Uwe', 8, 8)}")]
    found = sorted(map(tuple, decontam.leaks(frame(spark, docs), items_of(spark, items)).collect()), key=repr)
    assert found == expected(docs, items)
    of = {}
    for doc, item, n, *_, changed in found:
        of.setdefault(doc, {})[item] = n, changed
    assert all(of[i] == {0: (60, True)} for i in range(20))
    assert of[50][0] == (60, False) and of[51][99] == (1, True)


def test_query(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    got = entry_points.queries()["op8_template_leaks"](spark, sf_dir)
    assert sorted(map(tuple, got.collect()), key=repr) == expected(docs, items)
