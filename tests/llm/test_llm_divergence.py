"""The source audit against its SQL and against plain arithmetic on small tables."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import pyarrow as pa
import pytest

import __spark_entry__ as entry_points
from cases import frame, odd_rows, prose, with_clashes
from chatlake.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
COLUMNS = ["lang", "source", "part", "item", "value", "rank"]


def terms_of(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def expected(rows, top=200):
    counts, seen, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source in rows:
        key = lang or "", source or ""
        groups.add(key)
        own = terms_of(text)
        counts[key].update(own)
        seen[key[0]].update(set(own))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in seen[lang].items() if n >= 3]
        names = sorted(s for g, s in groups if g == lang)
        count = {s: {t: counts[lang, s][t] for t in kept} for s in names}
        count[None] = {t: sum(count[s][t] for s in names) for t in kept}
        p = {s: {t: 1 + 10**9 * (c + 1) // (sum(own.values()) + len(kept)) for t, c in own.items()} for s, own in count.items()}
        for s in names:
            pairs = [(-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o.encode(), o) for o in names if o != s]
            terms = [(-((p[s][t] - p[None][t]) ** 2 // p[None][t]), t.encode(), t) for t in kept if count[s][t] > 0 and p[s][t] > p[None][t]]
            out += [(lang, s, "pair", item, -v, i) for i, (v, _, item) in enumerate(sorted(pairs), 1)]
            out += [(lang, s, "term", item, -v, i) for i, (v, _, item) in enumerate(sorted(terms)[:top], 1)]
    return sorted(out)


def results(frame):
    assert frame.columns == COLUMNS
    return sorted(map(tuple, frame.collect()))


def sample(rng):
    rows = []
    for i in range(300):
        lang = rng.choice(["en", "en", "fr", None])
        source = "hot" if rng.random() < 0.4 else rng.choice(["a", "b", "Ä", "", None, "only" if lang == "fr" else "c"])
        rows.append((i, prose(rng, rng.randrange(0, 60), 60), lang, source))
    copied = rows[7][1]
    rows += [(400 + i, copied, rng.choice(["en", "fr"]), rng.choice(["a", "hot", None])) for i in range(80)]
    rows += [(500, "Été ÉTÉ été x1y2z İstanbul don't 中文", "fr", "a")] * 4
    rows += [(600, "one two three", "xx", "s"), (601, None, "xx", "t"), (602, "", "yy", None), (None, None, None, None)]
    return rows


def test_audit_is_plain_arithmetic(spark):
    rows = sample(random.Random(41))
    docs = with_clashes(frame(spark, rows))
    report = divergence.Audit(docs).report(top_terms=10)
    assert results(report) == expected(rows, 10)


@pytest.mark.parametrize("limits", [(1 << 22, 1 << 20, 1 << 20), (16, 5, 40)])
def test_counts_in_small_steps(monkeypatch, limits):
    """Pieces of texts, blocks of terms and rows sent early change nothing."""
    for name, limit in zip(("PIECE_BYTES", "COUNT_AT_ONCE", "HELD_ENTRIES"), limits):
        monkeypatch.setattr(divergence, name, limit)
    rng = random.Random(44)
    texts = [(rng.choice(["en", "fr"]), prose(rng, rng.randrange(40), 30), {g: rng.randrange(1, 5) for g in rng.sample(range(6), rng.randrange(1, 4))}) for _ in range(60)]
    kind = pa.list_(pa.struct([("group", pa.int64()), ("n", pa.int64())]))
    by = [[{"group": g, "n": n} for g, n in own.items()] for *_, own in texts]
    batch = pa.RecordBatch.from_arrays([pa.array([t[0] for t in texts]), pa.array([t[1] for t in texts]), pa.array(by, kind)], ["lang", "text", "by"])
    counted = pa.Table.from_batches(list(divergence._count(iter([batch.slice(0, 7), batch.slice(7)]))))
    counted = counted.sort_by([("lang", "ascending"), ("term", "ascending")]).combine_chunks()
    merged = pa.Table.from_batches(list(divergence._merged(iter(counted.to_batches(max_chunksize=3)), 5)))
    got = {(r["lang"], r["term"]): (r["docs"], {x["group"]: x["n"] for x in r["by"]}) for r in merged.to_pylist()}
    docs, words = Counter(), defaultdict(Counter)
    for lang, text, own in texts:
        for term, n in Counter(terms_of(text)).items():
            docs[lang, term] += sum(own.values())
            for g, times in own.items():
                words[lang, term][g] += n * times
    assert got == {k: (n, dict(words[k])) for k, n in docs.items() if n >= 5}
    assert merged.num_rows == len(got)


def test_sums_over_common_terms_in_small_steps(monkeypatch):
    """Blocks of pairs and of held sums change nothing."""
    rng = random.Random(42)
    lists = [[{"group": g, "p": rng.randrange(1, 10**9), "p0": 10 + g} for g in rng.sample(range(9), rng.randrange(0, 9))] for _ in range(50)]
    kind = pa.list_(pa.struct([("group", pa.int64()), ("p", pa.int64()), ("p0", pa.int64())]))
    batch = pa.RecordBatch.from_arrays([pa.array(lists, kind)], ["by"])
    want = Counter()
    for own in lists:
        for x in own:
            for y in own:
                if x["group"] != y["group"]:
                    f = lambda p, q: (p - q) ** 2 // q
                    want[x["group"], y["group"]] += f(x["p"], y["p"]) - f(x["p"], y["p0"]) - f(x["p0"], y["p"]) + f(x["p0"], y["p0"])
    for at_once, held in ((1 << 20, 1 << 20), (5, 20)):
        monkeypatch.setattr(divergence, "PAIRS_AT_ONCE", at_once)
        monkeypatch.setattr(divergence, "HELD_ENTRIES", held)
        got = Counter()
        for part in divergence._common(iter([batch.slice(0, 20), batch.slice(20)])):
            for one, other, value in zip(*(c.to_pylist() for c in part.columns)):
                got[one, other] += value
        assert got == want


def test_odd_documents(spark):
    rows = [(*r, "en", "web") if len(r) == 2 else r for r in odd_rows(random.Random(43))]
    docs = with_clashes(frame(spark, rows))
    assert results(divergence.Audit(docs).report()) == expected(rows)
    assert divergence.Audit(frame(spark, [])).report().count() == 0


def test_shares_are_exact_for_great_counts(spark):
    for n in (0, 5, divergence._SMALL - 1, divergence._SMALL, divergence._SMALL + 1, 10**15 + 7):
        row = spark.range(1).select(divergence.share(divergence.F.lit(n), divergence.F.lit(3 * n), divergence.F.lit(11)).alias("p")).first()
        assert row["p"] == 1 + 10**9 * (n + 1) // (3 * n + 11)


def test_query_is_its_sql(spark, sf_dir):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS FROM '{sf_dir}/documents.parquet'")
    want = db.execute(f"SELECT {', '.join(COLUMNS)} FROM ({entry_points.oracle_sql()['op11_source_divergence']})").fetchall()
    assert results(entry_points.queries()["op11_source_divergence"](spark, sf_dir)) == sorted(want)
