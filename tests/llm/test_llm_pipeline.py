"""The pipeline's stages alone, on odd documents, and together against brute force."""

import random
import shutil

import corpus_pipeline
import pytest
from cases import WORD, frame, odd_rows, prose, with_clashes
from test_llm_bpe import PATH, reference  # noqa: F401
from test_llm_bpe import expected as encoded
from test_llm_decontam import expected as leaks
from test_llm_outliers import verdicts
from test_llm_rlz import masks
from test_llm_simhash import classes, fingerprint

SF_DIR = "/root/testdata/sf0.001"


def cut(text, gone):
    """Kept words with the white space between them, one blank where words went."""
    spans = [m.span() for m in WORD.finditer(text)]
    if not any(gone):
        return text
    out = ""
    for i, ((a, b), g) in enumerate(zip(spans, gone)):
        if not g:
            before = text[spans[i - 1][1] : a] if i and not gone[i - 1] else " " if out else ""
            out += before + text[a:b]
    return out


def brute(rows, items):
    rows = [r for r, (kept, _) in zip(rows, verdicts(rows)[1]) if kept]
    prints = [fingerprint(r[1], 3) for r in rows]
    of = classes(prints)
    least = {}
    for r, p in zip(rows, prints):
        least[of[p]] = min(r[0], least.get(of[p], r[0]))
    rows = [r for r, p in zip(rows, prints) if least[of[p]] == r[0]]
    split, gone = masks(rows)
    rows = [(r[0], cut(r[1], g), *r[2:]) for r, own, g in zip(rows, split, gone) if not (own and all(g))]
    leaking = {d for d, *_ in leaks([(r[0], r[1]) for r in rows], items)}
    return [r for r in rows if r[0] not in leaking]


def test_run_is_the_brute_force_of_all_stages(spark, reference):  # noqa: F811
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "lang", "source").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    got = corpus_pipeline.run(spark, SF_DIR)
    left = brute(docs, items)
    assert 0 < len(left) < len(docs)
    assert sorted(map(tuple, got.collect()), key=repr) == encoded([(r[0], r[1]) for r in left], reference)


def test_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "near duplicates", "substring dedup", "benchmark decontamination", "byte-level BPE"]
    assert corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES, ids=[n for n, _ in corpus_pipeline.STAGES])
def test_each_stage_takes_odd_documents(spark, name, stage):
    rng = random.Random(28)
    rows = odd_rows(rng) + [(1000 + i, prose(rng, 70, 5000), None, None) for i in range(70)]
    docs = with_clashes(frame(spark, rows))
    out = stage(spark, docs, SF_DIR)
    kept = out.collect()
    if stage is not corpus_pipeline.token_ids:
        assert out.columns == docs.columns
        assert {r["kept"] for r in kept} == {"own kept"}
    assert {1000 + i for i in range(70)} <= {r["doc_id"] for r in kept}
    assert stage(spark, frame(spark, []), SF_DIR).count() == 0


def test_run_on_an_empty_table(spark, tmp_path):
    frame(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    shutil.copy(f"{SF_DIR}/benchmark.parquet", f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
