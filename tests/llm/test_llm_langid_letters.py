"""Languages of many letters, and samples where long documents hold most characters."""

import random

from cases import frame
from chatlake.llm import langid
from pyspark.sql import functions as F
from test_llm_langid import phrases


def text_in(rng, letters, n):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randrange(2, 6))) for _ in range(n))


LETTERS = {
    "el": "".join(map(chr, range(0x3B1, 0x3C2))),
    "en": "abcdefghijklmnopqrstuvwxyz",
    "ru": "".join(map(chr, range(0x430, 0x450))),
    "zh": "".join(map(chr, range(0x4E00, 0x4E00 + 600))),
}


def test_every_letter_of_the_samples_is_told_apart(monkeypatch):
    rng = random.Random(51)
    samples = {k: text_in(rng, v, 400) for k, v in LETTERS.items()}
    texts = [text_in(rng, v, 30) for v in LETTERS.values()] + [samples["zh"][:300], samples["el"][50:200] + " \u0e01 x"]
    want = [[phrases(samples[k], t) for k in sorted(samples)] for t in texts]
    for entries in (langid.TABLE_ENTRIES, 1):
        monkeypatch.setattr(langid, "TABLE_ENTRIES", entries)
        model = langid.Model(samples)
        assert model.phrases(texts, model.symbols())[0].tolist() == want
        assert model.predict(texts, model.symbols())[0] == ["el", "en", "ru", "zh", "zh", "el"]


def test_long_documents_do_not_hide_a_language(spark):
    rng = random.Random(52)
    long = text_in(rng, LETTERS["en"], 20_000)
    rows = [(i, long, "en", "s") for i in range(400)] + [(1000 + i, text_in(rng, LETTERS["en"], 25), "en", "s") for i in range(20)]
    rows += [(2000, "12345 " * 10_000 + text_in(rng, LETTERS["ru"], 15_000), "ru", "s"), (2001, "77 88", "ru", "s")]
    model = langid.learn(frame(spark, rows), F.lit(True))
    assert model.names == ["en", "ru"]
    assert min(model.bits) > 15
    few = langid.SAMPLE_CHARS // 18
    many = [(3000 + i, text_in(rng, LETTERS["en"], 1_000), f"x{i:02}", "s") for i in range(18)]
    learned = langid.learn(frame(spark, many), F.lit(True))
    assert len(learned.names) == 18 and min(2**b for b in learned.bits) > few
