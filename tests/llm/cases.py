"""Documents that operators must survive, and small brute-force helpers."""

import re
import zlib

from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")
# Names that operators use for their own or their result's columns.
CLASHING = ["shard", "slot", "kept", "n_words", "base_failed", "stratum", "component_id", "fp", "copy", "found", "id", "h", "score", "row", "bin", "item_id"]

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


def frame(spark, rows):
    """(doc_id, text) or (doc_id, text, lang, source) as documents."""
    full = [(r[0], r[1], *(r[2:] or ("en", "web")), len(r[1]) if r[1] is not None else None) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def with_clashes(docs):
    return docs.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHING if c not in docs.columns])


def words(text):
    return WORD.findall(text or "")


def remainder(doc_id, modulus):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % modulus


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" if rng.random() < 0.9 else f"W{rng.randrange(vocabulary)}," for _ in range(n))


ODD_TEXTS = [
    None,
    "",
    " \t\n\x0b\x0c\r ",
    "x",
    "one two",
    "a b  c \u0085d café İstanbul 中文 \U0001f600",
    "it's they'll we've I'd you're 'tis ''s   \n\n  x  ",
    "same same same same same same same same same same same same same same same same",
]


def odd_rows(rng):
    """Nulls in every column, empty, blank and very long texts, repeated rows and ids."""
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS)]
    rows += [(None, None, None, None), (None, "no id here", "en", None), (100, "a b c d", None, "web")]
    rows += [(101, prose(rng, 60)), (101, rows[-1][1])] * 2
    text = prose(rng, 80)
    rows += [(i, text) for i in range(200, 230)]
    rows += [(300, prose(rng, 30_000)), (301, "y" * 100_000)]
    return rows
