"""Quality rules: base rules on counts, then robust multivariate outliers.

Every document gets counts of words, symbols and repetitions. Four transformed statistics
of the documents that pass the base rules are judged per language and source against a
minimum-covariance-determinant estimate: centre and covariance of the h documents that lie
closest together, found by concentration steps from two starts (mean and covariance of all;
medians and quartiles), of which the smaller determinant wins. Steps go on until the determinant
grows no smaller. A document is rejected if its squared Mahalanobis distance is over CUTOFF.

All work is DataFrame functions. Groups are never brought together: each step sends sums
and counted bins of distances, so a source with a third of all rows costs no more than
others. The h-subset ends with the whole bin in which the h-th distance falls, so equal
distances are treated alike. FLOORS keeps statistics that hardly vary (most documents have
no symbol at all) from making the covariance singular.

Languages and sources with fewer than MIN_ROWS documents are pooled by language, those left
over all together; a pool that is still smaller rejects nothing beyond the base rules.
Null languages and sources are values of their own. A null or empty text has no words and
fails the base rules. Equal texts of one group get equal verdicts; repeated rows count
each. An empty table gives no rows. The windows of a text are an array in its row, of some 40 bytes
a word, so a row needs memory in proportion to its text. Further columns pass through; where one is named like a
column of the result, the result's stands in its place.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatlake.llm.common import SPACE_CLASS, SPACES, staged, text_of
from chatlake.session import BROADCAST_LIMIT_BYTES, checkpointed, estimated_bytes, few, lookup

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"

MIN_ROWS = 60
# Half of the rows: an estimate that junk cannot move while it is less than the other half.
SUBSET = 0.5
# The 0.9999 quantile of chi-square with four degrees of freedom.
CUTOFF = 23.51
BINS_PER_E = 64
# Bins per unit in which quartiles are counted.
QUARTILE_BINS = 256
# A step counts as smaller from this share of the log determinant on.
SETTLED = 1e-9
AXES = ["__x0", "__x1", "__x2", "__x3"]
# Least standard deviation per statistic: log of the mean word length, log of 1 + symbols per
# 100 characters, log of 1 + repeated words per 20 words, log of 1 + repeated lines. The cutoff
# is 7.04 of these, so that in a stratum without any 3.1 symbols per 100 characters, 37 percent
# repeated words or 8 repeated lines are outliers by themselves.
FLOORS = [0.03, 0.2, 0.3, 0.3]

STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def with_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with STATISTICS and ``base_failed``.

    Windows of three words are compared by a 64-bit hash inside one text.
    """
    text = text_of(text_col)
    plain = docs.withColumns(
        {
            "__words": F.expr(f"filter(split(coalesce(`{text_col}`, ''), r'{SPACE_CLASS}+'), w -> w <> '')"),
            "__lines": F.filter(F.split(text, "\n"), lambda x: F.trim(x, F.lit(SPACES)) != ""),
            "word_chars": F.length(F.translate(text, SPACES, "")).cast("long"),
            "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
        }
    )
    windows = plain.withColumns(
        {
            "n_words": F.size("__words").cast("long"),
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
            "__sorted": F.expr(
                "array_sort(transform(slice(__words, 1, greatest(size(__words) - 2, 0)),"
                " (w, i) -> struct(xxhash64(w, get(__words, i + 1), get(__words, i + 2)) AS h, i AS i)))"
            ),
        }
    )
    repeated = windows.withColumn(
        "__again",
        F.expr("filter(__sorted, (x, j) -> coalesce(x.h = get(__sorted, j - 1).h, false) OR coalesce(x.h = get(__sorted, j + 1).h, false))"),
    )
    counted = repeated.withColumn(
        "n_repeat_words",
        F.expr("size(array_distinct(flatten(transform(__again, x -> array(x.i, x.i + 1, x.i + 2)))))").cast("long"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    # as a generator, so that a filter on the verdict is not pushed below and does not count again
    once = F.inline(F.array(F.struct(*STATISTICS, failed.alias("base_failed"))))
    made = {*STATISTICS, "base_failed"}
    return counted.select(*[f"`{c}`" for c in docs.columns if c not in made], once)


def _vector() -> dict[str, Column]:
    words, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    return {
        "__x0": F.log(chars / words),
        "__x1": F.log1p(100 * F.col("n_symbols") / chars),
        "__x2": F.log1p(20 * F.col("n_repeat_words") / words),
        "__x3": F.log1p(F.col("n_dup_lines").cast("double")),
    }


def _strata(passed: DataFrame, lang_col: str, source_col: str) -> DataFrame:
    """Language, source and the name of the stratum that estimates for them; few rows."""
    groups = passed.groupBy(F.col(lang_col).alias("__lang"), F.col(source_col).alias("__source")).agg(F.count("*").alias("n"))
    own = F.to_json(F.struct(F.lit(2).alias("k"), F.col("__lang").alias("l"), F.col("__source").alias("s")))
    groups = few(groups.withColumn("stratum", F.when(F.col("n") >= MIN_ROWS, own)))
    left = groups.where("stratum is null")
    langs = left.groupBy("__lang").agg((F.sum("n") >= MIN_ROWS).alias("enough"))
    pooled = F.to_json(F.struct(F.lit(1).alias("k"), F.col("g.__lang").alias("l")))
    small = (
        left.alias("g")
        .join(langs.alias("l"), F.expr("g.__lang <=> l.__lang"))
        .select("g.__lang", "g.__source", F.when(F.col("l.enough"), pooled).otherwise(F.lit('{"k":0}')).alias("stratum"))
    )
    return few(groups.where("stratum is not null").select("__lang", "__source", "stratum").union(small))


def _factor(mean: list[Column], product: dict[tuple[int, int], Column]) -> dict[str, Column]:
    """Centre, Cholesky factor of the covariance with floors, and log determinant."""
    p = len(AXES)
    out = {f"m{i}": mean[i] for i in range(p)}
    return out | {f"s{i}{j}": product[i, j] - mean[i] * mean[j] + (FLOORS[i] ** 2 if i == j else 0.0) for i in range(p) for j in range(i + 1)}


def _with_cholesky(params: DataFrame) -> DataFrame:
    p = len(AXES)
    for i in range(p):
        for j in range(i + 1):
            value = F.col(f"s{i}{j}")
            for k in range(j):
                value = value - F.col(f"c{i}{k}") * F.col(f"c{j}{k}")
            value = F.sqrt(F.greatest(value, F.lit(FLOORS[i] ** 2 * 1e-3))) if i == j else value / F.col(f"c{j}{j}")
            params = params.withColumn(f"c{i}{j}", value)
    log_det = F.lit(0.0)
    for i in range(p):
        log_det = log_det + 2 * F.log(F.col(f"c{i}{i}"))
    return params.withColumn("log_det", log_det)


def _distance() -> Column:
    """Squared Mahalanobis distance by forward substitution."""
    z: list[Column] = []
    for i, axis in enumerate(AXES):
        value = F.col(axis) - F.col(f"m{i}")
        for j in range(i):
            value = value - F.col(f"c{i}{j}") * z[j]
        z.append(value / F.col(f"c{i}{i}"))
    total = z[0] * z[0]
    for v in z[1:]:
        total = total + v * v
    return total


def _estimates(rows: DataFrame) -> DataFrame:
    """Moments of ``rows`` per (stratum, start), as centre and factor."""
    p = len(AXES)
    sums = [F.avg(a).alias(f"a{i}") for i, a in enumerate(AXES)]
    sums += [F.avg(F.col(AXES[i]) * F.col(AXES[j])).alias(f"p{i}{j}") for i in range(p) for j in range(i + 1)]
    moments = rows.groupBy("stratum", "start").agg(*sums)
    columns = _factor([F.col(f"a{i}") for i in range(p)], {(i, j): F.col(f"p{i}{j}") for i in range(p) for j in range(i + 1)})
    return _with_cholesky(moments.select("stratum", "start", *[c.alias(n) for n, c in columns.items()]))


def _quartile_start(rows: DataFrame) -> DataFrame:
    """Centre and factor from quartiles, read off counted bins, so that they do not depend on how rows are divided."""
    bins = [F.struct(F.lit(i).alias("axis"), F.floor(F.col(a) * QUARTILE_BINS).alias("bin")) for i, a in enumerate(AXES)]
    counts = rows.select("stratum", F.explode(F.array(*bins)).alias("b")).groupBy("stratum", "b.axis", "b.bin").agg(F.count("*").alias("n"))
    whole = Window.partitionBy("stratum", "axis")
    upto = counts.withColumns({"upto": F.sum("n").over(whole.orderBy("bin")), "all": F.sum("n").over(whole)})
    middle = (F.col("bin") + 0.5) / QUARTILE_BINS
    quartile = {(i, k): F.min(F.when((F.col("axis") == i) & (F.col("upto") >= F.ceil(F.col("all") * k / 4)), middle)).alias(f"q{i}{k}") for i in range(len(AXES)) for k in (1, 2, 3)}
    found = upto.groupBy("stratum").agg(*quartile.values())
    columns = {f"m{i}": F.col(f"q{i}2") for i in range(len(AXES))}
    for i in range(len(AXES)):
        for j in range(i + 1):
            spread = (F.col(f"q{i}3") - F.col(f"q{i}1")) / 1.349
            columns[f"s{i}{j}"] = spread * spread + FLOORS[i] ** 2 if i == j else F.lit(0.0)
    return _with_cholesky(found.select("stratum", F.lit(1).alias("start"), *[c.alias(n) for n, c in columns.items()]))


def _chi2_even(x: float, dims: int) -> float:
    term = total = 1.0
    for k in range(1, dims // 2):
        term *= x / 2 / k
        total += term
    return 1 - math.exp(-x / 2) * total


def consistency() -> float:
    """Factor that makes the covariance of the inner SUBSET that of a normal law."""
    p, low, high = len(AXES), 0.0, 200.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if _chi2_even(mid, p) < SUBSET else (low, mid)
    return SUBSET / _chi2_even(low, p + 2)


def fit(rows: DataFrame) -> DataFrame:
    """Best estimate per stratum from ``rows`` (``stratum`` and AXES); few rows result."""
    total = rows.groupBy("stratum").agg(F.count("*").alias("rows"))
    total = few(total.where(F.col("rows") >= MIN_ROWS))
    starts = _estimates(rows.withColumn("start", F.lit(0))).unionByName(_quartile_start(rows)).join(total, "stratum")
    params = few(starts.withColumn("moving", F.lit(True)))
    keys = ["stratum", "start"]
    values = [c for c in params.columns if c not in (*keys, "rows", "moving")]
    # all frames joined below are as many rows or fewer, and as wide
    hint = F.broadcast if estimated_bytes(params) <= BROADCAST_LIMIT_BYTES else lambda frame: frame
    first = moving = not params.isEmpty()
    while moving:
        near = rows.join(hint(params.where("moving")), "stratum").withColumn("bin", F.floor(F.log(_distance() + 1e-9) * BINS_PER_E))
        counts = near.groupBy(*keys, "rows", "bin").agg(F.count("*").alias("n"))
        along = Window.partitionBy(*keys).orderBy("bin")
        reached = counts.withColumn("upto", F.sum("n").over(along)).where(F.col("upto") >= F.ceil(F.col("rows") * SUBSET))
        edge = few(reached.groupBy(*keys).agg(F.min("bin").alias("edge")))
        inner = near.join(hint(edge), keys).where("bin <= edge")
        new = _estimates(inner.select(*keys, *AXES)).select(*keys, F.struct(*values).alias("new"))
        least = F.col("log_det") - SETTLED * F.greatest(F.lit(1.0), F.abs("log_det"))
        # the starts are no estimates of a subset, so the first step always counts
        taken = F.lit(True) if first else F.col("new.log_det") < least
        taken = F.coalesce(F.col("moving") & F.col("new").isNotNull() & taken, F.lit(False))
        joined = params.join(hint(new), keys, "left").withColumn("taken", taken)
        kept = [F.when(F.col("taken"), F.col(f"new.{c}")).otherwise(F.col(c)).alias(c) for c in values]
        params = few(joined.select(*keys, "rows", *kept, F.col("taken").alias("moving")))
        first, moving = False, params.agg(F.max("moving")).first()[0]
    best = params.groupBy("stratum").agg(F.min_by(F.struct("*"), F.struct("log_det", "start")).alias("b"))
    return few(best.select("b.*").drop("start", "rows", "moving"))


class Rules:
    """Estimates of one table, and verdicts by them."""

    def __init__(self, counted: DataFrame, lang_col: str = "lang", source_col: str = "source"):
        """``counted`` has STATISTICS and ``base_failed``."""
        self.lang_col, self.source_col = lang_col, source_col
        passed = counted.where("not base_failed")
        self.strata = _strata(passed, lang_col, source_col)
        rows = self._placed(passed).withColumns(_vector()).select("stratum", *AXES)
        self.params = fit(checkpointed(rows))

    def _placed(self, counted: DataFrame) -> DataFrame:
        lang, source = counted[self.lang_col], counted[self.source_col]
        known = lookup(self.strata)
        own = counted.columns
        joined = counted.join(known, lang.eqNullSafe(known["__lang"]) & source.eqNullSafe(known["__source"]), "left")
        return joined.select(*[counted[f"`{c}`"] for c in own if c != "stratum"], known["stratum"])

    def judge(self, counted: DataFrame) -> DataFrame:
        """``counted`` with ``kept``."""
        placed = self._placed(counted).withColumns(_vector()).join(lookup(self.params), "stratum", "left")
        outlier = F.coalesce(_distance() / consistency() > CUTOFF, F.lit(False))
        own = [f"`{c}`" for c in counted.columns if c not in ("kept", "stratum")]
        return placed.withColumn("kept", ~F.col("base_failed") & ~outlier).select(*own, "kept")


def passing(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns. The counts are written beside the
    rows, so texts are read once and not shuffled; the estimates read only the counts."""
    packed = docs.select("lang", "source", F.col(text_col).alias("text"), F.struct("*").alias("__document"))
    counted = staged(with_statistics(packed).drop("text"), "counted")
    return Rules(counted.drop("__document")).judge(counted).where("kept").select("__document.*")
