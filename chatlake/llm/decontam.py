"""Benchmark decontamination by templates.

Words are taken to lower case and lose their punctuation; numbers, units behind a number
and names (capitalised words inside a sentence) become typed placeholders. Windows of
WINDOW template words are joined by hash with those of the benchmark items, so a question
whose numbers or names were exchanged still matches. Matches of one document and item are
then lined up by the distance of their places, and slots are checked along a line: a value of the
item stands for the value that it meets most often there. A window with another value does
not count, unless an item has its values word for word; the other windows of the line do.
A document leaks an item if its lines hold half of the item's telling windows, or as many
windows as RUN words have.

Items with the same template, and with equal values in the same places, are one class and reported
once, under the least id, so a template shared by many items costs a document one row.

All work is DataFrame functions. Document windows are joined with a broadcast benchmark if
that is measured to be small, else by a shuffle. A window with fewer than LITERALS plain
words is too general as a template and is compared by its real values; windows with more are
telling. An item shorter than a window is one window, and one shorter than LITERALS words
leaks only as the whole of a text. Templates are compared by a 64-bit hash.

A number is a word that begins with a digit, fractions and decimals included. A unit is what letters
stand directly behind its digits, or a word of UNITS behind it: signs that are the same everywhere,
and names in some languages, to which a caller may add.

Null and empty texts have no words: such documents leak nothing and such items are in no
document. Repeated documents are reported once per id, repeated items once; a null id of a
document or item is an id like any other. An empty table gives no rows. Other columns are not
read. The words of a text are arrays in its row, so a row needs memory in proportion to its
text; its windows are rows, made from their places one after the other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatlake.session import checkpointed, gathered, lookup

WINDOW = 8
LITERALS = 3
RUN = 13
SHARE = 0.5

NAME_MARK, AFTER_MARK = "\ue000", "\ue001"
# Signs of units, then their names in English, German, French and Spanish.
UNITS = (
    "nm mm cm dm m km in ft yd mi mg g kg t lb lbs oz ml cl dl l s ms sec min h hr hrs d hz khz mhz ghz w kw mw kwh j kj kcal cal v a k c f "
    "pa kpa bar b kb mb gb tb usd eur gbp chf jpy "
    "inch inches feet foot yard yards mile miles meter meters metre metres gram grams kilograms pound pounds ounces liter liters litre litres "
    "second seconds minute minutes hour hours day days week weeks month months year years percent degrees dollar dollars euro euros cent cents "
    "zoll meile meilen gramm kilogramm pfund unze unzen sekunde sekunden minuten stunde stunden tag tage tagen woche wochen monat monate monaten "
    "jahr jahre jahren prozent grad "
    "pouce pouces pied pieds lieue lieues gramme grammes kilogramme kilogrammes livre livres once onces seconde secondes heure heures jour jours "
    "semaine semaines mois an ans pourcent degré degrés "
    "pulgada pulgadas pie pies milla millas metro metros gramo gramos kilo kilos libra libras onza onzas litro litros segundo segundos minuto "
    "minutos hora horas día días semana semanas mes meses año años grado grados dólar dólares"
).split()


def words(table: DataFrame, id_col: str, text_col: str, units: list[str] = UNITS) -> DataFrame:
    """``id``, ``values`` (plain words; names carry a mark) and ``template`` (with placeholders)."""
    spaced = F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), r"[\x20\x09-\x0D]+", " ")
    marked = F.regexp_replace(spaced, r"(?<=[^ .!?:] )(?=\p{Lu}\p{Ll})", NAME_MARK)
    plain = F.regexp_replace(F.lower(marked), rf"[^\p{{L}}\p{{N}} {NAME_MARK}.,/]|(?<![0-9])[.,/]|[.,/](?![0-9])", "")
    # letters behind digits become a word of their own, with a mark that tells them from others
    apart = F.regexp_replace(plain, r"(?<=[0-9])(?=\p{L})", f" {AFTER_MARK}")
    split = table.select(F.col(id_col).alias("id"), F.filter(F.split(apart, " "), lambda w: w != "").alias("values"))
    known = ", ".join(f"'{u}'" for u in units)
    return split.withColumn(
        "template",
        F.expr(
            f"""transform(values, (v, i) -> CASE
                WHEN v >= '0' AND v < ':' THEN '<number>'
                WHEN v >= '{NAME_MARK}' AND v < '{AFTER_MARK}' THEN '<name>'
                WHEN startswith(v, '{AFTER_MARK}') THEN '<unit>'
                WHEN v IN ({known}) AND coalesce(get(values, i - 1) >= '0' AND get(values, i - 1) < ':', false) THEN '<unit>'
                ELSE v END)"""
        ),
    ).withColumn("values", F.expr(f"transform(values, v -> ltrim('{AFTER_MARK}', v))"))


def windows(found: DataFrame, lengths: list[int]) -> DataFrame:
    """``id``, ``at``, ``h`` (hash of the template, of the values where fewer than LITERALS words
    are plain) and ``slots`` (values behind its placeholders)."""
    out = None
    for n in lengths:
        # shorter than LITERALS words, only a whole text counts
        fits = F.size("values") >= n if n >= LITERALS else F.size("values") == n
        placed = found.select("id", "values", "template", F.explode(F.when(fits, F.sequence(F.lit(0), F.size("values") - n))).alias("at"))
        places, plain = ([F.get(a, F.col("at") + k) for k in range(n)] for a in ("template", "values"))
        # without lambdas, so that a window costs compiled code only, and its slots only if it is matched
        n_slots = sum((F.when(t != v, 1).otherwise(0) for t, v in zip(places, plain)), F.lit(0))
        part = placed.select(
            "id",
            "at",
            F.when(F.lit(n) - n_slots < LITERALS, F.xxhash64(F.lit(-n), *plain)).otherwise(F.xxhash64(F.lit(n), *places)).alias("h"),
            F.array_remove(F.array(*(F.when(t != v, v).otherwise("") for t, v in zip(places, plain))), "").alias("slots"),
        )
        out = part if out is None else out.union(part)
    return out


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Windows of the classes of items, with ``class``, ``item`` (the least id), ``n_items``, ``n`` (telling
    windows, or all if there is none), ``n_windows`` (all), ``length``; and for all items the
    hashes ``own`` of the values that a window (``class``, ``item_at``) has."""
    found = checkpointed(words(items, id_col, text_col).where(F.size("values") > 0).withColumn("row", F.monotonically_increasing_id()))
    short = [r[0] for r in found.where(F.size("values") < WINDOW).select(F.size("values")).distinct().collect()]
    every = None
    for n in [WINDOW, *sorted(short)]:
        of_length = F.size("values") >= WINDOW if n == WINDOW else F.size("values") == n
        part = windows(found.where(of_length).select(F.col("row").alias("id"), "values", "template"), [n]).withColumn("length", F.lit(n))
        every = part if every is None else every.union(part)
    every = checkpointed(every.withColumnRenamed("id", "row"))
    total = every.count()
    # equal values in the same places: the place where each value of a slot comes first
    slots = F.expr("filter(values, (v, i) -> get(template, i) <> v)")
    pattern = F.transform(slots, lambda v: F.array_position(slots, v))
    forms = every.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("at", "h"))).alias("form"))
    named = found.select("row", "id", pattern.alias("pattern")).join(forms, "row")
    named = gathered(named.select("row", "id", F.xxhash64("form", "pattern").alias("class"), F.xxhash64(F.lit(1), "pattern", "form").alias("check")), total)
    classes = named.groupBy("class", "check").agg(F.min("row").alias("row"), F.min("id").alias("item"), F.count_distinct(F.struct("id")).alias("n_items"))
    few = F.col("length") - F.size("slots") < LITERALS
    sizes = every.groupBy("row").agg(F.count_if(~few).alias("telling"), F.count("*").alias("n_windows"))
    sizes = sizes.withColumn("n", F.when(F.col("telling") > 0, F.col("telling")).otherwise(F.col("n_windows")))
    first = classes.join(sizes, "row").join(every, "row")
    known = gathered(first.select(F.col("row").alias("class"), "item", "n_items", "n", "n_windows", F.col("at").alias("item_at"), "h", F.col("slots").alias("item_slots"), "length"), total)
    members = named.select("row", "class", "check").join(classes.select("class", "check", F.col("row").alias("of")), ["class", "check"])
    values = every.join(members, "row").select(F.col("of").alias("class"), F.col("at").alias("item_at"), F.xxhash64("slots").alias("own")).distinct()
    return known, gathered(values, total)


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document and class of items it leaks: ``id_col``, ``item_id`` (the least of the class),
    ``n_items`` (ids in the class), ``n_windows`` (of an item), ``n_found`` and ``reparameterised`` (whether
    some window has values that no item of the class has there)."""
    known, values = item_windows(items)
    lengths = sorted({WINDOW, *[r[0] for r in known.select("length").distinct().collect()]})
    small = lookup(known.select("class", "item_at", "h", "item_slots"))
    matched = windows(words(docs, id_col, text_col), lengths).join(small, "h")
    same = lookup(values.withColumn("exact", F.lit(True)))
    matched = matched.withColumn("own", F.xxhash64("slots")).join(same, ["class", "item_at", "own"], "left")
    window = F.struct("item_at", F.arrays_zip("item_slots", "slots").alias("pairs"), F.coalesce("exact", F.lit(False)).alias("exact"))
    lines = matched.groupBy("id", "class", (F.col("at") - F.col("item_at")).alias("line")).agg(F.collect_set(window).alias("met"))
    # of the values that an item's value meets on a line, the one met most often counts
    lines = lines.withColumn("pairs", F.flatten(F.col("met.pairs"))).withColumn("kinds", F.array_distinct("pairs"))
    votes = """transform(kinds, p -> struct(p.item_slots AS item_slots, size(filter(pairs, q -> q = p)) AS n, p.item_slots = p.slots AS same, p.slots AS slots))"""
    lines = lines.withColumn("votes", F.expr(votes))
    won = """filter(votes, v -> v = array_max(filter(votes, w -> w.item_slots = v.item_slots)))"""
    lines = lines.withColumn("won", F.expr(f"transform({won}, v -> struct(v.item_slots AS item_slots, v.slots AS slots))"))
    held = lines.withColumn("kept", F.expr("filter(met, w -> w.exact OR forall(w.pairs, p -> array_contains(won, p)))"))
    held = held.where(F.size("kept") > 0).groupBy("id", "class").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list(F.col("kept.item_at"))))).alias("n_found"),
        F.max(F.exists("kept", lambda w: ~w["exact"])).alias("reparameterised"),
    )
    classes = known.select("class", "item", "n_items", "n", "n_windows").distinct()
    enough = F.least(F.lit(RUN - WINDOW + 1), F.ceil(F.col("n") * SHARE))
    return held.join(lookup(classes), "class").where(F.col("n_found") >= enough).select(
        F.col("id").alias(id_col),
        F.col("item").alias("item_id"),
        "n_items",
        "n_windows",
        F.col("n_found").cast("long").alias("n_found"),
        "reparameterised",
    )


def without_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that leak no item, with all their columns."""
    leaking = checkpointed(leaks(docs, items, id_col, text_col).select(F.col(id_col).alias("__leaking")).distinct())
    return docs.join(lookup(leaking), F.col(id_col).eqNullSafe(F.col("__leaking")), "left_anti")
