"""Benchmark decontamination by template canonicalisation, in DataFrame functions only.

Texts and benchmark items are cut into numbers, words and operators in front of a number. In the template names (words of
which the first letter is a capital and the second is small, wherever they stand), numbers and units of measure behind
numbers are replaced by typed placeholders, other words are lower-cased. Windows of WINDOW template tokens are hashed and
joined by hash. An item is found in a document if at least SHARE of its windows are, in one alignment, with consistent slots:
at the places that match, and near them, each value of a placeholder in the item stands for one value in the document, and each
name or unit of the document for one of the item. So a question with other numbers or names is caught, and a chance likeness
of templates with slots at random is not. Numbers may coincide: 3 + 5 can become 4 + 4.

Alignments are the shifts from places of the item to places of the document: each shift for itself, shifts that lie together by
ever wider gaps (powers of GAP, for copies with insertions), and all of them. Each is judged alone and one that passes is enough,
so other variants, copies and chance matches elsewhere in the document do not hide an item. The columns are those of the passing
alignment with most windows.

Windows of the plain tokens, lower-cased, are joined beside those of the template: a document that holds SHARE of an item's plain
windows holds the item whatever its slots are. So copies in other case are caught, and items with many placeholders (arithmetic,
sequences, tables): template windows of the item with fewer than half of their tokens literal are not used. A finding by plain windows
alone has no slots. Items shorter than WINDOW tokens have one window of their own length; only an item without a letter, number
or operator is not looked for.

Texts are tokenised once for all windows. The item windows are broadcast only if they are at most BROADCAST_WINDOWS, counted
first; else both sides are shuffled by hash. Work is in proportion to the tokens.

Nulls: null texts match nothing; rows without doc_id or item_id are skipped. Repeated rows give the same findings once.
An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut, drop_cut, table

WINDOW = 8
SHARE = 0.5
BROADCAST_WINDOWS = 500_000
GAP = 4
FORMS = ("template", "plain")
TEMPLATE, PLAIN = 0, 1
NAME, NUMBER, UNIT = "name", "number", "unit"
NUMBER_PATTERN = r"\p{Nd}++(?:[.,:/]\p{Nd}++)*+"
WORD_PATTERN = r"[\p{L}\p{M}]++(?:['’-][\p{L}\p{M}]++)*+"
OPERATOR_PATTERN = r"[\p{Sm}*/^-](?=\x20?+[\p{Nd}(])"
#: Units of measure, in English, German, French and Spanish.
UNITS = """
mm cm m km in inch inches ft foot feet yd yard yards mi mile miles g kg mg lb lbs oz ounce ounces l ml s sec second seconds min minute minutes h hour hours
day days week weeks month months year years euro euros dollar dollars cent cents percent degree degrees meter meters metre metres gram grams liter liters litre litres kph mph kmh
sekunde sekunden minuten stunde stunden tag tage tagen woche wochen monat monate monaten jahr jahre jahren prozent grad liter meile meilen
seconde secondes heure heures jour jours semaine semaines mois an ans degré degrés mètre mètres kilomètre kilomètres gramme grammes
segundo segundos minuto minutos hora horas día días semana semanas mes meses año años grado grados metro metros kilómetro kilómetros gramo gramos litro litros
""".split()


def tokens(text: Column) -> Column:
    """Numbers, words and operators as they stand."""
    return F.regexp_extract_all(text, F.lit(f"{NUMBER_PATTERN}|{WORD_PATTERN}|{OPERATOR_PATTERN}"), F.lit(0))


def is_number(token: Column) -> Column:
    """By the order of strings; patterns are asked only beyond ASCII, as most tokens are words in small letters."""
    return ((token >= "0") & (token < ":")) | ((token >= "\u0080") & token.rlike(r"^\p{Nd}"))


def is_name(token: Column) -> Column:
    return (((token >= "A") & (token < "[")) | (token >= "\u0080")) & token.rlike(r"^\p{Lu}[\p{Ll}\p{M}]")


def by_kind(token: Column, before: Column, of: dict[str, Column]) -> Column:
    """What of has for the token's kind of placeholder, null if it is literal; before: the token in front of it, or an empty one."""
    unit = is_number(before) & F.lower(token).isin(UNITS)
    return F.when(is_number(token), of[NUMBER]).when(is_name(token), of[NAME]).when(unit, of[UNIT])


def with_before(raw: str, of: Callable[[Column, Column], Column]) -> Column:
    """of each token and the one in front of it."""
    return F.zip_with(raw, F.slice(F.concat(F.array(F.lit("")), F.col(raw)), F.lit(1), F.size(raw)), of)


def tokenised(rows: DataFrame, key: str) -> DataFrame:
    """key, n (tokens), plain_1 and template_1 (hashes of the tokens of each form)."""
    marks = {kind: F.xxhash64(F.lit("slot"), F.lit(kind)) for kind in (NAME, NUMBER, UNIT)}

    raw = rows.select(key, tokens(F.col("text")).alias("raw"))
    held = raw.select(key, F.size("raw").alias("n"), F.transform("raw", lambda t: F.xxhash64(F.lower(t))).alias("plain_1"), with_before("raw", lambda t, before: by_kind(t, before, marks)).alias("marks"))
    return held.select(key, "n", "plain_1", F.zip_with("plain_1", "marks", lambda h, m: F.coalesce(m, h)).alias("template_1"))


def windows(rows: DataFrame, key: str, sizes: list[int]) -> DataFrame:
    """key, n, at, hash of the windows of all these sizes; at: number of the window among those of a text, see decoded.

    Windows are made by doubling. Arrays are arguments of functions, not read inside lambdas, where they would be made anew for each place.
    """
    made = {1}

    def joined(form: str, size: int, left: int) -> Column:
        count = F.greatest(F.col("n") - size + 1, F.lit(0))
        return F.zip_with(F.slice(f"{form}_{left}", F.lit(1), count), F.slice(f"{form}_{size - left}", F.lit(left + 1), count), lambda a, b: F.xxhash64(a, b))

    def make(size: int) -> None:
        nonlocal rows
        if size not in made:
            left = 1 << ((size - 1).bit_length() - 1)
            make(left)
            make(size - left)
            rows = rows.withColumns({f"{form}_{size}": joined(form, size, left) for form in FORMS})
            made.add(size)

    for size in sizes:
        make(size)
    every = F.concat(*(F.col(f"{form}_{size}") for size in sizes for form in FORMS))
    # outer: for others Spark adds a filter on the array's size, which has the array made anew below
    return rows.select(key, "n", F.posexplode_outer(every).alias("at", "hash")).where("hash is not null")


def decoded(n: Column, at: Column, sizes: list[int]) -> Column:
    """mode, size and place of a text's window by its number, which counts sizes and within them forms; n: tokens of the text."""
    before, out = F.lit(0), None
    for size in sizes:
        count = F.greatest(n - size + 1, F.lit(0))
        for mode in range(len(FORMS)):
            one = F.struct(F.lit(mode).alias("mode"), F.lit(size).alias("size"), (at - before).alias("place"))
            before = before + count
            out = F.when(at < before, one) if out is None else out.when(at < before, one)
    return out


def slots(rows: DataFrame, key: str) -> DataFrame:
    """key, place, kind, value of every placeholder."""
    raw = rows.select(key, tokens(F.col("text")).alias("raw"))
    kinds = {kind: F.lit(kind) for kind in (NAME, NUMBER, UNIT)}
    one = with_before("raw", lambda t, before: F.struct(by_kind(t, before, kinds).alias("kind"), F.lower(t).alias("value")))
    # outer, here and below: for others Spark adds a filter on the array's size, which has the array made anew below
    return raw.select(key, F.posexplode_outer(one).alias("place", "slot")).where("slot.kind is not null").select(key, "place", "slot.kind", "slot.value")


def alignments(places: DataFrame) -> DataFrame:
    """doc_id, item_id, shift, first, last: the shifts of each pair's alignments, which are named by their first and last shift."""
    shifts = places.select("doc_id", "item_id", "shift").distinct()
    pair = Window.partitionBy("doc_id", "item_id")
    ordered = pair.orderBy("shift")
    shifts = shifts.withColumns({"gap": F.col("shift") - F.lag("shift").over(ordered), "widest": F.max("shift").over(pair) - F.min("shift").over(pair)})
    # the powers of GAP below the pair's widest gap, then no bound
    steps = F.ceil(F.log(F.greatest("widest", F.lit(1)).cast("double")) / math.log(GAP)).cast("int")
    bounds = F.concat(F.array(F.lit(0.0)), F.transform(F.sequence(F.lit(1), steps + 1), lambda k: F.pow(F.lit(float(GAP)), k)))
    leveled = shifts.withColumn("bound", F.explode(bounds))
    run = F.sum((F.coalesce("gap", F.lit(0)) > F.col("bound")).cast("long")).over(Window.partitionBy("doc_id", "item_id", "bound").orderBy("shift"))
    whole = Window.partitionBy("doc_id", "item_id", "bound", "run")
    named = leveled.withColumn("run", run).select("doc_id", "item_id", "shift", F.min("shift").over(whole).alias("first"), F.max("shift").over(whole).alias("last"))
    return named.distinct()


def item_windows(items: DataFrame) -> DataFrame:
    """item_id, mode, size, item_place, hash of the windows that items are looked for by."""
    rows = tokenised(items, "item_id").where("n > 0")
    sizes = sorted(r["size"] for r in rows.select(F.least("n", F.lit(WINDOW)).alias("size")).distinct().collect())  # WINDOW values at most
    if not sizes:
        return items.sparkSession.createDataFrame([], "item_id long, mode int, size int, item_place int, hash long")
    literal = rows.select("item_id", F.zip_with("plain_1", "template_1", lambda a, b: a == b).alias("literal"))
    one = windows(rows, "item_id", sizes).withColumn("w", decoded(F.col("n"), F.col("at"), sizes)).where(F.col("w.size") == F.least("n", F.lit(WINDOW)))
    n_literal = F.size(F.filter(F.slice("literal", F.col("w.place") + 1, F.col("w.size")), lambda x: x))
    used = one.join(literal, "item_id").where((F.col("w.mode") == PLAIN) | (2 * n_literal >= F.col("w.size")))
    return used.select("item_id", "w.mode", "w.size", F.col("w.place").alias("item_place"), "hash")


def contaminated(docs: DataFrame, items: DataFrame, share: float = SHARE) -> DataFrame:
    """doc_id, item_id, n_windows (of the item), n_matched (those of them found), n_slots (compared), n_slot_conflicts; pairs that are findings only."""
    spark = docs.sparkSession
    items = items.where("item_id is not null and text is not null").select("item_id", "text").dropDuplicates(["item_id"])
    sought = cut(item_windows(items), "op5-sought")
    sizes = sorted(r["size"] for r in sought.select("size").distinct().collect())
    if not sizes:
        return spark.createDataFrame([], "doc_id long, item_id long, n_windows long, n_matched long, n_slots long, n_slot_conflicts long")
    few = sought.count() <= BROADCAST_WINDOWS
    texts = docs.where("doc_id is not null and text is not null").select("doc_id", "text")
    side = F.broadcast(sought) if few else sought
    found = windows(tokenised(texts, "doc_id"), "doc_id", sizes).join(side, "hash").withColumn("w", decoded(F.col("n"), F.col("at"), sizes))
    found = found.where((F.col("w.mode") == F.col("mode")) & (F.col("w.size") == F.col("size"))).withColumn("place", F.col("w.place"))
    found = cut(found.select("doc_id", "item_id", "mode", "size", "place", "item_place").distinct(), "op5-found")
    total = sought.groupBy("item_id", "mode").agg(F.count("*").alias("n_windows"))
    matched = found.groupBy("doc_id", "item_id", "mode").agg(F.count_distinct("item_place").alias("n_matched"))
    pairs = cut(matched.join(total, ["item_id", "mode"]).where(F.col("n_matched") >= share * F.col("n_windows")), "op5-pairs")
    none = F.lit(0).cast("long")
    counts = ("n_windows", "n_matched", "n_slots", "n_slot_conflicts")
    plain = pairs.where(F.col("mode") == PLAIN).select("doc_id", "item_id", "n_windows", "n_matched", none.alias("n_slots"), none.alias("n_slot_conflicts"))

    # slots at the places that match; texts are read again for documents with findings only
    pair, one = ["doc_id", "item_id"], ["doc_id", "item_id", "first", "last"]
    likely = pairs.where(F.col("mode") == TEMPLATE)
    places = found.where(F.col("mode") == TEMPLATE).join(likely.select(*pair), pair, "left_semi")
    places = cut(places.select(*pair, "item_place", (F.col("place") - F.col("item_place")).alias("shift"), "size"), "op5-places")
    drop_cut(found)
    aligned = cut(alignments(places), "op5-alignments")
    judged = places.join(aligned, [*pair, "shift"]).groupBy(*one).agg(F.count_distinct("item_place").alias("n_matched"))
    judged = judged.join(total.where(F.col("mode") == TEMPLATE).drop("mode"), "item_id").where(F.col("n_matched") >= share * F.col("n_windows"))
    item_slots = slots(items.join(likely.select("item_id").distinct(), "item_id", "left_semi"), "item_id")
    # slots in a window that matches, or about as near to one; where the document has no such slot there, nothing is compared
    inside = F.col("item_slot").between(F.col("item_place") - WINDOW, F.col("item_place") + F.col("size") + WINDOW)
    item_slots = item_slots.select("item_id", F.col("place").alias("item_slot"), "kind", F.col("value").alias("item_value"))
    asked = places.join(item_slots, "item_id").where(inside)
    asked = asked.select(*pair, "shift", "kind", "item_value", (F.col("item_slot") + F.col("shift")).alias("place")).distinct()
    # written, as the filters of what follows would else be evaluated for all texts, before the join
    wanted = cut(docs.select("doc_id", "text").where("text is not null").join(likely.select("doc_id").distinct(), "doc_id", "left_semi"), "op5-texts")
    bound = asked.join(slots(wanted, "doc_id"), ["doc_id", "place", "kind"]).join(aligned, [*pair, "shift"])
    bound = cut(bound.select(*one, "kind", "item_value", "place", "value").distinct(), "op5-bound")
    # an item's value stands for one value, and a name or unit of the document for one of the item
    forth = bound.groupBy(*one, "kind", "item_value").agg(F.count("*").alias("n"), (F.count_distinct("value") > 1).cast("long").alias("conflict"))
    back = bound.where(F.col("kind") != NUMBER).groupBy(*one, "kind", "value").agg(none.alias("n"), (F.count_distinct("item_value") > 1).cast("long").alias("conflict"))
    both = forth.select(*one, "n", "conflict").unionByName(back.select(*one, "n", "conflict"))
    slot_counts = both.groupBy(*one).agg(F.sum("n").alias("n_slots"), F.sum("conflict").alias("n_slot_conflicts"))
    passed = judged.join(slot_counts, one, "left").fillna(0, ["n_slots", "n_slot_conflicts"]).where("n_slot_conflicts = 0")
    best = F.max(F.struct("n_matched", "n_slots", "n_slot_conflicts", "n_windows")).alias("best")
    findings = passed.select(*pair, *counts).unionByName(plain.select(*pair, *counts)).groupBy(*pair).agg(best)
    return findings.select(*pair, *(f"best.{c}" for c in counts))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that stand in documents."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
