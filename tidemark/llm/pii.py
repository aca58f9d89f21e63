"""Personal data by rules and by bootstrapped contextual extraction, in DataFrame functions only.

Rules find the base spans: email, ip, card, phone. These are the seeds. Every word of the corpus, without the marks at its
edges, can be an instance; the words beside it, to its left, to its right and both, digits written 0, are its patterns. Instances
and patterns make a graph, which is scored in rounds until a round discovers nothing:

* a pattern's confidence is the score of its known instances (1 for seeds) by the number of its different instances, one more
  counted as 0; it needs SUPPORT different known ones, and is useful from CONFIDENT on;
* an instance beside useful patterns scores one minus the product of what these leave open; from DISCOVERED on it is known, and
  from the next round on it supports all patterns that stand beside it anywhere, so identifiers lead to patterns and these to more.

A known instance that is no seed makes spans of kind ctx: beside useful patterns, and if it holds a digit wherever it stands as
a word; but where it touches a base span.

The corpus is read again in each round, so no table of its words is kept; patterns and values are told by 64-bit hashes. What a
round looks for is broadcast only if it is at most BROADCAST_KEYS hashes, counted first; else both sides are shuffled. Patterns
that far too many words stand beside (``the``) are dropped by a sketch of these, or a larger one where it is full, and all others are
counted exactly.

Spans are in code points, the end exclusive. A null text has no spans. Rows are told apart by doc_id and a hash of the text, so
null and repeated doc_ids do no harm, and repeated rows are reported each. An empty table gives no rows. Other columns are
ignored. Work is in proportion to the text: regular expressions do not try runs that failed again from inside, which finds the same,
and places are summed up in pieces.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut, drop_cut, table

SUPPORT, CONFIDENT, DISCOVERED = 3, 0.5, 0.8
BROADCAST_KEYS = 1_000_000
#: Patterns with more than this many times the instances that would make them useful, by a sketch of so many 64-bit words, are not counted exactly.
MARGIN, WORDS = 1.5, 16
#: Values that it takes to set all bits of a sketch.
FULL = 64 * WORDS * math.log(64 * WORDS)
#: Elements whose sums are formed one after the other.
PIECE = 256
KINDS = ("email", "ip", "card", "phone")
SPACES = r"[\x20\x09-\x0D]"
#: What is taken off the edges of a word.
EDGES = ".,;:!?()[]{}<>\"'`*#$%&|=“”„«»"
#: The contract's patterns with possessive quantifiers, which match the same; a match starts inside a run only where the last one ended.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a kind to be looked for.
MARKS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9][ -]?[0-9]", "phone": r"\+[0-9]"}
SPAN = "struct<kind:string,start:int,end:int>"


def with_starts(rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    """rows with a column for each of columns (array of lengths: name): the sum of all lengths before each place.

    Sums are formed within pieces and over the totals of pieces, as an array grows only by copying it.
    """

    def summed(of: Column) -> Column:
        begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("sums"))
        return F.aggregate(of, begin, lambda done, n: F.struct((done["at"] + n).alias("at"), F.concat(done["sums"], F.array(done["at"])).alias("sums")))

    def pieces(c: str) -> Column:
        whole = F.transform(F.sequence(F.lit(0), F.floor((F.size(c) - 1) / PIECE).cast("int")), lambda k: F.slice(c, k * PIECE + 1, F.lit(PIECE)))
        return F.when(F.size(c) > 0, whole).otherwise(F.array().cast("array<array<int>>"))

    rows = rows.withColumns({f"{name}_pieces": pieces(c) for c, name in columns.items()})
    rows = rows.withColumns({f"{name}_sums": F.transform(f"{name}_pieces", summed) for name in columns.values()})
    rows = rows.withColumns({f"{name}_totals": F.transform(f"{name}_sums", lambda x: x["at"]) for name in columns.values()})
    starts = {name: F.flatten(F.zip_with(f"{name}_sums", summed(F.col(f"{name}_totals"))["sums"], lambda x, at: F.transform(x["sums"], lambda s: s + at))) for name in columns.values()}
    rows = rows.withColumns(starts)
    return rows.drop(*(f"{name}_{part}" for name in columns.values() for part in ("pieces", "sums", "totals")))


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def passes_luhn(digits: Column) -> Column:
    turned = F.reverse(digits)
    # doubling each second digit: what exceeds 9 loses 9
    worth = F.transform(F.sequence(F.lit(1), F.length(digits)), lambda i: F.substr(turned, i, F.lit(1)).try_cast("int") * F.when(i % 2 == 0, 2).otherwise(1))
    return F.aggregate(worth, F.lit(0), lambda a, x: a + F.when(x > 9, x - 9).otherwise(x)) % 10 == 0


def holds(kind: str, value: Column) -> Column:
    """Whether a match of the kind is kept."""
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda part: part.rlike("^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return F.length(digits_of(value)).between(16, 19) & passes_luhn(digits_of(value))
    if kind == "phone":
        return F.length(digits_of(value)).between(8, 15)
    return F.lit(True)


def kept(kind: str) -> Callable[[Column], Column]:
    return lambda span: holds(kind, span["value"])


def plain(text: Column) -> Column:
    """How words stand in patterns."""
    return F.when(text.rlike("[0-9]"), F.regexp_replace(F.lower(text), "[0-9]++", "0")).otherwise(F.lower(text))


def beside(gap: Column, last: bool) -> Column:
    """The last or the first whole word of what stands between two matches, without what touches the match; empty if there is none."""
    parts = F.split(gap, SPACES, -1)
    words = F.array_remove(F.slice(parts, F.lit(1 if last else 2), F.size(parts) - 1), "")
    return plain(F.coalesce(F.try_element_at(words, F.lit(-1 if last else 1)), F.lit("")))


def spans_of(kind: str) -> Column:
    n = F.size(f"{kind}_hits")
    before, after = F.slice(f"{kind}_gaps", F.lit(1), n), F.slice(f"{kind}_gaps", F.lit(2), n)
    zipped = F.arrays_zip(F.col(f"{kind}_hits").alias("value"), F.col(f"{kind}_starts").alias("at"), before.alias("before"), after.alias("after"))

    def span(x: Column) -> Column:
        start = x["at"] + F.length(x["before"])
        end = start + F.length(x["value"])
        left, right = beside(x["before"], True), beside(x["after"], False)
        return F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), x["value"].alias("value"), left.alias("left"), right.alias("right"))

    return F.transform(F.filter(zipped, kept(kind)), span)


def base_spans(texts: DataFrame, keep: list[str]) -> DataFrame:
    """keep, spans: array of kind, start, end, value, left, right (words beside) by kind as listed, then start. What splitting leaves and matches alternate."""
    columns, lengths = {}, {}
    for kind in KINDS:
        marked = F.col("text").contains("@") if kind == "email" else F.col("text").rlike(MARKS[kind])
        none = F.array().cast("array<string>")
        columns[f"{kind}_gaps"] = F.when(marked, F.split("text", PATTERNS[kind], -1)).otherwise(none)
        columns[f"{kind}_hits"] = F.when(marked, F.regexp_extract_all("text", F.lit(PATTERNS[kind]), F.lit(0))).otherwise(none)
        gaps = F.slice(f"{kind}_gaps", F.lit(1), F.size(f"{kind}_hits"))
        lengths[f"{kind}_lengths"] = F.zip_with(gaps, f"{kind}_hits", lambda gap, hit: F.length(gap) + F.length(hit))
    rows = texts.select(*keep, "text").withColumns(columns).drop("text").withColumns(lengths)
    rows = with_starts(rows, {f"{kind}_lengths": f"{kind}_starts" for kind in KINDS})
    return rows.select(*keep, F.concat(*map(spans_of, KINDS)).alias("spans"))


def patterns_of(left: Column, right: Column) -> Column:
    """Hashes of the patterns that a word's left and right ones make; null where these are, at an end of the text."""
    left_, right_ = F.when(left.isNotNull(), F.xxhash64(F.lit("left"), left)), F.when(right.isNotNull(), F.xxhash64(F.lit("right"), right))
    return F.array(left_, right_, F.when(left.isNotNull() & right.isNotNull(), F.xxhash64(F.lit("both"), left, right)))


def spread(rows: DataFrame, *keep: str) -> DataFrame:
    """keep, pattern: a row for each pattern. Outer, here and below: for others Spark adds a filter on the array's size, which has the array made anew below."""
    return rows.select(*keep, F.explode_outer("patterns").alias("pattern")).where("pattern is not null")


def split_words(text: Column) -> Column:
    """The words, by single blanks: patterns cost several times as much."""
    for white in "\t\n\x0b\x0c\r":
        text = F.replace(text, F.lit(white), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def trimmed(word: Column) -> Column:
    """The word without marks at its edges, which most do not have."""

    def ordinary(c: Column) -> Column:
        return ((c >= "a") & (c < "{")) | ((c >= "A") & (c < "[")) | ((c >= "0") & (c < ":"))

    return F.when(ordinary(word) & ordinary(F.substring(word, -1, 1)), word).otherwise(F.btrim(word, F.lit(EDGES)))


def words_of(texts: DataFrame, keep: list[str], placed: bool = False) -> DataFrame:
    """keep, v (hash of the word without marks at its edges), patterns and, if asked for, numbered (it holds a digit), start and end of all words."""
    normal = split_words(plain(F.col("text"))).alias("normal")
    if placed:
        rows = texts.select(*keep, normal, F.split("text", SPACES, -1).alias("parts"))
        rows = with_starts(rows.withColumn("lengths", F.transform("parts", lambda x: F.length(x) + 1)), {"lengths": "starts"})
        zipped = F.filter(F.arrays_zip(F.col("parts").alias("word"), F.col("starts").alias("at")), lambda x: x["word"] != "")
        rows = rows.select(*keep, "normal", zipped.alias("words"))
        word = F.col("w.x.word")
    else:
        rows = texts.select(*keep, normal, split_words(F.col("text")).alias("words"))
        word = F.col("w.x")
    none = F.array(F.lit(None).cast("string"))
    left, right = F.slice(F.concat(none, F.col("normal")), F.lit(1), F.size("normal")), F.slice(F.concat(F.col("normal"), none), F.lit(2), F.size("normal"))
    one = rows.select(*keep, F.explode_outer(F.arrays_zip(F.col("words").alias("x"), left.alias("left"), right.alias("right"))).alias("w"))
    value = trimmed(word)
    out = [*keep, F.xxhash64(value).alias("v"), patterns_of(F.col("w.left"), F.col("w.right")).alias("patterns")]
    if placed:
        start = F.col("w.x.at") + F.length(word) - F.length(F.ltrim(word, F.lit(EDGES)))
        out += [value.rlike("[0-9]").alias("numbered"), start.alias("start"), (start + F.length(value)).alias("end")]
    return one.where(value != "").select(*out)


def bits(v: str) -> tuple[list[Column], Column]:
    """A sketch of WORDS times 64 bits, which the values' hashes set: aggregates over a column place, and that column. They are compiled, as Spark's own sketches are not."""
    place = F.shiftrightunsigned(v, 40).bitwiseAND(F.lit(64 * WORDS - 1))
    one = F.expr("1L << cast(place & 63 as int)")
    return [F.bit_or(F.when(F.shiftrightunsigned("place", 6) == k, one).otherwise(F.lit(0).cast("long"))).alias(f"bits_{k}") for k in range(WORDS)], place.alias("place")


def estimate() -> Column:
    """Different values in the sketch: its bits where they are few, by linear counting where some fell together; null if all bits are set."""
    total = 64 * WORDS
    held = sum((F.bit_count(f"bits_{k}") for k in range(1, WORDS)), F.bit_count("bits_0"))
    return F.when(held < total, -total * F.log(1 - held / total))


def sought(rows: DataFrame, keys: DataFrame, column: str, how: str = "inner") -> DataFrame:
    """rows joined with written keys, which are broadcast if they are few."""
    return rows.join(F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys, column, how)


def bootstrap(texts: DataFrame, seeds: DataFrame) -> tuple[DataFrame, DataFrame] | None:
    """What the seeds (v, pattern) lead to: the useful patterns, and the values known in the end but for seeds; None if there is nothing."""
    edges = seeds
    own = cut(seeds.select("v").distinct(), "op3-seeds")
    known, before = own.withColumn("score", F.lit(1.0)), None
    useful = None
    while True:
        mass = edges.join(known, "v").groupBy("pattern").agg(F.count("*").alias("n"), F.sum("score").alias("mass"))
        mass = cut(mass.where(F.col("n") >= SUPPORT).select("pattern", "mass"), "op3-mass")
        if mass.isEmpty():
            break
        sketch, place = bits("v")
        sizes = sought(spread(words_of(texts, []), "v"), mass, "pattern").select("pattern", "mass", place).groupBy("pattern").agg(F.any_value("mass").alias("mass"), *sketch)
        sizes = cut(sizes.select("pattern", estimate().alias("n"), (MARGIN * F.col("mass") / CONFIDENT).alias("most")), "op3-sizes")
        rest = sizes.where(F.col("n") <= F.col("most")).select("pattern")
        # a full sketch tells that there are many, which only matters to patterns that may have as many
        full = cut(sizes.where(F.col("n").isNull() & (F.col("most") >= FULL)).select("pattern", "most"), "op3-full")
        if not full.isEmpty():
            counted = sought(spread(words_of(texts, []), "v"), full, "pattern").groupBy("pattern").agg(F.approx_count_distinct("v").alias("n"), F.any_value("most").alias("most"))
            rest = rest.unionByName(counted.where(F.col("n") <= F.col("most")).select("pattern"))
        likely = cut(rest, "op3-likely")
        drop_cut(mass)
        if likely.isEmpty():
            break
        pairs = sought(spread(words_of(texts, []), "v"), likely, "pattern").select("v", "pattern").distinct().unionByName(sought(edges, likely, "pattern").select("v", "pattern")).distinct()
        pairs = cut(pairs, "op3-pairs")
        scored = pairs.join(known, "v", "left").groupBy("pattern").agg((F.sum(F.coalesce("score", F.lit(0.0))) / (F.count("*") + 1)).alias("confidence"))
        useful = cut(scored.where(F.col("confidence") >= CONFIDENT), "op3-useful")
        left_open = F.exp(F.sum(F.log(1 - F.col("confidence"))))
        found = pairs.join(useful, "pattern").groupBy("v").agg((1 - left_open).alias("score")).where(F.col("score") >= DISCOVERED)
        found = cut(found.join(own, "v", "left_anti"), "op3-found")
        drop_cut(pairs)
        drop_cut(likely)
        if found.isEmpty() or before is not None and found.join(before, "v", "left_anti").isEmpty():
            break
        before = found if before is None else cut(found.unionByName(before).groupBy("v").agg(F.max("score").alias("score")), "op3-known")
        known = own.withColumn("score", F.lit(1.0)).unionByName(before)
        again = spread(sought(words_of(texts, []), before.select("v"), "v"), "v").distinct()
        edges = cut(seeds.unionByName(again).distinct(), "op3-edges")
    return None if before is None else (useful.select("pattern"), before.select("v"))


def discovered_spans(texts: DataFrame, base: DataFrame, useful: DataFrame, known: DataFrame) -> DataFrame:
    """doc_id, h, spans of kind ctx."""
    key = ["doc_id", "h"]
    rows = sought(words_of(texts, key, placed=True), known, "v")  # few words are left here
    rows = cut(rows, "op3-words")
    context = sought(spread(rows, *key, "start", "end"), useful, "pattern", "left_semi")
    rows = cut(context.select(*key, "start", "end").unionByName(rows.where("numbered").select(*key, "start", "end")).distinct(), "op3-context")
    # what touches a base span is told in one pass over both, by place
    marks = base.select(*key, F.explode("spans").alias("s")).select(*key, "s.start", "s.end", F.lit(True).alias("is_base")).distinct()
    hashed = rows.select("h").distinct()
    both = rows.withColumn("is_base", F.lit(False)).unionByName(marks.join(hashed, "h", "left_semi"))
    upwards, downwards = (Window.partitionBy(*key).orderBy(o, F.desc("is_base")).rowsBetween(Window.unboundedPreceding, 0) for o in (F.asc("start"), F.desc("start")))
    reached = F.max(F.when(F.col("is_base"), F.col("end"))).over(upwards)
    next_ = F.min(F.when(F.col("is_base"), F.col("start"))).over(downwards)
    free = both.withColumns({"reached": reached, "next": next_})
    free = free.where(~F.col("is_base") & (F.coalesce("reached", F.lit(0)) <= F.col("start")) & (F.coalesce("next", F.col("end")) >= F.col("end")))
    spans = F.sort_array(F.collect_list(F.struct(F.lit("ctx").alias("kind"), "start", "end"))).alias("new")
    return cut(free.groupBy(*key).agg(spans), "op3-new")


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, spans: array of (kind, start, end), base kinds as listed and then ctx, each by start."""
    text = F.coalesce("text", F.lit(""))
    texts = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("h"))
    # written as they are: a filter on them would be moved below, and have them made twice
    rows = cut(base_spans(texts, ["doc_id", "h"]), "op3-rows")
    base = cut(rows.where(F.size("spans") > 0).dropDuplicates(["doc_id", "h"]), "op3-base")
    word = lambda side: F.when(F.col(f"s.{side}") != "", F.col(f"s.{side}"))
    seeds = base.select(F.explode("spans").alias("s")).select(F.xxhash64("s.value").alias("v"), patterns_of(word("left"), word("right")).alias("patterns"))
    seeds = spread(seeds, "v")
    found = bootstrap(texts.select("text"), cut(seeds.distinct(), "op3-edges"))
    spans = F.transform("spans", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    rows = rows.select("doc_id", "h", spans.alias("spans"))
    if found is None:
        return rows.select("doc_id", "spans")
    new = discovered_spans(texts, base, *found)
    joined = rows.join(new, rows["doc_id"].eqNullSafe(new["doc_id"]) & (rows["h"] == new["h"]), "left")
    return joined.select(rows["doc_id"], F.concat("spans", F.coalesce("new", F.array().cast(f"array<{SPAN}>"))).alias("spans"))


def _of(kind: str) -> Callable[[Column], Column]:
    return lambda span: span["kind"] == kind


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document."""
    found = personal_data(table(spark, sf_dir, "documents"))
    written = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    counts = [F.size(F.filter("spans", _of(kind))).cast("long").alias(f"n_{kind}") for kind in KINDS]
    base = written(F.filter("spans", lambda s: s["kind"] != "ctx"))
    return found.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))
