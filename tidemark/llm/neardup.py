"""Near-duplicate documents: SuperMinHash signatures, banding, verification on full sets, grouping.

A document's set holds the hashes of its distinct word shingles. Documents with the same set form a class, which all later
steps take as one. A class's SuperMinHash signature has one random permutation of the places for each element: in round j
the element offers j plus a random fraction to the j-th place of its permutation. Round by round over all elements of a
batch gives the same minima as element by element, and a document stops as soon as no place can still fall (early stopping).

Signatures are cut into BANDS bands of ROWS places; classes that share a band are candidates. Within a shared band all are
compared with one head, so pairs grow with the members. What did not link with its head's component is loose: it is compared
with further heads while that settles half of it a turn. What is loose then is met by rare elements: two sets that link share one
of the rarest elements of each, whose number follows from the threshold, so each class is compared with every component it
meets so, in blocks of whole sets. No candidate pair of a band is left out, and every link is confirmed on the full sets by
counting their intersection. Links are grouped by contraction: nodes move to their least neighbour until no link is left.

Recall of candidates: a pair of similarity s shares a band with probability 1 - (1 - s**ROWS)**BANDS, over 0.9999 at 0.8.

Nulls: a null text has an empty set and is linked with nothing, as are texts without words. Repeated rows and texts alike are
one class. A row without doc_id belongs to the component of its text; where that has no doc_id at all, component_id is null.
An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import GOLDEN, as_bytes, cut, drop_cut, hash_words, mix, release, rows_a_batch, slices, table

BANDS, ROWS = 32, 6
PLACES = BANDS * ROWS
#: Turns of further heads go on while each leaves less than this share of what was loose; then come blocks. It changes the work, not the result.
GOES_ON = 0.5
#: Elements in a block of sets, and rows of two blocks in a batch.
BLOCK, BLOCK_ROWS = 50_000, 8
UNSET = np.uint64(0xFFFFFFFFFFFFFFFF)
LOW = np.uint64(0xFFFFFFFF)
HALF = np.uint64(32)


def shingle_sets(texts: list[bytes], shingle: int) -> list[np.ndarray]:
    """For each text, the sorted distinct hashes of its shingles, A-Z lowered. With fewer words, the whole sequence is the only one."""
    h, bounds = hash_words([t.lower() for t in texts])
    key = np.full(max(0, len(h) - shingle + 1), shingle, np.uint64)
    for k in range(shingle):
        key = mix(key * GOLDEN + h[k : len(key) + k])
    sets = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= shingle:
            sets.append(np.unique(key[a : b - shingle + 1]))
        elif b > a:
            short = np.full(1, b - a, np.uint64)
            for k in range(a, b):
                short = mix(short * GOLDEN + h[k])
            sets.append(short)
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def super_min_hash(sets: list[np.ndarray], places: int = PLACES) -> np.ndarray:
    """Signatures, a row for each set: in the upper half of a value the round, in the lower one the fraction."""
    n = len(sets)
    signature = np.full(n * places, UNSET)
    element = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    order = None
    for j in range(places):
        if not len(element):
            break
        random = mix(element + np.uint64(int(GOLDEN) * (j + 1) & int(UNSET)))
        swap = j + ((random & LOW) * np.uint64(places - j) >> HALF).astype(np.int64)
        if order is None:
            place = swap
        else:
            here = np.arange(len(element))
            place = order[here, swap].astype(np.int64)
            order[here, swap] = order[:, j]
            order[:, j] = place
        np.minimum.at(signature, owner * places + place, np.uint64(j << 32) | (random >> HALF))
        open_ = signature.reshape(n, places).max(1) >= np.uint64((j + 1) << 32)
        stay = open_[owner]
        if order is None:
            # permutations are kept only for elements of sets that need a second round
            element, owner, swap = element[stay], owner[stay], swap[stay]
            order = np.tile(np.arange(places, dtype=np.uint8 if places <= 256 else np.uint16), (len(element), 1))
            order[np.arange(len(element)), swap] = 0
            order[:, 0] = swap
        elif not stay.all():
            element, owner, order = element[stay], owner[stay], order[stay]
    return signature.reshape(n, places)


def band_keys(signature: np.ndarray) -> np.ndarray:
    parts = signature.reshape(len(signature), BANDS, ROWS)
    key = np.broadcast_to(mix(np.arange(1, BANDS + 1, dtype=np.uint64)), (len(signature), BANDS))
    for k in range(ROWS):
        key = mix(key * GOLDEN + parts[:, :, k])
    return key.view(np.int64)


def sketches(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, n_shingles, class (digest of the set, null if empty), bands."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"].tolist()
            for first, last in slices(texts, 500_000):
                sets = shingle_sets(texts[first:last], shingle)
                keys = band_keys(super_min_hash(sets))
                full = [len(s) > 0 for s in sets]
                yield pd.DataFrame({
                    "doc_id": batch["doc_id"].iloc[first:last].to_numpy(), "n_shingles": [len(s) for s in sets],
                    "class": [xxhash.xxh3_128_digest(s.tobytes()) if f else None for s, f in zip(sets, full, strict=True)],
                    "bands": [k if f else None for k, f in zip(keys, full, strict=True)],
                })

    keyed = docs.select(F.col("doc_id").cast("string").alias("doc_id"), as_bytes().alias("text"))
    return keyed.mapInPandas(run, "doc_id string, n_shingles long, class binary, bands array<long>").withColumn("doc_id", F.col("doc_id").cast("long"))


def full_sets(docs: DataFrame, shingle: int) -> DataFrame:
    """class, set of each document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"].tolist()
            for first, last in slices(texts):
                sets = shingle_sets(texts[first:last], shingle)
                yield pd.DataFrame({"class": [xxhash.xxh3_128_digest(s.tobytes()) for s in sets], "set": [s.view(np.int64) for s in sets]})

    return docs.select(as_bytes().alias("text")).mapInPandas(run, "class binary, set array<long>")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """a, b, similarity, linked."""
    left = sets.select(F.col("class").alias("a"), F.col("set").alias("set_a"))
    right = sets.select(F.col("class").alias("b"), F.col("set").alias("set_b"))
    small, large = F.least(F.size("set_a"), F.size("set_b")), F.greatest(F.size("set_a"), F.size("set_b"))
    # sets of too different sizes are told apart by these alone
    both = F.when(100 * small >= percent * large, F.size(F.array_intersect("set_a", "set_b"))).otherwise(small)
    joined = pairs.join(right, "b").join(left, "a").select("a", "b", both.alias("both"), (F.size("set_a") + F.size("set_b")).alias("sizes"))
    union = F.col("sizes") - F.col("both")
    return joined.select("a", "b", (F.col("both") / union).alias("similarity"), (100 * F.col("both") >= percent * union).alias("linked"))


def components(links: DataFrame, label: str) -> DataFrame:
    """node, component (its least node) for the nodes of the links (a, b)."""
    edges, labels = cut(links.select("a", "b"), f"{label}-edges"), None
    while True:
        both = edges.select("a", "b").union(edges.select("b", "a"))
        step = cut(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("to")), f"{label}-step")
        if labels is None:
            labels = cut(step.select(F.col("a").alias("node"), F.col("to").alias("component")), f"{label}-labels")
        else:
            old = labels
            moved = old.join(step, old["component"] == step["a"], "left")
            labels = cut(moved.select("node", F.coalesce("to", "component").alias("component")), f"{label}-labels")
            drop_cut(old)
        left, right = step.select("a", F.col("to").alias("x")), step.select(F.col("a").alias("b"), F.col("to").alias("y"))
        rest = edges.join(left, "a").join(right, "b").where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        rest = cut(rest, f"{label}-edges")
        drop_cut(edges)
        drop_cut(step)
        release(links.sparkSession)
        edges = rest
        if edges.isEmpty():
            return labels


def _with_component(members: DataFrame, labels: DataFrame) -> DataFrame:
    named = labels.select(F.col("node").alias("class"), "component")
    return members.join(named, "class", "left").withColumn("component", F.coalesce("component", "class"))


def _blocks(rows: DataFrame, sets: DataFrame, by: str, out: str) -> DataFrame:
    """Of rows (by, class, and component if there is one): the sets of each value of by in blocks of about BLOCK elements, as by, out."""
    sized = rows.join(sets.select("class", F.size("set").alias("n")), "class")
    blocks = cut(sized.groupBy(by).agg(F.ceil(F.sum("n") / BLOCK).alias("blocks")), "neardup-sizes")
    dealt = sized.drop("n").join(blocks, by).withColumn("block", F.pmod(F.xxhash64("class"), "blocks")).drop("blocks")
    one = F.struct("class", "set")
    return dealt.join(sets, "class").groupBy(by, "block").agg(F.collect_list(one).alias(out)).drop("block")


def needed(n: Column, m: Column, percent: int) -> Column:
    """How many elements sets of n and m elements must share to link."""
    return F.ceil(percent * (n + m) / (100 + percent))


def prefixes(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """element, class, component, n, at: where the rarest elements of each class of rows (class, component) stand in its order.

    Elements are ordered by the number of classes that have them, the rarest first. Sets of n and m elements that link share an
    element among the first n - needed + 1 of the one and the first m - needed + 1 of the other, whatever the order is.
    """
    spread = rows.join(sets, "class").select("class", "component", F.size("set").alias("n"), F.explode("set").alias("element"))
    common = spread.groupBy("element").agg(F.count("*").alias("df"), F.min("component").alias("low"), F.max("component").alias("high"))
    common = cut(common.where("df > 1").select("element", "df", (F.col("low") != F.col("high")).alias("mixed")), "neardup-common")
    ranked = spread.join(common, "element").groupBy("class").agg(
        F.any_value("component").alias("component"), F.any_value("n").alias("n"), F.sort_array(F.collect_list(F.struct("df", "element", "mixed"))).alias("shared")
    )
    # elements that one class alone has come first and lead to none
    alone = F.col("n") - F.size("shared")
    most = (F.col("n") - F.ceil(F.col("n") * percent / 100) + 1 - alone).cast("int")
    first = ranked.where(most > 0).select("class", "component", "n", alone.alias("alone"), F.posexplode(F.slice("shared", F.lit(1), most)).alias("place", "x"))
    return first.where("x.mixed").select("x.element", "class", "component", "n", (F.col("alone") + F.col("place")).alias("at"))


def compare_blocks(left: list, right: list, percent: int) -> list[bytes]:
    """The classes of left that link with a class of right; both hold rows of class and set. Intersections are counted over an index of right."""
    sizes = np.array([len(y["set"]) for y in right])
    flat = np.concatenate([y["set"] for y in right])
    order = np.argsort(flat, kind="stable")
    element, first = np.unique(flat[order], return_index=True)
    owner, last = np.repeat(np.arange(len(right)), sizes)[order], np.append(first[1:], len(flat))
    found = []
    for x in left:
        own = np.asarray(x["set"])
        at = np.minimum(np.searchsorted(element, own), len(element) - 1)
        at = at[element[at] == own]
        count = last[at] - first[at]
        ends = np.cumsum(count)
        posts = np.repeat(first[at] - ends + count, count) + np.arange(ends[-1] if len(ends) else 0)
        both = np.bincount(owner[posts], minlength=len(right))
        if (100 * both >= percent * (sizes + len(own) - both)).any():
            found.append(x["class"])
    return found


def block_links(loose: DataFrame, named: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that connect loose classes with all components they link with, b being a component. loose, named: band, class, component.

    Classes in bands with loose ones meet by rare elements. Where classes of several components meet, those outside the largest
    one are each compared with the components there that they can link with by size and place, as a whole: sets of a component
    stand in blocks, and blocks of what is to be compared meet blocks of the component. Rows grow with the pairs of a class and a
    component that share an element rare enough.
    """
    own = cut(named.join(loose.select("band").distinct(), "band").select("class", "component").distinct(), "neardup-own")
    met = cut(prefixes(own, sets, percent), "neardup-prefixes")
    # of classes that link the smaller one, or one of two as large, has the element this early
    early = F.col("at") <= F.col("n") - needed(F.col("n"), F.col("n"), percent)
    beside = cut(met.groupBy("element", "component", "n", "at").agg(F.count("*").alias("classes"), F.any_value(early).alias("early")), "neardup-beside")
    sums = beside.groupBy("element", "component").agg(F.sum("classes").alias("classes"), F.max("early").alias("early"))
    largest = sums.groupBy("element").agg(F.max(F.struct("classes", "component")).alias("largest"), F.count("*").alias("n"), F.max("early").alias("early"))
    largest = cut(largest.where("n > 1 and early").select("element", F.col("largest.component").alias("largest")), "neardup-largest")
    outside = cut(met.join(largest, "element").where(F.col("component") != F.col("largest")).withColumn("early", early), "neardup-outside")
    target = beside.select("element", F.col("component").alias("target"), F.col("n").alias("m"), F.col("at").alias("place"), F.col("early").alias("first"))
    least = needed(F.col("n"), F.col("m"), percent)
    asked = outside.join(target, "element").where(
        (F.col("early") | F.col("first")) & (F.col("component") != F.col("target")) & (F.col("at") <= F.col("n") - least) & (F.col("place") <= F.col("m") - least)
    )
    asked = cut(asked.select("class", "target").distinct(), "neardup-asked")
    for part in (met, beside, outside):
        drop_cut(part)
    left = _blocks(asked, sets, "target", "left")
    targets = cut(asked.select(F.col("target").alias("component")).distinct(), "neardup-targets")
    wanted = own.join(targets, "component", "left_semi")
    right = cut(_blocks(wanted.select("class", F.col("component").alias("target")), sets, "target", "right"), "neardup-right")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [(x, target) for target, left, right in zip(batch["target"], batch["left"], batch["right"], strict=True) for x in compare_blocks(left, right, percent)]
            yield pd.DataFrame(found, columns=["a", "b"])

    with rows_a_batch(sets.sparkSession, BLOCK_ROWS):
        links = left.join(right, "target").select("target", "left", "right").mapInPandas(compare, "a binary, b binary")
        links = cut(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "neardup-met")
    drop_cut(right)
    return links


def class_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Confirmed links that connect what the candidate pairs of every band connect. members: band, class, head (least class of the band)."""
    star = members.where(F.col("class") != F.col("head")).select(F.col("head").alias("a"), F.col("class").alias("b")).distinct()
    links = cut(verified(star, sets, percent).where("linked").select("a", "b"), "neardup-links")
    before, turn = None, 0
    while True:
        named = cut(_with_component(members, components(links, "neardup")), "neardup-named")
        heads = named.where(F.col("class") == F.col("head")).select("band", F.col("component").alias("head_component"))
        loose = cut(named.join(heads, "band").where(F.col("component") != F.col("head_component")), "neardup-loose")
        n = loose.count()
        if not n:
            return links
        if before is not None and n >= GOES_ON * before:
            # the rest with all classes of the components beside it, in blocks
            return cut(links.unionByName(block_links(loose, named, sets, percent)), "neardup-links")
        # what is loose is compared with other heads, as many as it has bands: most links are found so
        order = F.xxhash64("class", F.lit(turn))
        bands = loose.select("band").distinct()
        heads = cut(named.join(bands, "band").groupBy("band").agg(F.min_by(F.struct("class", "component"), order).alias("other")), "neardup-heads")
        star = loose.join(heads, "band").where(F.col("component") != F.col("other.component"))
        star = star.select(F.least("class", "other.class").alias("a"), F.greatest("class", "other.class").alias("b")).distinct()
        links = cut(links.unionByName(verified(star, sets, percent).where("linked").select("a", "b")).distinct(), "neardup-links")
        before, turn = n, turn + 1
        drop_cut(named)
        drop_cut(loose)
        release(sets.sparkSession)


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id (the least doc_id of those reachable by links), kept (doc_id is component_id)."""
    spark = docs.sparkSession
    sketch = cut(sketches(docs, shingle), "neardup-sketch")
    classes = cut(
        sketch.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("first_id"), F.any_value("bands").alias("bands")), "neardup-classes"
    )
    banded = classes.select("class", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.min("class").alias("head"), F.count("*").alias("n")).where("n > 1").drop("n")
    members = cut(banded.join(cut(shared, "neardup-shared"), "band"), "neardup-members")  # written first: a hot band can then be split
    release(spark)
    wanted = members.select("class").distinct().join(classes.select("class", "first_id"), "class")
    # texts are read once more for candidates only
    some = cut(wanted.select("class", "first_id"), "neardup-wanted")
    texts = docs.select("doc_id", "text").join(some.select(F.col("first_id").alias("doc_id")).distinct(), "doc_id", "left_semi")
    texts = texts.unionByName(docs.select("doc_id", "text").where("doc_id is null"))
    sets = full_sets(texts, shingle).join(some.select("class"), "class", "left_semi").dropDuplicates(["class"])
    sets = cut(sets, "neardup-sets")
    release(spark)
    labels = components(class_links(members, sets, percent), "neardup")
    named = _with_component(classes.select("class", "first_id"), labels)
    least = cut(named.groupBy("component").agg(F.min("first_id").alias("component_id")), "neardup-least")  # written first, as above
    found = cut(named.join(least, "component").select("class", "component_id"), "neardup-found")
    drop_cut(sets)
    release(spark)
    whole = sketch.select("doc_id", "n_shingles", "class").join(found, "class", "left")
    component = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    return whole.select("doc_id", "n_shingles", component, F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of the documents by 2-word shingles."""
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=2)


OP6_SQL = r"""
with recursive words as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') as w
  from documents
), shingles as (
  select distinct doc_id, unnest(case when len(w) > 1 then list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) else w end) as s from words
), sizes as (select doc_id, count(*) as n from shingles group by doc_id
), shared as (
  select a.doc_id as x, b.doc_id as y, count(*) as c from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by all
), links as (
  select x, y from shared join sizes p on p.doc_id = x join sizes q on q.doc_id = y where 100 * c >= 80 * (p.n + q.n - c)
), edges as (select x as a, y as b from links union all select y, x from links
), reached(a, b) as (
  select doc_id, doc_id from documents union select reached.a, edges.b from reached join edges on reached.b = edges.a
), least as (select a as doc_id, min(b) as component_id from reached group by a)
select documents.doc_id, coalesce(sizes.n, 0) as n_shingles, least.component_id, documents.doc_id = least.component_id as kept
from documents join least on documents.doc_id = least.doc_id left join sizes on documents.doc_id = sizes.doc_id
"""
