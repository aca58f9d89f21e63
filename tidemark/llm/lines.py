"""Line dedup by pairwise alignment.

Lines with a word are compared; others stay. A line of ``MIN_CHARS`` characters makes a hash of its own; a shorter one is
hashed with its neighbours, as many as it takes to reach ``MIN_CHARS``, once forwards and once backwards. So a frequent short
line alone pairs nothing, and what pairs is rare by its length. Each such run that stands in several documents pairs its
later documents with the first one (least doc_id): pairs grow with the runs, not with the square of a run's documents. Each
pair is aligned by patience diff: lines that stand once in both are matched along a longest increasing sequence, matches grow
over equal neighbours, and the gaps are aligned in the same way. Aligned common blocks of at least ``MIN_CHARS`` characters
are deleted from the later document. What the pair shares in another order is aligned next, run by run.

In sum a line goes if it lies in consecutive lines of at least ``MIN_CHARS`` characters that stand consecutively in an
earlier document too, whichever that is: a block that meets an earlier document holds, for each of its lines, a run of that
line, and the run's first document is no later.

Of a pair only the later document's lines in shared runs travel; the earlier document's lines are sent once for every
``PAIRS`` pairs that it is in, so neither a popular first document nor a long one is copied to each of its pairs.

Nulls: a null text stays null and has no lines; a row without doc_id is neither compared nor changed. Rows that share a
doc_id are one document and should share its text; if they do not, that of the least text is compared for all, and each row
loses lines only where its text is that one. Texts keep what is left, joined by line feeds; a text may become empty. An empty
table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import as_bytes, cut, drop_cut, release, slices, table

MIN_CHARS = 32
#: Pairs of one earlier document for which its lines are sent once.
PAIRS = 100
WHITE = b" \t\n\x0b\x0c\r"


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Pairs of places of aligned equal lines, ascending in both."""
    out, gaps = [], [(0, len(a), 0, len(b))]
    while gaps:
        a0, a1, b0, b1 = gaps.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {line: i for i, line in enumerate(a[a0:a1], a0) if in_a[line] == 1 and in_b.get(line) == 1}
        common = [(place[line], j) for j, line in enumerate(b[b0:b1], b0) if line in place]
        # longest increasing sequence of places in a
        tops, piles, back = [], [], {}
        for k, (i, _) in enumerate(common):
            at = bisect_left(tops, i)
            back[k] = piles[at - 1] if at else -1
            tops[at : at + 1], piles[at : at + 1] = [i], [k]
        chain, k = [], piles[-1] if piles else -1
        while k >= 0:
            chain.append(common[k])
            k = back[k]
        if not chain:
            continue
        ends = [(a0, b0), *((i + 1, j + 1) for i, j in reversed(chain))]
        begins = [*reversed(chain), (a1, b1)]
        out += chain
        gaps += [(i0, i1, j0, j1) for (i0, j0), (i1, j1) in zip(ends, begins, strict=True) if i0 < i1 and j0 < j1]
    return sorted(out)


def runs_of(sizes: list[int], least: int = MIN_CHARS) -> list[tuple[int, int]]:
    """First and last line of the shortest runs of so many characters, from each line forwards and to each line backwards. A line has one at least."""
    total = [0]
    for n in sizes:
        total.append(total[-1] + n)
    found = set()
    for k in range(len(sizes)):
        if (end := bisect_left(total, total[k] + least)) <= len(sizes):
            found.add((k, end - 1))
        if total[k + 1] >= least:
            found.add((bisect_right(total, total[k + 1] - least) - 1, k))
    return sorted(found)


def common_blocks(earlier: list[int], later: list[tuple[int, int, int]], runs: list[tuple[int, int]], least: int = MIN_CHARS) -> set[int]:
    """Numbers of the later document's lines in common blocks of at least so many characters.

    later: number, hash and characters of its lines in shared runs, ascending; runs: first and last line number of each, which
    the earlier document has too, by the hash of their lines.
    """
    gone: set[int] = set()
    aligned = [(i, later[j][0], later[j][2]) for i, j in patience(earlier, [h for _, h, _ in later])]
    begin = 0
    for k in range(1, len(aligned) + 1):
        if k == len(aligned) or aligned[k][:2] != (aligned[k - 1][0] + 1, aligned[k - 1][1] + 1):
            block = aligned[begin:k]
            if sum(size for _, _, size in block) >= least:
                gone.update(number for _, number, _ in block)
            begin = k
    # what stands there in another order: each run that is left, as a block of its own
    for first, end in runs:
        gone.update(range(first, end + 1))
    return gone


def parsed(docs: DataFrame) -> DataFrame:
    """doc_id and of its lines with a word: hashes, sizes (characters), places (among all lines); runs (key, first, last)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, ids = batch["text"].tolist(), batch["doc_id"].to_numpy()
            for begin, stop in slices(texts):
                rows = []
                for doc_id, text in zip(ids[begin:stop], texts[begin:stop], strict=True):
                    lines = text.split(b"\n")
                    places = [k for k, line in enumerate(lines) if line.strip(WHITE)]
                    own = [lines[k] for k in places]
                    sizes = [len(x) if x.isascii() else len(x.decode()) for x in own]
                    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, own), np.uint64, len(own))
                    spans = runs_of(sizes)
                    packed = hashes.tobytes()
                    keys = [xxhash.xxh3_128_digest(packed[8 * a : 8 * b + 8]) for a, b in spans]
                    rows.append((doc_id, hashes.view(np.int64), np.array(sizes, np.int32), np.array(places, np.int32), keys, np.array([a for a, _ in spans], np.int32), np.array([b for _, b in spans], np.int32)))
                yield pd.DataFrame(rows, columns=["doc_id", "hashes", "sizes", "places", "keys", "first", "last"])

    schema = "doc_id long, hashes array<long>, sizes array<int>, places array<int>, keys array<binary>, first array<int>, last array<int>"
    return docs.mapInPandas(run, schema)


def repeated_lines(docs: DataFrame) -> DataFrame:
    """doc_id, gone (places of the lines to delete), digest (of the text they belong to)."""
    spark = docs.sparkSession
    texts = docs.where("doc_id is not null and text is not null").select("doc_id", as_bytes().alias("text"))
    several = cut(texts.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"), "op1-several")
    if not several.isEmpty():
        one = texts.join(several, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))
        texts = texts.join(several, "doc_id", "left_anti").unionByName(one)
    lines = cut(parsed(texts), "op1-lines")
    spans = F.explode(F.arrays_zip("keys", "first", "last")).alias("run")
    runs = lines.select("doc_id", spans).select("doc_id", F.col("run.keys").alias("key"), F.col("run.first").alias("first"), F.col("run.last").alias("last"))
    shared = runs.groupBy("key").agg(F.min("doc_id").alias("earlier"), F.max("doc_id").alias("latest")).where("latest > earlier").drop("latest")
    shared = cut(shared, "op1-shared")  # written first: Spark can then split a hot run of what is joined with it
    found = runs.join(shared, "key").where("doc_id <> earlier").groupBy("earlier", "doc_id").agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("runs"))
    pairs = cut(found, "op1-pairs")
    drop_cut(shared)
    release(spark)

    def align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        earlier = None
        for batch in batches:
            out = []
            for doc_id, number, hashes, sizes, places, first, last in batch.itertuples(index=False):
                if pd.isna(doc_id):
                    earlier = hashes.tolist()
                    continue
                later = {k: (k, h, n) for k, h, n in zip(number.tolist(), hashes.tolist(), sizes.tolist(), strict=True)}
                gone = common_blocks(earlier, [later[k] for k in sorted(later)], list(zip(first.tolist(), last.tolist(), strict=True)))
                at = dict(zip(number.tolist(), places.tolist(), strict=True))
                out.append((int(doc_id), np.array(sorted(at[k] for k in gone), np.int32)))
            yield pd.DataFrame(out, columns=["doc_id", "gone"])

    none = F.array().cast("array<int>")
    # of the later document its lines in the shared runs, of the earlier one all, once for each bucket of its pairs
    number = F.array_distinct(F.flatten(F.transform("runs", lambda r: F.sequence(r["first"], r["last"])))).alias("number")
    of = lambda column: F.transform("number", lambda k: F.get(column, k)).alias(column)
    count = cut(pairs.groupBy("earlier").agg(F.ceil(F.count("*") / PAIRS).cast("int").alias("buckets")), "op1-counts")
    dealt = pairs.join(count, "earlier").withColumn("bucket", F.pmod(F.xxhash64("doc_id"), "buckets").cast("int"))
    later = dealt.join(lines.select("doc_id", "hashes", "sizes", "places"), "doc_id").select("earlier", "bucket", "doc_id", "runs", "hashes", "sizes", "places", number)
    later = later.select(
        "earlier", "bucket", F.col("doc_id").cast("string").alias("doc_id"), "number", of("hashes"), of("sizes"), of("places"),
        F.transform("runs", lambda r: r["first"]).alias("first"), F.transform("runs", lambda r: r["last"]).alias("last"),
    )
    own = count.select(F.col("earlier"), F.explode(F.sequence(F.lit(0), F.col("buckets") - 1)).alias("bucket"))
    own = own.join(lines.select(F.col("doc_id").alias("earlier"), "hashes"), "earlier")
    own = own.select("earlier", "bucket", F.lit(None).cast("string").alias("doc_id"), none.alias("number"), "hashes", none.alias("sizes"), none.alias("places"), none.alias("first"), none.alias("last"))
    # the earlier document's row, without doc_id, comes before those of its pairs
    grouped = own.unionByName(later).repartition("earlier", "bucket").sortWithinPartitions("earlier", "bucket", F.col("doc_id").asc_nulls_first())
    aligned = grouped.select("doc_id", "number", "hashes", "sizes", "places", "first", "last").mapInPandas(align, "doc_id long, gone array<int>")
    gone = aligned.groupBy("doc_id").agg(F.array_distinct(F.flatten(F.collect_list("gone"))).alias("gone"))
    if not several.isEmpty():
        digests = one.select("doc_id", F.sha2("text", 256).alias("digest"))
        gone = gone.join(digests, "doc_id", "left")
    else:
        gone = gone.withColumn("digest", F.lit(None).cast("string"))
    gone = cut(gone, "op1-gone")
    for part in (pairs, lines, count):
        drop_cut(part)
    release(spark)
    return gone


def without_repeated_lines(docs: DataFrame, counts: tuple[str, str] = ("n_lines", "n_removed")) -> DataFrame:
    """docs with the text that is left, and the numbers of lines and of those deleted, named by counts; columns of these names are replaced."""
    named = repeated_lines(docs).select(F.col("doc_id").alias("id"), "gone", "digest")
    # the same plan at every size: what is deleted grows with the documents
    same = (F.col("row.doc_id") == F.col("id")) & (F.col("digest").isNull() | (F.sha2("row.text", 256) == F.col("digest")))
    joined = docs.select(F.struct("*").alias("row")).join(named.hint("merge"), same, "left")
    text, lines = F.col("row.text"), F.col("lines")
    joined = joined.select("row", "gone", F.when(F.col("gone").isNotNull(), F.split(text, "\n")).alias("lines"))
    # by sets of places, so that time is in proportion to the lines
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone"))
    left = F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")
    n_lines = F.when(text.isNull(), F.lit(0)).otherwise(F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long")
    n_removed = F.when(F.col("gone").isNull(), F.lit(0)).otherwise(F.size("gone")).cast("long")
    kept = F.when(F.col("gone").isNull(), text).otherwise(left).alias("text")
    rest = [kept if c == "text" else F.col("row")[c].alias(c) for c in docs.columns if c not in counts]
    return joined.select(*rest, n_lines.alias(counts[0]), n_removed.alias(counts[1]))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: its lines, those deleted, and the digest and length of the text that is left (null: empty)."""
    docs = without_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", "n_lines", "n_removed", F.length(text).cast("long").alias("kept_chars"), F.sha2(text, 256).alias("kept_sha256"))


OP1_SQL = r"""
with split as (select doc_id, string_split(text, chr(10)) as l from documents where text is not null
), lines as (select doc_id, unnest(l) as line, generate_subscripts(l, 1) as p from split
), worded as (
  select doc_id, p, line, length(line) as n, row_number() over d as k, sum(length(line)) over (d rows unbounded preceding) as c
  from lines where regexp_matches(line, '[^\x20\x09-\x0D]') window d as (partition by doc_id order by p)
), reach as (
  select a.doc_id, a.k as s, b.k as e from worded a join worded b on a.doc_id = b.doc_id and b.k between a.k and a.k + 31 and b.c - a.c + a.n >= 32
), runs as (
  select doc_id, s, min(e) as e from reach group by doc_id, s union select doc_id, max(s), e from reach group by doc_id, e
), content as (
  select r.doc_id, r.s, r.e, string_agg(w.line, chr(10) order by w.k) as g
  from runs r join worded w on w.doc_id = r.doc_id and w.k between r.s and r.e group by r.doc_id, r.s, r.e
), first as (select g, min(doc_id) as f from content group by g
), gone as (
  select distinct w.doc_id, w.p from content c join first on c.g = first.g and c.doc_id > first.f
  join worded w on w.doc_id = c.doc_id and w.k between c.s and c.e
), kept as (
  select lines.doc_id, string_agg(line, chr(10) order by lines.p) as t
  from lines anti join gone on lines.doc_id = gone.doc_id and lines.p = gone.p group by lines.doc_id
), removed as (select doc_id, count(*) as n from gone group by doc_id)
select d.doc_id, cast(coalesce(len(split.l), 0) as bigint) as n_lines, coalesce(removed.n, 0) as n_removed,
  cast(length(coalesce(kept.t, '')) as bigint) as kept_chars, sha256(coalesce(kept.t, '')) as kept_sha256
from documents d left join split on d.doc_id = split.doc_id left join kept on d.doc_id = kept.doc_id left join removed on d.doc_id = removed.doc_id
"""
