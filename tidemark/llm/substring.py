"""Substring dedup by recompression: words of a repeated window of WINDOW words are removed but for its first place.

Each text is parsed in rounds. A round first names maximal runs of one symbol, then pairs of neighbours whose left one falls in
the left and whose right one falls in the right half of the alphabet. Names are hashes of what they stand for and the halves
are hashes of names, so all partitions of all tasks agree on them without a table of names, and equal substrings get equal
symbols wherever they stand, but for some at their edges. How far a symbol depends on its surroundings is carried along: its
context. A window's anchor is the symbol of least name among those of the highest round whose context lies within the window;
equal windows have equal anchors, and neighbouring ones mostly share theirs. ROUNDS is such that nearly every window holds some
symbols of the last round: after more rounds contexts outgrow the window, after fewer a symbol says too little. Spark counts the
anchors (name and context) of the corpus; windows whose anchor is unique are unique. The windows in a row that share an
anchor form a block. Of equal blocks all but the first are covered as a whole, which settles copies and the inside of long
repeats. First blocks that share their anchor with other blocks are verified window by window: these are hashed in 128 bits,
Spark finds the first place of each, and the later places are covered.

Nulls: a null text has no words; a row without doc_id is neither compared nor changed. Rows that share a doc_id are one
document and must share its text. Fewer than WINDOW words make no window. An empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import GOLDEN, as_bytes, cut, drop_cut, hash_words, mix, range_hashes, release, slices, table

WINDOW, ROUNDS = 20, 3


def recompress(names: np.ndarray, doc: np.ndarray, first: np.ndarray, last: np.ndarray, rounds: int = ROUNDS) -> list[tuple[np.ndarray, ...]]:
    """Symbols after each round, the words themselves first: name, start, end, start and end of the context.

    names: of the words of all texts one after the other; doc: number of each word's text; first, last: bounds of each text.
    A context that depends on an end of the text reaches beyond it, so that no window holds it.
    """
    words, start = names, np.arange(len(names))
    end, low, high = start + 1, start.copy(), start + 1
    levels = [(names, start, end, low, high)]
    for r in range(rounds):
        # runs
        edge = np.ones(len(names), bool)
        edge[1:] = (names[1:] != names[:-1]) | (doc[1:] != doc[:-1])
        head = np.flatnonzero(edge)
        tail = np.append(head[1:], len(names)) - 1
        length = (tail - head + 1).astype(np.uint64)
        begins, ends = start[head] == first[doc[head]], end[tail] == last[doc[head]]
        # a run ends where another symbol follows; where its nearest word already tells it apart, no more of it is context
        by_word = words[np.maximum(start[head] - 1, 0)] != words[end[head] - 1]
        new_low = np.where(by_word, np.minimum(low[head], start[head] - 1), low[np.maximum(head - 1, 0)])
        new_low = np.where(begins, first[doc[head]] - 1, new_low)
        by_word = words[np.minimum(end[tail], len(words) - 1)] != words[start[tail]]
        new_high = np.where(by_word, np.maximum(high[tail], end[tail] + 1), high[np.minimum(tail + 1, len(names) - 1)])
        new_high = np.where(ends, last[doc[head]] + 1, new_high)
        names = np.where(length > 1, mix(names[head] * GOLDEN + length), names[head])
        start, end, low, high, doc = start[head], end[tail], new_low, new_high, doc[head]
        # pairs
        right = (mix(names + np.uint64(r + 1)) & np.uint64(1)).astype(bool)
        joins = np.zeros(len(names), bool)
        joins[:-1] = ~right[:-1] & right[1:] & (doc[1:] == doc[:-1])
        taken = np.zeros(len(names), bool)
        taken[1:] = joins[:-1]
        before, after = np.maximum(np.arange(len(names)) - 1, 0), np.minimum(np.arange(len(names)) + 1, len(names) - 1)
        new_low = np.where(right & ~taken, np.where(start == first[doc], first[doc] - 1, low[before]), low)
        new_high = np.where(joins, high[after], np.where(~right, np.where(end == last[doc], last[doc] + 1, high[after]), high))
        pair = mix(mix(names) * GOLDEN + names[after])
        keep = ~taken
        names, end = np.where(joins, pair, names)[keep], np.where(joins, end[after], end)[keep]
        start, low, high, doc = start[keep], new_low[keep], new_high[keep], doc[keep]
        levels.append((names, start, end, low, high))
    return levels


def least_between(names: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Where the least name from first to last stands, the leftmost of equals; ranges are shorter than 64."""
    out = np.zeros(len(first), np.int64)
    power = np.frexp((last - first + 1).astype(np.float32))[1] - 1
    best = np.arange(len(names))
    for j in range(int(power.max(initial=0)) + 1):
        own = power == j
        a, b = best[first[own]], best[last[own] - (1 << j) + 1]
        out[own] = np.where(names[b] < names[a], b, a)
        a, b = best[: -(1 << j)], best[1 << j :]
        best = np.where(names[b] < names[a], b, a)
    return out


def anchors(words: np.ndarray, bounds: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, ...]:
    """Anchors of all windows: their hash, the hash of their block's words, the text, its first window with the anchor, the number of such windows."""
    sizes = np.diff(bounds)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    first, last = bounds[:-1], bounds[1:]
    place = np.arange(len(words))
    windows = place[place + window <= last[doc]]
    key, spot = np.zeros(len(words), np.uint64), np.zeros(len(words), np.int64)
    if not len(windows):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), windows, windows, windows
    values, rest = mix(words), windows
    for name, start, _, low, high in recompress(words, doc, first, last)[::-1]:
        k, end = np.searchsorted(low, rest, "left"), np.searchsorted(high, rest + window, "right") - 1
        found = k <= end
        at, k = rest[found], least_between(name, k[found], end[found])
        key[at] = mix(mix(name[k] + GOLDEN * (start[k] - low[k]).astype(np.uint64)) ^ range_hashes(values, low[k], high[k]))
        spot[at] = start[k]
        rest = rest[~found]
        if not len(rest):
            break
    own = key[windows]
    head = np.ones(len(windows), bool)
    head[1:] = (own[1:] != own[:-1]) | (np.diff(spot[windows]) != 0) | (np.diff(windows) != 1)
    at = np.flatnonzero(head)
    begin, count = windows[at], np.diff(np.append(at, len(windows)))
    block = mix(range_hashes(values ^ GOLDEN, begin, begin + count + window - 1) + count.astype(np.uint64))
    return own[at], block, doc[begin], begin - first[doc[begin]], count


def window_hashes(halves: tuple[np.ndarray, np.ndarray], window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """128 bits for each window, by doubling; halves: two independent hashes of each word."""
    out = []
    for words in halves:
        part, size, done, have = mix(words), 1, None, 0
        rest = window
        while rest:
            if rest & 1:
                done = part if done is None else mix(done[: len(part) - have] * GOLDEN + mix(part[have:] if have else part))
                have += size
            rest >>= 1
            if rest:
                part = mix(part[:-size] * GOLDEN + mix(part[size:])) if len(part) > size else part[:0]
                size *= 2
        out.append(done[: max(0, len(words) - window + 1)])
    return out[0], out[1]


def anchor_rows(docs: DataFrame) -> DataFrame:
    """key, block, doc_id, span (first window times 32, plus the number of windows) of every anchor."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, ids = batch["text"].tolist(), batch["doc_id"].to_numpy()
            for begin, stop in slices(texts, 300_000):
                key, block, doc, at, n = anchors(*hash_words(texts[begin:stop]))
                yield pd.DataFrame({"key": key.view(np.int64), "block": block.view(np.int64), "doc_id": ids[begin + doc], "span": at * 32 + n})

    rows = docs.where("doc_id is not null").select("doc_id", as_bytes().alias("text"))
    return rows.mapInPandas(run, "key long, block long, doc_id long, span long")


def starts_of(spans: np.ndarray, n: int) -> np.ndarray:
    """The starts, below n, that the spans hold."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, np.minimum(spans >> 5, n), 1)
    np.add.at(edge, np.minimum((spans >> 5) + (spans & 31), n), -1)
    return np.flatnonzero(np.cumsum(edge)[:n])


def window_rows(texts: DataFrame) -> DataFrame:
    """h1, h2, doc_id, span of the windows that the spans of each text name."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, ids, spans = batch["text"].tolist(), batch["doc_id"].to_numpy(), batch["spans"].tolist()
            for begin, stop in slices(texts, 300_000):
                words, bounds = hash_words(texts[begin:stop])
                a, b = window_hashes((words, hash_words(texts[begin:stop], seed=1)[0]))
                at, own = [np.zeros(0, np.int64)], [0] * (stop - begin)
                for i in range(begin, stop):
                    here = starts_of(np.asarray(spans[i], np.int64), max(0, bounds[i - begin + 1] - bounds[i - begin] - WINDOW + 1))
                    at.append(here + bounds[i - begin])
                    own[i - begin] = len(here)
                at, doc = np.concatenate(at), np.repeat(np.arange(begin, stop), own)
                start = at - bounds[doc - begin]
                yield pd.DataFrame({"h1": a[at].view(np.int64), "h2": b[at].view(np.int64), "doc_id": ids[doc], "span": start * 32 + 1})

    return texts.mapInPandas(run, "h1 long, h2 long, doc_id long, span long")


def first_places(rows: DataFrame, by: list[str], label: str) -> DataFrame:
    """by, first (doc_id, span of the first place), n, written: so Spark can split a hot key of what is joined with it."""
    return cut(rows.groupBy(*by).agg(F.min(F.struct("doc_id", "span")).alias("first"), F.count("*").alias("n")), label)


def later_places(rows: DataFrame, by: list[str], first: DataFrame) -> DataFrame:
    """doc_id, span of all places but the first ones."""
    again = first.where("n > 1").select(*by, "first")
    return rows.join(again, by).where(F.struct("doc_id", "span") != F.col("first")).select("doc_id", "span")


def repeated(rows: DataFrame, label: str) -> DataFrame:
    """Keys of two rows or more."""
    return cut(rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), label)


def covered(docs: DataFrame) -> DataFrame:
    """doc_id, spans: the windows of a document that stand earlier too."""
    spark = docs.sparkSession
    rows = cut(anchor_rows(docs), "op8-anchors")
    blocks = cut(rows.join(repeated(rows, "op8-shared"), "key"), "op8-blocks")
    drop_cut(rows)
    release(spark)
    first = first_places(blocks, ["key", "block"], "op8-first")
    copied = cut(later_places(blocks, ["key", "block"], first), "op8-copied")
    drop_cut(blocks)
    release(spark)
    # first blocks that share their anchor with others are taken apart
    several = first.select("key", "first.*").join(repeated(first, "op8-several"), "key")
    named = cut(several.groupBy("doc_id").agg(F.collect_list("span").alias("spans")), "op8-named")
    windows = cut(window_rows(docs.select("doc_id", as_bytes().alias("text")).join(named, "doc_id")), "op8-windows")
    drop_cut(first)
    release(spark)
    later = later_places(windows, ["h1", "h2"], first_places(windows, ["h1", "h2"], "op8-places"))
    spans = cut(copied.unionByName(later).groupBy("doc_id").agg(F.collect_list("span").alias("spans")), "op8-covered")
    drop_cut(copied)
    drop_cut(windows)
    release(spark)
    return spans


def without_repeats(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and, if asked for, kept: the words left, joined by a space."""
    schema = "doc_id string, n_words long, n_removed long, kept_sha256 string" + ", kept string" * with_text

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text, spans in zip(batch["text"], batch["spans"], strict=True):
                words = text.split()
                n = len(words)
                if spans is not None:
                    gone = np.zeros(n + WINDOW, np.int64)
                    starts = starts_of(np.asarray(spans, np.int64), n)
                    np.add.at(gone, starts, 1)
                    np.add.at(gone, starts + WINDOW, -1)
                    words = [words[k] for k in np.flatnonzero(np.cumsum(gone)[:n] == 0).tolist()]
                kept = b" ".join(words)
                rows.append((n, n - len(words), sha256(kept).hexdigest(), *[kept.decode()] * with_text))
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")[1:]])
            out.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield out

    joined = docs.select("doc_id", as_bytes().alias("text")).join(covered(docs), "doc_id", "left")
    return joined.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(run, schema).withColumn("doc_id", F.col("doc_id").cast("long"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of its repeated windows."""
    return without_repeats(table(spark, sf_dir, "documents"))


OP8_SQL = r"""
with words as (
  select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') as w from documents
), windows as (
  select doc_id, s, list_aggregate(w[s:s + 19], 'string_agg', ' ') as g
  from (select doc_id, w, unnest(range(1, len(w) - 18)) as s from words where len(w) >= 20)
), later as (
  select doc_id, s from (select doc_id, s, row_number() over (partition by g order by doc_id, s) as k from windows) where k > 1
), gone as (
  select distinct doc_id, unnest(range(s, s + 20)) as p from later
), spread as (
  select doc_id, unnest(w) as x, generate_subscripts(w, 1) as p from words
), kept as (
  select spread.doc_id, string_agg(x, ' ' order by spread.p) as t from spread anti join gone on spread.doc_id = gone.doc_id and spread.p = gone.p group by spread.doc_id
), removed as (select doc_id, count(*) as n from gone group by doc_id)
select words.doc_id, cast(len(w) as bigint) as n_words, coalesce(removed.n, 0) as n_removed, sha256(coalesce(kept.t, '')) as kept_sha256
from words left join removed on words.doc_id = removed.doc_id left join kept on words.doc_id = kept.doc_id
"""
