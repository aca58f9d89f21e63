"""Quality rules from tokeniser fertility.

Base rules count words, symbols, repeated lines and repeated 5-word windows. The method then asks how public vocabularies
take the text: characters of words for each token of a byte-level BPE vocabulary, the share of byte-fallback pieces of a
second vocabulary, and the entropy of the text's tokens in bits. Every document is measured; over all of them each group
(language, else script, and power of two of the number of tokens, as entropy grows with length) gets its band: ``FENCE``
interquartile ranges, at least ``SLACK``, outside the quartiles. A document outside a band of its group is rejected. Where a
group has fewer than ``SUPPORT`` documents, the band is that of the language (else script) at all lengths, then of the script,
then of all documents, whatever their number; entropy's quartiles are taken there for each bit of the number of tokens.

Nulls: a null text has no words, fails the base rules and has null measures, as have texts without words; a null lang is
replaced by the script of most letters. Repeated rows count each. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.bpe import Recent, vocabulary
from tidemark.llm.common import as_bytes, cut, slices, table

WINDOW = 5
FENCE, SUPPORT = 4.0, 200
#: The least distance of a band's ends from the quartiles, for each measure.
SLACK = {"chars_per_token": 0.75, "byte_share": 0.05, "entropy": 0.75}
#: What bands are taken by, the finest first.
LEVELS = (("band_of", "band_size"), ("band_of",), ("band_script",), ())
SYMBOLS = b"#*$%&|<>"
WHITE = b" \t\n\x0b\x0c\r"

#: First code points of Unicode blocks, and the script of what follows.
BLOCKS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"), (0x0900, "indic"),
    (0x0E00, "thai"), (0x0E80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"),
    (0x3040, "japanese"), (0x3100, "other"), (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "other"), (0x20000, "han"), (0x30000, "other"),
]
COLUMNS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_tokens long, chars_per_token double, byte_share double, entropy double, script string"


def windows_repeated(ids: np.ndarray, distinct: int) -> np.ndarray:
    """Which windows of WINDOW ids occur twice or more: exact, by ranks of ever longer windows where their numbers would not fit in 64 bits."""
    if max(distinct, 2) ** WINDOW < 2**62:
        key = np.zeros(len(ids) - WINDOW + 1, np.int64)
        for k in range(WINDOW):
            key = key * distinct + ids[k : len(key) + k]
    else:
        key = ids[: len(ids) - WINDOW + 1].astype(np.int64)
        for k in range(1, WINDOW):
            key = np.unique(key, return_inverse=True)[1] * np.int64(distinct) + ids[k : len(key) + k]
    _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
    return count[inverse] > 1


def base_counts(text: bytes, words: list[bytes]) -> tuple[int, int, int, int, np.ndarray]:
    """word_chars, n_symbols, n_dup_lines, n_repeat_words, and for each word the number of its first place among the distinct ones."""
    white = len(text) - len(text.translate(None, WHITE))
    points = len(text) - int(np.count_nonzero((np.frombuffer(text, np.uint8) & 0xC0) == 0x80)) if not text.isascii() else len(text)
    lines = [x for x in text.split(b"\n") if x.strip(WHITE)]
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    repeated = 0
    if len(words) > WINDOW and len(number) < len(words):
        again = windows_repeated(ids, len(number))
        if again.any():
            edge = np.zeros(len(words) + 1, np.int64)
            np.add.at(edge, np.flatnonzero(again), 1)
            np.add.at(edge, np.flatnonzero(again) + WINDOW, -1)
            repeated = int(np.count_nonzero(np.cumsum(edge) > 0))
    return points - white, len(text) - len(text.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeated, ids


class Fertility:
    """Tokens of words in the two vocabularies, kept for words that come again."""

    def __init__(self, ranks: str, pieces: str):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        with open(ranks, "rb") as file:
            mergeable = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.bytes_bpe = tiktoken.Encoding("byte-level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=mergeable, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.is_byte = np.array([self.pieces.is_byte(i) for i in range(self.pieces.vocab_size())])
        self.spaced = np.zeros(1 << 16, bool)
        self.spaced[[i for token, i in mergeable.items() if token.startswith(b" ")]] = True
        self.words = Recent()

    def _tokens(self, texts: list[str]) -> tuple[bytes, list[int]]:
        """Tokens of the words, each behind a space, and where in these bytes each word's begin and the last one's end."""
        encode = self.bytes_bpe.encode_ordinary
        if all(map(str.isprintable, texts)):
            # without other white space a word's first token alone starts with the space: all go in one call
            tokens = np.array(encode(f" {' '.join(texts)}"), "<u2")
            starts = np.flatnonzero(self.spaced[tokens])
            if len(starts) == len(texts):
                return tokens.tobytes(), [*(2 * starts).tolist(), 2 * len(tokens)]
        lists = [encode(f" {t}") for t in texts]
        return np.fromiter(chain.from_iterable(lists), "<u2").tobytes(), (2 * np.cumsum([0, *map(len, lists)])).tolist()

    def _measure(self, words: list[bytes]) -> list[tuple[bytes, int, int]]:
        """For each word its tokens, the number of its pieces and of those that are bytes."""
        texts = [w.decode("utf-8", "replace") for w in words]
        packed, ends = self._tokens(texts)
        pieces = self.pieces.encode(texts, num_threads=1)
        bounds = np.cumsum([0, *map(len, pieces)])
        is_byte = self.is_byte[np.fromiter(chain.from_iterable(pieces), np.int64, int(bounds[-1]))]
        n_bytes = np.diff(np.concatenate([[0], np.cumsum(is_byte)])[bounds])
        return [(packed[a:b], n, m) for a, b, n, m in zip(ends, ends[1:], np.diff(bounds).tolist(), n_bytes.tolist())]

    def of(self, documents: list[list[bytes]]) -> list[tuple[int, float | None, float | None]]:
        """Of the words of each document: number of tokens, share of byte pieces, entropy of the tokens; without words the last two are null."""
        flat = list(chain.from_iterable(documents))
        distinct = dict.fromkeys(flat)
        parts = self.words.get_distinct(list(distinct), self._measure)
        number = dict(zip(distinct, range(len(distinct)), strict=True))
        ids = np.fromiter(map(number.__getitem__, flat), np.int64, len(flat))
        size = np.fromiter((len(p[0]) for p in parts), np.int64, len(parts)) // 2
        first, packed = np.cumsum(size) - size, np.frombuffer(b"".join([p[0] for p in parts]), "<u2")
        bounds = np.cumsum([0, *map(len, documents)])
        pieces, in_bytes, tokens = (np.concatenate([[0], np.cumsum(x[ids])])[bounds] for x in (*(np.fromiter((p[k] for p in parts), np.int64, len(parts)) for k in (1, 2)), size))
        # all tokens of all documents, told apart by the document's number above them
        count = size[ids]
        ends = np.cumsum(count)
        spread = packed[np.repeat(first[ids] - ends + count, count) + np.arange(ends[-1] if len(ends) else 0)].astype(np.int64)
        n = np.diff(tokens)
        key, times = np.unique(np.repeat(np.arange(len(documents)), n) << 16 | spread, return_counts=True)
        share = times / n[key >> 16]
        entropy = np.bincount(key >> 16, -share * np.log2(share), len(documents))
        by_bytes = np.diff(in_bytes) / np.maximum(1, np.diff(pieces))
        return [(t, b, e) if words else (0, None, None) for words, t, b, e in zip(documents, n.tolist(), by_bytes.tolist(), entropy.tolist(), strict=True)]


@lru_cache(1)
def fertility(ranks: str, pieces: str) -> Fertility:
    return Fertility(ranks, pieces)


def script_of(text: bytes) -> str | None:
    """Script of most letters."""
    if text.isascii():
        return "latin" if any(65 <= b <= 90 or 97 <= b <= 122 for b in text) else None
    codes, count = np.unique(np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le"), "<u4"), return_counts=True)
    letter = np.array([chr(c).isalpha() for c in codes.tolist()], bool)
    codes, count = codes[letter], count[letter]
    if not len(codes):
        return None
    kinds = np.bincount(np.searchsorted([b for b, _ in BLOCKS], codes, "right") - 1, count, len(BLOCKS)).astype(np.int64)
    total: dict[str, int] = {}
    for (_, name), n in zip(BLOCKS, kinds.tolist(), strict=True):
        total[name] = total.get(name, 0) + n
    return max(sorted(total), key=total.get)


def measure(docs: DataFrame, ranks: str, pieces: str) -> DataFrame:
    """doc_id, lang and the counts and measures of every text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = fertility(ranks, pieces)
        for batch in batches:
            texts = batch["text"].tolist()
            for first, last in slices(texts):
                rows, split = [], [text.split() for text in texts[first:last]]
                for text, words, (n, share, entropy) in zip(texts[first:last], split, known.of(split), strict=True):
                    chars, symbols, lines, repeated, _ = base_counts(text, words)
                    rows.append((len(words), chars, symbols, lines, repeated, n, chars / n if n else None, share, entropy, script_of(text)))
                out = pd.DataFrame(rows, columns=[c.split()[0] for c in COLUMNS.split(", ")])
                out.insert(0, "lang", batch["lang"].iloc[first:last].to_numpy())
                out.insert(0, "doc_id", batch["doc_id"].iloc[first:last].to_numpy())
                yield out

    keyed = docs.select(F.col("doc_id").cast("string").alias("doc_id"), as_bytes().alias("text"), F.col("lang").cast("string").alias("lang"))
    return keyed.mapInPandas(run, f"doc_id string, lang string, {COLUMNS}").withColumn("doc_id", F.col("doc_id").cast("long"))


def verdicts(measured: DataFrame) -> DataFrame:
    """measured with base_failed, kept, and reject_reason (the first band it is outside of)."""
    group = F.coalesce("lang", "script", F.lit("none")).alias("band_of")
    size = F.floor(F.log2("n_tokens")).alias("band_size")
    bits = F.greatest(F.log2("n_tokens"), F.lit(1.0))
    measured = measured.withColumns({"band_of": group, "band_size": size, "band_script": F.coalesce("script", F.lit("none")), "bits": bits})
    joined, found = measured, []
    for k, keys in enumerate(LEVELS):
        per = F.col("bits") if k else F.lit(1.0)  # only the first level holds texts of about one length
        quartiles = [F.percentile_approx(F.col(m) / per if m == "entropy" else F.col(m), F.array(F.lit(0.25), F.lit(0.75)), 2000).alias(f"{m}_q") for m in SLACK]
        bands = measured.where("n_tokens > 0").groupBy(*keys).agg(F.count("*").alias("support"), *quartiles)
        if keys:
            bands = bands.where(F.col("support") >= SUPPORT)
        bands = cut(bands.select(*keys, F.struct(*(f"{m}_q" for m in SLACK)).alias(f"band_{k}")), "op4-bands")  # of known size: Spark broadcasts it only if small
        joined = joined.join(bands, list(keys), "left") if keys else joined.crossJoin(bands)
        held = {m: F.col(f"band_{k}")[f"{m}_q"] for m in SLACK}
        held["entropy"] = F.array(held["entropy"][0] * per, held["entropy"][1] * per)
        found.append(F.when(F.col(f"band_{k}").isNotNull(), F.struct(*(q.alias(m) for m, q in held.items()))))
    joined = joined.withColumn("quartiles", F.coalesce(*found))
    ends = {}
    for m, slack in SLACK.items():
        low, high = F.col("quartiles")[m][0], F.col("quartiles")[m][1]
        reach = F.greatest((high - low) * FENCE, F.lit(slack))
        ends[m] = (low - reach, high + reach)
    reason = F.coalesce(*(F.when((F.col(m) < ends[m][0]) | (F.col(m) > ends[m][1]), F.lit(m)) for m in SLACK))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    judged = joined.withColumns({"base_failed": failed, "reject_reason": F.when(~failed, reason)})
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("reject_reason").isNull())


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict for every document."""
    measured = measure(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.tiktoken"), vocabulary("piece_bpe_32k.model"))
    judged = verdicts(cut(measured, "op4-measures"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judged.select("doc_id", *counts, "n_tokens", "chars_per_token", "byte_share", "entropy", "reject_reason")
