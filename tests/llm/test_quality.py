import math
import random
import re
from collections import Counter

import numpy as np
from samples import prose

from tidemark.llm import quality
from tidemark.llm.bpe import vocabulary

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text: str) -> tuple:
    words, seen, covered = WORD.findall(text), Counter(), set()
    for i in range(len(words) - 4):
        seen[tuple(words[i : i + 5])] += 1
    for i in range(len(words) - 4):
        if seen[tuple(words[i : i + 5])] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_counts_and_edges(spark, edges):
    measured = quality.measure(edges, vocabulary("byte_bpe_50k.tiktoken"), vocabulary("piece_bpe_32k.model"))
    texts = {r["doc_id"]: r["text"] or "" for r in edges.collect() if r["doc_id"] is not None}
    rows = [r for r in quality.verdicts(measured).collect()]
    assert len(rows) == edges.count()
    for r in rows:
        if r["doc_id"] is not None:
            found = counts(texts[r["doc_id"]])
            assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == found
            assert r["base_failed"] == (found[0] < 10 or 100 * found[4] > 20 * found[0])
            assert not (r["base_failed"] and r["kept"])


def test_windows_are_exact_where_numbers_do_not_fit():
    ids = np.array([*range(7000), *range(10)])
    assert quality.windows_repeated(ids, 7000).sum() == 12


def test_a_text_outside_its_group_is_rejected(spark):
    rows = [(i, " ".join(f"the word number {(i * 7 + k) % 50} stands here and there in it" for k in range(12)), "en") for i in range(300)]
    rows += [(999, " ".join("ᚐᚑᚒ" + chr(0x16A0 + k) for k in range(60)), "en")]
    measured = quality.measure(spark.createDataFrame(rows, "doc_id long, text string, lang string"), vocabulary("byte_bpe_50k.tiktoken"), vocabulary("piece_bpe_32k.model"))
    measured = measured.withColumn("n_tokens", quality.F.lit(128)).withColumn("n_repeat_words", quality.F.lit(0))  # one size, base rules aside
    kept = {r["doc_id"]: r["kept"] for r in quality.verdicts(measured).collect()}
    assert not kept[999] and all(kept[i] for i in range(300))


def test_junk_among_prose_is_rejected_by_the_method(spark):
    """Through real grouping: encoded bytes and runs of one syllable among prose of several lengths."""
    rng = random.Random(4)
    rows = [(i, prose(i, rng.randrange(60, 400)), "en") for i in range(400)]
    rows += [(1000 + i, " ".join("".join(rng.choice("0123456789abcdefXYZ+/") for _ in range(rng.randrange(30, 90))) for _ in range(40)), "en") for i in range(20)]
    rows += [(2000 + i, " ".join(rng.choice(("la", "lala", "lalala", f"la{k}")) for k in range(rng.randrange(90, 200))), "en") for i in range(5)]
    measured = quality.measure(spark.createDataFrame(rows, "doc_id long, text string, lang string"), vocabulary("byte_bpe_50k.tiktoken"), vocabulary("piece_bpe_32k.model"))
    got = {r["doc_id"]: r for r in quality.verdicts(measured).collect()}
    assert all(got[1000 + i]["reject_reason"] for i in range(20)) and not any(got[1000 + i]["base_failed"] for i in range(20))
    assert sum(got[i]["kept"] or got[i]["base_failed"] for i in range(400)) >= 398


def test_words_together_are_tokenised_as_alone():
    known = quality.fertility(vocabulary("byte_bpe_50k.tiktoken"), vocabulary("piece_bpe_32k.model"))
    for words in (["a", "don't", "日本語", "12'll", "x" * 300, "é,", "..."], ["a　b", "c", " "]):
        packed, ends = known._tokens(words)
        alone = [np.array(known.bytes_bpe.encode_ordinary(f" {w}"), "<u2").tobytes() for w in words]
        assert [packed[a:b] for a, b in zip(ends, ends[1:])] == alone


def test_every_document_meets_a_band(spark):
    def row(i, lang, script, n_tokens, chars=4.0, entropy=None):
        return i, 100, 0, n_tokens, chars, 0.0, entropy or 0.8 * math.log2(n_tokens), lang, script

    rows = [row(i, "en", "latin", 100) for i in range(300)] + [row(300 + i, "de", "latin", 300) for i in range(20)]
    rows += [row(900, "en", "latin", 9000), row(901, "en", "latin", 9000, chars=40.0), row(902, "en", "latin", 9000, entropy=1.0)]
    rows += [row(903, "de", "latin", 300, chars=40.0), row(904, "xx", "greek", 50, chars=40.0), row(905, "xx", "greek", 50)]
    schema = "doc_id long, n_words long, n_repeat_words long, n_tokens long, chars_per_token double, byte_share double, entropy double, lang string, script string"
    got = {r["doc_id"]: r["reject_reason"] for r in quality.verdicts(spark.createDataFrame(rows, schema)).collect()}
    assert {d: r for d, r in got.items() if r} == {901: "chars_per_token", 902: "entropy", 903: "chars_per_token", 904: "chars_per_token"}
    few = spark.createDataFrame(rows[:30] + rows[-6:], schema)
    assert {r["doc_id"] for r in quality.verdicts(few).collect() if r["reject_reason"]} == {901, 902, 903, 904}


def test_no_rows(spark, nothing):
    assert quality.verdicts(quality.measure(nothing, vocabulary("byte_bpe_50k.tiktoken"), vocabulary("piece_bpe_32k.model"))).count() == 0
