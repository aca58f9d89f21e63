import hashlib
import random
import re

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from samples import edge_rows, prose
from test_lines import brute as brute_lines
from test_neardup import brute as brute_components
from tokenizers import Tokenizer

from tidemark.llm import bpe, langid


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("tables"))
    rows = [r[:5] for r in edge_rows()] + [(200 + i, prose(300 + i, 40), "en", "t", 1) for i in range(30)]
    rows += [(300, f"{prose(400, 30)}. {prose(900, 30)}. {prose(401, 30)}", "en", "t", 1), (301, "12 34 --", "en", "t", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(1, prose(900, 30))], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return at


def test_stages_keep_columns_and_take_effect(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    left = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        left[name] = {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert not left["language_id"] & {1, 2, 3, 301} and {4, 5, 6, 7, 300} <= left["language_id"]
    assert not left["line_dedup"] & {6} and {5, 7, 11, 12} <= left["line_dedup"]
    assert 5 in left["near_dedup"] and 7 not in left["near_dedup"]
    assert 300 not in left["decontamination"] and left["near_dedup"] - left["decontamination"] == {300}
    assert set(range(200, 230)) <= left["decontamination"]


def test_run_encodes_what_is_left(spark, folder):
    rows = {r["doc_id"]: r for r in corpus_pipeline.run(spark, folder).collect()}
    library = Tokenizer.from_file(bpe.vocabulary("byte_bpe_50k.json"))
    text = prose(305, 40)
    ids = library.encode(text, add_special_tokens=False).ids
    assert rows[205]["n_tokens"] == len(ids) and rows[205]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert rows[205]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_no_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").where(F.lit(False))
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        assert docs.count() == 0


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Documents with shared lines, near and exact copies, benchmark passages in several forms, other languages, and noise."""
    at, rng = str(tmp_path_factory.mktemp("corpus")), random.Random(12)
    pool = [prose(5000 + k, 9) for k in range(6)]
    rows, items = [], {k: prose(900 + k, 30) for k in range(4)}
    for d in range(120):
        lines = [prose(100 * d + k, rng.randrange(6, 14)) for k in range(rng.randrange(1, 6))]
        if rng.random() < 0.4:
            lines.insert(rng.randrange(len(lines) + 1), rng.choice(pool))
        if rng.random() < 0.1:
            lines.append(rng.choice((str.upper, str))(rng.choice(list(items.values()))))
        rows.append((d, "\n".join(lines), "en", "s", 0))
    for d in range(120, 150):
        words = rows[rng.randrange(120)][1].replace("\n", " ").split()
        if rng.random() < 0.7:
            words[rng.randrange(len(words))] = "other"
        rows.append((d, " ".join(words), "en", "s", 0))
    rows += [(200 + k, " ".join(rng.choice("der die das und nicht haus mutter vater wasser".split()) for _ in range(40)), "de", "s", 0) for k in range(40)]
    rows += [(300, None, "en", "s", 0), (301, "", "en", "s", 0), (302, "1 2 3 4 -- 5", "en", "s", 0), (303, rows[3][1], None, "s", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(list(items.items()), "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return at, items


def test_every_stage_equals_plain_python(spark, corpus):
    """Each stage on what the stages before it left, against a version without Spark."""
    at, items = corpus
    docs = spark.read.parquet(f"{at}/documents.parquet")
    rows = lambda df: {r["doc_id"]: r["text"] for r in df.collect()}
    before = rows(docs)
    # language: the model that was learned, asked document by document
    model = langid.fit(docs.select("doc_id", "text", "lang"))
    expected = set()
    for d, text in before.items():
        x, lettered = langid.features([text or ""])
        lang, score = model.predict(x)
        if lettered[0] and lang[0] != langid.UNDETERMINED and score[0] >= corpus_pipeline.LEAST_SCORE:
            expected.add(d)
    stages = dict(corpus_pipeline.STAGES)
    docs = stages["language_id"](spark, docs, at)
    left = rows(docs)
    assert set(left) == expected and len(expected) < len(before)
    # lines: every pair of documents
    told = {d: t for d, t in brute_lines(list(left.items())).items() if t == left[d] or t.split()}
    docs = stages["line_dedup"](spark, docs, at)
    assert rows(docs) == told and told != left
    # near copies: every pair of documents
    component = brute_components(list(told.items()), corpus_pipeline.SHINGLE)
    docs = stages["near_dedup"](spark, docs, at)
    kept = rows(docs)
    assert set(kept) == {d for d, c in component.items() if c == d} and len(kept) < len(told)
    # benchmark: at least half of an item's windows of eight words stand in the document, in either case
    windows = lambda t: [tuple(w) for w in zip(*([x for x in re.findall(r"[a-z]+", t.lower())][k:] for k in range(8)))]
    dirty = {d for d, t in kept.items() for i in items.values() if 2 * sum(w in set(windows(t)) for w in windows(i)) >= len(windows(i))}
    docs = stages["decontamination"](spark, docs, at)
    assert set(rows(docs)) == set(kept) - dirty and dirty
    library = Tokenizer.from_file(bpe.vocabulary("byte_bpe_50k.json"))
    got = {r["doc_id"]: (r["n_tokens"], r["decoded_sha256"]) for r in corpus_pipeline.run(spark, at).collect()}
    assert got == {d: (len(library.encode(t, add_special_tokens=False).ids), hashlib.sha256(t.encode()).hexdigest()) for d, t in rows(docs).items()}
