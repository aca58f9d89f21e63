import random
import zlib

import numpy as np

from tidemark.llm import langid

SYLLABLES = {
    "en": "the th ing er and of tion is wh ou ly ed", "de": "sch ein ung ich keit der und ge ver tz ö ü", "fr": "eau le tion eux ê é ou ç la des que ier",
    "es": "ción ar os la el ñ ue ie do que á es", "xx": "ka ro mi tu sa ne lo wi zu",
}


def text(lang: str, seed: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(SYLLABLES[lang].split()) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(3, 40)))


def test_held_out_accuracy(spark):
    rows = [(i, text(lang, i), lang, "s") for i, lang in enumerate(random.Random(0).choices(sorted(SYLLABLES), k=900))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string").repartition(4)
    model = langid.fit(docs, per_language=80)
    assert model.languages == {"germanic": ["de", "en"], "romance": ["es", "fr"], "xx": ["xx"]}
    assert langid.training_sample(docs, 80).groupBy("lang").count().agg({"count": "max"}).first()[0] <= 80
    got = langid.predict(docs, model).where(langid.held_out(langid.F.col("doc_id"))).collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in got) and len(got) > 100
    assert np.mean([r["lang_pred"] == r["lang"] for r in got]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_the_label_of_a_row_does_not_matter(spark):
    rows = [(i, text(lang, i), lang) for i, lang in enumerate(["en", "fr"] * 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs)
    plain = {r["doc_id"]: r["lang_pred"] for r in langid.predict(docs, model).collect()}
    other = docs.withColumn("lang", langid.F.lit("zz"))
    assert {r["doc_id"]: r["lang_pred"] for r in langid.predict(other, model).collect()} == plain


def test_edges(spark, edges, nothing):
    model = langid.fit(edges)
    rows = langid.predict(edges, model).collect()
    assert len(rows) == edges.count()
    assert {r["doc_id"] for r in rows if r["lang_pred"] == "und"} == {1, 2, 3} and all(r["score"] == 0 for r in rows if r["lang_pred"] == "und")
    assert {r["lang_pred"] for r in rows} == {"und", "en"}
    assert langid.predict(nothing, model).count() == 0
    none = langid.fit(nothing)
    assert {r["lang_pred"] for r in langid.predict(edges, none).collect()} == {"und"}


def test_a_column_of_many_languages_is_bounded(spark, monkeypatch):
    """A dirty column: what reaches the driver is bounded, and the frequent languages are learned as before."""
    monkeypatch.setattr(langid, "MOST_LANGUAGES", 3)
    monkeypatch.setattr(langid, "MOST_ROWS", 60)
    rows = [(i, f"the house of the father and the mother number {i}", "en") for i in range(200)]
    rows += [(1000 + i, f"das haus des vaters und der mutter nummer {i}", "de") for i in range(150)] + [(5000 + i, f"x{i} y", f"dirt{i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sample = langid.training_sample(docs).groupBy("lang").count().collect()
    assert len(sample) <= 3 and sum(r["count"] for r in sample) <= 60
    model = langid.fit(docs)
    got = langid.predict(spark.createDataFrame([(1, "the father and the house"), (2, "der vater und das haus")], "doc_id long, text string"), model).collect()
    assert [r["lang_pred"] for r in sorted(got, key=lambda r: r["doc_id"])] == ["en", "de"]
