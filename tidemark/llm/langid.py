"""Language identification by hierarchical discrimination.

A text's features are the square roots of the shares of its hashed character bigrams and trigrams (letters lower-cased,
all else a space). Linear support vector machines first tell the language family, one against the rest; within the family
one machine for each pair of its languages separates these, and the language with the most support wins. Machines are
fitted by dual coordinate descent on the driver.

Bounds of the fit: the MOST_LANGUAGES languages with most labelled rows, others are not learned; of each at most ``per_language``
labelled rows, and of all MOST_ROWS, those with the lowest hash of doc_id; of each row the whole text and one short piece, so that
short texts are known too. Counting and prediction cover all rows.

Nulls: a text that is null or without a letter gets ``und`` and score 0; a null lang or text is never learned from; a null
doc_id counts as held out. Without labelled rows every text is ``und``. Ties go to the alphabetically first language.
Repeated rows are predicted each; other columns stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.llm.common import slices, table

DIM_BITS = 12
DIM = 1 << DIM_BITS
PER_LANGUAGE, MOST_LANGUAGES, MOST_ROWS = 300, 200, 3000
UNDETERMINED = "und"

#: Families of languages with near relatives, by ISO 639-1 code. A language not listed is its own family.
FAMILIES = {
    "germanic": "af da de en fy is lb nl no nb nn sv",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "uralic": "et fi hu",
    "baltic": "lt lv",
    "turkic": "az kk ky tr uz",
    "indo-aryan": "bn gu hi mr ne pa ur",
    "semitic": "am ar he mt",
    "austronesian": "id jv ms tl",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5, F.lit(0)) == 0


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A row of DIM features for each text, and which texts have a letter."""
    rows, lettered = np.zeros((len(texts), DIM), np.float32), np.zeros(len(texts), bool)
    for i, text in enumerate(texts):
        codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = _letters()[codes]
        lettered[i] = letter.any()
        if not lettered[i]:
            continue
        codes = np.where(letter, codes, np.uint32(32))
        two = codes[:-1] * np.uint32(0x9E3779B1) ^ codes[1:] * np.uint32(0x85EBCA77)
        three = (two[:-1] ^ codes[2:] * np.uint32(0xC2B2AE3D)) * np.uint32(0x27D4EB2F)
        wanted = letter[:-1] | letter[1:]
        count = np.bincount((two * np.uint32(0x2C1B3C6D))[wanted] >> np.uint32(32 - DIM_BITS), minlength=DIM)
        count += np.bincount(three[wanted[:-1]] >> np.uint32(32 - DIM_BITS), minlength=DIM)
        rows[i] = np.sqrt(count / count.sum())
    return rows, lettered


def linear_svm(x: np.ndarray, y: np.ndarray, cost: float = 10.0, rounds: int = 30) -> np.ndarray:
    """Weights (the last one the offset) of a machine for y of -1 or 1: dual coordinate descent for the squared hinge loss, both classes of equal weight."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    bound = np.where(y > 0, (y < 0).mean(), (y > 0).mean()) * 2 * cost
    own = (x * x).sum(1) + 1 / (2 * bound)
    weights, dual = np.zeros(x.shape[1]), np.zeros(len(x))
    order = np.random.default_rng(7)
    for _ in range(rounds):
        for i in order.permutation(len(x)):
            step = max(0.0, dual[i] - (y[i] * (x[i] @ weights) - 1 + dual[i] / (2 * bound[i])) / own[i]) - dual[i]
            if step:
                dual[i] += step
                weights += step * y[i] * x[i]
    return weights.astype(np.float32)


@dataclass
class Model:
    """languages: those learned, by family. families: the machine of each. pairs: the machine of each two of one family, positive for the first."""

    languages: dict[str, list[str]]
    families: dict[str, np.ndarray]
    pairs: dict[tuple[str, str], np.ndarray]

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        x = np.hstack([x, np.ones((len(x), 1), np.float32)])
        support = lambda w: 1 / (1 + np.exp(-3 * (x @ w).astype(float)))
        names = sorted(self.languages)
        family = np.stack([support(self.families[f]) if len(names) > 1 else np.ones(len(x)) for f in names], 1)
        family /= family.sum(1, keepdims=True)
        language, score = np.empty(len(x), object), np.zeros(len(x))
        best = family.argmax(1)
        for k, name in enumerate(names):
            own = self.languages[name]
            total = {a: np.zeros(len(x)) for a in own}
            for a, b in combinations(own, 2):
                p = support(self.pairs[a, b])
                total[a] += p
                total[b] += 1 - p
            share = np.stack([total[a] for a in own], 1) / (len(own) - 1) if len(own) > 1 else np.ones((len(x), 1))
            here = best == k
            language[here] = np.array(own, object)[share.argmax(1)][here]
            score[here] = (family[:, k] * share.max(1))[here]
        return list(language), score.clip(0, 1)


def training_sample(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """doc_id, text, lang of at most per_language rows for each lang, those with the lowest hash; found from the ids alone."""
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    mark = F.xxhash64("doc_id").bitwiseAND(F.lit((1 << 40) - 1)) / float(1 << 40)
    most = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES)
    counts = {r["lang"]: r["count"] for r in most.collect()}
    if not counts:
        return docs.select("doc_id", "text", "lang").limit(0)
    per_language = max(1, min(per_language, MOST_ROWS // len(counts)))
    # a share that leaves about 1.5 times the bound, so that what is ranked stays as small whatever the table's size
    share = F.create_map(*(F.lit(v) for lang, n in counts.items() for v in (lang, min(1.0, 1.5 * per_language / n + 0.01 * (n < 1e5)))))
    ids = labelled.where(mark <= F.coalesce(share[F.col("lang")], F.lit(-1.0))).select("doc_id", "lang", mark.alias("mark"))
    ranked = ids.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("mark", "doc_id"))).where(F.col("rank") <= per_language)
    chosen = ranked.select("doc_id").distinct()
    return labelled.select("doc_id", "text", "lang").join(F.broadcast(chosen), "doc_id", "left_semi")  # at most per_language ids a language


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    def featured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for text, lang in zip(batch["text"], batch["lang"], strict=True):
                at = len(text) // 3
                x, lettered = features([text, text[at : at + 80]])
                yield pd.DataFrame({"lang": lang, "x": [row.tobytes() for row in x[lettered]]})

    rows = training_sample(docs, per_language).mapInPandas(featured, "lang string, x binary").collect()
    rows.sort(key=lambda r: (r["lang"], bytes(r["x"])))
    langs = np.array([r["lang"] for r in rows], object)
    x = np.frombuffer(b"".join(bytes(r["x"]) for r in rows), np.float32).reshape(-1, DIM)
    languages: dict[str, list[str]] = {}
    for lang in sorted(set(langs)):
        languages.setdefault(FAMILY_OF.get(lang.lower(), lang), []).append(lang)
    families = {}
    for family, own in languages.items() if len(languages) > 1 else ():
        families[family] = linear_svm(x, np.where(np.isin(langs, own), 1.0, -1.0))
    pairs = {}
    for own in languages.values():
        for a, b in combinations(own, 2):
            two = np.isin(langs, [a, b])
            pairs[a, b] = linear_svm(x[two], np.where(langs[two] == a, 1.0, -1.0))
    return Model(languages, families, pairs)


def predict(docs: DataFrame, model: Model, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """docs with the language and its score, columns of these names replaced; of its columns only text is read."""
    docs = docs.drop(*names)
    schema = T.StructType([*docs.schema.fields, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())])

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            langs, scores = [], []
            for first, last in slices(texts):
                for at in range(first, last, 1000):  # features of 16 MB at most
                    x, lettered = features(texts[at : min(at + 1000, last)])
                    lang, score = model.predict(x) if model.languages else ([UNDETERMINED] * len(x), np.zeros(len(x)))
                    langs += [name if known else UNDETERMINED for name, known in zip(lang, lettered, strict=True)]
                    scores += np.where(lettered, score, 0.0).tolist()
            columns = [*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, *names])

    return docs.mapInArrow(predicted, schema)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, by a model that has not seen every fifth of them."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.select("doc_id", "text", "lang"))
    return predict(docs.select("doc_id", "text"), model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
