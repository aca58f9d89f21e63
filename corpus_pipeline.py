"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, all but the last with the columns of documents; between
stages rows are written and read again. What goes: texts without a language, repeated lines, near copies, documents that
hold benchmark items; what is left is encoded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontaminate, langid, lines, neardup
from tidemark.llm.common import cut, table
from tidemark.session import shipped

#: Below this score a text is taken for no language that was learned.
LEAST_SCORE = 0.4
SHINGLE, PERCENT = 5, 80
#: Columns that stages add for themselves.
OWN = ("_tidemark_0", "_tidemark_1")

#: SQL has no support vector machines, patience diff or BPE: tests hold the stages against brute force.
ORACLE_SQL = None


@shipped
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a learned language. Where there is nothing to learn from, nothing is rejected but texts without letters."""
    model = langid.fit(docs.select("doc_id", "text", "lang"))
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    lang, score = OWN
    known = langid.predict(docs, model, OWN).where((F.col(lang) != langid.UNDETERMINED) & (F.col(score) >= LEAST_SCORE))
    return known.select(*docs.columns)


@shipped
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier one has too; a document of which no word is left goes."""
    removed = F.col(OWN[1])
    left = lines.without_repeated_lines(docs, OWN)
    left = left.where((removed == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.when(removed > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return left.select(*docs.columns)


@shipped
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies, that of the least doc_id."""
    gone = neardup.near_duplicates(docs, SHINGLE, PERCENT).where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone.hint("merge"), "doc_id", "left_anti").select(*docs.columns)


@shipped
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item was found."""
    found = decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return docs.join(found.hint("merge"), "doc_id", "left_anti").select(*docs.columns)


@shipped
def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    return bpe.encoding_digests(docs, bpe.vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("bpe_encoding", bpe_encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
