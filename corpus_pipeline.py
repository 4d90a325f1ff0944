"""A training corpus from raw documents: five stages, each on all that the one before has kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which ``run``
writes to the shared folder and rereads as the next stage's documents. All but the last return the columns of
``documents``. Rows without ``doc_id`` and null texts pass through every stage that does not reject them by rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custofold.llm import bpe, decontam, forest, langid, lines
from custofold.llm.common import in_fold, stored
from custofold.llm.queries import table, tokenizer_file

#: Documents whose best language has less than this share of the likelihood are no one language's.
LEAST_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of some learned language go on: those without a letter, and those that no language fits best, go."""
    trees = langid.train(docs.where(~in_fold("doc_id", 3, 1)))
    judged = langid.predict(docs, trees)
    return judged.where((F.col("lang_pred") != langid.UNDECIDED) & (F.col("score") >= LEAST_SCORE)).select(*docs.columns)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of 40 characters that five documents hold stay in one; ``n_chars`` is counted anew where a line went."""
    bitmaps = lines.line_bitmaps(docs, 40, 5)
    changed = F.col("n_dropped") > 0
    text = F.when(changed, lines.keep_lines(F.col("text"), F.col("keep"))).otherwise(F.col("text"))
    out = bitmaps.withColumn("text", text)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(changed, F.char_length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies goes on: five-word shingles, similarity 0.8 or more."""
    return forest.dedup(docs, words=5, percent=80)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item go on."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, the ids of its text and how many there are."""
    made = bpe.encode_documents(docs.select("doc_id", "text"), tokenizer_file())
    return made.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("language_id", language),
    ("line_dedup", repeated_lines),
    ("minhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontaminated),
    ("bpe", encoded),
]

#: Language models and tokenizers are beyond SQL; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
