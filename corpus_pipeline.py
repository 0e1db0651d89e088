"""Corpus pipeline over ``documents``: quality rules, near duplicates, repeated passages, contamination, packing.

Each stage works on all that its predecessor kept. The first four return the
columns of ``documents``; the last returns the packed pieces. Rows are told
apart by id and text, so null ids and repeated ids are judged like any other
row. Extra columns of the input are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candela.llm.common import stored, table, temporary_tables, text_or_empty
from candela.llm.decontamination import contamination
from candela.llm.jaccard_join import jaccard_components
from candela.llm.packing import best_fit_packing
from candela.llm.passages import without_repeated_passages
from candela.llm.quality_rules import quality_rules

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Near duplicates: words of a shingle, and the similarity in hundredths.
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80


def row_key() -> Column:
    """Key of a row by id and text; the order of keys is that of non-negative ids, null ids last."""
    number = F.coalesce(F.lpad(F.col("doc_id").cast("string"), 20, "0"), F.lit("~"))
    return F.concat_ws(":", number, F.xxhash64(text_or_empty()).cast("string"))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the isolation forest accept."""
    judged = quality_rules(docs.select(*COLUMNS), table(spark, sf_dir, "labels"), *COLUMNS)
    return judged.filter("kept").select(*COLUMNS)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one of the smallest id; repeated rows are one document."""
    rows = docs.select(*COLUMNS).withColumn("_key", row_key())
    judged = jaccard_components(rows.select(F.col("_key").alias("doc_id"), "text"), SHINGLE_WORDS, SIMILAR_PERCENT)
    kept = judged.filter(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("_key")).distinct()
    return rows.join(kept, "_key").dropDuplicates(["_key"]).select(*COLUMNS)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of more than 50 words that also stand elsewhere; texts left blank go.

    Words are counted, not bytes: every word goes that stands in a repeated string of 51 words, and shorter repeats stay,
    however many bytes they have.
    """
    rows = docs.select(*COLUMNS).withColumn("_key", row_key())
    cut = without_repeated_passages(rows, "_key", *[c for c in COLUMNS if c not in ("text", "n_chars")])
    rows = cut.withColumn("text", F.col("kept")).withColumn("n_chars", F.length("kept").cast("long"))
    blank = F.trim(F.translate("text", "\n\t\r", "   ")) == ""
    return rows.filter((F.col("n_words_cut") == 0) | ~blank).select(*COLUMNS)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item contaminates."""
    rows = docs.select(*COLUMNS).withColumn("_key", row_key())
    found = contamination(rows.select(F.col("_key").alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    bad = found.filter("contaminated").select(F.col("doc_id").alias("_key")).distinct()
    return rows.join(stored(bad, "contaminated"), "_key", "left_anti").select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents with their sequence and place in it."""
    return best_fit_packing(docs.select("doc_id", "text"))


STAGES = [
    ("quality rules", keep_quality),
    ("n-gram Jaccard join", keep_one_of_near_copies),
    ("suffix-array dedup", cut_repeated_passages),
    ("benchmark decontamination", keep_uncontaminated),
    ("best-fit packing", packed),
]

#: The forest's scores, the word cuts and packing have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with temporary_tables(spark):  # what a stage wrote for itself goes once its result stands
            docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"), keep=True)
    return STAGES[-1][1](spark, docs, sf_dir)
