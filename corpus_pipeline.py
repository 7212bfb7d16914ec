"""Training-corpus pipeline: quality, near duplicates, contamination, personal data, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslake.llm.common import table
from corpuslake.llm.decontaminate import contaminated_rows
from corpuslake.llm.near_dups import near_duplicates
from corpuslake.llm.packing import pack_documents
from corpuslake.llm.pii import redact
from corpuslake.llm.quality_forest import keep_good
from corpuslake.operators.skew import skew_join
from corpuslake.session import write_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the isolation forest accept."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every class of near duplicates, that of smallest id (a null id last).

    Rows are told apart by a number of their own, written first: rows that share an id
    are compared each by its text, and one of several equal rows stays.
    """
    row, taken = "_row", set(docs.columns)
    while row in taken:
        row = "_" + row
    at = write_table(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    classes = near_duplicates(at, id_col=row, k=5, percent=80).where("n_shingles > 0") \
        .select(F.col(row).alias("_r"), F.col("component_id").alias("_c"))
    many = write_table(classes.groupBy("_c").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_c"), "classes")
    copies = write_table(skew_join(write_table(classes, "classes"), many, "_c", spread=["_r"]), "copies")
    ids = at.select(F.col(row).alias("_r"), F.col("doc_id").alias("_d")).join(copies, "_r")
    stay = ids.groupBy("_c").agg(F.min(F.struct(F.col("_d").isNull(), "_d", "_r")).alias("_s")).select(F.col("_s._r").alias("_r"))
    gone = copies.join(stay, "_r", "left_anti").select(F.col("_r").alias(row))
    return at.join(gone, row, "left_anti").select(docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return contaminated_rows(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked by its kind."""
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1,024 ids."""
    return pack_documents(docs)


STAGES = [("quality_rules", quality), ("near_dedup", near_dedup), ("decontamination", decontaminate),
          ("pii", personal_data), ("packing", packing)]

#: Forests, expectation-maximisation and tokenizers have no SQL form; tests hold each
#: stage against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written before the next reads them."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
