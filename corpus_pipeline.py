"""A corpus from raw documents to tokens: language ID, line dedup, near-duplicate removal, decontamination, BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; docs has the columns of documents, and all stages but
the last return them. run() writes each stage's result to the shared folder and rereads it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.llm import bpe, decontaminate, jaccard_join, language_id, line_dedup
from strataflow.llm.graph import read, shared_folder
from strataflow.llm.queries import tokenizer_path

#: No SQL: language ID and BPE are not SQL; the run is tested against brute-force stages.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is too far from all centroids for its length go, as do those without text or letters."""
    model = language_id.fit(docs)
    return language_id.predict(docs, model, docs.columns).where(~F.col("rejected")).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of line runs and of lines of over 50 words leave the texts; n_chars follows. Documents that lose
    every line go, and those of null text. Each other row gives one row with its own columns: rows of a null doc_id with
    their text as it is, repeated rows alike, different texts of one doc_id each by themselves."""
    rest = [c for c in docs.columns if c not in ("text", "n_chars")]
    kept = line_dedup.line_dedup(docs, long_words=line_dedup.LONG_WORDS, carry=rest).where("n_kept > 0")
    out = kept.select("carried.*", F.col("text_kept").alias("text"), F.length("text_kept").cast("long").alias("n_chars"))
    return out.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one of smallest doc_id; rows of a null doc_id stay."""
    later = jaccard_join.jaccard_join(docs).where("component_id != doc_id").select("doc_id")
    return docs.join(later, "doc_id", "left_anti").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go, with all rows of their doc_id; rows of a null doc_id stay."""
    found = decontaminate.leaks(docs, read(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti").select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(docs, tokenizer_path())


STAGES = [("language_id", language), ("line_dedup", lines), ("jaccard_join", near_duplicates), ("decontamination", decontamination), ("bpe", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages. A stage's folder goes when the next one is written; the last one's stays."""
    docs, top, last = read(spark, sf_dir, "documents"), f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}", None
    for i, (name, stage) in enumerate(STAGES):
        path = f"{top}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if last:
            folder = spark._jvm.org.apache.hadoop.fs.Path(last)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        last = path
    return docs
