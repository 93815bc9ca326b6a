"""Operator 11: exact dedup against a persistent index of text digests.

Texts are equal when they are identical after lower-casing A-Z only; a null text counts as empty. The index is a table
bucketed and sorted by the SHA-256 of the normalised text. A batch of documents is reduced to its digests (texts are
read once and never shuffled), its groups are held against the index by a sort-merge anti-join in which only the batch
is shuffled, and what is new is appended as entries; digests that the index has get a row that adds to their entry. One
append holds both, and a small document beside the table names the appends that count: a batch that died half-way is
not among them, and a batch that is added again changes nothing.

Of equal texts the row with the largest doc_id stays, whatever batch brought it; a null doc_id loses to any other, and of
rows that are equal in both, the one met last stays, so exactly one row of a group does. Each row added gives one row,
rows of null doc_id and repeated rows too; other columns are left out. An empty table gives none.
"""

from __future__ import annotations

import uuid
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.llm.graph import keep, shared_folder
from strataflow.sources.readers import json_document
from strataflow.sources.sinks import save_json, write_once


def digest(text: str = "text") -> Column:
    return F.unhex(F.sha2(F.translate(F.coalesce(F.col(text), F.lit("")), ascii_uppercase, ascii_lowercase), 256))


class DigestIndex:
    """The index at path, which all machines must see; it is made if it isn't there. Without buckets, a new one has as
    many as the session has shuffle partitions; later sessions keep its number."""

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark, self.path, self.meta = spark, path, f"{path}/index.json"
        self.state = json_document(spark, self.meta) or {"buckets": buckets or int(spark.conf.get("spark.sql.shuffle.partitions")), "batches": {}}
        self.table = f"digests_{uuid.uuid5(uuid.NAMESPACE_URL, path).hex}"
        columns = "digest binary, keep_id bigint, keep_row bigint, n bigint, batch string"
        spark.sql(f"create table if not exists {self.table} ({columns}) using parquet clustered by (digest) sorted by (digest) into {self.state['buckets']} buckets location '{path}/entries'")
        save_json(spark, self.state, self.meta)

    def entries(self, without: str | None = None) -> DataFrame:
        """Rows of the batches that count, but for one."""
        names = [made for batch, made in self.state["batches"].items() if batch != without]
        return self.spark.table(self.table).where(F.col("batch").isin(names))

    def unseen(self, docs: DataFrame) -> DataFrame:
        """The documents whose text the index doesn't have, with all their columns."""
        return docs.withColumn("__digest", digest()).join(self.entries().select(F.col("digest").alias("__digest")).hint("merge"), "__digest", "left_anti").drop("__digest")

    def add(self, docs: DataFrame, batch: str) -> None:
        """Adds documents under a name of their own."""
        if batch in self.state["batches"]:
            return
        made = f"{batch}-{uuid.uuid4().hex}"
        # Row numbers are written, not computed twice, so that a retried task can't change them.
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest().alias("digest")).withColumn("row", F.monotonically_increasing_id())
        rows = write_once(self.spark, rows, f"{self.path}/rows/batch={made}")
        last = F.max(F.struct("doc_id", "row"))
        groups = rows.groupBy("digest").agg(last.alias("k"), F.count(F.lit(1)).alias("n")).select("digest", F.col("k.doc_id").alias("keep_id"), F.col("k.row").alias("keep_row"), "n", F.lit(made).alias("batch"))
        if int(self.spark.conf.get("spark.sql.shuffle.partitions")) != self.state["buckets"]:
            groups = groups.repartition(self.state["buckets"], "digest")
        groups = keep(groups)  # read by both joins, dealt as the buckets are
        seen = self.entries(batch).select("digest").hint("merge")
        new, more = (groups.join(seen, "digest", how) for how in ("left_anti", "left_semi"))
        new.unionByName(more).select("digest", "keep_id", "keep_row", "n", "batch").write.insertInto(self.table)
        self.state["batches"][batch] = made
        save_json(self.spark, self.state, self.meta)
        self.spark.catalog.refreshTable(self.table)

    def decisions(self) -> DataFrame:
        """doc_id, keep_id, group_size, kept, text_sha256 of every row of every batch."""
        # Without a shuffle, since the buckets hold a digest's rows together. What is left has one row a repeated text;
        # as a written table both sides of the next join are plain shuffles, of which Spark splits hot keys.
        groups = self.entries().groupBy("digest").agg(F.max(F.struct("keep_id", "batch", "keep_row")).alias("k"), F.sum("n").alias("n")).where("n > 1")
        groups = write_once(self.spark, groups, f"{self.path}/groups-{uuid.uuid4().hex}")
        names = list(self.state["batches"].values())
        rows = self.spark.read.schema("doc_id long, digest binary, row long, batch string").parquet(f"{self.path}/rows") if names else self.spark.createDataFrame([], "doc_id long, digest binary, row long, batch string")
        both = rows.where(F.col("batch").isin(names)).join(groups, "digest", "left")
        kept = F.col("n").isNull() | ((F.col("batch") == F.col("k.batch")) & (F.col("row") == F.col("k.keep_row")))
        return both.select("doc_id", F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("k.keep_id")).alias("keep_id"), F.coalesce("n", F.lit(1)).cast("long").alias("group_size"), kept.alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def arrivals(docs: DataFrame) -> list[tuple[str, DataFrame]]:
    """docs as two batches, the lower half of the range of ids and the rest, as a growing table would bring them."""
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    first = F.coalesce(F.col("doc_id") <= (low + high) // 2, F.lit(False)) if low is not None else F.lit(False)
    return [("first", docs.where(first)), ("second", docs.where(~first))]


def exact_dedup(spark: SparkSession, batches: list[tuple[str, DataFrame]], path: str | None = None) -> DataFrame:
    """The decisions on all batches, added in order to the index at path, or to a new one in the shared folder."""
    index = DigestIndex(spark, path or f"{shared_folder(spark)}/digests-{uuid.uuid4().hex}")
    for name, docs in batches:
        index.add(docs, name)
    return index.decisions()


ORACLE = f"""
with own as (select doc_id, translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}') as t from documents)
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
  row_number() over (partition by t order by doc_id desc nulls last) = 1 as kept, sha256(t) as text_sha256
from own window same as (partition by t)
"""
