"""Exact dedup against a persistent digest index.

The index is a table of digests, bucketed and sorted by digest. New data is grouped by
digest first (partial aggregation, so the size of a group of copies does not matter), then
meets the index in a sort-merge anti-join for which the index is not moved, and what is new
is appended.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skylattice.llm.text import SPACE, documents, whole
from skylattice.session import new_folder, settle

BUCKETS = 64


def text_digests(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, text_sha256, form``: the digest of each text without white space.

    A null text counts as empty. ``form`` tells texts apart that differ in white space only.
    Other columns of ``docs`` are ignored.
    """
    text = whole()
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.length(text).cast("long").alias("n_chars"),
        F.sha2(F.regexp_replace(text, SPACE, ""), 256).alias("text_sha256"),
        F.xxhash64(text).alias("form"),
    )


class DigestIndex:
    """Digests seen so far, with the row that stays of each.

    ``path`` is a folder all executors share; opening the same path again continues the
    index, in the same or a later session. The first row kept for a digest stays its
    representative when later batches bring longer texts.
    """

    COLUMNS = "text_sha256 string, keep_id bigint, keep_chars bigint, group_size bigint"

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.table = f"digests_{uuid.uuid5(uuid.NAMESPACE_URL, path).hex}"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} ({self.COLUMNS}) USING parquet "
            f"CLUSTERED BY (text_sha256) SORTED BY (text_sha256) INTO {buckets} BUCKETS "
            f"LOCATION '{path}'"
        )

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def add(self, digests: DataFrame) -> None:
        """Appends the digests that the index does not hold yet.

        Of equal texts the one with the most characters stays, then the smallest id; a
        null id loses against any other.
        """
        best = F.min(F.struct((-F.col("n_chars")).alias("less"), F.col("doc_id").isNull(), "doc_id"))
        groups = digests.groupBy("text_sha256").agg(best.alias("best"), F.count("*").alias("group_size"))
        new = groups.select(
            "text_sha256",
            F.col("best.doc_id").alias("keep_id"),
            (-F.col("best.less")).alias("keep_chars"),
            "group_size",
        ).join(self.rows().select("text_sha256").hint("merge"), "text_sha256", "left_anti")
        (
            new.repartition(self.buckets, "text_sha256")
            .write.mode("append")
            .format("parquet")
            .option("path", self.path)
            .bucketBy(self.buckets, "text_sha256")
            .sortBy("text_sha256")
            .saveAsTable(self.table)
        )

    def resolve(self, digests: DataFrame) -> DataFrame:
        """Each row of ``digests`` with ``keep_id``, ``group_size`` and ``kept``.

        Exactly one row of a group is kept. Rows that repeat an id count as copies: of
        those the longest, then the one of smallest ``form``, can be kept.
        """
        again = Window.partitionBy("doc_id", "text_sha256").orderBy(F.desc("n_chars"), "form")
        return (
            digests.withColumn("turn", F.row_number().over(again))
            .join(self.rows(), "text_sha256")
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("turn") == 1))
            .drop("turn", "form")
        )


def exact_dedup(docs: DataFrame, path: str | None = None, buckets: int = BUCKETS) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256, n_chars``.

    Without ``path`` the index is a fresh one below the shared folder. An empty table gives
    no rows.
    """
    spark = docs.sparkSession
    index = DigestIndex(spark, path or new_folder(spark, "digest-index"), buckets)
    digests = settle(text_digests(docs), "digests")
    index.add(digests)
    return index.resolve(digests).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256", "n_chars"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


SQL = r"""
with d as (
  select doc_id, length(coalesce(text, '')) as n_chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as text_sha256
  from documents),
r as (
  select *, first_value(doc_id) over w as keep_id,
         row_number() over w as turn, count(*) over (partition by text_sha256) as group_size
  from d window w as (partition by text_sha256 order by n_chars desc, doc_id))
select doc_id, keep_id, group_size, turn = 1 as kept, text_sha256, n_chars from r
"""
