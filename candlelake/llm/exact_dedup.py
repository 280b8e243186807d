"""Exact deduplication against a persistent digest index.

The index is a table of one row per distinct text, bucketed and sorted by the text's digest. A batch of new documents is
reduced to one row per digest (partial aggregation first, so that a hot text shrinks before it is shuffled), deduplicated
against the index by a sort-merge anti-join on the digest, and what is new is appended. Of digests that are known already,
the batch's count is appended; readers add the counts up. All of it is DataFrame operations.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SEPARATOR_CLASS, discard, discard_path, free_name, materialise, partitions, scratch_dir, texts

INDEX_SCHEMA = "text_sha256 string, keep_id long, keep_length int, group_size long"


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, length (code points of the text as it is), text_sha256 (of the text without separators, in UTF-8)."""
    plain = F.regexp_replace("text", SEPARATOR_CLASS + "+", "")
    return texts(docs).select("doc_id", F.length("text").alias("length"), F.sha2(plain.cast("binary"), 256).alias("text_sha256"))


def best_rows(rows: DataFrame) -> DataFrame:
    """One row per digest: the longest original text stays, then the smallest doc_id; rows without a doc_id come last."""
    return rows.groupBy("text_sha256").agg(
        F.min_by("doc_id", F.struct(-F.col("length"), F.col("doc_id").isNull(), F.col("doc_id"))).alias("keep_id"),
        F.max("length").alias("keep_length"),
        F.count(F.lit(1)).alias("group_size"),
    )


class DigestIndex:
    """A bucketed and sorted table of known digests.

    append() takes documents and adds the digests that the index doesn't have yet; digests that it has keep their row, so
    an earlier batch wins over a later one. Within a batch the longest text wins, then the smallest doc_id. group_size counts
    the documents of all batches; a batch that is appended twice counts twice. drop() takes the table and its files away.
    """

    def __init__(self, spark: SparkSession, name: str | None = None, buckets: int | None = None, path: str | None = None):
        self.spark, self.buckets = spark, buckets or partitions(spark)
        self.name, self.path = name or f"digest_index_{uuid.uuid4().hex}", path or scratch_dir(spark)
        if not spark.catalog.tableExists(self.name):
            self._write(spark.createDataFrame([], INDEX_SCHEMA))

    def _write(self, rows: DataFrame) -> None:
        (rows.write.mode("append").format("parquet").option("path", self.path).bucketBy(self.buckets, "text_sha256").sortBy("text_sha256").saveAsTable(self.name))

    def table(self) -> DataFrame:
        """One row per digest, read by bucket; rows that only count hold neither keep_id nor keep_length."""
        return self.spark.table(self.name).groupBy("text_sha256").agg(F.max("keep_id").alias("keep_id"), F.max("keep_length").alias("keep_length"), F.sum("group_size").alias("group_size"))

    def append(self, docs: DataFrame) -> None:
        self.append_digests(digests(docs))

    def append_digests(self, rows: DataFrame) -> None:
        best = best_rows(rows).alias("new")
        stored = self.spark.table(self.name)
        known = stored.select("text_sha256").hint("merge").alias("known")
        same = F.col("new.text_sha256") == F.col("known.text_sha256")
        rows = best.join(known, same, "left_anti")
        if not stored.isEmpty():
            again = best.join(known, same, "left_semi")
            rows = rows.unionByName(again.select("text_sha256", F.lit(None).cast("long").alias("keep_id"), F.lit(None).cast("int").alias("keep_length"), "group_size"))
        self._write(rows.repartition(self.buckets, "text_sha256"))

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS `{self.name}`")
        discard_path(self.spark, self.path)


def exact_dedup(docs: DataFrame, index: DigestIndex | None = None, batch_lengths: tuple[int, ...] = (2_000, 0)) -> DataFrame:
    """Every document with the group it belongs to: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical without the characters of ``[\\x20\\x09-\\x0D]``; null counts as empty, and all
    empty texts are one group. Rows that repeat a doc_id count each; of rows equal in text, length and doc_id all are
    marked kept, as are rows without a doc_id in a group that has no others of its length. An empty table gives an empty
    result; extra columns are ignored, whatever their names; texts may have any length.

    Without an index, a new one is filled and dropped again, in batches of falling length (from each of ``batch_lengths``
    code points on): so the row that stays, which is the longest of its group, is in the first batch that has its digest.
    With an index, docs are a further batch of it: keep_id may be of an earlier batch, and group_size counts the documents
    of all batches so far.
    """
    spark = docs.sparkSession
    rows = materialise(digests(docs))  # each text is read and hashed once
    own = index or DigestIndex(spark)
    if index:
        index.append_digests(rows)
    else:
        for low, high in zip(batch_lengths, (None, *batch_lengths)):
            batch = rows.where(F.col("length") >= low)
            own.append_digests(batch if high is None else batch.where(F.col("length") < high))
    found = _with_groups(rows, own).select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
    if index:
        return found
    found = materialise(found)
    own.drop()
    discard(rows)
    return found


def _with_groups(rows: DataFrame, index: DigestIndex) -> DataFrame:
    """Rows with keep_id and group_size of their digest. The index is read by bucket, without dealing it out again. Digests
    that hold more than a fair share of a task are joined apart, by broadcast: there are at most four for each task."""
    parts = partitions(rows.sparkSession)
    groups = index.table().select(F.col("text_sha256").alias("digest"), "keep_id", "group_size")
    heavy = max(1, rows.count() // (4 * parts))
    hot = rows.groupBy("text_sha256").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > heavy).select(F.col("text_sha256").alias("hot"))
    hot = F.broadcast(materialise(hot))
    usual = rows.join(hot, F.col("text_sha256") == F.col("hot"), "left_anti").join(groups.hint("merge"), F.col("text_sha256") == F.col("digest"))
    some = F.broadcast(groups.join(hot, F.col("digest") == F.col("hot"), "left_semi"))
    return usual.unionByName(rows.join(some, F.col("text_sha256") == F.col("digest")))


def keep_first(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all columns of the input; rows that repeat a kept doc_id and its text become one. A row
    without a doc_id stays if it is the one that its text's group keeps, and goes if another row is.

    Rows are matched by doc_id and digest together, so the copies of a hot text spread over all tasks.
    """
    index = DigestIndex(docs.sparkSession)
    index.append(docs)
    sha, keep = free_name(docs, "sha"), free_name(docs, "keep")
    plain = F.regexp_replace(F.coalesce("text", F.lit("")), SEPARATOR_CLASS + "+", "")
    rows = docs.withColumn(sha, F.sha2(plain.cast("binary"), 256))
    kept = materialise(index.table().select(F.col("text_sha256").alias(f"{sha}_known"), F.col("keep_id").alias(keep)))
    index.drop()
    same = (rows[sha] == kept[f"{sha}_known"]) & docs["doc_id"].cast("long").eqNullSafe(kept[keep])
    return rows.join(kept.repartition(partitions(docs.sparkSession)).hint("merge"), same, "left_semi").dropDuplicates(["doc_id", sha]).drop(sha)


#: DuckDB SQL of the query's result.
ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
     h AS (SELECT doc_id, length(text) AS n, sha256(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256 FROM d)
SELECT doc_id, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS kept, text_sha256
FROM h
"""
