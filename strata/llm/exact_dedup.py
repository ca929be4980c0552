"""Exact deduplication against a persistent digest index.

The index is a table bucketed and sorted by digest. A batch is reduced to one row per digest
(map-side pre-aggregation, so a group of copies never meets in one task), anti-joined with the
index by sort-merge (the index side is read bucket by bucket without a shuffle), and what is new
is appended. Texts never cross the network: only 32-byte digests, ids and lengths do.

Defined cases: a null text counts as empty; rows of one digest and equal ids are one group and
each keeps that id; a null id is kept only if its whole group has no id; an empty batch leaves
the index as it is; further columns are ignored by the index and kept by :func:`keep_first`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import SPACES, stage, text_or_empty
from strata.session import scratch_path

INDEX_SCHEMA = "digest binary, keep_id bigint, n_chars bigint, group_size bigint"


class DigestIndex:
    """``digest → (keep_id, n_chars, group_size)`` at ``path``, bucketed and sorted by digest.

    ``path`` is a folder all executors share; an index written by an earlier session is
    attached again by its path and ``buckets`` (the count it was made with).
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark, self.path = spark, path
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.table = "digest_index_" + "".join(c if c.isalnum() else "_" for c in path)[-60:].lower()
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} ({INDEX_SCHEMA}) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS "
                  f"LOCATION '{path}'")

    def rows(self) -> DataFrame:
        """One row per digest. A digest has a row of its own for every batch that brought it; they lie
        in one bucket, sorted, so adding them up needs no shuffle."""
        return self.spark.table(self.table).groupBy("digest").agg(
            F.min("keep_id").alias("keep_id"), F.max("n_chars").alias("n_chars"), F.sum("group_size").alias("group_size"))

    def admit(self, docs: DataFrame) -> DataFrame:
        """Deduplicate ``docs(doc_id, text, …)`` against the index and itself, append the new
        digests, and return one row per document:
        ``doc_id, keep_id, group_size, kept, text_sha256, n_chars, digest``.

        Of equal texts in one batch the longest original (code points), then the smallest id
        stays; a text the index already holds is dropped in favour of the indexed document.
        ``group_size`` counts the rows of this batch and of all batches before."""
        plain = F.translate(text_or_empty(), SPACES, "")
        rows = stage(docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.char_length(text_or_empty()).cast("long").alias("n_chars"),
            F.unhex(F.sha2(plain.cast("binary"), 256)).alias("digest")), "digests")
        first = F.min(F.struct((-F.col("n_chars")).alias("neg"), F.col("doc_id").isNull().alias("no_id"),
                               F.col("doc_id").alias("id")))
        groups = rows.groupBy("digest").agg(first.alias("f"), F.count(F.lit(1)).alias("group_size"))
        groups = stage(groups.select("digest", F.col("f.id").alias("keep_id"),
                                     (-F.col("f.neg")).alias("n_chars"), "group_size"), "digest-groups")
        known = self.rows()
        resolved = None
        if self.spark.table(self.table).limit(1).count():
            old = known.select("digest", F.col("keep_id").alias("old_id"),
                               F.col("group_size").alias("old_size"))
            resolved = stage(groups.join(old.hint("merge"), "digest", "left").select(
                "digest", F.coalesce("old_size", F.lit(0)).alias("old_size"),
                F.when(F.col("old_size").isNull(), F.col("keep_id")).otherwise(F.col("old_id")).alias("keep_id"),
                "group_size", F.col("old_size").isNull().alias("fresh")), "digest-resolved")
        new = groups.join(known.hint("merge"), "digest", "left_anti").select("digest", "keep_id", "n_chars", "group_size")
        if resolved is not None:  # known digests: what this batch adds to their count
            new = new.union(resolved.where("NOT fresh").select("digest", "keep_id", F.lit(None).cast("long"), "group_size"))
        (new.repartition(self.buckets, "digest").sortWithinPartitions("digest")
         .write.insertInto(self.table))
        self.spark.catalog.refreshTable(self.table)
        if resolved is None:
            resolved = groups.select("digest", F.lit(0).cast("long").alias("old_size"), "keep_id",
                                     "group_size", F.lit(True).alias("fresh"))
        return (rows.join(resolved, "digest")
                .select("doc_id", "keep_id",
                        (F.col("group_size") + F.col("old_size")).alias("group_size"),
                        (F.col("fresh") & F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
                        F.lower(F.hex("digest")).alias("text_sha256"),
                        rows.n_chars.alias("n_chars"), "digest"))


def keep_first(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, one per digest, with their own columns. Rows that repeat
    the id and text of the one that stays are dropped too (the smallest original text stays)."""
    plain = F.translate(text_or_empty(), SPACES, "")
    keys = (decisions.where("kept").select(F.col("doc_id").alias("_xd_id"), F.col("digest").alias("_xd_digest"))
            .distinct())
    mine = docs.withColumns({"_xd_digest": F.unhex(F.sha2(plain.cast("binary"), 256)),
                             "_xd_id": F.col("doc_id").cast("long")})
    kept = mine.join(keys, (mine._xd_digest == keys._xd_digest) & mine._xd_id.eqNullSafe(keys._xd_id), "left_semi")
    w = Window.partitionBy("_xd_digest", "_xd_id").orderBy(F.char_length(text_or_empty()).desc(),
                                                     F.col("text").asc_nulls_last())
    return (kept.withColumn("_xd_n", F.row_number().over(w)).where("_xd_n = 1")
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


def new_index(spark: SparkSession) -> DigestIndex:
    return DigestIndex(spark, scratch_path(spark, "digest-index"))
