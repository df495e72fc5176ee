"""Exact deduplication against a persistent index of text digests.

The index is a Parquet table bucketed and sorted by the SHA-256 of the normalised
text (A-Z lower-cased, nothing else changed; a null text is an empty text).  A load
is reduced to one row per digest, with partial aggregation before the shuffle, and
anti-joined with the index by a sort-merge join that reads the index bucket by
bucket without shuffling it; only the digests that are new are appended.

Defined results.  Within a load the row with the largest id stays (a null id counts
as the smallest; of rows that repeat id and text, one stays).  A text that an
earlier load brought is dropped whatever its id, and ``keep_id`` names the earlier
row.  ``group_size`` counts the load's rows of that text.  A load that runs again
under its name gives the same decisions and appends what it had not appended.
An empty table gives an empty result.  Other columns play no part, whatever
their names.

Skew: a text that holds more than one row in ``HOT`` is looked up by a broadcast of
at most ``HOT`` rows (no more texts can be so common); all others go through a
shuffle, where a key then has at most that share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from quarry.llm.scratch import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A text with more than 1 / HOT of a load's rows is hot: at most HOT texts are.
HOT = 4096


def digest(text: str = "text") -> Column:
    """The SHA-256 of the normalised text, 32 bytes."""
    return F.unhex(F.sha2(F.translate(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")), UPPER, LOWER), 256))


class DigestIndex:
    """An index in a folder that all executors share.  ``buckets`` counts for a new
    index only (default: the session's shuffle width, so that the aggregated load
    meets its buckets without another shuffle)."""

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None, id_type: str = "bigint"):
        self.spark, self.path = spark, path.rstrip("/")
        try:
            meta = spark.read.schema("buckets int, id_type string").json(f"{self.path}/about").first()
        except AnalysisException:
            meta = None
        if meta is None:
            meta = (int(buckets or spark.conf.get("spark.sql.shuffle.partitions")), id_type)
            spark.createDataFrame([meta], "buckets int, id_type string").coalesce(1).write.mode("overwrite").json(f"{self.path}/about")
        self.buckets, self.id_type = meta
        # The catalog entry belongs to this session; the files carry the buckets.
        self.table = "digests_" + spark.sql("SELECT md5(:p) AS m", {"p": self.path}).first()["m"]
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} (digest BINARY, keep_id {self.id_type}, load STRING) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.path}/digests'")

    def rows(self) -> DataFrame:
        """(digest, keep_id, load) of every text seen, one row per text."""
        self.spark.catalog.refreshTable(self.table)
        return self.spark.table(self.table)

    def ingest(self, docs: DataFrame, load: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
        """Appends the load's new texts and returns its decisions, one row per row of
        ``docs``: (``id_col``, keep_id, group_size, kept, digest)."""
        # Numbered once and written, so that a lost task cannot number rows anew.
        stamped = written(docs.select(F.col(f"`{id_col}`").cast(self.id_type).alias("id"), digest(text).alias("digest"),
                                      F.monotonically_increasing_id().alias("row")), "digests")
        groups = written(stamped.groupBy("digest").agg(F.max(F.struct("id", "row")).alias("keep"), F.count("*").alias("n")), "groups")

        known = self.rows()
        fresh = groups.hint("merge").join(known, "digest", "left_anti")
        (fresh.select("digest", F.col("keep.id").alias("keep_id"), F.lit(load).alias("load"))
              .write.mode("append").insertInto(self.table))

        earlier = self.rows().where(F.col("load") != load).select("digest", F.col("keep_id").alias("earlier_id"), F.lit(True).alias("seen"))
        judged = groups.hint("merge").join(earlier, "digest", "left").select(
            "digest", "n", F.when(F.col("seen"), F.col("earlier_id")).otherwise(F.col("keep.id")).alias("keep_id"),
            F.when(F.col("seen"), F.lit(-1)).otherwise(F.col("keep.row")).alias("keep_row"))
        judged = written(judged, "judged")
        common = F.col("n") * HOT > F.lit(stamped.count())
        hot = stamped.join(F.broadcast(judged.where(common)), "digest", "left")
        rest = hot.where("n IS NULL").select("id", "row", "digest").join(judged.where(~common), "digest")
        return hot.where("n IS NOT NULL").unionByName(rest).select(
            F.col("id").alias(id_col), "keep_id", F.col("n").alias("group_size"), (F.col("row") == F.col("keep_row")).alias("kept"), "digest")

    def deduplicated(self, docs: DataFrame, load: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
        """The rows of ``docs`` that stay, with all their columns."""
        kept = self.ingest(docs, load, id_col, text).where("kept").select(
            F.col(f"`{id_col}`").alias("__id"), F.col("digest").alias("__digest"), F.lit(True).alias("__kept"))
        marked = docs.withColumns({"__digest": digest(text), "__id": F.col(f"`{id_col}`").cast(self.id_type)})
        a, b = marked.alias("a"), kept.alias("b")
        same = (F.col("a.__digest") == F.col("b.__digest")) & F.col("a.__id").eqNullSafe(F.col("b.__id"))
        left = a.join(b, same, "left_semi").dropDuplicates(["__digest", "__id"])
        return left.drop("__digest", "__id")
