"""Exact dedup: binary-fuse filters of an immutable snapshot screen the digests that come in.

Texts are equal when they are identical after lower-casing A-Z. A snapshot is written once and never changed: distinct
digests with what is kept of each, dealt to buckets, and one static filter for each bucket. A batch's own duplicates are
grouped among themselves first; of its distinct digests, those that a filter may hold go to the exact buckets, where
SHA-256 and length must be equal; then the texts of each digest that met are compared byte by byte. The query takes half
of the ids (by hash) as the snapshot and half as the batch.

Nulls: a null text counts as empty; rows with a null id are rows like others (any id beats it). Repeated rows: of rows
with the same id and equal texts one stays (of unlike spellings the one whose hash is larger). An empty table gives an
empty result. Extra columns, whatever their names, are left as they are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, ascii_lower, documents, new_path, no_clash, spread_join, stored, without
from .fuse import FuseFilter

#: Digests that a filter holds on average.
BUCKET_ROWS = 4096


def normalised(docs: DataFrame) -> DataFrame:
    """doc_id, th (hash of the text as it is), text (lower-cased), sha, bytes."""
    text = ascii_lower(F.coalesce(F.col("text").cast("string"), F.lit("")))
    rows = no_clash(docs, "doc_id", "text").select("doc_id", F.xxhash64("text").alias("th"), text.alias("text"))
    return rows.withColumn("sha", F.unhex(F.sha2("text", 256))).withColumn("bytes", F.octet_length("text").cast("long"))


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, th, sha binary, bytes long, n long: rows of one id and text are counted in n."""
    return normalised(docs).groupBy("doc_id", "th", "sha", "bytes").agg(F.count("*").alias("n"))


def grouped(rows: DataFrame) -> DataFrame:
    """One row for each digest: sha, bytes, top (its largest id, with the text's hash), n (its rows)."""
    return rows.groupBy("sha", "bytes").agg(F.max(F.struct("doc_id", "th")).alias("top"), F.sum("n").alias("n"))


def with_bucket(groups: DataFrame, buckets: int) -> DataFrame:
    return groups.withColumn("key", F.xxhash64("sha")).withColumn("bucket", F.pmod(F.col("key"), F.lit(buckets)).cast("int"))


@dataclass(frozen=True)
class Snapshot:
    """A written snapshot: path/groups (sha, bytes, top, n) and path/filters (bucket, buckets, filter)."""

    spark: SparkSession
    path: str

    def groups(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/groups")

    def filters(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/filters")

    def buckets(self) -> int:
        first = self.filters().select("buckets").first()
        return first.buckets if first else 1


def write_snapshot(rows: DataFrame, path: str) -> Snapshot:
    """Write the digests (of digests()) and their filters below a path that must not exist."""
    spark = rows.sparkSession
    grouped(rows).write.mode("errorifexists").parquet(f"{path}/groups")
    made = Snapshot(spark, path)
    buckets = 1 << max(0, (made.groups().count() // BUCKET_ROWS).bit_length())

    def build(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"bucket": [key[0]], "buckets": [buckets], "filter": [FuseFilter.build(part["key"].to_numpy(np.int64)).pack()]})

    dealt = with_bucket(made.groups(), buckets).select("bucket", "key").groupBy("bucket")
    dealt.applyInPandas(build, "bucket int, buckets int, filter binary").write.mode("errorifexists").parquet(f"{path}/filters")
    return made


def screen(batch: DataFrame, snapshot: Snapshot) -> DataFrame:
    """The batch's groups with a boolean `maybe`: false only if no bucket of the snapshot holds the digest."""
    schema = "sha binary, bytes long, top_id long, top_th long, n long, maybe boolean"

    def ask(key: tuple, rows: pd.DataFrame, filt: pd.DataFrame) -> pd.DataFrame:
        out = rows[["sha", "bytes", "top_id", "top_th", "n"]].copy()
        out["maybe"] = FuseFilter.unpack(filt["filter"].iloc[0]).may_hold(rows["key"].to_numpy(np.int64)) if len(filt) else False
        out["top_id"] = out["top_id"].astype("Int64")
        return out

    flat = with_bucket(batch, snapshot.buckets()).select("sha", "bytes", F.col("top.doc_id").alias("top_id"), F.col("top.th").alias("top_th"), "n", "key", "bucket")
    asked = flat.groupBy("bucket").cogroup(snapshot.filters().groupBy("bucket")).applyInPandas(ask, schema)
    return asked.select("sha", "bytes", F.struct(F.col("top_id").alias("doc_id"), F.col("top_th").alias("th")).alias("top"), "n", "maybe")


def check_bytes(docs: DataFrame, met: DataFrame) -> None:
    """Compare the texts of every digest in met: least and greatest must be the same bytes, else an error.

    Partial aggregation leaves one text of a digest for each task, so groups of any size are spread.
    """
    few = stored(met.select("sha").distinct())
    few = F.broadcast(few) if few.count() <= BROADCAST_ROWS else few
    texts = normalised(docs).select("sha", "text").join(few, "sha", "left_semi")
    unlike = texts.groupBy("sha").agg(F.min("text").alias("a"), F.max("text").alias("b")).where("a <> b")
    if unlike.limit(1).count():
        raise ValueError("unlike texts have one SHA-256")


def merged(snapshot: Snapshot, batch: DataFrame, docs: DataFrame) -> DataFrame:
    """Groups over both: sha, bytes, top, group_size. batch: rows as digests() gives them; docs: the texts of both."""
    asked = stored(screen(grouped(batch), snapshot))
    old = snapshot.groups()
    hits = asked.where("maybe").select("sha", "bytes", F.col("top").alias("top2"), F.col("n").alias("n2"))
    known = stored(old.join(hits, ["sha", "bytes"], "full_outer"))
    check_bytes(docs, known.where("n is not null and n2 is not null"))
    fresh = asked.where("not maybe").select("sha", "bytes", "top", F.col("n").alias("group_size"))
    return known.select("sha", "bytes", F.greatest("top", "top2").alias("top"), (F.coalesce("n", F.lit(0)) + F.coalesce("n2", F.lit(0))).alias("group_size")).unionByName(fresh)


def decisions(docs: DataFrame) -> DataFrame:
    """doc_id, th, sha, n, top, group_size: a row for each id and text. Half of the ids are the snapshot, half the batch."""
    rows = stored(digests(docs))
    side = F.pmod(F.xxhash64("doc_id"), F.lit(2))
    snapshot = write_snapshot(rows.where(side == 0), new_path(docs.sparkSession, "snapshot"))
    groups = stored(merged(snapshot, rows.where(side == 1), docs)).withColumn("size", F.col("group_size"))
    return spread_join(rows, groups, ["sha", "bytes"], "size")


def stays() -> Column:
    return F.struct("doc_id", "th").eqNullSafe(F.col("top"))


def exact_dedup(docs: DataFrame) -> DataFrame:
    """One row for each row of docs: doc_id, keep_id, group_size, kept, text_sha256."""
    copies = decisions(docs).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    return copies.select("doc_id", F.col("top.doc_id").alias("keep_id"), "group_size", (stays() & (F.col("copy") == 1)).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def keep_first_class(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, with all their columns."""
    return without(docs, decisions(docs).where(~stays() | (F.col("n") > 1)).select("doc_id", "th", stays().cast("int").alias("extra")))


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


#: The plain statement of the same result.
OP1_SQL = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), h AS (SELECT doc_id, sha256(t) AS text_sha256 FROM d)
SELECT doc_id, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, text_sha256
FROM h
"""
