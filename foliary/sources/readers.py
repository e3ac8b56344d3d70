"""Sources: JSON documents with or without envelope, text files, directories, and PDF adapters."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

FRAME = "path string, page int, page_height double, text string, has_toc boolean, blocks string"


def whole_files(spark: SparkSession, path: str) -> DataFrame:
    """path, value: a row for each file."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")


def unwrapped(raw: DataFrame, schema: StructType | str, only_with_status: bool = False, require_success: bool = False) -> DataFrame:
    """Raw (value, a JSON object) -> the schema's fields, of `data` as a whole if the object has it, else of the object.

    Fields of the outer object never mix with those of `data`, whose own names may be any, `status` and `data` too.
    only_with_status: an object counts as an envelope only if it has a status. require_success: failed ones are left out.
    Rows whose value is no JSON object are left out; unreadable() has them.
    """
    fields = raw.sparkSession.createDataFrame([], schema).schema
    keys = F.json_object_keys("value")
    rows = raw.withColumn("keys", keys).where("keys is not null")
    if require_success:
        status = F.get_json_object("value", "$.status")
        rows = rows.where(~F.array_contains("keys", "status") | F.coalesce(status == "success", F.lit(False)))
    wrapped = F.array_contains("keys", "data") & (F.array_contains("keys", "status") if only_with_status else F.lit(True))
    inner = F.from_json("value", StructType([StructField("data", fields)]))["data"]
    one = F.when(wrapped, inner).otherwise(F.from_json("value", fields))
    return rows.select(one.alias("one")).select(*(F.col("one")[f.name].alias(f.name) for f in fields))


def unreadable(raw: DataFrame) -> DataFrame:
    """Rows whose value is no JSON object."""
    return raw.where(F.json_object_keys("value").isNull())


def read_json(spark: SparkSession, path: str, schema: StructType | str, only_with_status: bool = False, require_success: bool = False, strict: bool = True) -> DataFrame:
    """Whole-file JSON documents, as unwrapped() takes them. strict: a file that is no JSON object is an error."""
    raw = whole_files(spark, path)
    if strict:
        bad = raw.withColumn("value", F.when(F.json_object_keys("value").isNull(), F.raise_error(F.concat(F.lit("no JSON object: "), F.col("path")))).otherwise(F.col("value")))
        raw = bad
    return unwrapped(raw, schema, only_with_status, require_success)


def checksums(lines: DataFrame) -> DataFrame:
    """Lines (value) of hash, white space, name -> sha, name."""
    at = r"^\s*(\S+)\s+(.*\S)\s*$"
    return lines.select(F.regexp_extract("value", at, 1).alias("sha"), F.regexp_extract("value", at, 2).alias("name")).where("sha <> ''")


def read_checksums(spark: SparkSession, path: str) -> DataFrame:
    return checksums(spark.read.text(path))


def read_files(spark: SparkSession, folder: str, pattern: str = "*.pdf", max_bytes: int = 300 * 2**20) -> DataFrame:
    """Files by name with size and SHA-256; a file over max_bytes is an error, and its content is not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    about = ["path", F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("bytes")]
    over = F.raise_error(F.concat(F.lit(f"over {max_bytes} bytes: "), F.col("path")))
    large = files.where(F.col("length") > max_bytes).select(*about, over.cast("string").alias("sha"))
    return files.where(F.col("length") <= max_bytes).select(*about, F.sha2("content", 256).alias("sha")).unionByName(large)


def last_steps(lines: DataFrame, n: int = 25) -> DataFrame:
    """Of lines (at, value) the last n step or merge lines, in order."""
    return lines.where(F.col("value").contains("[step") | F.col("value").contains("[merge")).orderBy(F.col("at").desc()).limit(n).orderBy("at").select("value")


def log_tail(spark: SparkSession, path: str, n: int = 25) -> DataFrame:
    """Of one log file. Its lines are told apart by their place in the file, which doesn't depend on partitions."""
    lines = whole_files(spark, path).select(F.posexplode(F.split("value", "\r?\n")).alias("at", "value"))
    return last_steps(lines, n)


def read_pdfs(spark: SparkSession, path: str) -> DataFrame:
    """A row for each page of each file, blocks as the JSON that blocks.with_spans() reads. Needs PyMuPDF on the executors; tested with a stand-in."""

    def pages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        try:
            import fitz
        except ImportError as e:
            raise RuntimeError("reading PDFs needs PyMuPDF") from e
        import json

        for batch in batches:
            for row in batch.itertuples():
                with fitz.open(stream=row.content, filetype="pdf") as doc:
                    toc = bool(doc.get_toc())
                    out = [(row.path, i + 1, float(p.rect.height), p.get_text(), toc, json.dumps(p.get_text("dict")["blocks"], default=str)) for i, p in enumerate(doc)]
                yield pd.DataFrame(out, columns=["path", "page", "page_height", "text", "has_toc", "blocks"])

    return spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(path).select("path", "content").mapInPandas(pages, FRAME)
