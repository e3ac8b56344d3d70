"""What the corpus operators share: stored tables, word rules, work in Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but space and the ASCII controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share (spark.checkpoint.dir). Where none is set, a local session gets one of its own; on a cluster that is an error."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        own = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
        if not own and not sc.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(own or tempfile.mkdtemp(prefix="checkpoints-"))
    return sc.getCheckpointDir()


#: Folders of the scratch blocks that are open, the innermost last.
_OPEN: list[list[str]] = []


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if _OPEN:
        _OPEN[-1].append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """What is stored within the block is deleted at its end, but for the last table that is handed to what this gives."""
    paths: list[str] = []
    kept: list[str] = []
    _OPEN.append(paths)

    def keep(df: DataFrame) -> DataFrame:
        out = stored(df)
        kept[:] = [paths.pop()]
        return out

    try:
        yield keep
    finally:
        _OPEN.pop()
        for p in paths:
            at = spark._jvm.org.apache.hadoop.fs.Path(p)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        if _OPEN:
            _OPEN[-1].extend(kept)


def stored(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage, survives lost executors, is computed once."""
    path = new_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def done_with(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more. Shuffle files of finished steps go when the JVM collects their plans, so it is told to."""
    import gc

    for table in tables:
        for file in table.inputFiles()[:1]:
            at = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(file)).getParent()
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    gc.collect()
    spark._jvm.System.gc()


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Where every character is one byte long, lower() does the same and is faster."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def id_crc(doc_id: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo mod; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % mod


def give_back() -> None:
    """Hand memory that was freed back to the system: a worker lives on after its task, and others need the room."""
    import ctypes

    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def by_batch(df: DataFrame, columns: list[str], work: Callable[..., dict | None], schema: str, chars: int = 2_000_000) -> DataFrame:
    """work(*column lists) -> columns of schema, for pieces of some rows each, so that memory stays bounded.

    columns: the ones handed to work, the text last; a piece ends when its texts hold `chars` bytes.
    """
    from pyspark.sql.types import _parse_datatype_string
    from pyspark.sql.pandas.types import to_arrow_schema

    out = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in pieces(b.column(b.num_columns - 1), chars):
                got = work(*(c.slice(lo, hi - lo).to_pylist() for c in b.columns))
                if got is not None:
                    yield pa.RecordBatch.from_arrays([pa.array(got[f.name], type=f.type) for f in out], schema=out)
            give_back()

    return df.select(*columns).mapInArrow(run, schema)


def by_whole_rows(docs: DataFrame, change: Callable[[pa.RecordBatch, list], pa.RecordBatch], chars: int = 2_000_000) -> DataFrame:
    """change(rows, their texts) -> rows of the same columns. Columns go by their place, so any names will do."""
    from pyspark.sql.pandas.types import to_arrow_schema

    at = docs.columns.index("text")
    placed = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    out = to_arrow_schema(placed.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = [c.cast(f.type) if c.type != f.type else c for c, f in zip(b.columns, out, strict=True)]
            whole = pa.RecordBatch.from_arrays(cols, schema=out)
            for lo, hi in pieces(whole.column(at), chars):
                part = whole.slice(lo, hi - lo)
                yield change(part, part.column(at).to_pylist())
            give_back()

    return placed.mapInArrow(run, placed.schema).toDF(*docs.columns)


def free_name(taken: list[str], name: str) -> str:
    """name, with underscores put behind it until no column has it."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name += "_"
    return name


#: A key counts as hot from this share of all rows on, so that there are at most 1 / HOT_SHARE of them.
HOT_SHARE = 1 / 1000


def spread_join(rows: DataFrame, groups: DataFrame, on: list[str], size: str) -> DataFrame:
    """rows joined with the one row that groups have for each key. groups.size: how many rows have the key; it is dropped.

    Hot keys, a thousand at most, are broadcast, so their rows stay where they are; the others meet by a shuffle. Both
    sides must be cheap to read twice.
    """
    total, top = groups.agg(F.coalesce(F.sum(size), F.lit(0)), F.coalesce(F.max(size), F.lit(0))).first()
    bound = max(1000, int(total * HOT_SHARE))
    if top <= bound:
        return rows.join(groups.drop(size), on)
    hot = F.broadcast(stored(groups.where(F.col(size) > bound).drop(size)))
    cold = groups.where(F.col(size) <= bound).drop(size)
    return rows.join(hot, on).unionByName(rows.join(hot.select(*on), on, "left_anti").join(cold, on))


#: Dropped rows are broadcast up to this number: 24 bytes each, some tens of MB as a hash table.
BROADCAST_ROWS = 200_000


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """docs less some rows, with all their columns. gone: doc_id, th (xxhash64 of text), extra (rows of that id and text that stay, 0 or 1).

    Only the narrow `gone` is hashed and, up to BROADCAST_ROWS rows, broadcast, so that texts need no shuffle; beyond it
    rows meet by a shuffle of id and hash. Of repeated rows with extra = 1, one stays.
    """
    mine, theirs, extra = (free_name(docs.columns, x) for x in ("own_row", "gone_row", "extra_rows"))
    few = stored(gone.select(F.struct("doc_id", "th").alias(theirs), F.col("extra").alias(extra)))
    n, repeated = few.agg(F.count("*"), F.coalesce(F.max(extra), F.lit(0))).first()
    rows = docs.withColumn(mine, F.struct(F.col("doc_id"), F.xxhash64("text").alias("th")))
    met = rows.join(F.broadcast(few) if n <= BROADCAST_ROWS else few, rows[mine].eqNullSafe(few[theirs]), "left")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    whole = met.where(F.col(extra).isNull()).select(*columns)
    return whole.unionByName(met.where(F.col(extra) == 1).dropDuplicates([mine]).select(*columns)) if repeated else whole


def pieces(texts: pa.Array, chars: int) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts hold about `chars` bytes; one longer text is a piece of its own."""
    n = len(texts)
    if not n:
        return
    import pyarrow.compute as pc

    ends = np.cumsum(np.nan_to_num(np.asarray(pc.binary_length(texts).fill_null(0)), nan=0))
    lo = 0
    while lo < n:
        base = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, base + chars, side="right")))
        yield lo, hi
        lo = hi


def no_clash(df: DataFrame, *wanted: str) -> DataFrame:
    """Only the wanted columns: extra ones, whatever their names, can't disturb an operator's own."""
    return df.select(*(F.col(f"`{c}`") for c in wanted))
