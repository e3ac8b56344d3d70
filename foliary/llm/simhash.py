"""SimHash near-dedup with pivot distance tables.

Words are runs of non-space after lower-casing A-Z; the fingerprint of a text is the bitwise majority of the XXH64
(seed 42) of its 3-word shingles. Fingerprints link when 2 bits or fewer differ.

Pivot tables: let d(x, p) be the Hamming distance of a fingerprint to a reference p. By the triangle inequality
|d(x, p) - d(y, p)| <= d(x, y), so a pair whose largest coordinate difference is over 2 can't link.

1. Candidates. Bits that differ lie in two bytes at most. For each of the 28 pairs of bytes a table is computed that
   leaves these two out, of fingerprints and references alike: its distances to PIVOTS references are the coordinates of a
   cell. A linked pair has the same coordinates, so the same cell, in the table that leaves its differing bytes out.
2. Pruning. A cell's members are sorted by their whole distance to the first reference; only those at most 2 apart meet,
   and pairs whose largest difference over all references is over 2 are discarded.
3. Survivors are verified. What links gives a spanning forest of the cell, not all pairs.

Fingerprints of a cell differ in two bytes, so there are 65,536 at most (coordinates tell unlike rests apart but for rare
coincidence, which pruning and verification undo): no cell grows with the corpus, and there is one path for all sizes.

Nulls and texts without words have fingerprint zero and link like any other. Repeated rows each get their row. Extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_batch, documents, no_clash, spread_join, stored, without
from .components import components, forest

BITS, PIVOTS = 2, 24
SHINGLE, SEED = 3, 42
REFERENCES = np.random.default_rng(7).integers(0, 2**64, PIVOTS, dtype=np.uint64)
#: All but two bytes, for each pair of bytes; and odd numbers that turn a cell's coordinates into one key.
MASKS = np.array([~((0xFF << 8 * a) | (0xFF << 8 * b)) & (1 << 64) - 1 for a, b in itertools.combinations(range(8), 2)], np.uint64)
TURNS = np.random.default_rng(8).integers(0, 2**63, PIVOTS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def fingerprint(text: str | None) -> int:
    """The fingerprint as an unsigned number."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    h, join = xxhash.xxh64_intdigest, b" ".join
    if len(words) < SHINGLE:
        hashes = np.array([h(join(words), SEED)], np.uint64)
    else:
        hashes = np.fromiter((h(join(t), SEED) for t in zip(*(words[i:] for i in range(SHINGLE)), strict=False)), np.uint64, len(words) - SHINGLE + 1)
    return majority(hashes)


def majority(hashes: np.ndarray) -> int:
    """The bits that are 1 in over half the hashes."""
    votes = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 15):
        votes += np.unpackbits(hashes[i : i + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(hashes), bitorder="little").tobytes(), "little")


def signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, th (a hash that tells texts of one id apart), fp long, for each row."""

    def work(ids: list, hashes: list, texts: list) -> dict:
        return {"doc_id": ids, "th": hashes, "fp": [signed(fingerprint(t)) for t in texts]}

    rows = no_clash(docs, "doc_id", "text").select("doc_id", F.xxhash64("text").alias("th"), "text")
    return by_batch(rows, ["doc_id", "th", "text"], work, "doc_id long, th long, fp long")


def distances(x: np.ndarray) -> np.ndarray:
    """The pivot table of fingerprints: a column for each reference."""
    return np.bitwise_count(x[..., None] ^ REFERENCES).astype(np.int8)


def survivors(x: np.ndarray, table: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which of the pairs (i, j) link: pruned by the largest coordinate difference, a few pivots first, then verified."""
    at = np.arange(len(i))
    for lo in range(0, PIVOTS, 6):
        at = at[np.abs(table[i[at], lo : lo + 6] - table[j[at], lo : lo + 6]).max(axis=1) <= BITS] if len(at) else at
    return at[np.bitwise_count(x[i[at]] ^ x[j[at]]) <= BITS]


def cell_links(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of the fingerprints of one cell."""
    table = distances(x)
    order = np.argsort(table[:, 0], kind="stable")
    x, table = x[order], table[order]
    reach = np.searchsorted(table[:, 0], table[:, 0] + BITS, side="right")
    found = []
    lo = 0
    while lo < len(x):
        # Rows by the block, so that some 100,000 pairs are looked at at once.
        hi = min(len(x), lo + max(1, (1 << 17) // int(reach[lo] - lo + 1)))
        n = reach[lo:hi] - np.arange(lo, hi) - 1
        i = np.repeat(np.arange(lo, hi), n)
        j = i + 1 + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        at = survivors(x, table, i, j)
        found.append((i[at], j[at]))
        lo = hi
    i, j = (np.concatenate(c) for c in zip(*found, strict=True))
    label = forest(len(x), i, j)
    at = np.flatnonzero(label != np.arange(len(x)))
    return x[at], x[label[at]]


def cell_keys(x: np.ndarray) -> np.ndarray:
    """A key for each fingerprint (row) and mask (column): the cell's coordinates, as one number."""
    rest = x[:, None] & MASKS
    keys = np.broadcast_to(np.arange(len(MASKS), dtype=np.uint64), rest.shape).copy()
    for p, turn in zip(REFERENCES, TURNS, strict=True):
        keys += np.bitwise_count(rest ^ (p & MASKS)).astype(np.uint64) * turn
    return keys


def edges(distinct: DataFrame) -> DataFrame:
    """distinct (fp long) -> a long, b long: links that keep linked fingerprints connected."""

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(0).to_numpy().view(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(cell_keys(x).ravel().view(np.int64)), pa.array(np.repeat(x, len(MASKS)).view(np.int64))], names=["cell", "fp"])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cells = [np.sort(np.asarray(c, np.int64)).view(np.uint64) for c in (g.values.to_numpy(zero_copy_only=False) for g in b.column(0))]
            pairs = np.array([c for c in cells if len(c) == 2], np.uint64).reshape(-1, 2)
            at = survivors(pairs.ravel(), distances(pairs.ravel()), 2 * np.arange(len(pairs)), 2 * np.arange(len(pairs)) + 1)
            found = [(pairs[at, 1], pairs[at, 0]), *(cell_links(c) for c in cells if len(c) > 2)]
            u, v = (np.concatenate(c).view(np.int64) for c in zip(*found, strict=True))
            if len(u):
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["a", "b"])

    cells = distinct.select("fp").mapInArrow(put, "cell long, fp long")
    met = cells.groupBy("cell").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
    return met.select("fps").mapInArrow(link, "a long, b long")


def near_classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows: doc_id, th, fp, n; classes: fp, root, size: rows of fp, first: the least doc_id and text hash of the class)."""
    rows = stored(fingerprints(docs).groupBy("doc_id", "th", "fp").agg(F.count("*").alias("n")))
    return rows, classes_of(rows, lambda firsts: components(edges(firsts.select("fp"))))


def classes_of(rows: DataFrame, roots_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Classes of rows (as of near_classes) by what roots_of gives for their distinct fp: node, root of those that link."""
    firsts = stored(rows.groupBy("fp").agg(F.count("*").alias("size"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")).alias("first")))
    roots = roots_of(firsts)
    mine = stored(firsts.join(roots, firsts.fp == roots.node, "left").select("fp", "size", F.coalesce("root", "fp").alias("root"), "first"))
    tops = mine.groupBy("root").agg(F.min("first").alias("first"))
    return stored(mine.select("fp", "size", "root").join(tops, "root"))


def simhash_classes(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint, component_id for each row of docs."""
    out = spread_join(*near_classes(docs), ["fp"], "size").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("first.doc_id").alias("component_id"))


def keep_first(docs: DataFrame, rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Of each class (of near_classes, or of the same form) the row with the smallest id, with all its columns.

    Rows of one id and text count as one. Of unlike texts with one id and in one class the one with the smaller hash stays.
    """
    top = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th").eqNullSafe(F.col("first"))
    return without(docs, spread_join(rows, classes, ["fp"], "size").where(~top | (F.col("n") > 1)).select("doc_id", "th", top.cast("int").alias("extra")))


def keep_first_near(docs: DataFrame) -> DataFrame:
    """Of each class of near-duplicates the row with the smallest id, with all its columns."""
    return keep_first(docs, *near_classes(docs))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_classes(documents(spark, sf_dir))
