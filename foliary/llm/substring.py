"""Substring dedup: FM-index shards find passages that also begin in a document with a smaller id.

A passage is 13 consecutive words. Documents are cut into runs: stretches of windows with one minimizer (the least hash
of the 5-word grams in a window). Equal windows have equal minimizers, so they meet in the shard of their key and
nowhere else; each run is streamed through one shard only, however many there are.

1. One pass takes each document's minimizers. Keys of one document alone can't hold a shared window and go no further.
2. Documents with the same words are one: all but those with the smallest id lose every window.
3. Equal runs are one content, owned by the smallest id; in other documents all its windows are shared.
4. Each shard indexes its contents (sort transform of order 13, wavelet matrix) and streams them through backward search;
   the least owner of the rows of a matching interval says whether the window begins in a smaller document too.
5. Removed words are the union of covered windows, judged on the input.

A shard holds about SHARD_WORDS words. The runs of a key go whole to its shard; where all that documents hold of a key
would pass SHARD_WORDS, its runs go window by window, each to the shard of its own hash. So no shard grows with a common
line or a word that is said over and over, and every result comes out of a shard's index.

What a step stored or shuffled is deleted as soon as no later step reads it.

Nulls: a null text has no words; a null id counts as larger than any other. Rows with the same id are not smaller than
each other; repeated rows each get their row. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_batch, documents, done_with, no_clash, spread_join, stored
from .fmindex import FmIndex
from .windows import gram_hashes, runs, words

WINDOW, GRAM, SHARD_WORDS = 13, 5, 600_000
LAST = (1 << 63) - 1
_SPACES = bytes(32 if 9 <= b <= 13 else b for b in range(256))


def plain(text: str | None) -> bytes:
    """The words of a text, joined by one space."""
    b = (text or "").encode("utf-8", "replace").translate(_SPACES)
    return b" ".join(b.split()) if b"  " in b or b[:1] == b" " or b[-1:] == b" " else b


def sha(b: bytes) -> str:
    return hashlib.sha256(b).hexdigest()


def surveyed(rows: DataFrame) -> DataFrame:
    """did, th, sha, n_words, keys (the document's distinct minimizers), held (words of each key's runs) of rows with did, th, text."""

    def work(dids: list, hashes: list, texts: list) -> dict:
        flat = [plain(t) for t in texts]
        w = words(flat)
        r = runs(w, WINDOW, GRAM)
        order = np.lexsort((r.key, r.text))
        key, text, size = r.key[order], r.text[order], r.count[order] + (WINDOW - 1)
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (text[1:] != text[:-1])
        held = np.add.reduceat(size, np.flatnonzero(new)) if len(size) else size
        key, text = key[new], text[new]
        cut = np.searchsorted(text, np.arange(len(flat) + 1))
        return {
            "did": dids, "th": hashes, "sha": [sha(b) for b in flat], "n_words": np.bincount(w.text, minlength=len(flat)),
            "keys": [key[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)], "held": [held[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)],
        }

    return by_batch(rows, ["did", "th", "text"], work, "did long, th long, sha string, n_words long, keys array<long>, held array<long>", 1_000_000)


def shared_keys(survey: DataFrame) -> DataFrame:
    """did, th, cold, hot: of documents that own their words, the keys that other documents have too, by how their runs go to shards."""
    owners = survey.groupBy("sha").agg(F.min("did").alias("did"))
    each = survey.join(owners, ["sha", "did"], "left_semi").select("did", "th", F.explode(F.arrays_zip("keys", "held")).alias("k")).select("did", "th", F.col("k.keys").alias("key"), F.col("k.held").alias("held"))
    counts = each.groupBy("key").agg(F.count("*").alias("docs"), F.sum("held").alias("held")).where("docs > 1").select("key", (F.col("held") > SHARD_WORDS).alias("wide"))
    met = each.select("did", "th", "key").join(counts, "key")
    wide = F.col("wide")
    return met.groupBy("did", "th").agg(F.collect_list(F.when(~wide, F.col("key"))).alias("cold"), F.collect_list(F.when(wide, F.col("key"))).alias("hot"))


def shared_runs(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """did, th, first, count, key, content of the runs with shared keys."""

    def work(dids: list, hashes: list, cold: list, hot: list, texts: list) -> dict:
        flat = [plain(t) for t in texts]
        w = words(flat)
        r = runs(w, WINDOW, GRAM)
        base = np.searchsorted(w.text, np.arange(len(flat)))

        def chosen(lists: list) -> np.ndarray:
            sizes = [len(x) for x in lists]
            pairs = gram_hashes_of(np.repeat(np.arange(len(lists)), sizes), np.concatenate([np.asarray(x, np.int64) for x in lists]))
            return np.flatnonzero(np.isin(gram_hashes_of(r.text, r.key), pairs))

        at = chosen(cold)
        first, count, key, text = r.first[at], r.count[at], r.key[at], r.text[at]
        at = chosen(hot)
        if len(at):
            whole = (gram_hashes(w.hash, WINDOW) >> np.uint64(16)).astype(np.int64)
            one = np.repeat(r.first[at], r.count[at]) + np.arange(r.count[at].sum()) - np.repeat(np.cumsum(r.count[at]) - r.count[at], r.count[at])
            first, count, key, text = (np.concatenate(x) for x in ((first, one), (count, np.ones(len(one), np.int64)), (key, whole[one]), (text, w.text[one])))
        lo, hi = w.start[first], w.end[first + count + WINDOW - 2]
        raw = w.raw.tobytes()
        return {
            "did": np.asarray(dids, np.int64)[text], "th": np.asarray(hashes, np.int64)[text], "first": first - base[text], "count": count, "key": key,
            "content": [raw[a:b] for a, b in zip(lo.tolist(), hi.tolist(), strict=True)],
        }

    met = rows.join(keys, ["did", "th"])
    return by_batch(met, ["did", "th", "cold", "hot", "text"], work, "did long, th long, first int, count int, key long, content binary", 1_000_000)


def gram_hashes_of(text: np.ndarray, key: np.ndarray) -> np.ndarray:
    """One number for a pair of a text's place and a key."""
    return key * np.int64(1 << 14) + (text % (1 << 14)) if len(key) else np.zeros(0, np.int64)


def shard_intervals(shard: pd.DataFrame) -> pd.DataFrame:
    """Of each content (key, content, owner): the windows that begin in a document smaller than the owner, as intervals."""
    w = words(list(shard["content"]))
    sizes = np.bincount(w.text, minlength=len(shard))
    index = FmIndex(w.hash, sizes, WINDOW)
    owner = shard["owner"].to_numpy(np.int64)
    group = index.matches(w.hash, sizes)
    covered = np.zeros(len(group) + 1, bool)
    covered[:-1] = (group >= 0) & (index.least(owner)[group] < owner[w.text])
    covered[np.cumsum(sizes) - 1] = False
    turn = np.diff(np.concatenate([[False], covered]).astype(np.int8))
    lo, hi = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
    text = w.text[lo]
    lo, hi = lo - (np.cumsum(sizes) - sizes)[text], hi - (np.cumsum(sizes) - sizes)[text]
    cut = np.searchsorted(text, np.arange(len(shard) + 1))
    return pd.DataFrame({
        "key": shard["key"], "content": shard["content"], "owner": shard["owner"], "holders": shard["holders"],
        "los": [lo[a:b].astype(np.int32) for a, b in zip(cut[:-1], cut[1:], strict=True)], "his": [hi[a:b].astype(np.int32) for a, b in zip(cut[:-1], cut[1:], strict=True)],
    })


def covered_words(found: DataFrame) -> DataFrame:
    """did, th, spans (array of word intervals to remove) from runs, stored."""
    contents = stored(found.groupBy("key", "content").agg(F.min("did").alias("owner"), F.count("*").alias("holders")))
    total = contents.agg(F.sum(F.octet_length("content"))).first()[0] or 0
    shards = max(1, total // (6 * SHARD_WORDS) + 1)
    dealt = contents.select("key", "content", "owner", "holders", F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard"))
    schema = "key long, content binary, owner long, holders long, los array<int>, his array<int>"
    judged = stored(dealt.groupBy("shard").applyInPandas(lambda rows: shard_intervals(rows), schema).select("key", F.xxhash64("content").alias("ck"), "owner", "holders", "los", "his"))
    done_with(found.sparkSession, contents)
    mine = spread_join(found.select("did", "th", "first", "count", "key", F.xxhash64("content").alias("ck")), judged, ["key", "ck"], "holders")
    own = F.transform(F.arrays_zip("los", "his"), lambda s: F.struct((F.col("first") + s.los).alias("lo"), (F.col("first") + s.his + (WINDOW - 1)).alias("hi")))
    every = F.array(F.struct(F.col("first").alias("lo"), (F.col("first") + F.col("count") + (WINDOW - 1)).alias("hi")))
    spans = mine.select("did", "th", F.explode(F.when(F.col("did") > F.col("owner"), every).otherwise(own)).alias("span"))
    out = stored(spans.groupBy("did", "th").agg(F.collect_list("span").alias("spans")))
    done_with(found.sparkSession, judged)
    return out


def without(text: bytes, lo: np.ndarray, hi: np.ndarray) -> tuple[int, bytes]:
    """How many words of a plain text lie in the intervals, and the rest."""
    all_words = text.split(b" ")
    edge = np.zeros(len(all_words) + 1, np.int64)
    np.add.at(edge, lo, 1)
    np.add.at(edge, hi, -1)
    gone = np.cumsum(edge)[:-1] > 0
    return int(gone.sum()), b" ".join([x for x, g in zip(all_words, gone.tolist(), strict=True) if not g])


def substring_dedup(docs: DataFrame, keep: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for each row; with keep also the kept text."""
    rows = no_clash(docs, "doc_id", "text").select("doc_id", F.coalesce("doc_id", F.lit(LAST)).alias("did"), F.xxhash64("text").alias("th"), "text")
    spark = docs.sparkSession
    whole = stored(surveyed(rows))
    survey, keys = stored(whole.drop("keys", "held")), stored(shared_keys(whole))
    done_with(spark, whole)
    found = stored(shared_runs(rows, keys))
    done_with(spark, keys)
    spans = covered_words(found)
    done_with(spark, found)

    def cut(ids: list, los: list, his: list, texts: list) -> dict:
        out: dict = {"doc_id": ids, "n_words": [], "n_removed": [], "kept_sha256": [], "kept": []}
        for lo, hi, t in zip(los, his, texts, strict=True):
            b = plain(t)
            n, rest = without(b, np.asarray(lo), np.asarray(hi))
            out["n_words"].append(b.count(b" ") + 1)
            out["n_removed"].append(n)
            out["kept_sha256"].append(sha(rest))
            if keep:
                out["kept"].append(rest.decode())
        return out

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * keep
    met = rows.join(spans, ["did", "th"]).select("doc_id", F.col("spans.lo").alias("lo"), F.col("spans.hi").alias("hi"), "text")
    changed = by_batch(met, ["doc_id", "lo", "hi", "text"], cut, schema)
    owners = stored(survey.groupBy("sha").agg(F.min("did").alias("top"), F.count("*").alias("copies")))
    rest = spread_join(survey.join(spans.select("did", "th"), ["did", "th"], "left_anti"), owners, ["sha"], "copies")
    copy = (F.col("did") > F.col("top")) & (F.col("n_words") >= WINDOW)
    same = rest.select(
        F.when(F.col("did") != LAST, F.col("did")).alias("doc_id"), "n_words", F.when(copy, F.col("n_words")).otherwise(0).alias("n_removed"), F.when(copy, F.lit(sha(b""))).otherwise(F.col("sha")).alias("kept_sha256"), *(["did", "th", copy.alias("copy")] if keep else [])
    )
    if keep:
        text = F.concat_ws(" ", F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"([^\x20\x09-\x0D]+)"), 1))
        same = same.join(rows.select("did", "th", "text").distinct(), ["did", "th"]).withColumn("kept", F.when(F.col("copy"), "").otherwise(text)).select("doc_id", "n_words", "n_removed", "kept_sha256", "kept")
    return changed.unionByName(same)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(documents(spark, sf_dir))


#: The plain statement of the same result.
OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^ \t\n\v\f\r]+') AS ws FROM documents
), w AS (
  SELECT doc_id, p, array_to_string(ws[p:p+12], ' ') AS win FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS p FROM d)
), f AS (SELECT win, min(doc_id) AS low FROM w GROUP BY win),
hit AS (SELECT w.doc_id, w.p FROM w JOIN f USING (win) WHERE f.low < w.doc_id),
gone AS (SELECT DISTINCT doc_id, q FROM (SELECT doc_id, unnest(range(p, p + 13)) AS q FROM hit)),
word AS (SELECT doc_id, unnest(ws) AS x, unnest(range(1, len(ws) + 1)) AS q FROM d),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY q) AS t FROM word LEFT JOIN (SELECT doc_id, q, 1 AS g FROM gone) USING (doc_id, q) WHERE g IS NULL GROUP BY doc_id
)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
