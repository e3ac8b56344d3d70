"""Quality rules: hashed n-gram log-likelihood ratio between a trusted target and the raw corpus.

Words and word pairs are hashed to BUCKETS. Bucket counts of all documents make the raw multinomial, those of documents
labelled good the target one. A document's score is the mean over its n-grams of log(target / raw); below the threshold
it is not kept. The base rules (too few words, too many words in repeated 5-word windows) come first.

Labelled ids are halved by crc32, and every labelled document takes part: all good ones of one half are the target, all of
the other half set the threshold: the lowest of the best, where a good document that would go weighs as much as LOSS bad
ones that would stay (as shares). Without good and bad ones there, THRESHOLD holds. Raw counts are over all documents. All
of it is DataFrame functions: no Python runs on executors. Ids meet documents by a merge join at all sizes: the texts of the
target's half are shuffled once, for the threshold only stored scores are. The driver gets sums by bin, never scores.

Nulls: a null text has no words and fails the base rules. Without labels, or without documents, all weights are zero and
only the base rules decide. Repeated rows each get their row.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import SPACE, WORD, documents, labels, no_clash, stored

BUCKETS, SMOOTH, THRESHOLD, LOSS = 65_536, 1.0, -0.13, 20
#: Bins to a unit of score. Scores are means of logs, so there are some thousands of bins at most, whatever the corpus.
BINS = 1000


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def grams_of(hashes: Column, n: int) -> Column:
    """Hashes of n consecutive word hashes."""
    at = F.when(F.size(hashes) >= n, F.sequence(F.lit(0), F.size(hashes) - n)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(*(F.get(hashes, i + j) for j in range(n))))


def bucketed(docs: DataFrame) -> DataFrame:
    """doc_id, bucket: one row for each word and each pair."""
    hashed = no_clash(docs, "doc_id", "text").select("doc_id", F.transform(words_of(F.col("text")), lambda w: F.xxhash64(w)).alias("h"))
    both = hashed.select("doc_id", F.explode(F.concat("h", grams_of(F.col("h"), 2))).alias("g"))
    return both.select("doc_id", F.pmod("g", F.lit(BUCKETS)).cast("int").alias("bucket"))


def counts(docs: DataFrame) -> dict[int, int]:
    """Bucket counts: BUCKETS rows at most, whatever the corpus."""
    return {r.bucket: r.n for r in bucketed(docs).groupBy("bucket").agg(F.count("*").alias("n")).collect()}


def labelled_ids(marks: DataFrame, half: int) -> DataFrame:
    """doc_id, quality of all labelled rows of one half; of several labels the least holds."""
    rows = no_clash(marks, "doc_id", "quality").where((F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == half) & F.col("quality").isin(0, 1))
    return rows.groupBy("doc_id").agg(F.min("quality").alias("quality"))


def weights(docs: DataFrame, marks: DataFrame) -> list[float]:
    """log(target / raw) by bucket."""
    ids = labelled_ids(marks.where("quality = 1"), 0).select("doc_id")
    target, raw = counts(no_clash(docs, "doc_id", "text").join(ids.hint("merge"), "doc_id", "left_semi")), counts(docs)
    if not target:
        return [0.0] * BUCKETS
    t, c = sum(target.values()) + SMOOTH * BUCKETS, sum(raw.values()) + SMOOTH * BUCKETS
    return [math.log((target.get(b, 0) + SMOOTH) / t) - math.log((raw.get(b, 0) + SMOOTH) / c) for b in range(BUCKETS)]


def threshold_of(docs: DataFrame, marks: DataFrame, weight: list[float]) -> float:
    """The threshold that the half of the labels which gave no target counts sets."""
    return threshold_from(scored(docs, weight), marks)


def threshold_from(rows: DataFrame, marks: DataFrame) -> float:
    """The same from rows of scored(): no text moves."""
    ids = labelled_ids(marks, 1).withColumnRenamed("doc_id", "id").hint("merge")
    return cut_of(rows.where("n_words >= 10").select("doc_id", "llr").join(ids, F.col("doc_id") == F.col("id")).select("llr", "quality"))


def cut_of(rows: DataFrame) -> float:
    """best_cut of llr, quality rows, however many: running sums within bins of scores, behind the sums of the bins before."""
    good, bad = (F.count(F.when(F.col("quality") == q, 1)) for q in (1, 0))
    each = stored(rows.groupBy("llr").agg(good.alias("good"), bad.alias("bad")).withColumn("bin", F.floor(F.col("llr") * BINS)))
    bins = sorted(each.groupBy("bin").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"), F.min("llr").alias("low")).collect())
    n_good, n_bad = sum(b.good for b in bins), sum(b.bad for b in bins)
    if not n_good or not n_bad:
        return THRESHOLD
    before, sums = [], [0, 0]
    for b in bins:
        before.append((b.bin, *sums))
        sums = [sums[0] + b.good, sums[1] + b.bad]
    within = Window.partitionBy("bin").orderBy("llr").rowsBetween(Window.unboundedPreceding, 0)
    run = each.select("bin", "llr", *(F.sum(c).over(within).alias(c) for c in ("good", "bad")))
    met = run.join(F.broadcast(rows.sparkSession.createDataFrame(before, "bin long, good_before long, bad_before long")), "bin")
    # Whole numbers in place of shares, so that equal costs are equal.
    cost = LOSS * float(n_bad) * (F.col("good") + F.col("good_before")) - float(n_good) * (F.col("bad") + F.col("bad_before"))
    top = met.select(cost.alias("cost"), "llr").orderBy("cost", "llr").first()
    if top.cost >= 0:
        return round(bins[0].low - 1e-6, 9)
    above = each.where(F.col("llr") > top.llr).agg(F.min("llr")).first()[0]
    return round((top.llr + (top.llr + 2e-6 if above is None else above)) / 2, 9)


def best_cut(good: list[float], bad: list[float]) -> float:
    """Midway between two scores, so that LOSS times the share of good ones below and the share of bad ones above are least.

    cut_of does this on tables; this is its plain statement, on lists.
    """
    if not good or not bad:
        return THRESHOLD
    rows = sorted([(x, 1) for x in good] + [(x, 0) for x in bad])
    cost, best, cut = 1.0, 1.0, rows[0][0] - 1e-6
    for k, (x, is_good) in enumerate(rows):
        cost += LOSS / len(good) if is_good else -1 / len(bad)
        above = rows[k + 1][0] if k + 1 < len(rows) else x + 2e-6
        if above > x and cost < best - 1e-12:
            best, cut = cost, (x + above) / 2
    return round(cut, 9)


def repeated_words(hashes: Column) -> Column:
    """Words that lie in a 5-word window found twice or more: windows sorted by hash show equal neighbours."""
    grams = grams_of(hashes, 5)

    def covered(g: Column) -> Column:
        pairs = F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("g"), i.alias("at"))))

        def marked(p: Column) -> Column:
            hit = F.filter(p, lambda x, k: F.coalesce(x.g == F.get(p, k - 1).g, F.lit(False)) | F.coalesce(x.g == F.get(p, k + 1).g, F.lit(False)))
            places = F.sort_array(F.transform(hit, lambda x: x["at"]))
            start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
            step = lambda acc, at: F.struct((acc["n"] + at + 5 - F.greatest(acc["end"], at)).cast("long").alias("n"), (at + 5).alias("end"))
            return F.aggregate(places, start, step)["n"]

        return F.get(F.transform(F.array(pairs), marked), 0)

    once = F.get(F.transform(F.array(grams), lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0).cast("long")).otherwise(covered(g))), 0)
    return F.when(F.size(hashes) < 5, F.lit(0).cast("long")).otherwise(once)


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, h, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words for each row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))
    rows = no_clash(docs, "doc_id", "text").select(
        "doc_id",
        F.transform(words_of(F.col("text")), lambda w: F.xxhash64(w)).alias("h"),
        F.length(reduce(lambda t, c: F.replace(t, F.lit(c), F.lit("")), SPACE, text)).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        lines.alias("lines"),
    )
    return rows.select(
        "doc_id", "h", F.size("h").cast("long").alias("n_words"), "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), repeated_words(F.col("h")).alias("n_repeat_words"),
    )


def score_of(hashes: Column, weight: list[float]) -> Column:
    """Mean weight of the words and pairs; 0 without words."""
    table = F.split(F.lit(",".join(map(repr, weight))), ",").cast("array<double>")
    add = lambda acc, g: acc + F.get(table, F.pmod(g, F.lit(BUCKETS)).cast("int"))
    total = F.aggregate(grams_of(hashes, 2), F.aggregate(hashes, F.lit(0.0), add), add)
    return F.when(F.size(hashes) == 0, 0.0).otherwise(total / (F.size(hashes) * 2 - 1))


def with_base(docs: DataFrame) -> DataFrame:
    """doc_id, h, n_words, the four counts, base_failed for each row: nothing is trained for these."""
    return measured(docs).withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


def scored(docs: DataFrame, weight: list[float]) -> DataFrame:
    """doc_id, n_words, the four counts, base_failed, llr for each row."""
    return with_base(docs).withColumn("llr", score_of(F.col("h"), weight)).drop("h")


def verdict(rows: DataFrame, threshold: float) -> DataFrame:
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & (F.col("llr") >= threshold)).alias("kept"), "llr")


def judge(docs: DataFrame, weight: list[float], threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_words, the four counts, base_failed, kept, llr for each row."""
    return verdict(scored(docs, weight), threshold)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, marks = documents(spark, sf_dir), labels(spark, sf_dir)
    rows = stored(scored(docs, weights(docs, marks)))
    return verdict(rows, threshold_from(rows, marks))
