"""Near-dedup by the Jaccard similarity of 5-word shingles, exactly: all pairs of SIMILAR (4/5) or more link.

A text is the set of the XXH64 hashes of its 5-word shingles (of all its words, where there are fewer). Equal sets are one
node. Shingles have one order for all sets, rare ones first (frequencies by a sample, so they cost speed at most, never a
pair). Two sets that link share one of the first n - ceil(4n/5) + 1 of their n shingles: those are the keys by which they meet.

Pairs that met are discarded without a look at the sets when sizes, places of the shared key, or sketches say that they
can't link: a sketch has the parity of each of 256 hash classes, and each class that differs stands for a shingle that
only one set has (4096 classes for large sets). Survivors are verified on the whole sets.

All pairs of a key of FEW members are compared at once. Crowds need no square of pairs: HUB_ROUNDS times, each key's
members are compared with one of them only, and what links is one class from then on. After that every pair of a key whose
classes differ is compared.

The method of op3 comes first: fingerprints (bitwise majority) of the sets meet in the cells of its pivot tables, are
discarded by the largest difference, and what survives is verified as above. Sets that it links are one class from the
start. Fingerprints of a pair of 4/5 differ in some 10 bits, which no pivot table narrows down, so the join finds the rest.

Texts without words link with each other. Repeated rows each count; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_batch, done_with, no_clash, scratch, spread_join, stored
from .components import components
from .simhash import SEED, classes_of, edges, keep_first, majority, signed

SHINGLE, HUB_ROUNDS = 5, 2
#: Rows that tell frequencies of shingles, and how many frequent shingles are told apart.
SAMPLE_ROWS, FREQUENT = 5_000, 200_000
SKETCH = [f"p{i}" for i in range(4)]
#: Members up to which all pairs of a key are compared at once. Sets above WIDE have a sketch of 4096 classes too.
FEW, WIDE = 8, 400


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct hashes."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h, join = xxhash.xxh64_intdigest, b" ".join
    if len(words) < SHINGLE:
        return np.array([h(join(words), SEED)], np.uint64)
    hashes = (h(join(t), SEED) for t in zip(*(words[i:] for i in range(SHINGLE)), strict=False))
    return np.unique(np.fromiter(hashes, np.uint64, len(words) - SHINGLE + 1))


def sketch(s: np.ndarray, classes: int = 256) -> np.ndarray:
    odd = np.bincount((s & np.uint64(classes - 1)).astype(np.int64), minlength=classes) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def hashed(docs: DataFrame) -> DataFrame:
    """doc_id, th (a hash that tells texts of one id apart), text."""
    return no_clash(docs, "doc_id", "text").select("doc_id", F.xxhash64("text").alias("th"), "text")


def sets_of(rows: DataFrame, name: str) -> DataFrame:
    """The named column, then s (the set) for each row."""
    return by_batch(rows, [name, "text"], lambda ids, texts: {name: ids, "s": [shingles(t).view(np.int64) for t in texts]}, f"{name} long, s array<long>", 500_000)


def frequent(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles of a bounded sample, sorted, and how often each is found there."""
    share = min(1_000_000, SAMPLE_ROWS * 1_000_000 // max(1, rows.count()) + 1)
    some = sets_of(rows.where(F.pmod("th", F.lit(1_000_000)) < share), "th").select(F.explode("s").alias("h"))
    top = some.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").orderBy(F.desc("n"), "h").limit(FREQUENT).toArrow()
    h, n = top["h"].to_numpy().view(np.uint64), top["n"].to_numpy()
    order = np.argsort(h)
    return h[order], n[order]


def prefix(s: np.ndarray, often: np.ndarray, times: np.ndarray) -> np.ndarray:
    """The first shingles by frequency, then hash: two sets that link share one of them."""
    k = len(s) - (4 * len(s) + 4) // 5 + 1 if len(s) else 0
    if len(often):
        at = np.minimum(np.searchsorted(often, s), len(often) - 1)
        s = s[np.argsort(np.where(often[at] == s, times[at], 0), kind="stable")]
    return s[:k]


def shingled(docs: DataFrame) -> DataFrame:
    """doc_id, th, sid (of the set), mark (its fingerprint), n, sketch, a wide one for large sets, keys for each row."""
    rows = hashed(docs)
    often, times = frequent(rows)

    def work(ids: list, hashes: list, texts: list) -> dict:
        sets = [shingles(t) for t in texts]
        sketches = np.stack([sketch(s) for s in sets])
        return {
            "doc_id": ids, "th": hashes, "sid": [signed(xxhash.xxh64_intdigest(s.tobytes(), SEED)) for s in sets], "mark": [signed(majority(s)) for s in sets], "n": [len(s) for s in sets],
            **{p: sketches[:, i] for i, p in enumerate(SKETCH)}, "wide": [sketch(s, 4096) if len(s) > WIDE else [] for s in sets], "keys": [prefix(s, often, times).view(np.int64) for s in sets],
        }

    return by_batch(rows, ["doc_id", "th", "text"], work, f"doc_id long, th long, sid long, mark long, n int, {', '.join(f'{p} long' for p in SKETCH)}, wide array<long>, keys array<long>", 500_000)


def may_link(a: str, b: str) -> Column:
    """Whether sizes, places and sketches leave it open that two members of a key link."""
    of = lambda t, c: F.col(f"{t}.{c}")
    both = of(a, "n") + of(b, "n")
    left = F.least(of(a, "n") - of(a, "place"), of(b, "n") - of(b, "place"))
    apart = sum((F.bit_count(of(a, p).bitwiseXOR(of(b, p))) for p in SKETCH), F.lit(0))
    return (of(a, "root") != of(b, "root")) & (5 * F.least(of(a, "n"), of(b, "n")) >= 4 * F.greatest(of(a, "n"), of(b, "n"))) & (9 * left >= 4 * both) & (9 * apart <= both)


def wide_enough(pairs: DataFrame, large: DataFrame) -> DataFrame:
    """Pairs of large sets (sid, n, wide) whose wide sketches leave it open that they link, and all other pairs."""
    met = pairs
    for c in "ab":
        met = met.join(large.select(F.col("sid").alias(c), F.col("n").alias(f"n{c}"), F.col("wide").alias(f"w{c}")), c, "left")
    apart = F.aggregate(F.zip_with("wa", "wb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x)
    return stored(met.where(F.coalesce(9 * apart <= F.col("na") + F.col("nb"), F.lit(True))).select("a", "b"))


def verified(pairs: DataFrame, docs: DataFrame, rows: DataFrame) -> DataFrame:
    """a, b of pairs whose similarity is 4/5 or more."""
    wanted = pairs.select(F.col("a").alias("sid")).unionByName(pairs.select(F.col("b").alias("sid"))).distinct()
    ids = stored(rows.join(wanted, "sid", "left_semi").groupBy("sid").agg(F.min("th").alias("th")))
    texts = hashed(docs).join(ids, "th").select("sid", "text").dropDuplicates(["sid"])
    some = stored(sets_of(texts, "sid"))
    both = pairs.join(some.select(F.col("sid").alias("a"), F.col("s").alias("sa")), "a").join(some.select(F.col("sid").alias("b"), F.col("s").alias("sb")), "b")
    good = 9 * F.size(F.array_intersect("sa", "sb")) >= 4 * (F.size("sa") + F.size("sb"))
    return both.where(good).select("a", "b")


ABOUT = ["sid", "place", "n", *SKETCH, "root"]


def linked(pairs: DataFrame, docs: DataFrame, rows: DataFrame, large: DataFrame) -> DataFrame:
    """a, b of those pairs (x, y: members of one key) that link, stored; what is stored on the way is deleted."""
    a, b = F.col("x.sid"), F.col("y.sid")
    with scratch(docs.sparkSession) as keep:
        met = stored(pairs.where(may_link("x", "y")).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct())
        return keep(verified(wide_enough(met, large), docs, rows) if met.limit(1).count() else met)


def pivot_links(docs: DataFrame, rows: DataFrame, large: DataFrame) -> DataFrame:
    """a, b of linked sets that op3's pivot tables bring together by their fingerprints: a star for equal ones, a forest for near ones."""
    marks = rows.select("sid", "mark").distinct()
    firsts = stored(marks.groupBy("mark").agg(F.min("sid").alias("b"), F.count("*").alias("m")))
    same = spread_join(marks, firsts, ["mark"], "m").where("sid <> b").select(F.col("sid").alias("a"), "b")
    near = edges(firsts.select(F.col("mark").alias("fp"))).distinct()
    for c in "ab":
        near = near.join(firsts.select(F.col("mark").alias(c), F.col("b").alias(f"{c}s")), c)
    pairs = near_pairs = stored(same.unionByName(near.select(F.col("as").alias("a"), F.col("bs").alias("b"))))
    about = rows.select("sid", F.lit(0).alias("place"), "n", *SKETCH, F.col("sid").alias("root"))
    about = about.join(pairs.select(F.explode(F.array("a", "b")).alias("sid")).distinct(), "sid", "left_semi").dropDuplicates(["sid"])
    about = stored(about.select("sid", F.struct(*ABOUT).alias("s")))
    for c, side in (("a", "x"), ("b", "y")):
        pairs = pairs.join(about.select(F.col("sid").alias(c), F.col("s").alias(side)), c)
    out = linked(pairs, docs, rows, large)
    done_with(docs.sparkSession, firsts, near_pairs, about)
    return out


def similar_roots(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """rows of shingled() -> node, root: classes of linked sets; sets that link with none are absent.

    Stored tables are deleted once read, shuffles of finished steps with them: on few rows and many partitions files take more disk than rows.
    """
    spark = docs.sparkSession
    keys = rows.select("sid", F.posexplode("keys").alias("place", "key"))
    shared = keys.groupBy("key").agg(F.min("sid").alias("lo"), F.max("sid").alias("hi"), F.count("*").alias("m")).where("lo < hi").select("key", "m", (F.col("m") <= FEW).alias("few"))
    shared = stored(shared)
    first = stored(spread_join(keys, shared, ["key"], "m").distinct())
    about = rows.select("sid", "n", *SKETCH).join(first.select("sid").distinct(), "sid", "left_semi").dropDuplicates(["sid"])
    large = stored(rows.where(F.col("n") > WIDE).select("sid", "n", "wide").dropDuplicates(["sid"]))
    roots = stored(components(pivot_links(docs, rows, large)))
    met = stored(first.join(about, "sid").join(roots.withColumnRenamed("node", "sid"), "sid", "left").withColumn("root", F.coalesce("root", "sid")))
    done_with(spark, shared, first)
    few = met.where("few")
    found = linked(few.alias("x").join(few.alias("y"), F.col("x.key") == F.col("y.key")), docs, rows, large)
    crowds = stored(met.where("not few").drop("few", "root"))
    done_with(spark, met)

    def open_keys() -> tuple[DataFrame, DataFrame]:
        """Members of crowded keys that hold more than one class, and those keys with their size m and largest class."""
        now = stored(crowds.join(roots.withColumnRenamed("node", "sid"), "sid", "left").withColumn("root", F.coalesce("root", "sid")))
        each = now.groupBy("key", "root").agg(F.count("*").alias("m"))
        still = stored(each.groupBy("key").agg(F.max_by("root", F.struct("m", "root")).alias("main"), F.sum("m").alias("m"), F.count("*").alias("classes")).where("classes > 1").drop("classes"))
        here = stored(spread_join(now, still.select("key", "m"), ["key"], "m"))
        done_with(spark, now)
        return here, still

    def joined(new: DataFrame) -> DataFrame:
        """Roots after new links: the old ones go in as links."""
        if not new.limit(1).count():
            return roots
        return stored(components(new.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b")))))

    roots = joined(found)
    for turn in range(HUB_ROUNDS):
        here, still = open_keys()
        if not still.limit(1).count():
            return roots
        hubs = stored(here.groupBy("key").agg(F.min_by(F.struct(*ABOUT), F.xxhash64("sid", "key", F.lit(turn))).alias("y")).join(still.select("key", "m"), "key"))
        found = linked(spread_join(here.select("key", F.struct(*ABOUT).alias("x")), hubs, ["key"], "m"), docs, rows, large)
        done_with(spark, here, still, hubs)
        roots = joined(found)
    here, still = open_keys()
    # The key's largest class is left out on one side: its members need no look at each other.
    others = spread_join(here, still, ["key"], "m").where("root <> main").drop("main")
    found = linked(others.alias("x").join(here.alias("y"), F.col("x.key") == F.col("y.key")), docs, rows, large)
    done_with(spark, here, still, crowds, large)
    return joined(found)


def similar_classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows: doc_id, th, fp, n; classes: fp, root, size, first), as of simhash.near_classes; fp stands for the set."""
    whole = stored(shingled(docs))
    rows = stored(whole.groupBy("doc_id", "th", F.col("sid").alias("fp")).agg(F.count("*").alias("n")))
    classes = classes_of(rows, lambda _: similar_roots(docs, whole))
    done_with(docs.sparkSession, whole)
    return rows, classes


def keep_first_similar(docs: DataFrame) -> DataFrame:
    """Of each class of similar texts the row with the smallest id, with all its columns."""
    return keep_first(docs, *similar_classes(docs))
