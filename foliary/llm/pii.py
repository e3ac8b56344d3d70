"""Personal data by candidate gradient boosting, with DataFrame functions alone.

Base rules find e-mail addresses, IP addresses, card numbers (Luhn) and phone numbers; what they find stays. Beside them
high-recall generators propose overlapping candidates: runs and groups of digits, addresses with a written-out "at",
account numbers. Each has discrete features of format (digits, groups, separators, check digits, lead) and context (what
stands around it, cue words before it).

Boosted trees are fitted over counts of distinct feature vectors: all candidates count, yet the table has no more rows
than there are vectors. A candidate is a positive if a base span touches it or a check of its own holds: Luhn for 13 to
19 digits, the remainder by 97 for account numbers, for written-out addresses a domain ending that base addresses have
too. Half of the ids (by crc32) fit the trees, the other half sets a threshold for each generator, the lowest at which
PRECISION of its candidates are positives. Candidates apart from base spans that reach it are added; of those that
overlap the one with the best score, then the longest, then the first.

Nulls count as empty: no spans. Without candidates nothing is added. Repeated rows each get their row; extra columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .boosting import Boosted, calibrated, fit
from .common import documents, no_clash, stored

KINDS = ("email", "ip", "card", "phone")
PRECISION = 0.98
#: Domain endings of base addresses that count as known: the most frequent ones.
ENDINGS = 2000
#: A letter of the private use area stands for a single separator between digits, so that a number is one run.
JOINT, OTHER = "\ue000", "\ue001"
LOCAL = r"A-Za-z0-9._%+-"
EMAIL = rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
BYTE = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9][0-9]|[0-9]|)"
CARD = rf"[0-9][0-9{JOINT}]+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Generators of candidates: whole runs of digits and separators, addresses in words, account numbers; card and phone
#: numbers of the usual shape also within a longer run, which a base rule takes, and drops, as a whole. Runs have no
#: greatest length, so none is cut within; each is read once.
AT, DOT = r"\x20?[\[(](?:at|AT)[\])]\x20?", r"(?:\.|\x20?[\[(](?:dot|DOT)[\])]\x20?)"
GENERATORS = (
    r"\+?[0-9(](?:[\x20().-]*+[0-9])++",
    rf"(?<![{LOCAL}])[{LOCAL}]++{AT}[A-Za-z0-9-]++(?:{DOT}[A-Za-z0-9-]++)++",
    r"\b[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)\b",
    r"(?<![0-9])[0-9]{4}(?:[\x20-]?[0-9]{4}){3}(?![0-9])",
    r"\+[0-9]{1,3}[\x20.-]?\(?[0-9]{2,4}\)?[\x20.-]?[0-9]{3}[\x20.-]?[0-9]{4}(?![0-9])",
)
NUMBER, WRITTEN, ACCOUNT = 0, 1, 2
CUES = r"(?:phone|tel|mobile|call|card|visa|account|iban|mail|contact|ssn|passport|reach|write)[^\n]{0,16}$"
FEATURES = ("gen", "digits", "groups", "plus", "sep", "check", "cue", "before", "after", "lead")


def located(text: Column, pattern: str, when: Column) -> Column:
    """array of (start, end, value): matches interleave with the pieces that a split leaves. Code points, end exclusive."""
    matches, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    kind = "struct<at:int,found:array<struct<start:int,end:int,value:string>>>"

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["value"])
        return F.struct(end.alias("at"), F.concat(acc["found"], F.array(F.struct(start.alias("start"), end.alias("end"), x["value"].alias("value")))).alias("found")).cast(kind)

    pairs = F.zip_with(matches, F.slice(gaps, 1, F.greatest(F.size(matches), F.lit(1))), lambda m, g: F.struct(m.alias("value"), g.alias("gap")))
    pairs = F.filter(pairs, lambda x: x["value"].isNotNull())
    first = F.struct(F.lit(0).alias("at"), F.array().alias("found")).cast(kind)
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return F.when(when, F.aggregate(pairs, first, step)["found"]).otherwise(none)


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Whether the digits pass the Luhn check."""
    back = F.split(F.reverse(digits_of(value)), "")
    numbers = F.transform(F.filter(back, lambda x: x != ""), lambda x, i: F.when(i % 2 == 0, x.cast("int")).otherwise((x.cast("int") * 2).cast("int") - F.when(x.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(numbers, F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(value: Column) -> Column:
    """Whether an account number's remainder by 97 is 1: the first four characters go to the end, letters count from 10."""
    plain = F.regexp_replace(value, "[^A-Z0-9]", "")
    chars = F.split(F.concat(F.substr(plain, F.lit(5)), F.substring(plain, 1, 4)), "")
    step = lambda acc, x: F.when(x.rlike("[0-9]"), acc * 10 + x.cast("int")).otherwise(acc * 100 + F.ascii(x) - 55) % 97
    return F.aggregate(F.filter(chars, lambda x: x != ""), F.lit(0), lambda acc, x: step(acc, x).cast("int")) == 1


def ending(value: Column) -> Column:
    """What follows the last dot of an address, written out or not, in lower case."""
    return F.lower(F.regexp_extract(value, r"([A-Za-z0-9-]+)$", 1))


def base_spans(text: Column) -> dict[str, Column]:
    """Matches of each kind that pass the kind's test."""
    # A number with 16 digits, bounded: it says which texts are worth the joining of separators.
    long_number = text.rlike(r"[0-9](?:[\x20-]?[0-9]){15}")
    joined = F.regexp_replace(F.translate(text, JOINT, OTHER), r"(?<=[0-9])[\x20-](?=[0-9])", JOINT)

    def sized(lo: int, hi: int):  # noqa: ANN202
        return lambda m: F.length(digits_of(m["value"])).between(lo, hi)

    return {
        "email": located(text, EMAIL, text.contains("@")),
        "ip": F.filter(located(text, IP, text.rlike(r"[0-9]\.[0-9]")), lambda m: m["value"].rlike(rf"^(?:{BYTE}\.){{3}}{BYTE}$")),
        "card": F.filter(F.filter(located(joined, CARD, long_number), sized(16, 19)), lambda m: luhn(m["value"])),
        "phone": F.filter(located(text, PHONE, text.contains("+")), sized(8, 15)),
    }


def described(text: Column, gen: int, m: Column) -> Column:
    """A candidate with its features."""
    value, n = m["value"], F.length(digits_of(m["value"]))
    before = F.substr(text, F.greatest(m["start"] - 23, F.lit(1)), F.least(m["start"], F.lit(24)))
    near = F.when(m["start"] > 0, F.substr(text, m["start"], F.lit(1))).otherwise("")
    after = F.substr(text, m["end"] + 1, F.lit(1))
    flag = lambda c: c.cast("int")
    return F.struct(
        m["start"].alias("start"), m["end"].alias("end"), F.lit(gen).alias("gen"),
        F.when(n < 8, 0).when(n < 10, 1).when(n < 13, 2).when(n < 16, 3).when(n < 20, 4).otherwise(5).alias("digits"),
        F.least(F.size(F.filter(F.split(value, "[^0-9]+"), lambda x: x != "")), F.lit(8)).alias("groups"),
        flag(value.startswith("+")).alias("plus"),
        F.when(value.rlike(r"^[^.]*\.[^.]*\.[^.]*\.[^.]*$"), 3).when(value.contains("("), 2).when(value.rlike(r"[\x20-]"), 1).otherwise(0).alias("sep"),
        flag(F.lit(False) if gen == WRITTEN else mod97(value) if gen == ACCOUNT else F.when(n.between(13, 19), luhn(value)).otherwise(False)).alias("check"),
        flag(F.lower(before).rlike(CUES)).alias("cue"), flag(near.rlike(r"[\p{L}\p{N}]")).alias("before"), flag(after.rlike(r"[\p{L}\p{N}]")).alias("after"),
        F.when(value.rlike("^[0-9]"), value.substr(1, 1).cast("int")).otherwise(10).alias("lead"),
        (ending(value) if gen == WRITTEN else F.lit(None).cast("string")).alias("ending"),
    )


def describing(text: Column, gen: int):  # noqa: ANN201
    """One argument only: transform() would hand a second one the element's place."""
    return lambda m: described(text, gen, m)


def proposed(docs: DataFrame) -> DataFrame:
    """doc_id, base spans by kind, endings of base addresses, candidates with features and whether a base span touches them."""
    rows = no_clash(docs, "doc_id", "text").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    text = F.col("text")
    base = rows.select("doc_id", "text", *(c.alias(k) for k, c in base_spans(text).items()))
    worth = [text.rlike(r"[0-9](?:[\x20().-]*+[0-9]){5}"), text.rlike(r"[\[(](?:at|AT)[\])]"), text.rlike(r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4}"), text.rlike(r"[0-9]{4}(?:[\x20-]?[0-9]{4}){3}"), text.contains("+")]
    cands = F.concat(*(F.transform(wide(k, located(text, g, w)), describing(text, k)) for k, (g, w) in enumerate(zip(GENERATORS, worth, strict=True))))
    short = [F.transform(k, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"))).alias(k) for k in KINDS]
    met = base.select("doc_id", *short, F.transform("email", lambda m: ending(m["value"])).alias("endings"), cands.alias("cands"))
    every = F.concat(*KINDS)
    touch = lambda c: F.exists(every, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))
    return met.withColumn("cands", F.transform("cands", lambda c: c.withField("base", touch(c))))


def wide(gen: int, found: Column) -> Column:
    """Of runs of digits those of six characters or more."""
    return F.filter(found, lambda m: m["end"] - m["start"] >= 6) if gen == NUMBER else found


def learned(found: DataFrame) -> tuple[Boosted, list[float]]:
    """The model and a threshold for each generator, from counts of distinct feature vectors over all candidates."""
    known = found.select(F.explode("endings").alias("x")).groupBy("x").agg(F.count("*").alias("n")).where("n > 1").orderBy(F.desc("n"), "x").limit(ENDINGS).collect()
    half = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2, F.lit(0)).cast("int")
    good = F.col("c.base") | (F.col("c.check") == 1) | F.coalesce(F.col("c.ending").isin([r.x for r in known]), F.lit(False))
    each = found.select(half.alias("half"), F.explode("cands").alias("c")).groupBy("half", *(F.col(f"c.{f}").alias(f) for f in FEATURES))
    table = each.agg(F.count_if(good).alias("pos"), F.count_if(~good).alias("neg")).orderBy("half", *FEATURES).collect()
    rows = [[(r.asDict(), float(r.pos), float(r.neg)) for r in table if r.half == h] for h in (0, 1)]
    model = fit(rows[0], list(FEATURES))
    return model, [calibrated(model, [x for x in rows[1] if x[0]["gen"] == g], PRECISION) for g in range(len(GENERATORS))]


def chosen(cands: Column, model: Boosted, least: list[float]) -> Column:
    """start, end of candidates apart from base spans that reach their generator's threshold; none overlaps another."""
    kind = "array<struct<start:int,end:int>>"

    def passes(c: Column) -> Column:
        out = F.lit(False)
        for g, x in enumerate(least):
            if x != float("inf"):
                out = out | ((c["gen"] == g) & (model.column(c) >= x))
        return ~c["base"] & out

    ranked = F.array_sort(F.transform(F.filter(cands, passes), lambda c: F.struct((-model.column(c)).alias("score"), (c["start"] - c["end"]).alias("size"), c["start"].alias("start"), c["end"].alias("end"))))
    free = lambda kept, c: ~F.exists(kept, lambda k: (k["start"] < c["end"]) & (c["start"] < k["end"]))
    add = lambda kept, c: F.when(free(kept, c), F.concat(kept, F.array(F.struct(c["start"].alias("start"), c["end"].alias("end"))))).otherwise(kept)
    return F.array_sort(F.aggregate(ranked, F.array().cast(kind), lambda kept, c: add(kept, c).cast(kind)))


def joined(spans: Column, kind: str) -> Column:
    return F.transform(spans, lambda s: F.concat_ws(":", F.lit(kind), s["start"], s["end"]))


def find_private(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_other for each row."""
    found = stored(proposed(docs))
    model, least = learned(found)
    none = all(x == float("inf") for x in least)
    more = F.array().cast("array<struct<start:int,end:int>>") if none else chosen(F.col("cands"), model, least)
    rows = found.select("doc_id", *KINDS, more.alias("other"))
    base = F.concat(*(joined(F.col(k), k) for k in KINDS))
    return rows.select(
        "doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS), F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
        F.array_join(F.concat(base, joined(F.col("other"), "other")), ",").alias("spans"), F.size("other").cast("long").alias("n_other"),
    )


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_private(documents(spark, sf_dir))
