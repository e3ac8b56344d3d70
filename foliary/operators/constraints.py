"""Integrity rules as violation frames: no rows means that the rule holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Exit codes, kinds, patterns of file names.
EXIT_CODES = {"ok": 0, "invalid_input": 10, "extraction": 20, "verification": 30, "build": 40, "internal": 50}
KINDS = ("contents", "editorial", "research", "digest", "info")
RESEARCH_NAME = r"^[A-Za-z]+_\d{4}-\d{2}_\d{3}-\d{3}_[A-Z][a-z]+\.pdf$"
SERVICE_NAME = r"^[A-Za-z]+_\d{4}-\d{2}_\d{3}-\d{3}_(Contents|Editorial|Digest|Info)\.pdf$"


class RuleBroken(ValueError):
    """Carries the exit code of the stage whose rule is broken."""

    def __init__(self, rule: str, code: int) -> None:
        super().__init__(f"{rule} (exit code {code})")
        self.code = code


def require(violations: DataFrame, rule: str, code: int) -> None:
    """Raise on the first violation."""
    if violations.limit(1).count():
        raise RuleBroken(rule, code)


def bad_ranges(ranges: DataFrame, totals: DataFrame) -> DataFrame:
    """V3: pages from 1 to the issue's total, from <= to, a known kind."""
    met = ranges.join(totals, "issue", "left")
    rule = F.when(F.col("lo").isNull() | F.col("hi").isNull(), "missing").when((F.col("lo") < 1) | (F.col("hi") < 1), "below_one").when(F.col("lo") > F.col("hi"), "reversed").when(F.col("hi") > F.col("total_pages"), "beyond_end").when(~F.col("kind").isin(*KINDS), "kind")
    return met.withColumn("rule", rule).where("rule is not null").select("issue", "id", "rule")


def without_ranges(issues: DataFrame, ranges: DataFrame) -> DataFrame:
    """V4: issues without any range."""
    return issues.join(ranges, "issue", "left_anti")


def broken_chain(ranges: DataFrame, totals: DataFrame) -> DataFrame:
    """V9: ranges that don't begin where the one before ends, and last ones that don't end with the issue."""
    w = Window.partitionBy("issue").orderBy("nth")
    met = ranges.withColumn("before", F.lag("hi").over(w)).withColumn("next", F.lead("nth").over(w)).join(totals, "issue")
    rule = F.when(F.col("lo") <= F.col("before"), "overlap").when(F.col("lo") > F.col("before") + 1, "gap").when(F.col("next").isNull() & (F.col("hi") != F.col("total_pages")), "end")
    return met.withColumn("rule", rule).where("rule is not null").select("issue", "id", "rule")


def uncertain_starts(starts: DataFrame) -> DataFrame:
    """V9: starts whose confidence isn't 1."""
    return starts.where(~F.coalesce(F.col("confidence") == 1.0, F.lit(False)))


def bad_names(articles: DataFrame) -> DataFrame:
    """V5, V6: file names that don't fit their kind or the policy; research without surname."""
    service = F.col("filename").rlike(SERVICE_NAME)
    rule = (
        F.when(~F.col("kind").isin(*KINDS), "kind").when(F.col("filename").isNull(), "missing")
        .when((F.col("kind") == "research") & (F.coalesce("surname", F.lit("")) == ""), "surname")
        .when((F.col("kind") == "research") & service, "suffix").when((F.col("kind") == "research") & ~F.col("filename").rlike(RESEARCH_NAME), "pattern")
        .when((F.col("kind") != "research") & ~F.col("filename").endswith(F.concat(F.lit("_"), F.initcap("kind"), F.lit(".pdf"))), "suffix")
        .when((F.col("kind") != "research") & ~service, "pattern")
    )
    return articles.withColumn("rule", rule).where("rule is not null").select("issue", "id", "rule")


def unequal_counts(total: DataFrame, listed: DataFrame, exported: DataFrame) -> DataFrame:
    """Issues whose stated total, listed articles and exported files differ in number."""
    count = lambda df, n: df.groupBy("issue").agg(F.count("*").alias(n))
    met = total.join(count(listed, "l"), "issue", "full_outer").join(count(exported, "e"), "issue", "full_outer").na.fill(0)
    return met.where("total <> l or total <> e")


def checksum_mismatches(computed: DataFrame, listed: DataFrame, manifest: DataFrame, strict: bool = False) -> DataFrame:
    """Files (name, sha) against checksum list and manifest, by bare name. A missing side passes unless strict."""
    bare = lambda df, n: df.select(F.element_at(F.split("name", "/"), -1).alias("name"), F.col("sha").alias(n))
    met = bare(computed, "c").join(bare(listed, "f"), "name", "left").join(bare(manifest, "m"), "name", "left")
    wrong = (F.col("c") != F.col("f")) | (F.col("c") != F.col("m"))
    return met.where(F.coalesce(wrong, F.lit(False)) | (F.lit(strict) & (F.col("f").isNull() | F.col("m").isNull())))


def bad_copies(copies: DataFrame) -> DataFrame:
    """V8: copies whose size or hash isn't the source's."""
    return copies.where("not (bytes <=> source_bytes) or not (sha <=> source_sha)")


def missing_files(required: DataFrame, found: DataFrame) -> DataFrame:
    """V7: required paths that are absent."""
    return required.join(found, "path", "left_anti")


#: What an export folder must hold.
EXPORT_PARTS = ("articles", "manifest", "checksums.sha256", "README.md")


def incomplete_exports(exports: DataFrame, found: DataFrame) -> DataFrame:
    """V7: exports (export) that lack a part, with the part; found: export, name of what each folder holds."""
    needed = exports.select("export", F.explode(F.array(*map(F.lit, EXPORT_PARTS))).alias("name"))
    return needed.join(found, ["export", "name"], "left_anti")


def bad_inputs(inputs: DataFrame, files: DataFrame) -> DataFrame:
    """Inputs (issue_id, journal_code, pdf_path) without a required field, or whose path is absent or no file.

    files: path, is_file of what is there.
    """
    blank = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    met = inputs.join(files.select(F.col("path").alias("pdf_path"), "is_file"), "pdf_path", "left")
    rule = F.when(blank("issue_id"), "issue_id").when(blank("journal_code"), "journal_code").when(blank("pdf_path"), "pdf_path").when(F.col("is_file").isNull(), "absent").when(~F.col("is_file"), "no_file")
    return met.withColumn("rule", rule).where("rule is not null").select("issue_id", "journal_code", "pdf_path", "rule")


def split_files(ranges: DataFrame, files: DataFrame) -> DataFrame:
    """Each range with its split file; violations are rows without one, or with an empty one."""
    named = ranges.withColumn("file", F.concat_ws("_", F.col("issue").cast("string"), F.concat("id", F.lit(".pdf"))))
    return named.join(files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "path", "bytes"), "file", "left").withColumn("ok", F.coalesce(F.col("bytes") > 0, F.lit(False)))


def positional_mismatches(actual: DataFrame, golden: DataFrame) -> DataFrame:
    """Rows of (issue, nth, lo, hi) paired by position that differ, or have no partner."""
    a, g = actual.select("issue", "nth", F.struct("lo", "hi").alias("a")), golden.select("issue", "nth", F.struct("lo", "hi").alias("g"))
    return a.join(g, ["issue", "nth"], "full_outer").where("not (a <=> g)").select("issue", "nth", "a.lo", "a.hi", F.col("g.lo").alias("golden_lo"), F.col("g.hi").alias("golden_hi"))


def bag_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of one bag that the other lacks, with their side; empty for equal bags."""
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))


def bad_codes(issues: DataFrame) -> DataFrame:
    """Journal codes that aren't two letters (of any script)."""
    return issues.where(~F.coalesce(F.col("journal_code").rlike(r"^\p{L}{2}$"), F.lit(False)))


def bad_starts(starts: DataFrame) -> DataFrame:
    """Starts without a page from 1 on, or without a kind."""
    return starts.where("start_page is null or start_page < 1 or kind is null")


def less_fields(column: str, fields: tuple[str, ...]) -> Column:
    """An array of structs without some of their fields."""
    return F.transform(column, lambda x: x.dropFields(*fields))


def unlike_manifests(actual: DataFrame, golden: DataFrame, key: str, drop: tuple[str, ...] = (), drop_within: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """Keys whose manifests differ, or are on one side only, when fields of each run are left out.

    drop: top-level fields; drop_within: fields of the structs in an array column, by column.
    """

    def bare(df: DataFrame, name: str) -> DataFrame:
        out = df.drop(*drop)
        for column, fields in (drop_within or {}).items():
            out = out.withColumn(column, less_fields(column, fields))
        return out.select(key, F.struct(*sorted(c for c in out.columns if c != key)).alias(name))

    met = bare(actual, "a").join(bare(golden, "g"), key, "full_outer")
    return met.where("not (a <=> g)").select(key, F.when(F.col("a").isNull(), "golden_only").when(F.col("g").isNull(), "actual_only").otherwise("differs").alias("rule"))


def grafted(documents: DataFrame, more: DataFrame, key: str, column: str) -> DataFrame:
    """Documents with one column of another stage's document put in; null where that stage gave none."""
    return documents.join(more.select(key, column), key, "left")
