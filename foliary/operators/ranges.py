"""From anchors to article ranges with kinds, surnames and file names.

Anchors: issue, seq, page, type, text, value, font_name, font_size. They are read once: page_facts() sums up each page in
one aggregation by issue and page, and all that follows works on pages and articles by issue, so after one exchange by
issue the windows need no further one.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliary.functions import text as T


@dataclass(frozen=True)
class Policy:
    """Fixed values of the detection rules."""

    font_name: str = "MyriadPro-BoldIt"
    font_size: float = 12.0
    tolerance: float = 0.5
    min_chars: int = 10
    bilingual: str = "KEYWORDS|ABSTRACT|SUMMARY|INTRODUCTION"
    info: tuple[str, ...] = ("ИНФОРМАЦИЯ", "INFORMATION")
    digest: tuple[str, ...] = ("дайджест", "digest")
    contents_reach: int = 2
    front_pages: int = 4
    bylines: int = 6
    confidence: float = 1.0
    front_signal: str = "contents_marker_on_first_pages"
    start_signal: str = "typography_descriptor"


POLICY = Policy()


def is_typography(p: Policy = POLICY) -> Column:
    """a text block in the heading font, long enough, not blacklisted."""
    near = F.col("font_size").between(p.font_size - p.tolerance, p.font_size + p.tolerance)
    return F.coalesce((F.col("type") == "text_block") & (F.col("font_name") == p.font_name) & near & (F.length("text") >= p.min_chars) & ~T.is_blacklisted(F.col("text")), F.lit(False))


def typography(anchors: DataFrame, p: Policy = POLICY) -> DataFrame:
    return anchors.where(is_typography(p))


def page_facts(anchors: DataFrame, p: Policy = POLICY) -> DataFrame:
    """All that later steps need of a page, in one aggregation.

    F16-F18, J2, J4, A7: flags. W1, A3: rep (the first heading text), chars of all of them. front: place of the first
    contents marker. J6: ru, en (the first author anchors that are no running headers). W9: bylines, the first of them.
    """
    text, up = F.col("text"), F.col("up")
    kind = lambda k: F.col("type") == k
    # Plain words are looked for as such.
    bilingual = T.any_of(up, tuple(p.bilingual.split("|"))) if re.fullmatch(r"\w+(\|\w+)*", p.bilingual) else up.rlike(p.bilingual)
    flag = lambda c: F.coalesce(F.bool_or(c), F.lit(False))
    doi_start = F.regexp_extract("value", r"\.(\d+)-\d+$", 1)
    early = kind("doi") & F.when(doi_start != "", doi_start.cast("long") < F.col("page"))
    title = F.lower(T.stripped(text))
    at = F.struct("seq", "page", "text")
    heading, header = F.col("heading"), F.col("header")
    rows = anchors.withColumn("heading", is_typography(p)).withColumn("header", F.when(F.col("type").isin("ru_authors", "en_authors", "text_block"), T.is_running_header(text))).withColumn("up", F.when(kind("text_block"), F.upper("text")))
    # Rules first, so that only texts that are kept go into the aggregation, which sorts its rows.
    told = rows.select(
        "issue", "page", "seq",
        (kind("text_block") & bilingual).alias("bilingual"),
        (kind("ru_title") & (title.startswith(p.digest[0]) | title.startswith(p.digest[1]))).alias("digest"),
        (kind("text_block") & T.stripped(up).isin(*p.info)).alias("info"), kind("doi").alias("doi"),
        ((kind("ru_authors") & ~T.is_greeting(text)) | kind("en_authors")).alias("authors"),
        kind("contents_marker").alias("marker"), early.alias("early"),
        F.when(heading, text).alias("rep"),
        F.when(kind("ru_authors") & ~header, at).alias("ru"), F.when(kind("en_authors") & ~header, at).alias("en"),
        F.when(kind("text_block") & ~header & T.is_byline(text), at).alias("byline"),
    )
    c = F.col
    return told.groupBy("issue", "page").agg(
        flag(c("bilingual")).alias("bilingual"), flag(c("digest")).alias("digest"), (flag(c("info")) & ~flag(c("doi"))).alias("info"),
        flag(c("authors")).alias("authors"), flag(c("marker")).alias("marker"), flag(c("early")).alias("mid_article"),
        F.min_by("rep", F.when(c("rep").isNotNull(), c("seq"))).alias("rep"), F.sum(F.length("rep")).alias("chars"),
        F.min(F.when(c("marker"), c("seq"))).alias("front"),
        F.min_by("ru", "ru.seq").alias("ru"), F.min_by("en", "en.seq").alias("en"),
        F.slice(F.array_sort(F.collect_list("byline")), 1, p.bylines).alias("bylines"),
    )


def page_flags(anchors: DataFrame, p: Policy = POLICY) -> DataFrame:
    return page_facts(anchors, p).select("issue", "page", "bilingual", "digest", "info", "authors", "marker", "mid_article")


def with_start(facts: DataFrame) -> DataFrame:
    """`is_start` for pages with a heading, less translations of the heading page before and pages inside an article."""
    before = Window.partitionBy("issue").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    prev = F.last(F.when(F.col("rep").isNotNull(), F.struct("page", "rep", "chars")), ignorenulls=True).over(before)
    met = facts.withColumn("prev", prev)
    twin = (F.col("prev.page") == F.col("page") - 1) & T.is_cyrillic_dominant(F.col("prev.rep")) & T.is_latin_dominant(F.col("rep")) & (F.col("chars") / F.col("prev.chars")).between(0.5, 2.0)
    return met.withColumn("is_start", F.col("rep").isNotNull() & ~F.col("mid_article") & ~(F.col("bilingual") & F.coalesce(twin, F.lit(False)))).drop("prev")


def start_pages(anchors: DataFrame, p: Policy = POLICY) -> DataFrame:
    return with_start(page_facts(anchors, p)).where("is_start")


def signals(origin: Column, p: Policy = POLICY) -> Column:
    """What a start was told by."""
    typo = origin == 1
    return F.struct(
        F.when(typo, p.start_signal).otherwise(p.front_signal).alias("primary"), F.when(~typo, "special_case_front_matter").alias("detection_method"), F.when(typo, p.font_name).alias("font_name"), F.when(typo, p.font_size).alias("font_size"),
        F.when(typo, p.tolerance).alias("tolerance"), F.when(typo, F.array(*map(F.lit, T.BLACKLIST))).alias("blacklist"), F.when(typo, "enabled").alias("ru_en_dedup_policy"),
    )


def starts_of(facts: DataFrame, p: Policy = POLICY) -> DataFrame:
    """A front contents page, if any, and the heading starts with the first kind that holds; not deduplicated.

    issue, start_page, kind, origin (0: front contents); own, next: facts of the page and the one behind; head: those of
    pages 1 and 2; markers: the issue's pages with a contents marker.
    """
    issue = Window.partitionBy("issue")
    by_page = issue.orderBy("page")
    facts = with_start(facts).withColumn("own", F.struct("page", "ru", "en", "bylines"))
    of_page = lambda n: F.max(F.when(F.col("page") == n, F.col("own"))).over(issue)
    front = F.min(F.when(F.col("marker") & F.col("page").between(1, p.front_pages), F.struct("front", "page"))).over(issue)
    met = (
        facts.withColumn("front_page", front["page"]).withColumn("near_marker", F.max("marker").over(by_page.rangeBetween(0, p.contents_reach)))
        .withColumn("next", F.lead("own").over(by_page)).withColumn("next", F.when(F.col("next.page") == F.col("page") + 1, F.col("next")))
        .withColumn("head", F.struct(of_page(1).alias("own"), of_page(2).alias("next"))).withColumn("markers", F.collect_set(F.when(F.col("marker"), F.col("page"))).over(issue))
    )
    kind = F.when(F.col("info"), "info").when(F.col("near_marker"), "contents").when(F.col("authors"), "research").when(F.col("digest"), "digest").otherwise("editorial")
    two = F.array(F.when(F.col("page") == F.col("front_page"), F.struct(F.lit("contents").alias("kind"), F.lit(0).alias("origin"))), F.when(F.col("is_start"), F.struct(kind.alias("kind"), F.lit(1).alias("origin"))))
    rows = met.where(F.col("is_start") | (F.col("page") == F.col("front_page"))).withColumn("s", F.explode(F.filter(two, lambda s: s.isNotNull())))
    return rows.select("issue", F.col("page").alias("start_page"), "s.kind", "s.origin", "own", "next", "head", "markers")


def article_starts(anchors: DataFrame, p: Policy = POLICY) -> DataFrame:
    """Starts with kind, confidence and signals."""
    return starts_of(page_facts(anchors, p), p).select("issue", "start_page", "kind", "origin", F.lit(p.confidence).alias("confidence"), signals(F.col("origin"), p).alias("signals"))


def ranges(starts: DataFrame, totals: DataFrame) -> DataFrame:
    """Each start runs to the page before the next; a contents start that comes first runs from page 1. Further columns stay."""
    w = Window.partitionBy("issue").orderBy("start_page", "origin")
    numbered = starts.withColumn("nth", F.row_number().over(w)).withColumn("following", F.lead("start_page").over(w)).join(totals, "issue")
    lo = F.when((F.col("nth") == 1) & (F.col("kind") == "contents"), 1).otherwise(F.col("start_page"))
    more = [c for c in (*starts.columns, *totals.columns) if c not in ("issue", "kind", "origin", "confidence", "signals", "total_pages")]
    return numbered.select("issue", F.format_string("a%02d", "nth").alias("id"), "nth", lo.cast("long").alias("lo"), F.coalesce(F.col("following") - 1, F.col("total_pages")).cast("long").alias("hi"), "kind", *more)


def reverified(found: DataFrame) -> DataFrame:
    """A contents range that holds none of `markers` is research; the first kind is kept beside it."""
    held = F.coalesce(F.exists("markers", lambda x: x.between(F.col("lo"), F.col("hi"))), F.lit(False))
    return found.withColumn("first_kind", F.col("kind")).withColumn("kind", F.when((F.col("kind") == "contents") & ~held, "research").otherwise(F.col("kind"))).drop("markers")


def verified(found: DataFrame, anchors: DataFrame) -> DataFrame:
    markers = anchors.where("type = 'contents_marker'").groupBy("issue").agg(F.collect_set("page").alias("markers"))
    return reverified(found.join(markers, "issue", "left"))


def named(found: DataFrame, p: Policy = POLICY) -> DataFrame:
    """The surname cascade over `own` and `next`, the facts of pages lo and lo + 1; first valid step wins, null where none is.

    surname (fit for a file name), source, evidence; null too for what is no research.
    """
    first = lambda k: F.least(F.col(f"own.{k}"), F.col(f"next.{k}"))
    none = F.array().cast("array<struct<seq:bigint,page:bigint,text:string>>")
    kept = [c for c in found.columns if c not in ("own", "next")]
    rows = found.withColumn("ru", first("ru")).withColumn("en", first("en"))
    seen = F.slice(F.array_sort(F.concat(F.coalesce("own.bylines", none), F.coalesce("next.bylines", none))), 1, p.bylines)
    # Each step in a struct of its own, so that no rule repeats the one before it.
    words = F.transform(seen, lambda b, i: F.struct(b["page"].alias("page"), i.alias("nth"), T.first_word(b["text"]).alias("word")))
    latin = F.transform(words, lambda x: F.struct(x["page"].alias("page"), x["nth"].alias("nth"), x["word"].rlike(f"^[{T.CYRILLIC}]").alias("is_ru"), T.capitalised(T.transliterate(x["word"])).alias("ru"), T.capitalised(x["word"]).alias("en")))
    good = F.filter(latin, lambda x: F.when(x["is_ru"], T.is_surname(x["ru"], True)).otherwise(T.is_english_surname(x["en"]) & T.is_surname(x["en"], True)))
    rows = rows.withColumn("good", F.when(F.col("kind") == "research", good))
    rows = rows.withColumn("own_word", T.first_surname(F.col("ru.text"))).withColumn("other_word", T.capitalised(T.first_surname(F.col("en.text")))).withColumn("latin", T.capitalised(T.transliterate(F.col("own_word"))))
    rows = rows.withColumn("c_ru", F.get(F.filter("good", lambda x: x["is_ru"]), 0)).withColumn("c_en", F.get(F.filter("good", lambda x: ~x["is_ru"]), 0))
    own, other, latin_word = F.col("own_word"), F.col("other_word"), F.col("latin")
    valid = T.is_english_surname(other) & T.is_surname(other)

    def pick(name: Column, source: str, kind: str, page: Column, checked: bool = False, nth: Column | None = None) -> Column:
        evidence = F.struct(F.lit(kind).alias("anchor_type"), page.alias("anchor_page"), F.lit(checked or None).cast("boolean").alias("en_authors_verified"), (F.lit(None) if nth is None else nth).cast("int").alias("text_block_index"))
        return F.struct(T.file_safe(name).alias("surname"), F.lit(source).alias("source"), evidence.alias("evidence"))

    n = F.coalesce(
        F.when(own.isNotNull() & valid, pick(other, "ru_authors_author_translit", "ru_authors", F.col("ru.page"), checked=True)),
        F.when(own.isNotNull() & T.is_surname(latin_word), pick(latin_word, "ru_authors_translit", "ru_authors", F.col("ru.page"))),
        F.when(valid, pick(other, "en_authors", "en_authors", F.col("en.page"))),
        F.when(F.col("c_ru").isNotNull(), pick(F.col("c_ru.ru"), "text_block_translit", "text_block", F.col("c_ru.page"), nth=F.col("c_ru.nth"))),
        F.when(F.col("c_en").isNotNull(), pick(F.col("c_en.en"), "text_block", "text_block", F.col("c_en.page"), nth=F.col("c_en.nth"))),
    )
    # Exploding one element keeps the optimiser from putting the whole cascade into every rule that looks at a name.
    return rows.select(*kept, F.explode(F.array(F.when(F.col("kind") == "research", n))).alias("n")).select(*kept, "n.surname", "n.source", "n.evidence")


def surnames(found: DataFrame, anchors: DataFrame, p: Policy = POLICY) -> DataFrame:
    """The cascade for ranges (issue, id, lo, kind), with facts met by page."""
    facts = page_facts(anchors, p).select("issue", "page", F.struct("page", "ru", "en", "bylines").alias("own"))
    met = found.where("kind = 'research'").select("issue", "id", "kind", "lo")
    met = met.join(facts.withColumnRenamed("page", "lo"), ["issue", "lo"], "left").join(facts.select("issue", (F.col("page") - 1).alias("lo"), F.col("own").alias("next")), ["issue", "lo"], "left")
    return named(met, p).select("issue", "id", "surname", "source", "evidence")


def manifest(anchors: DataFrame, issues: DataFrame, files: DataFrame | None = None, p: Policy = POLICY) -> DataFrame:
    """The whole chain: starts, ranges, kinds, surnames and file names (null where research has no surname).

    issues: issue, total_pages, prefix. files: issue, id, path, bytes, sha of the split files, if they are there; they
    become the struct splitter_output.
    """
    found = reverified(ranges(starts_of(page_facts(anchors, p), p), issues.select("issue", "total_pages", "prefix")))
    # A range that begins before its start page begins on page 1.
    early = F.col("lo") < F.col("start_page")
    found = found.withColumn("own", F.when(early, F.col("head.own")).otherwise(F.col("own"))).withColumn("next", F.when(early, F.col("head.next")).otherwise(F.col("next"))).drop("head", "start_page")
    out = named(found, p)
    out = out.withColumn("filename", T.file_name(F.col("prefix"), F.col("kind"), F.col("lo"), F.col("hi"), F.col("surname")))
    if files is None:
        return out
    return out.join(files.select("issue", "id", F.struct("path", "bytes", F.col("sha").alias("sha256")).alias("splitter_output")), ["issue", "id"], "left")
