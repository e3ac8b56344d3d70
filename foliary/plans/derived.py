"""Span and anchor relations derived from the lines of documents, the same in Spark and in SQL.

Documents stand for issues, lines for spans. Texts, types and boxes follow from (doc_id, line) by whole-number arithmetic,
with literal texts put in so that every branch of every operator has rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TEXTS = (
    "Vol. 21, No. 1", "2026; Том 21, № 1", "Плоткин Ф.Б.", "Plotkin F.B., Zhukova D.I.", "Безчасный К.В., Иванов И.И.", "Гелприн М.", "Smith J.", "Таблица А.",
    "Гелприн М. Рассказ о том, как это было", "Introduction A.B.", "Table A.B. of results", "Содержание", "CONTENTS", "Сontents list", "KEYWORDS: heart, aorta",
    "Уважаемые коллеги!", "ИНФОРМАЦИЯ", " information ", "Дайджест новостей за месяц", "Digest of the month", "Оригинальное исследование сердца", "Исследование сердца и сосудов",
    "Heart and vessel research", "Аннотация: цель работы", "Институт кардиологии", "г. Москва, ул. Ленина", "doi 10.1234/abc.2026.02.1-9 and 10.5555/xyz", "Муртазалиева А.А.",
    "Гуменюк П.П.", "TPM1 A.B.", "rs1143 A.B.", "Ёлкин  Я.Ю.", "abc фыв", "Зайцев О.О.; Vol. 3", "123 ()", "Щукин ый Э.Э.",
    "Аннотация", " \u00a0Дайджест рынка за год",
)
CYCLE = 60


def _key(issue: Column, pos: Column) -> Column:
    return (issue * 31 + pos * 7) % CYCLE


def _span(pos: Column, line: Column, k: Column) -> dict[str, Column]:
    """The columns of the span at a line with key k."""
    texts = F.array(*(F.lit(t) for t in TEXTS))
    y0 = (10 + pos % 3 * 14 + k % 3 * 4).cast("double")
    return {
        "seq": pos, "k": k, "page": (F.floor(pos / 3) + 1).cast("long"), "text": F.when(k < len(TEXTS), F.get(texts, k.cast("int"))).otherwise(line),
        "x0": (k % 5).cast("double"), "y0": y0, "x1": (k % 5 + 200).cast("double"), "y1": y0 + 12,
        "font_size": (10 + (k % 6) * 0.5).cast("double"), "font_name": F.when(k % 4 < 2, "MyriadPro-BoldIt").otherwise("Times"), "page_height": F.lit(100.0),
    }


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """issue, seq, page, text, lang-free spans with boxes and fonts."""
    lines = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").alias("issue"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    with_k = lines.withColumn("pos", F.col("pos").cast("long")).withColumn("k", _key(F.col("issue"), F.col("pos")))
    return with_k.select("issue", *(c.alias(n) for n, c in _span(F.col("pos"), F.col("line"), F.col("k")).items()))


def anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """issue, seq, page, type, text, value, font_name, font_size: a type for each span, ordered by group, then place."""
    s = spans(spark, sf_dir)
    j = (F.col("issue") + F.col("seq") * 3) % 8
    kind = F.when(j == 0, "ru_authors").when(j == 1, "en_authors").when((j == 2) & (F.col("k") % 3 == 0), "contents_marker").when(j == 2, "ru_title").when((j == 3) & (F.col("k") % 4 == 0), "doi").otherwise("text_block")
    group = F.when(kind == "doi", 0).when(kind == "text_block", 1).when(kind.startswith("ru"), 2).when(kind.startswith("en"), 3).otherwise(4)
    value = F.when(kind == "doi", F.concat(F.lit("10.1234/x.2026.02."), (F.col("page") - 1 + F.col("k") % 3).cast("string"), F.lit("-"), (F.col("page") + 9).cast("string")))
    return s.select("issue", (group * 1_000_000 + F.col("seq")).alias("seq"), "page", kind.alias("type"), "text", value.alias("value"), "font_name", "font_size")


def issues(pages: DataFrame, beyond: int = 1) -> DataFrame:
    """issue, total_pages (its last page and `beyond`), issue_id (mg_YYYY_MM by arithmetic on the id)."""
    y = F.format_string("mg_%04d_%02d", (2000 + F.col("issue") % 30).cast("long"), (F.col("issue") % 12 + 1).cast("long"))
    return pages.groupBy("issue").agg((F.max("page") + beyond).alias("total_pages")).withColumn("issue_id", y)


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """issue, page, page_height, text, blocks, dealt by issue, so that nothing behind it by issue needs an exchange: blocks as a PDF library's JSON, one of a single span each, with some of other kinds, short boxes, missing sizes and fonts."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").groupBy(F.col("doc_id").alias("issue")).agg(F.collect_list("text").alias("texts"))
    lines = docs.select("issue", F.transform("texts", lambda t: F.split(t, "\n")).alias("texts"))
    last = F.array_max(F.transform("texts", lambda t: F.floor((F.size(t) - 1) / 3) + 1)).cast("int")
    numbered = lines.select("issue", "texts", F.explode(F.sequence(F.lit(1), last)).alias("page"))
    # A page's lines are three neighbours of a text: of each text, if several have one id.
    here = F.flatten(F.transform("texts", lambda t: F.transform(F.slice(t, F.col("page") * 3 - 2, 3), lambda x, i: F.struct(((F.col("page") - 1) * 3 + i).cast("long").alias("pos"), x.alias("line")))))
    placed = numbered.select("issue", F.col("page").cast("long").alias("page"), here.alias("at"))
    keyed = F.transform("at", lambda x: F.struct(x["pos"].alias("pos"), x["line"].alias("line"), _key(F.col("issue"), x["pos"]).alias("k")))

    def block(x: Column) -> Column:
        k, s = x["k"], _span(x["pos"], x["line"], x["k"])
        box = F.array(s["x0"], s["y0"], s["x1"], s["y1"])
        span = F.struct(s["text"].alias("text"), F.when(k % 31 == 11, F.slice(box, 1, 3)).otherwise(box).alias("bbox"), F.when(k % 37 != 13, s["font_size"]).alias("size"), F.when(k % 41 == 3, "").otherwise(s["font_name"]).alias("font"))
        return F.struct(s["seq"].alias("seq"), s["text"].alias("text"), F.when(k % 29 == 7, 1).otherwise(0).alias("type"), F.array(F.struct(F.array(span).alias("spans"))).alias("lines"))

    listed = placed.select("issue", "page", F.lit(100.0).alias("page_height"), F.array_sort(F.transform(keyed, block)).alias("b"))
    return listed.select("issue", "page", "page_height", F.array_join(F.transform("b", lambda x: x["text"]), " ").alias("text"), F.to_json(F.transform("b", lambda x: x.dropFields("seq", "text"))).alias("blocks"))


def _literal(t: str) -> str:
    return "'" + t.replace("'", "''") + "'"


SPANS_SQL = f"""
span_lines AS (
  SELECT doc_id AS issue, unnest(string_split(text, chr(10))) AS line, CAST(unnest(range(0, len(string_split(text, chr(10))))) AS BIGINT) AS pos FROM documents
), span_keys AS (SELECT *, (issue * 31 + pos * 7) % {CYCLE} AS k FROM span_lines),
spans AS (
  SELECT issue, pos AS seq, k, pos // 3 + 1 AS page, CASE WHEN k < {len(TEXTS)} THEN [{", ".join(map(_literal, TEXTS))}][k + 1] ELSE line END AS text,
    CAST(k % 5 AS DOUBLE) AS x0, CAST(10 + pos % 3 * 14 + k % 3 * 4 AS DOUBLE) AS y0, CAST(k % 5 + 200 AS DOUBLE) AS x1, CAST(22 + pos % 3 * 14 + k % 3 * 4 AS DOUBLE) AS y1,
    CAST(10 + (k % 6) * 0.5 AS DOUBLE) AS font_size, CASE WHEN k % 4 < 2 THEN 'MyriadPro-BoldIt' ELSE 'Times' END AS font_name, 100.0::DOUBLE AS page_height
  FROM span_keys
)"""
ANCHORS_SQL = f"""{SPANS_SQL},
typed AS (
  SELECT *, CASE (issue + seq * 3) % 8 WHEN 0 THEN 'ru_authors' WHEN 1 THEN 'en_authors' WHEN 2 THEN CASE WHEN k % 3 = 0 THEN 'contents_marker' ELSE 'ru_title' END
    WHEN 3 THEN CASE WHEN k % 4 = 0 THEN 'doi' ELSE 'text_block' END ELSE 'text_block' END AS type FROM spans
), anchors AS (
  SELECT issue, CASE WHEN type = 'doi' THEN 0 WHEN type = 'text_block' THEN 1 WHEN type LIKE 'ru%' THEN 2 WHEN type LIKE 'en%' THEN 3 ELSE 4 END * 1000000 + seq AS seq, page, type, text,
    CASE WHEN type = 'doi' THEN '10.1234/x.2026.02.' || (page - 1 + k % 3) || '-' || (page + 9) END AS value, font_name, font_size
  FROM typed
), totals AS (SELECT issue, max(page) + 1 AS total_pages FROM anchors GROUP BY issue)"""
NBSP = "\u00a0"
#: What the span scan leaves of pages(): places are 2^26 apart, as each span has a block of its own.
SCANNED_SQL = rf"""{SPANS_SQL},
scanned_all AS (SELECT *, (row_number() OVER (PARTITION BY issue, page ORDER BY seq) - 1) * 67108864 AS place, regexp_replace(regexp_replace(text, '[\s{NBSP}]+', ' ', 'g'), '^ | $', '', 'g') AS norm FROM spans),
scanned AS (
  SELECT issue, page, page_height, place AS seq, norm AS text, CASE WHEN regexp_matches(norm, '[А-ЯЁа-яё]') THEN 'ru' WHEN regexp_matches(norm, '[A-Za-z]') THEN 'en' ELSE 'unknown' END AS lang, x0, y0, x1, y1, font_size, CASE WHEN k % 41 <> 3 THEN font_name END AS font_name
  FROM scanned_all WHERE k % 29 <> 7 AND norm <> '' AND k % 31 <> 11 AND k % 37 <> 13
)"""
