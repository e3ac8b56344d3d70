"""Registered queries of the segmentation operators, each over whole tables, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliary.functions import text as T
from foliary.operators import blocks, constraints, ranges, runs
from foliary.plans import derived as D
from foliary.sources import readers, writers

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):  # noqa: ANN201
    """Register a function under its name, with SQL if there is any."""

    def put(f):  # noqa: ANN001, ANN202
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return put


# SQL text for the scalar rules, from the rules' description. DuckDB's \\s lacks the no-break space.
_WS, _NOT_WS = "[\\s\u00a0]", "[^\\s\u00a0]"


def _s(x: str) -> str:
    return f"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"


def _word(x: str) -> str:
    return f"regexp_replace(regexp_extract({_s(x)}, '^{_NOT_WS}+'), '[.,;:]+$', '')"


def _cap(x: str) -> str:
    return f"(upper(substring({x}, 1, 1)) || substring({x}, 2))"


def _in(x: str, values: tuple[str, ...]) -> str:
    return f"{x} IN ({', '.join(map(D._literal, values))})"


def _has(x: str, parts: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains({x}, {D._literal(p)})" for p in parts) + ")"


def _header(x: str) -> str:
    return rf"regexp_matches({_s(x)}, '(?i)(^|;\s*)(vol(ume)?\.?\s+\d|том\s+\d)')"


_L = "A-Za-zА-Яа-яЁё"


def _byline(x: str) -> str:
    return rf"regexp_matches({_s(x)}, '^[{_L}]+[\s ,]+[{_L}]\.{_WS}*[{_L}]\.')"


def _single(x: str) -> str:
    w = _word(x)
    return rf"(regexp_matches({_s(x)}, '^[{_L}]+[\s ,]+[{_L}]\.$') AND NOT {_in(w, T.LABELS)} AND NOT {_in(_cap(w), T.HARD_WORDS + T.SOFT_WORDS)})"


def _shape(x: str) -> str:
    return rf"(length({x}) >= 2 AND NOT regexp_matches({x}, '\d') AND NOT ({x} = upper({x}) AND {x} <> lower({x}) AND length({x}) <= 8) AND NOT regexp_matches({x}, '[()]'))"


def _surname(x: str, last: bool = False) -> str:
    return f"({_shape(x)} AND NOT {_in(_cap(x), T.HARD_WORDS + (T.SOFT_WORDS if last else ()))} AND regexp_matches({_cap(x)}, '^[A-Z][a-z]'))"


def _english(x: str) -> str:
    return f"({_shape(x)} AND regexp_matches({x}, '^[A-Z][a-z]'))"


def _latin(x: str) -> str:
    out = f"regexp_replace({x}, '([ыЫ])й($|[^Ѐ-ӿ])', '\\1i\\2', 'g')"
    for a, b in (("и[еЕ]", "iye"), ("И[еЕ]", "Iye"), ("н[юЮ]", "niu"), ("Н[юЮ]", "Niu")):
        out = f"regexp_replace({out}, '{a}', '{b}', 'g')"
    for a, b in T.ONE_TO_MANY:
        out = f"replace({out}, '{a}', '{b}')"
    return f"translate({out}, '{T.ONE_TO_ONE[0]}', '{T.ONE_TO_ONE[1]}')"


def _greeting(x: str) -> str:
    return f"({_has(f'lower({x})', T.GREETINGS + T.SIGNATURES)} OR length({x}) > 200 OR (suffix({_s(x)}, '!') AND {_has(f'lower({x})', T.ADDRESSED)}))"


def _letters(x: str, cls: str) -> str:
    return f"length(regexp_replace({x}, '[^{cls}]', '', 'g'))"


_CYR, _LAT = _letters("text", "Ѐ-ӿ"), _letters("text", "A-Za-z")
_PREFIX = rf"regexp_extract({_s('text')}, '^([{_L}]+[\s ,]+[{_L}]\.){_WS}', 1)"


@query(rf"""WITH {D.SPANS_SQL} SELECT issue, seq,
  CASE WHEN regexp_matches(text, '[А-ЯЁа-яё]') THEN 'ru' WHEN regexp_matches(text, '[A-Za-z]') THEN 'en' ELSE 'unknown' END AS lang,
  length({_s("text")}) <= 30 AND regexp_matches(text, '(?i)(^|[^\p{{L}}\p{{N}}_])(содержание|contents)($|[^\p{{L}}\p{{N}}_])') AS contents,
  {_has("lower(text)", T.BLACKLIST)} AS blacklisted, ({_CYR} + {_LAT} > 0 AND 2 * {_CYR} >= {_CYR} + {_LAT}) AS cyrillic, ({_CYR} + {_LAT} > 0 AND 2 * {_LAT} >= {_CYR} + {_LAT}) AS latin,
  {_greeting("text")} AS greeting, {_header("text")} AS header, {_byline("text")} AS byline, {_single("text")} AS single,
  CASE WHEN {_PREFIX} <> '' AND {_single(_PREFIX)} THEN {_PREFIX} END AS prefix FROM spans""")
def text_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    return D.spans(spark, sf_dir).select(
        "issue", "seq", T.language(t).alias("lang"), T.is_contents_marker(t).alias("contents"), T.is_blacklisted(t).alias("blacklisted"), T.is_cyrillic_dominant(t).alias("cyrillic"), T.is_latin_dominant(t).alias("latin"),
        T.is_greeting(t).alias("greeting"), T.is_running_header(t).alias("header"), T.is_byline(t).alias("byline"), T.is_single_byline(t).alias("single"), T.byline_prefix(t).alias("prefix"),
    )


_SPACED = f"regexp_replace(text, '{_WS}+', ' ', 'g')"
_FIRST = _word("string_split(text, ',')[1]")


@query(rf"""WITH {D.SPANS_SQL} SELECT issue, seq, {_s(_SPACED)} AS normal, {_latin("text")} AS latin, CASE WHEN {_FIRST} <> '' THEN {_FIRST} END AS surname,
  {_cap("text")} AS capital, regexp_replace(regexp_replace(regexp_replace(text, '[^A-Za-z0-9_-]', '_', 'g'), '_+', '_', 'g'), '^_+|_+$', '', 'g') AS safe,
  CASE WHEN regexp_matches(text, '(?i)^\s*Аннотация($|[^\p{{L}}\p{{N}}_])') AND {_s("regexp_replace(text, '(?i)^[ ]*Аннотация[: ]*', '')")} <> '' THEN {_s("regexp_replace(text, '(?i)^[ ]*Аннотация[: ]*', '')")} END AS abstract,
  {_surname(_word("text"))} AS valid, {_surname(_word("text"), True)} AS valid_last, {_english(_word("text"))} AS valid_en, lpad(CAST(seq AS VARCHAR), greatest(3, length(CAST(seq AS VARCHAR)))::INT, '0') AS padded,
  CASE WHEN seq % 100 BETWEEN 11 AND 19 THEN 'статей' WHEN seq % 10 = 1 THEN 'статья' WHEN seq % 10 BETWEEN 2 AND 4 THEN 'статьи' ELSE 'статей' END AS plural FROM spans""")
def text_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, w = F.col("text"), F.col("word")
    rows = D.spans(spark, sf_dir).select("issue", "seq", "text", T.first_word(F.col("text")).alias("word"))
    return rows.select(
        "issue", "seq", T.normal_space(t).alias("normal"), T.transliterate(t).alias("latin"), T.first_surname(t).alias("surname"), T.capitalised(t).alias("capital"), T.file_safe(t).alias("safe"), T.abstract_text(t).alias("abstract"),
        T.is_surname(w).alias("valid"), T.is_surname(w, True).alias("valid_last"), T.is_english_surname(w).alias("valid_en"), T.padded_page(F.col("seq")).alias("padded"), T.plural_articles(F.col("seq")).alias("plural"),
    )


@query("""WITH k AS (SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'mg_20' || lpad(CAST(doc_id % 30 AS VARCHAR), 2, '0') || '_' || lpad(CAST(doc_id % 15 AS VARCHAR), 2, '0') WHEN 1 THEN 'abc_2025_12' WHEN 2 THEN 'MG_2025_1' WHEN 3 THEN 'mg_25_12' ELSE 'na_2026_02' END AS issue_id, url FROM documents JOIN pages ON doc_id = page_id)
SELECT doc_id, issue_id, upper(substring(p[1], 1, 1)) || lower(substring(p[1], 2)) || '_' || p[2] || '-' || p[3] AS prefix, CASE WHEN length(p[1]) = 2 THEN p[1] END AS code,
  lower(p[1]) = 'mg' AND regexp_matches(p[2], '^[0-9]{4}$') AND CAST(p[3] AS INT) BETWEEN 1 AND 12 AS valid, 'Mg_' || p[2] || '-' || p[3] AS expected, CASE WHEN length(p[2]) = 4 THEN p[2] END AS year, string_split(url, '/')[-1] AS base
FROM (SELECT *, string_split(issue_id, '_') AS p FROM k)""")
def issue_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, n = spark.read.parquet(f"{sf_dir}/documents.parquet"), F.col("doc_id")
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    i = F.when(n % 5 == 0, F.concat(F.lit("mg_20"), two(n % 30), F.lit("_"), two(n % 15))).when(n % 5 == 1, "abc_2025_12").when(n % 5 == 2, "MG_2025_1").when(n % 5 == 3, "mg_25_12").otherwise("na_2026_02")
    p = spark.read.parquet(f"{sf_dir}/pages.parquet").select(F.col("page_id").alias("doc_id"), "url")
    i_ = F.col("issue_id")
    return d.select("doc_id", i.alias("issue_id")).join(p, "doc_id").select(
        "doc_id", "issue_id", T.issue_prefix(i_).alias("prefix"), T.journal_code(i_).alias("code"), T.is_issue_id(i_, F.lit("Mg")).alias("valid"), T.name_prefix(F.lit("Mg"), i_).alias("expected"), T.year_of(T.issue_prefix(i_)).alias("year"), T.base_name(F.col("url")).alias("base")
    )


@query(rf"""WITH {D.SPANS_SQL}, pg AS (SELECT issue, page, string_agg(text, ' ' ORDER BY seq) AS text FROM spans GROUP BY issue, page),
m AS (SELECT issue, page, regexp_extract_all(text, '(?i)\b10\.\d{{4,9}}/[-._;()/:A-Z0-9]+\b') AS v FROM pg), e AS (SELECT issue, page, unnest(v) AS value, CAST(unnest(range(0, len(v))) AS INT) AS nth FROM m)
SELECT e.issue, e.page, nth, value, coalesce(min_by(x0, seq), 0.0) AS x0, coalesce(min_by(y0, seq), 0.0) AS y0, coalesce(min_by(x1, seq), 0.0) AS x1, coalesce(min_by(y1, seq), 0.0) AS y1
FROM e LEFT JOIN spans s ON s.issue = e.issue AND s.page = e.page AND contains(s.text, e.value) GROUP BY e.issue, e.page, nth, value""")
def doi_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = D.spans(spark, sf_dir)
    listed = F.array_sort(F.collect_list(F.struct("seq", "text")))
    pages = s.groupBy("issue", "page").agg(F.array_join(F.transform(listed, lambda x: x["text"]), " ").alias("text"))
    return blocks.doi_boxes(blocks.doi_anchors(pages), s)


_TYPO = f"SELECT * FROM anchors WHERE type = 'text_block' AND font_name = 'MyriadPro-BoldIt' AND font_size BETWEEN 11.5 AND 12.5 AND length(text) >= 10 AND NOT {_has('lower(text)', T.BLACKLIST)}"
_STEPS = rf"""typo AS ({_TYPO}),
flags AS (
  SELECT issue, page, coalesce(bool_or(type = 'text_block' AND regexp_matches(upper(text), 'KEYWORDS|ABSTRACT|SUMMARY|INTRODUCTION')), false) AS bilingual,
    coalesce(bool_or(type = 'ru_title' AND regexp_matches({_s("lower(text)")}, '^(дайджест|digest)')), false) AS digest,
    coalesce(bool_or(type = 'text_block' AND {_s("upper(text)")} IN ('ИНФОРМАЦИЯ', 'INFORMATION')), false) AND NOT bool_or(type = 'doi') AS info,
    bool_or((type = 'ru_authors' AND NOT {_greeting("text")}) OR type = 'en_authors') AS authors, bool_or(type = 'contents_marker') AS marker,
    coalesce(bool_or(type = 'doi' AND CAST(nullif(regexp_extract(value, '\.(\d+)-\d+$', 1), '') AS BIGINT) < page), false) AS mid_article
  FROM anchors GROUP BY issue, page),
reps AS (SELECT issue, page, min_by(text, seq) AS text, sum(length(text)) AS chars FROM typo GROUP BY issue, page),
marked AS (SELECT *, ({_CYR} + {_LAT} > 0 AND 2 * {_CYR} >= {_CYR} + {_LAT}) AS cyr, ({_CYR} + {_LAT} > 0 AND 2 * {_LAT} >= {_CYR} + {_LAT}) AS lat FROM reps),
twins AS (SELECT issue, page, coalesce(lag(page) OVER w = page - 1 AND lag(cyr) OVER w AND lat AND chars::DOUBLE / lag(chars) OVER w BETWEEN 0.5 AND 2.0, false) AS twin FROM marked WINDOW w AS (PARTITION BY issue ORDER BY page)),
pages_in AS (SELECT t.issue, t.page, f.info, f.authors, f.digest FROM twins t JOIN flags f USING (issue, page) WHERE NOT (twin AND bilingual) AND NOT mid_article),
kinds AS (SELECT issue, page AS start_page, CASE WHEN info THEN 'info' WHEN EXISTS (SELECT 1 FROM anchors a WHERE a.issue = p.issue AND a.type = 'contents_marker' AND a.page BETWEEN p.page AND p.page + 2) THEN 'contents' WHEN authors THEN 'research' WHEN digest THEN 'digest' ELSE 'editorial' END AS kind, 1 AS origin FROM pages_in p),
starts AS (SELECT * FROM kinds UNION ALL SELECT issue, min_by(page, seq), 'contents', 0 FROM anchors WHERE type = 'contents_marker' AND page BETWEEN 1 AND 4 GROUP BY issue),
numbered AS (SELECT issue, kind, start_page, row_number() OVER w AS nth, lead(start_page) OVER w AS nxt FROM starts WINDOW w AS (PARTITION BY issue ORDER BY start_page, origin)),
ranges AS (SELECT issue, 'a' || lpad(CAST(nth AS VARCHAR), greatest(2, length(CAST(nth AS VARCHAR)))::INT, '0') AS id, nth::INT AS nth, CASE WHEN nth = 1 AND kind = 'contents' THEN 1 ELSE start_page END::BIGINT AS lo, coalesce(nxt - 1, total_pages)::BIGINT AS hi, kind FROM numbered JOIN totals USING (issue)),
checked AS (SELECT * REPLACE (CASE WHEN kind = 'contents' AND NOT EXISTS (SELECT 1 FROM anchors a WHERE a.issue = r.issue AND a.type = 'contents_marker' AND a.page BETWEEN r.lo AND r.hi) THEN 'research' ELSE kind END AS kind), kind AS first_kind FROM ranges r)"""
_CHAIN = f"{D.ANCHORS_SQL}, {_STEPS}"
_OWN = _word("string_split(ru, ',')[1]")
_SAFE = "regexp_replace(regexp_replace(regexp_replace({0}, '[^A-Za-z0-9_-]', '_', 'g'), '_+', '_', 'g'), '^_+|_+$', '', 'g')"
_C_RU = rf"regexp_matches(w, '^[Ѐ-ӿ]') AND {_surname(_cap('lw'), True)}"
_C_EN = rf"NOT regexp_matches(w, '^[Ѐ-ӿ]') AND {_english(_cap('w'))} AND {_surname(_cap('w'), True)}"
_NAME_STEPS = rf"""near AS (SELECT c.issue, c.id, a.type, a.text, a.seq, a.page FROM checked c JOIN anchors a ON a.issue = c.issue AND a.page BETWEEN c.lo AND c.lo + 1 WHERE c.kind = 'research' AND NOT {_header("a.text")}),
seen AS (SELECT *, {_word("text")} AS w FROM (SELECT *, row_number() OVER (PARTITION BY issue, id ORDER BY seq) AS n FROM near WHERE type = 'text_block' AND {_byline("text")}) WHERE n <= 6),
worded AS (SELECT *, {_latin("w")} AS lw FROM seen),
step_c AS (SELECT issue, id, min_by({_cap("lw")}, n) FILTER (WHERE {_C_RU}) AS c_ru, min_by(page, n) FILTER (WHERE {_C_RU}) AS c_ru_page, min(n) FILTER (WHERE {_C_RU}) AS c_ru_n,
  min_by({_cap("w")}, n) FILTER (WHERE {_C_EN}) AS c_en, min_by(page, n) FILTER (WHERE {_C_EN}) AS c_en_page, min(n) FILTER (WHERE {_C_EN}) AS c_en_n FROM worded GROUP BY issue, id),
heads AS (SELECT issue, id, min_by(text, seq) FILTER (WHERE type = 'ru_authors') AS ru, min_by(page, seq) FILTER (WHERE type = 'ru_authors') AS ru_page, min_by(text, seq) FILTER (WHERE type = 'en_authors') AS en, min_by(page, seq) FILTER (WHERE type = 'en_authors') AS en_page FROM near GROUP BY issue, id),
named AS (SELECT c.issue, c.id, nullif({_OWN}, '') AS own, nullif({_word("string_split(en, ',')[1]")}, '') AS other0, ru_page, en_page, c_ru, c_ru_page, c_ru_n, c_en, c_en_page, c_en_n FROM checked c LEFT JOIN heads USING (issue, id) LEFT JOIN step_c USING (issue, id) WHERE c.kind = 'research'),
cased AS (SELECT *, {_cap("other0")} AS other, {_cap(_latin("own"))} AS latin FROM named),
judged AS (SELECT *, coalesce({_english("other")} AND {_surname("other")}, false) AS good, coalesce({_surname("latin")}, false) AS latin_ok FROM cased),
stepped AS (SELECT *, CASE WHEN own IS NOT NULL AND good THEN 'ru_authors_author_translit' WHEN own IS NOT NULL AND latin_ok THEN 'ru_authors_translit' WHEN good THEN 'en_authors' WHEN c_ru IS NOT NULL THEN 'text_block_translit' WHEN c_en IS NOT NULL THEN 'text_block' END AS source FROM judged),
surnames AS (SELECT issue, id, {_SAFE.format("CASE source WHEN 'ru_authors_author_translit' THEN other WHEN 'ru_authors_translit' THEN latin WHEN 'en_authors' THEN other WHEN 'text_block_translit' THEN c_ru ELSE c_en END")} AS surname, source,
  CASE WHEN source LIKE 'ru%' THEN 'ru_authors' WHEN source LIKE 'en%' THEN 'en_authors' WHEN source IS NOT NULL THEN 'text_block' END AS evidence_type, CASE WHEN source LIKE 'ru%' THEN ru_page WHEN source LIKE 'en%' THEN en_page WHEN source LIKE '%translit' THEN c_ru_page ELSE c_en_page END AS evidence_page,
  CASE WHEN source = 'ru_authors_author_translit' THEN true END AS evidence_verified, CAST(CASE source WHEN 'text_block_translit' THEN c_ru_n - 1 WHEN 'text_block' THEN c_en_n - 1 END AS INT) AS evidence_index FROM stepped)"""
_PAD = "lpad(CAST({0} AS VARCHAR), greatest(3, length(CAST({0} AS VARCHAR)))::INT, '0')"
_NAMES_OF = f"""manifest AS (SELECT c.issue, c.id, c.nth, lo, hi, kind, first_kind, surname, source, evidence_type, evidence_page, evidence_verified, evidence_index,
  'Mg_' || (2000 + c.issue % 30) || '-' || lpad(CAST(c.issue % 12 + 1 AS VARCHAR), 2, '0') || '_' || {_PAD.format("lo")} || '-' || {_PAD.format("hi")} || '_' || CASE WHEN kind = 'research' THEN surname ELSE upper(substring(kind, 1, 1)) || substring(kind, 2) END || '.pdf' AS filename
  FROM checked c LEFT JOIN surnames USING (issue, id))"""
_MANIFEST = f"{_CHAIN}, {_NAME_STEPS}, {_NAMES_OF}"
MANIFEST_COLUMNS = ["issue", "id", "nth", "lo", "hi", "kind", "first_kind", "surname", "source", "evidence_type", "evidence_page", "evidence_verified", "evidence_index", "filename"]


def _anchors(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    a = D.anchors(spark, sf_dir)
    return a, _issues(D.issues(a))


def _issues(issues: DataFrame) -> DataFrame:
    return issues.select("issue", "total_pages", T.issue_prefix(F.col("issue_id")).alias("prefix"))


def _listed(articles: DataFrame) -> DataFrame:
    e = {"evidence_type": "anchor_type", "evidence_page": "anchor_page", "evidence_verified": "en_authors_verified", "evidence_index": "text_block_index"}
    return articles.select(*(F.col(f"evidence.{e[c]}").alias(c) if c in e else F.col(c) for c in MANIFEST_COLUMNS))


@query(f"WITH {D.ANCHORS_SQL} SELECT issue, seq, page, text FROM ({_TYPO})")
def typography(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranges.typography(_anchors(spark, sf_dir)[0]).select("issue", "seq", "page", "text")


@query(f"WITH {_CHAIN} SELECT * FROM flags")
def page_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranges.page_flags(_anchors(spark, sf_dir)[0])


@query(f"WITH {_CHAIN} SELECT issue, page FROM pages_in")
def start_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranges.start_pages(_anchors(spark, sf_dir)[0]).select("issue", "page")


@query(f"""WITH {_CHAIN} SELECT issue, start_page, kind, origin, 1.0::DOUBLE AS confidence, CASE origin WHEN 0 THEN 'contents_marker_on_first_pages' ELSE 'typography_descriptor' END AS signal,
  CASE origin WHEN 1 THEN 'MyriadPro-BoldIt' END AS font_name, CASE origin WHEN 1 THEN 12.0::DOUBLE END AS font_size, CASE origin WHEN 1 THEN 0.5::DOUBLE END AS tolerance FROM starts""")
def article_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = ranges.article_starts(_anchors(spark, sf_dir)[0])
    return s.select("issue", "start_page", "kind", "origin", "confidence", F.col("signals.primary").alias("signal"), "signals.font_name", "signals.font_size", "signals.tolerance")


def _ranges(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Anchors, issues and ranges; the facts of pages are dropped, so that they are not computed."""
    a, i = _anchors(spark, sf_dir)
    return a, i, ranges.ranges(ranges.article_starts(a), i.select("issue", "total_pages"))


@query(f"WITH {_CHAIN} SELECT issue, id, nth, lo, hi, kind, hi - lo + 1 AS page_count FROM ranges")
def article_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranges(spark, sf_dir)[2].select("issue", "id", "nth", "lo", "hi", "kind", (F.col("hi") - F.col("lo") + 1).alias("page_count"))


@query(f"WITH {_CHAIN} SELECT issue, id, kind, first_kind FROM checked")
def verified_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, _, found = _ranges(spark, sf_dir)
    return ranges.verified(found, a).select("issue", "id", "kind", "first_kind")


@query(f"WITH {_CHAIN}, {_NAME_STEPS} SELECT issue, id, surname, source FROM surnames")
def first_surnames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cascade on given ranges, with facts met by a join."""
    a, _, found = _ranges(spark, sf_dir)
    return ranges.surnames(ranges.verified(found, a), a).select("issue", "id", "surname", "source")


@query(f"WITH {_MANIFEST} SELECT {', '.join(MANIFEST_COLUMNS)} FROM manifest")
def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _listed(ranges.manifest(*_anchors(spark, sf_dir)))


_V3 = "CASE WHEN lo < 1 OR hi < 1 THEN 'below_one' WHEN lo > hi THEN 'reversed' WHEN hi > total_pages THEN 'beyond_end' END"
_V9 = "CASE WHEN lo <= lag(hi) OVER w THEN 'overlap' WHEN lo > lag(hi) OVER w + 1 THEN 'gap' WHEN lead(nth) OVER w IS NULL AND hi <> total_pages THEN 'end' END"


@query(f"WITH {_CHAIN} SELECT * FROM (SELECT issue, id, {_V3} AS rule FROM ranges JOIN totals USING (issue)) WHERE rule IS NOT NULL")
def bad_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, i, found = _ranges(spark, sf_dir)
    return constraints.bad_ranges(found, i.select("issue", "total_pages"))


@query(f"WITH {_CHAIN} SELECT * FROM (SELECT issue, id, {_V9} AS rule FROM ranges JOIN totals USING (issue) WHERE nth <> 2 WINDOW w AS (PARTITION BY issue ORDER BY nth)) WHERE rule IS NOT NULL")
def broken_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second range of each issue is taken out, so that there is something to find."""
    _, i, found = _ranges(spark, sf_dir)
    return constraints.broken_chain(found.where("nth <> 2"), i.select("issue", "total_pages"))


@query(f"""WITH {_MANIFEST} SELECT * FROM (SELECT issue, id, CASE WHEN filename IS NULL THEN 'missing' WHEN kind = 'research' AND coalesce(surname, '') = '' THEN 'surname'
  WHEN kind = 'research' AND NOT regexp_matches(filename, '^[A-Za-z]+_[0-9]{{4}}-[0-9]{{2}}_[0-9]{{3}}-[0-9]{{3}}_[A-Z][a-z]+\\.pdf$') THEN 'pattern'
  WHEN kind <> 'research' AND NOT regexp_matches(filename, '^[A-Za-z]+_[0-9]{{4}}-[0-9]{{2}}_[0-9]{{3}}-[0-9]{{3}}_(Contents|Editorial|Digest|Info)\\.pdf$') THEN 'pattern' END AS rule FROM manifest) WHERE rule IS NOT NULL""")
def bad_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return constraints.bad_names(ranges.manifest(*_anchors(spark, sf_dir)))


@query(f"""WITH {_CHAIN} SELECT issue FROM totals WHERE issue NOT IN (SELECT issue FROM ranges)""")
def issues_without_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, i, found = _ranges(spark, sf_dir)
    return constraints.without_ranges(i, found).select("issue")


_TAGGED = f"""{D.SPANS_SQL}, tagged AS (SELECT *, CASE WHEN regexp_matches(text, '[А-ЯЁа-яё]') THEN 'ru' WHEN regexp_matches(text, '[A-Za-z]') THEN 'en' END AS lang FROM spans)"""
_FOLD = rf"""ordered AS (SELECT *, row_number() OVER (PARTITION BY issue, page, lang ORDER BY y0, x0, seq) AS n FROM tagged WHERE lang IS NOT NULL),
fold AS (
  SELECT issue, page, lang, n, 1::BIGINT AS b, text, x0, y0, x1, y1, font_size, seq FROM ordered WHERE n = 1
  UNION ALL
  SELECT o.issue, o.page, o.lang, o.n, CASE WHEN j THEN f.b ELSE f.b + 1 END, CASE WHEN j THEN f.text || ' ' || o.text ELSE o.text END, CASE WHEN j THEN least(f.x0, o.x0) ELSE o.x0 END, CASE WHEN j THEN least(f.y0, o.y0) ELSE o.y0 END,
    CASE WHEN j THEN greatest(f.x1, o.x1) ELSE o.x1 END, CASE WHEN j THEN greatest(f.y1, o.y1) ELSE o.y1 END, CASE WHEN j THEN f.font_size ELSE o.font_size END, CASE WHEN j THEN f.seq ELSE o.seq END
  FROM (SELECT f.*, (abs(f.font_size - o.font_size) <= 0.5 AND abs(o.y0 - f.y1) <= 6.0) AS j, o.n AS on_ FROM fold f JOIN ordered o ON o.issue = f.issue AND o.page = f.page AND o.lang = f.lang AND o.n = f.n + 1) f
  JOIN ordered o ON o.issue = f.issue AND o.page = f.page AND o.lang = f.lang AND o.n = f.on_
), blocks AS (SELECT issue, page, lang, {_s(_SPACED)} AS text, x0, y0, x1, y1, font_size, seq, b FROM (SELECT *, row_number() OVER (PARTITION BY issue, page, lang, b ORDER BY n DESC) AS last FROM fold) WHERE last = 1),
titles AS (SELECT * FROM (SELECT issue, page, lang, text AS title, x0 AS title_x0, y0 AS title_y0, x1 AS title_x1, y1 AS title_y1, row_number() OVER (PARTITION BY issue, page, lang ORDER BY font_size DESC, y0, x0, b) AS r FROM blocks WHERE (y0 + y1) / 2 <= 40.0 AND length(text) >= 10) WHERE r = 1)"""
_BLOCKS_SQL = f"{_TAGGED}, {_FOLD}"


def _tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.spans(spark, sf_dir).withColumn("text", T.normal_space(F.col("text"))).withColumn("lang", T.language(F.col("text")))


@query("WITH RECURSIVE " + _BLOCKS_SQL + " SELECT issue, page, lang, text, x0, y0, x1, y1, font_size, seq FROM blocks")
def merged_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks.merged_blocks(_tagged(spark, sf_dir)).drop("page_height")


@query("WITH RECURSIVE " + _BLOCKS_SQL + " SELECT issue, page, lang, title, title_y0 FROM titles")
def page_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = blocks.page_picks(_tagged(spark, sf_dir)).where("title is not null")
    return t.select("issue", "page", "lang", F.col("title.text").alias("title"), F.col("title.y0").alias("title_y0"))


_AUTHOR_STEPS = rf"""below AS (SELECT b.*, CASE WHEN {_byline("text")} OR {_single("text")} THEN text WHEN lang = 'ru' AND {_PREFIX} <> '' AND {_single(_PREFIX)} THEN {_PREFIX} END AS name
  FROM blocks b JOIN titles t USING (issue, page, lang) WHERE b.y0 >= t.title_y0 AND b.text <> t.title AND NOT {_header("text")}),
authors AS (SELECT * FROM (SELECT issue, page, lang, name, x0, y0, x1, y1, row_number() OVER (PARTITION BY issue, page, lang ORDER BY y0, x0, b) AS r FROM below WHERE name IS NOT NULL AND (lang = 'ru' OR (y0 + y1) / 2 <= 40.0)) WHERE r = 1)"""


_AUTHORS_SQL = f"{_BLOCKS_SQL}, {_AUTHOR_STEPS}"
_AFFILIATION = "regexp_matches(b.text, '(?i)университет|институт|больниц|центр|кафедр|факультет|академ')"
_ADDRESS = r"regexp_matches(b.text, '(?i)(^|[^\p{L}\p{N}_])г\.\s|ул\.\s|пр\.\s|д\.\s|россия|рф|москва|санкт-петербург')"


@query(f"WITH RECURSIVE {_AUTHORS_SQL} SELECT issue, page, lang, name FROM authors")
def page_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = blocks.page_picks(_tagged(spark, sf_dir)).where("author is not null")
    return p.select("issue", "page", "lang", F.col("author.name").alias("name"))


@query(f"""WITH RECURSIVE {_AUTHORS_SQL} SELECT a.issue, a.page, min_by(b.text, (b.y0 * 100 + b.x0) * 10000 + b.b) FILTER (WHERE {_AFFILIATION}) AS affiliation, min_by(b.text, (b.y0 * 100 + b.x0) * 10000 + b.b) FILTER (WHERE {_ADDRESS}) AS address
FROM authors a JOIN blocks b ON b.issue = a.issue AND b.page = a.page AND b.lang = 'ru' AND b.y0 >= a.y0 WHERE a.lang = 'ru' GROUP BY a.issue, a.page""")
def page_affiliations(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = blocks.page_picks(_tagged(spark, sf_dir)).where("author is not null and lang = 'ru'")
    return p.select("issue", "page", F.col("affiliation.text").alias("affiliation"), F.col("address.text").alias("address"))


_REST = _s("regexp_replace(b.text, '(?i)^[ ]*Аннотация[: ]*', '')")
_IS_ABSTRACT = rf"regexp_matches(b.text, '(?i)^\s*Аннотация($|[^\p{{L}}\p{{N}}_])') AND {_REST} <> ''"


@query(f"WITH RECURSIVE {_BLOCKS_SQL} SELECT issue, page, min_by({_REST}, b.b) AS abstract FROM blocks b WHERE lang = 'ru' AND {_IS_ABSTRACT} GROUP BY issue, page")
def page_abstracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = blocks.page_picks(_tagged(spark, sf_dir)).where("abstract is not null")
    return p.select("issue", "page", F.col("abstract.text").alias("abstract"))


@query(f"WITH {D.SCANNED_SQL} SELECT issue, page, seq, text, lang, x0, y0, x1, y1, font_size, font_name, 0.9::DOUBLE AS confidence FROM scanned")
def span_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5, from the JSON of pages."""
    return blocks.exploded_spans(D.pages(spark, sf_dir)).drop("page_height")


_FIRST_BELOW = "SELECT DISTINCT ON (b.issue, b.page) b.issue, b.page, b.text, b.x0, b.y0, b.x1, b.y1 FROM authors a JOIN blocks b ON b.issue = a.issue AND b.page = a.page AND b.lang = 'ru' AND b.y0 >= a.y0 WHERE a.lang = 'ru' AND {0} ORDER BY b.issue, b.page, b.y0, b.x0, b.b"
_EXTRACTED = rf"""{D.SCANNED_SQL}, tagged AS (SELECT * REPLACE (CASE WHEN lang <> 'unknown' THEN lang END AS lang) FROM scanned), {_FOLD}, {_AUTHOR_STEPS},
page_text AS (SELECT issue, page, string_agg(text, ' ' ORDER BY seq) AS text FROM spans GROUP BY issue, page),
dois AS (SELECT issue, page, unnest(v) AS value, unnest(range(0, len(v))) AS nth FROM (SELECT issue, page, regexp_extract_all(text, '(?i)\b10\.\d{{4,9}}/[-._;()/:A-Z0-9]+\b') AS v FROM page_text)),
doi_places AS (SELECT d.issue, d.page, nth, value, min_by(x0, seq) AS x0, min_by(y0, seq) AS y0, min_by(x1, seq) AS x1, min_by(y1, seq) AS y1 FROM dois d LEFT JOIN scanned s ON s.issue = d.issue AND s.page = d.page AND contains(s.text, d.value) GROUP BY d.issue, d.page, nth, value),
picked AS (
  SELECT 2 AS stream, 0 AS nth, 'ru_title' AS type, issue, page, title AS text, title_x0 AS x0, title_y0 AS y0, title_x1 AS x1, title_y1 AS y1 FROM titles WHERE lang = 'ru'
  UNION ALL SELECT 3, 0, 'en_title', issue, page, title, title_x0, title_y0, title_x1, title_y1 FROM titles WHERE lang = 'en'
  UNION ALL SELECT CASE lang WHEN 'ru' THEN 2 ELSE 3 END, CASE lang WHEN 'ru' THEN 2 ELSE 1 END, lang || '_authors', issue, page, name, x0, y0, x1, y1 FROM authors
  UNION ALL SELECT 2, 1, 'ru_abstract', * FROM (SELECT DISTINCT ON (issue, page) issue, page, {_REST} AS text, x0, y0, x1, y1 FROM blocks b WHERE lang = 'ru' AND {_IS_ABSTRACT} ORDER BY issue, page, b.b)
  UNION ALL SELECT 2, 3, 'ru_affiliations', * FROM ({_FIRST_BELOW.format(_AFFILIATION)})
  UNION ALL SELECT 2, 4, 'ru_address', * FROM ({_FIRST_BELOW.format(_ADDRESS)})
),
streams AS (
  SELECT 0 AS stream, nth, 'doi' AS type, issue, page, NULL::VARCHAR AS text, value, NULL::VARCHAR AS lang, coalesce(x0, 0.0) AS x0, coalesce(y0, 0.0) AS y0, coalesce(x1, 0.0) AS x1, coalesce(y1, 0.0) AS y1, NULL::DOUBLE AS font_size, NULL::VARCHAR AS font_name, 0.98::DOUBLE AS confidence FROM doi_places
  UNION ALL SELECT 1, seq, 'text_block', issue, page, text, NULL, lang, x0, y0, x1, y1, font_size, font_name, 0.9 FROM scanned
  UNION ALL SELECT stream, nth, type, issue, page, text, NULL, CASE stream WHEN 2 THEN 'ru' ELSE 'en' END, x0, y0, x1, y1, NULL, NULL, 0.9 FROM picked
  UNION ALL SELECT 4, seq, 'contents_marker', issue, page, text, NULL, NULL, x0, y0, x1, y1, NULL, NULL, 0.95 FROM scanned WHERE length(text) <= 30 AND regexp_matches(text, '(?i)(^|[^\p{{L}}\p{{N}}_])(содержание|contents)($|[^\p{{L}}\p{{N}}_])')
),
anchors AS (SELECT issue, stream::BIGINT * 1152921504606846976 + page * 1099511627776 + nth AS seq, page, type, text, value, lang, x0, y0, x1, y1, font_size, font_name, confidence FROM streams)"""


@query(f"WITH RECURSIVE {_EXTRACTED} SELECT * FROM anchors")
def extracted_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From pages to the union of all anchors."""
    return blocks.anchors_of(D.pages(spark, sf_dir))


@query(f"""WITH RECURSIVE {_EXTRACTED}, totals AS (SELECT issue, max(page) AS total_pages FROM page_text GROUP BY issue), {_STEPS}, {_NAME_STEPS}, {_NAMES_OF} SELECT {', '.join(MANIFEST_COLUMNS)} FROM manifest""")
def extracted_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole way: pages, spans, blocks, picks, anchors, starts, ranges, kinds, surnames, file names."""
    pages = D.pages(spark, sf_dir)
    return _listed(ranges.manifest(blocks.anchors_of(pages), _issues(D.issues(pages, 0))))


@query(rf"""WITH {D.SPANS_SQL}, pg AS (SELECT issue, page, string_agg(CASE WHEN k % 3 = 0 THEN '' ELSE text END, ' ') AS text FROM spans GROUP BY issue, page)
SELECT issue, count(*) AS pages, coalesce(string_agg(page, ',' ORDER BY page) FILTER (WHERE {_s("text")} <> ''), '') AS text_pages, coalesce(string_agg(page, ',' ORDER BY page) FILTER (WHERE {_s("text")} = ''), '') AS blank_pages FROM pg GROUP BY issue""")
def page_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = D.spans(spark, sf_dir)
    return blocks.page_lists(s.groupBy("issue", "page").agg(F.array_join(F.collect_list(F.when(F.col("k") % 3 == 0, "").otherwise(F.col("text"))), " ").alias("text")))


_RUNS_SQL = "runs AS (SELECT CAST(event_id AS VARCHAR) AS run_id, CAST(user_id AS VARCHAR) AS issue_id, CASE event_id % 97 WHEN 0 THEN 'pending' WHEN 1 THEN 'running' WHEN 2 THEN 'failed' ELSE 'done' END AS status, strftime(ts, '%Y-%m-%d %H:%M:%S') AS created_at FROM events)"


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.col("event_id") % 97
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("event_id").cast("string").alias("run_id"), F.col("user_id").cast("string").alias("issue_id"), F.when(m == 0, "pending").when(m == 1, "running").when(m == 2, "failed").otherwise("done").alias("status"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("created_at"))


@query(f"WITH {_RUNS_SQL} SELECT * FROM runs ORDER BY created_at DESC, run_id LIMIT 20")
def recent_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A top-k report."""
    return runs.recent(_runs(spark, sf_dir), 20)


@query(f"WITH {_RUNS_SQL} SELECT * FROM runs WHERE status IN ('pending', 'running') ORDER BY created_at, run_id LIMIT 1")
def active_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.active(_runs(spark, sf_dir))


@query(f"WITH {_RUNS_SQL} SELECT run_id, issue_id, CASE WHEN status IN ('pending', 'running') THEN 'failed' ELSE status END AS status, created_at FROM runs")
def failed_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.orphans_failed(_runs(spark, sf_dir), "interrupted", "now")


@query("""SELECT o.o_orderkey AS issue, CAST(o.o_orderkey % 7 AS BIGINT) AS total, coalesce(l.l, 0) AS l, coalesce(e.e, 0) AS e FROM orders o
  LEFT JOIN (SELECT l_orderkey, count(*) AS l FROM lineitem GROUP BY 1) l ON l.l_orderkey = o.o_orderkey LEFT JOIN (SELECT l_orderkey, count(*) AS e FROM lineitem WHERE l_linenumber <> 3 GROUP BY 1) e ON e.l_orderkey = o.o_orderkey
  WHERE o.o_orderkey % 7 <> coalesce(l.l, 0) OR o.o_orderkey % 7 <> coalesce(e.e, 0)""")
def unequal_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, li = spark.read.parquet(f"{sf_dir}/orders.parquet"), spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    line = li.select(F.col("l_orderkey").alias("issue"), "l_linenumber")
    return constraints.unequal_counts(o.select(F.col("o_orderkey").alias("issue"), (F.col("o_orderkey") % 7).cast("long").alias("total")), line, line.where("l_linenumber <> 3"))


@query("""WITH c AS (SELECT 'p' || p_partkey AS name, sha256(p_name) AS c, p_partkey AS k FROM part) SELECT name, c, f, m FROM (
  SELECT name, c, CASE WHEN k % 5 <> 0 THEN CASE WHEN k % 11 = 0 THEN 'bad' ELSE c END END AS f, CASE WHEN k % 3 <> 0 THEN CASE WHEN k % 13 = 0 THEN 'bad' ELSE c END END AS m FROM c) WHERE c <> f OR c <> m""")
def checksum_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, sha = F.col("p_partkey"), F.sha2("p_name", 256)
    p = spark.read.parquet(f"{sf_dir}/part.parquet").select(F.concat(F.lit("p"), k).alias("name"), sha.alias("sha"), k)
    wrong = lambda n: F.when(F.col("p_partkey") % n == 0, "bad").otherwise(F.col("sha")).alias("sha")
    listed, man = p.where("p_partkey % 5 <> 0").select(F.concat(F.lit("articles/"), "name").alias("name"), wrong(11)), p.where("p_partkey % 3 <> 0").select("name", wrong(13))
    return constraints.checksum_mismatches(p, listed, man)


@query("""WITH a AS (SELECT l_orderkey AS issue, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS nth, l_partkey AS lo, l_suppkey AS hi FROM lineitem), g AS (SELECT issue, nth, CASE WHEN lo % 10 = 0 THEN lo + 1 ELSE lo END AS lo, hi FROM a WHERE nth < 6)
  SELECT coalesce(a.issue, g.issue) AS issue, CAST(coalesce(a.nth, g.nth) AS INT) AS nth, a.lo, a.hi, g.lo AS golden_lo, g.hi AS golden_hi FROM a FULL JOIN g ON a.issue = g.issue AND a.nth = g.nth WHERE (a.lo, a.hi) IS DISTINCT FROM (g.lo, g.hi)""")
def positional_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    a = li.select(F.col("l_orderkey").alias("issue"), F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")).alias("nth"), F.col("l_partkey").alias("lo"), F.col("l_suppkey").alias("hi"))
    return constraints.positional_mismatches(a, a.where("nth < 6").withColumn("lo", F.when(F.col("lo") % 10 == 0, F.col("lo") + 1).otherwise(F.col("lo"))))


@query("""WITH a AS (SELECT o_custkey AS k FROM orders), b AS (SELECT o_custkey AS k FROM orders WHERE o_orderkey % 9 <> 0 UNION ALL SELECT c_custkey FROM customer WHERE c_custkey % 50 = 1)
  SELECT k, 'left' AS side FROM (SELECT k FROM a EXCEPT ALL SELECT k FROM b) UNION ALL SELECT k, 'right' FROM (SELECT k FROM b EXCEPT ALL SELECT k FROM a)""")
def bag_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c = spark.read.parquet(f"{sf_dir}/orders.parquet"), spark.read.parquet(f"{sf_dir}/customer.parquet")
    a = o.select(F.col("o_custkey").alias("k"))
    return constraints.bag_difference(a, o.where("o_orderkey % 9 <> 0").select(F.col("o_custkey").alias("k")).unionByName(c.where("c_custkey % 50 = 1").select(F.col("c_custkey").alias("k"))))


@query("""SELECT c_custkey, c_name, substring(c_name, 1, c_custkey % 4) AS journal_code FROM customer WHERE NOT regexp_matches(substring(c_name, 1, c_custkey % 4), '^\\p{L}{2}$')""")
def bad_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    return constraints.bad_codes(c.select("c_custkey", "c_name", F.substring(F.col("c_name"), F.lit(1), (F.col("c_custkey") % 4).cast("int")).alias("journal_code")))


# Documents, lines and files: what readers and sinks do with their rows.

_DOCS = "d AS (SELECT p_partkey AS k, p_name AS name FROM part)"


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k, value: JSON objects with and without envelope, failed ones, ones whose fields bear the envelope's names, and no JSON."""
    k, n = F.col("p_partkey"), F.col("p_name")
    put = lambda *x: F.concat(*(F.lit(y) if isinstance(y, str) else y.cast("string") for y in x))
    forms = [
        put('{"status":"success","issue":"outer","n":0,"data":{"issue":"', n, '","n":', k, "}}"), put('{"issue":"', n, '","n":', k, "}"), put('{"status":"error","data":null,"error":{"exit_code":10}}'), put('{"issue": ', n),
        put('{"data":{"status":"inner","issue":"', n, '"},"n":7}'), put('{"status":"success","issue":"', n, '"}'), put("[1, 2]"), put('{"status":"error","issue":"', n, '","n":1}'),
    ]
    value = F.lit(None).cast("string")
    for i, f in enumerate(forms):
        value = F.when(k % len(forms) == i, f).otherwise(value)
    return spark.read.parquet(f"{sf_dir}/part.parquet").select(k.cast("long").alias("k"), value.alias("value"))


_ENVELOPED = "SELECT '{0}' AS mode, CASE k % 8 WHEN 2 THEN NULL WHEN 7 THEN name ELSE name END AS issue, CAST(CASE k % 8 WHEN 0 THEN k WHEN 1 THEN k WHEN 7 THEN 1 END AS BIGINT) AS n, CASE k % 8 WHEN 4 THEN 'inner' WHEN 5 THEN 'success' WHEN 7 THEN 'error' END AS status FROM d WHERE k % 8 NOT IN (3, 6)"


@query(f"""WITH {_DOCS}, whole AS ({_ENVELOPED.format("any")}), by_status AS (SELECT 'status' AS mode, CASE k % 8 WHEN 2 THEN NULL WHEN 4 THEN NULL ELSE name END AS issue, CAST(CASE k % 8 WHEN 0 THEN k WHEN 1 THEN k WHEN 4 THEN 7 WHEN 7 THEN 1 END AS BIGINT) AS n, CASE k % 8 WHEN 5 THEN 'success' WHEN 7 THEN 'error' END AS status FROM d WHERE k % 8 NOT IN (3, 6)),
good AS (SELECT * REPLACE ('success' AS mode) FROM ({_ENVELOPED.format("any")} AND k % 8 NOT IN (2, 7))) SELECT * FROM whole UNION ALL SELECT * FROM by_status UNION ALL SELECT * FROM good""")
def json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1, S1b, S1c."""
    raw, schema = _documents(spark, sf_dir), "issue string, n long, status string"
    modes = {"any": {}, "status": {"only_with_status": True}, "success": {"require_success": True}}
    out = [readers.unwrapped(raw, schema, **m).select(F.lit(name).alias("mode"), "*") for name, m in modes.items()]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query(f"WITH {_DOCS} SELECT k FROM d WHERE k % 8 IN (3, 6)")
def unreadable_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.unreadable(_documents(spark, sf_dir)).select("k")


@query(f"WITH {_DOCS} SELECT k, CASE k % 8 WHEN 2 THEN NULL WHEN 3 THEN NULL WHEN 6 THEN NULL ELSE name END AS issue FROM d")
def json_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C14."""
    return _documents(spark, sf_dir).select("k", T.json_field(F.col("value"), "issue").alias("issue"))


@query(f"WITH {_DOCS} SELECT sha256(name) AS sha, 'articles/' || name || '.pdf' AS name FROM d WHERE k % 5 <> 2")
def checksum_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with one or two spaces or a tab, some blank."""
    k = F.col("p_partkey")
    gap = F.when(k % 3 == 0, "  ").when(k % 3 == 1, " ").otherwise("\t")
    line = F.when(k % 5 == 2, F.repeat(F.lit(" "), (k % 4).cast("int"))).otherwise(F.concat(F.repeat(F.lit(" "), (k % 2).cast("int")), F.sha2("p_name", 256), gap, F.lit("articles/"), "p_name", F.lit(".pdf"), F.repeat(F.lit(" "), (k % 2).cast("int"))))
    return readers.checksums(spark.read.parquet(f"{sf_dir}/part.parquet").select(line.alias("value")))


@query("""SELECT value FROM (SELECT event_id AS place, CASE event_id % 4 WHEN 0 THEN '[step ' WHEN 1 THEN '[merge ' WHEN 2 THEN 'step ' ELSE '[ok ' END || event_id || ']' AS value FROM events) WHERE contains(value, '[step') OR contains(value, '[merge') ORDER BY place DESC LIMIT 25""")
def step_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A top-k report."""
    i = F.col("event_id")
    head = F.when(i % 4 == 0, "[step ").when(i % 4 == 1, "[merge ").when(i % 4 == 2, "step ").otherwise("[ok ")
    return readers.last_steps(spark.read.parquet(f"{sf_dir}/events.parquet").select(i.alias("at"), F.concat(head, i.cast("string"), F.lit("]")).alias("value")))


@query("""SELECT '{"status":"success","component":"c","version":"1","data":{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '","n_regionkey":' || n_regionkey || '},"error":null}' AS value FROM nation
  UNION ALL SELECT '{"component":"c","data":{"n_name":"' || n_name || '","n_nationkey":' || n_nationkey || ',"n_regionkey":' || n_regionkey || '},"error":null,"status":"success","version":"1"}' FROM nation
  UNION ALL SELECT '{"status":"error","component":"c","version":"1","data":null,"error":{"exit_code":30,"code":"odd","message":"odd: {\\"n_nationkey\\":' || n_nationkey || '}","details":{"n_nationkey":' || n_nationkey || '}}}' FROM nation WHERE n_nationkey % 2 = 1""")
def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: as written, with sorted keys, and for violations."""
    n = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey", "n_name", "n_regionkey")
    odd = n.where("n_nationkey % 2 = 1").select(F.lit("odd").alias("rule"), "n_nationkey")
    return writers.envelopes(n, "c", "1").unionByName(writers.envelopes(n, "c", "1", sort_keys=True)).unionByName(writers.error_envelopes(odd, "c", "1", 30))


@query(f"WITH {_MANIFEST}, listed AS (SELECT issue, id, filename, row_number() OVER (PARTITION BY issue ORDER BY id) - 1 AS place, count(*) OVER (PARTITION BY issue) AS total_articles FROM manifest) SELECT issue, CAST(place AS INT) AS place, id, filename, total_articles FROM listed")
def export_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One manifest for each issue, its articles by their id as text."""
    m = writers.manifests(ranges.manifest(*_anchors(spark, sf_dir)), "now")
    return m.select("issue", "total_articles", F.posexplode("articles").alias("place", "a")).select("issue", "place", F.col("a.article_id").alias("id"), "a.filename", "total_articles")


def _split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """issue, id, path, bytes, sha: split files of the ranges, some absent, some empty."""
    r = _ranges(spark, sf_dir)[2]
    return r.where("(issue + nth) % 5 <> 0").select("issue", "id", F.concat(F.lit("/split/"), F.col("issue").cast("string"), F.lit("_"), "id", F.lit(".pdf")).alias("path"), (F.col("issue") * 100 + F.col("nth")).alias("b"), ((F.col("issue") + F.col("nth")) % 7 * 10).cast("long").alias("bytes"), F.sha2("id", 256).alias("sha")).drop("b")


@query(f"WITH {_CHAIN}, f AS (SELECT issue, id, '/split/' || issue || '_' || id || '.pdf' AS path, CAST((issue + nth) % 7 * 10 AS BIGINT) AS bytes FROM ranges WHERE (issue + nth) % 5 <> 0) SELECT r.issue, r.id, path, bytes, coalesce(bytes > 0, false) AS ok FROM ranges r LEFT JOIN f USING (issue, id)")
def split_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J8."""
    return constraints.split_files(_ranges(spark, sf_dir)[2], _split(spark, sf_dir)).select("issue", "id", "path", "bytes", "ok")


@query(f"WITH {_MANIFEST} SELECT issue, m.id, filename, CASE WHEN (issue + nth) % 5 <> 0 THEN '/split/' || issue || '_' || m.id || '.pdf' END AS path, CASE WHEN (issue + nth) % 5 <> 0 THEN sha256(m.id) END AS sha256 FROM manifest m")
def manifest_with_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = ranges.manifest(*_anchors(spark, sf_dir), files=_split(spark, sf_dir))
    return m.select("issue", "id", "filename", "splitter_output.path", "splitter_output.sha256")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'golden_only' WHEN o_orderkey % 7 = 1 THEN 'actual_only' ELSE 'differs' END AS rule FROM orders WHERE o_orderkey % 7 IN (0, 1) OR o_orderkey % 7 = 2""")
def unlike_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clock, id and paths of a run are left out; a changed file name shows."""
    o, k = spark.read.parquet(f"{sf_dir}/orders.parquet"), F.col("o_orderkey")

    def made(run: str, changed: Column) -> DataFrame:
        name = F.concat(F.lit("f"), F.col("o_custkey").cast("string"), F.when(changed, "x").otherwise(""))
        article = lambda n: F.struct(F.lit(n).alias("article_id"), name.alias("filename"), F.lit(f"/{run}/{n}").alias("export_path"))
        return o.select("o_orderkey", F.lit(run).alias("export_id"), F.lit(run).alias("export_timestamp_utc"), F.col("o_custkey").alias("issue"), F.array(article("a01"), article("a02")).alias("articles"))

    a, g = made("one", F.lit(False)).where(k % 7 != 0), made("two", k % 7 == 2).where(k % 7 != 1)
    return constraints.unlike_manifests(a, g, "o_orderkey", ("export_id", "export_timestamp_utc"), {"articles": ("export_path",)})


@query("SELECT c_custkey, c_name, CASE WHEN c_custkey % 3 <> 0 THEN '/runs/' || c_custkey END AS splitter_output_dir FROM customer")
def grafted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J12."""
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_name")
    split = c.where("c_custkey % 3 <> 0").select("c_custkey", F.concat(F.lit("/runs/"), F.col("c_custkey").cast("string")).alias("splitter_output_dir"), F.lit(1).alias("c_name"))
    return constraints.grafted(c, split, "c_custkey", "splitter_output_dir")


@query("SELECT event_id, strftime(ts, '%Y_%m_%d__%H_%M_%S') AS run FROM events")
def timestamp_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C12."""
    return spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", T.timestamp_id(F.col("ts")).alias("run"))


@query("""SELECT c_custkey AS export, name FROM customer, (SELECT unnest(['articles', 'manifest', 'checksums.sha256', 'README.md']) AS name, unnest([2, 3, 5, 7]) AS n) WHERE c_custkey % n = 1""")
def incomplete_exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V7."""
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").alias("export"))
    held = F.array(*(F.when(F.col("export") % n != 1, name) for name, n in zip(constraints.EXPORT_PARTS, (2, 3, 5, 7), strict=True)))
    return constraints.incomplete_exports(c, c.select("export", F.explode(held).alias("name")).where("name is not null"))


@query("""SELECT 'p' || p_partkey AS path FROM part WHERE p_partkey % 4 = 1""")
def missing_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = spark.read.parquet(f"{sf_dir}/part.parquet").select(F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("path"), "p_partkey")
    return constraints.missing_files(p.select("path"), p.where("p_partkey % 4 <> 1"))


@query("""SELECT p_partkey FROM part WHERE p_partkey % 6 IN (1, 2) OR (p_partkey % 6 = 3)""")
def bad_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V8: other size, other hash, no copy."""
    k, sha = F.col("p_partkey"), F.sha2("p_name", 256)
    p = spark.read.parquet(f"{sf_dir}/part.parquet")
    copies = p.select(k, F.lit(10).alias("source_bytes"), sha.alias("source_sha"), F.when(k % 6 == 1, 11).when(k % 6 != 3, 10).alias("bytes"), F.when(k % 6 == 2, "x").when(k % 6 != 3, sha).alias("sha"))
    return constraints.bad_copies(copies).select("p_partkey")


@query("""SELECT issue_id, journal_code, pdf_path, rule FROM (SELECT CASE WHEN k % 11 <> 0 THEN 'mg_' || k END AS issue_id, CASE WHEN k % 7 <> 0 THEN 'mg' ELSE '' END AS journal_code, CASE WHEN k % 5 <> 0 THEN '/in/' || k END AS pdf_path,
  CASE WHEN k % 11 = 0 THEN 'issue_id' WHEN k % 7 = 0 THEN 'journal_code' WHEN k % 5 = 0 THEN 'pdf_path' WHEN k % 3 = 0 THEN 'absent' WHEN k % 4 = 0 THEN 'no_file' END AS rule FROM (SELECT c_custkey AS k FROM customer)) WHERE rule IS NOT NULL""")
def bad_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V11."""
    c, k = spark.read.parquet(f"{sf_dir}/customer.parquet"), F.col("c_custkey")
    text = k.cast("string")
    inputs = c.select(F.when(k % 11 != 0, F.concat(F.lit("mg_"), text)).alias("issue_id"), F.when(k % 7 != 0, "mg").otherwise("").alias("journal_code"), F.when(k % 5 != 0, F.concat(F.lit("/in/"), text)).alias("pdf_path"))
    return constraints.bad_inputs(inputs, c.where(k % 3 != 0).select(F.concat(F.lit("/in/"), text).alias("path"), (k % 4 != 0).alias("is_file")))


@query(f"WITH {_CHAIN} SELECT issue, start_page FROM (SELECT issue, CASE start_page % 5 WHEN 0 THEN -start_page WHEN 1 THEN NULL ELSE start_page END AS start_page, CASE WHEN start_page % 3 = 0 THEN kind END AS kind FROM starts) WHERE start_page IS NULL OR start_page < 1 OR kind IS NULL")
def bad_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V13."""
    s, p = ranges.article_starts(_anchors(spark, sf_dir)[0]), F.col("start_page")
    return constraints.bad_starts(s.select("issue", F.when(p % 5 == 0, -p).when(p % 5 != 1, p).alias("start_page"), F.when(p % 3 == 0, F.col("kind")).alias("kind"))).select("issue", "start_page")


@query(f"WITH {_CHAIN} SELECT issue, start_page FROM starts WHERE start_page % 3 <> 0")
def uncertain_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V9's rule on confidence."""
    s, p = ranges.article_starts(_anchors(spark, sf_dir)[0]), F.col("start_page")
    return constraints.uncertain_starts(s.withColumn("confidence", F.when(p % 3 == 0, F.col("confidence")).when(p % 3 == 1, 0.5))).select("issue", "start_page")


@query(f"WITH {_RUNS_SQL} SELECT * REPLACE (CASE WHEN run_id = '7' THEN 'done' ELSE status END AS status) FROM runs WHERE run_id IN ('7', '97', '98')")
def run_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Point update and lookup by key."""
    r = runs.updated(_runs(spark, sf_dir), "7", status="done")
    return runs.run_of(r, "7").unionByName(runs.run_of(r, "97")).unionByName(runs.run_of(r, "98"))
