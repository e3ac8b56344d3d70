"""Merge, picks, ranges, cascade and rules on literal rows."""

import json

import pytest
from pyspark.sql import functions as F

from foliary.operators import blocks, constraints, ranges

SPAN = "issue long, seq long, page long, page_height double, lang string, text string, x0 double, y0 double, x1 double, y1 double, font_size double"
ANCHOR = "issue long, seq long, page long, type string, text string, value string, font_name string, font_size double"


def spans(spark, rows):
    return spark.createDataFrame([(1, i, 1, 100.0, r[4] if len(r) > 4 else "ru", r[0], 0.0, r[1], 9.0, r[2], r[3]) for i, r in enumerate(rows)], SPAN)


def texts(df):
    return [r.text for r in df.orderBy("y0", "seq").collect()]


def test_merge_is_a_fold(spark):
    assert texts(blocks.merged_blocks(spans(spark, [("A", 0.0, 5.0, 10.0), ("B", 6.0, 11.0, 10.4), ("C", 12.0, 17.0, 10.8)]))) == ["A B", "C"]
    assert texts(blocks.merged_blocks(spans(spark, [("A", 0.0, 40.0, 10.0), ("B", 38.0, 39.0, 10.0), ("C", 46.0, 50.0, 10.0)]))) == ["A B C"]
    assert blocks.merged_blocks(spans(spark, [])).count() == 0


def test_title_and_authors(spark):
    p = blocks.page_picks(spans(spark, [("Исследование сердца", 10.0, 20.0, 14.0), ("Vol. 3", 30.0, 32.0, 8.0), ("Гелприн М. Рассказ Майка", 50.0, 60.0, 10.0), ("Институт, г. Москва", 80.0, 90.0, 9.0)])).first()
    assert p.title.text == "Исследование сердца"
    assert p.author.name == "Гелприн М."
    assert (p.affiliation.text, p.address.text) == ("Институт, г. Москва",) * 2
    assert p.abstract is None


def test_picks_of_one_place_go_by_merge_order(spark):
    rows = [("Аннотация", 10.0, 12.0, 9.0), ("Аннотация: раз", 40.0, 42.0, 9.0), ("Аннотация: два", 60.0, 62.0, 9.0), ("Заголовок первый", 20.0, 22.0, 14.0), ("Заголовок второй", 20.0, 22.0, 15.0), ("Заголовок третий", 20.0, 22.0, 16.0)]
    p = blocks.page_picks(spans(spark, rows)).first()
    assert (p.title.text, p.abstract.text) == ("Заголовок третий", "раз")
    assert p.author is None and p.affiliation is None


PAGE = "issue long, page long, page_height double, text string, blocks string"


def block(*texts, kind=0, y=10.0, size=12.0, font="MyriadPro-BoldIt", box=4):
    return {"type": kind, "lines": [{"spans": [{"text": t, "bbox": [0.0, y + 20 * i, 9.0, y + 20 * i + 5][:box], "size": size, "font": font}]} for i, t in enumerate(texts)]}


def test_extraction_from_pages_to_manifest(spark):
    """The scan feeds the merge, the picks, the union and the manifest."""
    pages = [
        (1, 1, 100.0, "x", [block("Contents")]),
        (1, 2, 100.0, "x", [block("  Исследование   сердца "), block("Плоткин Ф.Б.", y=60.0, size=9.0), block("Институт, г. Москва", y=80.0, size=8.0), block("фото", kind=1), block("", box=4), block("short box", box=3), block("no size", size=None)]),
        (1, 3, 100.0, "see 10.1234/abc.2026.02.7-9 now", [block("see 10.1234/abc.2026.02.7-9 now", font="")]),
        (1, 4, 100.0, None, None),
        (1, 5, 100.0, "", [block("ИНФОРМАЦИЯ ДЛЯ ВСЕХ"), block("Информация", y=70.0)]),
    ]
    df = spark.createDataFrame([(*p[:4], json.dumps(p[4], ensure_ascii=False) if p[4] is not None else None) for p in pages], PAGE)
    got = blocks.anchors_of(df).orderBy("seq").collect()
    assert [(a.page, a.type, a.text or a.value) for a in got if a.page == 2] == [
        (2, "text_block", "Исследование сердца"), (2, "text_block", "Плоткин Ф.Б."), (2, "text_block", "Институт, г. Москва"),
        (2, "ru_title", "Исследование сердца"), (2, "ru_authors", "Плоткин Ф.Б."), (2, "ru_affiliations", "Институт, г. Москва"), (2, "ru_address", "Институт, г. Москва"),
    ]
    assert [(a.type, a.value, a.x1, a.confidence) for a in got if a.type == "doi"] == [("doi", "10.1234/abc.2026.02.7-9", 9.0, 0.98)]
    assert [a.type for a in got] == sorted((a.type for a in got), key=lambda t: 0 if t == "doi" else 1 if t == "text_block" else 2 if t.startswith("ru") else 3 if t.startswith("en") else 4)
    assert {a.font_name for a in got if a.page == 3 and a.type == "text_block"} == {None}
    rows = blocks.merged_blocks(blocks.exploded_spans(df)).where("page = 2").orderBy("y0").collect()
    assert [r.text for r in rows] == ["Исследование сердца", "Плоткин Ф.Б.", "Институт, г. Москва"]
    issues = spark.createDataFrame([(1, 5, "Mg_2026-02")], "issue long, total_pages long, prefix string")
    files = spark.createDataFrame([(1, "a02", "/f", 7, "s")], "issue long, id string, path string, bytes long, sha string")
    m = ranges.manifest(blocks.anchors_of(df), issues, files).orderBy("nth").collect()
    assert [(r.id, r.lo, r.hi, r.kind, r.filename) for r in m] == [
        ("a01", 1, 1, "contents", "Mg_2026-02_001-001_Contents.pdf"), ("a02", 2, 4, "research", "Mg_2026-02_002-004_Plotkin.pdf"), ("a03", 5, 5, "info", "Mg_2026-02_005-005_Info.pdf"),
    ]
    assert m[1].evidence.asDict() == {"anchor_type": "ru_authors", "anchor_page": 2, "en_authors_verified": None, "text_block_index": None}
    assert m[1].splitter_output.asDict() == {"path": "/f", "bytes": 7, "sha256": "s"}
    assert m[0].splitter_output is None and m[0].surname is None
    assert blocks.anchors_of(df.limit(0)).count() == 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_manifest_plan(spark, tmp_path):
    """Anchors are read twice (pages, issues) and go through few exchanges; extraction shuffles nothing."""
    path = f"{tmp_path}/a"
    anchors(spark, [(5, "text_block", "Исследование сердца")]).write.parquet(path)
    a = spark.read.parquet(path)
    issues = a.groupBy("issue").agg((F.max("page") + 1).alias("total_pages")).withColumn("prefix", F.lit("Mg_2026-02"))
    plan = plan_of(ranges.manifest(a, issues))
    assert plan.count("FileScan parquet") <= 2
    assert plan.count("Exchange ") <= 5
    df = spark.createDataFrame([(1, 1, 1.0, "", "[]")], PAGE)
    assert "Exchange" not in plan_of(blocks.anchors_of(df))


def anchors(spark, rows):
    return spark.createDataFrame([(1, i, r[0], r[1], r[2], r[3] if len(r) > 3 else None, "MyriadPro-BoldIt", 12.0) for i, r in enumerate(rows)], ANCHOR)


def test_ranges_of_a_known_issue(spark):
    # The start pages of a known issue.
    starts = [5, 6, 16, 28, 34, 42, 51, 67, 74, 80, 88, 97, 108, 110, 113, 116, 119, 122, 125, 130, 133, 137, 140, 143, 145, 148, 151, 154]
    rows = [(1, p, "research", 1) for p in starts] + [(1, 3, "contents", 0)]
    got = ranges.ranges(spark.createDataFrame(rows, "issue long, start_page long, kind string, origin int"), spark.createDataFrame([(1, 156)], "issue long, total_pages long")).orderBy("nth").collect()
    assert [(r.lo, r.hi) for r in got] == list(zip([1, *starts], [*(s - 1 for s in starts), 156], strict=True))
    assert [got[0].id, got[-1].id] == ["a01", "a29"]


def test_translated_pages_go_only_if_all_holds(spark):
    ru, en = (5, "text_block", "Исследование сердца"), (6, "text_block", "Heart research study")
    mark = (6, "text_block", "KEYWORDS")
    pages = lambda rows: [r.page for r in ranges.start_pages(anchors(spark, rows)).orderBy("page").collect()]
    assert pages([ru, en, mark]) == [5]
    assert pages([ru, en]) == [5, 6]
    assert pages([ru, (7, *en[1:]), (7, *mark[1:])]) == [5, 7]
    assert pages([en[:0] + (5, *en[1:]), en, mark]) == [5, 6]
    assert pages([ru, (6, "text_block", "Heart research study " * 3), mark]) == [5, 6]
    assert pages([ru, (5, "doi", "", "10.1/x.3-9")]) == []
    assert pages([]) == []


def test_kinds(spark):
    rows = [(p, "text_block", "Исследование сердца") for p in (5, 10, 15, 20, 25)]
    rows += [(12, "contents_marker", "Contents"), (14, "contents_marker", "Contents"), (15, "en_authors", "Smith J.J."), (20, "ru_title", "Дайджест"), (25, "text_block", "Информация"), (5, "ru_authors", "Уважаемые коллеги")]
    got = {r.start_page: r.kind for r in ranges.article_starts(anchors(spark, rows)).collect()}
    assert got == {5: "editorial", 10: "contents", 15: "research", 20: "digest", 25: "info"}
    a = anchors(spark, rows)
    found = ranges.ranges(ranges.article_starts(a), spark.createDataFrame([(1, 30)], "issue long, total_pages long")).where("kind = 'contents'")
    assert ranges.verified(found.withColumn("hi", found.lo), a).first().kind == "research"


@pytest.mark.parametrize(
    "rows,want",
    [
        ([(5, "ru_authors", "Иванов И.И."), (6, "en_authors", "Ivanoff I.I.")], ("Ivanoff", "ru_authors_author_translit")),
        ([(5, "ru_authors", "Иванов И.И."), (5, "en_authors", "Vol A.A.")], ("Ivanov", "ru_authors_translit")),
        ([(5, "en_authors", "smith J.J.")], ("Smith", "en_authors")),
        ([(5, "text_block", "Table A.A."), (5, "text_block", "Smith J.J."), (6, "text_block", "Зайцев О.О.")], ("Zaytsev", "text_block_translit")),
        ([(5, "text_block", "Table A.A.")] * 6 + [(5, "text_block", "Smith J.J.")], (None, None)),
        ([(5, "text_block", "Vol. 3")] * 7 + [(5, "text_block", "Smith J.J.")], ("Smith", "text_block")),
        ([(7, "ru_authors", "Иванов И.И.")], (None, None)),
    ],
)
def test_surname_cascade(spark, rows, want):
    found = spark.createDataFrame([(1, "a01", 5, "research")], "issue long, id string, lo long, kind string")
    got = ranges.surnames(found, anchors(spark, rows)).first()
    assert (got.surname, got.source) == want
    if want == ("Zaytsev", "text_block_translit"):
        assert tuple(got.evidence) == ("text_block", 6, None, 2)


def test_surnames_fit_file_names(spark):
    """What a file name can't hold is replaced in the surname itself."""
    found = spark.createDataFrame([(1, "a01", 5, "research")], "issue long, id string, lo long, kind string")
    assert ranges.surnames(found, anchors(spark, [(5, "en_authors", "O'Brien J.J.")])).first().surname is None
    assert ranges.surnames(found, anchors(spark, [(5, "en_authors", "Smith'son J.J.")])).first().surname == "Smith_son"


def test_first_range_that_is_no_contents(spark):
    """A front contents start whose own page goes to a heading on it: the range from page 1 is reverified, its surname comes from pages 1 and 2."""
    rows = [(1, "ru_authors", "Иванов И.И."), (3, "contents_marker", "Contents"), (3, "text_block", "Исследование сердца"), (3, "en_authors", "Smith J.J.")]
    issues = spark.createDataFrame([(1, 9, "Mg_2026-02")], "issue long, total_pages long, prefix string")
    m = ranges.manifest(anchors(spark, rows), issues).orderBy("nth").collect()
    assert [(r.lo, r.hi, r.first_kind, r.kind, r.surname) for r in m] == [(1, 2, "contents", "research", "Ivanov"), (3, 9, "contents", "contents", None)]


def test_digest_titles_may_be_padded(spark):
    rows = [(5, "text_block", "Исследование сердца"), (5, "ru_title", " \u00a0Дайджест"), (7, "text_block", "Исследование сосудов"), (7, "ru_title", "О дайджесте")]
    assert {r.start_page: r.kind for r in ranges.article_starts(anchors(spark, rows)).collect()} == {5: "digest", 7: "editorial"}


def test_constants():
    """Values that queries and their SQL share, told again."""
    p = ranges.POLICY
    assert (p.font_name, p.font_size, p.tolerance, p.min_chars, p.bylines, p.front_pages, p.contents_reach) == ("MyriadPro-BoldIt", 12.0, 0.5, 10, 6, 4, 2)
    assert (blocks.FONT_GAP, blocks.LINE_GAP, blocks.TOP_SHARE, blocks.TITLE_CHARS) == (0.5, 6.0, 0.40, 10)
    assert constraints.EXIT_CODES == {"ok": 0, "invalid_input": 10, "extraction": 20, "verification": 30, "build": 40, "internal": 50}
    assert constraints.KINDS == ("contents", "editorial", "research", "digest", "info")


def test_rules(spark):
    names = [("research", "Mg_2025-12_005-014_Ivanov.pdf", "Ivanov"), ("research", "Mg_2025-12_005-014_IVANOV.pdf", "IVANOV"), ("info", "Mg_2025-12_001-004_FrontMatter.pdf", None), ("x", "a", None), ("info", None, None), ("contents", "Mg_2025-12_001-004_Contents.pdf", None), ("digest", "Mg_2025-12_001-004_Info.pdf", None)]
    df = spark.createDataFrame([(1, f"a{i}", *n) for i, n in enumerate(names)], "issue long, id string, kind string, filename string, surname string")
    assert {r.id: r.rule for r in constraints.bad_names(df).collect()} == {"a1": "pattern", "a2": "suffix", "a3": "kind", "a4": "missing", "a6": "suffix"}
    files = spark.createDataFrame([("articles/a.pdf", "1"), ("b.pdf", "2")], "name string, sha string")
    other = spark.createDataFrame([("a.pdf", "1")], "name string, sha string")
    assert constraints.checksum_mismatches(files, other, files).count() == 0
    assert [r.name for r in constraints.checksum_mismatches(files, other, files, strict=True).collect()] == ["b.pdf"]
    assert [r.name for r in constraints.checksum_mismatches(files, other.selectExpr("name", "'9' sha"), files).collect()] == ["a.pdf"]
    with pytest.raises(constraints.RuleBroken) as e:
        constraints.require(files, "none", constraints.EXIT_CODES["verification"])
    assert e.value.code == 30


def test_pages_go_by_issue_from_the_start(spark, tmp_path):
    """Pages are made within their document, so the whole way needs one exchange of documents for each reading; it had one more by page, twice."""
    from foliary.plans import catalog
    from foliary.plans import derived as D

    rows = [(i % 9 - 2 if i % 5 else None, None if i % 7 == 0 else "\n".join(f"l{i}  {j}" * (j % 3) for j in range(i % 12))) for i in range(40)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    pages = D.pages(spark, str(tmp_path)).select("issue", "page", "text", F.size(F.from_json("blocks", blocks.BLOCKS_JSON)).alias("n"))
    by_span = D.spans(spark, str(tmp_path)).groupBy("issue", "page").agg(F.array_sort(F.collect_list(F.struct("seq", "text"))).alias("s"))
    want = by_span.select("issue", "page", F.array_join("s.text", " ").alias("text"), F.size("s").alias("n"))
    assert pages.exceptAll(want).count() == want.exceptAll(pages).count() == 0
    plan = catalog.QUERIES["extracted_manifest"](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
