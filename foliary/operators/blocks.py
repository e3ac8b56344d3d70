"""From pages to anchors: the span scan, the merge of neighbouring spans, picks of title, authors and the rest, the union.

Rules are functions of array columns, so a page is worked on in its own row: anchors_of() reads pages once and shuffles
nothing. Spans: issue, page, seq, text, lang, x0, y0, x1, y1, font_size, font_name. seq is a span's place on its page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliary.functions import text as T

# Fixed values.
FONT_GAP, LINE_GAP, TOP_SHARE, TITLE_CHARS = 0.5, 6.0, 0.40, 10
DOI_CONFIDENCE, BLOCK_CONFIDENCE, MARKER_CONFIDENCE = 0.98, 0.90, 0.95
#: The streams of anchors in their order, and the picks of a page in theirs.
STREAMS = ("doi", "text_block", "ru", "en", "contents_marker")
RU_PICKS = ("ru_title", "ru_abstract", "ru_authors", "ru_affiliations", "ru_address")
EN_PICKS = ("en_title", "en_authors")

BLOCKS_JSON = "array<struct<type:int,lines:array<struct<spans:array<struct<text:string,bbox:array<double>,size:double,font:string>>>>>>"
SPAN = "struct<seq:bigint,text:string,lang:string,x0:double,y0:double,x1:double,y1:double,font_size:double,font_name:string>"
BLOCK = "struct<nth:int,text:string,x0:double,y0:double,x1:double,y1:double,font_size:double,seq:bigint>"
ANCHOR = "struct<stream:int,nth:bigint,type:string,text:string,value:string,lang:string,x0:double,y0:double,x1:double,y1:double,font_size:double,font_name:string,confidence:double>"
BOX = ("x0", "y0", "x1", "y1")


def span_place(block: Column, line: Column, span: Column) -> Column:
    """One number for a span's place on its page: 13 bits each for line and span, the block above them."""
    return block.cast("long") * (1 << 26) + line.cast("long") * (1 << 13) + span.cast("long")


def anchor_seq(stream: Column, page: Column, nth: Column) -> Column:
    """One number for an anchor's place in its issue: stream, page, place on the page."""
    return stream.cast("long") * (1 << 60) + page.cast("long") * (1 << 40) + nth.cast("long")


def spans_of(blocks: Column) -> Column:
    """The spans of a page's blocks (as arrays, or as the JSON that read_pdfs gives).

    Blocks that hold no text, empty texts, boxes without four numbers and missing sizes are left out.
    """

    def span(b: Column, ln: Column):  # noqa: ANN202
        def of(s: Column, i: Column) -> Column:
            text, box = T.normal_space(s["text"]), s["bbox"]
            return F.struct(
                span_place(b, ln, i).alias("seq"), text.alias("text"), T.language(text).alias("lang"), *(F.get(box, k).alias(c) for k, c in enumerate(BOX)), s["size"].alias("font_size"), F.nullif(s["font"], F.lit("")).alias("font_name"), F.size(box).alias("n_box"),
            )

        return of

    text_blocks = F.filter(F.transform(blocks, lambda b, i: F.struct(b.alias("b"), i.alias("i"))), lambda x: x["b"]["type"] == 0)
    nested = F.transform(text_blocks, lambda x: F.flatten(F.transform(F.coalesce(x["b"]["lines"], F.array().cast(f"array<{_LINE}>")), lambda ln, j: F.transform(F.coalesce(ln["spans"], F.array().cast(f"array<{_RAW}>")), span(x["i"], j)))))
    good = F.filter(F.flatten(nested), lambda s: (s["text"] != "") & (s["n_box"] == 4) & s["font_size"].isNotNull())
    return F.coalesce(F.transform(good, lambda s: s.dropFields("n_box")), F.array()).cast(f"array<{SPAN}>")


_RAW = "struct<text:string,bbox:array<double>,size:double,font:string>"
_LINE = f"struct<spans:array<{_RAW}>>"


def with_spans(pages: DataFrame) -> DataFrame:
    """pages (issue, page, page_height, text, blocks) with an array `spans` in place of blocks."""
    blocks = F.from_json("blocks", BLOCKS_JSON) if pages.schema["blocks"].dataType.simpleString() == "string" else F.col("blocks").cast(BLOCKS_JSON)
    return pages.withColumn("spans", spans_of(blocks)).drop("blocks")


def exploded_spans(pages: DataFrame) -> DataFrame:
    """S5 as rows: spans with issue, page and page_height, as merged_blocks takes them."""
    return with_spans(pages).select("issue", "page", "page_height", F.explode("spans").alias("s")).select("issue", "page", "page_height", "s.*", F.lit(BLOCK_CONFIDENCE).alias("confidence"))


def doi_anchors(pages: DataFrame) -> DataFrame:
    """Every DOI of a page's text, in order."""
    return pages.select("issue", "page", F.posexplode(F.regexp_extract_all("text", F.lit(T.DOI), F.lit(0))).alias("nth", "value"))


def doi_boxes(dois: DataFrame, spans: DataFrame) -> DataFrame:
    """The box of the first span on the page that holds the DOI, else zeros."""
    s = spans.select("issue", "page", "seq", "text", F.struct(*BOX).alias("box"))
    met = dois.join(s, ["issue", "page"], "left").groupBy("issue", "page", "nth", "value").agg(F.min_by("box", F.when(F.col("text").contains(F.col("value")), F.col("seq"))).alias("box"))
    return met.select("issue", "page", "nth", "value", *(F.coalesce(f"box.{c}", F.lit(0.0)).alias(c) for c in BOX))


def folded(spans: Column) -> Column:
    """M1: a fold over the spans of one page and language, by place: each is compared with the open block, whose font is its first one's."""
    state = f"struct<done:array<{BLOCK}>,open:{BLOCK}>"
    in_order = F.array_sort(F.transform(spans, lambda s: F.struct(*(s[c].alias(c) for c in ("y0", "x0", "seq", "text", "x1", "y1", "font_size")))))

    def block(s: Column, nth: Column) -> Column:
        return F.struct(nth.alias("nth"), s["text"].alias("text"), *(s[c].alias(c) for c in BOX), s["font_size"].alias("font_size"), s["seq"].cast("long").alias("seq"))

    def step(acc: Column, s: Column) -> Column:
        last = acc["open"]
        joins = F.coalesce((F.abs(last["font_size"] - s["font_size"]) <= FONT_GAP) & (F.abs(s["y0"] - last["y1"]) <= LINE_GAP), F.lit(False))
        grown = F.struct(
            last["nth"].alias("nth"), T.normal_space(F.concat_ws(" ", last["text"], s["text"])).alias("text"), F.least(last["x0"], s["x0"]).alias("x0"), F.least(last["y0"], s["y0"]).alias("y0"),
            F.greatest(last["x1"], s["x1"]).alias("x1"), F.greatest(last["y1"], s["y1"]).alias("y1"), last["font_size"].alias("font_size"), last["seq"].alias("seq"),
        )
        closed = F.struct(F.when(last.isNull(), acc["done"]).otherwise(F.concat(acc["done"], F.array(last))).alias("done"), block(s, F.coalesce(last["nth"] + 1, F.lit(0))).alias("open"))
        return F.when(joins, F.struct(acc["done"].alias("done"), grown.alias("open")).cast(state)).otherwise(closed.cast(state))

    first = F.struct(F.array().cast(f"array<{BLOCK}>").alias("done"), F.lit(None).cast(BLOCK).alias("open")).cast(state)
    finish = lambda acc: F.when(acc["open"].isNull(), acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["open"])))
    return F.aggregate(in_order, first, step, finish)


def page_blocks(spans: DataFrame) -> DataFrame:
    """issue, page, lang, page_height, blocks: the merged blocks of each page and language, from rows of spans."""
    entry = F.struct("y0", "x0", "seq", "text", "x1", "y1", "font_size")
    rows = spans.where(F.col("lang").isin("ru", "en")).groupBy("issue", "page", "lang", "page_height").agg(F.collect_list(entry).alias("spans"))
    return rows.withColumn("blocks", folded(F.col("spans"))).drop("spans")


def merged_blocks(spans: DataFrame) -> DataFrame:
    """M1 as rows."""
    return page_blocks(spans).select("issue", "page", "lang", "page_height", F.explode("blocks").alias("b")).select("issue", "page", "lang", "page_height", "b.*").drop("nth")


def title_of(blocks: Column, height: Column) -> Column:
    """A2: of blocks in the top of the page with enough text, the largest font; then the highest, the leftmost, the first."""
    top = F.filter(blocks, lambda b: ((b["y0"] + b["y1"]) / 2 <= TOP_SHARE * height) & (F.length(b["text"]) >= TITLE_CHARS))
    return F.array_max(F.transform(top, lambda b: F.struct(b["font_size"].alias("f"), (-b["y0"]).alias("a"), (-b["x0"]).alias("b"), (-b["nth"]).alias("c"), b.alias("block"))))["block"]


def placed(blocks: Column) -> Column:
    """O1: blocks by place, as struct(y0, x0, nth, block)."""
    return F.array_sort(F.transform(blocks, lambda b: F.struct(b["y0"].alias("y0"), b["x0"].alias("x0"), b["nth"].alias("nth"), b.alias("block"))))


def author_of(blocks: Column, title: Column, height: Column, russian: bool) -> Column:
    """struct(name, block) of the first byline at or below the title; in Russian also the prefix of a longer block, in English in the page's top only."""
    here = F.filter(placed(blocks), lambda x: (x["y0"] >= title["y0"]) & (x["block"]["text"] != title["text"]) & (F.lit(russian) | ((x["y0"] + x["block"]["y1"]) / 2 <= TOP_SHARE * height)))

    def name(text: Column) -> Column:
        whole = F.when(T.is_byline(text) | T.is_single_byline(text), text)
        return F.when(~T.is_running_header(text), F.coalesce(whole, T.byline_prefix(text)) if russian else whole)

    named = F.transform(here, lambda x: F.struct(name(x["block"]["text"]).alias("name"), x["block"].alias("block")))
    return F.get(F.filter(named, lambda x: x["name"].isNotNull()), 0)


def first_below(blocks: Column, author: Column, pattern: str) -> Column:
    """The first block at or below the authors' that matches."""
    return F.get(F.filter(placed(blocks), lambda x: (x["y0"] >= author["block"]["y0"]) & x["block"]["text"].rlike(pattern)), 0)["block"]


def abstract_of(blocks: Column) -> Column:
    """struct(text, block) of the first block in merge order that holds the marker and a text behind it."""
    marked = F.transform(blocks, lambda b: F.struct(T.normal_space(T.abstract_text(b["text"])).alias("text"), b.alias("block")))
    return F.get(F.filter(marked, lambda x: x["text"].isNotNull()), 0)


def with_picks(pages: DataFrame, russian: bool, blocks: str = "blocks") -> DataFrame:
    """pages with an array column of blocks and page_height -> title, author, and in Russian affiliation, address and abstract."""
    b, h = F.col(blocks), F.col("page_height")
    out = pages.withColumn("title", title_of(b, h)).withColumn("author", author_of(b, F.col("title"), h, russian))
    if not russian:
        return out
    out = out.withColumn("affiliation", first_below(b, F.col("author"), T.AFFILIATION)).withColumn("address", first_below(b, F.col("author"), T.ADDRESS))
    return out.withColumn("abstract", abstract_of(b))


def of_language(spans: Column, lang: str) -> Column:
    return F.filter(spans, lambda s: s["lang"] == lang)


def page_picks(spans: DataFrame) -> DataFrame:
    """issue, page, lang and the picks of each page and language, from rows of spans; null where there is none."""
    b = page_blocks(spans)
    ru, en = with_picks(b.where("lang = 'ru'"), True), with_picks(b.where("lang = 'en'"), False)
    return ru.unionByName(en, allowMissingColumns=True).drop("blocks", "page_height")


def anchors_of(pages: DataFrame) -> DataFrame:
    """Pages (issue, page, page_height, text, blocks) -> all anchors, in one reading and without a shuffle.

    issue, seq, page, type, text, value, lang, x0, y0, x1, y1, font_size, font_name, confidence. seq orders an issue's
    anchors: DOIs, text blocks, Russian picks, English picks, contents markers, each by page and place.
    """
    p = with_spans(pages)
    spans = F.col("spans")
    for lang in ("ru", "en"):
        blocks = f"{lang}_blocks"
        p = p.withColumn(blocks, folded(of_language(spans, lang)))
        p = with_picks(p, lang == "ru", blocks).withColumnsRenamed({c: f"{lang}_{c}" for c in ("title", "author", "affiliation", "address", "abstract")})

    def anchor(stream: str, nth: Column, kind: Column, block: Column, confidence: float, **more: Column) -> Column:
        none = F.lit(None).cast("string")
        put = {"text": block["text"], "value": none, "lang": none, **{c: block[c] for c in BOX}, "font_size": F.lit(None).cast("double"), "font_name": none} | more
        return F.struct(F.lit(STREAMS.index(stream)).alias("stream"), nth.cast("long").alias("nth"), kind.alias("type"), *(v.alias(k) for k, v in put.items()), F.lit(confidence).alias("confidence")).cast(ANCHOR)

    def doi(value: Column, i: Column) -> Column:
        hit = F.get(F.filter(spans, lambda s: s["text"].contains(value)), 0)
        return anchor("doi", i, F.lit("doi"), hit, DOI_CONFIDENCE, text=F.lit(None).cast("string"), value=value, **{c: F.coalesce(hit[c], F.lit(0.0)) for c in BOX})

    def span(s: Column) -> Column:
        return anchor("text_block", s["seq"], F.lit("text_block"), s, BLOCK_CONFIDENCE, lang=s["lang"], font_size=s["font_size"], font_name=s["font_name"])

    def pick(stream: str, nth: int, kind: str, block: Column, text: Column) -> Column:
        return F.when(block.isNotNull(), anchor(stream, F.lit(nth), F.lit(kind), block, BLOCK_CONFIDENCE, text=text, lang=F.lit(stream)))

    c = F.col
    ru = [(c("ru_title"), c("ru_title.text")), (c("ru_abstract.block"), c("ru_abstract.text")), (c("ru_author.block"), c("ru_author.name")), (c("ru_affiliation"), c("ru_affiliation.text")), (c("ru_address"), c("ru_address.text"))]
    en = [(c("en_title"), c("en_title.text")), (c("en_author.block"), c("en_author.name"))]
    picks = [pick("ru", i, k, *x) for i, (k, x) in enumerate(zip(RU_PICKS, ru, strict=True))] + [pick("en", i, k, *x) for i, (k, x) in enumerate(zip(EN_PICKS, en, strict=True))]
    streams = F.concat(
        F.transform(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(T.DOI), F.lit(0)), doi),
        F.transform(spans, span),
        F.filter(F.array(*picks), lambda a: a.isNotNull()),
        F.transform(F.filter(spans, lambda s: T.is_contents_marker(s["text"])), lambda s: anchor("contents_marker", s["seq"], F.lit("contents_marker"), s, MARKER_CONFIDENCE)),
    )
    rows = p.select("issue", F.col("page").cast("long").alias("page"), F.explode(streams).alias("a"))
    return rows.select("issue", anchor_seq(F.col("a.stream"), F.col("page"), F.col("a.nth")).alias("seq"), "page", "a.*").drop("stream", "nth")


def page_lists(pages: DataFrame) -> DataFrame:
    """S3, A1: pages with and without text by issue."""
    has = T.stripped(F.coalesce("text", F.lit(""))) != ""
    listed = lambda c: F.array_join(F.array_sort(F.collect_list(F.when(c, F.col("page")))), ",")
    return pages.groupBy("issue").agg(F.count("*").alias("pages"), listed(has).alias("text_pages"), listed(~has).alias("blank_pages"))
