"""Sources, sinks, run store, inbox, and the queries against their SQL on the small tables."""

import json
import os

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from foliary.operators import blocks, runs
from foliary.plans import catalog
from foliary.sources import readers, writers
from foliary.streaming import inbox

SMALL = "/root/testdata/sf0.001"


def test_envelopes_and_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    docs = {
        "a": {"status": "success", "issue": "outer", "data": {"issue": "x", "n": 1}}, "b": {"issue": "y", "n": 2}, "c": {"status": "error", "issue": "z"}, "d": {"status": "success", "issue": "outer", "data": {"n": 3}},
        "e": {"data": {"issue": "w"}, "n": 9}, "f": {"status": "error", "data": None, "issue": "v"},
    }
    for name, doc in docs.items():
        (tmp_path / f"in/{name}.json").write_text(json.dumps(doc, indent=1))
    read = lambda schema="issue string, n int", **k: {tuple(r) for r in readers.read_json(spark, str(tmp_path / "in"), schema, **k).collect()}
    assert read() == {("x", 1), ("y", 2), ("z", None), (None, 3), ("w", None), (None, None)}
    assert read(require_success=True) == {("x", 1), ("y", 2), (None, 3), ("w", None)}
    assert read(only_with_status=True) == {("x", 1), ("y", 2), ("z", None), (None, 3), (None, 9), (None, None)}
    assert ("error",) in read("status string") and (None,) in read("status string")
    (tmp_path / "in/g.json").write_text('{"issue": ')
    with pytest.raises(Exception, match="no JSON object: .*g.json"):
        read()
    assert len(read(strict=False)) == 6
    assert [r.path.rsplit("/", 1)[1] for r in readers.unreadable(readers.whole_files(spark, str(tmp_path / "in"))).collect()] == ["g.json"]
    (tmp_path / "sums").write_text("abc  articles/a.pdf\n\n  def b c.pdf \n")
    assert {tuple(r) for r in readers.read_checksums(spark, str(tmp_path / "sums")).collect()} == {("abc", "articles/a.pdf"), ("def", "b c.pdf")}
    (tmp_path / "a.pdf").write_bytes(b"x")
    got = readers.read_files(spark, str(tmp_path)).first()
    assert (got.name, got.bytes, got.sha[:8]) == ("a.pdf", 1, "2d711642")
    (tmp_path / "b.pdf").write_bytes(b"xy")
    with pytest.raises(Exception, match="over 1 bytes: .*b.pdf"):
        readers.read_files(spark, str(tmp_path), max_bytes=1).collect()
    assert readers.read_files(spark, str(tmp_path)).count() == 2
    (tmp_path / "log").write_text("\n".join(f"[step {i}]" if i % 2 else "x" for i in range(100)))
    assert [r.value for r in readers.log_tail(spark, str(tmp_path / "log"), 2).collect()] == ["[step 97]", "[step 99]"]
    writers.write_envelopes(spark.createDataFrame([(1, None)], "b int, a string"), str(tmp_path / "env"), "c", "1", sort_keys=True)
    assert spark.read.text(str(tmp_path / "env")).first().value == '{"component":"c","data":{"a":null,"b":1},"error":null,"status":"success","version":"1"}'


ARTICLE = "issue long, journal_code string, prefix string, id string, filename string, kind string, lo long, hi long, surname string, source string, path string, bytes long, sha string"


def test_export(spark, tmp_path):
    """Copies with manifest, checksums and a note; all or nothing by issue; refused if it is there."""
    import hashlib
    import zipfile

    rows = []
    for issue in (1, 2):
        for n in range(3):
            raw = f"{issue} {n}".encode() * 1000
            (tmp_path / f"{issue}_{n}").write_bytes(raw)
            kind = "research" if n else "info"
            rows.append((issue, "mg", f"Mg_202{issue}-02", f"a0{n}", f"f{n}.pdf", kind, n + 1, n + 1, "Orlov" if n else None, "en_authors" if n else None, f"{tmp_path}/{issue}_{n}", len(raw), hashlib.sha256(raw).hexdigest()))
    df = spark.createDataFrame(rows, ARTICLE)
    done = writers.write_export(df, str(tmp_path / "out"), "e1", "now")
    assert done.count() == 6
    at = tmp_path / "out/mg/2021/Mg_2021-02/exports/e1"
    assert sorted(p.name for p in at.iterdir()) == ["README.md", "articles", "checksums.sha256", "manifest"]
    sums = dict(reversed(line.split("  ")) for line in (at / "checksums.sha256").read_text().splitlines())
    assert sums == {f"articles/f{n}.pdf": hashlib.sha256((at / f"articles/f{n}.pdf").read_bytes()).hexdigest() for n in range(3)}
    m = json.loads((at / "manifest/export_manifest.json").read_text())
    assert (m["total_articles"], m["year"], m["export_timestamp_utc"]) == (3, "2021", "now")
    assert [a["article_id"] for a in m["articles"]] == ["a00", "a01", "a02"]
    assert "first_author_surname" not in m["articles"][0] and m["articles"][1]["first_author_surname"] == "Orlov"
    assert list(m) == sorted(m)
    with pytest.raises(FileExistsError):
        writers.write_export(df, str(tmp_path / "out"), "e1", "now")
    bad = df.withColumn("sha", F.when(F.col("issue") == 2, "x").otherwise(F.col("sha")))
    with pytest.raises(Exception, match="other bytes"):
        writers.write_export(bad, str(tmp_path / "out2"), "e1", "now").count()
    assert not list((tmp_path / "out2").glob("mg/2022/*/exports/*"))
    writers.zip_export(str(at), str(tmp_path / "z.zip"))
    with zipfile.ZipFile(tmp_path / "z.zip") as z:
        assert z.namelist() == ["README.md", "articles/f0.pdf", "articles/f1.pdf", "articles/f2.pdf", "checksums.sha256", "manifest/export_manifest.json"]
        assert z.read("articles/f1.pdf") == b"1 1" * 1000


STAND_IN = """
class Rect:
    height = 100.0
class Page:
    rect = Rect()
    def __init__(self, text): self.text = text
    def get_text(self, kind="text"):
        if kind == "dict":
            return {"blocks": [{"type": 0, "lines": [{"spans": [{"text": t, "bbox": (0, 1, 2, 3), "size": 12.0, "font": "F"} for t in self.text.split("|")]}]}, {"type": 1, "image": b"x"}]}
        return self.text
class Doc:
    def __init__(self, pages): self.pages = pages
    def __enter__(self): return self
    def __exit__(self, *a): pass
    def __iter__(self): return iter([Page(t) for t in self.pages])
    def get_toc(self): return []
    def insert_pdf(self, doc, from_page, to_page): self.pages += doc.pages[from_page:to_page + 1]
    def set_metadata(self, m): pass
    def tobytes(self, no_new_id): return chr(12).join(self.pages).encode()
def open(stream=None, filetype=None):
    return Doc(stream.decode().split(chr(12)) if stream else [])
"""


def test_pdfs_with_a_stand_in(spark, tmp_path):
    """Pages of files go into the span scan, ranges out into files; the library itself is a stand-in."""
    (tmp_path / "fitz.py").write_text(STAND_IN)
    spark.sparkContext.addPyFile(str(tmp_path / "fitz.py"))
    (tmp_path / "pdf").mkdir()
    (tmp_path / "pdf/a.pdf").write_bytes("Исследование|сердца\fSmith J.J.\f".encode())
    pages = readers.read_pdfs(spark, str(tmp_path / "pdf"))
    assert sorted((r.page, r.page_height, r.text) for r in pages.collect()) == [(1, 100.0, "Исследование|сердца"), (2, 100.0, "Smith J.J."), (3, 100.0, "")]
    s = blocks.exploded_spans(pages.withColumn("issue", F.lit(1)))
    assert sorted((r.page, r.text, r.lang, r.y1, r.font_size) for r in s.collect()) == [(1, "Исследование", "ru", 3.0, 12.0), (1, "сердца", "ru", 3.0, 12.0), (2, "Smith J.J.", "en", 3.0, 12.0)]
    raw = (tmp_path / "pdf/a.pdf").read_bytes()
    df = spark.createDataFrame([(1, "a01", 1, 2, raw), (1, "a02", 2, 3, raw)], "issue long, id string, lo long, hi long, content binary")
    (tmp_path / "split").mkdir()
    got = sorted((r.id, r.page_count, r.bytes) for r in writers.split_pdfs(df, str(tmp_path / "split")).collect())
    assert got == [("a01", 2, len(raw) - 1), ("a02", 2, 11)]
    assert (tmp_path / "split/1_a02.pdf").read_bytes() == b"Smith J.J.\f"


def test_runs_and_inbox(spark, tmp_path):
    df = spark.createDataFrame([("1", "done", "a", None), ("2", "running", "b", None)], "run_id string, status string, created_at string, error_msg string")
    df = runs.new_run(df, {"run_id": "3", "created_at": "c", "error_msg": None})
    assert [r.run_id for r in runs.recent(df, 2).collect()] == ["3", "2"]
    assert runs.active(df).first().run_id == "2"
    assert runs.active(runs.orphans_failed(df, "lost", "now")).count() == 0
    assert runs.run_of(runs.updated(df, "2", status="done"), "2").first().status == "done"
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text('{"issue": 1}\n')
    inbox.follow_inbox(spark, str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "c"), "issue long").awaitTermination()
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1


@pytest.fixture(scope="session")
def duck():
    c = duckdb.connect()
    for t in os.listdir(SMALL):
        p = f"{SMALL}/{t}"
        c.sql(f"create view {t[:-8]} as select * from read_parquet('{p + '/*' if os.path.isdir(p) else p}')")
    return c


def rows(df):
    """Rows as texts, columns by name; whole numbers that nulls made floats count as whole."""
    df = df[sorted(df.columns)]
    text = lambda x: "~" if pd.isna(x) else str(int(x)) if isinstance(x, float) and x == int(x) else str(x)
    return sorted(tuple(map(text, r)) for r in df.astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    got, want = catalog.QUERIES[name](spark, SMALL).toPandas(), duck.sql(catalog.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
