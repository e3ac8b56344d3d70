"""Sinks: envelopes, exports with copies and checksums, the split of PDFs."""

from __future__ import annotations

import zipfile
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType


def sorted_keys(value: Column, kind: DataType) -> Column:
    """A value whose objects, at any depth, have their keys in order."""
    if isinstance(kind, StructType):
        fields = sorted(kind.fields, key=lambda f: f.name)
        return F.when(value.isNotNull(), F.struct(*(sorted_keys(value[f.name], f.dataType).alias(f.name) for f in fields)))
    if isinstance(kind, ArrayType) and isinstance(kind.elementType, (StructType, ArrayType)):
        return F.transform(value, lambda x: sorted_keys(x, kind.elementType))
    return value


def envelopes(df: DataFrame, component: str, version: str, sort_keys: bool = False) -> DataFrame:
    """K1: value: one success envelope in JSON for each row; with sort_keys as the last two stages write it. Nulls are written."""
    data = F.struct(*df.columns)
    parts = {"status": F.lit("success"), "component": F.lit(component), "version": F.lit(version), "data": sorted_keys(data, df.schema) if sort_keys else data, "error": F.lit(None).cast("string")}
    names = sorted(parts) if sort_keys else list(parts)
    return df.select(F.to_json(F.struct(*(parts[n].alias(n) for n in names)), {"ignoreNullFields": "false"}).alias("value"))


def error_envelopes(violations: DataFrame, component: str, version: str, code: int) -> DataFrame:
    """K1: value: one error envelope for each violation (rule, further columns), which become its details."""
    details = F.to_json(F.struct(*(c for c in violations.columns if c != "rule")))
    error = F.struct(F.lit(code).alias("exit_code"), F.col("rule").alias("code"), F.concat(F.col("rule"), F.lit(": "), details).alias("message"), F.struct(*(c for c in violations.columns if c != "rule")).alias("details"))
    whole = F.struct(F.lit("error").alias("status"), F.lit(component).alias("component"), F.lit(version).alias("version"), F.lit(None).cast("string").alias("data"), error.alias("error"))
    return violations.select(F.to_json(whole, {"ignoreNullFields": "false"}).alias("value"))


def write_envelopes(df: DataFrame, path: str, component: str, version: str, sort_keys: bool = False) -> None:
    envelopes(df, component, version, sort_keys).write.mode("errorifexists").text(path)


def manifests(articles: DataFrame, clock: str) -> DataFrame:
    """One manifest for each issue: prefix, count and articles by their id as text (O3); the clock is handed in."""
    entry = F.struct(F.col("id").alias("article_id"), "nth", "filename", "kind", "lo", "hi", "surname")
    listed = F.array_sort(F.collect_list(entry))
    out = articles.groupBy("issue", "prefix").agg(F.count("*").alias("total_articles"), listed.alias("articles"))
    return out.withColumn("year", F.regexp_extract("prefix", r"_(\d{4})-", 1)).withColumn("exported_at", F.lit(clock))


EXPORTED = "issue string, export_path string, article_id string, filename string, bytes long, sha256 string"


def write_export(articles: DataFrame, root: str, export_id: str, clock: str) -> DataFrame:
    """K3, K4: copy each issue's split files to root/code/year/prefix/exports/export_id, with manifest, checksum list and a note.

    articles: issue, journal_code, prefix, id, filename, kind, lo, hi, surname, source, path, bytes, sha; root and path
    can be in any store that pyarrow.fs knows. An issue is one task's work: it is written beside its place and moved there
    when all copies have their size and hash, so no half export can be seen; a task that runs again begins anew. An export
    that is there already is an error, before anything is written. Gives the exported files, which root/_exported lists too.
    """
    from pyarrow import fs as store

    year = F.regexp_extract("prefix", r"_(\d{4})-", 1)
    rows = articles.select(F.col("issue").cast("string").alias("issue"), "journal_code", "prefix", "id", "filename", "kind", "lo", "hi", "surname", "source", "path", "bytes", "sha", F.concat_ws("/", F.lit(root.rstrip("/")), "journal_code", year, "prefix", F.lit("exports"), F.lit(export_id)).alias("place"), year.alias("year"))

    def present(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            at = [store.FileSystem.from_uri(x if "://" in x else f"file://{x}") for x in part["place"]]
            yield part[[fs.get_file_info(x).type != store.FileType.NotFound for fs, x in at]]

    if there := rows.select("place").distinct().mapInPandas(present, "place string").limit(1).collect():
        raise FileExistsError(f"export already exists: {there[0].place}")

    def put(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        import hashlib
        import json

        def opened(path: str) -> tuple:
            return store.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://") if path.startswith("file:") else f"file://{path}")

        part = part.sort_values("id")
        fs, place = opened(part["place"].iloc[0])
        new = f"{place}.tmp"
        if fs.get_file_info(new).type != store.FileType.NotFound:
            fs.delete_dir(new)
        for d in ("articles", "manifest"):
            fs.create_dir(f"{new}/{d}", recursive=True)
        listed, sums = [], []
        for r in part.itertuples():
            src, at = opened(r.path)
            target = f"{new}/articles/{r.filename}"
            with src.open_input_stream(at) as a, fs.open_output_stream(target) as b:
                while chunk := a.read(1 << 20):
                    b.write(chunk)
            digest, size = hashlib.sha256(), 0
            with fs.open_input_stream(target) as f:
                while chunk := f.read(1 << 20):
                    digest.update(chunk)
                    size += len(chunk)
            if size != r.bytes or digest.hexdigest() != r.sha:
                fs.delete_dir(new)
                raise ValueError(f"{r.id}: copy of {r.path} has other bytes")
            entry = {"article_id": r.id, "filename": r.filename, "expected_filename": r.filename, "material_kind": r.kind, "export_path": f"{place}/articles/{r.filename}", "bytes": size, "sha256": r.sha, "from_page": int(r.lo), "to_page": int(r.hi)}
            if r.kind == "research":
                entry |= {"first_author_surname": r.surname, "first_author_surname_source": r.source}
            listed.append(entry)
            sums.append(f"{r.sha}  articles/{r.filename}")
        one = part.iloc[0]
        head = {"export_id": export_id, "journal_code": one.journal_code, "issue_prefix": one.prefix, "year": one.year, "total_articles": len(listed), "articles": listed, "export_timestamp_utc": clock}
        note = f"# Export {export_id}\n\nIssue {one.prefix}: {len(listed)} articles in `articles/`, listed in `manifest/export_manifest.json`.\nTo check the files: `sha256sum -c checksums.sha256` in this folder.\n"
        texts = {"manifest/export_manifest.json": json.dumps(head, ensure_ascii=False, indent=2, sort_keys=True) + "\n", "checksums.sha256": "\n".join(sums) + "\n", "README.md": note}
        for name, text in texts.items():
            with fs.open_output_stream(f"{new}/{name}") as f:
                f.write(text.encode())
        if fs.get_file_info(place).type != store.FileType.NotFound:
            fs.delete_dir(place)  # an earlier try of this task
        fs.move(new, place)
        return pd.DataFrame({"issue": key[0], "export_path": place, "article_id": [e["article_id"] for e in listed], "filename": [e["filename"] for e in listed], "bytes": [e["bytes"] for e in listed], "sha256": [e["sha256"] for e in listed]})

    # The list is written once and read back: reading it must not copy again.
    done = f"{root.rstrip('/')}/_exported/{export_id}"
    rows.groupBy("issue").applyInPandas(put, EXPORTED).write.mode("errorifexists").parquet(done)
    return articles.sparkSession.read.parquet(done)


def zip_export(folder: str, target: str) -> None:
    """K5: a driver-side helper; files in sorted order."""
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(Path(folder).rglob("*")):
            if f.is_file():
                z.write(f, f.relative_to(folder))


def split_pdfs(ranges: DataFrame, out_dir: str) -> DataFrame:
    """K2: ranges (issue, id, lo, hi, content of the issue's PDF) -> one file each in a shared folder. Needs PyMuPDF; tested with a stand-in."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        try:
            import fitz
        except ImportError as e:
            raise RuntimeError("splitting PDFs needs PyMuPDF") from e
        import hashlib
        import os

        for batch in batches:
            rows = []
            for r in batch.itertuples():
                with fitz.open(stream=r.content, filetype="pdf") as doc, fitz.open() as part:
                    part.insert_pdf(doc, from_page=r.lo - 1, to_page=r.hi - 1)
                    part.set_metadata({})
                    raw = part.tobytes(no_new_id=True)
                path = f"{out_dir}/{r.issue}_{r.id}.pdf"
                with open(f"{path}.tmp", "wb") as f:
                    f.write(raw)
                os.replace(f"{path}.tmp", path)
                rows.append((r.issue, r.id, path, r.hi - r.lo + 1, len(raw), hashlib.sha256(raw).hexdigest()))
            yield pd.DataFrame(rows, columns=["issue", "id", "path", "page_count", "bytes", "sha"])

    return ranges.select("issue", "id", "lo", "hi", "content").mapInPandas(cut, "issue long, id string, path string, page_count long, bytes long, sha string")
