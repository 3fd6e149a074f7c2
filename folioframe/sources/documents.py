"""Annotation files, run logs, metrics and images: readers and writers."""

from __future__ import annotations

import html
import re
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: One annotated page.
PAGE = (
    "image string, block_boxes array<array<int>>, block_classes array<string>, block_text array<string>, reading_order array<int>, "
    "block_relations array<struct<source:int,target:int,relation:string>>, annotation_quality string, lang string"
)


def annotation_files(spark: SparkSession, path: str) -> DataFrame:
    """(file_name, payload): one row per JSON file, unreadable files included."""
    rows = spark.read.option("wholetext", True).option("pathGlobFilter", "*.json").text(path)
    return rows.select(F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("payload"))


def annotations_of(files: DataFrame) -> DataFrame:
    """``files`` (file_name, payload) with the columns of one annotated page; null columns where a part is absent or of another type."""
    return files.select("file_name", F.from_json("payload", PAGE).alias("p")).select("file_name", "p.*")


def write_annotations(annotations: DataFrame, path: str, by: str | None = "lang") -> None:
    """Annotated pages as JSON lines, one folder per value of ``by``; null parts are written as null."""
    parts = [c for c in annotations.columns if c != by]
    rows = annotations.select(F.to_json(F.struct(*parts), {"ignoreNullFields": "false"}).alias("value"), *([by] if by else []))
    writer = rows.write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).text(path)


def metrics(spark: SparkSession, path: str) -> DataFrame:
    """(stage, seconds, line) of a JSON-lines metrics file; lines that are no JSON or name no stage are skipped."""
    rows = spark.read.text(path).select(F.from_json("value", "stage string, seconds double").alias("m"), F.monotonically_increasing_id().alias("line"))
    return rows.where("m.stage is not null").select("m.stage", "m.seconds", "line")


def append_metrics(rows: DataFrame, path: str) -> None:
    """(stage, seconds) appended to a folder of JSON lines."""
    rows.select("stage", "seconds").write.mode("append").json(path)


def log_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file_name, line_no, line) of text logs. Lines of one file are numbered in their order within it."""
    rows = spark.read.option("wholetext", True).text(path).select(F.col("_metadata.file_name").alias("file_name"), "value")
    return rows.select("file_name", F.posexplode(F.split("value", "\r?\n")).alias("line_no", "line"))


def images(spark: SparkSession, path: str, pattern: str = "*.jpg") -> DataFrame:
    """(path, length, content): image files as bytes; ``content`` is only read where it is used."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path", "length", "content")


def base64_images(rows: DataFrame) -> DataFrame:
    """(path, data): images in base64 without line breaks."""
    return rows.select("path", F.translate(F.base64("content"), "\r\n", "").alias("data"))


def called(rows: DataFrame, client: Callable[[pd.DataFrame], pd.DataFrame], schema: str, batch: int = 5) -> DataFrame:
    """``rows`` sent to a service in requests of at most ``batch`` rows; ``client`` takes and returns pandas frames.

    A task that runs again sends its requests again: give rows a key and write the result once before it is used.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), batch):
                yield client(frame.iloc[at : at + batch])

    return rows.mapInPandas(run, schema)


def pdf_pages(rows: DataFrame, dpi: int = 150) -> DataFrame:
    """(path, page_no, image) of PDF files (path, content): every page as JPEG. Needs PyMuPDF on the workers."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import fitz

        for frame in frames:
            for path, content in zip(frame["path"], frame["content"]):
                with fitz.open(stream=content, filetype="pdf") as pdf:
                    for k, page in enumerate(pdf):
                        shot = page.get_pixmap(matrix=fitz.Matrix(dpi / 72, dpi / 72))
                        yield pd.DataFrame({"path": [path], "page_no": [k + 1], "image": [shot.tobytes("jpeg")]})

    return rows.select("path", "content").mapInPandas(run, "path string, page_no int, image binary")


def _count(content: bytes) -> int:
    """Pages of a PDF, by PyMuPDF where it is installed, else by the page objects that stand open in the file."""
    try:
        import fitz
    except ModuleNotFoundError:
        found = len(re.findall(rb"/Type\s*/Page(?![A-Za-z])", content or b""))
        if not (content or b"").startswith(b"%PDF") or not found:
            raise ValueError("no page objects to be seen") from None
        return found
    with fitz.open(stream=content, filetype="pdf") as pdf:
        return len(pdf)


def page_counts(rows: DataFrame, unreadable: int | None = None) -> DataFrame:
    """(path, pages) of PDF files (path, content); ``unreadable`` (null, or 0 as some callers want) for files that can't be read."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            pages = []
            for content in frame["content"]:
                try:
                    pages.append(_count(content))
                except Exception:  # a broken file is a count of its own
                    pages.append(unreadable)
            yield pd.DataFrame({"path": frame["path"], "pages": pd.array(pages, "Int32")})

    return rows.select("path", "content").mapInPandas(run, "path string, pages int")


def responses(files: DataFrame) -> DataFrame:
    """(file_name, json): readable annotation files (file_name, payload) as answers, each with its own name in ``_file``, by name."""
    keys = F.try_variant_get(F.try_parse_json("payload"), "$", "map<string,variant>")
    own = F.map_concat(F.map_filter(keys, lambda k, v: k != "_file"), F.create_map(F.lit("_file"), F.try_parse_json(F.to_json(F.array("file_name")).substr(F.lit(2), F.length(F.to_json(F.array("file_name"))) - 2))))
    return files.where(keys.isNotNull()).select("file_name", F.to_json(own).alias("json")).orderBy("file_name")


def usage_state(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A usage log of JSON lines; an absent or unreadable one is an empty table, unreadable lines are left out."""
    try:
        return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def zip_folder(folder: str, target: str) -> Path:
    """Everything below a local folder as one ZIP, without the ZIP itself."""
    root, out = Path(folder), Path(target)
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted(root.rglob("*")):
            if file.is_file() and file.resolve() != out.resolve():
                archive.write(file, file.relative_to(root))
    return out


def write_zip(annotations: DataFrame, path: str, folder: str, name: str = "image") -> Path:
    """A ZIP of pages, each as ``folder/stem.json``, written from an iterator over a result meant for one archive."""
    target = Path(path)
    rows = annotations.select(F.col(name).alias("name_"), F.to_json(F.struct(*annotations.columns), {"ignoreNullFields": "false"}).alias("json"))
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for k, row in enumerate(rows.toLocalIterator()):
            stem = Path(row["name_"]).stem if row["name_"] else f"page_{k:06d}"
            archive.writestr(f"{folder or 'unknown'}/{stem}.json", row["json"])
    return target


def write_html(summary: DataFrame, pages: DataFrame, path: str, title: str = "Annotation report") -> Path:
    """A report of one summary row and a table of pages; ``pages`` should be a sample or a top list."""
    head = summary.first().asDict()
    cards = "".join(f"<dt>{html.escape(k)}</dt><dd>{html.escape(str(v))}</dd>" for k, v in head.items())
    names = pages.columns
    with open(path, "w", encoding="utf-8") as out:
        out.write(f"<!doctype html><meta charset=utf-8><title>{html.escape(title)}</title><h1>{html.escape(title)}</h1><dl>{cards}</dl><table><tr>")
        out.write("".join(f"<th>{html.escape(n)}</th>" for n in names) + "</tr>")
        for row in pages.toLocalIterator():
            out.write("<tr>" + "".join(f"<td>{html.escape(str(row[n]))}</td>" for n in names) + "</tr>")
        out.write("</table>")
    return Path(path)
