"""File sources as documents (id, content, meta): text, CSV, HTML, Markdown, office files, JSON, images, archives."""

from __future__ import annotations

import io
import re
import tarfile
import zipfile
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import routers, text

DOCUMENT = "id string, content string, meta map<string,string>"


def files(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """path, modificationTime, length, content of every file; content is read only where it is used."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    return (reader.option("pathGlobFilter", pattern) if pattern else reader).load(path)


def documents(sources: DataFrame, content: Column, meta: dict[str, Column] | None = None, full_path: bool = False) -> DataFrame:
    """Documents of file rows: the path (or only the file's name) and ``meta`` in the meta map, an id over content and meta."""
    name = F.col("path") if full_path else F.element_at(F.split("path", "/"), -1)
    pairs = {"file_path": name} | (meta or {})
    made = sources.select(content.alias("content"), F.create_map(*[x for k, v in pairs.items() for x in (F.lit(k), v.cast("string"))]).alias("meta"))
    return made.select(text.document_id(F.col("content"), F.to_json("meta")).alias("id"), "content", "meta")


def text_files(spark: SparkSession, path: str, pattern: str = "*.txt", encoding: str = "UTF-8", **options) -> DataFrame:
    return documents(files(spark, path, pattern), F.decode("content", encoding), **options)


def csv_files(spark: SparkSession, path: str, pattern: str = "*.csv", encoding: str = "UTF-8", **options) -> DataFrame:
    """Whole CSV texts; for parsed rows use ``spark.read.csv``."""
    return documents(files(spark, path, pattern), F.decode("content", encoding), **options)


def html_files(spark: SparkSession, path: str, pattern: str = "*.html", **options) -> DataFrame:
    return documents(files(spark, path, pattern), text.html_text(F.decode("content", "UTF-8")), **options)


def markdown_files(spark: SparkSession, path: str, pattern: str = "*.md", **options) -> DataFrame:
    return documents(files(spark, path, pattern), text.markdown_text(F.decode("content", "UTF-8")), **options)


def image_files(spark: SparkSession, path: str, pattern: str = "*.png", **options) -> DataFrame:
    """Documents without content; the bytes are not read."""
    return documents(files(spark, path, pattern).drop("content"), F.lit(None).cast("string"), **options)


def _xml(data: bytes) -> ElementTree.Element:
    if b"<!DOCTYPE" in data[:2000]:
        raise ValueError("document types are not allowed in office files")
    return ElementTree.fromstring(data)


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def docx_text(data: bytes) -> str:
    """Paragraphs of a Word file, one a line; table cells by tabs."""
    body = _xml(zipfile.ZipFile(io.BytesIO(data)).read("word/document.xml"))
    lines = []
    for p in body.iter():
        if _local(p.tag) == "p":
            lines.append("".join("\t" if _local(x.tag) == "tab" else "\n" if _local(x.tag) == "br" else x.text or "" for x in p.iter() if _local(x.tag) in ("t", "tab", "br")))
    return "\n".join(lines)


def pptx_text(data: bytes) -> str:
    """Texts of each slide's shapes, slides apart by form feeds."""
    book = zipfile.ZipFile(io.BytesIO(data))
    slides = sorted((n for n in book.namelist() if re.fullmatch(r"ppt/slides/slide\d+\.xml", n)), key=lambda n: int(re.search(r"\d+", n).group()))
    out = []
    for name in slides:
        shapes = [s for s in _xml(book.read(name)).iter() if _local(s.tag) == "txBody"]
        out.append("\n".join("\n".join("".join(t.text or "" for t in p.iter() if _local(t.tag) == "t") for p in s if _local(p.tag) == "p") for s in shapes))
    return "\f".join(out)


def xlsx_text(data: bytes) -> str:
    """Sheets as comma-separated lines, sheets apart by form feeds."""
    book = zipfile.ZipFile(io.BytesIO(data))
    shared = []
    if "xl/sharedStrings.xml" in book.namelist():
        shared = ["".join(t.text or "" for t in si.iter() if _local(t.tag) == "t") for si in _xml(book.read("xl/sharedStrings.xml"))]
    sheets = sorted((n for n in book.namelist() if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)), key=lambda n: int(re.search(r"\d+", n).group()))
    out = []
    for name in sheets:
        lines = []
        for row in (r for r in _xml(book.read(name)).iter() if _local(r.tag) == "row"):
            cells: dict[int, str] = {}
            for c in row:
                letters = re.match(r"[A-Z]*", c.get("r", "")).group()
                at = 0
                for letter in letters:
                    at = at * 26 + ord(letter) - 64
                value = "".join(v.text or "" for v in c.iter() if _local(v.tag) in ("v", "t"))
                cells[at or len(cells) + 1] = shared[int(value)] if c.get("t") == "s" and value else value
            line = [cells.get(i, "") for i in range(1, max(cells, default=0) + 1)]
            lines.append(",".join(f'"{x.replace(chr(34), chr(34) * 2)}"' if re.search('[",\n]', x) else x for x in line))
        out.append("\n".join(lines))
    return "\f".join(out)


OFFICE: dict[str, Callable[[bytes], str]] = {"docx": docx_text, "pptx": pptx_text, "xlsx": xlsx_text}


def office_files(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Documents of one office format; a file that can't be read has null content and its error in meta."""
    convert = OFFICE[kind]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            contents, errors = [], []
            for data in frame["content"]:
                try:
                    contents.append(convert(bytes(data)))
                    errors.append(None)
                except (zipfile.BadZipFile, KeyError, ElementTree.ParseError, ValueError) as error:
                    contents.append(None)
                    errors.append(f"{type(error).__name__}: {error}")
            yield pd.DataFrame({"path": frame["path"], "text": contents, "error": errors})

    read = files(spark, path, f"*.{kind}").select("path", "content").mapInPandas(run, "path string, text string, error string")
    return documents(read, F.col("text"), {"error": F.col("error")})


def json_records(spark: SparkSession, path: str, schema: str, records: str, content: str, meta: list[str] | None = None) -> DataFrame:
    """One document for each object of the array ``records`` of each JSON file; other keys go to meta."""
    rows = spark.read.schema(schema).json(path, multiLine=True).select(F.explode(records).alias("r"))
    pairs = [x for k in meta or [] for x in (F.lit(k), F.col(f"r.{k}").cast("string"))]
    made = rows.select(F.col(f"r.{content}").alias("content"), (F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")).alias("meta"))
    return made.select(text.document_id(F.col("content"), F.to_json("meta")).alias("id"), "content", "meta")


def any_files(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """Documents of text, CSV, HTML, Markdown, JSON and office files below ``path`` by MIME type; others have null content and meta.mime unclassified."""
    found = files(spark, path).withColumn("mime", F.coalesce(routers.mime_of_path(F.col("path")), routers.mime_of_bytes(F.col("content")), F.lit("unclassified")))
    plain = F.decode("content", encoding)
    content = F.when(F.col("mime") == "text/html", text.html_text(plain)).when(F.col("mime") == "text/markdown", text.markdown_text(plain)).when(F.col("mime").startswith("text/") | (F.col("mime") == "application/json"), plain)
    out = documents(found.where(~F.col("mime").contains("openxmlformats")), content, {"mime": F.col("mime")})
    for kind in OFFICE:
        out = out.unionByName(office_files(spark, path, kind).withColumn("meta", F.map_filter("meta", lambda k, v: v.isNotNull())))
    return out


def data_uris(df: DataFrame, column: str) -> DataFrame:
    """Adds mime and content of ``data:`` URIs."""
    pattern = r"^data:([^;,]*)(?:;[^,]*)?,(.*)$"
    body = F.regexp_extract(column, pattern, 2)
    coded = F.col(column).rlike(r"^data:[^,]*;base64,")
    return df.withColumn("mime", F.regexp_extract(column, pattern, 1)).withColumn("content", F.when(coded, F.unbase64(body)).otherwise(F.encode(F.url_decode(body), "UTF-8")))


def archive_members(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, member, content) of zip and tar files (plain, gz, bz2, xz)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for file, data in zip(frame["path"], frame["content"], strict=True):
                rows = []
                if zipfile.is_zipfile(io.BytesIO(data)):
                    with zipfile.ZipFile(io.BytesIO(data)) as book:
                        rows = [(file, n, book.read(n)) for n in book.namelist() if not n.endswith("/")]
                else:
                    with tarfile.open(fileobj=io.BytesIO(data)) as book:
                        rows = [(file, m.name, book.extractfile(m).read()) for m in book if m.isfile()]
                yield pd.DataFrame(rows, columns=["path", "member", "content"])

    return files(spark, path, pattern).select("path", "content").mapInPandas(run, "path string, member string, content binary")
