"""Readers of record files as they come: delimited, JSON, XML, spreadsheets, archives, whole folders, office documents."""

from __future__ import annotations

import csv
import html
import io
import json
import re
import zipfile
from collections.abc import Iterator, Sequence
from typing import Any
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as st

from millrace.functions import text as T
from millrace.session import ship
from millrace.sources.archives import ArchiveReader, Archives, schema_of

STRING_MAP = st.MapType(st.StringType(), st.StringType())
# File-name parts of code dictionaries, which are no records.
DICTIONARY_MARKS = ("court", "categor", "judgment")


def delimited(spark: SparkSession, path: str, delimiter: str = ";", encoding: str = "windows-1251") -> DataFrame:
    """All-string rows of a delimited file, nulls as ''. Other charsets than Spark's own need spark.sql.legacy.javaCharsets."""
    rows = spark.read.options(sep=delimiter, header=True, encoding=encoding, inferSchema=False, multiLine=False).csv(path)
    return rows.select(*[F.coalesce(F.trim(F.col(f"`{c}`")), F.lit("")).alias(c) for c in rows.columns])


def json_register(spark: SparkSession, path: str) -> DataFrame:
    """(row map) of a JSON array, or of the array under ``data``; values that are no objects are skipped, nested ones stay JSON."""
    files = spark.read.text(path, wholetext=True).select(F.trim("value").alias("value"))
    body = F.when(F.startswith("value", F.lit("[")), F.col("value")).otherwise(F.get_json_object("value", "$.data"))
    items = F.from_json(body, "array<string>")
    row = F.from_json(F.col("item"), STRING_MAP)
    return files.select(F.explode(items).alias("item")).where(F.startswith(F.trim("item"), F.lit("{"))).select(row.alias("row")).where("row is not null")


def xml_records(spark: SparkSession, path: str, tag: str, schema: str | st.StructType | None = None) -> DataFrame:
    """Rows of an XML file by record tag, upper-case columns, all strings unless a schema is given."""
    reader = spark.read.option("rowTag", tag).option("inferSchema", False)
    rows = (reader.schema(schema) if schema else reader).xml(path)
    return rows.select(*[F.col(f"`{c}`").alias(c.upper()) for c in rows.columns])


def archives(spark: SparkSession, path: str, kind: str = "csv", **options: str) -> DataFrame:
    """(archive, member, at, row map) of files inside archives, or of spreadsheets; kind ``subject``: companies, see sources.archives.

    Paths with a scheme other than file: are read through Spark's own file systems, an archive (2 GB at most) a task.
    """
    ship(spark)
    if not re.match(r"(?!file:)\w[\w+.-]+://", path):
        spark.dataSource.register(Archives)
        return spark.read.format("archives").options(path=path.removeprefix("file://"), kind=kind, **options).load()
    return archives_in(spark.read.format("binaryFile").load(path), kind, **options)


def archives_in(files: DataFrame, kind: str = "csv", **options: str) -> DataFrame:
    """As ``archives``, of rows (path, content)."""
    reader = ArchiveReader({"kind": kind, **options})

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [part.split()[0] for part in schema_of(kind).split(", ")]
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    rows = (row for member in ([""] if reader.kind == "xlsx" else reader.members(archive)) for row in reader.rows(archive, path, member))
                    while some := [row for _, row in zip(range(10_000), rows, strict=False)]:
                        yield pd.DataFrame(some, columns=names)

    return files.select("path", "content").mapInPandas(parse, schema_of(kind))


def jsonl_to_parquet(spark: SparkSession, source: str, target: str, mode: str = "errorifexists") -> int:
    """JSON lines as zstd Parquet; the number of rows. Broken lines are an error, as a silent gap would be."""
    rows = spark.read.option("mode", "FAILFAST").json(source)
    rows.write.mode(mode).option("compression", "zstd").parquet(target)
    return spark.read.schema(rows.schema).parquet(target).count()


def provenance(sources: DataFrame, inventory: DataFrame) -> DataFrame:
    """(path, source_url, bytes, sha256, issue) of the inputs a graph is built from, sorted by path.

    ``sources`` has url and target, ``inventory`` path, sha256 and bytes. A path named twice and one that is missing have an issue.
    """
    named = sources.groupBy(F.col("target").alias("path")).agg(F.min("url").alias("source_url"), F.count("*").alias("n"))
    found = named.join(inventory.select("path", "bytes", "sha256"), "path", "left")
    issue = F.when(F.col("n") > 1, "duplicate provenance input path").when(F.col("sha256").isNull(), "provenance input is missing")
    return found.select("path", "source_url", "bytes", "sha256", issue.alias("issue")).orderBy("path")


def packages(spark: SparkSession) -> DataFrame:
    """(name, version) of the Python packages of this machine, by lower-case name: the parts list of a release."""
    from importlib.metadata import distributions

    rows = sorted({(d.metadata["Name"], d.version) for d in distributions() if d.metadata["Name"]}, key=lambda r: r[0].lower())
    return spark.createDataFrame(rows, "name string, version string")


def signals(spark: SparkSession, path: str) -> DataFrame:
    """(file, valid, schema_version, signal, source_commit, state, detail, generated_at) of status documents, one a file.

    The commit may stand under source_commit or git_commit; a document that is no JSON object has ``valid`` false.
    """
    fields = "schema_version long, signal string, source_commit string, git_commit string, state string, detail string, generated_at_utc string"
    rows = spark.read.text(path, wholetext=True).select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file"), F.trim("value").alias("value"))
    rows = rows.withColumn("s", F.from_json("value", fields)).withColumn("valid", F.startswith("value", F.lit("{")) & F.try_parse_json("value").isNotNull())
    return rows.select("file", "valid", "s.schema_version", "s.signal", F.coalesce("s.source_commit", "s.git_commit").alias("source_commit"), "s.state", F.substring(F.coalesce("s.detail", F.lit("")), 1, 500).alias("detail"), F.col("s.generated_at_utc").alias("generated_at"))


def checkpoints(spark: SparkSession, path: str) -> DataFrame:
    """(file, valid, workflow, source_commit, checkpoint, checkpoint_id, state, updated_at) of recovery documents, one a file."""
    fields = "workflow string, source_commit string, checkpoint string, checkpoint_id string, state string, updated_at string"
    rows = spark.read.text(path, wholetext=True).select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file"), F.trim("value").alias("value"))
    rows = rows.withColumn("valid", F.startswith("value", F.lit("{")) & F.try_parse_json("value").isNotNull())
    return rows.select("file", "valid", F.from_json("value", fields).alias("c")).select("file", "valid", "c.*")


def available(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """A Parquet scan of the wanted columns, null where a file set lacks one."""
    rows = spark.read.option("mergeSchema", True).parquet(path)
    return rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in columns])


def inventory(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, sha256, bytes) of a folder's files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    return files.select("path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes"))


def metric_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, ordinal, step, loss, val_loss) of JSON lines; lines that are no JSON objects are skipped."""
    lines = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.posexplode(F.split("value", "\n")).alias("ordinal", "line"))
    got = lines.withColumn("m", F.from_json("line", "step long, loss double, val_loss double"))
    return got.where(F.startswith(F.trim("line"), F.lit("{")) & (F.col("m.step").isNotNull() | F.col("m.loss").isNotNull() | F.col("m.val_loss").isNotNull())).select("file", "ordinal", "m.*")


def source_list(spark: SparkSession, path: str) -> DataFrame:
    """(line, url, target) of URL=PATH lines, the first sign parts them; blank lines and comments are skipped."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\r?\n")).alias("at", "text")).withColumn("text", F.trim("text"))
    kept = lines.where((F.col("text") != "") & ~F.startswith("text", F.lit("#")))
    parts = F.split("text", "=", 2)
    return kept.select((F.col("at") + 1).alias("line"), F.trim(parts[0]).alias("url"), F.trim(F.get(parts, F.lit(1))).alias("target"))


def sniff(heading: str) -> str:
    """The delimiter a heading line holds most of: tab, comma or semicolon, in this order; a comma if none."""
    counts = [(heading.count(d), d) for d in "\t,;"]
    most = max(n for n, _ in counts)
    return next(d for n, d in counts if n == most) if most else ","


def decode(data: bytes) -> str:
    try:
        return data.decode("utf-8-sig")
    except UnicodeDecodeError:
        return data.decode("cp1251", "replace")


def nested(element: ElementTree.Element) -> Any:  # noqa: ANN401
    """An element as text, or as children by lower-case name: repeated ones as lists, a lone wrapper is left out."""
    children = list(element)
    if not children:
        return (element.text or "").strip()
    out: dict[str, Any] = {}
    for c in children:
        name, value = c.tag.rpartition("}")[2].lower(), nested(c)
        if name in out:
            out[name] = [*out[name], value] if isinstance(out[name], list) else [out[name], value]
        else:
            out[name] = value
    return next(iter(out.values())) if len(out) == 1 and isinstance(next(iter(out.values())), dict) else out


def parse_records(path: str, data: bytes) -> Iterator[dict[str, Any]]:
    """Records of one json, csv, xml or xhtml file; broken files and dictionaries give none."""
    name, suffix = path.rpartition("/")[2].lower(), path.rpartition(".")[2].lower()
    if any(m in name for m in DICTIONARY_MARKS) and suffix == "csv":
        return
    try:
        if suffix == "json":
            value = json.loads(decode(data))
            yield from (x for x in (value if isinstance(value, list) else [value]) if isinstance(x, dict))
        elif suffix == "csv":
            text = decode(data)
            yield from ({k: v for k, v in row.items() if k} for row in csv.DictReader(io.StringIO(text), delimiter=sniff(text.partition("\n")[0])))
        elif suffix in ("xml", "xhtml"):
            root = ElementTree.fromstring(data)
            for element in list(root) or [root]:
                value = nested(element)
                yield value if isinstance(value, dict) else {element.tag.rpartition("}")[2].lower(): value}
    except (ValueError, ElementTree.ParseError, csv.Error):
        return


def tree(spark: SparkSession, path: str) -> DataFrame:
    """(file, at, record as JSON) of all record files below a folder; a task parses whole files."""
    ship(spark)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.{json,csv,xml,xhtml}").load(path).select("path", "content")

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(p, k, json.dumps(r, ensure_ascii=False)) for p, c in zip(batch["path"], batch["content"], strict=True) for k, r in enumerate(parse_records(p, c))]
            yield pd.DataFrame(rows, columns=["file", "at", "record"])

    return files.mapInPandas(parse, "file string, at long, record string")


def dictionaries(spark: SparkSession, path: str) -> DataFrame:
    """(list, seq, code, name) of the code dictionaries below a folder: the first two columns of their files."""
    ship(spark)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").load(path).select("path", "content")

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for p, c in zip(batch["path"], batch["content"], strict=True):
                kind = next((m for m in DICTIONARY_MARKS if m in p.rpartition("/")[2].lower()), None)
                if kind:
                    text = decode(c)
                    out += [(kind, k, r[0].strip(), r[1].strip()) for k, r in enumerate(csv.reader(io.StringIO(text), delimiter=sniff(text.partition("\n")[0]))) if k and len(r) > 1]
            yield pd.DataFrame(out, columns=["list", "seq", "code", "name"])

    return files.mapInPandas(parse, "list string, seq long, code string, name string")


def rtf_text(data: str) -> str:
    """The text of an RTF document: groups of tables and pictures left out, escapes decoded by its code page."""
    page = re.search(r"\\ansicpg(\d+)", data)
    encoding = f"cp{page[1]}" if page else "cp1251"
    out, stack, skip, k = [], [], False, 0
    pattern = re.compile(r"\\([a-z]+)(-?\d+)? ?|\\'([0-9a-fA-F]{2})|\\([^a-z0-9])|([{}])|[\r\n]+|(.)", re.S)
    after = 0
    while k < len(data) and (m := pattern.match(data, k)):
        k = m.end()
        word, number, code, sign, brace, char = m.groups()
        if brace == "{":
            stack.append(skip)
        elif brace == "}":
            skip = stack.pop() if stack else False
        elif sign == "*" or word in ("fonttbl", "colortbl", "stylesheet", "info", "pict", "header", "footer"):
            skip = True
        elif skip:
            continue
        elif word == "u" and number:
            out.append(chr(int(number) % 65536))
            after = 1
        elif code:
            out.append("" if after else bytes([int(code, 16)]).decode(encoding, "replace"))
            after = 0
        elif word in ("par", "line", "row"):
            out.append("\n")
        elif word in ("tab", "cell"):
            out.append("\t")
        elif sign == "~":
            out.append(" ")
        elif char:
            out.append("" if after and char == "?" else char)
            after = 0
    return "".join(out).strip()


def html_text(data: str) -> str:
    bare = re.sub(r"(?is)<(script|style)\b.*?</\1\s*>", " ", data)
    return html.unescape(re.sub(r"\s+", " ", re.sub(r"(?s)<[^>]+>", " ", bare)).strip()).strip()


def document_text(name: str, data: bytes) -> str | None:
    """Text of an rtf, html, docx or txt document by its name's extension, '' for unknown ones; None for unreadable or old Word files."""
    suffix = name.split("?")[0].rpartition(".")[2].lower()
    try:
        if suffix == "rtf":
            return rtf_text(data.decode("latin-1"))
        if suffix in ("html", "htm"):
            return html_text(decode(data))
        if suffix == "txt":
            return decode(data).strip()
        if suffix == "docx":
            root = ElementTree.fromstring(zipfile.ZipFile(io.BytesIO(data)).read("word/document.xml"))
            word = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
            paragraph = lambda p: "".join(t.text or "" for t in p.iter(f"{word}t"))
            cell = lambda c: "\n".join(paragraph(p) for p in c.iter(f"{word}p"))
            out = []
            for block in root.find(f"{word}body") if root.find(f"{word}body") is not None else root.iter(f"{word}p"):
                if block.tag == f"{word}tbl":
                    out += [" | ".join(cell(c).strip() for c in row.iter(f"{word}tc")) for row in block.iter(f"{word}tr")]
                elif block.tag == f"{word}p":
                    out.append(paragraph(block))
            return "\n".join(out).strip()
        return None if suffix == "doc" else ""
    except (ValueError, KeyError, zipfile.BadZipFile, ElementTree.ParseError):
        return None


def documents(spark: SparkSession, path: str) -> DataFrame:
    """(path, text) of document files below a folder."""
    ship(spark)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content")

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"path": batch["path"], "text": [document_text(p, c) for p, c in zip(batch["path"], batch["content"], strict=True)]})

    return files.mapInPandas(parse, "path string, text string")


def text_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of files that are text: no NUL byte and valid UTF-8."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.where((F.position(F.lit(b"\x00"), "content") == 0) & F.is_valid_utf8(F.col("content").cast("string"))).select("path", F.col("content").cast("string").alias("content"))


def flat_fields(record: DataFrame, names: Sequence[str], column: str = "record") -> DataFrame:
    """Fields of a JSON record column as strings, nested values as JSON text."""
    row = F.from_json(F.col(column), STRING_MAP)
    return record.withColumn("__row", row).select(*[c for c in record.columns if c != column], *[T.blank_to_null(F.element_at("__row", F.lit(n))).alias(n) for n in names])
