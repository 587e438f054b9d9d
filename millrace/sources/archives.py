"""A Spark data source for record files inside archives and for spreadsheets: one task a member, rows as string maps.

    spark.dataSource.register(Archives)
    spark.read.format("archives").option("path", "/data/*.zip").option("kind", "csv").load()

Options: ``path`` (glob, or several parted by commas), ``kind`` (csv, xml, xlsx, subject), ``delimiter`` (;), ``encoding`` (cp1251),
``tag`` (the end of a record element's name, RECORD), ``sheet`` (a sheet's name, else the first), ``verify`` (true: the checksums
of all members are tested first). Of csv archives the largest member counts, of xml archives the first; ``members=all`` reads
every fitting member. Undecodable bytes are replaced. ``subject`` reads xml members as company subjects with lists of founders
and signers. The paths must be mounted on all machines; ``files.archives`` reads other file systems through Spark.
"""

from __future__ import annotations

import csv
import glob
import io
import re
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from xml.etree import ElementTree

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "archive string, member string, at long, row map<string,string>"
SUBJECT_SCHEMA = "archive string, member string, at long, edrpou string, name string, stan string, opf string, statute string, founders array<string>, signers array<string>"


@dataclass
class Member(InputPartition):
    path: str
    member: str


def safe_member(name: str) -> bool:
    """Whether a member's path stays inside the archive."""
    return not (name.startswith(("/", "\\")) or re.match(r"^[A-Za-z]:", name) or ".." in re.split(r"[\\/]", name))


def xml_rows(stream: io.BufferedIOBase, tag: str) -> Iterator[dict[str, str]]:
    """Child texts of each element whose upper-case name ends in ``tag``; of repeated children the last counts."""
    parents: list[ElementTree.Element] = []
    for event, element in ElementTree.iterparse(stream, events=("start", "end")):
        if event == "start":
            parents.append(element)
            continue
        parents.pop()
        if _name(element).endswith(tag):
            yield {_name(c): (c.text or "").strip() for c in element}
            element.clear()
            if parents:
                parents[-1].remove(element)


def subject_rows(stream: io.BufferedIOBase, tag: str = "SUBJECT") -> Iterator[dict[str, str | list[str]]]:
    """EDRPOU, NAME, STAN, OPF and STATUTE of each subject, with all its founders and signers."""
    for _, element in ElementTree.iterparse(stream, events=("end",)):
        if _name(element).endswith(tag):
            texts: dict[str, list[str]] = {}
            for x in element.iter():
                if (text := (x.text or "").strip()) and x is not element:
                    texts.setdefault(_name(x), []).append(text)
            one = {k: texts.get(k, [""])[0] for k in ("EDRPOU", "NAME", "STAN", "OPF", "STATUTE")}
            yield {**one, "founders": texts.get("FOUNDER", []), "signers": texts.get("SIGNER", [])}
            element.clear()  # what it held; the emptied element itself is small


def _name(element: ElementTree.Element) -> str:
    return element.tag.rpartition("}")[2].strip().upper()


_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


def xlsx_rows(book: zipfile.ZipFile, sheet: str | None = None) -> Iterator[dict[str, str]]:
    """Rows of a sheet below its headings as trimmed strings; columns without heading are left out."""
    shared = []
    if "xl/sharedStrings.xml" in book.namelist():
        shared = ["".join(t.text or "" for t in si.iter(f"{_MAIN}t")) for si in ElementTree.fromstring(book.read("xl/sharedStrings.xml")).iter(f"{_MAIN}si")]
    sheets = [(s.get("name"), s.get(f"{_REL}id")) for s in ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{_MAIN}sheet")]
    target = next((r for n, r in sheets if n == sheet), sheets[0][1])
    links = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
    headings: list[str] | None = None
    with book.open("xl/" + links[target].removeprefix("/xl/")) as stream:
        for _, row in ElementTree.iterparse(stream):
            if row.tag != f"{_MAIN}row":
                continue
            cells: dict[int, str] = {}
            for at, c in enumerate(row.findall(f"{_MAIN}c")):
                letters = re.match("[A-Z]+", c.get("r") or "")
                place = at if letters is None else sum((ord(x) - 64) * 26**k for k, x in enumerate(reversed(letters[0]))) - 1
                value = c.findtext(f"{_MAIN}v") or ""
                if c.get("t") == "s":
                    value = shared[int(value)]
                elif c.get("t") == "inlineStr":
                    value = "".join(t.text or "" for t in c.iter(f"{_MAIN}t"))
                cells[place] = value.strip()
            row.clear()
            if headings is None:
                headings = [cells.get(k, "") for k in range(max(cells, default=-1) + 1)]
            elif any(cells.values()):
                yield {h: cells.get(k, "") for k, h in enumerate(headings) if h}


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.kind = options.get("kind", "csv").lower()
        self.paths = sorted({p for part in options.get("path", "").split(",") for p in glob.glob(part.strip())})
        self.delimiter, self.encoding = options.get("delimiter", ";"), options.get("encoding", "cp1251")
        self.tag, self.sheet, self.all = options.get("tag", "SUBJECT" if self.kind == "subject" else "RECORD").upper(), options.get("sheet"), options.get("members") == "all"
        self.verify = options.get("verify", "false").lower() == "true"

    def members(self, archive: zipfile.ZipFile) -> list[str]:
        if self.verify and (broken := archive.testzip()):
            raise zipfile.BadZipFile(f"checksum of {broken} is wrong")
        suffix = "xml" if self.kind == "subject" else self.kind
        fit = [m for m in archive.infolist() if m.filename.lower().endswith("." + suffix) and safe_member(m.filename)]
        if fit and not self.all:
            fit = [max(fit, key=lambda m: m.file_size)] if self.kind == "csv" else fit[:1]
        return [m.filename for m in fit]

    def partitions(self) -> list[Member]:
        if self.kind == "xlsx":
            return [Member(p, "") for p in self.paths]
        out = []
        for path in self.paths:
            with zipfile.ZipFile(path) as archive:
                out += [Member(path, m) for m in self.members(archive)]
        return out

    def rows(self, archive: zipfile.ZipFile, path: str, member: str) -> Iterator[tuple]:
        if self.kind == "xlsx":
            yield from ((path, self.sheet or "", k, row) for k, row in enumerate(xlsx_rows(archive, self.sheet)))
            return
        with archive.open(member) as stream:
            if self.kind == "subject":
                fields = ("EDRPOU", "NAME", "STAN", "OPF", "STATUTE", "founders", "signers")
                yield from ((path, member, k, *(row[f] for f in fields)) for k, row in enumerate(subject_rows(stream, self.tag)))
                return
            if self.kind == "xml":
                rows = xml_rows(stream, self.tag)
            else:
                text = io.TextIOWrapper(stream, encoding=self.encoding, errors="replace", newline="")
                rows = ({k: (v or "") for k, v in row.items() if k} for row in csv.DictReader(text, delimiter=self.delimiter))
            yield from ((path, member, k, row) for k, row in enumerate(rows))

    def read(self, part: Member | None) -> Iterator[tuple]:
        if part is None:
            return
        with zipfile.ZipFile(part.path) as archive:
            yield from self.rows(archive, part.path, part.member)


def schema_of(kind: str) -> str:
    return SUBJECT_SCHEMA if kind.lower() == "subject" else SCHEMA


class Archives(DataSource):
    @classmethod
    def name(cls) -> str:
        return "archives"

    def schema(self) -> str:
        return schema_of(self.options.get("kind", "csv"))

    def reader(self, schema) -> ArchiveReader:  # noqa: ANN001
        return ArchiveReader(dict(self.options))
