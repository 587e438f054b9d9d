"""Sources behind HTTP against a server of the test's own, subjects in archives, sinks and corpus operators."""

import json
import threading
import zipfile
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlsplit

import pytest
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import corpus
from millrace.sources import files, remote, sinks

DATASETS = [{"id": f"d{k}", "name": f"Name {9 - k}", "title": f"Реєстр {k}", "resources": [{"id": "r", "url": f"https://x/{k}.csv", "format": "CSV", "name": "Файл", "size": "5"}, {"url": "ftp://x"}]} for k in range(5)]


class Handler(BaseHTTPRequestHandler):
    asked: dict[str, int] = {}

    def do_GET(self):
        path, query = urlsplit(self.path).path, parse_qs(urlsplit(self.path).query)
        self.asked[path] = self.asked.get(path, 0) + 1
        if path == "/search":
            found = DATASETS if query["q"] == ["all"] else DATASETS[:1]
            start, rows = int(query["start"][0]), int(query["rows"][0])
            return self.answer(200, json.dumps({"success": True, "result": {"count": len(found), "results": found[start : start + rows]}}).encode())
        if path == "/busy" and self.asked[path] < 3:
            return self.answer(503, b"", {"Retry-After": "0"})
        return self.answer(404, b"") if path == "/gone" else self.answer(200, path.encode(), {"ETag": '"v1"'})

    do_HEAD = do_GET

    def answer(self, status, body, headers=None):
        self.send_response(status)
        for k, v in {**(headers or {}), "Content-Length": str(len(body))}.items():
            self.send_header(k, v)
        self.end_headers()
        if self.command == "GET":
            self.wfile.write(body)

    def log_message(self, *_):
        pass


@pytest.fixture(scope="module")
def server():
    made = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=made.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{made.server_port}"
    made.shutdown()


def test_catalog(spark, server):
    got = remote.catalog(spark, f"{server}/search", ["all", "one"], rows=2).collect()
    assert [r.id for r in got] == ["d4", "d3", "d2", "d1", "d0"] and got[0].resources[0].size == 5 and got[0].resources[1].format is None
    assert remote.catalog(spark, f"{server}/search", ["all"], rows=2, limit=3).count() == 3
    assert tuple(remote.download_url(remote.catalog(spark, f"{server}/search", ["all"]), "реєстр 3", "файл").first()) == ("d3", "https://x/3.csv")


def test_fetched_and_probed(spark, server):
    rows = spark.createDataFrame([(f"{server}/a",), (f"{server}/a",), (f"{server}/busy",), (f"{server}/gone",), ("http://127.0.0.1:9/x",), ("file:///etc/passwd",), (None,)], "url string")
    got = {r.url.removeprefix(server): r for r in remote.fetched(rows, tries=3).collect()}
    assert len(got) == 5 and bytes(got["/a"].content) == b"/a" and got["/a"].tag == '"v1"' and got["/busy"].sha256 and got["/gone"].status == 404
    assert got["http://127.0.0.1:9/x"].error == "connection" and got["file:///etc/passwd"].error == "address"
    assert {r.host: r.reachable for r in remote.probed(rows.where("url like 'http%'").limit(1)).collect()} == {"127.0.0.1": True}
    assert remote.change_tag(f"{server}/a") == '"v1"'
    assert [remote.wait_before(k, w) for k, w in ((0, None), (3, None), (9, None), (1, "7"), (1, "-3"), (2, "soon"))] == [1.0, 8.0, 60.0, 7.0, 0.0, 4.0]


def test_subjects_and_archives_through_spark(spark, tmp_path):
    body = "<D><X:SUBJECT xmlns:X='u'><EDRPOU>12345678</EDRPOU><NAME> Н </NAME><FOUNDERS><FOUNDER>а</FOUNDER><FOUNDER/></FOUNDERS><SIGNERS><SIGNER>б</SIGNER></SIGNERS></X:SUBJECT><SUBJECT><NAME>М</NAME></SUBJECT></D>"
    with zipfile.ZipFile(tmp_path / "u.zip", "w") as z:
        z.writestr("u.xml", body)
    rows = files.archives(spark, str(tmp_path / "u.zip"), kind="subject", verify="true").collect()
    assert [(r.edrpou, r.name, r.founders, r.signers) for r in rows] == [("12345678", "Н", ["а"], ["б"]), ("", "М", [], [])]
    through = files.archives_in(spark.read.format("binaryFile").load(str(tmp_path / "u.zip")), "subject").collect()
    assert [(r.at, r.edrpou, r.founders) for r in through] == [(r.at, r.edrpou, r.founders) for r in rows]
    broken = (tmp_path / "u.zip").read_bytes().replace(b"12345678", b"12345679")
    (tmp_path / "v.zip").write_bytes(broken)
    with pytest.raises(Exception, match="checksum|CRC"):
        files.archives(spark, str(tmp_path / "v.zip"), kind="subject", verify="true").collect()


def test_provenance_and_documents(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"a": 1}\n{"a": 2, "b": "x"}\n')
    assert files.jsonl_to_parquet(spark, str(tmp_path / "a.jsonl"), str(tmp_path / "p")) == 2
    sources = spark.createDataFrame([("u1", "a"), ("u2", "b"), ("u3", "b"), ("u4", "c")], "url string, target string")
    held = spark.createDataFrame([("a", "1", 5), ("b", "2", 6)], "path string, sha256 string, bytes long")
    assert [(r.path, r.issue) for r in files.provenance(sources, held).collect()] == [("a", None), ("b", "duplicate provenance input path"), ("c", "provenance input is missing")]
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "graph.json").write_text('{"schema_version": 1, "signal": "graph", "git_commit": "c", "state": "green"}')
    (tmp_path / "s" / "bad.json").write_text("{")
    assert {r.file: (r.valid, r.source_commit) for r in files.signals(spark, str(tmp_path / "s")).collect()} == {"graph.json": (True, "c"), "bad.json": (False, None)}
    assert "pyspark" in {r.name.lower() for r in files.packages(spark).collect()}
    with pytest.raises(ValueError, match="more than 3"):
        sinks.write_document(spark.range(4), str(tmp_path / "d.json"), most=3)
    sinks.write_document(spark.range(3), str(tmp_path / "d.json"), most=3)
    assert len(json.loads((tmp_path / "d.json").read_text())) == 3


def test_document_tables():
    import io

    box, word = io.BytesIO(), "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
    cell = lambda t: f"<w:tc><w:p><w:r><w:t>{t}</w:t></w:r></w:p></w:tc>"
    with zipfile.ZipFile(box, "w") as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="{word}"><w:body><w:p><w:r><w:t>до</w:t></w:r></w:p><w:tbl><w:tr>{cell("а")}{cell("б")}</w:tr><w:tr>{cell("в")}{cell("")}</w:tr></w:tbl></w:body></w:document>')
    assert files.document_text("a.docx", box.getvalue()) == "до\nа | б\nв |"


def test_addresses_and_file_names(spark):
    rows = spark.createDataFrame([("https://x/docs/artf",), ("https://x/a.RTF?y=1",), ("https://x/p-html",), (None,)], "u string")
    assert [r.ok for r in rows.select(T.has_extension(F.col("u"), [".rtf", ".html"]).alias("ok")).collect()] == [False, True, False, False]
    names = spark.createDataFrame([("дуже-довга-назва-" * 30 + ".xlsx",), ("a b/c?.csv",), ("...",), ("короткий.csv",)], "n string")
    got = [r.n for r in names.select(T.safe_file_name(F.col("n")).alias("n")).collect()]
    assert got[0].endswith(".xlsx") and 170 < len(got[0].encode()) <= 180 and got[1:] == ["a_b_c_.csv", "resource", "короткий.csv"]


def test_corpus_build(spark):
    line = lambda k: f"Рядок корпусу номер {k} достатньої довжини"
    first = spark.createDataFrame([(k, line(k % 5)) for k in range(10)] + [(10, None), (11, "")], "seq long, line string")
    second = spark.createDataFrame([(1, line(0)), (2, "коротко"), (3, line(77))], "seq long, line string")
    got, counts = corpus.build({"a": (first, 7), "b": (second, None)}, target=3)
    assert {tuple(r) for r in counts.collect()} == {("a", 7, 7), ("b", 3, 2), ("", 6, 3)}
    assert [r.line for r in got.orderBy("line").collect()] == sorted({line(k) for k in (0, 1, 2, 3, 4, 77)})[::2]
    held, rest = corpus.split_validation(spark.range(200), "id", least=5, part=20)
    assert sorted(r.id for r in held.collect()) == list(range(10)) and rest.count() == 190
    words = {r.word: r.n for r in corpus.word_counts(spark.createDataFrame([("а б а",), (" ",), (None,)], "line string")).collect()}
    assert words == {"а": 2, "б": 1}
    mixed = corpus.shuffled(spark.range(50), "id", 3).orderBy("shuffled").collect()
    assert [r.id for r in mixed] != list(range(50)) and [r.id for r in mixed] == [r.id for r in corpus.shuffled(spark.range(50).repartition(7), "id", 3).orderBy("shuffled").collect()]
    losses = spark.createDataFrame([("a", k, float(k)) for k in range(40)] + [("b", 1, 2.0), ("b", 2, None)], "f string, ordinal long, v double")
    assert {r.f: r.n for r in corpus.sampled_mean(losses, "v", ["f"]).collect()} == {"a": 16, "b": 1}
