import io
import json
import zipfile

from pyspark.sql import functions as F

from millrace.sources import archives, files, sinks
from millrace.streaming import incremental


def test_delimited_cp1251(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("НАЗВА;КОД\nТОВ «Ї»; 12\n;\n".encode("cp1251"))
    rows = files.delimited(spark, str(tmp_path / "a.csv")).collect()
    assert [tuple(r) for r in rows] == [("ТОВ «Ї»", "12"), ("", "")]


def test_json_register(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"a": 1, "b": {"c": 2}}, 5, "x", {"a": null}]')
    (tmp_path / "b.json").write_text('{"data": [{"a": "z"}], "n": 1}')
    (tmp_path / "c.json").write_text('{"rows": []}')
    got = {f: [r.row for r in files.json_register(spark, str(tmp_path / f)).collect()] for f in ("a.json", "b.json", "c.json")}
    assert got == {"a.json": [{"a": "1", "b": '{"c":2}'}, {"a": None}], "b.json": [{"a": "z"}], "c.json": []}


def test_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("small.csv", "A;B\n1;2\n")
        z.writestr("big.csv", "A;B\n" + "".join(f"{k};є{k}\n" for k in range(50)).encode("cp1251").decode("cp1251"))
        z.writestr("../evil.csv", "A;B\n" + "9;9\n" * 500)
        z.writestr("r.xml", "<R><x:RECORD xmlns:x='u'><name>А</name><name>Б</name><Code/></x:RECORD><RECORD><name>В</name></RECORD></R>")
    got = files.archives(spark, str(tmp_path / "*.zip"), encoding="utf-8").collect()
    assert len(got) == 50 and got[7].row == {"A": "7", "B": "є7"} and got[0].member == "big.csv"
    assert files.archives(spark, str(tmp_path / "a.zip"), encoding="utf-8", members="all").count() == 51
    xml = files.archives(spark, str(tmp_path / "a.zip"), kind="xml").collect()
    assert [r.row for r in xml] == [{"NAME": "Б", "CODE": ""}, {"NAME": "В"}]
    subject = list(archives.subject_rows(io.BytesIO("<D><SUBJECT><NAME>Н</NAME><FOUNDERS><FOUNDER>а</FOUNDER><FOUNDER/><FOUNDER>б</FOUNDER></FOUNDERS></SUBJECT></D>".encode())))
    assert subject[0]["NAME"] == "Н" and subject[0]["founders"] == ["а", "б"] and subject[0]["signers"] == []


def test_xlsx(spark, tmp_path):
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    with zipfile.ZipFile(tmp_path / "b.xlsx", "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="S1" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="r1" Target="worksheets/s.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}"><si><t>Ім</t></si><si><t> є </t></si></sst>')
        z.writestr("xl/worksheets/s.xml", f'<worksheet xmlns="{main}"><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="C1" t="inlineStr"><is><t>N</t></is></c></row><row><c r="A2" t="s"><v>1</v></c><c r="B2"><v>9</v></c><c r="C2"><v>7</v></c></row><row/></sheetData></worksheet>')
    assert [r.row for r in files.archives(spark, str(tmp_path / "b.xlsx"), kind="xlsx").collect()] == [{"Ім": "є", "N": "7"}]


def test_tree_and_dictionaries(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "r.csv").write_text("﻿doc_id\tcourt_code\n1\t7\n")
    (tmp_path / "d" / "courts.csv").write_text("code;name\n7;Суд\n")
    (tmp_path / "x.xml").write_text("<all><doc><Cause>1/2</Cause><p>a</p><p>b</p></doc></all>")
    (tmp_path / "j.json").write_bytes('{"ключ": "є"}'.encode("cp1251"))
    (tmp_path / "bad.json").write_text("{")
    got = sorted(json.dumps(json.loads(r.record), ensure_ascii=False, sort_keys=True) for r in files.tree(spark, str(tmp_path)).collect())
    assert got == ['{"cause": "1/2", "p": ["a", "b"]}', '{"court_code": "7", "doc_id": "1"}', '{"ключ": "є"}']
    assert [tuple(r) for r in files.dictionaries(spark, str(tmp_path)).collect()] == [("court", 1, "7", "Суд")]
    fields = files.flat_fields(files.tree(spark, str(tmp_path)).where("record like '%cause%'"), ["cause", "p", "zz"]).first()
    assert (fields.cause, fields.p, fields.zz) == ("1/2", '["a","b"]', None)


def test_documents(spark, tmp_path):
    assert files.document_text("a.rtf", rb"{\rtf1\ansi\ansicpg1251{\fonttbl{\f0 Arial;}}\'d1\'f3\'e4 \u1108?\par {\*\x y}End}") == "Суд є\nEnd"
    assert files.document_text("http://x/a.html?y", "<p>Є&nbsp;а</p><script>x</script>".encode()) == "Є\xa0а"
    box = io.BytesIO()
    with zipfile.ZipFile(box, "w") as z:
        z.writestr("word/document.xml", '<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:p><w:r><w:t>а</w:t><w:t>б</w:t></w:r></w:p><w:p/></w:document>')
    assert files.document_text("a.docx", box.getvalue()) == "аб"
    assert files.document_text("a.doc", b"x") is None and files.document_text("a.docx", b"x") is None and files.document_text("a.pdf", b"x") == ""
    (tmp_path / "t.txt").write_text("рядок\n")
    (tmp_path / "b.bin").write_bytes(b"\x00\x01")
    (tmp_path / "c.bin").write_bytes(b"\xff\xfe!")
    assert [(r.path[-5:], r.text) for r in files.documents(spark, str(tmp_path)).where("path like '%txt'").collect()] == [("t.txt", "рядок")]
    assert [r.content for r in files.text_files(spark, str(tmp_path)).collect()] == ["рядок\n"]
    assert files.inventory(spark, str(tmp_path)).count() == 3


def test_small_readers(spark, tmp_path):
    (tmp_path / "m.jsonl").write_text('{"step": 1, "loss": 2.0}\nbroken\n{"step": 2, "val_loss": 1.5}\n{"x": 1}\n')
    got = files.metric_lines(spark, str(tmp_path / "m.jsonl")).orderBy("ordinal").collect()
    assert [(r.ordinal, r.step, r.val_loss) for r in got] == [(0, 1, None), (2, 2, 1.5)]
    (tmp_path / "s.txt").write_text("# c\n\nhttp://x?a=1=p/q\nhttp://y\n")
    assert [tuple(r) for r in files.source_list(spark, str(tmp_path / "s.txt")).collect()] == [(3, "http://x?a", "1=p/q"), (4, "http://y", None)]
    assert [files.sniff(x) for x in ("a\tb,c", "a;b;c,d", "a,b;c", "abc", "")] == ["\t", ";", ",", ",", ","]


def test_xml_source(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<r><REC><a>1</a><b>007</b></REC><REC><a>2</a></REC></r>")
    assert [tuple(r) for r in files.xml_records(spark, str(tmp_path / "a.xml"), "REC").orderBy("A").collect()] == [("1", "007"), ("2", None)]


def test_sinks(spark, tmp_path):
    rows = spark.range(95).withColumn("t", F.lit("x")).coalesce(1)
    parts = sinks.write_parts(rows, str(tmp_path / "p"), part_rows=30)
    assert sorted(r.n_rows for r in parts.collect()) == [5, 30, 30, 30]
    assert sinks.manifest(spark, str(tmp_path / "p"), tag="1").count() == 4
    try:
        sinks.write_parts(rows.limit(0), str(tmp_path / "q"))
        raise AssertionError("empty writes must fail")
    except ValueError:
        pass
    assert sinks.append_shard(rows, str(tmp_path / "p")) and not sinks.append_shard(rows.limit(0), str(tmp_path / "p"))
    assert files.available(spark, str(tmp_path / "p"), ["id", "none"]).count() == 190
    sinks.write_lines(spark.createDataFrame([("а",), ("б",)], "line string"), str(tmp_path / "l"))
    sinks.write_document(spark.createDataFrame([(1, None)], "a int, b string"), str(tmp_path / "m.json"))
    assert json.loads((tmp_path / "m.json").read_text()) == {"a": 1, "b": None}


def test_streams(spark, tmp_path):
    kind = "document_id string, source_url string, a long, b long, kind string, dataset string"
    put = lambda rows: spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    schema = spark.createDataFrame([], kind).schema
    put([("1", "x.rtf", 1, 2, "k", "d"), ("1", "y.rtf", 2, 1, "k", "d"), ("2", "x.pdf", 1, 1, "k", "d")])
    for _ in range(2):
        incremental.pending_documents(incremental.new_files(spark, str(tmp_path / "in"), schema), "document_id", "source_url", [".rtf"], str(tmp_path / "out"), str(tmp_path / "c1")).awaitTermination()
        put([("1", "z.rtf", 1, 3, "k", "d"), ("3", "z.rtf", 1, 3, "k", "d")])
    assert sorted(r.document_id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["1", "3"]
    query = incremental.edge_counts(incremental.new_files(spark, str(tmp_path / "in"), schema)).writeStream.format("memory").queryName("edges_now").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted((r.a, r.b, r.weight) for r in spark.table("edges_now").collect()) == [(1, 2, 2), (1, 3, 4)]
