import hashlib

import pytest
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.plans import record_queries


def one(spark, value, make, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(make(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize(("given", "wanted"), [("  Іваненко    Петро  Олексійович ", "ІВАНЕНКО ПЕТРО ОЛЕКСІЙОВИЧ"), ("ТОВʼХрест", "ТОВ'ХРЕСТ"), (None, ""), ("а б", "А Б")])
def test_normalize_name(spark, given, wanted):
    assert one(spark, given, T.normalize_name) == wanted


@pytest.mark.parametrize(("code", "wanted"), [("16102003", True), ("35197641", False), ("1610200", False), ("abcdefgh", False), (None, False)])
def test_looks_like_date(spark, code, wanted):
    assert one(spark, code, T.looks_like_date) is wanted


def test_company_codes(spark):
    assert one(spark, "Код 35197641, дата 16102003, 123456789, 35197641 і 44556677", T.company_codes) == ["35197641", "44556677"]
    assert one(spark, None, T.company_codes) == []


@pytest.mark.parametrize(("line", "name", "role"), [("Ковальова І. В.; частка - 1000,00 грн", "Ковальова І. В.", ""), ("Шевчук Олег - директор", "Шевчук Олег", "директор"), ("Сам,", "Сам", "")])
def test_roles(spark, line, name, role):
    assert (one(spark, line, T.role_name), one(spark, line, T.role_of)) == (name, role)


@pytest.mark.parametrize(
    ("x", "y", "wanted"),
    [
        ("А Б В", "А Б В", 1.0),
        ("А БОРИС ВІКТОРОВИЧ", "А Б В", 0.5 + 0.35 * 0.9 + 0.15 * 0.9),
        ("А БОРИС", "А БОРИС ІГОРОВИЧ", 0.9),
        ("А БОРИС", "А БОРИС", 0.85),
        ("А БОРИС ІГОРОВИЧ", "А БОРИС ОЛЕГОВИЧ", None),
        ("А БОРИС", "Б БОРИС", None),
        ("А", "А БОРИС", None),
        ("А ОЛЕГ", "А БОРИС", None),
    ],
)
def test_name_score(spark, x, y, wanted):
    row = spark.createDataFrame([(x.split(), y.split())], "x array<string>, y array<string>").select(T.name_score(F.col("x"), F.col("y")).alias("a"), T.name_score(F.col("y"), F.col("x")).alias("b")).first()
    assert row.a == pytest.approx(wanted) if wanted is not None else row.a is None
    assert row.a == row.b


@pytest.mark.parametrize(("name", "person", "candidate"), [("ІВАНЕНКО ПЕТРО ОЛЕКСІЙОВИЧ", True, True), ("ІВАНЕНКО П. О.", False, True), ("ТОВ РОМАШКА", False, False), ("ІВАНЕНКО", False, False), ("ФІЗИЧНА ОСОБА", True, False), ("ІВАН 7", False, False)])
def test_shapes(spark, name, person, candidate):
    assert (one(spark, name, T.is_person_name), one(spark, name, T.is_name_candidate)) == (person, candidate)


def test_html(spark):
    page = "<p>Суд&nbsp;і <b>час</b></p><SCRIPT>x<1</SCRIPT> <style>a{}</style>&amp;lt;&laquo;а&raquo;"
    assert one(spark, page, T.html_to_text) == "Суд і час &lt;«а»"
    assert one(spark, "<a href=\"x\">'", T.html_escape) == "&lt;a href=&quot;x&quot;&gt;&#x27;"


def test_names_and_urls(spark):
    assert one(spark, "Build & Test: A/B!", T.slug) == "build-test-a-b"
    assert one(spark, "Стан", T.slug) == "unnamed"
    assert one(spark, "HTTPS://Data.Gov.UA:80/x", T.host) == "data.gov.ua"
    assert one(spark, "", T.host) == ""
    assert one(spark, "http://x/a.RTF?y=1", lambda c: T.has_extension(c, [".rtf"])) is True
    assert one(spark, None, lambda c: T.has_extension(c, [".rtf"])) is False
    long = one(spark, "ї" * 500, T.safe_file_name)
    assert len(long.encode()) <= 180 and len(long) > 20


def test_clean_line(spark):
    assert one(spark, " а " * 12, T.clean_line) == " ".join("а" * 12)
    assert one(spark, "коротко", T.clean_line) == "" and one(spark, "x" * 601, T.clean_line) == ""
    assert one(spark, None, T.clean_line) == ""


def test_validators_and_rates(spark):
    assert one(spark, "a" * 64, T.is_sha256) and not one(spark, "g" * 64, T.is_sha256) and not one(spark, None, T.is_sha256)
    assert one(spark, "2026-01-02T03:04:05Z", T.is_utc_timestamp) and not one(spark, "2026-01-02T03:04:05+02:00", T.is_utc_timestamp)
    assert one(spark, 100.0, T.perplexity, "double") == pytest.approx(485165195.4, rel=1e-6)
    assert one(spark, 9, lambda c: T.retry_wait(F.lit(None), c), "int") == 60.0
    assert one(spark, 0, lambda c: T.learning_rate(c, 1.0, 10, 110), "int") == pytest.approx(0.1)
    assert one(spark, 110, lambda c: T.learning_rate(c, 1.0, 10, 110), "int") == pytest.approx(0.1)
    assert one(spark, 503, lambda c: T.failure_kind(F.lit(None), c), "int") == "source_throttled"


def test_pages_of_all_documents(spark, tmp_path):
    texts = ["Суд\nі час", "Postanowienie sądu: zażółć", "Ｓｕｄ５", "а\u00a0б\u2007\u3000в", "ο Cуд"]
    spark.createDataFrame([*((k, t, "джерело") for k, t in enumerate(texts)), (9, None, "x")], "doc_id long, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.text_md5 for r in record_queries.html_to_text(spark, str(tmp_path)).collect()}
    assert got == {k: hashlib.md5(f"{' '.join(t.split())} © &джерело".encode()).hexdigest() for k, t in enumerate(texts)}
