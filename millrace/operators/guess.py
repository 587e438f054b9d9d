"""Which columns of an unknown register hold persons, codes, organisations and numbers: a look at sample rows before one is mapped."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import text as T

# Headings as they look without blanks and punctuation, beginnings of them, and parts of headings as written.
# Headings with an underscore can't match, as matching takes it out; they are part of the rule.
PERSON = (("FIO", "PIB", "ФІО", "ПІБ", "ФИО", "NAME_PERSON", "FULLNAME", "SECONDNAME", "AK_NAME", "PERSON"), ("ПРІЗВИЩЕ", "ФАМІЛІЯ", "ФАМИЛИЯ", "SURNAME", "LASTNAME", "ІМ", "ИМЯ"), ())
IPN = (("IPN", "ІПН", "ІНН", "ИНН", "INN", "TIN", "DRFO", "ДРФО", "РНОКПП", "RNOKPP"), (), ())
EDRPOU = (("EDRPOU", "ЄДРПОУ", "ЕДРПОУ"), (), ())
ORG = (("NAME_OBJ", "ORGANIZATION", "ORG", "SUBJECT_NAME", "AUDITOR_FIRM", "НАЗВА", "НАЗВА_ОРГ", "NAME", "ORG_NAME"), (), ("НАЗВА ОРГАНІЗАЦІЇ", "НАЗВА СУБ", "НАЗВА_ЮР", "ФІРМА"))
NUMBER = (("REG_NUM", "REG_NUMBER", "LICENSE", "СВІДОЦТВО", "СВІДОЦТВА"), (), ("РЕЄСТРАЦІЙНИЙ НОМЕР", "НОМЕР СВІДОЦТВА", "НОМЕР РЕЄСТРУ", "№ РЕЄСТРУ"))


def _matches(heading: Column, marks: tuple[Sequence[str], Sequence[str], Sequence[str]]) -> Column:
    exact, beginnings, parts = marks
    bare, found = T.header(heading), F.lit(False)
    found = bare.isin(*exact)
    for beginning in beginnings:
        found = found | F.startswith(bare, F.lit(beginning))
    for part in parts:
        found = found | F.contains(F.upper(heading), F.lit(part))
    return found


def guess_field(row: Column, marks: tuple[Sequence[str], Sequence[str], Sequence[str]]) -> Column:
    """The first heading of a row (a string map, in its order) that has a value and matches; null if none does."""
    filled = F.filter(F.map_entries(row), lambda e: F.coalesce(F.trim(e["value"]), F.lit("")) != "")
    return F.get(F.transform(F.filter(filled, lambda e: _matches(e["key"], marks)), lambda e: e["key"]), F.lit(0))


def canonical_fields(rows: DataFrame, known: DataFrame | None = None, row: str = "row") -> DataFrame:
    """``rows`` with ``found``: person, ipn, edrpou, org and regnum as read from a string map of any headings, '' where there is none.

    Codes count with 10 and 8 digits. Where no heading tells, other columns do by their digits, in order: ten are a tax number, eight
    that are no date a company code, twelve or more, while neither is found, the company code they begin with, if ``known`` (edrpou) has it.
    """
    source = F.map_filter(F.transform_values(F.col(row), lambda _, v: F.trim(v)), lambda _, v: v.isNotNull())
    keyed = rows.withColumn("__row", source)
    for name, marks in (("person", PERSON), ("ipn", IPN), ("edrpou", EDRPOU), ("org", ORG), ("regnum", NUMBER)):
        keyed = keyed.withColumn(f"__{name}", guess_field(F.col("__row"), marks))
    used = F.array_compact(F.array(*[F.col(f"__{n}") for n in ("person", "ipn", "edrpou", "org", "regnum")]))
    rest = F.transform(F.filter(F.map_entries("__row"), lambda e: ~F.array_contains(used, e["key"])), lambda e: T.digits(e["value"]))
    keyed = keyed.withColumn("__rest", rest)
    starts = F.filter(F.transform("__rest", lambda c: F.when((F.length(c) >= 12) & ~T.looks_like_date(F.substring(c, 1, 8)), F.substring(c, 1, 8))), lambda c: c.isNotNull())
    if known is None:
        keyed = keyed.withColumn("__known", F.array().cast("array<string>"))
    else:
        keyed = keyed.withColumn("__id", F.monotonically_increasing_id())
        there = keyed.select("__id", F.explode(F.array_distinct(starts)).alias("edrpou")).join(known.select("edrpou").distinct(), "edrpou", "left_semi")
        keyed = keyed.join(there.groupBy("__id").agg(F.collect_set("edrpou").alias("__known")), "__id", "left").withColumn("__known", F.coalesce("__known", F.array().cast("array<string>"))).drop("__id")
    value = lambda name: F.coalesce(F.element_at("__row", F.col(f"__{name}")), F.lit(""))
    code = lambda name, size: F.when(F.length(T.digits(value(name))) == size, T.digits(value(name))).otherwise("")

    def step(acc: Column, c: Column) -> Column:
        ten = (acc["ipn"] == "") & (F.length(c) == 10)
        eight = ~ten & (acc["edrpou"] == "") & (F.length(c) == 8) & ~T.looks_like_date(c)
        start = F.substring(c, F.lit(1), F.lit(8))
        twelve = ~ten & ~eight & (acc["ipn"] == "") & (acc["edrpou"] == "") & (F.length(c) >= 12) & ~T.looks_like_date(start) & F.array_contains("__known", start)
        return F.struct(F.when(ten, c).otherwise(acc["ipn"]).alias("ipn"), F.when(eight, c).when(twelve, start).otherwise(acc["edrpou"]).alias("edrpou"))

    codes = F.aggregate("__rest", F.struct(code("ipn", 10).alias("ipn"), code("edrpou", 8).alias("edrpou")), step)
    found = F.struct(value("person").alias("person"), codes["ipn"].alias("ipn"), codes["edrpou"].alias("edrpou"), value("org").alias("org"), value("regnum").alias("regnum"))
    return keyed.withColumn("found", found).select(*rows.columns, "found")


def inspect(rows: DataFrame, most: int = 5, known: DataFrame | None = None, row: str = "row") -> DataFrame:
    """``most`` sample rows (row map) with what is recognised in each; a sample is the point of it."""
    return canonical_fields(rows.limit(most), known, row).select(row, "found.*")


def as_maps(rows: DataFrame) -> DataFrame:
    """(row) string maps of the columns of a register, in their order."""
    return rows.select(F.create_map(*[x for c in rows.columns for x in (F.lit(c), F.col(f"`{c}`").cast("string"))]).alias("row"))
