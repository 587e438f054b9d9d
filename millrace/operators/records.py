"""Records of any column naming brought to fixed schemas, enriched by code lists and checked."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as st

from millrace.functions import text as T

# Fields of a decision record with the column names that sources use for them, in order of preference.
DECISION_FIELDS = {
    "case_number": ("case_number", "cause_num", "nomer_spravy", "caseNum", "case"),
    "document_id": ("document_id", "doc_id", "id", "id_doc"),
    "court": ("court_name", "court", "sud"),
    "court_instance": ("court_instance", "instance", "instanciya"),
    "document_type": ("judgment_code", "document_type", "decision_type", "type"),
    "decision_date": ("adjudication_date", "decision_date", "date_decision", "date"),
    "publication_date": ("date_publ", "publication_date", "published_at"),
    "judge": ("judge", "suddya"),
    "justice_kind": ("justice_kind",),
    "status": ("status",),
    "category": ("category_name", "category", "kategoriya"),
    "text": ("text", "body", "content", "document_text", "tekst", "fulltext"),
    "source_url": ("doc_url", "source_url", "url", "reyestr_url"),
}
PROVENANCE_FIELDS = ("source_dataset", "source_sha256", "source_file", "extra")
DECISION_SCHEMA = st.StructType([st.StructField(n, st.StringType()) for n in (*DECISION_FIELDS, *PROVENANCE_FIELDS)])
# Keys that a valid record must have.
REQUIRED_KEYS = ("case_number", "decision_date", "text")


def plain_key(name: str) -> str:
    """A column name as matching sees it: Latin letters and digits, lower case."""
    return re.sub("[^a-z0-9]", "", name.lower())


def pick(columns: Sequence[str], aliases: Sequence[str]) -> str | None:
    """The column of the first alias that is present at all, even if its values are empty; of equal columns the last."""
    there = {plain_key(c): c for c in columns}
    return next((there[plain_key(a)] for a in aliases if plain_key(a) in there), None)


def filled(columns: Sequence[str], aliases: Sequence[str]) -> Column:
    """Per row the first alias whose value is not blank, else ''; headings match without case and punctuation."""
    bare = lambda s: re.sub(r"[\s_\-'/ʼ’().,\"]", "", s.upper())
    found = [c for a in aliases for c in ([a] if a in columns else []) + [c for c in columns if bare(c) == bare(a) and c != a]]
    return T.first_filled(*[F.col(f"`{c}`") for c in dict.fromkeys(found)]) if found else F.lit("")


def normalize_decisions(raw: DataFrame, dataset: str, file_hash: str | Column = "", file: str | Column = "") -> DataFrame:
    """The 17 string columns of a decision record from rows of any column naming; ``extra`` keeps the whole row as JSON.

    Which column feeds a field is settled when the plan is made, so only those columns are read. Blank values become null.
    """
    value = lambda c: T.blank_to_null((F.to_json(c) if isinstance(raw.schema[c].dataType, (st.StructType, st.ArrayType, st.MapType)) else F.col(f"`{c}`")).cast("string"))
    fields = [(value(c) if (c := pick(raw.columns, aliases)) else F.lit(None).cast("string")).alias(name) for name, aliases in DECISION_FIELDS.items()]
    as_column = lambda x: F.lit(x) if isinstance(x, str) else x
    extra = F.to_json(F.struct(*[F.col(f"`{c}`") for c in raw.columns]), {"ignoreNullFields": "false"})
    return raw.select(*fields, F.lit(f"https://data.gov.ua/dataset/{dataset}").alias("source_dataset"), as_column(file_hash).alias("source_sha256"), as_column(file).alias("source_file"), extra.alias("extra"))


def normalize_generic(raw: DataFrame, aliases: Mapping[str, Sequence[str]], now: Column | None = None) -> DataFrame:
    """Fields by exact alias (first non-null), text hash (null if empty), load time and all unused columns as a map."""
    used = {a for names in aliases.values() for a in names}
    fields = [F.coalesce(*[F.col(f"`{a}`").cast("string") for a in names if a in raw.columns], F.lit(None).cast("string")).alias(name) for name, names in aliases.items()]
    rest = [c for c in raw.columns if c not in used]
    extra = F.map_filter(F.create_map(*[x for c in rest for x in (F.lit(c), F.col(f"`{c}`").cast("string"))]), lambda _, v: v.isNotNull()) if rest else F.create_map().cast("map<string,string>")
    out = raw.select(*fields, extra.alias("extra"), (now if now is not None else F.current_timestamp()).alias("ingested_at"))
    return out.withColumn("text_sha256", F.when(F.col("text").isNotNull() & (F.col("text") != ""), F.sha2("text", 256))) if "text" in aliases else out


def enrich(rows: DataFrame, code: str, codes: DataFrame, out: str) -> DataFrame:
    """``out`` from a code list (seq, code, name): trimmed codes, the last entry of a code wins, unknown codes give null.

    Code lists of registers have some thousands of rows; the join is left to the optimizer, which broadcasts them by size.
    """
    last = codes.groupBy(F.trim("code").alias("__code")).agg(F.max(F.struct("seq", "name"))["name"].alias(out))
    return rows.join(last, F.trim(F.col(code)) == F.col("__code"), "left").drop("__code")


def errors(row: Mapping[str, Column], present: Sequence[str], required: Sequence[str] = REQUIRED_KEYS, least_text: int = 20) -> Column:
    """Array of what is wrong: required keys that are absent (null values pass) and texts that are too short."""
    found = [F.lit(f"missing {k}") for k in required if k not in present]
    text = row.get("text")
    if text is not None:
        found.append(F.when((F.length(F.trim(text)) > 0) & (F.length(F.trim(text)) < least_text), "text too short"))
    return F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")


def gate(rows: DataFrame, problems: Column, most_invalid: float = 0.01) -> DataFrame:
    """One row: total, invalid, ratio and whether the ratio passes."""
    counted = rows.agg(F.count("*").alias("total"), F.count_if(F.size(problems) > 0).alias("invalid"))
    ratio = F.when(F.col("total") > 0, F.col("invalid") / F.col("total")).otherwise(0.0)
    return counted.withColumn("ratio", ratio).withColumn("passed", F.col("ratio") <= most_invalid)


def quarantine(rows: DataFrame, problems: Column) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and invalid rows with their problems and a content hash."""
    marked = rows.withColumn("problems", problems)
    content = F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns])), 256)
    return marked.where(F.size("problems") == 0).drop("problems"), marked.where(F.size("problems") > 0).withColumn("content_sha256", content)


def duplicate_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
