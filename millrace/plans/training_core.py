"""Queries p1, p3 and p6: timestamps, hot keys and orphan references over the register tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import orphans, skew, timestamps
from millrace.session import table

HOT_SHARE = 0.025


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    records, provenance = table(spark, sf_dir, "edrsr_records"), table(spark, sf_dir, "provenance")
    dates = [timestamps.unusual(records.select("rec_id", "source_dataset", c), "rec_id", c, "date", c, source="source_dataset", zones=timestamps.SOURCE_ZONES) for c in ("decision_date", "publication_date")]
    # repeated provenance rows are exact, so their findings are too
    instants = timestamps.unusual(provenance.select("record_id", "source", "retrieved_at"), "record_id", "retrieved_at", "instant", "retrieved_at", source="source", zones=timestamps.SOURCE_ZONES).distinct()
    return reduce(DataFrame.unionByName, [*dates, instants])


def p1_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per field and normalised month, with those that hold no usable value as ``unusable``."""
    records, provenance = table(spark, sf_dir, "edrsr_records"), table(spark, sf_dir, "provenance")
    parts = [(records, "decision_date", "date", "source_dataset"), (records, "publication_date", "date", "source_dataset"), (provenance, "retrieved_at", "instant", "source")]
    done = [timestamps.normalize(df.select(c, source), c, "norm", form, source=source, zones=timestamps.SOURCE_ZONES).select(F.lit(c).alias("field"), F.coalesce(F.substring("norm", 1, 7), F.lit("unusable")).alias("month")) for df, c, form, source in parts]
    return reduce(DataFrame.unionByName, done).groupBy("field", "month").agg(F.count("*").alias("n_rows"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = table(spark, sf_dir, "mentions").select(F.lit("mentions.entity_id").alias("field"), F.col("entity_id").alias("key_id"))
    keys = keys.unionByName(table(spark, sf_dir, "edges").select(F.lit("edges.a").alias("field"), F.col("a").alias("key_id")))
    return skew.hot_values(keys, "field", "key_id", HOT_SHARE).select("field", "key_id")


def _day(text: Column) -> Column:
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text).try_cast("date")


def p3_entity_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per entity over all mentions: rows, distinct datasets, latest and exact median date."""
    rows = table(spark, sf_dir, "mentions").select("entity_id", "dataset", F.unix_date(_day(F.get_json_object("extra", "$.date"))).alias("day"))
    out = skew.profile(rows, "entity_id", "dataset", "day")
    return out.select(F.col("key").alias("entity_id"), "n_rows", "n_datasets", F.date_from_unix_date(F.col("top").cast("int")).cast("string").alias("latest"), F.date_from_unix_date(F.col("median").cast("int")).cast("string").alias("median_date"))


def p3_edge_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per first end over all edges: rows, distinct datasets, largest and exact median weight."""
    out = skew.profile(table(spark, sf_dir, "edges").select("a", "dataset", "weight"), "a", "dataset", "weight")
    return out.select(F.col("key").alias("a"), "n_rows", "n_datasets", F.col("top").alias("max_weight"), F.col("median").alias("median_weight"))


def _references(spark: SparkSession, sf_dir: str) -> list[tuple[str, DataFrame, DataFrame, bool]]:
    day = lambda c: F.substring(c, 1, 10).try_cast("date")
    cases = table(spark, sf_dir, "cases").select(orphans.plain_key(F.col("case_id")).alias("key"), day("first_seen_at").alias("since"))
    entities = table(spark, sf_dir, "entities").select(F.col("entity_id").cast("string").alias("key"), F.lit(None).cast("date").alias("since"))
    hearings = table(spark, sf_dir, "hearings").select(F.col("hearing_id").alias("row_id"), orphans.plain_key(F.col("case_id")).alias("key"), day("scheduled_at").alias("day"))
    decisions = table(spark, sf_dir, "decisions").select(F.col("decision_id").alias("row_id"), orphans.plain_key(F.col("case_id")).alias("key"), day("decision_date").alias("day"))
    mentions = table(spark, sf_dir, "mentions").select(F.col("mention_id").cast("string").alias("row_id"), F.col("entity_id").cast("string").alias("key"), _day(F.get_json_object("extra", "$.date")).alias("day"))
    return [("hearings", hearings, cases, True), ("decisions", decisions, cases, True), ("mentions", mentions, entities, False)]


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [orphans.orphan_rows(refs, targets, since).select(F.lit(name).alias("tbl"), "row_id", "period", "reason") for name, refs, targets, since in _references(spark, sf_dir)]
    return reduce(DataFrame.unionByName, parts)


def p6_orphan_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphan references and distinct orphan keys per table, month and reason."""
    parts = [orphans.orphan_counts(refs, targets, since).select(F.lit(name).alias("tbl"), "period", "reason", "refs", "keys") for name, refs, targets, since in _references(spark, sf_dir)]
    return reduce(DataFrame.unionByName, parts)


QUERIES = {f.__name__: f for f in (p1_found, p1_months, p3_found, p3_entity_profile, p3_edge_profile, p6_found, p6_orphan_counts)}

_REFS = """
refs AS (
  SELECT 'hearings' AS tbl, hearing_id AS row_id, lower(trim(case_id)) AS key, try_cast(substr(scheduled_at, 1, 10) AS DATE) AS day FROM hearings
  UNION ALL SELECT 'decisions', decision_id, lower(trim(case_id)), try_cast(substr(decision_date, 1, 10) AS DATE) FROM decisions
  UNION ALL SELECT 'mentions', cast(mention_id AS VARCHAR), cast(entity_id AS VARCHAR), try_cast(json_extract_string(extra, '$.date') AS DATE) FROM mentions),
targets AS (
  SELECT 'hearings' AS tbl, lower(trim(case_id)) AS key, min(try_cast(substr(first_seen_at, 1, 10) AS DATE)) AS since FROM cases GROUP BY 2
  UNION ALL SELECT 'decisions', lower(trim(case_id)), min(try_cast(substr(first_seen_at, 1, 10) AS DATE)) FROM cases GROUP BY 2
  UNION ALL SELECT DISTINCT 'mentions', cast(entity_id AS VARCHAR), CAST(NULL AS DATE) FROM entities),
found AS (
  SELECT r.tbl, r.row_id, r.key, coalesce(strftime(r.day, '%Y-%m'), 'unknown') AS period, CASE WHEN t.key IS NULL THEN 'missing' ELSE 'late' END AS reason
  FROM refs r LEFT JOIN targets t ON r.tbl = t.tbl AND r.key = t.key
  WHERE r.key IS NOT NULL AND r.key <> '' AND (t.key IS NULL OR t.since > r.day))
"""

_UNUSUAL = r"""
WITH v AS (
  SELECT 'decision_date' AS field, cast(rec_id AS VARCHAR) AS row_key, decision_date AS val FROM edrsr_records WHERE NOT regexp_matches(decision_date, '^\d{4}-\d{2}-\d{2}$')
  UNION ALL SELECT 'publication_date', cast(rec_id AS VARCHAR), publication_date FROM edrsr_records WHERE NOT regexp_matches(publication_date, '^\d{4}-\d{2}-\d{2}$')
  UNION ALL SELECT DISTINCT 'retrieved_at', record_id, retrieved_at FROM provenance WHERE NOT regexp_matches(retrieved_at, '^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{6}Z$')),"""
_EVERY = """
WITH v AS (
  SELECT 'decision_date' AS field, cast(rec_id AS VARCHAR) AS row_key, decision_date AS val FROM edrsr_records
  UNION ALL SELECT 'publication_date', cast(rec_id AS VARCHAR), publication_date FROM edrsr_records
  UNION ALL SELECT 'retrieved_at', record_id, retrieved_at FROM provenance),"""
_READ = r"""
z AS (SELECT *, regexp_extract(val, '(?:(?::\d{2}(?:\.\d+)?|T\d{6})\s?)(Z|UTC|GMT|EET|EEST|[+-]\d{2}:?\d{2}|Europe/Kiev|Europe/Kyiv)$', 1) AS mark FROM v),
b AS (SELECT *, rtrim(val[:length(val) - length(mark)]) AS body FROM z),
h AS (SELECT *, regexp_extract(body, ' (AM|PM)$', 1) AS half, regexp_replace(regexp_replace(body, ' (AM|PM)$', ''), '^(\d{8})T?(\d{2})(\d{2})(\d{2})$', '\1 \2:\3:\4') AS plain FROM b),
t AS (SELECT *, regexp_extract(plain, '[T ](\d{1,2}:\d{2}(?::\d{2}(?:\.\d{1,9})?)?)$', 1) AS clock, regexp_replace(plain, '[T ](\d{1,2}:\d{2}(?::\d{2}(?:\.\d{1,9})?)?)$', '') AS d FROM h),
m AS (SELECT *, list_position(['січ', 'лют', 'бер', 'кві', 'тра', 'чер', 'лип', 'сер', 'вер', 'жов', 'лис', 'гру', 'jan', 'feb', 'mar', 'apr', 'may', 'jun', 'jul', 'aug', 'sep', 'oct', 'nov', 'dec'],
  lower(coalesce(nullif(regexp_extract(d, '^\d{1,2} ([а-яіїє]{3})', 1), ''), nullif(regexp_extract(d, '^([A-Z][a-z]{2}) \d', 1), ''), regexp_extract(d, ' ([A-Z][a-z]{2}) \d{4}$', 1)))) AS mon FROM t),
y AS (SELECT *, CASE
  WHEN regexp_matches(d, '^\d{4}([-/.])\d{1,2}[-/.]\d{1,2}$') THEN regexp_replace(d, '^(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})$', '\1-\2-\3')
  WHEN regexp_matches(d, '^\d{1,2}[-/.]\d{1,2}[-/.]\d{4}$') THEN regexp_replace(d, '^(\d{1,2})[-/.](\d{1,2})[-/.](\d{4})$', '\3-\2-\1')
  WHEN regexp_matches(d, '^\d{1,2}[-/.]\d{1,2}[-/.]\d{2}$') THEN regexp_replace(d, '^(\d{1,2})[-/.](\d{1,2})[-/.](\d{2})$', '20\3-\2-\1')
  WHEN regexp_matches(d, '^\d{8}$') THEN regexp_replace(d, '^(\d{4})(\d{2})(\d{2})$', '\1-\2-\3')
  WHEN regexp_matches(d, '^[A-Z][a-z]{2} \d{1,2}, \d{4}$') THEN regexp_replace(d, '^[A-Z][a-z]{2} (\d{1,2}), (\d{4})$', '\2-') || ((mon - 1) % 12 + 1) || '-' || regexp_extract(d, ' (\d{1,2}),', 1)
  WHEN regexp_matches(d, '^\d{1,2} [а-яіїє]+\.? \d{4}( року| р\.)?$') THEN regexp_extract(d, '(\d{4})', 1) || '-' || mon || '-' || regexp_extract(d, '^(\d{1,2})', 1)
  WHEN regexp_matches(d, '^[A-Z][a-z]{2}, \d{2} [A-Z][a-z]{2} \d{4}$') THEN regexp_extract(d, '(\d{4})$', 1) || '-' || ((mon - 1) % 12 + 1) || '-' || regexp_extract(d, ' (\d{2}) ', 1) END AS ymd FROM m),
p AS (SELECT *, string_split(ymd, '-') AS s, CASE WHEN clock = '' THEN '00:00:00' WHEN regexp_matches(clock, '^\d{1,2}:\d{2}$') THEN clock || ':00' ELSE regexp_replace(clock, '(\.\d{6})\d+$', '\1') END AS hms FROM y),
l AS (SELECT *, try_cast(s[1] || '-' || lpad(s[2], 2, '0') || '-' || lpad(s[3], 2, '0') || ' ' || hms AS TIMESTAMP) + CASE WHEN half = 'PM' AND NOT starts_with(hms, '12') THEN to_hours(12) WHEN half = 'AM' AND starts_with(hms, '12') THEN to_hours(-12) ELSE to_hours(0) END AS local FROM p),
k AS (SELECT *, CASE WHEN mark IN ('Z', 'UTC', 'GMT') THEN 0 WHEN mark = 'EET' THEN 120 WHEN mark = 'EEST' THEN 180
  WHEN regexp_matches(mark, '^[+-]') THEN (CASE WHEN mark[1] = '-' THEN -1 ELSE 1 END) * (cast(mark[2:3] AS INT) * 60 + cast(mark[-2:] AS INT)) END AS off FROM l),
u AS (SELECT *, timezone('Europe/Kyiv', local) AS there FROM k),
i AS (SELECT field, row_key, CASE WHEN regexp_matches(val, '^\d{10}$') THEN make_timestamp(cast(val AS BIGINT) * 1000000) WHEN regexp_matches(val, '^\d{13}$') THEN make_timestamp(cast(val AS BIGINT) * 1000)
  WHEN off IS NOT NULL THEN local - to_minutes(off)
  WHEN timezone('Europe/Kyiv', there - INTERVAL 1 HOUR) = local THEN timezone('UTC', there - INTERVAL 1 HOUR) ELSE timezone('UTC', there) END AS inst FROM u)"""
_NORM = "CASE WHEN field = 'retrieved_at' THEN strftime(inst, '%Y-%m-%dT%H:%M:%S.%fZ') ELSE strftime(timezone('Europe/Kyiv', timezone('UTC', inst)), '%Y-%m-%d') END"

SQL = {
    "p1_found": f"{_UNUSUAL}{_READ} SELECT field, row_key, {_NORM} AS norm_value FROM i WHERE inst IS NOT NULL",
    "p1_months": f"{_EVERY}{_READ} SELECT field, coalesce(substr({_NORM}, 1, 7), 'unusable') AS month, count(*) AS n_rows FROM i GROUP BY 1, 2",
    "p3_found": """
SELECT field, key_id FROM (
  SELECT 'mentions.entity_id' AS field, entity_id AS key_id, count(*) AS n, (SELECT count(*) FROM mentions) AS total FROM mentions GROUP BY entity_id
  UNION ALL SELECT 'edges.a', a, count(*), (SELECT count(*) FROM edges) FROM edges GROUP BY a) WHERE n >= 0.025 * total""",
    "p3_entity_profile": """
WITH m AS (SELECT entity_id, dataset, try_cast(json_extract_string(extra, '$.date') AS DATE) AS day FROM mentions)
SELECT entity_id, count(*) AS n_rows, count(DISTINCT dataset) AS n_datasets, cast(max(day) AS VARCHAR) AS latest, cast(quantile_disc(day, 0.5) AS VARCHAR) AS median_date FROM m GROUP BY entity_id""",
    "p3_edge_profile": "SELECT a, count(*) AS n_rows, count(DISTINCT dataset) AS n_datasets, max(weight) AS max_weight, quantile_disc(weight, 0.5) AS median_weight FROM edges GROUP BY a",
    "p6_found": f"WITH {_REFS} SELECT DISTINCT tbl, row_id, period, reason FROM found",
    "p6_orphan_counts": f"WITH {_REFS} SELECT tbl, period, reason, count(*) AS refs, count(DISTINCT key) AS keys FROM found GROUP BY tbl, period, reason",
}
