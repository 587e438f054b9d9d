"""Queries over the entity graph, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import graph, registers
from millrace.session import table

_ROLES = "'founder','signer','beneficial_owner','linked','works_at'"


def co_org(spark: SparkSession, sf_dir: str) -> DataFrame:
    """People who share companies in the entity graph."""
    return graph.co_org(table(spark, sf_dir, "edges"), table(spark, sf_dir, "entities"))


def co_org_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers who order a part of one supplier on the same line of their orders."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    members = table(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return graph.co_members(members.select(F.struct("l_partkey", "l_suppkey", "l_linenumber").alias("line"), "o_custkey"), "line", "o_custkey")


def co_litigant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier pairs of one order, counted over orders."""
    orders = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_set("l_suppkey").alias("parties"))
    return graph.co_mentions(orders, "l_orderkey", "parties")


def judges_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.sits_in(table(spark, sf_dir, "edrsr_records"))


def entity_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and suppliers as name entities with their first title."""
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("seq"), F.col("c_name").alias("title")).unionByName(table(spark, sf_dir, "supplier").select((F.col("s_suppkey") + 1_000_000_000).alias("seq"), F.col("s_name").alias("title")))
    return graph.fold_entities(rows.select("seq", F.lit("name").alias("type"), T.normalize_name(F.col("title")).alias("value"), "title"))


def edge_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges in canonical order: ends sorted, self edges dropped, weights of repeats summed."""
    return graph.fold_edges(table(spark, sf_dir, "edges"), "weight")


def mention_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.mention_counts(table(spark, sf_dir, "mentions"))


def graph_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.stats(table(spark, sf_dir, "entities"), table(spark, sf_dir, "mentions"), table(spark, sf_dir, "edges"))


def bfs_depth2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything within two edges of the end that the most edges have, by its first level."""
    edges = table(spark, sf_dir, "edges").where("a != b")
    start = edges.groupBy("a").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "a").limit(1).select(F.col("a").alias("entity_id"))
    return graph.reach(edges, start, 2).select("node", "level")


def search_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The heaviest neighbours of the company with code 90000101."""
    entities = table(spark, sf_dir, "entities")
    return graph.neighbours(table(spark, sf_dir, "edges").where("a != b"), entities, graph.resolve_entity(entities, code="90000101"))


def search_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The entity with the shortest name that contains the asked one."""
    return graph.resolve_entity(table(spark, sf_dir, "entities"), name="Реєстратор").select("entity_id", "value")


def prefix_match_vat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Made-up payer numbers of customers matched with company codes by their first digits."""
    payers = table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lpad((F.col("c_custkey") % 900 + 90_000_000).cast("string"), 8, "0"), F.repeat(F.lit("7"), (F.col("c_custkey") % 5).cast("int"))).alias("code"))
    companies = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") % 900 + 90_000_000).cast("string").alias("edrpou"))
    return registers.match_codes(payers, companies).select("c_custkey", "type", "value")


def code_mode_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of a register whose ids tell persons from organisations by their length."""
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("seq"), F.col("c_name").alias("DEBTOR_NAME"), F.when(F.col("c_custkey") % 3 == 0, F.lpad((F.col("c_custkey") + 2_000_000_000).cast("string"), 10, "0")).when(F.col("c_custkey") % 3 == 1, (F.col("c_custkey") + 40_000_000).cast("string")).otherwise("").alias("DEBTOR_CODE"))
    return registers.counters(rows, registers.Register("debtors", {"name": ["DEBTOR_NAME"], "id": ["DEBTOR_CODE"]}, subject="mixed"))


def register_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edge events that a register of people gives, folded to weights by natural key."""
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("seq"), F.col("c_name").alias("PIB"), F.lpad((F.col("c_nationkey") + 40_000_000).cast("string"), 8, "0").alias("EDRPOU"))
    events = registers.person_events(rows, registers.Register("experts", {"person": ["ПІБ", "PIB"], "edrpou": ["EDRPOU"]}, org_edge="works_at"))
    return events.edges.groupBy("b_value", "kind", "dataset").agg(F.count("*").alias("n"))


QUERIES = {f.__name__: f for f in (co_org, co_org_star, co_litigant, judges_in, entity_upsert, edge_weights, mention_counts, graph_stats, bfs_depth2, search_card, search_name, prefix_match_vat, code_mode_split, register_events)}

_MEMBERS = f"""
c AS (SELECT entity_id FROM entities WHERE type = 'edrpou'),
m AS (
  SELECT DISTINCT CASE WHEN e.a IN (SELECT entity_id FROM c) THEN e.a ELSE e.b END AS company, CASE WHEN e.a IN (SELECT entity_id FROM c) THEN e.b ELSE e.a END AS person
  FROM edges e WHERE e.kind IN ({_ROLES}) AND e.a <> e.b AND (e.a IN (SELECT entity_id FROM c) OR e.b IN (SELECT entity_id FROM c)))"""

SQL = {
    "co_org": f"""
WITH {_MEMBERS},
q AS (SELECT m.* FROM m WHERE person IN (SELECT entity_id FROM entities WHERE type = 'name')),
s AS (SELECT company FROM q GROUP BY company HAVING count(*) BETWEEN 2 AND 40)
SELECT x.person AS a, y.person AS b, count(*) AS weight FROM q x JOIN q y ON x.company = y.company AND x.person < y.person WHERE x.company IN (SELECT company FROM s) GROUP BY 1, 2""",
    "co_org_star": """
WITH m AS (SELECT DISTINCT l_partkey || '-' || l_suppkey || '-' || l_linenumber AS line, o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
s AS (SELECT line FROM m GROUP BY 1 HAVING count(*) BETWEEN 2 AND 40)
SELECT x.o_custkey AS a, y.o_custkey AS b, count(*) AS weight FROM m x JOIN m y ON x.line = y.line AND x.o_custkey < y.o_custkey WHERE x.line IN (SELECT line FROM s) GROUP BY 1, 2""",
    "co_litigant": """
WITH m AS (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem)
SELECT x.l_suppkey AS a, y.l_suppkey AS b, count(*) AS weight FROM m x JOIN m y ON x.l_orderkey = y.l_orderkey AND x.l_suppkey < y.l_suppkey GROUP BY 1, 2""",
    "judges_in": r"""
WITH r AS (SELECT upper(trim(regexp_replace(translate(judge, 'ʼ’', ''''''), '\s+', ' ', 'g'))) AS judge, upper(trim(regexp_replace(translate(court, 'ʼ’', ''''''), '\s+', ' ', 'g'))) AS court FROM edrsr_records)
SELECT judge, court, count(*) AS weight FROM r WHERE judge <> '' AND court <> '' GROUP BY 1, 2""",
    "entity_upsert": r"""
WITH r AS (SELECT c_custkey AS seq, c_name AS title FROM customer UNION ALL SELECT s_suppkey + 1000000000, s_name FROM supplier)
SELECT 'name' AS type, upper(trim(regexp_replace(title, '\s+', ' ', 'g'))) AS value, arg_min(title, seq) AS title FROM r WHERE title <> '' GROUP BY 1, 2""",
    "edge_weights": "SELECT least(a, b) AS a, greatest(a, b) AS b, kind, dataset, sum(coalesce(weight, 1))::BIGINT AS weight FROM edges WHERE a <> b GROUP BY 1, 2, 3, 4",
    "mention_counts": "SELECT dataset, count(*) AS n, min(name) AS first_name FROM mentions GROUP BY dataset",
    "graph_stats": "SELECT 'entities' AS what, count(*) AS n FROM entities UNION ALL SELECT 'mentions', count(*) FROM mentions UNION ALL SELECT 'edges', count(*) FROM edges",
    "bfs_depth2": """
WITH e AS (SELECT a AS s, b AS d FROM edges WHERE a <> b UNION SELECT b, a FROM edges WHERE a <> b),
f AS (SELECT a AS id FROM edges WHERE a <> b GROUP BY a ORDER BY count(*) DESC, a LIMIT 1),
l1 AS (SELECT DISTINCT d AS node FROM e WHERE s IN (SELECT id FROM f)),
l2 AS (SELECT DISTINCT e.d AS node FROM e JOIN l1 ON e.s = l1.node WHERE e.d NOT IN (SELECT id FROM f) AND e.d NOT IN (SELECT node FROM l1))
SELECT node, 1 AS level FROM l1 UNION ALL SELECT node, 2 FROM l2""",
    "search_card": """
WITH s AS (SELECT min(entity_id) AS id FROM entities WHERE type = 'edrpou' AND value = '90000101'),
e AS (SELECT a AS src, b AS dst, kind, dataset, weight FROM edges WHERE a <> b UNION SELECT b, a, kind, dataset, weight FROM edges WHERE a <> b),
k AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY weight DESC NULLS LAST, dst, kind, dataset) AS k FROM e WHERE src IN (SELECT id FROM s))
SELECT src AS start_id, dst AS neighbour, type, value, kind, dataset, weight FROM k JOIN entities ON dst = entity_id WHERE k <= 30""",
    "search_name": "SELECT entity_id, value FROM entities WHERE type = 'name' AND contains(value, 'РЕЄСТРАТОР') ORDER BY length(value), entity_id LIMIT 1",
    "prefix_match_vat": """
WITH c AS (SELECT DISTINCT cast(s_suppkey % 900 + 90000000 AS VARCHAR) AS edrpou FROM supplier),
p AS (SELECT c_custkey, cast(c_custkey % 900 + 90000000 AS VARCHAR) || repeat('7', cast(c_custkey % 5 AS INT)) AS code FROM customer)
SELECT c_custkey, CASE WHEN edrpou IS NOT NULL THEN 'edrpou' WHEN length(code) >= 10 THEN 'ipn' WHEN length(code) >= 8 THEN 'edrpou' END AS type,
  CASE WHEN edrpou IS NOT NULL THEN edrpou WHEN length(code) >= 10 THEN substr(code, 1, 10) ELSE substr(code, 1, 8) END AS value FROM p LEFT JOIN c ON substr(code, 1, 8) = edrpou""",
    "code_mode_split": """
SELECT count(*) AS n_rows, count(*) FILTER (c_custkey % 3 <> 1 AND c_name <> '') AS people, count(*) FILTER (c_custkey % 3 = 0) AS identities, CAST(0 AS BIGINT) AS org_edges, count(*) FILTER (c_custkey % 3 = 1) AS org_subjects FROM customer""",
    "register_events": "SELECT cast(c_nationkey + 40000000 AS VARCHAR) AS b_value, 'works_at' AS kind, 'experts' AS dataset, count(*) AS n FROM customer WHERE c_name <> '' GROUP BY 1",
}
