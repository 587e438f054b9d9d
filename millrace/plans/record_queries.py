"""Queries over records, corpora, catalogs and contracts, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import catalog, control, corpus, records
from millrace.session import table

NOW = "2024-07-01 00:00:00"


def dictionary_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Court names from the court codes that records keep in their raw form."""
    rows = table(spark, sf_dir, "edrsr_records").select("rec_id", F.get_json_object("extra", "$.court_code").alias("court_code"))
    codes = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("seq"), (F.col("n_nationkey") + 200).cast("string").alias("code"), F.col("n_name").alias("name"))
    return records.enrich(rows, "court_code", codes, "court_name").select("rec_id", "court_code", "court_name")


def normalize_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written names of mentions by their normalised form, with digits and tokens counted."""
    name = F.col("name")
    rows = table(spark, sf_dir, "mentions").where("name is not null").select(T.normalize_name(name).alias("normal"), F.length(T.digits(name)).alias("n_digits"))
    return rows.groupBy("normal").agg(F.count("*").alias("n"), F.sum("n_digits").alias("digits"))


def person_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities of type name by whether they look like a person's full name or a candidate."""
    rows = table(spark, sf_dir, "entities").where("type = 'name'")
    return rows.groupBy(T.is_person_name(F.col("value")).alias("person"), T.is_name_candidate(F.col("value")).alias("candidate")).agg(F.count("*").alias("n"))


def roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name and role of made-up signer lines."""
    line = F.concat(F.col("c_name"), F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit(" - "), F.col("c_mktsegment"))).when(F.col("c_custkey") % 3 == 1, F.lit("; частка - 100,00 грн")).otherwise(""))
    rows = table(spark, sf_dir, "customer").select("c_custkey", line.alias("line"))
    return rows.select("c_custkey", T.role_name(F.col("line")).alias("name"), T.role_of(F.col("line")).alias("role"))


def decision_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions under other column names brought to the fixed record, counted by filled fields."""
    raw = table(spark, sf_dir, "edrsr_records").select(F.col("case_number").alias("cause_num"), F.col("document_id").alias("doc_id"), F.col("court").alias("court_name"), F.col("decision_date").alias("adjudication_date"), F.col("judge"), F.col("text").alias("document_text"))
    done = records.normalize_decisions(raw, "edrsr", "0", "file.csv")
    return done.groupBy("court").agg(*[F.count(c).alias(f"n_{c}") for c in ("case_number", "document_id", "decision_date", "publication_date", "judge", "text", "extra")])


def validate_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("text")
    return records.gate(rows, records.errors({"text": F.col("text")}, ["case_number", "decision_date", "text"], least_text=120))


def duplicate_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.duplicate_keys(table(spark, sf_dir, "edrsr_records").where("document_id is not null"), ["document_id"])


def quarantined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that fail validation, with what is wrong."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "text")
    _, bad = records.quarantine(rows, records.errors({"text": F.col("text")}, ["case_number", "decision_date", "text"], least_text=120))
    return bad.select("doc_id", F.array_join("problems", "; ").alias("problems"))


def corpus_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A systematic sample of the sorted distinct clean lines of documents."""
    lines = corpus.distinct_lines(table(spark, sf_dir, "documents").select(F.col("text").alias("line")))
    return corpus.systematic_sample(lines, target=50)


def corpus_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean distinct lines per kind of document."""
    lines = table(spark, sf_dir, "documents").select("doc_kind", T.clean_line(F.col("text")).alias("line")).where("line != ''")
    return lines.groupBy("doc_kind").agg(F.count("*").alias("written"), F.count_distinct("line").alias("lines"))


def record_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One corpus line a decision and a payer."""
    c = F.col
    decisions = table(spark, sf_dir, "edrsr_records").select(corpus.decision_line(c("court"), c("case_number"), c("category"), c("judge"), c("decision_date")).alias("line"))
    payers = table(spark, sf_dir, "supplier").select(corpus.vat_line(c("s_name"), F.when(c("s_suppkey") % 4 > 0, c("s_suppkey").cast("string")), F.when(c("s_suppkey") % 3 > 0, c("s_name"))).alias("line"))
    companies = table(spark, sf_dir, "supplier").select(corpus.company_line(F.lit("ТОВ"), c("s_name"), c("s_suppkey").cast("string"), F.lit("зареєстровано"), F.array(F.concat(c("s_name"), F.lit("; частка - 5 грн")), F.lit("")), F.substring("s_name", 1, 220)).alias("line"))
    return decisions.unionByName(payers).unionByName(companies).groupBy("line").agg(F.count("*").alias("n"))


def chunk_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of each source's document lines in order."""
    rows = table(spark, sf_dir, "documents").select("source", "doc_id", T.clean_line(F.col("text")).alias("line")).where("line != ''")
    return corpus.chunks(rows, "source", "doc_id").select("source", "chunk", F.length("text").alias("n_chars"))


def _page_texts(rows: DataFrame) -> DataFrame:
    page = F.concat(F.lit("<html><style>p {color: red}</style><body><p class='a'>"), F.replace("text", F.lit("\n"), F.lit("</p><p>")), F.lit("</p><script>if (1 > 0) {}</script>&copy; &amp;"), F.col("source"), F.lit("</body></html>"))
    return rows.where(F.col("text").isNotNull()).select("doc_id", F.md5(T.html_to_text(page)).alias("text_md5"))


def html_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text of pages made from documents."""
    return _page_texts(table(spark, sf_dir, "documents"))


def hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "provenance").select(T.host(F.col("source_url")).alias("host"))
    return rows.groupBy("host").agg(F.count("*").alias("n"))


def pending_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions whose text is not loaded and whose address can be fetched, each document once."""
    rows = table(spark, sf_dir, "edrsr_records")
    done = rows.where("text is not null").select("document_id")
    return catalog.pending(rows, done, "document_id", "source_url", [".rtf", ".html", ".txt"], "rec_id")


def resource_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as resources: the later half of a snapshot against the earlier, by decision and host."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("https://H"), (F.col("o_custkey") % 7).cast("string"), F.lit(".example/"), F.col("o_orderkey").cast("string")).alias("url"), F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderpriority")).alias("hash"), F.when(F.col("o_orderkey") % 5 > 0, F.col("o_orderdate").cast("string")).alias("last_modified"), F.col("o_custkey").alias("size"))
    prior = orders.where("o_orderkey % 4 > 0").select("url", F.when(F.col("o_orderkey") % 8 == 1, F.lit("x")).otherwise(F.col("hash")).alias("hash"), "last_modified", F.when(F.col("o_orderkey") % 8 == 2, F.col("size") + 1).otherwise(F.col("size")).alias("size"))
    known = spark.createDataFrame([(f"h{k}.example", k != 3) for k in range(7)], "host string, reachable boolean")
    rows = orders.withColumns({"ordinal": F.col("o_orderkey"), "throttled": F.col("o_orderkey") % 97 == 0})
    return catalog.sync_decisions(rows, prior, known, halt_after=3).groupBy("host", "decision").agg(F.count("*").alias("n"))


def title_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best firm title for made-up search terms; the last term of a query counts."""
    datasets = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("title"), (F.col("p_size") % 9).alias("n_resources"))
    terms = spark.createDataFrame([("a", 1, "blue"), ("a", 2, "green metal"), ("b", 1, "small red")], "query string, ordinal int, term string")
    return catalog.rank_titles(datasets, terms)


def catalog_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return catalog.page(rows, 20, 10)


def last_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each user's last three failures."""
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    return catalog.last_kept(rows.where("event_type = 'error' or event_type = 'click'"), ["user_id"], "event_id", 3).groupBy("event_type").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


def drift_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two halves of the lines compared per return flag."""
    lines = table(spark, sf_dir, "lineitem")
    half = lambda cond, p: lines.where(cond).groupBy(F.col("l_returnflag").alias("name")).agg(F.lit("h").alias(f"{p}_schema_hash"), F.count("*").alias(f"{p}_row_count"), F.count_distinct("l_linestatus").alias(f"{p}_distribution"), F.lit(True).alias(f"{p}_available"))
    pairs = half("l_orderkey % 5 < 2", "base").join(half("l_orderkey % 5 >= 2", "now"), "name", "full_outer")
    return control.drift(pairs).select("name", F.array_join("issues", "; ").alias("issues"), "state")


def signal_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest event of each type as a signal, its state after the freshness rule at a fixed time."""
    names = F.element_at(F.array(*[F.lit(s) for s in control.FRESHNESS_HOURS]), (F.col("user_id") % 6 + 1).cast("int"))
    rows = table(spark, sf_dir, "events").groupBy(names.alias("signal")).agg(F.max("ts").cast("timestamp").alias("generated_at")).withColumn("state", F.lit("green"))
    return control.freshness(rows, F.to_timestamp(F.lit(NOW))).select("signal", "age_hours", "effective")


def overall_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overall state of each user's events."""
    state = F.element_at(F.array(*[F.lit(s) for s in control.PRECEDENCE]), (F.col("event_id") % 4 + 1).cast("int"))
    rows = table(spark, sf_dir, "events").select("user_id", F.when(F.col("user_id") % 5 > 1, F.when(F.col("event_id") % 4 < 2, "unknown").otherwise("green")).otherwise(state).alias("effective"))
    return control.overall(rows, by=["user_id"])


def _steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcome = F.element_at(F.array(*[F.lit(s) for s in ("success", "failure", "cancelled", "")]), (F.col("l_partkey") % 4 + 1).cast("int"))
    name = F.when(F.col("l_linenumber") == 1, "Set up job").when(F.col("l_linenumber") == 7, "Post checkout").otherwise(F.concat(F.col("l_returnflag"), F.lit(" / "), F.col("l_linestatus")))
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("run"), F.lit("job").alias("job_name"), (F.col("l_partkey") * 1_000_000 + F.col("l_suppkey")).alias("job_id"), F.col("l_linenumber").alias("number"), name.alias("name"), outcome.alias("conclusion"), F.lit("").alias("status"))


def stage_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stages of job runs, numbered over the steps that count."""
    return control.stages(_steps(spark, sf_dir))


def replay_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What to do next per run, from its stages as checkpoints."""
    rows = control.stages(_steps(spark, sf_dir)).select(F.col("run").alias("workflow"), F.col("stage").alias("checkpoint"), "state", F.col("sequence").alias("updated_at"), F.col("stage").alias("checkpoint_id"))
    return control.replay(rows)


def model_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user: last, least loss and whether the last is within tolerance of the least."""
    rows = table(spark, sf_dir, "events").select("user_id", F.col("event_id").alias("ordinal"), F.col("event_id").alias("step"), F.when(F.col("event_type") != "view", F.col("value")).alias("val_loss"))
    got = control.last_losses(rows, "user_id")
    return got.withColumn("gate", control.model_gate(F.col("last_val_loss"), F.col("min_val_loss")))


def rollback_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per customer the order to roll back to."""
    rows = table(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderkey").alias("model_id"), F.when(F.col("o_orderstatus") == "F", "production").otherwise("dev").alias("publication_state"), (F.col("o_orderkey") % 100).alias("release_sequence"), F.col("o_orderdate").alias("promoted_at"))
    return control.rollback_target(rows, F.lit(-1), ["o_custkey"])


def promotions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Made-up promotion requests by state and issues."""
    states = F.array(*[F.lit(s) for s in ("dev", "validated", "candidate", "production", "rolled_back")])
    light = lambda k: F.when(F.col("o_orderkey") % k == 0, "red").otherwise("green")
    rows = table(spark, sf_dir, "orders").select(F.element_at(states, (F.col("o_custkey") % 5 + 1).cast("int")).alias("current"), F.element_at(states, (F.col("o_orderkey") % 4 + 1).cast("int")).alias("target"), light(7).alias("compatibility"), light(11).alias("evaluation"), light(13).alias("readiness"), F.col("o_orderpriority").alias("model_id"), F.sha2("o_orderpriority", 256).alias("artifact_sha256"), F.lit("x").alias("evaluation_evidence_sha256"), F.lit("me").alias("approval_identity"), F.lit(1).alias("release_sequence"), F.lit("2024-01-01T00:00:00Z").alias("promoted_at"))
    return control.promotion_issues(rows).groupBy("current", "target", "state", F.size("issues").alias("n_issues")).agg(F.count("*").alias("n"))


def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of documents with a secret, one planted in every 50th; counted by kind."""
    text = F.concat("text", F.when(F.col("doc_id") % 50 == 0, F.concat(F.lit("\nkey AKIA"), F.upper(F.substring(F.md5(F.col("doc_id").cast("string")), 1, 16)), F.lit(" end\nhttps://u:p@h.example/x"))).otherwise(""))
    return control.secrets(table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("path"), text.alias("content"))).groupBy("kind").agg(F.count("*").alias("n"), F.count_distinct("path").alias("files"))


def file_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("path"), F.sha2("p_name", 256).alias("sha256"), "p_partkey")
    now = rows.where("p_partkey % 5 > 0").select("path", F.when(F.col("p_partkey") % 7 == 0, "0").otherwise(F.col("sha256")).alias("sha256"))
    return control.compare_files(rows.where("p_partkey % 6 > 0").select("path", "sha256"), now).groupBy("change").agg(F.count("*").alias("n"))


def part_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which part file of 10,000 rows each order key falls in, and the size of each part."""
    keys = table(spark, sf_dir, "lineitem").select("l_orderkey").distinct()
    return corpus.numbered(keys, "l_orderkey").groupBy(F.floor(F.col("n") / 10_000).alias("part")).agg(F.count("*").alias("n_rows"), F.min("l_orderkey").alias("first"), F.max("l_orderkey").alias("last"))


QUERIES = {f.__name__: f for f in (dictionary_enrich, normalize_names, person_shapes, roles, decision_records, validate_ratio, duplicate_records, quarantined, corpus_lines, corpus_sizes, record_lines, chunk_packing, html_to_text, hosts, pending_docs, resource_diff, title_rank, catalog_page, last_failures, drift_profile, signal_freshness, overall_state, stage_sequence, replay_plan, model_gate, rollback_target, promotions, secret_scan, file_changes, part_files)}

_KEYWORDS = ", ".join("'" + w.replace("'", "''") + "'" for w in T.ORG_KEYWORDS)
_SENTINELS = ", ".join(f"'{w}'" for w in T.SENTINEL_NAMES)
_STEPS = """
st AS (SELECT l_orderkey AS run, l_partkey * 1000000 + l_suppkey AS job_id, l_linenumber AS number, l_returnflag || ' / ' || l_linestatus AS name,
  CASE l_partkey % 4 WHEN 0 THEN 'succeeded' WHEN 1 THEN 'failed' WHEN 2 THEN 'paused' ELSE 'running' END AS state FROM lineitem WHERE l_linenumber NOT IN (1, 7)),
sq AS (SELECT run, row_number() OVER (PARTITION BY run ORDER BY job_id, number) AS sequence, name, state FROM st),
sg AS (SELECT run, sequence, 'stage-' || lpad(cast(sequence AS VARCHAR), 3, '0') || '-' || substr(trim(regexp_replace(lower(name), '[^a-z0-9]+', '-', 'g'), '-'), 1, 80) AS stage, state FROM sq)"""

SQL = {
    "dictionary_enrich": "SELECT rec_id, json_extract_string(extra, '$.court_code') AS court_code, n_name AS court_name FROM edrsr_records LEFT JOIN nation ON json_extract_string(extra, '$.court_code') = cast(n_nationkey + 200 AS VARCHAR)",
    "normalize_names": r"""
WITH r AS (SELECT upper(trim(regexp_replace(regexp_replace(replace(translate(name, 'ʼ’', ''''''), 'ß', 'ss'), '[\s\x{00a0}\x{0085}]+', ' ', 'g'), '^ | $', '', 'g'))) AS normal, length(regexp_replace(name, '[^0-9]', '', 'g')) AS d FROM mentions WHERE name IS NOT NULL)
SELECT normal, count(*) AS n, sum(d)::BIGINT AS digits FROM r GROUP BY 1""",
    "person_shapes": f"""
WITH r AS (SELECT upper(translate(value, '''ʼ’`', '')) AS v, regexp_extract_all(upper(translate(value, '''ʼ’`', '')), '[A-ZА-ЯЄІЇҐ]+') AS t FROM entities WHERE type = 'name'),
s AS (SELECT v, t, len(t) BETWEEN 2 AND 4 AND NOT list_has_any(t, [{_KEYWORDS}]) AND NOT regexp_matches(v, '[0-9]') AS ok FROM r)
SELECT ok AND (len(t) <> 3 OR regexp_matches(t[len(t)], '(ОВИЧ|ЄВИЧ|ІВНА|ЇВНА|ІВИЧ|ОВНА|ИЧ|ВИЧ|ВНА)$')) AS person, ok AND v NOT IN ({_SENTINELS}) AS candidate, count(*) AS n FROM s GROUP BY 1, 2""",
    "roles": "SELECT c_custkey, c_name AS name, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment ELSE '' END AS role FROM customer",
    "decision_records": """
SELECT nullif(trim(court), '') AS court, count(nullif(trim(case_number), '')) AS n_case_number, count(nullif(trim(document_id), '')) AS n_document_id, count(nullif(trim(decision_date), '')) AS n_decision_date, CAST(0 AS BIGINT) AS n_publication_date,
  count(nullif(trim(judge), '')) AS n_judge, count(nullif(trim(text), '')) AS n_text, count(*) AS n_extra FROM edrsr_records GROUP BY 1""",
    "validate_ratio": "SELECT count(*) AS total, count(*) FILTER (length(trim(text)) BETWEEN 1 AND 119) AS invalid, count(*) FILTER (length(trim(text)) BETWEEN 1 AND 119) / count(*)::DOUBLE AS ratio, count(*) FILTER (length(trim(text)) BETWEEN 1 AND 119) / count(*)::DOUBLE <= 0.01 AS passed FROM documents",
    "duplicate_records": "SELECT document_id, count(*) AS n FROM edrsr_records WHERE document_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
    "quarantined": "SELECT doc_id, 'text too short' AS problems FROM documents WHERE length(trim(text)) BETWEEN 1 AND 119",
    "corpus_lines": r"""
WITH l AS (SELECT DISTINCT trim(regexp_replace(text, '[\s\x{00a0}\x{2000}-\x{200a}\x{202f}\x{3000}]+', ' ', 'g')) AS line FROM documents WHERE text IS NOT NULL),
k AS (SELECT line, row_number() OVER (ORDER BY encode(line)) - 1 AS n, count(*) OVER () AS total FROM l WHERE length(line) BETWEEN 20 AND 600)
SELECT line FROM k WHERE n % greatest(1, total // 50) = 0""",
    "corpus_sizes": r"""
WITH l AS (SELECT doc_kind, trim(regexp_replace(text, '[\s\x{00a0}\x{2000}-\x{200a}\x{202f}\x{3000}]+', ' ', 'g')) AS line FROM documents)
SELECT doc_kind, count(*) AS written, count(DISTINCT line) AS lines FROM l WHERE length(line) BETWEEN 20 AND 600 GROUP BY 1""",
    "record_lines": """
WITH d AS (SELECT concat_ws(' ', CASE WHEN court <> '' THEN 'Суд: ' || court || '.' END, CASE WHEN case_number <> '' THEN 'Справа № ' || case_number || '.' END, CASE WHEN category <> '' THEN 'Категорія: ' || category || '.' END,
  CASE WHEN judge <> '' THEN 'Суддя: ' || judge || '.' END, CASE WHEN decision_date <> '' THEN 'Рішення від ' || substr(decision_date, 1, 10) || '.' END) AS line FROM edrsr_records
UNION ALL SELECT CASE WHEN coalesce(s_name, '') = '' THEN '' WHEN s_suppkey % 4 > 0 THEN s_name || '. Платник податку на додану вартість, реєстрація ' || CASE WHEN s_suppkey % 3 > 0 AND s_name <> '' THEN s_name ELSE 'невідома' END || ' (ІПН ' || s_suppkey || ').' ELSE s_name || '.' END FROM supplier
UNION ALL SELECT concat_ws(' ', 'ТОВ ' || s_name, 'ЄДРПОУ ' || s_suppkey || '.', 'Стан: зареєстровано.', 'Засновники: ' || s_name || '.', CASE WHEN s_name <> '' THEN 'Статут: ' || substr(s_name, 1, 220) || '.' END) FROM supplier)
SELECT line, count(*) AS n FROM d GROUP BY 1""",
    "html_to_text": r"""
WITH p AS (SELECT doc_id, '<html><style>p {color: red}</style><body><p class=''a''>' || replace(text, chr(10), '</p><p>') || '</p><script>if (1 > 0) {}</script>&copy; &amp;' || source || '</body></html>' AS page
  FROM documents WHERE text IS NOT NULL),
t AS (SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(page, '(?is)<style\b.*?</style\s*>', ' ', 'g'), '(?is)<script\b.*?</script\s*>', ' ', 'g'), '(?s)<[^>]+>', ' ', 'g'), '[\s\v\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g')) AS text FROM p)
SELECT doc_id, md5(trim(replace(replace(replace(replace(replace(text, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&copy;', '©'), '&amp;', '&'))) AS text_md5 FROM t""",
    "hosts": "SELECT coalesce(lower(regexp_extract(source_url, '^[a-zA-Z]+://([^/:?#]+)', 1)), '') AS host, count(*) AS n FROM provenance GROUP BY 1",
    "pending_docs": """
SELECT document_id, arg_min(source_url, rec_id) AS source_url FROM edrsr_records WHERE document_id IS NOT NULL AND regexp_matches(lower(split_part(source_url, '?', 1)), '(\\.rtf|\\.html|\\.txt)$')
  AND document_id NOT IN (SELECT document_id FROM edrsr_records WHERE text IS NOT NULL AND document_id IS NOT NULL) GROUP BY 1""".replace("\\\\", "\\"),
    "resource_diff": """
WITH o AS (SELECT o_orderkey AS k, 'https://H' || (o_custkey % 7) || '.example/' || o_orderkey AS url, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END AS hash, CASE WHEN o_orderkey % 5 > 0 THEN cast(o_orderdate AS VARCHAR) END AS lm, o_custkey AS size, 'h' || (o_custkey % 7) || '.example' AS host, o_custkey % 7 AS h FROM orders),
p AS (SELECT url AS u, CASE WHEN k % 8 = 1 THEN 'x' ELSE hash END AS ph, lm AS plm, CASE WHEN k % 8 = 2 THEN size + 1 ELSE size END AS psize FROM o WHERE k % 4 > 0),
j AS (SELECT o.*, p.*, coalesce(sum(CASE WHEN k % 97 = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY host ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS hits FROM o LEFT JOIN p ON url = u)
SELECT host, CASE WHEN h = 3 THEN 'blocked_unreachable' WHEN hits >= 3 THEN 'blocked_throttled' WHEN u IS NOT NULL AND (CASE WHEN coalesce(hash, '') <> '' THEN ph IS NOT DISTINCT FROM hash ELSE plm IS NOT DISTINCT FROM lm AND psize IS NOT DISTINCT FROM size END) THEN 'skip' ELSE 'download' END AS decision, count(*) AS n FROM j GROUP BY 1, 2""",
    "title_rank": """
WITH t(query, term) AS (VALUES ('a', 'green metal'), ('b', 'small red')),
s AS (SELECT query, p_partkey AS id, 10 * len(list_intersect(list_distinct(regexp_extract_all(lower(p_name), '[\\p{L}\\p{N}]+')), list_distinct(regexp_extract_all(term, '[\\p{L}\\p{N}]+')))) + CASE WHEN contains(lower(p_name), term) THEN 20 ELSE 0 END + least(p_size % 9, 5) AS score FROM part, t),
k AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, id) AS k FROM s)
SELECT query, id, score FROM k WHERE k = 1""".replace("\\\\", "\\"),
    "catalog_page": "SELECT c_custkey AS id, c_name AS name FROM customer ORDER BY lower(c_name), c_custkey LIMIT 10 OFFSET 20",
    "last_failures": "WITH k AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS k FROM events WHERE event_type IN ('error', 'click')) SELECT event_type, count(*) AS n, sum(event_id)::BIGINT AS ids FROM k WHERE k <= 3 GROUP BY 1",
    "drift_profile": """
WITH b AS (SELECT l_returnflag AS name, count(*) AS n, count(DISTINCT l_linestatus) AS d FROM lineitem WHERE l_orderkey % 5 < 2 GROUP BY 1), c AS (SELECT l_returnflag AS name, count(*) AS n, count(DISTINCT l_linestatus) AS d FROM lineitem WHERE l_orderkey % 5 >= 2 GROUP BY 1)
SELECT name, concat_ws('; ', CASE WHEN abs(c.n - b.n) / b.n::DOUBLE > 0.2 THEN 'row_count threshold exceeded' END, CASE WHEN b.d <> c.d THEN 'field_distributions changed' END) AS issues,
  CASE WHEN abs(c.n - b.n) / b.n::DOUBLE > 0.2 OR b.d <> c.d THEN 'red' ELSE 'green' END AS state FROM b JOIN c USING (name)""",
    "signal_freshness": f"""
WITH s AS (SELECT (['ingestion', 'quality', 'graph', 'training', 'publication', 'security'])[user_id % 6 + 1] AS signal, max(ts) AS made FROM events GROUP BY 1),
a AS (SELECT signal, (epoch_us(TIMESTAMP '{NOW}') - epoch_us(made)) / 1000000.0 AS sec, CASE WHEN signal IN ('graph', 'training') THEN 168 ELSE 48 END AS lim FROM s)
SELECT signal, round(sec / 3600, 2) AS age_hours, CASE WHEN sec < 0 OR sec > lim * 3600 THEN 'unknown' ELSE 'green' END AS effective FROM a""",
    "overall_state": """
WITH s AS (SELECT user_id, CASE WHEN user_id % 5 > 1 THEN CASE WHEN event_id % 4 < 2 THEN 0 ELSE 1 END ELSE event_id % 4 END AS p FROM events)
SELECT user_id, (['unknown', 'green', 'yellow', 'red'])[max(p) + 1] AS overall FROM s GROUP BY 1""",
    "stage_sequence": f"WITH {_STEPS} SELECT run, sequence, stage, state FROM sg",
    "replay_plan": f"""
WITH {_STEPS}
SELECT run AS workflow, count(*) AS n, count(*) FILTER (state = 'succeeded') AS trusted, arg_max(stage, sequence) FILTER (state = 'succeeded') AS last_trusted_stage,
  coalesce('resume-from:' || arg_max(stage, sequence) FILTER (state <> 'succeeded'), 'complete') AS next_action FROM sg GROUP BY 1""",
    "model_gate": """
WITH g AS (SELECT user_id, arg_max(value, event_id) FILTER (event_type <> 'view' AND value IS NOT NULL) AS last_val_loss, min(value) FILTER (event_type <> 'view') AS min_val_loss, max(event_id) AS last_step FROM events GROUP BY 1)
SELECT *, CASE WHEN last_val_loss IS NULL OR min_val_loss <= 0 THEN 'invalid' WHEN last_val_loss <= min_val_loss * 1.02::DOUBLE THEN 'green' ELSE 'red' END AS gate FROM g""",
    "rollback_target": "SELECT o_custkey, arg_max(o_orderkey, (o_orderkey % 100, o_orderdate, o_orderkey)) AS target FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 100 > 0 GROUP BY 1",
    "promotions": """
WITH r AS (SELECT (['dev', 'validated', 'candidate', 'production', 'rolled_back'])[o_custkey % 5 + 1] AS current, (['dev', 'validated', 'candidate', 'production'])[o_orderkey % 4 + 1] AS target, o_orderkey AS k FROM orders),
i AS (SELECT current, target, (CASE WHEN (current, target) IN (('dev', 'validated'), ('validated', 'candidate'), ('candidate', 'production'), ('rolled_back', 'validated')) THEN 0 ELSE 1 END
  + CASE WHEN target IN ('validated', 'candidate', 'production') AND k % 7 = 0 THEN 1 ELSE 0 END + CASE WHEN target IN ('candidate', 'production') AND k % 11 = 0 THEN 1 ELSE 0 END
  + CASE WHEN target = 'production' AND k % 13 = 0 THEN 1 ELSE 0 END + CASE WHEN target = 'production' THEN 1 ELSE 0 END)::INT AS n_issues FROM r)
SELECT current, target, CASE WHEN n_issues > 0 THEN 'red' ELSE 'green' END AS state, n_issues, count(*) AS n FROM i GROUP BY 1, 2, 3, 4""",
    "secret_scan": """
SELECT kind, count(*) AS n, count(*) AS files FROM (SELECT unnest(['aws_access_key', 'basic_auth_url']) AS kind FROM documents WHERE doc_id % 50 = 0 AND text IS NOT NULL) GROUP BY 1""",
    "file_changes": """
WITH b AS (SELECT p_partkey AS k FROM part WHERE p_partkey % 6 > 0), c AS (SELECT p_partkey AS k FROM part WHERE p_partkey % 5 > 0),
d AS (SELECT CASE WHEN b.k IS NULL THEN 'added' WHEN c.k IS NULL THEN 'removed' WHEN c.k % 7 = 0 THEN 'changed' END AS change FROM b FULL JOIN c ON b.k = c.k)
SELECT change, count(*) AS n FROM d WHERE change IS NOT NULL GROUP BY 1""",
    "part_files": "WITH k AS (SELECT l_orderkey, row_number() OVER (ORDER BY l_orderkey) - 1 AS n FROM (SELECT DISTINCT l_orderkey FROM lineitem)) SELECT n // 10000 AS part, count(*) AS n_rows, min(l_orderkey) AS first, max(l_orderkey) AS last FROM k GROUP BY 1",
}
