"""Queries over the graph's build, unknown registers, release contracts and the corpus build, with their SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import build, catalog, control, corpus, graph, guess, registers, release, resolve
from millrace.session import table

COMMIT = "c" * 40
NOW = "2024-07-01 00:00:00"


def _subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as company subjects: every 20th with a code that is none, founders of each shape."""
    key, name = F.col("s_suppkey"), F.col("s_name")
    code = F.when(key % 20 == 0, "00000000").when(key % 20 == 1, "none").otherwise((key + 40_000_000).cast("string"))
    founders = F.array(F.concat(name, F.lit(" - засновник; частка 50")), F.lit("ФІЗИЧНА ОСОБА"), (key + 50_000_000).cast("string"), F.concat(F.lit("Спільний "), (key % 7).cast("string")))
    return table(spark, sf_dir, "supplier").select(key.alias("seq"), code.alias("edrpou"), name.alias("name"), F.when(key % 3 == 0, "зареєстровано").alias("stan"), founders.alias("founders"), F.array(F.concat(F.lit("Спільний "), (key % 5).cast("string"))).alias("signers"))


def _payers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    code = F.concat((key + 40_000_000).cast("string"), F.repeat(F.lit("7"), (key % 5).cast("int")))
    return table(spark, sf_dir, "customer").select(key.alias("seq"), code.alias("code"), F.col("c_name").alias("name"), F.lit("2020-01-01").alias("dat_reestr"), F.lit(None).cast("string").alias("dat_term"))


def _people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as a JSON register: a name, and a code that may be a company's."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(key.alias("seq"), F.col("c_name").alias("FIO"), (key % 400 + 40_000_000).cast("string").alias("edrpou"), F.when(key % 2 == 0, F.lpad((key + 2_000_000_000).cast("string"), 10, "0")).alias("ipn"), key.cast("string").alias("regNum"))


def _decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("rec_id")
    text = F.concat(F.lit("Позов "), (key % 90 + 40_000_000).cast("string"), F.lit(" до "), (key * 7 % 90 + 40_000_000).cast("string"), F.lit(" від 01012020"))
    return table(spark, sf_dir, "edrsr_records").select(key.alias("seq"), "case_number", "document_id", "judge", "court", text.alias("text"))


def _graph(spark: SparkSession, sf_dir: str) -> build.Events:
    people = registers.Register("people", subject="org")  # no mapping of persons: read generically
    return build.build(_subjects(spark, sf_dir), _payers(spark, sf_dir), [(_people(spark, sf_dir), people, "json")], _decisions(spark, sf_dir))


def build_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The graph of companies, payers, a register and decisions, counted: (what, kind, dataset, n, total)."""
    made = _graph(spark, sf_dir)
    none = F.lit("")
    entities = made.entities.groupBy(F.lit("entity").alias("what"), F.col("type").alias("kind"), none.alias("dataset")).agg(F.count("*").alias("n"), F.count("title").alias("total"))
    mentions = made.mentions.groupBy(F.lit("mention").alias("what"), none.alias("kind"), "dataset").agg(F.count("*").alias("n"), F.count("name").alias("total"))
    edges = made.edges.groupBy(F.lit("edge").alias("what"), "kind", "dataset").agg(F.count("*").alias("n"), F.sum("weight").alias("total"))
    return entities.unionByName(mentions).unionByName(edges)


def build_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company pairs and their weight as decisions name them together, by code."""
    made = _graph(spark, sf_dir)
    value = made.entities.select("entity_id", "value")
    pairs = made.edges.where("kind = 'co_litigant'").join(value.select(F.col("entity_id").alias("a"), F.col("value").alias("x")), "a").join(value.select(F.col("entity_id").alias("b"), F.col("value").alias("y")), "b")
    return pairs.select(F.least("x", "y").alias("code_a"), F.greatest("x", "y").alias("code_b"), "weight")


def add_people_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of registers of which one has no mapping, one is switched off and one can't be read."""
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("seq"), F.col("c_name").alias("PIB"), F.lpad((F.col("c_custkey") + 2_000_000_000).cast("string"), 10, "0").alias("IPN"), F.when(F.col("c_custkey") % 4 == 0, (F.col("c_custkey") + 40_000_000).cast("string")).alias("EDRPOU"))
    fields = {"person": ["ПІБ", "PIB"], "ipn": ["IPN"], "edrpou": ["EDRPOU"]}
    mapping = {n: registers.Register(n, fields, enabled=n != "off") for n in ("experts", "off", "broken")}
    _, total, _ = build.add_people({"experts": lambda: rows, "off": lambda: rows, "unknown": lambda: rows, "broken": lambda: spark.read.parquet(f"{sf_dir}/no-such-register.parquet")}, mapping)
    return spark.createDataFrame([(k, v) for k, v in total.items()], "what string, n long")


def card_of_hub(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All that is known about the entity with the most mentions."""
    mentions = table(spark, sf_dir, "mentions")
    start = mentions.groupBy("entity_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "entity_id").limit(1).select("entity_id")
    return graph.card(table(spark, sf_dir, "entities"), mentions, table(spark, sf_dir, "edges").where("a != b"), start, depth=1).select("section", "entity_id", "kind", "dataset", "n")


def co_org_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many companies, people and pairs the co-organisation operator meets, and how many groups its guard leaves out."""
    return graph.co_org_counters(table(spark, sf_dir, "edges"), table(spark, sf_dir, "entities"), max_group=6)


_SURNAMES, _GIVEN, _FATHERS = ("ШЕВЧУК", "БОЙКО", "ТКАЧ", "МОРОЗ", "КРАВЕЦЬ"), ("ІВАН", "ОЛЕГ", "ПЕТРО", "І"), ("ІВАНОВИЧ", "ПЕТРОВИЧ", "")


def _made_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Made-up people: names by customers, tax-number holders by suppliers; surnames are common or a holder's own."""
    pick = lambda values, key: F.element_at(F.array(*[F.lit(v) for v in values]), (key % len(values) + 1).cast("int"))
    surname = lambda key: F.concat(pick(_SURNAMES, key), F.translate((key % 40).cast("string"), "0123456789", "АБВГДЕЖЗИК"))
    full = lambda key: F.trim(F.concat_ws(" ", surname(key), pick(_GIVEN, F.floor(key / 2)), pick(_FATHERS, F.floor(key / 3))))
    c, s = F.col("c_custkey"), F.col("s_suppkey")
    names = table(spark, sf_dir, "customer").select(c.alias("entity_id"), F.lit("name").alias("type"), full(c).alias("value"), F.lit(None).cast("string").alias("title"))
    return names.unionByName(table(spark, sf_dir, "supplier").select((s + 10_000_000).alias("entity_id"), F.lit("ipn").alias("type"), (s + 2_000_000_000).cast("string").alias("value"), full(s).alias("title")))


def link_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Made-up names linked to the holder that fits clearly best; some are linked already."""
    done = table(spark, sf_dir, "customer").where("c_custkey % 11 = 0").select(F.col("c_custkey").alias("a"), (F.col("c_custkey") + 10_000_000).alias("b"), F.lit("identity").alias("kind"), F.lit("name_resolve").alias("dataset"))
    return resolve.link_names(_made_up(spark, sf_dir), done).select("name_id", "ipn_id", F.round("score", 6).alias("score"))


def link_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Made-up names that agree within a shared made-up company, across registers."""
    people = _made_up(spark, sf_dir).where("type = 'name'")
    companies = spark.range(60).select((F.col("id") + 20_000_000).alias("entity_id"), F.lit("edrpou").alias("type"), F.col("id").cast("string").alias("value"), F.lit(None).cast("string").alias("title"))
    edge = lambda key: people.select(F.col("entity_id").alias("a"), (key % 60 + 20_000_000).alias("b"), F.lit("founder").alias("kind"), F.lit("edr").alias("dataset"))
    edges = edge(F.floor(F.col("entity_id") / 9)).unionByName(edge(F.floor(F.col("entity_id") / 7)))
    mentions = people.select("entity_id", F.concat(F.lit("d"), (F.col("entity_id") % 3).cast("string")).alias("dataset"))
    return resolve.link_context(people.unionByName(companies), edges, mentions).select("a", "b", F.round("score", 6).alias("score"), "companies")


def _coded(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("doc_id")
    text = F.concat("text", F.lit(" ЄДРПОУ "), (key % 150 + 40_000_000).cast("string"), F.lit(", "), (key * 7 % 150 + 40_000_000).cast("string"), F.lit(", 400000001 від 01012020"))
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(T.company_codes(text)).alias("code")).join(_known(spark, sf_dir), "code", "left_semi")


def _known(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").where("s_suppkey < 150").select((F.col("s_suppkey") + 40_000_000).cast("string").alias("code"))


def extract_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known company codes in documents that name two each; dates and longer numbers are none."""
    return _coded(spark, sf_dir).select("doc_id", "code")


def co_mentioned_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known company codes named together in one document, counted over documents."""
    return graph.co_mentions(_coded(spark, sf_dir).groupBy("doc_id").agg(F.collect_set("code").alias("codes")), "doc_id", "codes")


def guessed_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is recognised in rows of a register of unknown headings."""
    key = F.col("c_custkey")
    odd = F.when(key % 4 == 0, (key + 2_000_000_000).cast("string")).when(key % 4 == 1, (key + 40_000_000).cast("string")).when(key % 4 == 2, F.concat((key % 150 + 40_000_000).cast("string"), F.lit("12345"))).otherwise("01012020")
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.create_map(F.lit("Дата"), F.lit("01.01.2020"), F.lit("П.І.Б."), F.col("c_name"), F.lit("Код"), odd, F.lit("Назва"), F.col("c_mktsegment"), F.lit("license"), F.when(key % 3 > 0, key.cast("string"))).alias("row"))
    known = table(spark, sf_dir, "supplier").where("s_suppkey < 150").select((F.col("s_suppkey") + 40_000_000).cast("string").alias("edrpou"))
    return guess.canonical_fields(rows, known).select("c_custkey", "found.*")


def _signals(spark: SparkSession) -> DataFrame:
    rows = [
        ("ingestion.json", True, 1, "ingestion", COMMIT, "green", "ok", "2024-06-30T00:00:00Z"), ("quality.json", True, 1, "quality", COMMIT, "green", "ok", "2024-06-28T23:00:00Z"),
        ("graph.json", True, 1, "graph", "d" * 40, "green", "ok", "2024-06-30T00:00:00Z"), ("training.json", True, 1, "training", COMMIT, "fine", "ok", "2024-06-30T00:00:00Z"),
        ("publication.json", False, None, None, None, None, None, None), ("other.json", True, 1, "other", COMMIT, "red", "", "2024-06-30T00:00:00Z"),
    ]
    return spark.createDataFrame(rows, "file string, valid boolean, schema_version long, signal string, source_commit string, state string, detail string, generated_at string")


def status_signals(spark: SparkSession, sf_dir: str) -> DataFrame:  # noqa: ARG001
    """Signals by the rules of the status index: fresh, stale, of another commit, without a valid state, broken, missing."""
    return release.signal_states(_signals(spark), COMMIT, F.lit(NOW).cast("timestamp"))


def status_overall(spark: SparkSession, sf_dir: str) -> DataFrame:  # noqa: ARG001
    return release.status_index(release.signal_states(_signals(spark), COMMIT, F.lit(NOW).cast("timestamp"))).select("overall_state", F.size("signals").alias("n"))


def _entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    path = F.when(key % 50 == 0, "").when(key % 50 == 1, F.concat(F.lit(".git/"), key.cast("string"))).when(key % 50 == 2, F.concat(F.lit("f"), (key % 100).cast("string"))).otherwise(F.concat(F.lit("p"), key.cast("string")))
    return table(spark, sf_dir, "part").select(key.alias("at"), path.alias("path"), F.when(key % 30 == 0, "x").otherwise(F.sha2("p_name", 256)).alias("sha256"), F.when(key % 40 != 0, F.col("p_size")).alias("bytes"), "p_name")


def manifest_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as entries of a release manifest: missing, repeated and excluded paths, broken checksums and sizes."""
    return release.manifest_issues(_entries(spark, sf_dir))


def chain_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as files that manifests name and bind: what is missing or differs, counted."""
    rows = _entries(spark, sf_dir).where("path like 'p%'")
    files = rows.where("at % 7 > 0").select("path", F.sha2("p_name", 256).alias("sha256"), F.coalesce("bytes", F.lit(0)).cast("long").alias("bytes"))
    found = release.chain_issues(rows.where("at % 9 = 0").select("path"), files, rows.select("path", "sha256"), rows.where("at % 3 = 0").select("path", "sha256", F.col("bytes").cast("long").alias("bytes")))
    return found.groupBy(F.substring_index("issue", ":", 1).alias("what")).agg(F.count("*").alias("n"))


def compat_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as pairs of model and dataset: which of revision and schema differ."""
    key = F.col("o_orderkey")
    pairs = table(spark, sf_dir, "orders").select((key % 7).cast("string").alias("model_revision"), (key % 5).cast("string").alias("model_schema"), F.when(key % 11 > 0, (key % 7).cast("string")).alias("data_revision"), (key % 10 % 5 + F.when(key % 13 == 0, 1).otherwise(0)).cast("string").alias("data_schema"))
    return release.compat_issues(pairs).groupBy("state", F.array_join("issues", "; ").alias("issues")).agg(F.count("*").alias("n"))


def readiness_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user: red if any of its events is, else yellow if any is."""
    state = F.when((F.col("user_id") % 9 == 0) & (F.col("event_id") % 3 == 0), None).when((F.col("user_id") % 5 == 0) & (F.col("event_id") % 4 == 0), "yellow").otherwise("green")
    return release.readiness(table(spark, sf_dir, "events").select("user_id", state.alias("state")), ["user_id"]).groupBy("overall").agg(F.count("*").alias("n"))


def hardening_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:  # noqa: ARG001
    """Every contract run on its fixture."""
    return release.evidence(spark)


def sync_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as datasets and customers' hosts as sources: what a batch did, in one row."""
    n = lambda k: F.array_repeat(F.lit("x"), (F.col("o_orderkey") % k).cast("int"))
    decisions = table(spark, sf_dir, "orders").select(n(4).alias("files"), n(3).alias("failed"), F.when(F.col("o_orderkey") % 5 > 0, n(2)).alias("blocked"))
    health = table(spark, sf_dir, "nation").select(F.concat(F.lit("h"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("host"), (F.col("n_nationkey") % 4 > 0).alias("reachable"), (F.col("n_nationkey") % 6 == 1).alias("throttled"))
    got = catalog.batch_summary(decisions, health)
    return got.withColumns({c: F.array_join(c, ",") for c in ("unreachable_hosts", "throttled_hosts")})


def curated_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as curated datasets: the enabled ones by priority, with their http addresses."""
    key = F.col("n_nationkey")
    rows = table(spark, sf_dir, "nation").select(F.col("n_name").alias("id"), (key % 6 > 0).alias("enabled"), F.when(key % 4 > 0, key % 5).cast("int").alias("priority"), F.array(F.concat(F.lit("https://x/"), key.cast("string")), F.lit("ftp://x")).alias("urls"))
    return corpus.numbered(catalog.curated(rows).select(F.struct(F.coalesce("priority", F.lit(99)).alias("p"), "id").alias("o"), F.element_at("urls", 1).alias("url"), F.size("urls").alias("n_urls")), "o").select("n", F.col("o.id").alias("id"), "url", "n_urls")


def progress_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as states of a mirror: what of the finished batches still counts."""
    key = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select((key % 6).alias("kind"), F.array((key % 9).cast("int"), (key % 4).cast("int"), (key % 4).cast("int")).alias("done"), F.lit(8).alias("count"), F.when(key % 6 == 1, 7).when(key % 6 != 2, 8).alias("old_count"), F.when(key % 6 == 3, "y").when(key % 6 != 4, "x").alias("old"))
    left = catalog.progress(F.col("done"), F.col("count"), F.lit("x"), F.col("old_count"), F.col("old"))
    return rows.groupBy("kind", F.array_join(left, ",").alias("kept")).agg(F.count("*").alias("n"))


def throttle_counter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as resources of a host a user: how many are blocked once a host was throttled twice."""
    rows = table(spark, sf_dir, "events").select(F.col("event_id").alias("ordinal"), F.concat(F.lit("https://h"), (F.col("user_id") % 20).cast("string"), F.lit(".example/"), F.col("event_id").cast("string")).alias("url"), F.lit(None).cast("string").alias("hash"), F.lit(None).cast("string").alias("last_modified"), F.lit(None).cast("long").alias("size"), (F.col("event_type") == "error").alias("throttled"))
    prior = rows.limit(0).select("url", "hash", "last_modified", "size")
    hosts = spark.createDataFrame([], "host string, reachable boolean")
    return catalog.sync_decisions(rows, prior, hosts, halt_after=2).groupBy("host", "decision").agg(F.count("*").alias("n"))


def _sources(spark: SparkSession, sf_dir: str) -> dict[str, tuple[DataFrame, int | None]]:
    c: type[Column] = F.col
    decisions = table(spark, sf_dir, "edrsr_records").select(c("rec_id").alias("seq"), corpus.decision_line(c("court"), c("case_number"), c("category"), c("judge"), c("decision_date")).alias("line"))
    payers = table(spark, sf_dir, "supplier").select(c("s_suppkey").alias("seq"), corpus.vat_line(c("s_name"), c("s_suppkey").cast("string"), F.lit(None).cast("string")).alias("line"))
    texts = table(spark, sf_dir, "documents").select(c("doc_id").alias("seq"), corpus.text_line(F.lit("Документ."), c("text")).alias("line"))
    return {"decisions": (decisions, 700), "payers": (payers, None), "texts": (texts, None)}


def corpus_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of a corpus built from decisions (the first 700, as a source's limit), payers and texts."""
    return corpus.build(_sources(spark, sf_dir), target=100)[1].where("source != ''")


def corpus_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each word occurs in the decisions' and payers' lines."""
    lines = reduce(DataFrame.unionByName, [rows for rows, _ in list(_sources(spark, sf_dir).values())[:2]])
    return corpus.word_counts(lines)


def validation_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as chunks in order: which are held out for validation."""
    held, rest = corpus.split_validation(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey")
    one = lambda df, name: df.agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first"), F.max("o_orderkey").alias("last")).select(F.lit(name).alias("part"), "n", "first", "last")
    return one(held, "validation").unionByName(one(rest, "training"))


QUERIES = {f.__name__: f for f in (build_graph, build_edges, add_people_totals, card_of_hub, co_org_counts, link_names, link_context, extract_codes, co_mentioned_codes, guessed_fields, status_signals, status_overall, manifest_problems, chain_problems, compat_states, readiness_states, hardening_evidence, sync_summary, curated_order, progress_states, throttle_counter, corpus_build, corpus_words, validation_split)}

_GRAPH = """
su AS (SELECT s_suppkey AS k, s_name AS name, cast(s_suppkey + 40000000 AS VARCHAR) AS code FROM supplier WHERE s_suppkey % 20 > 1),
ep AS (SELECT code, who, kind FROM (SELECT code, name AS who, 'founder' AS kind FROM su UNION ALL SELECT code, 'Спільний ' || k % 7, 'founder' FROM su UNION ALL SELECT code, 'Спільний ' || k % 5, 'signer' FROM su) WHERE who <> ''),
pa AS (SELECT cast(c_custkey + 40000000 AS VARCHAR) || repeat('7', cast(c_custkey % 5 AS INT)) AS code, c_name AS name FROM customer),
pv AS (SELECT p.code, p.name, s.code AS known, CASE WHEN s.code IS NOT NULL THEN 'edrpou' WHEN length(p.code) >= 10 THEN 'ipn' ELSE 'edrpou' END AS type,
  CASE WHEN s.code IS NOT NULL THEN s.code WHEN length(p.code) >= 10 THEN substr(p.code, 1, 10) ELSE substr(p.code, 1, 8) END AS value FROM pa p LEFT JOIN su s ON substr(p.code, 1, 8) = s.code),
re AS (SELECT c_name AS name, cast(c_custkey % 400 + 40000000 AS VARCHAR) AS code, CASE WHEN c_custkey % 2 = 0 THEN lpad(cast(c_custkey + 2000000000 AS VARCHAR), 10, '0') END AS ipn FROM customer WHERE c_name <> ''),
de AS (SELECT rec_id AS k, coalesce(nullif(case_number, ''), nullif(document_id, ''), '') AS ref, coalesce(nullif(trim(judge), ''), '') AS judge, coalesce(nullif(trim(court), ''), '') AS court,
  cast(rec_id % 90 + 40000000 AS VARCHAR) AS x, cast(rec_id * 7 % 90 + 40000000 AS VARCHAR) AS y FROM edrsr_records),
dc AS (SELECT DISTINCT k, code FROM (SELECT k, x AS code FROM de UNION ALL SELECT k, y FROM de) WHERE code IN (SELECT code FROM su)),
dn AS (SELECT *, upper(trim(regexp_replace(translate(judge, 'ʼ’', ''''''), '[\\s\\x{a0}]+', ' ', 'g'))) AS j, upper(trim(regexp_replace(translate(court, 'ʼ’', ''''''), '[\\s\\x{a0}]+', ' ', 'g'))) AS c FROM de WHERE judge <> '' AND court <> ''),
en AS (SELECT 'edrpou' AS type, code AS value, name AS title FROM su UNION ALL SELECT 'name', upper(who), who FROM ep
  UNION ALL SELECT type, value, name FROM pv WHERE known IS NULL UNION ALL SELECT 'name', upper(name), name FROM re UNION ALL SELECT 'ipn', ipn, NULL FROM re WHERE ipn IS NOT NULL
  UNION ALL SELECT 'name', j, judge FROM dn UNION ALL SELECT 'name', c, court FROM dn),
me AS (SELECT 'edr' AS dataset, name FROM su UNION ALL SELECT 'vat_payers', name FROM pv UNION ALL SELECT 'people', name FROM re UNION ALL SELECT 'edrsr', judge FROM dn WHERE ref <> '' UNION ALL SELECT 'edrsr', NULL FROM dc),
ed AS (SELECT 'name:' || upper(who) AS a, 'edrpou:' || code AS b, kind, 'edr' AS dataset FROM ep
  UNION ALL SELECT 'name:' || upper(name), 'edrpou:' || code, 'linked', 'people' FROM re WHERE code IN (SELECT code FROM su) UNION ALL SELECT 'name:' || upper(name), 'ipn:' || ipn, 'linked', 'people' FROM re WHERE ipn IS NOT NULL
  UNION ALL SELECT 'name:' || j, 'name:' || c, 'judges_in', 'edrsr' FROM dn WHERE j <> c UNION ALL SELECT 'edrpou:' || p.code, 'edrpou:' || q.code, 'co_litigant', 'edrsr' FROM dc p JOIN dc q ON p.k = q.k AND p.code < q.code)"""
_PEOPLE = """
pe AS (SELECT id, type, regexp_extract_all(shown, '[A-ZА-ЯЄІЇҐ]+') AS t FROM (
  SELECT id, type, (['ШЕВЧУК', 'БОЙКО', 'ТКАЧ', 'МОРОЗ', 'КРАВЕЦЬ'])[k % 5 + 1] || translate(cast(k % 40 AS VARCHAR), '0123456789', 'АБВГДЕЖЗИК') || ' ' || (['ІВАН', 'ОЛЕГ', 'ПЕТРО', 'І'])[k // 2 % 4 + 1] || ' ' || (['ІВАНОВИЧ', 'ПЕТРОВИЧ', ''])[k // 3 % 3 + 1] AS shown
  FROM (SELECT c_custkey AS k, c_custkey AS id, 'name' AS type FROM customer UNION ALL SELECT s_suppkey, s_suppkey + 10000000, 'ipn' FROM supplier)))"""
_AGREE = "CASE WHEN x.t[{0}] = y.t[{0}] THEN 1.0::DOUBLE WHEN length(x.t[{0}]) = 1 AND length(y.t[{0}]) > 1 AND x.t[{0}] = substr(y.t[{0}], 1, 1) THEN 0.9::DOUBLE WHEN length(y.t[{0}]) = 1 AND length(x.t[{0}]) > 1 AND y.t[{0}] = substr(x.t[{0}], 1, 1) THEN 0.9::DOUBLE END"
_BASE = f"(0.5::DOUBLE + 0.35::DOUBLE * ({_AGREE.format(2)}))"
_CODES = """
k AS (SELECT cast(s_suppkey + 40000000 AS VARCHAR) AS code FROM supplier WHERE s_suppkey < 150),
d AS (SELECT DISTINCT doc_id, code FROM (SELECT doc_id, unnest(regexp_extract_all(text || ' ЄДРПОУ ' || (doc_id % 150 + 40000000) || ', ' || (doc_id * 7 % 150 + 40000000) || ', 400000001 від 01012020', '[0-9]+')) AS code FROM documents) WHERE length(code) = 8 AND code IN (SELECT code FROM k))"""
_ENTRIES = """
e AS (SELECT p_partkey AS k, CASE p_partkey % 50 WHEN 0 THEN '' WHEN 1 THEN '.git/' || p_partkey WHEN 2 THEN 'f' || p_partkey % 100 ELSE 'p' || p_partkey END AS path, CASE WHEN p_partkey % 30 = 0 THEN 'x' ELSE sha256(p_name) END AS sha, CASE WHEN p_partkey % 40 <> 0 THEN p_size END AS bytes, sha256(p_name) AS own FROM part)"""
_LINES = """
l AS (SELECT * FROM (
  SELECT 'decisions' AS source, concat_ws(' ', CASE WHEN court <> '' THEN 'Суд: ' || court || '.' END, CASE WHEN case_number <> '' THEN 'Справа № ' || case_number || '.' END, CASE WHEN category <> '' THEN 'Категорія: ' || category || '.' END,
    CASE WHEN judge <> '' THEN 'Суддя: ' || judge || '.' END, CASE WHEN decision_date <> '' THEN 'Рішення від ' || substr(decision_date, 1, 10) || '.' END) AS line, rec_id AS seq FROM edrsr_records
  UNION ALL SELECT 'payers', s_name || '. Платник податку на додану вартість, реєстрація невідома (ІПН ' || s_suppkey || ').', s_suppkey FROM supplier WHERE s_name <> ''
  UNION ALL SELECT 'texts', 'Документ. ' || substr(trim(text, ' '), 1, 2500), doc_id FROM documents WHERE length(trim(text, ' ')) >= 200) WHERE line <> '')"""

SQL = {
    "build_graph": f"""
WITH {_GRAPH},
e2 AS (SELECT least(a, b) AS a, greatest(a, b) AS b, kind, dataset, count(*) AS w FROM ed GROUP BY 1, 2, 3, 4)
SELECT 'entity' AS what, type AS kind, '' AS dataset, count(*) AS n, count(title) AS total FROM (SELECT type, value, max(nullif(title, '')) AS title FROM en WHERE value <> '' GROUP BY 1, 2) GROUP BY type
UNION ALL SELECT 'mention', '', dataset, count(*), count(nullif(name, '')) FROM me GROUP BY dataset
UNION ALL SELECT 'edge', kind, dataset, count(*), sum(w)::BIGINT FROM e2 GROUP BY kind, dataset""",
    "build_edges": f"WITH {_GRAPH} SELECT substr(a, 8) AS code_a, substr(b, 8) AS code_b, count(*) AS weight FROM ed WHERE kind = 'co_litigant' GROUP BY 1, 2",
    "add_people_totals": """
SELECT unnest(['rows', 'people', 'identities', 'org_edges', 'failed', 'skipped']) AS what, unnest([count(*), count(*) FILTER (c_name <> ''), count(*), count(*) FILTER (c_custkey % 4 = 0), 1, 2]) AS n FROM customer""",
    "card_of_hub": """
WITH s AS (SELECT entity_id AS id FROM mentions GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
e AS (SELECT a AS src, b AS dst, kind, dataset, weight FROM edges WHERE a <> b UNION SELECT b, a, kind, dataset, weight FROM edges WHERE a <> b),
t AS (SELECT dst, e[1] AS kind, e[2] AS dataset, e[3] AS n FROM (SELECT dst, [kind, dataset, cast(weight AS VARCHAR)] AS e FROM (SELECT dst, kind, dataset, weight, row_number() OVER (PARTITION BY dst ORDER BY kind, dataset, weight NULLS FIRST) AS k FROM e WHERE src IN (SELECT id FROM s)) WHERE k = 1)),
u AS (SELECT dst, kind, dataset, cast(n AS BIGINT) AS n, row_number() OVER (ORDER BY cast(n AS BIGINT) DESC NULLS LAST, dst) AS k FROM t)
SELECT 'alias' AS section, dst AS entity_id, kind, dataset, weight AS n FROM e WHERE src IN (SELECT id FROM s) AND kind = 'identity' AND dst IN (SELECT entity_id FROM entities)
UNION ALL SELECT 'mention', entity_id, NULL, dataset, count(*) FROM mentions WHERE entity_id IN (SELECT id FROM s) GROUP BY 2, 4
UNION ALL SELECT 'neighbour', dst, kind, dataset, n FROM u WHERE k <= 30""",
    "co_org_counts": """
WITH c AS (SELECT entity_id FROM entities WHERE type = 'edrpou'),
m AS (SELECT DISTINCT CASE WHEN e.a IN (SELECT entity_id FROM c) THEN e.a ELSE e.b END AS company, CASE WHEN e.a IN (SELECT entity_id FROM c) THEN e.b ELSE e.a END AS person
  FROM edges e WHERE e.kind IN ('founder', 'signer', 'beneficial_owner', 'linked', 'works_at') AND e.a <> e.b AND (e.a IN (SELECT entity_id FROM c) OR e.b IN (SELECT entity_id FROM c))),
g AS (SELECT company, count(*) AS n FROM m WHERE person IN (SELECT entity_id FROM entities WHERE type = 'name') GROUP BY 1)
SELECT count(*) AS companies, coalesce(sum(n) FILTER (n > 1), 0)::BIGINT AS people, count(*) FILTER (n > 6) AS skipped, coalesce(sum(n * (n - 1) / 2) FILTER (n BETWEEN 2 AND 6), 0)::BIGINT AS pairs FROM g""",
    "link_names": f"""
WITH {_PEOPLE},
ok AS (SELECT *, len(t) <> 3 OR regexp_matches(t[3], '(ОВИЧ|ЄВИЧ|ІВНА|ЇВНА|ІВИЧ|ОВНА|ИЧ|ВИЧ|ВНА)$') AS pat FROM pe WHERE len(t) BETWEEN 2 AND 4),
s AS (SELECT x.id AS name_id, y.id AS ipn_id, CASE WHEN {_BASE} IS NULL THEN NULL WHEN len(x.t) > 2 AND len(y.t) > 2 THEN {_BASE} + 0.15::DOUBLE * ({_AGREE.format(3)}) WHEN len(x.t) > 2 OR len(y.t) > 2 THEN {_BASE} + 0.05::DOUBLE ELSE {_BASE} END AS score
  FROM ok x JOIN ok y ON x.t[1] = y.t[1] WHERE x.type = 'name' AND y.type = 'ipn' AND x.pat AND y.pat AND x.id NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 11 = 0)),
k AS (SELECT *, row_number() OVER w AS k, lead(score, 1, 0.0::DOUBLE) OVER w AS second FROM s WHERE score IS NOT NULL WINDOW w AS (PARTITION BY name_id ORDER BY score DESC, ipn_id))
SELECT name_id, ipn_id, round(score, 6) AS score FROM k WHERE k = 1 AND score >= 0.95 AND score - second >= 0.2""",
    "link_context": f"""
WITH {_PEOPLE},
p AS (SELECT *, len(t) <> 3 OR regexp_matches(t[3], '(ОВИЧ|ЄВИЧ|ІВНА|ЇВНА|ІВИЧ|ОВНА|ИЧ|ВИЧ|ВНА)$') AS pat FROM pe WHERE type = 'name' AND len(t) BETWEEN 2 AND 4),
m AS (SELECT DISTINCT * FROM (SELECT id, t, pat, id // 9 % 60 AS company FROM p UNION ALL SELECT id, t, pat, id // 7 % 60 FROM p)),
h AS (SELECT * FROM m WHERE company IN (SELECT company FROM m GROUP BY 1 HAVING count(*) BETWEEN 2 AND 40)),
z AS (SELECT x.company, x.id AS a, y.id AS b, x.pat OR y.pat AS anchored, CASE WHEN len(x.t) > 2 AND len(y.t) > 2 THEN {_BASE} + 0.15::DOUBLE * ({_AGREE.format(3)}) WHEN len(x.t) > 2 OR len(y.t) > 2 THEN {_BASE} + 0.05::DOUBLE ELSE {_BASE} END AS score
  FROM h x JOIN h y ON x.company = y.company AND x.t[1] = y.t[1] AND x.id <> y.id),
w AS (SELECT company, a, b, anchored, least(score, 1.0::DOUBLE) AS score FROM z WHERE score IS NOT NULL)
SELECT a, b, round(max(score), 6) AS score, count(*) AS companies FROM w WHERE a < b AND score >= 0.95 AND anchored AND a % 3 <> b % 3
  AND NOT EXISTS (SELECT 1 FROM w r WHERE r.company = w.company AND r.score >= w.score AND ((r.a = w.a AND r.b <> w.b) OR (r.a = w.b AND r.b <> w.a))) GROUP BY a, b""",
    "extract_codes": f"WITH {_CODES} SELECT doc_id, code FROM d",
    "co_mentioned_codes": f"WITH {_CODES} SELECT p.code AS a, q.code AS b, count(*) AS weight FROM d p JOIN d q ON p.doc_id = q.doc_id AND p.code < q.code GROUP BY 1, 2",
    "guessed_fields": """
SELECT c_custkey, c_name AS person, CASE WHEN c_custkey % 4 = 0 THEN cast(c_custkey + 2000000000 AS VARCHAR) ELSE '' END AS ipn,
  CASE WHEN c_custkey % 4 = 1 THEN cast(c_custkey + 40000000 AS VARCHAR) WHEN c_custkey % 4 = 2 AND c_custkey % 150 IN (SELECT s_suppkey FROM supplier) THEN cast(c_custkey % 150 + 40000000 AS VARCHAR) ELSE '' END AS edrpou,
  c_mktsegment AS org, CASE WHEN c_custkey % 3 > 0 THEN cast(c_custkey AS VARCHAR) ELSE '' END AS regnum FROM customer""",
    "status_signals": """
SELECT * FROM (VALUES ('ci', 'green', 'repository validation completed', NULL::DOUBLE), ('ingestion', 'green', 'ok', 24.0), ('quality', 'unknown', 'signal is stale (>48h)', NULL), ('graph', 'unknown', 'signal belongs to a different release commit', NULL),
  ('training', 'red', 'signal artifact has an invalid state', 24.0), ('publication', 'red', 'signal artifact is invalid JSON', NULL), ('security', 'unknown', 'no signal artifact recorded', NULL)) t(signal, state, detail, age_hours)""",
    "status_overall": "SELECT 'red' AS overall_state, 7 AS n",
    "manifest_problems": rf"""
WITH {_ENTRIES}, f AS (SELECT path, min(k) AS first FROM e WHERE path <> '' GROUP BY 1),
i AS (SELECT k, unnest(list_filter([CASE WHEN e.path = '' THEN 'has a missing path' WHEN k > first THEN 'has a duplicate path' WHEN starts_with(e.path, '.git/') THEN 'contains an excluded path' END, CASE WHEN NOT regexp_matches(sha, '^[0-9a-fA-F]{{64}}$') THEN 'has an invalid SHA-256' END, CASE WHEN bytes IS NULL THEN 'has an invalid byte size' END], lambda x: x IS NOT NULL)) AS what FROM e LEFT JOIN f ON e.path = f.path)
SELECT k AS "at", 'manifest file entry ' || k || ' ' || what AS issue FROM i""",
    "chain_problems": f"""
WITH {_ENTRIES}, r AS (SELECT * FROM e WHERE path LIKE 'p%'), i AS (
  SELECT 'missing artifact' AS what FROM r WHERE k % 9 = 0 AND k % 7 = 0
  UNION ALL SELECT CASE WHEN k % 7 = 0 THEN 'manifest file missing' ELSE 'manifest checksum mismatch' END FROM r WHERE k % 7 = 0 OR sha <> own
  UNION ALL SELECT 'bound artifact missing' FROM r WHERE k % 3 = 0 AND k % 7 = 0 UNION ALL SELECT 'bound artifact checksum mismatch' FROM r WHERE k % 3 = 0 AND k % 7 > 0 AND sha <> own
  UNION ALL SELECT 'bound artifact byte-size mismatch' FROM r WHERE k % 3 = 0 AND k % 7 > 0 AND bytes IS NULL)
SELECT what, count(*) AS n FROM i GROUP BY 1""",
    "compat_states": """
WITH p AS (SELECT o_orderkey % 11 = 0 AS r, (o_orderkey % 10 % 5 + CASE WHEN o_orderkey % 13 = 0 THEN 1 ELSE 0 END) <> o_orderkey % 5 AS s FROM orders)
SELECT CASE WHEN r OR s THEN 'red' ELSE 'green' END AS state, concat_ws('; ', CASE WHEN r THEN 'dataset revision mismatch' END, CASE WHEN s THEN 'schema hash mismatch' END) AS issues, count(*) AS n FROM p GROUP BY 1, 2""",
    "readiness_states": """
WITH u AS (SELECT user_id, bool_or(user_id % 9 = 0 AND event_id % 3 = 0) AS red, bool_or(user_id % 5 = 0 AND event_id % 4 = 0 AND NOT (user_id % 9 = 0 AND event_id % 3 = 0)) AS yellow FROM events GROUP BY 1)
SELECT CASE WHEN red THEN 'red' WHEN yellow THEN 'yellow' ELSE 'green' END AS overall, count(*) AS n FROM u GROUP BY 1""",
    "hardening_evidence": "SELECT * FROM (VALUES ('DRIFT-01', 'green'), ('QUAR-01', 'quarantined'), ('REG-01', 'green'), ('COMPAT-01', 'green'), ('PROM-01', 'green'), ('ROLL-01', 'green')) t(contract, state)",
    "sync_summary": """
SELECT count(*) AS datasets, sum(o_orderkey % 4)::BIGINT AS downloaded, sum(o_orderkey % 3)::BIGINT AS resource_failures, sum(CASE WHEN o_orderkey % 5 > 0 THEN o_orderkey % 2 ELSE 0 END)::BIGINT AS blocked_resources,
  (SELECT string_agg('h' || lpad(cast(n_nationkey AS VARCHAR), 2, '0'), ',' ORDER BY n_nationkey) FROM nation WHERE n_nationkey % 4 = 0) AS unreachable_hosts, (SELECT string_agg('h' || lpad(cast(n_nationkey AS VARCHAR), 2, '0'), ',' ORDER BY n_nationkey) FROM nation WHERE n_nationkey % 6 = 1) AS throttled_hosts FROM orders""",
    "curated_order": "SELECT row_number() OVER (ORDER BY CASE WHEN n_nationkey % 4 > 0 THEN n_nationkey % 5 ELSE 99 END, n_name) - 1 AS n, n_name AS id, 'https://x/' || n_nationkey AS url, 1 AS n_urls FROM nation WHERE n_nationkey % 6 > 0",
    "progress_states": """
WITH r AS (SELECT o_orderkey % 6 AS kind, o_orderkey % 9 AS x, o_orderkey % 4 AS y FROM orders)
SELECT kind, CASE WHEN kind BETWEEN 1 AND 4 OR x >= 8 THEN '' ELSE array_to_string(list_sort(list_distinct([x, y])), ',') END AS kept, count(*) AS n FROM r GROUP BY 1, 2""",
    "throttle_counter": """
WITH r AS (SELECT 'h' || user_id % 20 || '.example' AS host, coalesce(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id % 20 ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS hits FROM events)
SELECT host, CASE WHEN hits >= 2 THEN 'blocked_throttled' ELSE 'download' END AS decision, count(*) AS n FROM r GROUP BY 1, 2""",
    "corpus_build": rf"""
WITH {_LINES}, k AS (SELECT source, trim(regexp_replace(line, '[\s\x{{a0}}\x{{2000}}-\x{{200a}}\x{{202f}}\x{{3000}}]+', ' ', 'g')) AS line, row_number() OVER (PARTITION BY source ORDER BY seq) AS k FROM l)
SELECT source, count(*) AS written, count(*) FILTER (length(line) BETWEEN 20 AND 600) AS lines FROM k WHERE source <> 'decisions' OR k <= 700 GROUP BY 1""",
    "corpus_words": rf"""
WITH {_LINES}, w AS (SELECT unnest(string_split(trim(regexp_replace(line, '[\s\x{{a0}}\x{{2000}}-\x{{200a}}\x{{202f}}\x{{3000}}]+', ' ', 'g')), ' ')) AS word FROM l WHERE source <> 'texts')
SELECT word, count(*) AS n FROM w WHERE word <> '' GROUP BY 1""",
    "validation_split": """
WITH k AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS k, greatest(64, count(*) OVER () // 50) AS most FROM orders)
SELECT CASE WHEN k <= most THEN 'validation' ELSE 'training' END AS part, count(*) AS n, min(o_orderkey) AS first, max(o_orderkey) AS last FROM k GROUP BY 1""",
}
