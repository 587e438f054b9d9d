"""Contracts on what a release consists of: status signals, manifests, bound artifacts, compatibility, readiness. Issues are rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import control

# Signals a status index has, of these the one every index starts with as green, and states.
SIGNALS = ("ci", *control.FRESHNESS_HOURS)
STATES = tuple(control.PRECEDENCE)
# Contracts that hardening evidence proves, and states in which one is fulfilled.
CONTRACTS = ("DRIFT-01", "QUAR-01", "REG-01", "COMPAT-01", "PROM-01", "ROLL-01")
FULFILLED = ("green", "quarantined")
# Fields in which two manifests of one commit agree.
REPRODUCIBLE = ("schema_version", "release_class", "git_branch", "python", "files")


def signal_states(signals: DataFrame, commit: str, now: Column, expected: Sequence[str] = SIGNALS) -> DataFrame:
    """(signal, state, detail, age_hours) of each expected signal, by the rules in order.

    ``signals``: file (name.json), valid, schema_version, signal, source_commit, state, detail, generated_at (string). None: unknown.
    No JSON, another schema or signal name, or a state that is none: red. Another commit: unknown. A time that is missing, malformed,
    in the future or older than the signal's limit: unknown. ``ci`` is green, as its run is what builds the index.
    """
    spark = signals.sparkSession
    wanted = spark.createDataFrame([(s,) for s in expected], "name string")
    got = wanted.join(signals, F.concat("name", F.lit(".json")) == F.col("file"), "left")
    got = got.withColumn("at", F.when(F.col("generated_at").rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"), F.try_to_timestamp("generated_at", F.lit("yyyy-MM-dd'T'HH:mm:ssX"))))
    limit = F.element_at(control._table(control.FRESHNESS_HOURS), F.col("name"))
    seconds = (F.unix_micros(now) - F.unix_micros("at")) / F.lit(1_000_000)
    rules = [
        (F.col("name") == "ci", "green", "repository validation completed"),
        (F.col("file").isNull(), "unknown", "no signal artifact recorded"),
        (~F.col("valid"), "red", "signal artifact is invalid JSON"),
        (~F.col("schema_version").eqNullSafe(F.lit(1)) | ~F.col("signal").eqNullSafe(F.col("name")), "red", "signal artifact schema is invalid"),
        (~F.col("source_commit").eqNullSafe(F.lit(commit)), "unknown", "signal belongs to a different release commit"),
        (~F.coalesce(F.col("state").isin(*STATES), F.lit(False)), "red", "signal artifact has an invalid state"),
        (limit.isNotNull() & F.col("generated_at").isNull(), "unknown", "signal has no generation timestamp"),
        (limit.isNotNull() & F.col("at").isNull(), "unknown", "signal has invalid generation timestamp"),
        (limit.isNotNull() & (seconds < 0), "unknown", "signal generation timestamp is in the future"),
    ]
    state = reduce(lambda c, r: c.when(r[0], r[1]), rules[1:], F.when(rules[0][0], rules[0][1])).when(seconds > limit * 3600, "unknown").otherwise(F.col("state"))
    detail = reduce(lambda c, r: c.when(r[0], r[2]), rules[1:], F.when(rules[0][0], rules[0][2])).when(seconds > limit * 3600, F.format_string("signal is stale (>%dh)", limit)).otherwise(F.col("detail"))
    kept = limit.isNotNull() & (seconds >= 0) & (seconds <= limit * 3600) & F.col("source_commit").eqNullSafe(F.lit(commit))
    return got.select(F.col("name").alias("signal"), state.alias("state"), detail.alias("detail"), F.when(kept & (F.col("name") != "ci"), F.round(seconds / 3600, 2)).alias("age_hours"))


def status_index(states: DataFrame) -> DataFrame:
    """One row: overall_state (the state that outranks all others), and the signals as a map."""
    return states.agg(F.max_by("state", F.element_at(control._table(control.PRECEDENCE), F.col("state"))).alias("overall_state"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("signal", "state")))).alias("signals"))


def compat_issues(pairs: DataFrame) -> DataFrame:
    """``pairs`` (model_revision, model_schema, data_revision, data_schema, ...) with issues and state."""
    issues = F.array_compact(F.array(
        F.when(~F.col("model_revision").eqNullSafe(F.col("data_revision")), "dataset revision mismatch"),
        F.when(~F.col("model_schema").eqNullSafe(F.col("data_schema")), "schema hash mismatch"),
    ))
    return pairs.withColumn("issues", issues).withColumn("state", F.when(F.size("issues") > 0, "red").otherwise("green"))


def manifest_issues(entries: DataFrame) -> DataFrame:
    """(at, issue) of the file entries (at, path, sha256, bytes) of a manifest; of equal paths all but the first repeat it."""
    first = entries.where("path is not null and path != ''").groupBy("path").agg(F.min("at").alias("__first"))
    rows = entries.join(first, "path", "left")
    path = F.when(F.coalesce("path", F.lit("")) == "", "has a missing path").when(F.col("at") > F.col("__first"), "has a duplicate path")
    path = path.when((F.col("path") == "release-manifest.json") | F.startswith("path", F.lit(".git/")), "contains an excluded path")
    found = F.array_compact(F.array(path, F.when(~T.is_sha256(F.col("sha256")), "has an invalid SHA-256"), F.when(F.col("bytes").isNull() | (F.col("bytes") < 0), "has an invalid byte size")))
    return rows.select("at", F.explode(found).alias("what")).select("at", F.concat(F.lit("manifest file entry "), F.col("at").cast("string"), F.lit(" "), "what").alias("issue"))


def manifest_drift(manifests: DataFrame, fields: Sequence[str] = REPRODUCIBLE) -> DataFrame:
    """(pair, issue) of pairs of manifests with columns first_x and second_x: they need one commit, two times, and equal fields."""
    same = lambda f: F.col(f"first_{f}").eqNullSafe(F.col(f"second_{f}"))
    drift = [F.when(~same(f), f"reproducibility drift in {f}") for f in fields] + [F.when(same("generated_at_utc"), "reproducibility comparison requires distinct generated_at_utc values")]
    found = F.when(~same("git_commit"), F.array(F.lit("reproducibility comparison requires identical git_commit values"))).otherwise(F.array_compact(F.array(*drift)))
    return manifests.select("pair", F.explode(found).alias("issue"))


def chain_issues(required: DataFrame, files: DataFrame, entries: DataFrame, bindings: DataFrame) -> DataFrame:
    """(path, issue): what breaks the chain from required artifacts over manifest entries to bound artifacts.

    ``required`` has path; ``files`` path, sha256, bytes as found; ``entries`` path, sha256 and ``bindings`` path, sha256, bytes as stated.
    """
    there = files.select("path", F.col("sha256").alias("__sha"), F.col("bytes").alias("__bytes"))
    gone = control.missing(required, files, "path").select("path", F.concat(F.lit("missing artifact: "), "path").alias("issue"))
    listed = entries.join(there, "path", "left")
    wrong = F.when(F.coalesce("path", F.lit("")).eqNullSafe(F.lit("")) | (F.coalesce("sha256", F.lit("")) == ""), "release manifest contains invalid file entry").when(F.col("__sha").isNull(), F.concat(F.lit("manifest file missing: "), "path")).when(F.col("sha256") != F.col("__sha"), F.concat(F.lit("manifest checksum mismatch: "), "path"))
    bound = bindings.join(there, "path", "left")
    missing = F.when(F.col("__sha").isNull(), F.array(F.concat(F.lit("bound artifact missing: "), "path"))).when(F.col("sha256").isNull(), F.array(F.concat(F.lit("bound artifact checksum is invalid: "), "path")))
    differs = F.array_compact(F.array(F.when(F.col("sha256") != F.col("__sha"), F.concat(F.lit("bound artifact checksum mismatch: "), "path")), F.when(~F.col("bytes").eqNullSafe(F.col("__bytes")), F.concat(F.lit("bound artifact byte-size mismatch: "), "path"))))
    out = gone.unionByName(listed.select("path", wrong.alias("issue")).where("issue is not null"))
    return out.unionByName(bound.select("path", F.explode(missing.otherwise(differs)).alias("issue")))


def evidence_issues(evidence: DataFrame, commit: str, contracts: Sequence[str] = CONTRACTS) -> DataFrame:
    """(issue) of hardening evidence (schema_version, source_commit, contracts map<string,string>), one document."""
    found = [F.when(~F.col("schema_version").eqNullSafe(F.lit(1)), "unsupported hardening evidence schema"), F.when(~F.col("source_commit").eqNullSafe(F.lit(commit)), "hardening evidence commit does not match release manifest")]
    found += [F.when(~F.coalesce(F.element_at("contracts", F.lit(c)).isin(*FULFILLED), F.lit(False)), f"hardening contract not green: {c}") for c in contracts]
    return evidence.select(F.explode(F.array_compact(F.array(*found))).alias("issue"))


def authorization_id(authorization: DataFrame, fields: Sequence[str]) -> Column:
    """SHA-256 of an authorization's fields as JSON with sorted keys, its own id left out."""
    kept = [F.col(c) for c in sorted(fields) if c != "authorization_id"]
    return F.sha2(F.to_json(F.struct(*kept), {"ignoreNullFields": "false"}), 256)


def authorization_issues(authorizations: DataFrame, commit: str) -> DataFrame:
    """``authorizations`` with issues: schema, target, commit, model, checksums, approval, sequence, time, identity."""
    given = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) != ""
    fields = [c for c in authorizations.columns if c != "authorization_id"]
    own = F.col("authorization_id")
    found = [
        F.when(~F.col("schema_version").eqNullSafe(F.lit(1)), "unsupported promotion authorization schema"),
        F.when(~F.col("target").eqNullSafe(F.lit("production")), "promotion authorization target is not production"),
        F.when(~F.col("source_commit").eqNullSafe(F.lit(commit)), "promotion authorization commit does not match release manifest"),
        F.when(~given("model_id"), "promotion authorization missing model_id"),
        *[F.when(F.coalesce(F.length(c), F.lit(0)) != 64, f"promotion authorization missing {c}") for c in ("artifact_sha256", "evaluation_evidence_sha256")],
        F.when(~given("approval_identity"), "promotion authorization missing approval_identity"),
        F.when(~F.coalesce(F.col("release_sequence") > 0, F.lit(False)), "promotion authorization requires positive release_sequence"),
        F.when(~given("approved_at"), "promotion authorization missing approved_at"),
        F.when(F.coalesce(F.length(own), F.lit(0)) != 64, "promotion authorization identity is missing or invalid").when(own != authorization_id(authorizations, fields), "promotion authorization identity checksum mismatch"),
    ]
    return authorizations.withColumn("issues", F.array_compact(F.array(*found)))


def readiness(gates: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Red if any gate (gate, state) is red or has no state, else yellow if any is, else green."""
    state = F.coalesce("state", F.lit("red"))
    return gates.groupBy(*by).agg(F.when(F.bool_or(state == "red"), "red").when(F.bool_or(state == "yellow"), "yellow").otherwise("green").alias("overall"))


def evidence(spark: SparkSession) -> DataFrame:
    """(contract, state): every contract run on a small fixture, with what must fail failing; red where one does not hold."""
    row = lambda schema, *values: spark.createDataFrame([values], schema)
    profile = "name string, base_schema_hash string, now_schema_hash string, base_row_count long, now_row_count long, base_distribution string, now_distribution string, base_available boolean, now_available boolean"
    drift = control.drift(row(profile, "fixture", "h", "h", 10, 10, "d", "d", True, True)).first()["state"]
    registry = row("model_id string, sha string", "m", "a")
    _, same = control.register(registry, row("model_id string, sha string", "m", "a"))
    _, tampered = control.register(registry, row("model_id string, sha string", "m", "b"))
    kept = same.isEmpty() and not tampered.isEmpty()
    compat = compat_issues(row("model_revision string, model_schema string, data_revision string, data_schema string", "1", "s", "1", "s")).first()["state"]
    request = "current string, target string, compatibility string, evaluation string, readiness string, model_id string, artifact_sha256 string, evaluation_evidence_sha256 string, approval_identity string, release_sequence int, promoted_at string"
    good = ("candidate", "production", "green", "green", "green", "m", "0" * 64, "0" * 64, "self-test", 1, "2024-01-01T00:00:00Z")
    passed = control.promotion_issues(row(request, *good)).first()["state"] == "green"
    refused = control.promotion_issues(row(request, *good[:5], None, None, None, None, None, None)).first()["state"] == "red"
    models = spark.createDataFrame([("m", "production", 1, "2024-01-01T00:00:00Z"), ("now", "production", 2, "2024-02-01T00:00:00Z")], "model_id string, publication_state string, release_sequence int, promoted_at string")
    back = control.rollback_target(models, F.lit("now")).first()["target"] == "m"
    light = lambda ok: "green" if ok else "red"
    rows = [("DRIFT-01", drift), ("QUAR-01", "quarantined" if kept else "red"), ("REG-01", light(kept)), ("COMPAT-01", compat), ("PROM-01", light(passed and refused)), ("ROLL-01", light(back))]
    return spark.createDataFrame(rows, "contract string, state string")
