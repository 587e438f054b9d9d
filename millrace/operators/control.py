"""Contracts on data and releases: drift, freshness, replay, stages, quality gates, promotion, secrets, file sets."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import text as T

# How long a signal counts, in hours; how states outrank each other.
FRESHNESS_HOURS = {"ingestion": 48, "quality": 48, "graph": 168, "training": 168, "publication": 48, "security": 48}
PRECEDENCE = {"unknown": 0, "green": 1, "yellow": 2, "red": 3}
# Allowed steps of a model's publication state, and the gates each target needs.
TRANSITIONS = (("dev", "validated"), ("validated", "candidate"), ("candidate", "production"), ("rolled_back", "validated"))
GATES = {"compatibility": ("validated", "candidate", "production"), "evaluation": ("candidate", "production"), "readiness": ("production",)}
# Patterns of secrets by kind.
SECRETS = {
    "private_key": r"-----BEGIN (?:RSA |EC |OPENSSH |DSA )?PRIVATE KEY-----",
    "aws_access_key": r"\bAKIA[0-9A-Z]{16}\b",
    "github_token": r"\b(?:ghp|gho|ghs|ghr)_[A-Za-z0-9]{30,}\b",
    "github_pat": r"\bgithub_pat_[A-Za-z0-9_]{50,}\b",
    "slack_token": r"\bxox[baprs]-[A-Za-z0-9-]{20,}\b",
    "basic_auth_url": r"(?i)https?://[^\s/@:]+:[^\s/@]+@[^\s]+",
}
# Step names that are no stages.
SKIPPED_STEPS = ("set up job", "complete job")


def _table(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for x in chain(*values.items())])


def drift(profiles: DataFrame, most_change: float = 0.20) -> DataFrame:
    """(name, issues, state) per profiled source; ``profiles`` pairs columns base_x and now_x.

    x: schema_hash, row_count, distribution (comparable), available. A change of rows beyond ``most_change`` of the base counts.
    """
    rows = F.when(F.col("base_row_count").isNull() | F.col("now_row_count").isNull() | (F.least("base_row_count", "now_row_count") < 0), "invalid row_count")
    rows = rows.when((F.col("base_row_count") > 0) & (F.abs(F.col("now_row_count") - F.col("base_row_count")) / F.col("base_row_count") > most_change), "row_count threshold exceeded")
    issues = F.array_compact(F.array(
        F.when(~F.col("base_schema_hash").eqNullSafe(F.col("now_schema_hash")), "schema_hash changed"), rows,
        F.when(~F.col("base_distribution").eqNullSafe(F.col("now_distribution")), "field_distributions changed"),
        F.when(~(F.coalesce("base_available", F.lit(False)) & F.coalesce("now_available", F.lit(False))), "source unavailable"),
    ))
    return profiles.select("name", issues.alias("issues")).withColumn("state", F.when(F.size("issues") > 0, "red").otherwise("green"))


def freshness(signals: DataFrame, now: Column, limits: dict[str, int] = FRESHNESS_HOURS) -> DataFrame:
    """``signals`` (signal, state, generated_at TIMESTAMP) with age_hours and the state after the freshness rule.

    No time, a future time or an age beyond the limit make a state unknown; signals without a limit keep theirs.
    """
    limit = F.element_at(_table(limits), F.col("signal"))
    seconds = (F.unix_micros(now) - F.unix_micros("generated_at")) / F.lit(1_000_000)
    out_of_date = F.col("generated_at").isNull() | (seconds < 0) | (seconds > limit * 3600)
    kept = F.when(limit.isNotNull() & out_of_date, "unknown").otherwise(F.col("state"))
    return signals.withColumn("age_hours", F.round(seconds / 3600, 2)).withColumn("effective", kept)


def overall(states: DataFrame, state: str = "effective", by: Sequence[str] = ()) -> DataFrame:
    """The state that outranks all others (unknown below green) per group."""
    return states.groupBy(*by).agg(F.max_by(state, F.element_at(_table(PRECEDENCE), F.col(state))).alias("overall"))


def replay(checkpoints: DataFrame, by: str = "workflow", replay_requested: bool = False) -> DataFrame:
    """(workflow, n, trusted, last_trusted_stage, next_action) from checkpoints (checkpoint, state, updated_at, checkpoint_id)."""
    at = F.struct("updated_at", "checkpoint", "checkpoint_id")
    stage = F.col("checkpoint").rlike(r"^stage-\d{3}-")
    open_ = F.col("state").isin("failed", "paused", "running")
    good = F.col("state") == "succeeded"
    last = lambda cond, name: F.max_by("checkpoint", F.when(cond, at)).alias(name)
    got = checkpoints.groupBy(by).agg(F.count("*").alias("n"), F.count_if(good).alias("trusted"), last(good & stage, "last_trusted_stage"), last(open_ & stage, "__stage"), last(open_, "__open"), last(good, "__good"))
    rest = F.when(F.col("__good").isNotNull(), F.concat(F.lit("replay-from:"), "__good")).otherwise("replay-from:start") if replay_requested else F.lit("complete")
    action = F.when(F.coalesce("__stage", "__open").isNotNull(), F.concat(F.lit("resume-from:"), F.coalesce("__stage", "__open"))).otherwise(rest)
    return got.withColumn("next_action", action).drop("__stage", "__open", "__good")


def checkpoint_issues(checkpoints: DataFrame) -> DataFrame:
    """(issue, n): duplicate ids, several workflows or commits, malformed ids, commits and states."""
    one = lambda df, name: df.agg(F.count("*").alias("n")).where("n > 0").select(F.lit(name).alias("issue"), "n")
    out = one(checkpoints.groupBy("checkpoint_id").agg(F.count("*").alias("c")).where("c > 1"), "duplicate checkpoint_id")
    for column in ("workflow", "source_commit"):
        out = out.unionByName(checkpoints.agg(F.count_distinct(column).alias("n")).where("n > 1").select(F.lit(f"several values of {column}").alias("issue"), "n"))
    out = out.unionByName(one(checkpoints.where(~T.is_sha256(F.col("checkpoint_id"))), "invalid checkpoint_id"))
    out = out.unionByName(one(checkpoints.where(~T.is_commit(F.col("source_commit"))), "invalid source_commit"))
    return out.unionByName(one(checkpoints.where(~F.col("state").isin("succeeded", "failed", "paused", "running")), "invalid state"))


def stages(steps: DataFrame, run: str = "run") -> DataFrame:
    """(run, sequence, stage, state) of steps (run, job_name, job_id, number, name, conclusion, status) in order; bookends skipped."""
    name = F.trim(F.coalesce("name", F.lit("")))
    kept = steps.where((name != "") & ~F.lower(name).isin(*SKIPPED_STEPS) & ~F.startswith(F.lower(name), F.lit("post ")))
    order = Window.partitionBy(run).orderBy("job_name", "job_id", "number")
    outcome = F.lower(F.coalesce(F.nullif("conclusion", F.lit("")), F.nullif("status", F.lit("")), F.lit("")))
    state = F.when(outcome == "success", "succeeded").when(outcome.isin("failure", "timed_out", "startup_failure", "action_required"), "failed").when(outcome.isin("cancelled", "skipped", "neutral", "stale"), "paused").otherwise("running")
    numbered = kept.withColumn("sequence", F.row_number().over(order))
    return numbered.select(run, "sequence", F.concat(F.lit("stage-"), F.lpad(F.col("sequence").cast("string"), 3, "0"), F.lit("-"), T.slug(name)).alias("stage"), state.alias("state"))


def last_losses(metrics: DataFrame, by: str) -> DataFrame:
    """(by, last_val_loss, min_val_loss, last_step) of metric lines in order (ordinal, step, val_loss)."""
    return metrics.groupBy(by).agg(F.max_by("val_loss", F.when(F.col("val_loss").isNotNull(), F.col("ordinal"))).alias("last_val_loss"), F.min("val_loss").alias("min_val_loss"), F.max("step").alias("last_step"))


def model_gate(candidate: Column, baseline: Column, tolerance: float = 1.02) -> Column:
    """green, red, or invalid for losses that are missing or not finite."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    bad = ~finite(candidate) | (baseline.isNotNull() & (~finite(baseline) | (baseline <= 0)))
    return F.when(bad, "invalid").when(baseline.isNull() | (candidate <= baseline * F.lit(tolerance)), "green").otherwise("red")


def promotion_issues(requests: DataFrame) -> DataFrame:
    """``requests`` (current, target, compatibility, evaluation, readiness, ...) with issues and state."""
    step = F.concat_ws(">", "current", "target")
    found = [F.when(~step.isin(*[f"{a}>{b}" for a, b in TRANSITIONS]), "invalid promotion transition")]
    found += [F.when(F.col("target").isin(*targets) & ~F.col(gate).eqNullSafe(F.lit("green")), f"{gate} gate not green") for gate, targets in GATES.items()]
    final = F.col("target") == "production"
    needs = {"model_id": F.coalesce("model_id", F.lit("")) != "", "artifact_sha256": T.is_sha256(F.col("artifact_sha256")), "evaluation_evidence_sha256": T.is_sha256(F.col("evaluation_evidence_sha256")), "approval_identity": F.coalesce("approval_identity", F.lit("")) != "", "positive release_sequence": F.coalesce(F.col("release_sequence") > 0, F.lit(False)), "promoted_at": T.is_utc_timestamp(F.col("promoted_at"))}
    found += [F.when(final & ~ok, f"production promotion requires {what}") for what, ok in needs.items() if what.split()[-1] in requests.columns]
    return requests.withColumn("issues", F.array_compact(F.array(*found))).withColumn("state", F.when(F.size("issues") > 0, "red").otherwise("green"))


def rollback_target(models: DataFrame, current: Column, by: Sequence[str] = ()) -> DataFrame:
    """The other production model of the greatest (release_sequence, promoted_at), per group."""
    good = models.where((F.col("publication_state") == "production") & (F.col("model_id") != current) & (F.col("release_sequence") > 0) & F.col("promoted_at").isNotNull())
    return good.groupBy(*by).agg(F.max(F.struct("release_sequence", "promoted_at", "model_id"))["model_id"].alias("target"))


def register(registry: DataFrame, new: DataFrame, key: str = "model_id") -> tuple[DataFrame, DataFrame]:
    """The registry with new rows appended, and conflicts: keys that exist with other content. Equal rows change nothing."""
    content = lambda df: F.sha2(F.to_json(F.struct(*[F.col(c) for c in sorted(df.columns)]), {"ignoreNullFields": "false"}), 256)
    old, fresh = registry.withColumn("__h", content(registry)), new.withColumn("__h", content(new))
    conflicts = fresh.join(old.select(key, F.col("__h").alias("__old")), key).where(F.col("__h") != F.col("__old")).drop("__h", "__old")
    return registry.unionByName(fresh.join(old.select(key), key, "left_anti").drop("__h")), conflicts


def secrets(files: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """(path, line, kind): lines that match a secret pattern; every line meets every pattern in one pass."""
    lines = files.select(path, F.posexplode(F.split(content, "\n")).alias("at", "text"))
    hits = F.array_compact(F.array(*[F.when(F.col("text").rlike(p), k) for k, p in SECRETS.items()]))
    return lines.select(path, (F.col("at") + 1).alias("line"), F.explode(hits).alias("kind"))


def compare_files(base: DataFrame, now: DataFrame) -> DataFrame:
    """(path, change) of file sets (path, sha256): added, removed or changed."""
    joined = base.select("path", F.col("sha256").alias("old")).join(now.select("path", F.col("sha256").alias("new")), "path", "full_outer")
    change = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").when(F.col("old") != F.col("new"), "changed")
    return joined.select("path", change.alias("change")).where("change is not null")


def missing(required: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """Required keys that are not there."""
    return required.select(key).distinct().join(present.select(key), key, "left_anti")


def unsafe_path(path: Column, root: str = "artifacts/") -> Column:
    """Whether a path is absolute, climbs up, or lies outside ``root``."""
    return F.coalesce(path.rlike(r"^/|^[A-Za-z]:|(^|/)\.\.(/|$)") | ~F.startswith(path, F.lit(root)), F.lit(True))
