"""Model registry rules over a version table.

The table has one row per registered version: (model_name, version, stage, run_id, ...). Picks are ``max_by`` aggregates
per model, which combine on the map side, so a model with very many versions costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airmill import constants as K
from airmill.functions.lists import code_list

PRODUCTION, STAGING = "Production", "Staging"


def latest_by_stage(versions: DataFrame, by: Sequence[str] = ("model_name",)) -> DataFrame:
    """Highest version of every (model, stage)."""
    best = versions.groupBy(*by, "stage").agg(F.max_by("run_id", "version").alias("run_id"), F.max("version").alias("version"))
    return best.select(*by, "stage", "version", "run_id")


def _latest(stage: str) -> Column:
    """struct(version, stage, run_id) of the highest version in a stage, null when there is none."""
    mine = F.col("stage") == stage
    return F.max_by(F.struct("version", "stage", "run_id"), F.when(mine, F.col("version")))


def champion_fallback(versions: DataFrame, by: Sequence[str] = ("model_name",)) -> DataFrame:
    """Highest version other than the challenger (latest Staging), for models without a Production version."""
    keys = list(by)
    picks = versions.groupBy(*keys).agg(
        _latest(STAGING)["version"].alias("challenger_version"),
        F.count_if(F.col("stage") == PRODUCTION).alias("in_production"),
    )
    picks = picks.where((F.col("in_production") == 0) & F.col("challenger_version").isNotNull())
    others = versions.join(picks.drop("in_production"), keys).where(F.col("version") != F.col("challenger_version"))
    best = others.groupBy(*keys, "challenger_version").agg(F.max_by(F.struct("version", "stage", "run_id"), "version").alias("b"))
    return best.select(
        *keys,
        "challenger_version",
        F.col("b.version").alias("champion_version"),
        F.col("b.stage").alias("champion_stage"),
        F.col("b.run_id").alias("champion_run_id"),
    )


def champion_challenger(versions: DataFrame, by: Sequence[str] = ("model_name",)) -> DataFrame:
    """Champion (Production, else the fallback) against challenger (Staging) with a status per model."""
    keys = list(by)
    picks = versions.groupBy(*keys).agg(
        _latest(PRODUCTION)["version"].alias("production_version"), _latest(STAGING)["version"].alias("challenger_version")
    )
    spare = champion_fallback(versions, keys).select(*keys, F.col("champion_version").alias("fallback_version"))
    both = picks.join(spare, keys, "left")
    champion, challenger = F.coalesce("production_version", "fallback_version"), F.col("challenger_version")
    status = (
        F.when(challenger.isNull(), "no_staging")
        .when(champion.isNull(), "single_version")
        .when(champion == challenger, "same_version")
        .when(challenger < champion, "challenger_not_newer")
        .otherwise("ok")
    )
    used = F.when(F.col("production_version").isNotNull(), F.lit(False)).when(champion.isNotNull(), F.lit(True))
    return both.select(
        *keys,
        champion.alias("champion_version"),
        challenger.alias("challenger_version"),
        F.coalesce(used, F.lit(False)).alias("used_fallback"),
        status.alias("status"),
    )


def usable_model(versions: DataFrame, artifacts: DataFrame, by: Sequence[str] = ("model_name",)) -> DataFrame:
    """Version to score with: Production, else Staging; run id of the stored artifact when the versions differ.

    ``artifacts`` has one row per model: (model, artifact_version, artifact_run_id). Status: ok, artifact_mismatch,
    no_model or no_artifact; the last two mean that scoring is skipped.
    """
    keys = list(by)
    picked = F.coalesce(_latest(PRODUCTION), _latest(STAGING))
    chosen = versions.groupBy(*keys).agg(picked.alias("m")).join(artifacts, keys, "left")
    mismatch = F.col("m.version") != F.col("artifact_version")
    status = (
        F.when(F.col("m").isNull(), "no_model")
        .when(F.col("artifact_version").isNull(), "no_artifact")
        .when(mismatch, "artifact_mismatch")
        .otherwise("ok")
    )
    run = F.when(mismatch, F.coalesce("artifact_run_id", F.col("m.run_id"))).otherwise(F.col("m.run_id"))
    usable = F.col("status").isin("ok", "artifact_mismatch")
    out = chosen.select(
        *keys, F.col("m.version").alias("version"), F.col("m.stage").alias("stage"), run.alias("run_id"), status.alias("status")
    )
    return out.withColumn("run_id", F.when(usable, F.col("run_id")))


def registration_gate(metrics: DataFrame, limits: dict[str, float] = K.GATE_LIMITS) -> DataFrame:
    """Add ``failed`` (names of missed limits), ``registered`` and the branch taken."""
    failed = code_list(*[F.when(~(F.col(m) >= limit), F.lit(m)) for m, limit in limits.items()])
    out = metrics.withColumn("failed", failed).withColumn("registered", F.size("failed") == 0)
    return out.withColumn("branch", F.when(F.col("registered"), "register_model").otherwise("skip_registration"))


def stage_assignment(candidates: DataFrame, versions: DataFrame, by: Sequence[str] = ("model_name",)) -> DataFrame:
    """Stage of every newly registered version: the lowest one of a model without Production goes there, all others wait in
    Staging, as if they were registered one after the other.
    """
    live = versions.where(F.col("stage") == PRODUCTION).select(*by).distinct().withColumn("has_live", F.lit(True))
    first = candidates.groupBy(*by).agg(F.min("version").alias("first_version")).join(live, list(by), "left")
    out = candidates.join(first, list(by))
    goes = F.col("has_live").isNull() & (F.col("version") == F.col("first_version"))
    return out.withColumn("stage", F.when(goes, PRODUCTION).otherwise(STAGING)).drop("has_live", "first_version")


def register(candidates: DataFrame, versions: DataFrame, by: Sequence[str] = ("model_name",)) -> DataFrame:
    """The version table after registration: old rows plus the candidates with their stage."""
    return versions.unionByName(stage_assignment(candidates, versions, by), allowMissingColumns=True)


def version_metrics(versions: DataFrame, runs: DataFrame) -> DataFrame:
    """Versions with the metrics of their run; a missing run gives null metrics and training date 'unknown'."""
    date = F.coalesce(F.col("training_date").cast("string"), F.lit("unknown"))
    return versions.join(runs, "run_id", "left").withColumn("training_date", date)
