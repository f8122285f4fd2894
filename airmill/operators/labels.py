"""Domain labels and the stratified split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airmill import constants as K
from airmill.functions.stats import ratio
from airmill.session import stored

# Hash slots of the split; the slot table has at most SPLIT_SLOTS rows per class.
SPLIT_SLOTS = 65_536


def label_rules(limits: dict[str, float] = K.LABEL_LIMITS) -> dict[str, Column]:
    """The five rules by name; a null input makes a rule false."""
    t, h = F.col("temperature"), F.col("humidity")
    rules = {
        "iaq_high": F.col("iaq_score") > limits["iaq_score_max"],
        "temperature_high": t > limits["temperature_max"],
        "temperature_low": t < limits["temperature_min"],
        "humidity_high": h > limits["humidity_max"],
        "humidity_low": h < limits["humidity_min"],
    }
    return {name: F.coalesce(rule, F.lit(False)) for name, rule in rules.items()}


def with_label(df: DataFrame, limits: dict[str, float] = K.LABEL_LIMITS, name: str = "is_anomaly") -> DataFrame:
    """0/1 label: any rule holds."""
    any_rule = F.lit(False)
    for rule in label_rules(limits).values():
        any_rule = any_rule | rule
    return df.withColumn(name, any_rule.cast("int"))


def label_rate(df: DataFrame, label: str = "is_anomaly") -> DataFrame:
    """One row: total, anomalies, anomaly_rate and the sanity band (none, rare, ok, frequent)."""
    rate = ratio(F.sum(label), F.count(label))
    one = df.agg(F.count(label).alias("total"), F.coalesce(F.sum(label), F.lit(0)).alias("anomalies"), rate.alias("r"))
    r = F.col("r")
    band = F.when(r == 0, "none").when(r > K.RATE_HIGH, "frequent").when(r < K.RATE_LOW, "rare").otherwise("ok")
    return one.select("total", "anomalies", r.alias("anomaly_rate"), band.alias("band"))


def require_anomalies(df: DataFrame, label: str = "is_anomaly") -> DataFrame:
    """Fail when no row is labelled: the limits do not fit the data."""
    if df.where(F.col(label) == 1).isEmpty():
        raise ValueError("no anomaly in the labelled set; check the label limits")
    return df


def rule_breakdown(df: DataFrame, limits: dict[str, float] = K.LABEL_LIMITS) -> DataFrame:
    """(rule, matches): rules may overlap."""
    rules = label_rules(limits)
    one = df.agg(*[F.count_if(rule).alias(name) for name, rule in rules.items()])
    return one.unpivot([], list(rules), "rule", "matches")


def label_thresholds(df: DataFrame, limits: dict[str, float] = K.LABEL_LIMITS, label: str = "is_anomaly") -> DataFrame:
    """One row: the limits in use and the rate they gave."""
    fixed = [F.lit(value).alias(name) for name, value in limits.items()]
    return label_rate(df, label).select(*fixed, "anomaly_rate")


def training_set(df: DataFrame, ts: str = "ts", label: str = "is_anomaly") -> DataFrame:
    """Model features, label and time, the columns a fit needs."""
    return df.select(*K.SENSOR_COLUMNS, label, ts)


def split_quotas(sizes: DataFrame, label: str, share: float) -> DataFrame:
    """(label, rows, quota) from (label, rows): ceil(share * total) test rows, shared out by largest remainder.

    Equal remainders favour the smaller label. The input has one row per class.
    """
    everything = Window.partitionBy(F.lit(0))
    exact = F.col("rows") * F.ceil(F.sum("rows").over(everything) * share) / F.sum("rows").over(everything)
    sized = sizes.withColumn("exact", exact).withColumn("base", F.floor("exact"))
    rest = F.round(F.sum("exact").over(everything) - F.sum("base").over(everything)).cast("bigint")
    rank = F.row_number().over(everything.orderBy((F.col("exact") - F.col("base")).desc(), label))
    sized = sized.withColumn("rest", rest).withColumn("rank", rank)
    quota = F.col("base") + F.when(F.col("rank") <= F.col("rest"), 1).otherwise(0)
    return sized.select(label, "rows", quota.alias("quota"))


def stratified_split(
    df: DataFrame,
    key: str,
    label: str = "is_anomaly",
    share: float = K.TEST_SHARE,
    seed: int = K.SEED,
    hashed: Column | None = None,
    modulus: int | None = None,
    slots: int = SPLIT_SLOTS,
) -> DataFrame:
    """Add ``split`` ('test' or 'train') so that every class meets its test quota exactly.

    Rows are ranked by (hash, key) inside their class, but no class is ever sorted: counts per hash slot say which slots
    are wholly test or wholly train, and only the one slot per class where the quota ends is ranked. Everything else is
    a map-side decision against a stored slot table of at most ``slots`` rows per class. ``hashed`` with ``modulus`` replaces
    the built-in hash.
    """
    if hashed is None:
        modulus = 1 << 40
        hashed = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(modulus))
    placed = df.withColumn("_hash", hashed.cast("bigint"))
    placed = placed.withColumn("_slot", F.floor(F.col("_hash") / (modulus / slots)))
    counts = placed.groupBy(label, "_slot").agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy(label).orderBy("_slot").rowsBetween(Window.unboundedPreceding, 0)
    quotas = split_quotas(counts.groupBy(label).agg(F.sum("_n").alias("rows")), label, share)
    slot_table = counts.withColumn("_upto", F.sum("_n").over(upto)).join(quotas, label)
    left = F.col("quota") - (F.col("_upto") - F.col("_n"))
    slot_table = stored(slot_table.select(label, "_slot", "_n", F.greatest(left, F.lit(0)).alias("_left")))
    known = placed.join(F.broadcast(slot_table), [label, "_slot"])
    whole = F.when(F.col("_left") >= F.col("_n"), "test").when(F.col("_left") <= 0, "train")
    known = known.withColumn("split", whole)
    decided = known.where(F.col("split").isNotNull())
    by_hash = Window.partitionBy(label, "_slot").orderBy("_hash", key)
    border = known.where(F.col("split").isNull()).withColumn("_rank", F.row_number().over(by_hash))
    border = border.withColumn("split", F.when(F.col("_rank") <= F.col("_left"), "test").otherwise("train"))
    return decided.unionByName(border.drop("_rank")).drop("_hash", "_slot", "_n", "_left")


def split_balance(df: DataFrame, label: str = "is_anomaly") -> DataFrame:
    """Rows, anomalies and rate per split side, and the warning flag for too few test anomalies."""
    out = df.groupBy("split").agg(F.count(F.lit(1)).alias("rows"), F.sum(label).alias("anomalies"))
    few = (F.col("split") == "test") & (F.col("anomalies") < K.MIN_TEST_ANOMALIES)
    return out.select("split", "rows", "anomalies", ratio(F.col("anomalies"), F.col("rows")).alias("rate"), few.alias("few_anomalies"))
