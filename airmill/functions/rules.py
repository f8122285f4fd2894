"""Correlation rules over one reading: factor flags, rule match, model override."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from airmill import constants as K
from airmill.functions.lists import code_list


def contributing_factors(t: Column, h: Column, g: Column) -> Column:
    """Ordered array of factor codes; the stronger grade of a factor hides the weaker one."""
    temperature = F.when(t >= K.TEMP_CRITICAL, "temperature_critical").when(t >= K.TEMP_HIGH, "temperature_high")
    gas = F.when(g <= K.GAS_VERY_LOW, "gas_very_low").when(g <= K.GAS_LOW, "gas_low")
    return code_list(
        temperature,
        F.when(t <= K.TEMP_LOW, "temperature_low"),
        F.when(h >= K.HUMIDITY_HIGH, "humidity_high"),
        F.when(h <= K.HUMIDITY_LOW, "humidity_low"),
        gas,
        F.when(g >= K.GAS_HIGH, "gas_clean"),
    )


def _verdict(kind: str, severity: str) -> Column:
    return F.struct(F.lit(kind).alias("anomaly_type"), F.lit(severity).alias("severity"))


def correlation_rule(t: Column, h: Column, p: Column, g: Column) -> Column:
    """First matching rule as ``struct(anomaly_type, severity)``.

    The mould rule can never fire, because low gas is always taken by an earlier rule; the order is part of the result.
    """
    hot, scorching = t >= K.TEMP_HIGH, t >= K.TEMP_CRITICAL
    cold, damp, dry = t <= K.TEMP_LOW, h >= K.HUMIDITY_HIGH, h <= K.HUMIDITY_LOW
    bad_gas, foul_gas = g <= K.GAS_LOW, g <= K.GAS_VERY_LOW
    return (
        F.when(scorching & foul_gas, _verdict("FIRE_RISK", "CRITICAL"))
        .when(hot & bad_gas, _verdict("HEAT_SOURCE", "HIGH"))
        .when(foul_gas & ~hot, _verdict("CHEMICAL_VOC", "CRITICAL"))
        .when(bad_gas & ~hot, _verdict("AIR_POLLUTION", "MEDIUM"))
        .when(damp & bad_gas, _verdict("MOLD_RISK", "HIGH"))
        .when(damp & (p < K.STORM_PRESSURE), _verdict("WEATHER_CHANGE", "LOW"))
        .when(cold & dry, _verdict("DRY_COLD", "LOW"))
        .when(hot | cold | damp | dry | bad_gas, _verdict("GENERAL_ANOMALY", "MEDIUM"))
        .otherwise(_verdict("NORMAL", "NONE"))
    )


def apply_override(rule: Column, model_anomaly: Column) -> Column:
    """Combine rule and model into ``struct(is_anomaly, anomaly_type, severity)``.

    A model alarm without a rule becomes a statistical anomaly; fire and chemical rules raise the alarm by themselves.
    """
    kind, severity = rule["anomaly_type"], rule["severity"]
    only_model = model_anomaly & (kind == "NORMAL")
    return F.struct(
        (model_anomaly | kind.isin("FIRE_RISK", "CHEMICAL_VOC")).alias("is_anomaly"),
        F.when(only_model, F.lit("STATISTICAL_ANOMALY")).otherwise(kind).alias("anomaly_type"),
        F.when(only_model, F.lit("MEDIUM")).otherwise(severity).alias("severity"),
    )
