"""Air-quality scores and the labels read off them, as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from airmill import constants as K


def clip(value: Column, low: float, high: float) -> Column:
    """Limit ``value`` to [low, high]; null stays null."""
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high)))


def iaq_score(gas: Column, humidity: Column, baseline: Column) -> Column:
    """Score against a gas baseline: gas shortfall plus distance from the humidity comfort band, 0..500, 2 decimals."""
    gas_points = F.greatest(F.lit(0.0), (F.lit(1.0) - F.try_divide(gas, baseline)) * K.IAQ_GAS_POINTS)
    dry = F.lit(K.IAQ_COMFORT_LOW) - humidity
    damp = humidity - F.lit(K.IAQ_COMFORT_HIGH)
    humidity_points = F.greatest(F.lit(0.0), dry, damp) * K.IAQ_POINTS_PER_HUMIDITY
    known = gas.isNotNull() & humidity.isNotNull() & baseline.isNotNull()
    return F.when(known, F.round(F.least(F.lit(K.IAQ_MAX), gas_points + humidity_points), 2))


def iaq_v2(gas: Column, humidity: Column) -> Column:
    """Per-reading index without a baseline, truncated to an integer in 0..500.

    For humidity between 0 and 100 the formula stays between 0 and 80, so the upper labels are not reached.
    """
    offset = humidity - F.lit(K.IAQ2_HUMIDITY_CENTRE)
    weight = F.when(offset > 0, F.lit(K.IAQ2_WEIGHT_ABOVE)).otherwise(F.lit(K.IAQ2_WEIGHT_BELOW))
    humidity_part = weight / 100.0 * offset * -1
    span = K.IAQ2_GAS_CEILING - K.IAQ2_GAS_FLOOR
    gas_part = (clip(gas, K.IAQ2_GAS_FLOOR, K.IAQ2_GAS_CEILING) - K.IAQ2_GAS_FLOOR) / span * K.IAQ2_GAS_WEIGHT
    raw = (humidity_part + gas_part) * 100
    return clip((F.lit(1.0) - raw) * 500 / 100, 0.0, 500.0).cast("int")


def air_label(iaq: Column) -> Column:
    """Six-step label of an integer index."""
    label = F
    for limit, text in K.AIR_LABELS:
        label = label.when(iaq <= limit, F.lit(text))
    return label.when(iaq.isNotNull(), F.lit(K.AIR_LABEL_WORST))


def score_band(decision: Column) -> Column:
    """Five-step code of a decision score (higher = more normal)."""
    band = F
    for limit, code in K.SCORE_BANDS:
        band = band.when(decision > limit, F.lit(code))
    return band.when(decision.isNotNull(), F.lit(K.SCORE_BAND_LAST))
