"""Collapse many points per area into one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Digits of a degree that count: a tenth of a millimetre.
DIGITS = 9
FIXED = f"decimal(20,{DIGITS})"


def fixed_mean(value: Column) -> Column:
    """Mean of numbers taken as fixed-point ones: an exact sum and one division, whatever the order of the rows."""
    units = (value.try_cast(FIXED) * F.lit(10**DIGITS).cast("decimal(10,0)")).cast("decimal(21,0)")
    return F.try_divide(F.sum(units).cast("double"), F.count(units).cast("double") * F.lit(float(10**DIGITS)))


def mean_point_per_key(
    df: DataFrame, key: Column, lat: Column, lng: Column, city: Column, state: Column
) -> DataFrame:
    """One mean point per key of coordinates with nine digits; the labels are the smallest non-null ones,
    so reruns agree to the last digit."""
    return df.groupBy(key.alias("cep_prefixo")).agg(
        fixed_mean(lat).alias("latitude"),
        fixed_mean(lng).alias("longitude"),
        F.min(city).alias("cidade"),
        F.min(state).alias("uf"),
        F.count(F.lit(1)).alias("qtd_pontos_origem"),
    )
