"""Evaluation arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def wilson(k: Column, n: Column, z: float = 1.96) -> tuple[Column, Column]:
    """Bounds of the Wilson interval for k of n, within 0 and 1; (0, 0) for n = 0."""
    kd, nd = k.cast("double"), F.greatest(n, F.lit(1)).cast("double")
    p = kd / nd
    base = 1 + F.lit(z * z) / nd
    mid = (p + F.lit(z * z) / (2 * nd)) / base
    half = F.lit(z) * F.sqrt(p * (1 - p) / nd + F.lit(z * z) / (4 * nd * nd)) / base
    none = n == 0
    return F.when(none, 0.0).otherwise(F.greatest(F.lit(0.0), mid - half)), F.when(none, 0.0).otherwise(F.least(F.lit(1.0), mid + half))


def gib(c: Column) -> Column:
    return c / F.lit(float(1 << 30))


def signed64(c: Column) -> Column:
    """An unsigned 64-bit reading (decimal) as two's complement."""
    return F.when(c >= F.lit("9223372036854775808").cast("decimal(20,0)"), c - F.lit("18446744073709551616").cast("decimal(20,0)")).otherwise(c)


def battery_power_mw(external: Column, system_power_in: Column, amperage: Column, voltage: Column) -> Column:
    """Milliwatts: the mains figure if one is connected and known, else milliamperes times millivolts over 1000."""
    drawn = F.abs(signed64(amperage).cast("double") * voltage / 1000)
    return F.when(external & system_power_in.isNotNull(), system_power_in).otherwise(drawn)


def context_size(overhead: Column, chunk: Column, output: Column, batch: Column, margin: float = 1.2, unit: int = 1024) -> Column:
    """Context length for a request: overhead and, for each chunk of the batch, its tokens and its answer's, with a margin, up to a multiple of unit."""
    return (F.ceil(F.lit(margin) * (overhead + batch * (chunk + output)) / unit) * unit).cast("long")
