"""Numbers: rates, intervals, bins, distances, ranks and robust z-scores, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F


def ratio(a: Column, b: Column, scale: float = 1.0) -> Column:
    """Null where there is nothing to divide by."""
    return F.when(b > 0, a * F.lit(scale) / b)


def wilson(positives: Column, n: Column, z: float = 1.96) -> tuple[Column, Column]:
    """Ends of the score interval, in [0, 1]; null without tests; positives are held in [0, n]."""
    n = n.cast("double")
    pos = F.least(F.greatest(F.coalesce(positives, F.lit(0)).cast("double"), F.lit(0.0)), n)
    p, zz = pos / n, z * z
    denominator = 1 + F.lit(zz) / n
    center = (p + F.lit(zz) / (2 * n)) / denominator
    half = z * F.sqrt(F.greatest((p * (1 - p) + F.lit(zz) / (4 * n)) / n, F.lit(0.0))) / denominator
    return F.when(n > 0, F.greatest(center - half, F.lit(0.0))), F.when(n > 0, F.least(center + half, F.lit(1.0)))


def poisson(count: Column, population: Column, z: float = 1.96) -> tuple[Column, Column]:
    """Interval of the rate for 100,000."""
    count, population = count.cast("double"), population.cast("double")
    error = F.when(count > 0, F.sqrt(F.greatest(count, F.lit(0.0)))).otherwise(1.0) / population
    fine = (population > 0) & (count >= 0)
    return F.when(fine, F.greatest(count / population - z * error, F.lit(0.0)) * 1e5), F.when(fine, (count / population + z * error) * 1e5)


def bins(value: Column, cuts: list[float], labels: list[str]) -> Column:
    """Right-closed intervals; null stays null."""
    out = F.when(value.isNull(), F.lit(None).cast("string"))
    for cut, label in zip(cuts, labels, strict=False):
        out = out.when(value <= cut, label)
    return out.otherwise(labels[-1])


RISK_CUTS, RISK_LEVELS = [1.0, 2.0, 3.0], ["habitual", "atencao", "alerta", "alto_alerta"]
PRESSURE_CUTS, PRESSURE_LEVELS = [35.0, 55.0, 75.0], ["baixa", "moderada", "alta", "critica"]
CONFIDENCE_CUTS, CONFIDENCE_LEVELS = [0.35, 0.60, 0.80], ["baixa", "moderada", "boa", "alta"]


def clip(value: Column, low: float, high: float) -> Column:
    return F.greatest(F.least(value, F.lit(float(high))), F.lit(float(low)))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """O38."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * 6371.0 * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def sigmoid(x: Column) -> Column:
    """O39."""
    return 1 / (1 + F.exp(-clip(x, -20, 20)))


def with_robust_z(df, columns: dict[str, str], keys: list[str]):
    """``columns`` maps inputs to outputs. All windows have one partitioning, so the rows are shuffled once."""
    w = Window.partitionBy(*keys)
    centered = df.select("*", *[F.median(c).over(w).alias(f"_med_{c}") for c in columns])
    spread = centered.select("*", *[F.median(F.abs(F.col(c) - F.col(f"_med_{c}"))).over(w).alias(f"_mad_{c}") for c in columns])
    out = []
    for c, name in columns.items():
        v, mad, deviation = F.col(c), F.col(f"_mad_{c}"), F.stddev_pop(c).over(w)
        plain = F.when(deviation > 1e-12, (v - F.avg(c).over(w)) / deviation).otherwise(0.0)
        out.append(F.when(mad > 0, 0.6745 * (v - F.col(f"_med_{c}")) / mad).otherwise(plain).alias(name))
    return spread.select(*[F.col(c) for c in df.columns], *out)


def average_rank_share(value: Column, w_by: list[Column | str]) -> Column:
    """Average rank of ties over the count of values in the group; null values have none."""
    ordered = Window.partitionBy(*w_by).orderBy(value.asc_nulls_last())
    alike = Window.partitionBy(*w_by, value)
    group = Window.partitionBy(*w_by)
    return F.when(value.isNotNull(), (F.rank().over(ordered) + (F.count(F.lit(1)).over(alike) - 1) / 2.0) / F.count(value).over(group))


def rolling(value: Column, w: WindowSpec, size: int, least: int) -> Column:
    """Mean of the last ``size`` observed rows, from ``least`` values on. ``w`` is partitioned and ordered."""
    frame = w.rowsBetween(-(size - 1), 0)
    return F.when(F.count(value).over(frame) >= least, F.avg(value).over(frame))


def min_max(value: Column, low: float, high: float, by: list[str]) -> Column:
    """Scaled to [low, high]; a constant is put in the middle."""
    w = Window.partitionBy(*by)
    span = F.max(value).over(w) - F.min(value).over(w)
    return F.when(span > 0, low + (value - F.min(value).over(w)) / span * (high - low)).otherwise((low + high) / 2)
