"""Weekly pressure on the laboratory network, by town or by town and family, with its proxy index and label (O136, O137)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.measures import PRESSURE_CUTS, PRESSURE_LEVELS, average_rank_share, bins, clip, rolling
from .territory import WEEK, recent


def network_shares(network: DataFrame, keys: list[str]) -> DataFrame:
    """Service levels as shares: backlog over exams, turnaround over a fortnight, rejection over 5 %; one row for each of ``keys``."""
    backlog = clip(F.coalesce("backlog_estimado", F.lit(0)) / F.greatest(F.coalesce("exames", F.lit(0)), F.lit(1)), 0, 1)
    slow = clip(F.coalesce("tat_p90_dias", F.lit(14.0)) / 14.0, 0, 2) / 2.0
    rejected = clip(F.coalesce("pct_rejeitado", F.lit(0.0)) / 0.05, 0, 2) / 2.0
    return network.select(*keys, backlog.alias("backlog_norm"), slow.alias("tat_p90_norm"), rejected.alias("rejeicao_norm"))


def pressure_panel(panel: DataFrame, network: DataFrame, keys: tuple[str, ...] = ("municipio",), weeks: int = 104, unknown_turnaround: float = 0.5) -> DataFrame:
    """O136: tests and notifications of each week by ``keys`` (the town first), with lag, means, trend, rank among the towns of the week, and the index
    100 * (0.40 volume + 0.25 backlog + 0.20 turnaround + 0.15 rejection). Volume is held against the week's 95th percentile.

    Towns meet by week (and family, if ``keys`` has one), and weeks by town: two window partitionings. ``network`` has ``keys`` and
    service levels; where it has no row, backlog and rejection count 0 and turnaround ``unknown_turnaround``.
    """
    keys, others = list(keys), list(keys[1:])
    sums = recent(panel, weeks).groupBy(*keys, *WEEK).agg(F.sum("tests").alias("tests"), F.sum("notificacoes").alias("notificacoes"))
    w, week = Window.partitionBy(*keys).orderBy(*WEEK), Window.partitionBy(*WEEK, *others)
    seen = sums.select(
        "*", F.lag("tests", 1).over(w).alias("tests_lag1"), rolling(F.col("tests"), w, 4, 2).alias("tests_ma4"), rolling(F.col("tests"), w, 8, 3).alias("tests_ma8"), rolling(F.col("notificacoes"), w, 4, 2).alias("notificacoes_ma4"))
    volume = clip(F.col("tests") / F.greatest(F.percentile("tests", 0.95).over(week), F.lit(1.0)), 0, 1)
    placed = seen.select("*", (F.col("tests_ma4") - F.col("tests_ma8")).alias("tests_trend"), average_rank_share(F.col("tests"), [*WEEK, *others]).alias("tests_pct_estadual"), volume.alias("volume_norm"))
    joined = placed.join(network_shares(network, keys), keys, "left").fillna({"backlog_norm": 0.0, "tat_p90_norm": unknown_turnaround, "rejeicao_norm": 0.0})
    index = clip(100.0 * (0.40 * F.col("volume_norm") + 0.25 * F.col("backlog_norm") + 0.20 * F.col("tat_p90_norm") + 0.15 * F.col("rejeicao_norm")), 0, 100)
    out = joined.withColumn("indice_pressao_proxy", F.round(index, 2))
    return out.withColumn("faixa_pressao_proxy", bins(F.col("indice_pressao_proxy"), PRESSURE_CUTS, PRESSURE_LEVELS))


def pressure_labels(rows: DataFrame, keys: tuple[str, ...] = ("municipio",)) -> DataFrame:
    """O137: ``y_pressao_alta``: the next observed week has a high index, is in the top quarter of towns, or half again over the mean of eight weeks."""
    w = Window.partitionBy(*keys).orderBy(*WEEK)
    nxt = lambda c: F.lead(c, 1).over(w)
    ma8, tests = F.coalesce("tests_ma8", F.lit(0.0)), F.coalesce(nxt("tests"), F.lit(0))
    high = F.coalesce(nxt("indice_pressao_proxy") >= 55, F.lit(False)) | F.coalesce(nxt("tests_pct_estadual") >= 0.75, F.lit(False)) | ((tests >= 1.5 * ma8) & (tests >= 5) & (ma8 >= 2))
    return rows.select("*", high.cast("int").alias("y_pressao_alta"))
