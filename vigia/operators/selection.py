"""Selections of a panel and the series that are shown of them (O48, O89, O104)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.measures import ratio
from ..functions.rules import holds
from ..functions.text import slug

#: Disease groups and the words by which a target's slug belongs to them.
GROUPS = {
    "Arboviroses": ["dengue", "zika", "chik", "oropouche", "febre_amarela", "mayaro"],
    "Respiratórios": ["sars", "cov", "influenza", "vsr", "rsv", "resp", "metapneumo", "rinovirus", "adenovirus"],
    "Tuberculose": ["tuberculose", "mtb", "rifampicina", "baciloscopia"],
    "Hepatites": ["hepatite", "hbv", "hcv", "hbsag"],
    "Meningites": ["mening", "pneumo", "meningoc"],
}


def selected(panel: DataFrame, group: str | None = None, towns: list[str] | None = None, targets: list[str] | None = None, years: tuple[int, int] | None = None, weeks: tuple[int, int] | None = None, groups: dict[str, list[str]] | None = None) -> DataFrame:
    """The rows of a disease group, of towns, targets, years and weeks; what is None selects all, an unknown group nothing. All are plain filters,
    which reach the scan."""
    out = panel
    if group is not None:
        out = out.where(holds(slug(F.col("target")), (GROUPS if groups is None else groups).get(group, [])))
    for column, names in (("municipio", towns), ("target", targets)):
        if names is not None:
            out = out.where(F.col(column).isin(names))
    for column, span in (("epi_year", years), ("epi_week", weeks)):
        if span is not None:
            out = out.where(F.col(column).between(*span))
    return out


def series(panel: DataFrame) -> DataFrame:
    """By week and target over all towns: sums, the mean incidence, and the positivity of the sums."""
    sums = panel.groupBy("epi_year", "epi_week", "target").agg(*[F.sum(c).alias(c) for c in ("tests", "positives", "notificacoes", "obitos")], F.avg("incidencia_100k").alias("incidencia_100k"))
    return sums.withColumn("positividade", ratio(F.col("positives"), F.col("tests")))


def annual_top(panel: DataFrame, n: int = 5) -> DataFrame:
    """O89, O104: by year the ``n`` targets with the most exams over all years (a list of so many is what it is for), with their place."""
    top = panel.groupBy("target").agg(F.sum("tests").alias("_all")).orderBy(F.desc("_all"), "target").limit(n)
    year = panel.join(F.broadcast(top), "target").groupBy("target", "epi_year", "_all").agg(F.sum("tests").alias("tests"), F.sum("positives").alias("positives"))
    return year.select("target", "epi_year", "tests", "positives", ratio(F.col("positives"), F.col("tests")).alias("positividade"), F.col("_all").alias("tests_total"))


def climate_series(weather: DataFrame, variables: list[str]) -> DataFrame:
    """By week the mean of each weather variable over the towns."""
    when = [c for c in ("epi_year", "epi_week") if c in weather.columns]
    return weather.groupBy(*when).agg(*[F.avg(c).alias(c) for c in variables])
