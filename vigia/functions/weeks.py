"""Epidemiological weeks (ISO): parts, labels, arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epi_year(d: Column) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), d).cast("long")


def epi_week(d: Column) -> Column:
    return F.weekofyear(d).cast("long")


def week_label(y: Column, w: Column) -> Column:
    return F.format_string("%04d-SE%02d", y.cast("int"), w.cast("int"))


def monday(y: Column, w: Column) -> Column:
    """First day of the week; null where the year has no such week."""
    day = F.date_add(F.date_trunc("week", F.make_date(y.cast("int"), F.lit(1), F.lit(4))).cast("date"), (7 * (w - 1)).cast("int"))
    return F.when((w >= 1) & (epi_year(day) == y), day)


def advance(y: Column, w: Column, k: Column | int) -> tuple[Column, Column]:
    """k weeks on; the year turns after week 53, always."""
    k = k if isinstance(k, Column) else F.lit(k)
    return (y + F.floor((w - 1 + k) / 53)).cast("long"), (F.pmod(w - 1 + k, F.lit(53)) + 1).cast("long")


def ordinal(y: Column, w: Column) -> Column:
    """A number in which each step of ``advance`` is 1."""
    return y * 53 + w
