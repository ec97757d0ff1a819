"""Holiday rules -> holidays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.dates import easter_sunday, fixed_date
from ..schemas import (
    ALL_STATE_RULES,
    NATIONAL,
    NATIONAL_RULES,
    RULES,
    STATE_RULES,
    TIPO_NATIONAL,
    TIPO_STATE,
)
from ..sources import from_rows


def default_rules(spark: SparkSession, *, states: bool = True) -> DataFrame:
    """The national rules and, with ``states``, those of four states as a sample; see
    ``all_rules``. Any table with the same columns can take their place."""
    return from_rows(spark, NATIONAL_RULES + (STATE_RULES if states else []), RULES)


def all_rules(spark: SparkSession) -> DataFrame:
    """The national rules and those of all 27 states."""
    return from_rows(spark, NATIONAL_RULES + ALL_STATE_RULES, RULES)


def _bounds() -> tuple[Column, Column]:
    """First and last year of a rule; open ends lie beyond all years."""
    return F.coalesce("valid_from", F.lit(-(2**31))), F.coalesce("valid_to", F.lit(2**31 - 1))


def rule_conflicts(rules: DataFrame) -> DataFrame:
    """Rules that contradict each other or themselves: ``(scope, nome, valid_from, valid_to, problem)``.

    ``reversed``: a rule ends before it begins. ``overlap``: another rule of the scope with
    the same name is still in force when it begins, so a year has the holiday twice.
    ``unknown kind`` and ``no date`` are rules that never give a day.
    """
    first, last = _bounds()
    # One pass per scope and name: the latest end so far is all that later rules are held against.
    order = ["_first", F.asc_nulls_first("month"), F.asc_nulls_first("day"), F.asc_nulls_first("offset")]
    before = W.partitionBy("scope", "nome").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    placed = rules.withColumns({"_first": first, "_last": last}).withColumn("_open", F.max("_last").over(before))
    fixed = F.col("kind") == "fixed"
    no_date = F.when(fixed, F.col("month").isNull() | F.col("day").isNull()).otherwise(F.col("offset").isNull())
    problem = (
        F.when(~F.col("kind").isin("fixed", "easter") | F.col("kind").isNull(), "unknown kind")
        .when(no_date, "no date")
        .when(F.col("_last") < F.col("_first"), "reversed")
        .when(F.col("_open") >= F.col("_first"), "overlap")
    )
    return placed.withColumn("problem", problem).filter(F.col("problem").isNotNull()).select(
        "scope", "nome", "valid_from", "valid_to", "problem"
    )


def scopes_without_rules(rules: DataFrame, scopes: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """``(scope, ano)``: each scope of ``scopes`` and year in which none of its rules is in force.

    A calendar made of a sample shows here, scope by scope, instead of passing as complete.
    """
    first, last = _bounds()
    start, stop = F.greatest(first, F.lit(first_year)), F.least(last, F.lit(last_year))
    held = rules.select("scope", F.explode(F.when(start <= stop, F.sequence(start, stop))).alias("ano")).distinct()
    asked = scopes.select("scope").distinct().select("scope", F.explode(F.sequence(F.lit(first_year), F.lit(last_year))).alias("ano"))
    return asked.join(held, ["scope", "ano"], "left_anti")


def expand_rules(rules: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """``(data, nome, tipo, estado)``: one row per rule and year it is in force.

    A rule is a fixed month and day, or a number of days from Easter Sunday. A
    rule of one state gives rows of that state only, so no national holiday is
    repeated per state. Each rule unfolds by itself: no join, no shuffle.
    """
    start = F.greatest(F.coalesce("valid_from", F.lit(first_year)), F.lit(first_year))
    stop = F.least(F.coalesce("valid_to", F.lit(last_year)), F.lit(last_year))
    yearly = rules.select(
        "*", F.explode(F.when(start <= stop, F.sequence(start, stop))).alias("ano")
    )
    movable = F.col("kind") == "easter"
    on_fixed = fixed_date(F.col("ano"), F.col("month"), F.col("day"))
    # Decided without the Easter arithmetic, which then runs once per row.
    exists = F.when(movable, F.col("offset").isNotNull()).otherwise(on_fixed.isNotNull())
    national = F.col("scope") == NATIONAL
    return yearly.filter(exists).select(
        F.when(movable, F.date_add(easter_sunday("ano"), F.col("offset")))
        .otherwise(on_fixed)
        .alias("data"),
        "nome",
        F.when(national, TIPO_NATIONAL).otherwise(TIPO_STATE).alias("tipo"),
        F.col("scope").alias("estado"),
    )


def merge_same_day(holidays: DataFrame) -> DataFrame:
    """One row per day and state; the names that fall together are joined by ``; ``.

    Equal names fold on the map side, so a group holds the distinct rule names of
    one day and state, however many rows carry them.
    """
    names = F.array_sort(F.collect_set("nome"))
    return holidays.groupBy("data", "tipo", "estado").agg(
        F.when(F.size(names) > 0, F.array_join(names, "; ")).alias("nome")
    ).select("data", "nome", "tipo", "estado")
