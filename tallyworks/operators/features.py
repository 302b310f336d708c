"""Features of dated sales and of case histories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.functions.dates import in_period, whole_years
from tallyworks.functions.fixed_values import (
    CHARGE_SEVERITY,
    EVENT_CENTRE,
    EVENT_DAYS,
    EVENT_NEIGHBOURS,
    EVENT_START,
    HOLIDAY_TYPES,
    NO_HOLIDAY_FILL,
)
from tallyworks.operators.aggs import any_by
from tallyworks.operators.frame import fill_values, recode, row_sum, same, stack
from tallyworks.operators.windows import fill_back, run_starts
from tallyworks.session import cut_lineage


def holiday_flag(
    day_type: Column, locale: Column, locale_name: Column, transferred: Column, city: Column, state: Column,
    types: list[str] = HOLIDAY_TYPES,
) -> Column:
    """Whether a calendar entry is a holiday for this store.

    The day was not moved away, has one of the holiday types, and holds for the country, for the
    store's city or for its state. Missing values make it false.
    """
    here = (
        same(locale, F.lit("National"))
        | (same(locale, F.lit("Local")) & same(city, locale_name))
        | (same(locale, F.lit("Regional")) & same(state, locale_name))
    )
    return here & same(transferred, F.lit(False)) & F.coalesce(day_type.isin(types), F.lit(False))


def holiday_scope(flag: Column, locale: Column) -> Column:
    return F.when(flag, locale).otherwise("No Holidays")


def proximity(
    date: Column, state: Column, start: str = EVENT_START, days: int = EVENT_DAYS,
    centre: list[str] = EVENT_CENTRE, neighbours: list[str] = EVENT_NEIGHBOURS,
) -> Column:
    """2 at the centre of an event while it lasts, 1 next to it, else 0."""
    now = in_period(date, start, days)
    return F.when(now & state.isin(centre), 2).when(now & state.isin(neighbours), 1).otherwise(0)


def first_holiday(
    df: DataFrame, flag: str, date: str, keys: list[str] = (), parts: int | None = None
) -> DataFrame:
    """Adds ``first_any`` (the first day of a run of days with a holiday somewhere) and
    ``first_here`` (the same where this row has a holiday itself).

    The days are reduced to one row each and stored before they are put in order.
    """
    by = list(keys)
    days = cut_lineage(any_by(df, [*by, date], F.col(flag), "__any"))
    starts = run_starts(days, by, [date], "__any", "first_any", parts).drop("__any")
    return df.join(starts, [*by, date], "left").withColumn(
        "first_here", F.coalesce(F.col(flag), F.lit(False)) & F.coalesce("first_any", F.lit(False))
    )


def sales_base(
    sales: DataFrame, to_predict: DataFrame, prices: DataFrame, stores: DataFrame, holidays: DataFrame,
    parts: int | None = None,
) -> DataFrame:
    """Sales and rows to predict with oil price, store and calendar entries of their day.

    Prices are filled backwards over the days that occur in the facts (a small table), then joined,
    which gives what filling over the joined facts gives, without ordering the facts. A day with
    several calendar entries multiplies its rows, as intended. ``type`` of the calendar becomes
    ``day_type``, that of the store ``store_type``.
    """
    facts = stack(sales, to_predict)
    days = cut_lineage(facts.select("date").distinct().join(prices, "date", "left"))
    filled = fill_back(days, [], ["date"], "dcoilwtico", "__price", parts)
    filled = filled.drop("dcoilwtico").withColumnRenamed("__price", "dcoilwtico")
    wide = (
        facts.join(filled, "date", "left")
        .join(stores.withColumnRenamed("type", "store_type"), "store_nbr", "left")
        .join(holidays.withColumnRenamed("type", "day_type"), "date", "left")
    )
    return fill_values(wide, NO_HOLIDAY_FILL)


def person_profile(
    charges: DataFrame, people: DataFrame, severity: dict[str, int] = CHARGE_SEVERITY, earliest: int = -30,
    days: str = "days_since_screening",
) -> DataFrame:
    """One row per person: highest severity, charges per severity 0..5, largest charge number and
    age at the first charge. Charges are left out when their ``days``
    column, counted from the screening, is ``earliest`` or less.

    Only the columns of the profile travel; the group is summed on the map side.
    """
    levels = sorted(set(severity.values()))
    recent = charges.where(F.col(days) > earliest)
    coded = recent.withColumn("__s", recode(F.col("charge_degree"), severity, keep_unknown=False))
    born = people.select(F.col("id").alias("person_id"), "dob")
    aged = coded.join(born, "person_id", "left").withColumn(
        "__age", whole_years(F.col("date_charge_filed").cast("date"), F.col("dob").cast("date"))
    )
    return (
        aged.where(F.col("person_id").isNotNull())
        .groupBy(F.col("person_id").alias("id"))
        .agg(
            F.max("__s").alias("highest_degree_charged"),
            *[F.count_if(F.col("__s") == v).alias(f"count_deg_{v}") for v in levels],
            F.max("charge_number").alias("max_charge_incid"),
            F.min("__age").alias("ear_charge_age"),
        )
    )


def base_table(
    profiles: DataFrame, scores: DataFrame, statuses: DataFrame, columns: list[str], days: int = 30
) -> DataFrame:
    """Profiles with scores and marital status, excluded cases removed, total of all charges added.

    A person with several statuses stays once per status. A missing score text stays, the text
    "N/A" goes.
    """
    status = statuses.select(F.col("person_id").alias("id"), "marital_status").dropDuplicates()
    wide = profiles.join(scores, "id").join(status, "id")
    kept = wide.where(
        (F.col("highest_degree_charged") != 0)
        & (F.col("is_recid") != -1)
        & F.col("days_b_screening_arrest").between(-days, days)
        & ~F.col("score_text").eqNullSafe("N/A")
    )
    counts = [F.col(c) for c in profiles.columns if c.startswith("count_deg_")]
    return kept.withColumn("total_prior_charges", row_sum(counts)).select(*columns)
