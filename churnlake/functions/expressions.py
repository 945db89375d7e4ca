"""Column expressions shared by the operators. All stay inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from churnlake import schema as S


def col(name: str) -> Column:
    """A column by its exact name, dots and symbols included."""
    return F.col("`" + name.replace("`", "``") + "`")


def ts(moment: datetime) -> Column:
    """A zone-free timestamp literal, so that comparisons push down to the scan."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def elapsed_days(start: Column, end: Column) -> Column:
    """Whole elapsed 24-hour days, not calendar days."""
    return F.timestamp_diff("DAY", start, end)


def cut(value: Column, edges: Sequence[float], labels: Sequence[str],
        include_lowest: bool = False) -> Column:
    """Label of the right-closed band ``(lo, hi]`` holding the value, else NULL."""
    bands = list(zip(edges[:-1], edges[1:], labels))
    expr = None
    for i, (lo, hi, label) in enumerate(bands):
        above = value >= lo if include_lowest and i == 0 else value > lo
        inside = above & (value <= hi)
        expr = F.when(inside, label) if expr is None else expr.when(inside, label)
    return expr


def age_in(birthdate: Column, as_of_year: int) -> Column:
    return F.lit(as_of_year) - F.year(birthdate)


def age_band(age: Column) -> Column:
    return cut(age, S.AGE_EDGES, S.AGE_LABELS, include_lowest=True)


def rfm_bucket(total: Column) -> Column:
    return cut(total, S.RFM_EDGES, S.RFM_LABELS)


def ratio_or_zero(num: Column, den: Column) -> Column:
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def inactive(last_purchase: Column, threshold: datetime) -> Column:
    """1 for a user who never bought or whose last purchase is before the threshold."""
    return F.when(last_purchase.isNull() | (last_purchase < ts(threshold)), 1).otherwise(0)


def recency_days(last_purchase: Column, ref: datetime, horizon_days: int = S.CHURN_DAYS) -> Column:
    never = F.lit(horizon_days + S.NEVER_BOUGHT_EXTRA_DAYS).cast("bigint")
    return F.coalesce(elapsed_days(last_purchase, ts(ref)), never)


def gender_bin(gender: Column) -> Column:
    """1 for 'MALE' in any case and with white space around it, 0 for all else."""
    return F.when(F.upper(F.btrim(gender, F.lit(" \t\r\n\f\v"))) == "MALE", 1).otherwise(0)


def in_snapshot_cohort(gender: Column, age: Column) -> Column:
    lo, hi = S.SNAPSHOT_COHORT_AGES
    member = gender.isin(*S.SNAPSHOT_COHORT_GENDERS) & age.between(lo, hi)
    return F.when(member, 1).otherwise(0)


def in_model_cohort(age: Column, gender_flag: Column) -> Column:
    lo, hi = S.MODEL_COHORT_AGES
    return age.between(lo, hi) & (gender_flag == 1)


def to_number(value: Column) -> Column:
    """Text to double; text that is no number becomes NULL instead of an error.

    Type letters after a number (``1.0d``) make it none; single underscores between digits
    are read over.
    """
    text = F.regexp_replace(F.btrim(value.cast("string"), F.lit(" \t\r\n")),
                            "(?<=[0-9])_(?=[0-9])", "")
    number = text.rlike(r"(?i)^[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?|inf|infinity|nan)$")
    return F.when(number, text.try_cast("double"))


def finite(value: Column) -> Column:
    """NULL in place of NaN and of plus or minus infinity."""
    odd = F.isnan(value) | (F.abs(value) == float("inf"))
    return F.when(~odd, value)


def at_least(value: Column, floor: int) -> Column:
    return F.greatest(F.coalesce(value, F.lit(floor)), F.lit(floor))


def sigmoid(z: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-z))


def percent_text(rate: Column) -> Column:
    return F.format_string("%.2f%%", rate * 100)


def signed_points_text(points: Column) -> Column:
    return F.format_string("%+.2fpp", points)
