"""Scalar expressions over single rows; all stay inside generated code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as C


def known(col: Column) -> Column:
    """Null for the text codes that mean 'missing'."""
    return F.when(~col.isin(C.MISSING_TOKENS), col)


def parse_time(col: Column) -> Column:
    """UTC timestamp, null when unparseable or outside the nanosecond span."""
    ts = F.try_to_timestamp(col)
    return F.when(ts.between(F.lit(C.TIMESTAMP_MIN).cast("timestamp"),
                             F.lit(C.TIMESTAMP_MAX).cast("timestamp")), ts)


def parse_number(col: Column) -> Column:
    """Double, null for anything that is not a plain decimal or exponent form."""
    text = F.trim(col)
    return F.when(text.rlike(C.NUMBER_PATTERN), text.try_cast("double"))


def valid_failure(col: Column) -> Column:
    return F.when(col.isin(C.FAILURE_CODES), col.cast("int"))


def add_flag(flags: Column, flag: str, when: Column, once: bool = False) -> Column:
    """Append a quality flag; `once` keeps it from repeating."""
    added = F.array_append(flags, F.lit(flag))
    if once:
        when = when & ~F.array_contains(flags, flag)
    return F.when(when, added).otherwise(flags)


def render_flags(flags: Column) -> Column:
    return F.when(F.size(flags) == 0, F.lit("OK")).otherwise(F.array_join(flags, "|"))


def text_if(cond: Column, text: Column) -> Column:
    return F.when(cond, text)


def names_where(conditions: dict[str, Column]) -> Column:
    """Array of the names whose condition holds, in the given order."""
    picked = F.array(*[F.when(cond, F.lit(name)) for name, cond in conditions.items()])
    return F.array_compact(picked)


def fixed(col: Column, digits: int) -> Column:
    return F.format_string(f"%.{digits}f", col)


def strip_right(col: Column, chars: str) -> Column:
    """Remove any trailing characters of the set `chars`."""
    return F.rtrim(col, F.lit(chars))


def failure_label(failure: Column) -> Column:
    return (F.when(failure == 1, "Breakage").when(failure == 2, "Overheat")
            .otherwise(C.NO_FAILURE))


def load_proxy(rpm: Column, pressure: Column, voltage: Column) -> Column:
    return rpm * pressure / (F.abs(voltage) + 1.0)


def energy_per_cycle(consumption: Column, duration: Column) -> Column:
    return consumption * duration


def cycle_ratio(duration: Column, target: Column) -> Column:
    """Training rule: target 0 or a missing duration gives 1."""
    return F.coalesce(duration / F.nullif(target, F.lit(0)), F.lit(1.0))


def cycle_ratio_panel(duration: Column, target: Column) -> Column:
    """Dashboard rule: target <= 0 gives 1, a missing duration stays missing."""
    return F.when(target > 0, duration / target).otherwise(F.lit(1.0))


def clamp(value: Column, low: float, high: float) -> Column:
    """Clip to [low, high]; missing passes through (greatest/least skip nulls)."""
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high)))


def clamp_min(value: Column, low: float) -> Column:
    return F.greatest(value, F.lit(low))


def alert_level(anomaly: Column, score: Column, threshold: float = C.ALERT_THRESHOLD) -> Column:
    critical = max(C.CRITICAL_FLOOR, threshold)
    return (F.when(~anomaly, "nominal").when(score >= critical, "critical")
            .otherwise("warning"))


def hours_between(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(3.6e9)


def version_stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd'T'HHmmss'Z'")


def small_median(values: list[Column]) -> Column:
    """Median of a few columns, nulls skipped; null when all are null."""
    kept = F.array_sort(F.array_compact(F.array(*values)))
    return F.transform(
        F.array(kept),
        lambda a: F.when(F.size(a) > 0,
                         (F.get(a, ((F.size(a) - 1) / 2).cast("int"))
                          + F.get(a, (F.size(a) / 2).cast("int"))) / 2.0),
    )[0]


def squared_distance(pairs: list[tuple[Column, Column]]) -> Column:
    return reduce(lambda a, b: a + b, [(x - y) * (x - y) for x, y in pairs])


def failure_verdict(n0: Column, n1: Column, n2: Column) -> Column:
    """Failure code of a conflict from the counts of 0, 1 and 2.

    A unique most frequent code wins. On a tie the only failure code present
    wins; with both or neither present the verdict stays open.
    """
    top = F.greatest(n0, n1, n2)
    modes = sum(((n == top).cast("int") for n in (n0, n1, n2)), F.lit(0))
    return (F.when(top == 0, F.lit(None).cast("int"))
            .when(modes == 1, F.when(n0 == top, 0).when(n1 == top, 1).otherwise(2))
            .when((n1 > 0) & (n2 == 0), 1)
            .when((n2 > 0) & (n1 == 0), 2))
