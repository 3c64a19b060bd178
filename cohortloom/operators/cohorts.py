"""Activity labels, registration cohorts, retention and membership audits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from cohortloom.functions.binning import (
    Bin, bin_index, bin_label, bin_table, cohort_bins, period_bins,
)
from cohortloom.sources.schemas import HORIZON


def label_days(launch: DataFrame, video: DataFrame, activity: DataFrame) -> DataFrame:
    """Distinct (user, day) over the three logs: one union, one distinct, one shuffle."""
    logs = [log.select("user_id", "day") for log in (launch, video, activity)]
    return reduce(DataFrame.unionByName, logs).distinct()


# Days held by one number.
_BITS = 62


def day_masks(labels: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """The active days of a user as bits, ``_BITS`` days to a number ``days0``, ``days1``, ...

    Days are small integers, so a user's label rows fit in a few BIGINTs. They are combined
    map-side, and everything that follows has one row per user: no distinct counts.
    """
    day = F.col("day")
    bit = f"shiftleft(1L, CAST(day % {_BITS} AS INT))"
    return (
        labels.filter(day.between(1, horizon) & F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(*[
            F.bit_or(F.expr(f"CASE WHEN day DIV {_BITS} = {word} THEN {bit} END")).alias(f"days{word}")
            for word in range(horizon // _BITS + 1)
        ])
    )


def _active_in(lo: int, hi: int) -> str:
    words: dict[int, int] = {}
    for day in range(lo + 1, hi + 1):
        words[day // _BITS] = words.get(day // _BITS, 0) | 1 << day % _BITS
    tests = [f"coalesce(days{word}, 0L) & {bits}L <> 0" for word, bits in words.items()]
    return f"({' OR '.join(tests)})" if tests else "false"


def register_cohorts(register: DataFrame, bins: Sequence[Bin] | None = None) -> DataFrame:
    """(cohort, user) rows, distinct; registrations outside all bins are left out."""
    bins = list(bins or cohort_bins())
    number = bin_index(F.col("register_day"), bins)
    name = F.when(F.lit(False), "")
    for i, (lo, hi) in enumerate(bins):
        name = name.when(number == i, bin_label(lo, hi))
    return (
        register.select(name.alias("cohort"), "user_id")
        .filter(F.col("cohort").isNotNull())
        .distinct()
    )


def cohort_sizes(register: DataFrame, bins: Sequence[Bin] | None = None) -> DataFrame:
    """Users per cohort; an empty cohort is listed with 0."""
    bins = list(bins or cohort_bins())
    counted = (
        register_cohorts(register, bins).groupBy("cohort").agg(F.count("user_id").alias("n"))
    )
    return (
        bin_table(register.sparkSession, bins, "cohort")
        .join(counted, "cohort", "left")
        .select("cohort_no", "cohort", F.coalesce("n", F.lit(0)).alias("users"))
    )


def late_registrants(register: DataFrame, split_day: int = 23) -> DataFrame:
    """Users registered after the split day."""
    return register.filter(F.col("register_day") > split_day).select("user_id").distinct()


def retention(
    register: DataFrame,
    labels: DataFrame,
    split_day: int = 23,
    step: int = 7,
    period: int = 7,
    horizon: int = HORIZON,
) -> DataFrame:
    """Per cohort: its size as row 0, then the users active in each period after its edge.

    The counts of all cohorts and periods are one aggregate over one row per user;
    periods nobody was active in are there with 0.
    """
    bins = cohort_bins(split_day, step)
    layout: list[tuple[int, int, str, str, int, int]] = []
    for c, (lo, hi) in enumerate(bins):
        layout.append((c, 0, bin_label(lo, hi), bin_label(lo, hi), 0, 0))
        for i, (a, b) in enumerate(period_bins(hi, period, horizon), start=1):
            layout.append((c, i, bin_label(lo, hi), bin_label(a, b), a, b))

    users = register.select(
        bin_index(F.col("register_day"), bins).alias("cohort_no"), "user_id"
    ).filter(F.col("cohort_no").isNotNull()).distinct()
    known = users.join(day_masks(labels, horizon), "user_id", "left")

    def belongs(row) -> str:
        c, i, _, _, lo, hi = row
        mine = f"cohort_no = {c}"
        return mine if i == 0 else f"{mine} AND {_active_in(lo, hi)}"

    counts = known.agg(
        *[F.expr(f"count(CASE WHEN {belongs(row)} THEN 1 END) AS n{k}") for k, row in enumerate(layout)]
    )
    rows = ", ".join(
        f"struct({c}L AS cohort_no, {i}L AS period_no, '{cohort}' AS cohort, '{name}' AS period, n{k} AS users)"
        for k, (c, i, cohort, name, _, _) in enumerate(layout)
    )
    return counts.selectExpr(f"inline(array({rows}))")


def label_people(
    register: DataFrame,
    labels: DataFrame,
    start_day: int,
    end_day: int,
    period: int = 7,
    horizon: int = HORIZON,
) -> DataFrame:
    """(period, user) rows: registrants of [start, end] active in each period after ``end``."""
    people = (
        register.filter(F.col("register_day").between(start_day, end_day))
        .select("user_id").distinct()
    )
    known = people.join(day_masks(labels, horizon), "user_id")
    periods = ", ".join(
        f"CASE WHEN {_active_in(lo, hi)} THEN struct({i}L AS period_no, '{bin_label(lo, hi)}' AS period) END"
        for i, (lo, hi) in enumerate(period_bins(end_day, period, horizon))
    )
    return known.selectExpr("user_id", f"inline(array_compact(array({periods})))").select(
        "period_no", "period", "user_id"
    )


def label_people_counts(
    register: DataFrame, labels: DataFrame, start_day: int, end_day: int, period: int = 7
) -> DataFrame:
    """How many people each period has, empty periods included."""
    bins = period_bins(end_day, period)
    counted = (
        label_people(register, labels, start_day, end_day, period)
        .groupBy("period").agg(F.count("user_id").alias("n"))
    )
    return (
        bin_table(register.sparkSession, bins, "period")
        .join(counted, "period", "left")
        .select("period", F.coalesce("n", F.lit(0)).alias("users"))
    )


def return_labels(
    register: DataFrame, labels: DataFrame, start_day: int, end_day: int, days: int = 7
) -> DataFrame:
    """Each registrant of [start, end] with 1 if active in the ``days`` after ``end``, else 0."""
    people = (
        register.filter(F.col("register_day").between(start_day, end_day))
        .select("user_id").distinct()
    )
    known = people.join(day_masks(labels, end_day + days), "user_id", "left")
    active = _active_in(end_day, end_day + days)
    return known.selectExpr("user_id", f"CASE WHEN {active} THEN 1L ELSE 0L END AS label")


def membership(logs: Mapping[str, DataFrame]) -> DataFrame:
    """One row per user with a bit for each log the user occurs in."""
    tagged = [
        log.select("user_id", F.lit(1 << i).cast("long").alias("bit"))
        for i, log in enumerate(logs.values())
    ]
    return (
        reduce(DataFrame.unionByName, tagged)
        .filter(F.col("user_id").isNotNull())
        .groupBy("user_id").agg(F.bit_or("bit").alias("bits"))
    )


def set_audits(logs: Mapping[str, DataFrame]) -> DataFrame:
    """For every ordered pair of logs, how many users are in the one and not in the other."""
    names = list(logs)
    pairs = [(i, j) for i in range(len(names)) for j in range(len(names)) if i != j]

    def only(i: int, j: int) -> str:
        return f"bits & {(1 << i) | (1 << j)}L = {1 << i}L"

    counts = membership(logs).agg(
        *[F.expr(f"count(CASE WHEN {only(i, j)} THEN 1 END) AS n{i}_{j}") for i, j in pairs]
    )
    rows = ", ".join(
        f"struct('{names[i]}' AS in_log, '{names[j]}' AS not_in_log, n{i}_{j} AS users)" for i, j in pairs
    )
    return counts.selectExpr(f"inline(array({rows}))")


def users_missing(present: DataFrame, absent: DataFrame) -> DataFrame:
    """The users themselves: in ``present`` but not in ``absent``."""
    return present.select("user_id").distinct().join(
        absent.select("user_id").distinct(), "user_id", "left_anti"
    )
