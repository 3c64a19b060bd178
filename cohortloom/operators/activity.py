"""One feature row per registered user from four logs.

The three event logs are read once and reduced together to rows (user, kind, thing): every log
row stands for its day, and a row of the activity log also for its page, action, page-action
pair, video and author. Log rows are moved by their user before they are multiplied; a user
of a million rows or more is grouped by all three columns, combined map-side, and so
spread over all tasks. A row keeps one state per day
window (how often, on which pages, by which actions), so many windows cost no more rows than
one. The reduced table is written; the columns of every user and the series per day are two
aggregates over it, and nothing goes back to the logs.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from cohortloom.functions.joins import lookup_all
from cohortloom.operators.windows import DayWindow, in_window, in_windows
from cohortloom.session import settle
from cohortloom.sources.schemas import ACTIONS, HORIZON, PAGES

# Column names of the feature row.
REGISTER_COLUMNS = [
    "user_id", "register_day", "register_type", "device_type",
    "register_day_user_id", "register_type_user_id", "device_type_user_id",
]
LAUNCH_COLUMNS = [
    "last_launch_day", "last_launch_day_sub_register", "register_cnt", "launch_days",
    "launch_day_user", "avg_launch_day", "register_sub_launch",
]
VIDEO_COLUMNS = [
    "first_video_day", "last_video_day", "first_video_day_sub_register",
    "last_video_day_sub_register", "video_days", "video_frequency_avg",
    "video_frequency_max", "video_frequency_min", "video_frequency_std",
    "video_frequency_total", "avg_video_day", "register_sub_video", "launch_sub_video",
    "video_day_user", "video_day_frequency", "last_video_sub_frist_video", "video_span",
]
ACTIVITY_COLUMNS = [
    "first_activity_day", "last_activity_day", "first_activity_day_sub_register",
    "last_activity_day_sub_register", "activity_days", "activity_frequency_avg",
    "activity_frequency_max", "activity_frequency_min", "activity_frequency_std",
    "activity_frequency_total", "avg_activity_day", "register_sub_activity",
    "launch_sub_activity", "activity_sub_video", "activity_day_user",
    "activity_day_frequency", "last_activity_sub_frist_activity", "activity_span",
]
DISTINCT_COLUMNS = ["user_page_cnt", "user_video_cnt", "user_author_cnt", "user_action_cnt"]


def page_columns(pages: Sequence[int] = PAGES) -> list[str]:
    return [
        f"page{p}_{what}"
        for what in ("frequency", "day", "video", "author", "action")
        for p in pages
    ]


def action_columns(actions: Sequence[int] = ACTIONS) -> list[str]:
    return [
        f"action{a}_{what}"
        for what in ("frequency", "day", "video", "author", "page")
        for a in actions
    ]


# --- daily counts -----------------------------------------------------------------


def user_day_counts(log: DataFrame, keys: Sequence[str] = ("user_id",)) -> DataFrame:
    """Rows per user and day."""
    return log.groupBy(*keys, "day").agg(F.count(F.lit(1)).alias("frequency"))


def daily_series(
    log: DataFrame, name: str, window: Sequence[str] = (), events: bool = True
) -> DataFrame:
    """Distinct users (and events) per day, keyed by ``register_day`` to be looked up.

    Built from (user, day) counts: no distinct aggregate, and a hot day is shared by
    all tasks until one row per task is left of it.
    """
    wanted = [F.count("user_id").alias(f"{name}_day_user")]
    if events:
        wanted.append(
            F.sum(F.when(F.col("user_id").isNotNull(), F.col("frequency"))).alias(
                f"{name}_day_frequency"
            )
        )
    per_day = user_day_counts(log, [*window, "user_id"]).groupBy(*window, "day").agg(*wanted)
    return per_day.withColumnRenamed("day", "register_day")


def first_and_last(log: DataFrame, name: str, keys: Sequence[str] = ("user_id",)) -> DataFrame:
    """First and last day per user; a minimum and a maximum, nothing is sorted."""
    return log.groupBy(*keys).agg(
        F.min("day").alias(f"first_{name}_day"), F.max("day").alias(f"last_{name}_day")
    )


def edge_rows(log: DataFrame, last: bool = False) -> DataFrame:
    """The whole first (or last) row per user by day.

    ``min_by`` on a struct keeps one row per task and user; ties on the day are
    settled by the other columns, so the result does not depend on the row order.
    """
    rest = [c for c in log.columns if c not in ("user_id", "day")]
    row = F.struct("day", *rest)
    best = F.max(row) if last else F.min(row)
    return log.groupBy("user_id").agg(best.alias("_row")).select("user_id", "_row.*")


# --- feature families ---------------------------------------------------------------


def _keys(window_tag: bool) -> list[str]:
    return ["window", "user_id"] if window_tag else ["user_id"]


def register_features(register: DataFrame, window_tag: bool = False) -> DataFrame:
    """Registrants with the number of distinct users per day, type and device.

    The three counts come from one pass in long form, are written once and counted, so
    that the lookups know whether they may broadcast: a handful of types would make a
    shuffle by type a matter of a handful of tasks.
    """
    tag = ["window"] if window_tag else []
    grouped = ["register_day", "register_type", "device_type"]
    base = register.select(*tag, "user_id", *grouped)
    users = (
        base.unpivot([*tag, "user_id"], grouped, "feature", "thing")
        .filter(F.col("thing").isNotNull())
        .groupBy("feature", "thing", *tag, "user_id")
        .agg(F.lit(1).alias("_seen"))
        .groupBy("feature", "thing", *tag)
        .agg(F.count("user_id").alias("users"))
    )
    keys = {column: [column, *tag] for column in grouped}
    return lookup_all(base, users, keys, ["thing", *tag], "users", "_user_id").select(
        *tag, *REGISTER_COLUMNS
    )


def launch_per_user(launch: DataFrame, window_tag: bool = False) -> DataFrame:
    """Last day and number of rows."""
    return launch.groupBy(*_keys(window_tag)).agg(
        F.max("day").alias("last_launch_day"),
        F.count("day").alias("launch_days"),
    )


def video_per_user(video: DataFrame, window_tag: bool = False) -> DataFrame:
    """First and last day, days, and the statistics of the daily frequency."""
    keys = _keys(window_tag)
    return user_day_counts(video, keys).groupBy(*keys).agg(*_day_statistics("video"))


def _day_statistics(name: str, only: str | None = None, day: str = "day") -> list[Column]:
    """Statistics over (user, day) rows; ``only`` picks these rows out of a mixed set."""
    at = f"CASE WHEN {only} THEN {day} END" if only else day
    frequency = f"CASE WHEN {only} THEN frequency END" if only else "frequency"
    return [
        F.expr(c)
        for c in (
            f"min({at}) AS first_{name}_day",
            f"max({at}) AS last_{name}_day",
            f"nullif(count({at}), 0L) AS {name}_days",
            f"avg({frequency}) AS {name}_frequency_avg",
            f"max({frequency}) AS {name}_frequency_max",
            f"min({frequency}) AS {name}_frequency_min",
            f"stddev_samp({frequency}) AS {name}_frequency_std",
            f"sum({frequency}) AS {name}_frequency_total",
        )
    ]


# Kinds of counted things in the mixed (user, kind, thing) rows.
_DAY, _PAGE, _ACTION, _PAIR, _VIDEO, _AUTHOR = "d", "p", "a", "x", "v", "u"
# Days of the other two logs.
_LAUNCHED, _FILMED = "l", "f"
_DAYS = (_DAY, _LAUNCHED, _FILMED)
# Kinds of an activity row that a family of columns reads; its days tell that there are rows.
_NEEDED = {
    "days": {_DAY},
    "distinct": {_DAY, _PAGE, _ACTION, _VIDEO, _AUTHOR},
    "pages": {_DAY, _PAGE, _PAIR, _VIDEO, _AUTHOR},
    "actions": {_DAY, _ACTION, _PAIR, _VIDEO, _AUTHOR},
}
_FAMILIES = tuple(_NEEDED)
# A page-action pair is one number: the page in the upper half, the action in the lower.
_LOW = 0xFFFFFFFF


# Values held by one mask.
_BITS = 62
# Users are counted in this many slots; one with more rows than HOT_ROWS holds a hot user.
_SLOTS = 1 << 16
HOT_ROWS = 1_000_000
# Log rows of a part that holds whole users.
PART_ROWS = 250_000


def _masks(column: str, name: str, values: Sequence[int]) -> dict[str, str]:
    """One bit for each listed value, none for the others; as many masks as the list needs."""
    out = {}
    for word in range(len(values) // _BITS + 1):
        arms = " ".join(f"WHEN {int(v)} THEN {1 << i}L" for i, v in enumerate(values[word * _BITS : (word + 1) * _BITS]))
        out[f"{name}_mask{word}"] = f"CASE {column} {arms} ELSE 0L END" if arms else "0L"
    return out


def _number(condition: str) -> str:
    """Number of rows that meet the condition, NULL if there is none."""
    return f"nullif(count(CASE WHEN {condition} THEN 1 END), 0L)"


def _marked(
    log: DataFrame, keys: Sequence[str], kinds: dict[str, str], masks: dict[str, str]
) -> DataFrame:
    """(keys, _day, masks, kind, thing): a row per kind of thing that a log row stands for.

    Generated, not unpivoted: rows stay known to be parted by their keys.
    """
    marked = log.selectExpr(
        *[f"`{k}`" for k in keys], "day AS _day",
        *[f"{bits} AS {name}" for name, bits in masks.items()],
        *[f"{value} AS `_thing_{kind}`" for kind, value in kinds.items()],
    )
    things = F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(f"_thing_{kind}").alias("thing")) for kind in kinds])
    long = marked.select(*keys, "_day", *masks, F.inline(things))
    return long.filter(F.col("thing").isNotNull())


def _activity_kinds(parts: Sequence[str]) -> dict[str, str]:
    values = {
        _DAY: "day", _PAGE: "page", _ACTION: "action_type",
        _PAIR: f"shiftleft(page, 32) | (action_type & {_LOW}L)", _VIDEO: "video_id", _AUTHOR: "author_id",
    }
    needed = set().union(*(_NEEDED[p] for p in parts))
    return {kind: value for kind, value in values.items() if kind in needed}


def _value_masks(parts: Sequence[str], pages: Sequence[int], actions: Sequence[int]) -> dict[str, str]:
    found = _masks("page", "page", pages) if "pages" in parts else {}
    return found | (_masks("action_type", "action", actions) if "actions" in parts else {})


def activity_things(
    activity: DataFrame,
    pages: Sequence[int] = PAGES,
    actions: Sequence[int] = ACTIONS,
    window_tag: bool = False,
    parts: Sequence[str] = _FAMILIES,
) -> DataFrame:
    """One row per (user, kind, thing): how often, on which pages, by which actions.

    The kinds are the day, the page, the action, the page-action pair, the video and
    the author of a log row, as far as ``parts`` needs them. Grouping is by all three
    columns, so neither a hot user nor a hot video makes a large group.
    """
    keys = _keys(window_tag)
    masks = _value_masks(parts, pages, actions)
    return _marked(activity, keys, _activity_kinds(parts), masks).groupBy(*keys, "kind", "thing").agg(
        F.count(F.lit(1)).alias("frequency"), *[F.bit_or(name).alias(name) for name in masks]
    )


def _raw_rows(launch: DataFrame | None, video: DataFrame | None, activity: DataFrame | None, parts: Sequence[str]) -> DataFrame:
    """Rows of all logs side by side: the log they are of, user, day and what an activity row needs."""
    rows = []
    for log, kind in ((launch, _LAUNCHED), (video, _FILMED)):
        if log is not None:
            rows.append(log.select(F.lit(kind).alias("_log"), "user_id", "day"))
    if activity is not None:
        used = [c for c in ("page", "action_type", "video_id", "author_id") if any(c in v for v in _activity_kinds(parts).values())]
        rows.append(activity.select(F.lit(_DAY).alias("_log"), "user_id", "day", *used))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)


def log_things(
    launch: DataFrame | None,
    video: DataFrame | None,
    activity: DataFrame | None,
    windows: Sequence[DayWindow],
    pages: Sequence[int] = PAGES,
    actions: Sequence[int] = ACTIONS,
    parts: Sequence[str] = _FAMILIES,
    hot_rows: int = HOT_ROWS,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """(window, user_id, kind, thing, frequency, masks) of all logs, each read once.

    Log rows are written once and moved by their user, before they stand for anything: one row
    is moved where six would be, and a user's things come to lie together. A part has
    about ``part_rows`` rows. Users in a slot of more than ``hot_rows`` rows are grouped by
    (user, kind, thing) instead, combined map-side, so no user's log lands in one task.
    Rows are grouped once, whatever the number of windows: a group has one state per window,
    and leaves as one row for each window that saw it. Days come out shifted.
    """
    masks = _value_masks(parts, pages, actions) if activity is not None else {}
    kinds = {}
    if launch is not None:
        kinds[_LAUNCHED] = f"CASE WHEN _log = '{_LAUNCHED}' THEN day END"
    if video is not None:
        kinds[_FILMED] = f"CASE WHEN _log = '{_FILMED}' THEN day END"
    if activity is not None:
        kinds |= _activity_kinds(parts)
        kinds[_DAY] = f"CASE WHEN _log = '{_DAY}' THEN day END"
    read = " OR ".join(f"({w.reads('day')})" for w in windows)
    raw = settle(_raw_rows(launch, video, activity, parts).filter(read))
    slot = F.pmod(F.xxhash64("user_id"), F.lit(_SLOTS))
    counts = raw.groupBy(slot.alias("slot")).agg(F.count(F.lit(1)).alias("n")).collect()  # _SLOTS rows at most
    hot = [r["slot"] for r in counts if r["n"] > hot_rows]
    cold_rows = sum(r["n"] for r in counts if r["n"] <= hot_rows)
    least = int(raw.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cold = raw.filter(~slot.isin(hot)).repartition(max(least, -(-cold_rows // part_rows)), "user_id")
    grouped = _states(_marked(cold, ["user_id"], kinds, masks), windows, masks)
    if hot:
        grouped = grouped.unionByName(_states(_marked(raw.filter(slot.isin(hot)), ["user_id"], kinds, masks), windows, masks))
    seen = F.array(*[
        F.struct(
            F.lit(w.name).alias("window"), F.lit(w.shift).cast("long").alias("_shift"), F.col(f"_n{i}").alias("frequency"),
            *[F.col(f"_{m}_{i}").alias(m) for m in masks],
        )
        for i, w in enumerate(windows)
    ])
    per_window = grouped.select("user_id", "kind", "thing", F.inline(F.filter(seen, lambda x: x["frequency"].isNotNull())))
    thing = F.when(F.col("kind").isin(*_DAYS), F.col("thing") + F.col("_shift")).otherwise(F.col("thing"))
    return per_window.select("window", "user_id", "kind", thing.alias("thing"), "frequency", *masks)


def _states(long: DataFrame, windows: Sequence[DayWindow], masks: dict[str, str]) -> DataFrame:
    """Per (user, kind, thing) and window: how often, and on which pages and by which actions."""
    states = []
    for i, w in enumerate(windows):
        inside = w.reads("_day")
        states.append(F.expr(f"sum(CASE WHEN {inside} THEN 1L END)").alias(f"_n{i}"))
        states += [F.expr(f"bit_or(CASE WHEN {inside} THEN {m} END)").alias(f"_{m}_{i}") for m in masks]
    return long.groupBy("user_id", "kind", "thing").agg(*states)


def _pivots(name: str, values: Sequence[int], kind: str, half: str, crossed: str) -> list[Column]:
    """Columns of one pivoted attribute; ``half`` is where a pair keeps its value."""
    columns = []
    for position, v in enumerate(values):
        bit = f"{name}_mask{position // _BITS} & {1 << position % _BITS}L <> 0"
        columns += [
            f"sum(CASE WHEN kind = '{kind}' AND thing = {v} THEN frequency END) AS {name}{v}_frequency",
            f"{_number(f'kind = {_DAY!r} AND {bit}')} AS {name}{v}_day",
            f"{_number(f'kind = {_VIDEO!r} AND {bit}')} AS {name}{v}_video",
            f"{_number(f'kind = {_AUTHOR!r} AND {bit}')} AS {name}{v}_author",
            f"{_number(f'kind = {_PAIR!r} AND {half.format(v=v)}')} AS {name}{v}_{crossed}",
        ]
    return [F.expr(c) for c in columns]


def _page_pivots(pages: Sequence[int]) -> list[Column]:
    return _pivots("page", pages, _PAGE, "shiftright(thing, 32) = {v}", "action")


def _action_pivots(actions: Sequence[int]) -> list[Column]:
    half = f"thing & {_LOW}L = {{v}} & {_LOW}L"
    return _pivots("action", actions, _ACTION, half, "page")


def _distinct_counts() -> list[Column]:
    """0 for what a user's rows left empty, NULL for a user without rows."""
    rows = f"count(CASE WHEN kind = '{_DAY}' THEN 1 END) > 0"
    return [
        F.expr(f"CASE WHEN {rows} THEN count(CASE WHEN kind = '{which}' THEN 1 END) END AS {name}")
        for name, which in zip(DISTINCT_COLUMNS, (_PAGE, _VIDEO, _AUTHOR, _ACTION))
    ]


def _activity_columns(parts: Sequence[str], pages: Sequence[int], actions: Sequence[int]) -> list[Column]:
    wanted: list[Column] = []
    if "days" in parts:
        wanted += _day_statistics("activity", f"kind = '{_DAY}'", "thing")
    if "distinct" in parts:
        wanted += _distinct_counts()
    if "pages" in parts:
        wanted += _page_pivots(pages)
    if "actions" in parts:
        wanted += _action_pivots(actions)
    return wanted


def activity_per_user(
    activity: DataFrame,
    pages: Sequence[int] = PAGES,
    actions: Sequence[int] = ACTIONS,
    window_tag: bool = False,
    parts: Sequence[str] = _FAMILIES,
) -> DataFrame:
    """All per-user columns of the activity log from one read of it."""
    things = activity_things(activity, pages, actions, window_tag, parts)
    return things.groupBy(*_keys(window_tag)).agg(*_activity_columns(parts, pages, actions))


def _series_of(things: DataFrame, names: dict[str, str], tag: Sequence[str]) -> DataFrame:
    """Distinct users and events per day and kind, keyed by ``register_day``; kind -> name."""
    known = F.col("user_id").isNotNull()
    columns = []
    for kind, name in names.items():
        mine = (F.col("kind") == kind) & known
        columns.append(F.count(F.when(mine, 1)).alias(f"{name}_day_user"))
        columns.append(F.sum(F.when(mine, F.col("frequency"))).alias(f"{name}_day_frequency"))
    per_day = things.filter(F.col("kind").isin(list(names))).groupBy(*tag, F.col("thing").alias("register_day"))
    # a day without rows of a log has no number of users, rather than 0
    users = [F.expr(f"nullif({name}_day_user, 0L)").alias(f"{name}_day_user") for name in names.values()]
    return per_day.agg(*columns).select(*tag, "register_day", *users, *[f"{n}_day_frequency" for n in names.values()])


def distinct_counts(activity: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct pages, videos, authors and actions per user; sketches if asked for."""
    if not approximate:
        return activity_per_user(activity, parts=("distinct",))
    return activity.groupBy("user_id").agg(
        *[
            F.approx_count_distinct(c).alias(n)
            for c, n in zip(("page", "video_id", "author_id", "action_type"), DISTINCT_COLUMNS)
        ]
    )


# --- derived columns ----------------------------------------------------------------


def _launch_derived(closing: int) -> dict[str, str]:
    cnt = f"({closing + 1} - register_day)"
    return {
        "last_launch_day_sub_register": "last_launch_day - register_day",
        "register_cnt": cnt,
        "avg_launch_day": f"try_divide(CAST(launch_days AS DOUBLE), {cnt})",
        "register_sub_launch": f"{cnt} - launch_days",
    }


def _log_derived(name: str, closing: int) -> dict[str, str]:
    cnt = f"({closing + 1} - register_day)"
    first, last, days = f"first_{name}_day", f"last_{name}_day", f"{name}_days"
    return {
        f"{first}_sub_register": f"{first} - register_day",
        f"{last}_sub_register": f"{last} - register_day",
        f"avg_{name}_day": f"try_divide(CAST({days} AS DOUBLE), {cnt})",
        f"register_sub_{name}": f"{cnt} - {days}",
        f"launch_sub_{name}": f"launch_days - {days}",
        # the two gaps "last minus first": by days, as it is named, and in true days
        f"last_{name}_sub_frist_{name}": f"{last} - {days}",
        f"{name}_span": f"{last} - {first}",
    }


# --- whole rows -----------------------------------------------------------------------


def user_features(
    register: DataFrame,
    launch: DataFrame,
    video: DataFrame,
    activity: DataFrame,
    window: DayWindow | Sequence[DayWindow] = DayWindow(),
    pages: Sequence[int] = PAGES,
    actions: Sequence[int] = ACTIONS,
    parts: Sequence[str] = ("launch", "video", "activity", "distinct", "pages", "actions"),
) -> DataFrame:
    """One row per registrant of the window, or per (window, registrant) for a list.

    ``parts`` picks feature families; logs that none of them needs are not read.
    """
    many = not isinstance(window, DayWindow)
    windows = list(window) if many else [window]
    tag = ["window"] if many else []
    keys = _keys(many)
    closing = HORIZON if many else window.closing_day
    if many:
        registered = in_windows(register.sparkSession, register, "register_day", windows, whole=False)
    else:
        registered = in_window(register, "register_day", window, whole=False)
    users = register_features(registered, many)
    columns = list(users.columns)
    derived: dict[str, str] = {}
    series: dict[str, str] = {}
    measures: list[Column] = []

    families = [p for p in ("distinct", "pages", "actions") if p in parts]
    if "activity" in parts:
        families = ["days", *families]
    # days launched and days with a video are also read by later families
    launched = bool({"launch", "video", "activity"} & set(parts))
    filmed = bool({"video", "activity"} & set(parts))
    if not launched and not families:
        return users.select(*columns)
    if launched:
        at = f"CASE WHEN kind = '{_LAUNCHED}' THEN thing END"
        measures.append(F.expr(f"max({at}) AS last_launch_day"))
        measures.append(F.expr(f"sum(CASE WHEN kind = '{_LAUNCHED}' THEN frequency END) AS launch_days"))
    if "launch" in parts:
        series[_LAUNCHED] = "launch"
        derived |= _launch_derived(closing)
        columns += LAUNCH_COLUMNS
    if filmed:
        measures += _day_statistics("video", f"kind = '{_FILMED}'", "thing")
    if "video" in parts:
        series[_FILMED] = "video"
        derived |= _log_derived("video", closing)
        columns += VIDEO_COLUMNS
    measures += _activity_columns(families, pages, actions)
    if "activity" in parts:
        series[_DAY] = "activity"
        derived |= _log_derived("activity", closing)
        derived["activity_sub_video"] = "activity_days - video_days"
        columns += ACTIVITY_COLUMNS
    if "distinct" in parts:
        columns += DISTINCT_COLUMNS
    if "pages" in parts:
        columns += page_columns(pages)
    if "actions" in parts:
        columns += action_columns(actions)

    things = settle(log_things(
        launch if launched else None, video if filmed else None, activity if families else None,
        windows, pages, actions, families,
    ))
    joined = users
    if series:
        # at most one row per day (and window): bounded, so broadcast
        joined = joined.join(F.broadcast(_series_of(things, series, tag)), [*tag, "register_day"], "left")
    joined = joined.join(things.groupBy(*keys).agg(*measures), keys, "left")
    return joined.selectExpr(*[f"{derived[c]} AS {c}" if c in derived else f"`{c}`" for c in columns])


def bag_of_days(log: DataFrame, name: str, presence: bool, days: Sequence[int] | None = None) -> DataFrame:
    """One column per day: 1 for a launch, or the number of rows; 0 where there are none."""
    days = list(days or range(1, HORIZON + 1))
    value = F.lit(1).cast("long") if presence else F.count(F.lit(1))
    per_day = log.groupBy("user_id", "day").agg(value.alias("n"))
    wide = per_day.groupBy("user_id").pivot("day", days).agg(F.max("n"))
    return wide.select(
        "user_id",
        *[F.coalesce(F.col(f"`{d}`"), F.lit(0).cast("long")).alias(f"{name}_day{d}") for d in days],
    )


def popularity(activity: DataFrame) -> DataFrame:
    """Distinct users and events per video, author, page and action, in long form.

    First one row per (kind, thing, user), then one per (kind, thing): a video that
    everybody watched is spread over the users before it is added up.
    """
    things = activity.select(
        "user_id",
        F.col("video_id").alias("video"),
        F.col("author_id").alias("author"),
        F.col("page"),
        F.col("action_type").alias("action"),
    ).unpivot(["user_id"], ["video", "author", "page", "action"], "kind", "thing")
    per_user = (
        things.filter(F.col("thing").isNotNull())
        .groupBy("kind", "thing", "user_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return per_user.groupBy("kind", "thing").agg(
        F.count("user_id").alias("users"), F.sum("n").alias("events")
    )
