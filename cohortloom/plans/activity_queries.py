"""Registered queries over the four logs: feature rows, cohorts, labels, audits."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType

from cohortloom.functions.binning import bin_label, cohort_bins, period_bins
from cohortloom.operators import activity as act
from cohortloom.operators import cohorts as co
from cohortloom.operators import sketches
from cohortloom.operators.windows import DayWindow, in_window, in_windows
from cohortloom.plans import proxies
from cohortloom.plans.proxies import EVENTS_SQL, LOGS_SQL, PROXY_ACTIONS, PROXY_PAGES
from cohortloom.session import settle

Query = Callable[[SparkSession, str], DataFrame]

MAIN = DayWindow(1, 23, 1)
SLIDING = [DayWindow(1, 16, 2), DayWindow(1, 23, 1), DayWindow(8, 23, 1), DayWindow(1, 30, 0)]


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles to six places, as the SQL side does."""
    return df.selectExpr(
        *[
            f"round(`{f.name}`, {places}) AS `{f.name}`" if isinstance(f.dataType, DoubleType) else f"`{f.name}`"
            for f in df.schema
        ]
    )


# --- SQL for the feature rows -------------------------------------------------------


def _cut_ctes(w: DayWindow, prefix: str = "", tag: str | None = None) -> str:
    """Logs cut to a window and shifted, and the per-user and per-day tables on top."""
    lower = f"{{0}} >= {w.start} AND " if w.start is not None else ""
    reg = (lower + "{0} <= {1}").format("register_day", w.end)
    log = (lower + "{0} <= {1}").format("day", w.last_log_day)
    p = prefix
    return f"""
{p}r AS (SELECT user_id, register_day + {w.shift} AS register_day, register_type, device_type
  FROM register WHERE {reg}),
{p}l AS (SELECT user_id, day + {w.shift} AS day FROM launch WHERE {log}),
{p}v AS (SELECT user_id, day + {w.shift} AS day FROM video WHERE {log}),
{p}a AS (SELECT user_id, day + {w.shift} AS day, page, video_id, author_id, action_type
  FROM activity WHERE {log}),
{p}base AS (SELECT * FROM {p}r
  LEFT JOIN (SELECT register_day, count(DISTINCT user_id) AS register_day_user_id FROM {p}r GROUP BY 1) USING (register_day)
  LEFT JOIN (SELECT register_type, count(DISTINCT user_id) AS register_type_user_id FROM {p}r GROUP BY 1) USING (register_type)
  LEFT JOIN (SELECT device_type, count(DISTINCT user_id) AS device_type_user_id FROM {p}r GROUP BY 1) USING (device_type)),
{p}lu AS (SELECT user_id, max(day) AS last_launch_day, count(*) AS launch_days FROM {p}l GROUP BY 1),
{p}ld AS (SELECT day AS register_day, count(DISTINCT user_id) AS launch_day_user FROM {p}l GROUP BY 1),
{p}vu AS (SELECT user_id, min(day) AS first_video_day, max(day) AS last_video_day, count(*) AS video_days,
    avg(f) AS video_frequency_avg, max(f) AS video_frequency_max, min(f) AS video_frequency_min,
    stddev_samp(f) AS video_frequency_std, CAST(sum(f) AS BIGINT) AS video_frequency_total
  FROM (SELECT user_id, day, count(*) AS f FROM {p}v GROUP BY 1, 2) GROUP BY 1),
{p}vd AS (SELECT day AS register_day, count(DISTINCT user_id) AS video_day_user, count(user_id) AS video_day_frequency
  FROM {p}v GROUP BY 1),
{p}au AS (SELECT user_id, min(day) AS first_activity_day, max(day) AS last_activity_day, count(*) AS activity_days,
    avg(f) AS activity_frequency_avg, max(f) AS activity_frequency_max, min(f) AS activity_frequency_min,
    stddev_samp(f) AS activity_frequency_std, CAST(sum(f) AS BIGINT) AS activity_frequency_total
  FROM (SELECT user_id, day, count(*) AS f FROM {p}a GROUP BY 1, 2) GROUP BY 1),
{p}ad AS (SELECT day AS register_day, count(DISTINCT user_id) AS activity_day_user, count(user_id) AS activity_day_frequency
  FROM {p}a GROUP BY 1),
{p}ap AS (SELECT user_id, {_pivot_sql()} FROM {p}a GROUP BY 1)"""


def _pivot_sql() -> str:
    parts = [
        "count(DISTINCT page) AS user_page_cnt", "count(DISTINCT video_id) AS user_video_cnt",
        "count(DISTINCT author_id) AS user_author_cnt", "count(DISTINCT action_type) AS user_action_cnt",
    ]
    for p in PROXY_PAGES:
        parts.append(f"nullif(count(*) FILTER (page = {p}), 0) AS page{p}_frequency")
        for name, column in (("day", "day"), ("video", "video_id"), ("author", "author_id"), ("action", "action_type")):
            parts.append(f"nullif(count(DISTINCT {column}) FILTER (page = {p}), 0) AS page{p}_{name}")
    for a in PROXY_ACTIONS:
        parts.append(f"nullif(count(*) FILTER (action_type = {a}), 0) AS action{a}_frequency")
        for name, column in (("day", "day"), ("video", "video_id"), ("author", "author_id"), ("page", "page")):
            parts.append(f"nullif(count(DISTINCT {column}) FILTER (action_type = {a}), 0) AS action{a}_{name}")
    return ", ".join(parts)


def _formulas(w: DayWindow) -> dict[str, str]:
    cnt = f"({w.closing_day} + 1 - register_day)"
    out = {
        "last_launch_day_sub_register": "last_launch_day - register_day",
        "register_cnt": cnt,
        "avg_launch_day": f"round(launch_days / {cnt}, 6)",
        "register_sub_launch": f"{cnt} - launch_days",
        "activity_sub_video": "activity_days - video_days",
    }
    for n in ("video", "activity"):
        out |= {
            f"first_{n}_day_sub_register": f"first_{n}_day - register_day",
            f"last_{n}_day_sub_register": f"last_{n}_day - register_day",
            f"{n}_frequency_avg": f"round({n}_frequency_avg, 6)",
            f"{n}_frequency_std": f"round({n}_frequency_std, 6)",
            f"avg_{n}_day": f"round({n}_days / {cnt}, 6)",
            f"register_sub_{n}": f"{cnt} - {n}_days",
            f"launch_sub_{n}": f"launch_days - {n}_days",
            f"last_{n}_sub_frist_{n}": f"last_{n}_day - {n}_days",
            f"{n}_span": f"last_{n}_day - first_{n}_day",
        }
    return out


def _row_sql(w: DayWindow, columns: list[str], prefix: str = "", tag: str | None = None) -> str:
    formulas = _formulas(w)
    wanted = [f"{formulas[c]} AS {c}" if c in formulas else c for c in columns]
    if tag:
        wanted = [f"'{tag}' AS \"window\"", *wanted]
    p = prefix
    sources = {
        "launch_days": f"LEFT JOIN {p}lu USING (user_id)",
        "launch_day_user": f"LEFT JOIN {p}ld USING (register_day)",
        "video_days": f"LEFT JOIN {p}vu USING (user_id)",
        "video_day_user": f"LEFT JOIN {p}vd USING (register_day)",
        "activity_days": f"LEFT JOIN {p}au USING (user_id)",
        "activity_day_user": f"LEFT JOIN {p}ad USING (register_day)",
        "user_page_cnt": f"LEFT JOIN {p}ap USING (user_id)",
    }
    return f"SELECT {', '.join(wanted)} FROM {p}base {' '.join(sources.values())}"


def _feature_sql(w: DayWindow, columns: list[str]) -> str:
    return f"WITH {LOGS_SQL}, {_cut_ctes(w)} {_row_sql(w, columns)}"


ALL_COLUMNS = [
    *act.REGISTER_COLUMNS, *act.LAUNCH_COLUMNS, *act.VIDEO_COLUMNS, *act.ACTIVITY_COLUMNS,
    *act.DISTINCT_COLUMNS, *act.page_columns(PROXY_PAGES), *act.action_columns(PROXY_ACTIONS),
]

_FAMILIES = {
    "register_features": ((), act.REGISTER_COLUMNS),
    "launch_features": (("launch",), act.REGISTER_COLUMNS + act.LAUNCH_COLUMNS),
    "video_features": (("video",), act.REGISTER_COLUMNS + act.VIDEO_COLUMNS),
    "activity_features": (("activity",), act.REGISTER_COLUMNS + act.ACTIVITY_COLUMNS),
    "activity_distinct_counts": (("distinct",), act.REGISTER_COLUMNS + act.DISTINCT_COLUMNS),
    "page_pivots": (("pages",), act.REGISTER_COLUMNS + act.page_columns(PROXY_PAGES)),
    "action_pivots": (("actions",), act.REGISTER_COLUMNS + act.action_columns(PROXY_ACTIONS)),
    "user_features": (
        ("launch", "video", "activity", "distinct", "pages", "actions"), ALL_COLUMNS,
    ),
}


def _family_query(parts, window) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        logs = proxies.four_logs(spark, sf_dir)
        return rounded(
            act.user_features(*logs, window, PROXY_PAGES, PROXY_ACTIONS, parts)
        )

    return run


# --- the other queries ----------------------------------------------------------------


def launch_bag_of_days(spark, sf_dir):
    return act.bag_of_days(proxies.app_launch(spark, sf_dir), "app_launch", presence=True)


def video_bag_of_days(spark, sf_dir):
    return act.bag_of_days(proxies.video_create(spark, sf_dir), "video_create", presence=False)


def _bag_sql(log: str, name: str, presence: bool) -> str:
    value = "max(CASE WHEN day = {0} THEN 1 ELSE 0 END)" if presence else "count(*) FILTER (day = {0})"
    days = ", ".join(
        f"CAST({value.format(d)} AS BIGINT) AS {name}_day{d}" for d in range(1, 31)
    )
    return f"WITH {LOGS_SQL} SELECT user_id, {days} FROM {log} GROUP BY user_id"


def popularity(spark, sf_dir):
    cut = in_window(proxies.user_activity(spark, sf_dir), "day", DayWindow.snapshot(23))
    return act.popularity(cut)


def daily_log_counts(spark, sf_dir):
    """Users and events per day of the launch, video and activity logs."""
    _, launch, video, activity = proxies.four_logs(spark, sf_dir)
    parts = [
        act.daily_series(log, "log").select(
            F.lit(name).alias("log"), F.col("register_day").alias("day"),
            F.col("log_day_user").alias("users"), F.col("log_day_frequency").alias("events"),
        )
        for name, log in (("launch", launch), ("video", video), ("activity", activity))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def window_sketches(spark, sf_dir):
    """Distinct users and videos per window and page: exact, and whether stored sketches come near."""
    log = proxies.user_activity(spark, sf_dir).select("user_id", "day", "page", "video_id")
    stored = settle(sketches.daily_sketches(log, ["page"], {"users": "user_id", "videos": "video_id"}))
    near = sketches.window_estimates(stored, ["page"], ["users", "videos"], SLIDING)
    exact = in_windows(spark, log, "day", SLIDING).groupBy("window", "page").agg(
        F.countDistinct("user_id").alias("n_users"), F.countDistinct("video_id").alias("n_videos")
    )
    bound = sketches.error_bound()
    return exact.join(near, ["window", "page"]).select(
        "window", "page", "n_users", "n_videos",
        (F.abs(F.col("users") - F.col("n_users")) <= bound * F.col("n_users")).alias("users_near"),
        (F.abs(F.col("videos") - F.col("n_videos")) <= bound * F.col("n_videos")).alias("videos_near"),
    )


def user_day_counts(spark, sf_dir):
    return act.user_day_counts(proxies.event_activity(spark, sf_dir))


def first_activity_rows(spark, sf_dir):
    return act.edge_rows(proxies.user_activity(spark, sf_dir))


def last_activity_rows(spark, sf_dir):
    return act.edge_rows(proxies.user_activity(spark, sf_dir), last=True)


def _edge_sql(direction: str) -> str:
    order = ", ".join(
        f"{c} {direction}" for c in ("day", "page", "video_id", "author_id", "action_type")
    )
    return f"""WITH {LOGS_SQL} SELECT user_id, day, page, video_id, author_id, action_type FROM activity
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY {order}) = 1"""


def first_and_last_video(spark, sf_dir):
    return act.first_and_last(proxies.video_create(spark, sf_dir), "video")


def label_days(spark, sf_dir):
    _, launch, video, activity = proxies.four_logs(spark, sf_dir)
    return co.label_days(launch, video, activity)


def register_cohorts(spark, sf_dir):
    return co.register_cohorts(proxies.user_register(spark, sf_dir))


def cohort_sizes(spark, sf_dir):
    return co.cohort_sizes(proxies.user_register(spark, sf_dir)).select("cohort", "users")


def _case_bins(column: str, bins) -> str:
    arms = " ".join(
        f"WHEN {column} > {lo} AND {column} <= {hi} THEN '{bin_label(lo, hi)}'" for lo, hi in bins
    )
    return f"CASE {arms} END"


def late_registrants(spark, sf_dir):
    late = co.late_registrants(proxies.user_register(spark, sf_dir))
    return late.agg(
        F.count("user_id").alias("users"), F.min("user_id").alias("first_user"),
        F.max("user_id").alias("last_user"),
    )


def retention(spark, sf_dir):
    register, launch, video, activity = proxies.four_logs(spark, sf_dir)
    return co.retention(register, co.label_days(launch, video, activity))


def event_retention(spark, sf_dir):
    register = proxies.event_register(spark, sf_dir)
    return co.retention(register, proxies.event_activity(spark, sf_dir), split_day=9, step=4, period=5)


def _retention_sql(ctes: str, register: str, label: str, split_day=23, step=7, period=7) -> str:
    rows = []
    for c, (lo, hi) in enumerate(cohort_bins(split_day, step)):
        rows.append((c, 0, lo, hi, bin_label(lo, hi), bin_label(lo, hi), 0, 0))
        for i, (a, b) in enumerate(period_bins(hi, period), start=1):
            rows.append((c, i, lo, hi, bin_label(lo, hi), bin_label(a, b), a, b))
    values = ", ".join(repr(r) for r in rows)
    return f"""WITH {ctes}, layout(cohort_no, period_no, lo, hi, cohort, period, a, b) AS (VALUES {values})
    SELECT CAST(cohort_no AS BIGINT) AS cohort_no, CAST(period_no AS BIGINT) AS period_no, cohort, period,
           count(DISTINCT CASE WHEN period_no = 0 OR (day > a AND day <= b) THEN r.user_id END) AS users
    FROM layout LEFT JOIN {register} r ON register_day > lo AND register_day <= hi
    LEFT JOIN {label} d ON d.user_id = r.user_id GROUP BY ALL"""


LABELS_SQL = f"""{LOGS_SQL}, labels_ AS (SELECT user_id, day FROM launch UNION SELECT user_id, day FROM video
  UNION SELECT user_id, day FROM activity)"""


def label_people(spark, sf_dir):
    register, launch, video, activity = proxies.four_logs(spark, sf_dir)
    return co.label_people(register, co.label_days(launch, video, activity), 1, 16)


def label_people_counts(spark, sf_dir):
    register, launch, video, activity = proxies.four_logs(spark, sf_dir)
    return co.label_people_counts(register, co.label_days(launch, video, activity), 1, 16)


_PEOPLE_SQL = f"""SELECT DISTINCT {_case_bins('day', period_bins(16))} AS period, r.user_id
  FROM register r JOIN labels_ USING (user_id) WHERE register_day BETWEEN 1 AND 16 AND day > 16 AND day <= 30"""


def return_labels(spark, sf_dir):
    register, launch, video, activity = proxies.four_logs(spark, sf_dir)
    return co.return_labels(register, co.label_days(launch, video, activity), 1, 23)


def set_audits(spark, sf_dir):
    register, launch, video, activity = proxies.four_logs(spark, sf_dir)
    return co.set_audits(
        {"register": register, "launch": launch, "video": video, "activity": activity,
         "events": proxies.event_activity(spark, sf_dir)}
    )


def _audit_sql() -> str:
    names = {"register": "register", "launch": "launch", "video": "video",
             "activity": "activity", "events": "event_activity"}
    parts = [
        f"""SELECT '{i}' AS in_log, '{j}' AS not_in_log, count(*) AS users FROM
        (SELECT user_id FROM {names[i]} EXCEPT SELECT user_id FROM {names[j]})"""
        for i in names for j in names if i != j
    ]
    return f"WITH {LOGS_SQL}, {EVENTS_SQL} {' UNION ALL '.join(parts)}"


def users_without_video(spark, sf_dir):
    return co.users_missing(proxies.user_register(spark, sf_dir), proxies.video_create(spark, sf_dir))


def sliding_window_features(spark, sf_dir):
    logs = proxies.four_logs(spark, sf_dir)
    return rounded(act.user_features(*logs, SLIDING, PROXY_PAGES, PROXY_ACTIONS))


def _sliding_sql() -> str:
    ctes = ", ".join(_cut_ctes(w, f"w{i}_") for i, w in enumerate(SLIDING))
    rows = " UNION ALL ".join(
        _row_sql(w, ALL_COLUMNS, f"w{i}_", w.name) for i, w in enumerate(SLIDING)
    )
    return f"WITH {LOGS_SQL}, {ctes} {rows}"


QUERIES: dict[str, Query] = {
    **{name: _family_query(parts, MAIN) for name, (parts, _) in _FAMILIES.items()},
    "user_features_snapshot": _family_query(
        _FAMILIES["user_features"][0], DayWindow.snapshot(23)
    ),
    "sliding_window_features": sliding_window_features,
    "launch_bag_of_days": launch_bag_of_days,
    "video_bag_of_days": video_bag_of_days,
    "popularity": popularity,
    "daily_log_counts": daily_log_counts,
    "user_day_counts": user_day_counts,
    "window_sketches": window_sketches,
    "first_activity_rows": first_activity_rows,
    "last_activity_rows": last_activity_rows,
    "first_and_last_video": first_and_last_video,
    "label_days": label_days,
    "register_cohorts": register_cohorts,
    "cohort_sizes": cohort_sizes,
    "late_registrants": late_registrants,
    "retention": retention,
    "event_retention": event_retention,
    "label_people": label_people,
    "label_people_counts": label_people_counts,
    "return_labels": return_labels,
    "set_audits": set_audits,
    "users_without_video": users_without_video,
}

ORACLES: dict[str, str] = {
    **{name: _feature_sql(MAIN, columns) for name, (_, columns) in _FAMILIES.items()},
    "user_features_snapshot": _feature_sql(DayWindow.snapshot(23), ALL_COLUMNS),
    "sliding_window_features": _sliding_sql(),
    "launch_bag_of_days": _bag_sql("launch", "app_launch", True),
    "video_bag_of_days": _bag_sql("video", "video_create", False),
    "popularity": f"""WITH {LOGS_SQL}, cut AS (SELECT * FROM activity WHERE day <= 23)
      SELECT kind, thing, count(DISTINCT user_id) AS users, count(*) AS events FROM (
        SELECT 'video' AS kind, video_id AS thing, user_id FROM cut
        UNION ALL SELECT 'author', author_id, user_id FROM cut
        UNION ALL SELECT 'page', page, user_id FROM cut
        UNION ALL SELECT 'action', action_type, user_id FROM cut) GROUP BY 1, 2""",
    "daily_log_counts": f"""WITH {LOGS_SQL} SELECT log, day, count(DISTINCT user_id) AS users, count(user_id) AS events
      FROM (SELECT 'launch' AS log, user_id, day FROM launch UNION ALL SELECT 'video', user_id, day FROM video
            UNION ALL SELECT 'activity', user_id, day FROM activity) GROUP BY 1, 2""",
    "window_sketches": f"WITH {LOGS_SQL} " + " UNION ALL ".join(
        f"""SELECT '{w.name}' AS "window", page, count(DISTINCT user_id) AS n_users, count(DISTINCT video_id) AS n_videos,
          true AS users_near, true AS videos_near FROM activity WHERE {w.reads('day')} GROUP BY page""" for w in SLIDING
    ),
    "user_day_counts": f"WITH {EVENTS_SQL} SELECT user_id, day, count(*) AS frequency FROM event_activity GROUP BY 1, 2",
    "first_activity_rows": _edge_sql("ASC"),
    "last_activity_rows": _edge_sql("DESC"),
    "first_and_last_video": f"""WITH {LOGS_SQL} SELECT user_id, min(day) AS first_video_day,
      max(day) AS last_video_day FROM video GROUP BY 1""",
    "label_days": f"WITH {LABELS_SQL} SELECT user_id, day FROM labels_",
    "register_cohorts": f"""WITH {LOGS_SQL} SELECT DISTINCT {_case_bins('register_day', cohort_bins())} AS cohort, user_id
      FROM register WHERE register_day > 0 AND register_day <= 23""",
    "cohort_sizes": f"""WITH {LOGS_SQL}, bins(cohort, lo, hi) AS (VALUES {', '.join(repr((bin_label(lo, hi), lo, hi)) for lo, hi in cohort_bins())})
      SELECT cohort, count(DISTINCT user_id) AS users FROM bins LEFT JOIN register
      ON register_day > lo AND register_day <= hi GROUP BY 1""",
    "late_registrants": f"""WITH {LOGS_SQL} SELECT count(DISTINCT user_id) AS users, min(user_id) AS first_user,
      max(user_id) AS last_user FROM register WHERE register_day > 23""",
    "retention": _retention_sql(LABELS_SQL, "register", "labels_"),
    "event_retention": _retention_sql(f"{EVENTS_SQL}", "event_register", "event_activity", 9, 4, 5),
    "label_people": f"WITH {LABELS_SQL}, p AS ({_PEOPLE_SQL}) SELECT CAST(list_position([{', '.join(repr(bin_label(a, b)) for a, b in period_bins(16))}], period) - 1 AS BIGINT) AS period_no, period, user_id FROM p",
    "label_people_counts": f"WITH {LABELS_SQL}, p AS ({_PEOPLE_SQL}) SELECT period, count(*) AS users FROM p GROUP BY 1",
    "return_labels": f"""WITH {LABELS_SQL} SELECT user_id, CAST(max(CASE WHEN day > 23 AND day <= 30 THEN 1 ELSE 0 END) AS BIGINT) AS label
      FROM register LEFT JOIN labels_ USING (user_id) WHERE register_day BETWEEN 1 AND 23 GROUP BY 1""",
    "set_audits": _audit_sql(),
    "users_without_video": f"WITH {LOGS_SQL} SELECT user_id FROM register EXCEPT SELECT user_id FROM video",
}
