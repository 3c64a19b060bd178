import random

import pytest

from cohortloom.functions.binning import cohort_bins, period_bins
from cohortloom.operators import activity as act
from cohortloom.operators import cohorts as co
from cohortloom.operators.windows import DayWindow, in_window, in_windows
from cohortloom.sources.schemas import ACTIONS, PAGES

REGISTER = "user_id long, register_day long, register_type long, device_type long"
LOG = "user_id long, day long"
ACTIVITY = "user_id long, day long, page long, video_id long, author_id long, action_type long"


@pytest.mark.parametrize(
    "window, shift, extra",
    [(DayWindow(1, 23, 1), 7, 0), (DayWindow(1, 16, 2), 7, 7), (DayWindow(1, 23, 0), 0, 7)],
)
def test_window_arithmetic(window, shift, extra):
    assert (window.shift, window.extra_days, window.closing_day) == (shift, extra, 30)


def test_last_day_is_the_horizon_for_every_window():
    for start in range(1, 10):
        for end in range(start, 31):
            for weeks in range(0, 4):
                assert DayWindow(start, end, weeks).closing_day == 30


def test_snapshot_closes_at_its_own_day():
    window = DayWindow.snapshot(23)
    assert (window.shift, window.extra_days, window.closing_day) == (0, 0, 23)


def test_bins():
    assert cohort_bins(23, 7) == [(0, 2), (2, 9), (9, 16), (16, 23)]
    assert period_bins(23) == [(23, 30)]
    assert period_bins(2) == [(2, 9), (9, 16), (16, 23), (23, 30)]
    assert period_bins(20, 7) == [(20, 27), (27, 30)]


def test_many_windows_equal_one_by_one(spark, rows):
    log = spark.createDataFrame([(u, d) for u in range(3) for d in range(1, 31)], LOG)
    windows = [DayWindow(1, 16, 2), DayWindow(5, 23, 1), DayWindow(1, 30, 0)]
    together = in_windows(spark, log, "day", windows)
    for w in windows:
        mine = together.filter(together.window == w.name)
        assert rows(mine, "user_id", "day") == rows(in_window(log, "day", w), "user_id", "day")


def fixture_logs(spark, seed=1, users=12, hot=True):
    rnd = random.Random(seed)
    register = [(u, rnd.randint(1, 25), rnd.randint(0, 2), rnd.randint(0, 3)) for u in range(users)]
    launch = {(rnd.randrange(users + 2), rnd.randint(1, 30)) for _ in range(80)}
    video = [(rnd.randrange(users - 3), rnd.randint(1, 30)) for _ in range(60)]
    activity = [
        (0 if hot and i % 3 == 0 else rnd.randrange(users - 2), rnd.randint(1, 30),
         rnd.choice([*PAGES, 9, None]), rnd.randrange(20), rnd.randrange(6), rnd.choice([*ACTIONS, -4, None]))
        for i in range(400)
    ]
    return register, sorted(launch), video, activity


def brute_row(user, register, launch, video, activity, w):
    """One feature row by plain loops."""
    import statistics

    shifted = [(u, r + w.shift, t, d) for u, r, t, d in register if w.start <= r <= w.end]
    cut = lambda log: [(r[0], r[1] + w.shift, *r[2:]) for r in log if w.start <= r[1] <= w.last_log_day]
    launch, video, activity = cut(launch), cut(video), cut(activity)
    _, day, rtype, device = next(r for r in shifted if r[0] == user)
    out = {
        "register_day": day,
        "register_day_user_id": len({r[0] for r in shifted if r[1] == day}),
        "register_type_user_id": len({r[0] for r in shifted if r[2] == rtype}),
        "device_type_user_id": len({r[0] for r in shifted if r[3] == device}),
        "register_cnt": 31 - day,
        "launch_days": len([r for r in launch if r[0] == user]) or None,
        "launch_day_user": len({r[0] for r in launch if r[1] == day}) or None,
    }
    for name, log in (("video", video), ("activity", activity)):
        mine = [r for r in log if r[0] == user]
        days = [r[1] for r in mine]
        daily = [days.count(d) for d in sorted(set(days))]
        out |= {
            f"first_{name}_day": min(days, default=None),
            f"last_{name}_day": max(days, default=None),
            f"{name}_days": len(set(days)) or None,
            f"{name}_frequency_std": statistics.stdev(daily) if len(daily) > 1 else None,
            f"{name}_frequency_avg": statistics.mean(daily) if daily else None,
            f"{name}_frequency_total": len(days) or None,
            f"{name}_day_user": len({r[0] for r in log if r[1] == day}) or None,
            f"{name}_day_frequency": len([r for r in log if r[1] == day]) or None,
        }
    mine = [r for r in activity if r[0] == user]
    for name, at in zip(act.DISTINCT_COLUMNS, (2, 3, 4, 5)):
        out[name] = len({r[at] for r in mine} - {None}) if mine else None
    for label, values, at, crossed, cross_at in (
        ("page", PAGES, 2, "action", 5), ("action", ACTIONS, 5, "page", 2),
    ):
        for v in values:
            here = [r for r in mine if r[at] == v]
            out[f"{label}{v}_frequency"] = len(here) or None
            for what, i in (("day", 1), ("video", 3), ("author", 4), (crossed, cross_at)):
                out[f"{label}{v}_{what}"] = len({r[i] for r in here} - {None}) or None
    return out


@pytest.mark.parametrize("window", [DayWindow(1, 23, 1), DayWindow(1, 16, 2), DayWindow(3, 23, 0)])
def test_feature_rows_equal_brute_force(spark, window):
    register, launch, video, activity = fixture_logs(spark)
    df = act.user_features(
        spark.createDataFrame(register, REGISTER), spark.createDataFrame(launch, LOG),
        spark.createDataFrame(video, LOG), spark.createDataFrame(activity, ACTIVITY), window,
    )
    assert len(df.columns) == 104 + 4  # four columns keep a second reading of a formula
    got = {r["user_id"]: r.asDict() for r in df.collect()}
    wanted = [r[0] for r in register if window.start <= r[1] <= window.end]
    assert sorted(got) == sorted(wanted)
    for user in wanted:
        for name, value in brute_row(user, register, launch, video, activity, window).items():
            mine = got[user][name]
            assert mine == (pytest.approx(value) if isinstance(value, float) else value), (user, name)


def test_sliding_equals_single_windows(spark, rows):
    logs = [spark.createDataFrame(r, s) for r, s in zip(fixture_logs(spark), (REGISTER, LOG, LOG, ACTIVITY))]
    windows = [DayWindow(1, 16, 2), DayWindow(1, 23, 1)]
    together = act.user_features(*logs, windows)
    for w in windows:
        mine = together.filter(together.window == w.name).drop("window")
        assert rows(mine) == rows(act.user_features(*logs, w))


def test_result_does_not_depend_on_partitions(spark, rows):
    logs = [spark.createDataFrame(r, s) for r, s in zip(fixture_logs(spark), (REGISTER, LOG, LOG, ACTIVITY))]
    once = rows(act.user_features(*logs))
    again = rows(act.user_features(*[log.repartition(7) for log in logs]))
    assert once == again


def test_one_day_has_no_deviation(spark):
    video = spark.createDataFrame([(1, 5), (1, 5), (2, 1), (2, 2), (2, 2), (2, 2)], LOG)
    got = {r["user_id"]: r["video_frequency_std"] for r in act.video_per_user(video).collect()}
    assert got[1] is None
    assert got[2] == pytest.approx(1.414214, abs=1e-6)


def test_pivot_gaps(spark):
    activity = spark.createDataFrame([(1, 1, 0, 5, 6, 2)], ACTIVITY)
    row = act.activity_per_user(activity).first()
    assert (row["page0_frequency"], row["page1_frequency"], row["page1_video"]) == (1, None, None)


def test_bag_of_days_fills_gaps_with_zero(spark):
    log = spark.createDataFrame([(1, 3), (1, 3), (2, 30)], LOG)
    present = {r["user_id"]: r for r in act.bag_of_days(log, "app_launch", True).collect()}
    counted = {r["user_id"]: r for r in act.bag_of_days(log, "video_create", False).collect()}
    assert (present[1]["app_launch_day3"], present[1]["app_launch_day4"]) == (1, 0)
    assert (counted[1]["video_create_day3"], counted[2]["video_create_day30"]) == (2, 1)


def test_approximate_distinct_counts_are_close(spark):
    activity = spark.createDataFrame([(1, 1, p, v, v % 7, 0) for p in PAGES for v in range(40)], ACTIVITY)
    exact = act.distinct_counts(activity).first()
    rough = act.distinct_counts(activity, approximate=True).first()
    assert exact["user_video_cnt"] == 40
    assert abs(rough["user_video_cnt"] - 40) <= 6


def test_retention_counts(spark, rows):
    register = spark.createDataFrame([(1, 1, 0, 0), (2, 2, 0, 0), (3, 12, 0, 0), (4, 30, 0, 0)], REGISTER)
    labels = spark.createDataFrame([(1, 3), (1, 9), (1, 10), (2, 30), (3, 16), (3, 17)], LOG)
    got = {(r["cohort"], r["period"]): r["users"] for r in co.retention(register, labels).collect()}
    assert got[("(0, 2]", "(0, 2]")] == 2
    assert got[("(0, 2]", "(2, 9]")] == 1
    assert got[("(0, 2]", "(9, 16]")] == 1
    assert got[("(0, 2]", "(23, 30]")] == 1
    assert got[("(2, 9]", "(2, 9]")] == 0 and got[("(2, 9]", "(9, 16]")] == 0
    assert got[("(9, 16]", "(16, 23]")] == 1
    assert sum(n for (c, p), n in got.items() if c == p) == 3


def test_cohorts_are_right_closed(spark, rows):
    register = spark.createDataFrame([(d, d, 0, 0) for d in (0, 1, 2, 3, 9, 10)], REGISTER)
    got = rows(co.register_cohorts(register, [(0, 2), (2, 9)]))
    assert got == [("(0, 2]", 1), ("(0, 2]", 2), ("(2, 9]", 3), ("(2, 9]", 9)]
    sizes = rows(co.cohort_sizes(register, [(0, 2), (2, 9), (50, 60)]), "cohort", "users")
    assert ("(50, 60]", 0) in sizes


def test_set_audits_count_both_ways(spark):
    a = spark.createDataFrame([(1, 1), (2, 1), (2, 2)], LOG)
    b = spark.createDataFrame([(2, 1), (3, 1)], LOG)
    got = {(r["in_log"], r["not_in_log"]): r["users"] for r in co.set_audits({"a": a, "b": b}).collect()}
    assert got == {("a", "b"): 1, ("b", "a"): 1}


def test_edge_rows_keep_one_row(spark, rows):
    activity = spark.createDataFrame([(1, 2, 0, 9, 1, 1), (1, 1, 3, 4, 1, 1), (1, 1, 2, 4, 1, 1)], ACTIVITY)
    assert rows(act.edge_rows(activity), "day", "page") == [(1, 2)]
    assert rows(act.edge_rows(activity, last=True), "day", "page") == [(2, 0)]


def test_days_and_values_past_one_mask(spark, rows):
    register = spark.createDataFrame([(1, 1), (2, 2)], "user_id long, register_day long")
    labels = spark.createDataFrame([(1, 61), (1, 62), (2, 63), (2, 130), (1, 200)], "user_id long, day long")
    got = co.label_people(register, labels, 1, 2, period=32, horizon=130)
    days = {1: {61, 62}, 2: {63, 130}}
    want = [
        (i, u)
        for i, (lo, hi) in enumerate(period_bins(2, 32, 130)) for u, active in days.items()
        if any(lo < d <= hi for d in active)
    ]
    assert want and rows(got, "period_no", "user_id") == sorted(want)

    log = spark.createDataFrame([(1, d, p, 7 + p, 9, 0) for d, p in [(1, 0), (2, 61), (2, 62), (3, 129), (4, 129)]], ACTIVITY)
    wide = act.activity_per_user(log, pages=list(range(130))).first()
    assert [wide[f"page{p}_video"] for p in (0, 1, 61, 62, 129)] == [1, None, 1, 1, 1]
    assert [wide[f"page{p}_day"] for p in (0, 1, 61, 62, 129)] == [1, None, 1, 1, 2]


def test_every_log_is_read_once_whatever_the_windows(spark, tmp_path, monkeypatch):
    """One scan of each event log in what is written, none in what is returned."""
    logs = {
        "register": spark.createDataFrame([(1, 2, 0, 0), (2, 9, 1, 1)], "user_id long, register_day long, register_type long, device_type long"),
        "launch": spark.createDataFrame([(1, 3), (2, 10)], "user_id long, day long"),
        "video": spark.createDataFrame([(1, 3), (1, 3)], "user_id long, day long"),
        "activity": spark.createDataFrame([(1, 4, 0, 7, 8, 1)], "user_id long, day long, page long, video_id long, author_id long, action_type long"),
    }
    read = []
    for name, df in logs.items():
        df.write.parquet(f"{tmp_path}/{name}")
        read.append(spark.read.schema(df.schema).parquet(f"{tmp_path}/{name}"))
    written = []
    real = act.settle
    monkeypatch.setattr(act, "settle", lambda df: written.append(df) or real(df))
    for window in (DayWindow(1, 23, 1), [DayWindow(1, 16, 2), DayWindow(1, 23, 1), DayWindow(1, 30, 0)]):
        written.clear()
        out = act.user_features(*read, window)
        plan = "".join(df._jdf.queryExecution().executedPlan().toString() for df in (*written, out))
        for name in ("launch", "video", "activity"):
            assert plan.count(f"{tmp_path}/{name}]") == 1
        assert out.count() == 2 * (1 if isinstance(window, DayWindow) else 3)


def test_a_user_without_rows_has_no_counts(spark):
    register = spark.createDataFrame([(1, 2, 0, 0), (2, 2, 0, 0)], "user_id long, register_day long, register_type long, device_type long")
    launch = spark.createDataFrame([(1, 2)], "user_id long, day long")
    video = spark.createDataFrame([], "user_id long, day long")
    activity = spark.createDataFrame(
        [(1, 4, None, 7, 8, None)], "user_id long, day long, page long, video_id long, author_id long, action_type long"
    )
    got = {r["user_id"]: r for r in act.user_features(register, launch, video, activity).collect()}
    assert got[1]["user_page_cnt"] == 0 and got[1]["user_video_cnt"] == 1 and got[1]["video_days"] is None
    assert got[2]["user_page_cnt"] is None and got[2]["launch_days"] is None
    assert got[1]["launch_day_user"] == 1 and got[1]["video_day_user"] is None
