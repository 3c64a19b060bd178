"""Explicit schemas: nothing is inferred from the data."""

from __future__ import annotations

from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType


def _longs(*names: str) -> list[StructField]:
    return [StructField(name, LongType()) for name in names]


# Table layouts, value lists and the closing day of the data model.
HORIZON = 30
PAGES = [0, 1, 2, 3, 4]
ACTIONS = [0, 1, 2, 3, 4, 5]
MISSING = "-1"

USER_REGISTER = StructType(_longs("user_id", "register_day", "register_type", "device_type"))
APP_LAUNCH = StructType(_longs("user_id", "day"))
VIDEO_CREATE = StructType(_longs("user_id", "day"))
USER_ACTIVITY = StructType(_longs("user_id", "day", "page", "video_id", "author_id", "action_type"))

TOKEN_IMPORTANCE = StructType([
    StructField("feature", StringType()), StructField("feature_value", StringType()), StructField("import_value", DoubleType()),
])

# Tokens kept per column when rare ones are collapsed.
TOKENS_KEPT = {
    "appidaction": 266,
    "appidinstall": 2875,
    "kw1": 5690,
    "kw2": 3698,
    "kw3": 224,
    "topic1": 6105,
    "topic2": 5496,
    "topic3": 309,
}

def pair_schema(value: str, value_type=DoubleType) -> StructType:
    """One value per (uid, aid)."""
    return StructType(_longs("uid", "aid") + [StructField(value, value_type())])
