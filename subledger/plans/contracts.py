"""Column contracts of the six contracted models (names and type families)."""

from __future__ import annotations

from subledger.plans.posts import GROWTH_FIELDS, OVERVIEW_FIELDS, TRAFFIC_MEASURES

_FAMILY = {"bigint": "integer", "double": "float64", "boolean": "boolean", "str": "string",
           "ts": "timestamp"}
_POST_KEYS = [("post_id", "integer"), ("publication", "string"), ("snapshot_date", "timestamp")]

STG_SUBSCRIBERS = [
    ("snapshot_date", "date"), ("snapshot_ts", "timestamp"), ("source_uri", "string"),
    ("publication", "string"), ("subscription_id", "integer"), ("user_id", "integer"),
    ("email", "string"), ("name", "string"), ("type", "string"), ("stripe_plan", "string"),
    ("is_subscribed", "boolean"), ("is_comp", "boolean"), ("is_gift", "boolean"),
    ("is_free_trial", "boolean"), ("subscription_interval", "string"), ("start_date", "timestamp"),
    ("first_paid_date", "timestamp"), ("expiration_date", "timestamp"), ("cancel_date", "timestamp"),
    ("revenue", "float64"), ("country", "string"), ("paid_source", "string"),
    ("free_source", "string"), ("activity", "integer"), ("total_count", "integer"),
]
STG_POST_OVERVIEW = _POST_KEYS + [(n, _FAMILY[k]) for n, _, k in OVERVIEW_FIELDS]
INT_POST_OVERVIEW = [("post_id", "integer"), ("snapshot_date", "timestamp"), ("publication", "string")] + [
    (n, "timestamp" if n == "stats_updated_at" else _FAMILY[k]) for n, _, k in OVERVIEW_FIELDS]
STG_POST_TRAFFIC = _POST_KEYS + [(n, "integer") for n, *_ in TRAFFIC_MEASURES]
STG_POST_GROWTH = _POST_KEYS + [(n, "integer") for n, _ in GROWTH_FIELDS]
STG_POST_COMMENTS = [("comment_id", "integer"), ("post_id", "integer"), ("publication", "string"),
                     ("parent_comment_id", "integer"), ("body", "string"),
                     ("snapshot_date", "timestamp")]

CONTRACTS = {
    "stg_subscribers": STG_SUBSCRIBERS,
    "stg_post_overview": STG_POST_OVERVIEW,
    "int_post_overview": INT_POST_OVERVIEW,
    "stg_post_traffic": STG_POST_TRAFFIC,
    "stg_post_growth": STG_POST_GROWTH,
    "stg_post_comments": STG_POST_COMMENTS,
}
