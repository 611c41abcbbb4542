"""Post performance models: JSON payloads -> flat snapshots -> latest per post.

* Overview: one ``from_json`` per row into a typed struct (typed leaves read
  strictly: ``"5"`` or ``5.5`` into an integer field give NULL; text leaves are
  ``variant`` so a number is not accepted as text), then field access on the
  first element of ``posts``.
* Traffic: three arrays of ``{category, measure}`` objects turned into 33 wide
  sums.  Instead of exploding each array, grouping and inner-joining three
  aggregates, each array is folded once per row with a higher-order
  ``aggregate`` into a struct of its sums, and one aggregation by key adds them
  up and keeps the keys that produced elements in all three arrays: one shuffle
  instead of three aggregations and two joins.
* Growth: lenient text reads (numbers as text accepted) via string leaves and
  ``try_cast``.
* Latest per post with last-known metrics is a mergeable state per post, one aggregation over the snapshots, safe for posts
  with very many of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subledger.operators.dedup import latest_per_key

# Output column -> (JSON path under posts[0], type) of the overview
# payload, in output order.  "ts" = timestamp text, "str" = strict text.
_COMP_AVGS = ["queued", "sent", "delivered", "dropped", "opened", "opens", "clicked", "clicks",
              "open_rate", "click_through_rate", "engagement_rate", "views", "unique_engagements",
              "unique_opens_day7", "unique_opens_day28", "likes", "comments", "shares",
              "subscribes", "monthly_subscribes", "annual_subscribes", "unsubscribes",
              "unsubscribes_within_1_day", "disables_within_1_day", "subscriptions_within_1_day",
              "signups_within_1_day", "signups", "estimated_value"]
_STATS_INT = ["queued", "sent", "delivered", "dropped", "opened", "opens", "clicked", "clicks"]
_STATS_RATE = ["open_rate", "click_through_rate", "engagement_rate"]
_STATS_READ = ["views", "engaged", "subscribers_finished_post", "restacks", "subscribes",
               "monthly_subscribes", "annual_subscribes", "free_to_paid_upgrades", "signups",
               "likes", "shares"]
_STATS_CHURN = ["unsubscribes", "unsubscribes_within_1_day", "disables_within_1_day",
                "subscriptions_within_1_day", "signups_within_1_day"]

OVERVIEW_FIELDS: list[tuple[str, str, str]] = [
    ("post_id_check", "id", "bigint"), ("post_uuid", "uuid", "str"), ("title", "title", "str"),
    ("slug", "slug", "str"), ("post_type", "type", "str"), ("audience", "audience", "str"),
    ("meter_type", "meter_type", "str"), ("is_published", "is_published", "boolean"),
    ("should_send_email", "should_send_email", "boolean"),
    ("write_comment_permissions", "write_comment_permissions", "str"),
    ("publication_id", "publication_id", "bigint"), ("post_date", "post_date", "ts"),
    ("email_sent_at", "email_sent_at", "ts"), ("draft_created_at", "draft_created_at", "ts"),
    ("draft_updated_at", "draft_updated_at", "ts"), ("cover_image_url", "cover_image", "str"),
    ("author_name", "bylines[0].name", "str"), ("author_handle", "bylines[0].handle", "str"),
    ("comment_count", "comment_count", "bigint"), ("reaction_count", "reaction_count", "bigint"),
    ("child_comment_count", "child_comment_count", "bigint"),
    *[(c, f"stats.{c}", "bigint") for c in _STATS_INT],
    *[(c, f"stats.{c}", "double") for c in _STATS_RATE],
    *[(c, f"stats.{c}", "bigint") for c in _STATS_READ],
    ("estimated_value", "stats.estimated_value", "double"),
    *[(c, f"stats.{c}", "bigint") for c in _STATS_CHURN],
    ("referrer_total_views", "stats.referrers.total_views", "bigint"),
    ("pub_avg_n_comp_posts", "stats.comps.n_comp_posts", "bigint"),
    *[(f"pub_avg_{c}", f"stats.comps.avg_{c}", "double") for c in _COMP_AVGS],
    ("stats_updated_at", "stats.data_updated_at", "bigint"),
]

# Metrics that newer snapshots may leave NULL; the latest row takes their last known value.
LAST_KNOWN = ["queued", "dropped", "engaged", "subscribers_finished_post", "restacks",
              "monthly_subscribes", "annual_subscribes", "free_to_paid_upgrades", "unsubscribes",
              "likes", "stats_updated_at"]

KEYS = ["post_id", "publication", "snapshot_date"]

_LEAF = {"bigint": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType(),
         "str": T.VariantType(), "ts": T.VariantType()}


def _overview_schema(fields=tuple(OVERVIEW_FIELDS)) -> T.StructType:
    """Nested struct covering the paths of ``fields``."""
    tree: dict = {}
    for _, path, kind in fields:
        node = tree
        parts = path.split(".")
        for p in parts[:-1]:
            node = node.setdefault(p, {})
        node[parts[-1]] = _LEAF[kind]

    def build(node: dict) -> T.StructType:
        out = []
        for name, sub in node.items():
            if name.endswith("[0]"):
                out.append(T.StructField(name[:-3], T.ArrayType(build(sub))))
            elif isinstance(sub, dict):
                out.append(T.StructField(name, build(sub)))
            else:
                out.append(T.StructField(name, sub))
        return T.StructType(out)

    return T.StructType([T.StructField("posts", T.ArrayType(build(tree)))])


def _strict_text(v: Column) -> Column:
    return F.when(F.schema_of_variant(v) == "STRING", F.variant_get(v, "$", "string"))


def _path(root: Column, path: str) -> Column:
    c = root
    for p in path.split("."):
        if p.endswith("[0]"):
            c = F.get(c.getField(p[:-3]), 0)
        else:
            c = c.getField(p)
    return c


def overview_columns(data: str = "data", fields=tuple(OVERVIEW_FIELDS)) -> list[Column]:
    """The payload's ``fields`` as strictly typed columns."""
    # Fields are read straight off the from_json expression: a parsed struct column
    # with more than spark.sql.codegen.maxFields nested fields would switch off
    # whole-stage codegen; common-subexpression elimination parses once per row.
    post = F.get(F.from_json(data, _overview_schema(fields)).getField("posts"), 0)
    cols = []
    for name, path, kind in fields:
        c = _path(post, path)
        if kind == "str":
            c = _strict_text(c)
        elif kind == "ts":
            c = _strict_text(c).cast("timestamp").cast("timestamp_ntz")   # an offset names an instant; the session is UTC
        cols.append(c.alias(name))
    return cols


def stg_post_overview(landing: DataFrame) -> DataFrame:
    """Flatten the overview payload: 80 strictly typed fields plus the keys."""
    return landing.select(*KEYS, *overview_columns())


#: What a known value is ordered by.
_AT = ["snapshot_date", "publication"]


def post_state(landing: DataFrame) -> DataFrame:
    """What is known of each post, in one aggregation over its snapshots: the latest payload as it came, and the last
    non-NULL value of each volatile metric with its snapshot.

    Only the volatile metrics are parsed for every snapshot; the rest is parsed for the latest payload alone.  States merge
    (``merge_post_states``), so a new day is added without reading the days before.
    """
    volatile = tuple(f for f in OVERVIEW_FIELDS if f[0] in LAST_KNOWN)
    rows = landing.select(*KEYS, "data", *overview_columns(fields=volatile))
    known = [F.max(F.when(F.col(c).isNotNull(), F.struct(*_AT, F.col(c).alias("value")))).alias(c) for c in LAST_KNOWN]
    return rows.groupBy("post_id").agg(F.max_by(F.struct(*_AT, "data"), F.struct(*_AT)).alias("latest"), *known)


def merge_post_states(state: DataFrame, newer: DataFrame) -> DataFrame:
    """The state of both, one row per post."""
    return state.unionByName(newer).groupBy("post_id").agg(
        F.max_by("latest", F.struct(*[F.col(f"latest.{c}") for c in _AT])).alias("latest"),
        *[F.max(c).alias(c) for c in LAST_KNOWN])


def int_post_overview(state: DataFrame) -> DataFrame:
    """Latest snapshot per post; volatile metrics carry their last non-NULL value."""
    fixed = tuple(f for f in OVERVIEW_FIELDS if f[0] not in LAST_KNOWN)
    parsed = state.select("post_id", F.col("latest.snapshot_date").alias("snapshot_date"),
                          F.col("latest.publication").alias("publication"), *overview_columns("latest.data", fixed),
                          *[F.col(f"{c}.value").alias(c) for c in LAST_KNOWN])
    stamp = F.timestamp_millis("stats_updated_at").cast("timestamp_ntz").alias("stats_updated_at")
    return parsed.select("post_id", "snapshot_date", "publication",
                         *[stamp if n == "stats_updated_at" else n for n, _, _ in OVERVIEW_FIELDS])


# ---------------------------------------------------------------- traffic
# Output column -> (array, category field, category label, measure field).
REFERRER_LABELS = [("email", "Email"), ("direct", "Direct"), ("substack", "Substack"),
                   ("search", "Search"), ("social", "Social"), ("news", "News"),
                   ("other_external", "Other External"), ("other_internal", "Other Internal"),
                   ("other", "Other")]
SUBSCRIBER_VIEW_LABELS = REFERRER_LABELS[:5]
DEVICE_LABELS = [("email", "Email"), ("desktop_web", "Desktop Web"), ("mobile_web", "Mobile Web"),
                 ("substack_app", "Substack App")]
CATEGORY_LABELS = [("email", "Email"), ("direct", "Direct"), ("substack", "Substack"),
                   ("search", "Search"), ("social", "Social"), ("other_external", "Other External"),
                   ("other", "Other")]

TRAFFIC_MEASURES: list[tuple[str, str, str, str, str]] = [
    *[(f"referrer_views_{n}", "referrers", "source_category", lbl, "views") for n, lbl in REFERRER_LABELS],
    *[(f"paid_views_{n}", "referrers", "source_category", lbl, "paid_subscriber_views")
      for n, lbl in SUBSCRIBER_VIEW_LABELS],
    *[(f"free_views_{n}", "referrers", "source_category", lbl, "free_subscriber_views")
      for n, lbl in SUBSCRIBER_VIEW_LABELS],
    *[(f"device_views_{n}", "devices", "device_type", lbl, "views") for n, lbl in DEVICE_LABELS],
    *[(f"category_views_{n}", "categories", "category_type", lbl, "category_views")
      for n, lbl in CATEGORY_LABELS],
]

TRAFFIC_SCHEMA = (
    "struct<referrers: array<struct<source_category: string, views: string,"
    " paid_subscriber_views: string, free_subscriber_views: string>>,"
    " devices: array<struct<device_type: string, views: string>>,"
    " categories: array<struct<category_type: string, category_views: string>>>")
TRAFFIC_ARRAYS = ("referrers", "devices", "categories")


def _array_sums(arr: Column, measures: list[tuple[str, str, str, str]]) -> Column:
    """One fold over ``arr`` giving, per ``(name, category field, label, measure field)``,
    the sum of the lenient-integer measure over elements of that category; a sum
    stays NULL when no such element has a value (SQL SUM semantics)."""
    init = F.struct(*[F.lit(None).cast("bigint").alias(n) for n, *_ in measures])

    def step(acc, x):
        fields = []
        for name, cat, label, val in measures:
            v = x[val].try_cast("bigint")
            fields.append(F.when((x[cat] == label) & v.isNotNull(),
                                 F.coalesce(acc[name], F.lit(0).cast("bigint")) + v)
                          .otherwise(acc[name]).alias(name))
        return F.struct(*fields)

    return F.aggregate(arr, init, step)


def stg_post_traffic(landing: DataFrame) -> DataFrame:
    """Traffic pivot per (post, publication, snapshot); posts missing any array drop out."""
    parsed = landing.where(F.col("post_id").isNotNull() & F.col("publication").isNotNull()
                           & F.col("snapshot_date").isNotNull()).select(
        *KEYS, F.from_json("data", TRAFFIC_SCHEMA).alias("j"))
    folded = parsed.select(
        *KEYS,
        *[F.coalesce(F.size(F.col(f"j.{a}")), F.lit(0)).alias(f"__n_{a}") for a in TRAFFIC_ARRAYS],
        *[_array_sums(F.col(f"j.{a}"), [(n, c, l, v) for n, arr, c, l, v in TRAFFIC_MEASURES if arr == a])
          .alias(f"__s_{a}") for a in TRAFFIC_ARRAYS])
    per_row = folded.select(
        *KEYS, *[f"__n_{a}" for a in TRAFFIC_ARRAYS],
        *[F.col(f"__s_{arr}.{name}").alias(name) for name, arr, *_ in TRAFFIC_MEASURES])
    per_row = per_row.withColumns({f"__n_{a}": F.greatest(F.col(f"__n_{a}"), F.lit(0))
                                   for a in TRAFFIC_ARRAYS})
    agg = per_row.groupBy(*KEYS).agg(
        *[F.sum(f"__n_{a}").alias(f"__n_{a}") for a in TRAFFIC_ARRAYS],
        *[F.sum(name).alias(name) for name, *_ in TRAFFIC_MEASURES])
    present = F.lit(True)
    for a in TRAFFIC_ARRAYS:
        present = present & (F.col(f"__n_{a}") > 0)
    return agg.where(present).select(*KEYS, *[name for name, *_ in TRAFFIC_MEASURES])


# ----------------------------------------------------------------- growth
# Output column -> JSON path of the growth payload.
GROWTH_FIELDS = [
    ("subscribes", "subscribes.totals.subscribes"),
    ("monthly_subscribes", "subscribes.totals.monthly_subscribes"),
    ("annual_subscribes", "subscribes.totals.annual_subscribes"),
    ("free_trials", "subscribes.totals.free_trials"),
    ("founding_subscribes", "subscribes.totals.founding_subscribes"),
    ("signups", "signups.total"),
    ("unsubscribes", "unsubscribes.total"),
]
GROWTH_SCHEMA = (
    "struct<subscribes: struct<totals: struct<subscribes: string, monthly_subscribes: string,"
    " annual_subscribes: string, free_trials: string, founding_subscribes: string>>,"
    " signups: struct<total: string>, unsubscribes: struct<total: string>>")


def stg_post_growth(landing: DataFrame) -> DataFrame:
    """Growth totals: lenient integer reads (text numbers accepted, objects -> NULL)."""
    parsed = landing.select(*KEYS, F.from_json("data", GROWTH_SCHEMA).alias("j"))
    return parsed.select(*KEYS, *[F.col(f"j.{p}").try_cast("bigint").alias(n) for n, p in GROWTH_FIELDS])


def stg_post_comments(landing: DataFrame) -> DataFrame:
    return landing.select("comment_id", "post_id", "publication", "parent_comment_id", "body",
                          "snapshot_date")


def latest_snapshot(df: DataFrame, key: str) -> DataFrame:
    """Latest snapshot per ``key`` (traffic, growth: post; comments: comment)."""
    return latest_per_key(df, [key], ["snapshot_date"], ["publication"])
