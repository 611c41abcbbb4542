"""Payment and landing relations derived from the driver test tables.

The driver data has no payment or post tables, so each relation the models read
is a projection (a few are aggregates) of a driver table.  Every binding is a
list of ``(column, SQL expression)`` pairs; Spark evaluates them with
``F.expr`` and the DuckDB oracle pastes the same text into its SQL, so both
engines see identical inputs.  A handful of tokens cover the dialect gaps:

``~TS~``          timestamp-without-zone type name
``~DIV~``         integer division operator
``~LABEL(x)~``    English "Month YYYY" text of a date
``~K~``           the integer ``k`` of ``events.props``

All bindings are narrow per-row projections except ``subscribers_snapshot``,
``subscription_history`` and ``plan``, which aggregate (partial aggregation
before the shuffle).  JSON payloads are built per event row, so no group is
ever collected into one document, from narrow rows that are dealt to all cores first.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subledger.sources.tables import load

DIALECTS = {
    "spark": {
        "~TS~": "TIMESTAMP_NTZ",
        "~DIV~": "div",
        "~LABEL(": "date_format(",
        ")~": ", 'MMMM yyyy')",
        "~K~": "__k",   # read once a row by ``_one``: a payload names it dozens of times
    },
    "duckdb": {
        "~TS~": "TIMESTAMP",
        "~DIV~": "//",
        "~LABEL(": "strftime(",
        ")~": ", '%B %Y')",
        "~K~": "CAST(json_extract_string(props, '$.k') AS BIGINT)",
    },
}


K = "~K~"


def render(expr: str, dialect: str) -> str:
    for token, text in DIALECTS[dialect].items():
        expr = expr.replace(token, text)
    return expr


#: Tasks per core that payload rows are dealt to, so that no long task is left at the end.
TASKS_PER_CORE = 4


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt evenly to all cores before they grow: a row of some 30 stored bytes becomes a payload of 2 KB that is parsed
    again, while a scan has no more tasks than the file has row groups."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(TASKS_PER_CORE * max(cores, df.rdd.getNumPartitions()))


@dataclass
class Binding:
    """``SELECT <columns> FROM <table> [WHERE <where>]``; parts are UNION ALL-ed."""

    table: str
    columns: list[tuple[str, str]]
    where: str | None = None
    union: list["Binding"] = field(default_factory=list)

    def to_spark(self, spark: SparkSession, root: str, scan=None) -> DataFrame:
        scan = scan or (lambda t: load(spark, root, t))
        df = self._one(scan)
        for part in self.union:
            df = df.unionByName(part._one(scan))
        return df

    def _one(self, scan) -> DataFrame:
        df = scan(self.table)
        if any(K in e for _, e in self.columns):
            df = spread(df).withColumn("__k", F.get_json_object("props", "$.k").cast("bigint"))
        if self.where:
            df = df.where(F.expr(render(self.where, "spark")))
        return df.select([F.expr(render(e, "spark")).alias(c) for c, e in self.columns])

    def to_sql(self) -> str:
        parts = [self] + self.union
        return "\nUNION ALL\n".join(p._one_sql() for p in parts)

    def _one_sql(self) -> str:
        cols = ",\n  ".join(f"{render(e, 'duckdb')} AS {c}" for c, e in self.columns)
        where = f"\nWHERE {render(self.where, 'duckdb')}" if self.where else ""
        return f"SELECT\n  {cols}\nFROM {self.table}{where}"


# ---------------------------------------------------------------- JSON text
def j_num(expr: str) -> str:
    return f"coalesce(CAST({expr} AS STRING), 'null')"


def j_str(expr: str) -> str:
    return f"coalesce('\"' || {expr} || '\"', 'null')"


def j_bool(cond: str) -> str:
    return f"(CASE WHEN {cond} THEN 'true' WHEN NOT ({cond}) THEN 'false' ELSE 'null' END)"


def j_obj(pairs: list[tuple[str, str]]) -> str:
    body = " || ',' || ".join(f"'\"{k}\":' || {v}" for k, v in pairs)
    return f"('{{' || {body} || '}}')"


def j_arr(items: list[str]) -> str:
    return "('[' || " + " || ',' || ".join(items) + " || ']')"


def j_decimal(cents: str) -> str:
    """Non-negative integer cents as a JSON number with two decimals."""
    return (f"(CAST({cents} ~DIV~ 100 AS STRING) || '.' || "
            f"lpad(CAST({cents} % 100 AS STRING), 2, '0'))")


def pick(selector: str, values: list[str]) -> str:
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"(CASE {selector} {whens} END)"


CENTS = "CAST(round(value * 100) AS BIGINT)"
PUBLICATION = "(CASE user_id % 3 WHEN 0 THEN 'pub_a' WHEN 1 THEN 'pub_b' ELSE 'pub_c' END)"
ORDER_CENTS = "CAST(round(o_totalprice * 100) AS BIGINT)"

# The category vocabularies of the traffic payload, in the order the
# pivot reads them, plus one unknown label each that the pivot must ignore.
REFERRER_CATEGORIES = ["Email", "Direct", "Substack", "Search", "Social", "News",
                       "Other External", "Other Internal", "Other", "Podcast"]
DEVICE_TYPES = ["Email", "Desktop Web", "Mobile Web", "Substack App", "TV"]
CATEGORY_TYPES = ["Email", "Direct", "Substack", "Search", "Social", "Other External",
                  "Other", "Unknown"]

# ------------------------------------------------------- payment relations
CHARGE = Binding("orders", [
    ("id", "o_orderkey"),
    ("customer_id", "o_custkey"),
    ("invoice_id", "CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderkey END"),
    ("balance_transaction_id", "o_orderkey * 10"),
    ("created", "o_orderdate"),
    ("amount", ORDER_CENTS),
    ("currency", "CASE WHEN o_orderkey % 2 = 0 THEN 'USD' ELSE 'usd' END"),
    ("receipt_email", "'user' || CAST(o_custkey AS STRING) || '@example.com'"),
    ("description",
     "CASE WHEN o_orderpriority = '5-LOW' AND o_orderkey % 50 = 0"
     " THEN 'Earnings from App Store subscriptions for week ' || CAST(o_orderkey % 52 AS STRING)"
     " WHEN o_orderpriority = '5-LOW'"
     " THEN 'Earnings from App Store subscriptions for ' || ~LABEL(o_orderdate)~"
     " WHEN o_orderpriority = '3-MEDIUM' THEN 'Earnings from App Store subscription fees'"
     " WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL"
     " ELSE 'Subscription payment' END"),
    ("status", "CASE WHEN o_orderstatus IN ('F', 'O') THEN 'succeeded' ELSE 'failed' END"),
])

REFUND_CENTS = ("(CAST(round(l_extendedprice * 100) AS BIGINT)"
                " * CAST(round(l_discount * 100) AS BIGINT)) ~DIV~ 100")

# Settlements: one per charge except every 97th order (missing settlement), plus
# one per refund.  Refund settlements carry negative amounts.
BALANCE_TRANSACTION = Binding("orders", [
    ("id", "o_orderkey * 10"),
    ("amount", ORDER_CENTS),
    ("fee", f"({ORDER_CENTS} * 29) ~DIV~ 1000 + 30"),
    ("net", f"{ORDER_CENTS} - (({ORDER_CENTS} * 29) ~DIV~ 1000 + 30)"),
    ("currency", "'usd'"),
    ("exchange_rate", "CASE WHEN o_orderkey % 5 = 0 THEN CAST(1.08 AS DOUBLE) ELSE CAST(NULL AS DOUBLE) END"),
], where="o_orderkey % 97 <> 0", union=[Binding("lineitem", [
    ("id", "l_orderkey * 10 + l_linenumber"),
    ("amount", f"-({REFUND_CENTS})"),
    ("fee", "CAST(0 AS BIGINT)"),
    ("net", f"-({REFUND_CENTS})"),
    ("currency", "'usd'"),
    ("exchange_rate", "CAST(NULL AS DOUBLE)"),
], where="l_returnflag = 'R'")])

REFUND = Binding("lineitem", [
    ("id", "l_orderkey * 10 + l_linenumber"),
    ("charge_id", "l_orderkey"),
    ("balance_transaction_id", "l_orderkey * 10 + l_linenumber"),
    ("created", "l_shipdate"),
    ("status", "CASE WHEN l_linestatus = 'F' THEN 'succeeded' ELSE 'pending' END"),
], where="l_returnflag = 'R'")

INVOICE = Binding("orders", [
    ("id", "o_orderkey"),
    ("subscription_id", "CASE WHEN o_orderkey % 89 = 0 THEN NULL ELSE o_custkey END"),
    ("customer_id", "o_custkey"),
    ("created", "o_orderdate"),
    ("period_start", "o_orderdate"),
    ("period_end", "o_orderdate + INTERVAL '30' DAY"),
    ("amount_paid", ORDER_CENTS),
    ("currency", "'USD'"),
    ("status", "'paid'"),
], where="o_orderpriority <> '5-LOW'")

CUSTOMER = Binding("customer", [
    ("id", "c_custkey"),
    ("email",
     "CASE WHEN c_custkey % 50 = 7 THEN NULL ELSE 'user' || CAST(CASE WHEN c_custkey % 100 = 1"
     " THEN c_custkey - 1 ELSE c_custkey END AS STRING) || '@example.com' END"),
    ("name", "c_name"),
    ("created", "~TS~ '1994-12-01 00:00:00'"),
    ("delinquent", "c_acctbal < 0"),
])

PLAN_SEGMENTS = "('BUILDING', 'MACHINERY', 'AUTOMOBILE')"

SUBSCRIPTION_ITEM = Binding("customer", [
    ("id", "c_custkey"),
    ("subscription_id", "c_custkey"),
    ("plan_id", "c_mktsegment"),
    ("created", "~TS~ '1995-01-01 00:00:00'"),
    ("_fivetran_synced", "~TS~ '1995-01-01 00:00:00'"),
], where=f"c_mktsegment IN {PLAN_SEGMENTS}", union=[Binding("customer", [
    # an older second item: the latest item must win
    ("id", "-c_custkey"),
    ("subscription_id", "c_custkey"),
    ("plan_id", "'MACHINERY'"),
    ("created", "~TS~ '1994-06-01 00:00:00'"),
    ("_fivetran_synced", "~TS~ '1994-06-01 00:00:00'"),
], where=f"c_custkey % 10 = 0 AND c_mktsegment IN {PLAN_SEGMENTS}")])

PLAN_COLUMNS = [
    ("id", "c_mktsegment"),
    ("interval", "CASE c_mktsegment WHEN 'BUILDING' THEN 'year' WHEN 'MACHINERY' THEN 'month'"
                 " ELSE 'week' END"),
    ("interval_count", "CAST(1 AS BIGINT)"),
    ("amount", "CAST(CASE c_mktsegment WHEN 'BUILDING' THEN 6000 WHEN 'MACHINERY' THEN 700"
               " ELSE 200 END AS BIGINT)"),
    ("currency", "'usd'"),
    ("active", "true"),
]

# ------------------------------------------------------- landing relations
OVERVIEW_POST = j_obj([
    ("id", j_num("user_id")),
    ("uuid", j_str("'p-' || CAST(user_id AS STRING)")),
    ("title", j_str("'Post ' || CAST(user_id AS STRING)")),
    ("slug", j_str("'post-' || CAST(user_id AS STRING)")),
    ("type", j_str("CASE WHEN user_id % 4 = 0 THEN 'podcast' ELSE 'newsletter' END")),
    ("audience", j_str("CASE WHEN user_id % 3 = 0 THEN 'only_paid' ELSE 'everyone' END")),
    ("meter_type", j_str("'none'")),
    ("is_published", "'true'"),
    ("should_send_email", j_bool("event_type <> 'error'")),
    ("write_comment_permissions", j_str("'everyone'")),
    ("publication_id", j_num("user_id % 3")),
    ("post_date", j_str("CAST(DATE '2024-01-31' - CAST(user_id * 3 AS INT) AS STRING) || ' 06:30:00'")),
    ("email_sent_at", j_str("CAST(DATE '2024-01-31' - CAST(user_id * 3 AS INT) AS STRING) || ' 07:00:00'")),
    ("draft_created_at", j_str("CAST(DATE '2024-01-30' - CAST(user_id * 3 AS INT) AS STRING) || ' 09:15:00'")),
    ("cover_image", j_str("'https://img.example/' || CAST(user_id AS STRING) || '.png'")),
    ("bylines", "(CASE WHEN user_id % 6 = 0 THEN '[]' ELSE " + j_arr([j_obj([
        ("name", j_str("'Author ' || CAST(user_id % 7 AS STRING)")),
        ("handle", j_str("'author' || CAST(user_id % 7 AS STRING)")),
    ])]) + " END)"),
    ("comment_count", j_num(f"{K} % 17")),
    ("reaction_count", j_num(f"{K} % 23")),
    ("stats", j_obj([
        ("queued", j_num(f"CASE WHEN event_type IN ('view', 'click') THEN {CENTS} END")),
        ("sent", f"(CASE WHEN event_id % 7 = 0 THEN '\"' || CAST({K} * 10 AS STRING) || '\"'"
                 f" ELSE CAST({K} * 10 AS STRING) END)"),
        ("delivered", f"(CASE WHEN event_id % 11 = 0 THEN CAST({K} AS STRING) || '.5'"
                      f" ELSE CAST({K} * 10 - {K} % 5 AS STRING) END)"),
        ("dropped", j_num(f"CASE WHEN event_type = 'error' THEN {K} % 5 END")),
        ("opened", j_num(f"{K} * 6")),
        ("opens", j_num(f"{K} * 8")),
        ("clicked", j_num(K)),
        ("clicks", j_num(f"{K} + {K} % 3")),
        ("open_rate", f"('0.' || lpad(CAST({K} % 100 AS STRING), 2, '0'))"),
        ("click_through_rate", f"('0.0' || CAST({K} % 10 AS STRING))"),
        ("views", j_num(f"{CENTS} % 5000")),
        ("engaged", j_num(f"CASE WHEN event_type = 'click' THEN {K} * 2 END")),
        ("subscribers_finished_post", j_num(f"CASE WHEN event_type = 'view' THEN {K} END")),
        ("restacks", j_num(f"CASE WHEN event_type = 'signup' THEN {K} % 7 END")),
        ("subscribes", j_num(f"{K} % 13")),
        ("monthly_subscribes", j_num(f"CASE WHEN event_type = 'purchase' THEN {K} % 5 END")),
        ("annual_subscribes", j_num(f"CASE WHEN event_type = 'purchase' THEN {K} % 3 END")),
        ("free_to_paid_upgrades", j_num(f"CASE WHEN event_type IN ('purchase', 'signup') THEN {K} % 4 END")),
        ("signups", j_num(f"{K} % 11")),
        ("likes", j_num(f"CASE WHEN event_type <> 'error' THEN {K} % 29 END")),
        ("shares", j_num(f"{K} % 9")),
        ("estimated_value", j_decimal(CENTS)),
        ("unsubscribes", j_num(f"CASE WHEN event_type = 'error' THEN {K} % 6 END")),
        ("unsubscribes_within_1_day", j_num(f"{K} % 2")),
        ("referrers", j_obj([("total_views", j_num(f"{CENTS} % 5000 + {K}"))])),
        ("comps", j_obj([
            ("n_comp_posts", j_num("10 + user_id % 5")),
            ("avg_open_rate", "('0.4' || CAST(user_id % 10 AS STRING))"),
            ("avg_views", j_decimal("250000 + user_id * 37")),
            ("avg_sent", j_num("1000 + user_id")),
        ])),
        ("data_updated_at", j_num("CASE WHEN event_type <> 'view' THEN 1704067200000 + event_id * 1000 END")),
    ])),
])

POST_OVERVIEW = Binding("events", [
    ("post_id", "user_id"),
    ("publication", PUBLICATION),
    ("snapshot_date", "ts"),
    ("data", "(CASE WHEN event_id % 41 = 0 THEN '{\"posts\":[]}' ELSE "
             "'{\"posts\":' || " + j_arr([OVERVIEW_POST]) + " || '}' END)"),
])

TRAFFIC_DATA = j_obj([
    ("referrers", j_arr([
        j_obj([("source_category", j_str(pick(f"{K} % 10", REFERRER_CATEGORIES))),
               ("views", j_num(K)),
               ("paid_subscriber_views", j_num(f"{K} % 7")),
               ("free_subscriber_views", j_num(f"{K} % 11"))]),
        j_obj([("source_category", j_str(pick("event_id % 10", REFERRER_CATEGORIES))),
               ("views", j_str(f"CAST({K} % 50 AS STRING)")),
               ("paid_subscriber_views", j_num("1")),
               ("free_subscriber_views", "'null'")]),
    ])),
    ("devices", f"(CASE WHEN user_id % 8 = 0 AND event_type = 'error' THEN 'null' ELSE "
                + j_arr([j_obj([("device_type", j_str(pick("event_id % 5", DEVICE_TYPES))),
                                ("views", j_num(K))])]) + " END)"),
    ("categories", "(CASE WHEN event_id % 37 = 0 THEN '[]' ELSE "
                   + j_arr([j_obj([("category_type", j_str(pick(f"{K} % 8", CATEGORY_TYPES))),
                                   ("category_views", j_num(f"{K} * 2"))])]) + " END)"),
])

POST_TRAFFIC = Binding("events", [
    ("post_id", "user_id"),
    ("publication", PUBLICATION),
    ("snapshot_date", "ts"),
    ("data", TRAFFIC_DATA),
])

GROWTH_DATA = j_obj([
    ("subscribes", j_obj([("totals", j_obj([
        ("subscribes", j_num(f"{K} % 13")),
        ("monthly_subscribes", j_str(f"CAST({K} % 5 AS STRING)")),
        ("annual_subscribes", f"(CASE WHEN event_id % 9 = 0 THEN CAST({K} % 3 AS STRING) || '.5'"
                              f" ELSE CAST({K} % 3 AS STRING) END)"),
        ("free_trials", j_num(f"{K} % 2")),
        ("founding_subscribes", f"(CASE WHEN event_id % 13 = 0 THEN '{{\"n\":1}}' ELSE '0' END)"),
    ]))])),
    ("signups", j_obj([("total", j_num(f"{K} % 11"))])),
    ("unsubscribes", j_obj([("total", j_num(f"CASE WHEN event_type <> 'view' THEN {K} % 6 END"))])),
])

POST_GROWTH = Binding("events", [
    ("post_id", "user_id"),
    ("publication", PUBLICATION),
    ("snapshot_date", "ts"),
    ("data", GROWTH_DATA),
])

_COMMENT_COLUMNS = [
    ("comment_id", "conv_id * 1000 + turn"),
    ("post_id", "conv_id % 40"),
    ("publication", "(CASE conv_id % 3 WHEN 0 THEN 'pub_a' WHEN 1 THEN 'pub_b' ELSE 'pub_c' END)"),
    ("parent_comment_id", "CASE WHEN turn = 0 THEN NULL ELSE conv_id * 1000 END"),
]
POST_COMMENTS = Binding("conversations", _COMMENT_COLUMNS + [
    ("body", "text"),
    ("snapshot_date", "CAST(DATE '2024-01-01' + CAST(conv_id % 28 AS INT) AS ~TS~)"),
], union=[Binding("conversations", _COMMENT_COLUMNS + [
    # a later snapshot of every odd turn with an edited body
    ("body", "text || ' [edited]'"),
    ("snapshot_date", "CAST(DATE '2024-01-02' + CAST(conv_id % 28 AS INT) AS ~TS~)"),
], where="turn % 2 = 1")])

# Subscriber snapshot: one row per user and UTC day of ``events``.
SUBSCRIBER_GROUP = [("user_id", "user_id"), ("snap_day", "CAST(ts AS DATE)")]
SUBSCRIBER_AGGS = [
    ("first_purchase_ts", "min(CASE WHEN event_type = 'purchase' THEN ts END)"),
    ("last_error_ts", "max(CASE WHEN event_type = 'error' THEN ts END)"),
    ("revenue_cents", f"CAST(sum({CENTS}) AS BIGINT)"),
    ("clicks", "CAST(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS BIGINT)"),
    ("n_events", "CAST(count(*) AS BIGINT)"),
]
SUBSCRIBER_TOP = [
    ("snapshot_date", "CAST(snap_day AS ~TS~)"),
    ("publication", PUBLICATION),
]
SUBSCRIBER_STRUCT = [
    ("subscription_id", "user_id"),
    ("user_id", "user_id"),
    ("user_email_address",
     "CASE user_id % 10 WHEN 0 THEN NULL"
     " WHEN 1 THEN 'USER' || CAST(user_id AS STRING) || '@EXAMPLE.COM'"
     " WHEN 2 THEN '  user' || CAST(user_id AS STRING) || '@example.com '"
     " ELSE 'user' || CAST(user_id AS STRING) || '@example.com' END"),
    ("user_name", "'Reader ' || CAST(user_id AS STRING)"),
    ("subscriber", "CASE WHEN first_purchase_ts IS NULL THEN 'free' ELSE 'paid' END"),
    ("stripe_plan_name",
     "CASE user_id % 4 WHEN 0 THEN '$7 a month' WHEN 1 THEN '$60.50 a year'"
     " WHEN 2 THEN 'Founding member plan' END"),
    ("is_subscribed", "true"),
    ("is_comp", "CASE WHEN user_id % 13 = 0 THEN NULL ELSE user_id % 11 = 0 END"),
    ("is_gift", "CASE WHEN user_id % 17 = 0 THEN NULL ELSE user_id % 7 = 0 END"),
    ("is_free_trial", "user_id % 19 = 0"),
    ("subscription_interval",
     "CASE user_id % 5 WHEN 0 THEN 'annual' WHEN 1 THEN 'monthly' WHEN 2 THEN 'lifetime'"
     " WHEN 4 THEN 'monthly' END"),
    ("subscription_created_at", "CAST(DATE '2023-06-01' + CAST(user_id % 200 AS INT) AS ~TS~)"),
    ("first_payment_at", "first_purchase_ts"),
    ("subscription_expires_at",
     "CASE WHEN user_id % 23 = 0 THEN NULL"
     " ELSE CAST(snap_day + CAST(user_id % 5 - 2 AS INT) AS ~TS~) END"),
    ("unsubscribed_at", "last_error_ts"),
    ("total_revenue_generated", "revenue_cents"),
    ("country", "'NATION_' || CAST(user_id % 25 AS STRING)"),
    ("paid_attribution",
     "CASE WHEN user_id % 9 = 0 THEN 'substack-ios-in-app-purchase' ELSE 'direct' END"),
    ("free_attribution", "'email'"),
    ("activity_rating", "clicks"),
    ("total_count", "n_events"),
]


# ------------------------------------------------------- Spark entry points
# ``scan(table) -> DataFrame`` lets one set of bindings share a single scan per
# driver table (one file listing and footer read instead of one per binding).
def charge(spark, root, scan=None): return CHARGE.to_spark(spark, root, scan)
def balance_transaction(spark, root, scan=None): return BALANCE_TRANSACTION.to_spark(spark, root, scan)
def refund(spark, root, scan=None): return REFUND.to_spark(spark, root, scan)
def invoice(spark, root, scan=None): return INVOICE.to_spark(spark, root, scan)
def customer(spark, root, scan=None): return CUSTOMER.to_spark(spark, root, scan)
def subscription_item(spark, root, scan=None): return SUBSCRIPTION_ITEM.to_spark(spark, root, scan)
def post_overview(spark, root, scan=None): return POST_OVERVIEW.to_spark(spark, root, scan)
def post_traffic(spark, root, scan=None): return POST_TRAFFIC.to_spark(spark, root, scan)
def post_growth(spark, root, scan=None): return POST_GROWTH.to_spark(spark, root, scan)
def post_comments(spark, root, scan=None): return POST_COMMENTS.to_spark(spark, root, scan)


def plan(spark: SparkSession, root: str, scan=None) -> DataFrame:
    """Plan dimension: one row per market segment that carries a plan."""
    scan = scan or (lambda t: load(spark, root, t))
    segments = (scan("customer").select("c_mktsegment")
                .where(F.expr(f"c_mktsegment IN {PLAN_SEGMENTS}")).distinct())
    return segments.select([F.expr(e).alias(c) for c, e in PLAN_COLUMNS])


def subscribers_snapshot(spark: SparkSession, root: str, scan=None) -> DataFrame:
    """Landing subscriber snapshot with the nested ``sub`` struct."""
    scan = scan or (lambda t: load(spark, root, t))
    ev = scan("events")
    daily = ev.groupBy(*[F.expr(render(e, "spark")).alias(c) for c, e in SUBSCRIBER_GROUP]).agg(
        *[F.expr(render(e, "spark")).alias(c) for c, e in SUBSCRIBER_AGGS])
    return daily.select(
        *[F.expr(render(e, "spark")).alias(c) for c, e in SUBSCRIBER_TOP],
        F.struct(*[F.expr(render(e, "spark")).alias(c) for c, e in SUBSCRIBER_STRUCT]).alias("sub"),
    )


def subscription_history(spark: SparkSession, root: str, scan=None) -> DataFrame:
    """Subscription versions (one per customer with orders, a second on cancellation).

    Version 1 opens at the first order.  Customers with a negative balance cancel:
    below -800 on the day they started (same-day cancel), otherwise 20 days after
    their last order; the cancellation opens version 2.
    """
    scan = scan or (lambda t: load(spark, root, t))
    life = scan("orders").groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("first_ts"), F.max("o_orderdate").alias("last_ts"))
    cust = scan("customer").select("c_custkey", "c_acctbal")
    base = life.join(cust, life.o_custkey == cust.c_custkey).withColumn(
        "cancel_ts", F.expr(SUBSCRIPTION_CANCEL_TS))
    versions = base.withColumn(
        "version", F.explode(F.sequence(F.lit(1), F.when(F.col("cancel_ts").isNull(), 1).otherwise(2))))
    return versions.select([F.expr(render(e, "spark")).alias(c) for c, e in SUBSCRIPTION_VERSION])


SUBSCRIPTION_CANCEL_TS = ("CASE WHEN c_acctbal < -800 THEN first_ts + INTERVAL '3' HOUR"
                          " WHEN c_acctbal < 0 THEN last_ts + INTERVAL '20' DAY END")
_V2 = "version = 2"
SUBSCRIPTION_VERSION = [
    ("id", "o_custkey"),
    ("customer_id", "o_custkey"),
    ("status", f"CASE WHEN {_V2} THEN 'canceled' ELSE 'active' END"),
    ("current_period_start", "first_ts"),
    ("current_period_end", "first_ts + INTERVAL '30' DAY"),
    ("cancel_at_period_end", _V2),
    ("cancel_at", f"CASE WHEN {_V2} THEN cancel_ts END"),
    ("canceled_at", f"CASE WHEN {_V2} THEN cancel_ts END"),
    ("ended_at", f"CASE WHEN {_V2} THEN cancel_ts END"),
    ("created", "first_ts"),
    ("start_date", "first_ts"),
    ("trial_start", "CAST(NULL AS ~TS~)"),
    ("trial_end", "CAST(NULL AS ~TS~)"),
    ("_fivetran_active", f"{_V2} OR cancel_ts IS NULL"),
    ("_fivetran_start", f"CASE WHEN {_V2} THEN cancel_ts ELSE first_ts END"),
    ("_fivetran_end", f"CASE WHEN {_V2} OR cancel_ts IS NULL THEN ~TS~ '9999-12-31 00:00:00'"
                      " ELSE cancel_ts END"),
]


def binding_ctes() -> dict[str, str]:
    """DuckDB SQL of every binding, keyed by the relation name the models read."""
    sql = {
        "src_charge": CHARGE.to_sql(),
        "src_balance_transaction": BALANCE_TRANSACTION.to_sql(),
        "src_refund": REFUND.to_sql(),
        "src_invoice": INVOICE.to_sql(),
        "src_customer": CUSTOMER.to_sql(),
        "src_subscription_item": SUBSCRIPTION_ITEM.to_sql(),
        "src_post_overview": POST_OVERVIEW.to_sql(),
        "src_post_traffic": POST_TRAFFIC.to_sql(),
        "src_post_growth": POST_GROWTH.to_sql(),
        "src_post_comments": POST_COMMENTS.to_sql(),
    }
    plan_cols = ",\n  ".join(f"{render(e, 'duckdb')} AS {c}" for c, e in PLAN_COLUMNS)
    sql["src_plan"] = (f"SELECT\n  {plan_cols}\nFROM (SELECT DISTINCT c_mktsegment FROM customer"
                       f" WHERE c_mktsegment IN {PLAN_SEGMENTS}) s")
    group = ", ".join(f"{render(e, 'duckdb')} AS {c}" for c, e in SUBSCRIBER_GROUP)
    aggs = ", ".join(f"{render(e, 'duckdb')} AS {c}" for c, e in SUBSCRIBER_AGGS)
    top = ", ".join(f"{render(e, 'duckdb')} AS {c}" for c, e in SUBSCRIBER_TOP)
    struct = ", ".join(f"{c} := {render(e, 'duckdb')}" for c, e in SUBSCRIBER_STRUCT)
    sql["src_subscribers_snapshot"] = (
        f"SELECT {top}, struct_pack({struct}) AS sub FROM ("
        f"SELECT {group}, {aggs} FROM events GROUP BY ALL) d")
    version_cols = ",\n  ".join(f"{render(e, 'duckdb')} AS {c}" for c, e in SUBSCRIPTION_VERSION)
    sql["src_subscription_history"] = (
        f"SELECT\n  {version_cols}\nFROM (\n"
        f"  SELECT b.*, v.version FROM (\n"
        f"    SELECT l.*, c.c_acctbal, {render(SUBSCRIPTION_CANCEL_TS, 'duckdb')} AS cancel_ts FROM (\n"
        f"      SELECT o_custkey, min(o_orderdate) AS first_ts, max(o_orderdate) AS last_ts\n"
        f"      FROM orders GROUP BY o_custkey) l\n"
        f"    JOIN customer c ON l.o_custkey = c.c_custkey) b,\n"
        f"  (SELECT 1 AS version UNION ALL SELECT 2) v\n"
        f"  WHERE v.version = 1 OR b.cancel_ts IS NOT NULL) x")
    return sql
