"""The same operators on a sales star schema: orders, line items, customers, events, texts.

Roles map as follows: an order is an opening and its priority the department, an event is
an application and its type the stage, a customer is a candidate and the market segment
the channel, an order's price is the fee, spend or deal amount.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar_day, exact_total, month_of
from ..operators import metrics, shaping
from ..session import bound_tasks
from .checks import (
    INTEGRITY, RECONCILIATION, VALIDITY, Check, MatchedTotal, MonthlyTotal, Rows, Surplus, Total, Unmatched,
)

Tables = Mapping[str, DataFrame]

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

# Event types in funnel order; an "error" event only counts as entered.
FUNNEL = [("clicked", "click"), ("signed_up", "signup"), ("purchased", "purchase")]
PAID_SEGMENTS = ["BUILDING", "MACHINERY", "HOUSEHOLD"]
FINISHED, OPEN, PENDING = "F", "O", "P"


class StarTables(Mapping):
    """The tables of a folder and the derived inputs of the checks, opened when first used.

    Opening a table lists its files, so a query pays only for the tables it names.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder
        self._open: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._open:
            derive = DERIVED.get(name)
            if derive is None and name not in TABLES:
                raise KeyError(name)
            self._open[name] = (
                derive(self) if derive else self._spark.read.parquet(f"{self._folder}/{name}.parquet")
            )
        return self._open[name]

    def __iter__(self) -> Iterator[str]:
        return iter([*TABLES, *DERIVED])

    def __len__(self) -> int:
        return len(TABLES) + len(DERIVED)


def read_tables(spark: SparkSession, folder: str) -> StarTables:
    bound_tasks(spark)
    return StarTables(spark, folder)


def shipments(tables: Tables) -> DataFrame:
    """Line items with their order's dates. Both sides are large and join on the order key.

    Only narrow columns are shuffled. Adaptive execution splits the partition of an order
    key that holds too many line items, and broadcasts a side it has seen to be small.
    """
    lines = tables["lineitem"].select("l_orderkey", "l_shipdate")
    orders = tables["orders"].select("o_orderkey", "o_orderdate", "o_orderpriority")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def user_turns(tables: Tables) -> DataFrame:
    """User turns with the turn that should answer them: the next of the conversation."""
    turns = tables["conversations"].where(F.col("role") == "user")
    return turns.select("conv_id", (F.col("turn") + 1).alias("reply_turn"))


def document_texts(tables: Tables) -> DataFrame:
    """Whole texts as 256-bit digests, so that equal texts meet without shuffling texts."""
    return tables["documents"].select(F.unhex(F.sha2("text", 256)).alias("text_digest"))


def rated_customers(tables: Tables) -> DataFrame:
    """Customers with a rating, which is missing when they owe money."""
    balance = F.col("c_acctbal")
    return tables["customer"].select("c_custkey", F.when(balance >= 0, balance).alias("rating"))


DERIVED = {"rated_customers": rated_customers, "shipments": shipments, "user_turns": user_turns, "document_texts": document_texts}


# --- reports --------------------------------------------------------------------------


def days_to_ship_by_priority(t: Tables) -> DataFrame:
    shipped = t["shipments"].where(F.col("l_shipdate") >= F.col("o_orderdate"))
    return metrics.mean_duration_by(
        shipped, "o_orderpriority", "o_orderdate", "l_shipdate", counted="shipped_lines", mean="avg_days_to_ship"
    )


def finish_rate_by_month(t: Tables) -> DataFrame:
    return metrics.rate_by(
        t["orders"], month_of("o_orderdate").alias("order_month"), F.col("o_orderstatus") == FINISHED,
        total="orders_placed", hits="orders_finished", rate="finish_rate_pct", digits=1,
    ).orderBy("order_month")


def event_funnel(t: Tables) -> DataFrame:
    return metrics.cumulative_funnel(t["events"], "event_type", FUNNEL, "entered")


def purchase_rate_by_segment(t: Tables) -> DataFrame:
    return metrics.rate_by_lookup(
        t["events"], "user_id", t["customer"], "c_custkey", "c_mktsegment", F.col("event_type") == "purchase",
        total="events", hits="purchases", rate="purchase_rate_pct", digits=2,
    )


def spend_by_paid_segment(t: Tables) -> DataFrame:
    """Order values with the segment of their customer, paid segments only.

    Orders are totalled per customer before they join.
    """
    paid = t["customer"].where(F.col("c_mktsegment").isin(PAID_SEGMENTS)).select("c_custkey", "c_mktsegment")
    orders = t["orders"].select(F.col("o_custkey").alias("c_custkey"), F.col("o_totalprice").alias("spend"))
    return orders.groupBy("c_custkey").agg(exact_total("spend").alias("spend")).join(paid, "c_custkey")


def cost_per_purchase_by_segment(t: Tables) -> DataFrame:
    purchases = metrics.count_by_lookup(
        t["events"].where(F.col("event_type") == "purchase"), "user_id",
        t["customer"], "c_custkey", "c_mktsegment", counted="purchases",
    )
    return metrics.cost_per_outcome(
        purchases, spend_by_paid_segment(t), "c_mktsegment", "c_mktsegment", "spend",
        counted="purchases", total="total_spend", cost="cost_per_purchase",
    )


def monthly_order_value(t: Tables) -> DataFrame:
    return metrics.period_totals(
        t["orders"].where(F.col("o_orderstatus") == FINISHED), "o_orderdate", "o_totalprice",
        month="order_month", counted="orders", total="order_value", mean="avg_value",
    )


def orders_by_status(t: Tables) -> DataFrame:
    return metrics.stage_totals(
        t["orders"], "o_orderstatus", "o_totalprice", counted="orders", total="total_value"
    )


def finish_ratio(t: Tables) -> DataFrame:
    return metrics.outcome_ratio(
        t["orders"], "o_orderstatus", FINISHED, PENDING, won="finished", lost="pending", rate="finish_pct"
    )


def run_log_from_events(t: Tables) -> DataFrame:
    """Events in the shape of a run log: an error event is a broken run, a signup one with failures."""
    status = (
        F.when(F.col("event_type") == "error", "error")
        .when(F.col("event_type") == "signup", "failed_checks")
        .otherwise("success")
    )
    return t["events"].select(
        F.col("event_id").alias("run_id"),
        F.lit("validation").alias("run_type"),
        F.col("ts").alias("started_at"),
        F.col("ts").alias("finished_at"),
        status.alias("status"),
        F.when(F.col("event_type") == "error", F.lit(0)).otherwise(F.lit(19)).cast("bigint").alias("checks_total"),
        F.when(status == "success", F.lit(0)).otherwise(F.lit(1)).cast("bigint").alias("checks_failed"),
        F.when(status == "error", F.substring("props", 1, 500)).alias("error_message"),
    )


def first_seen_users(t: Tables) -> DataFrame:
    return shaping.first_seen(t["events"].withColumn("day", calendar_day("ts")), "user_id", "day", "first_day")


# --- checks ---------------------------------------------------------------------------


_VALUE = Total("orders", "o_totalprice")

CHECKS = [
    Check(INTEGRITY, "orphan_orders_customer", "Each order has its customer",
          Unmatched("orders", ("o_custkey",), "customer", ("c_custkey",))),
    Check(INTEGRITY, "orphan_lines_order", "Each line item has its order",
          Unmatched("lineitem", ("l_orderkey",), "orders", ("o_orderkey",))),
    Check(INTEGRITY, "orphan_documents_label", "Each document has a label",
          Unmatched("documents", ("doc_id",), "labels", ("doc_id",))),
    Check(INTEGRITY, "orphan_events_customer", "Each event has its customer",
          Unmatched("events", ("user_id",), "customer", ("c_custkey",))),
    Check(INTEGRITY, "duplicate_order_key", "No order key is missing or repeated",
          Surplus("orders", "o_orderkey")),
    Check(INTEGRITY, "duplicate_line_order_key", "No order has more than one line",
          Surplus("lineitem", "l_orderkey")),
    Check(INTEGRITY, "duplicate_document_text", "No document text is missing or repeated",
          Surplus("document_texts", "text_digest")),
    Check(RECONCILIATION, "orders_vs_returned_lines", "As many orders as returned lines",
          Rows("orders"), expected=Rows("lineitem", "l_returnflag = 'R'")),
    Check(RECONCILIATION, "customers_vs_purchases", "As many customers as purchases",
          Rows("customer"), expected=Rows("events", "event_type = 'purchase'")),
    Check(RECONCILIATION, "user_turns_without_answer", "Each user turn is answered by the next turn",
          Unmatched("user_turns", ("conv_id", "reply_turn"), "conversations", ("conv_id", "turn"),
                    "role = 'assistant'", witness="role")),
    Check(RECONCILIATION, "order_value_vs_monthly_report", "All order value appears in the monthly report",
          MonthlyTotal("orders", "o_totalprice", "o_orderdate"), expected=_VALUE),
    Check(RECONCILIATION, "order_value_vs_solvent_customers", "All order value belongs to solvent customers",
          MatchedTotal("orders", "o_totalprice", ("o_custkey",), "customer", ("c_custkey",), "c_acctbal >= 0"),
          expected=_VALUE),
    Check(VALIDITY, "finished_orders_without_customer", "A finished order has a customer",
          Rows("orders", f"o_orderstatus = '{FINISHED}' AND o_custkey IS NULL")),
    Check(VALIDITY, "error_events_with_value", "An error event has no value",
          Rows("events", "event_type = 'error' AND value IS NOT NULL")),
    Check(VALIDITY, "shipped_before_ordered", "A line ships on or after the day of its order",
          Rows("shipments", "l_shipdate < o_orderdate")),
    Check(VALIDITY, "negative_or_missing_balance", "A balance is known and at least zero",
          Rows("customer", "c_acctbal IS NULL OR c_acctbal < 0")),
    Check(VALIDITY, "discount_exceeds_quantity", "A discount is at most the quantity",
          Rows("lineitem", "l_discount > l_quantity")),
    Check(VALIDITY, "purchases_without_user", "A purchase has a user",
          Rows("events", "event_type = 'purchase' AND user_id IS NULL")),
    Check(VALIDITY, "page_events_without_value", "A click or view has a value",
          Rows("events", "event_type IN ('click', 'view') AND value IS NULL")),
]

LINE_PARTS = Check(
    INTEGRITY, "orphan_lines_part", "Each line item has its part",
    Unmatched("lineitem", ("l_partkey",), "part", ("p_partkey",)),
)

RATED_CUSTOMERS = Check(
    RECONCILIATION, "orders_without_rated_customer", "Each order's customer has a rating",
    Unmatched("orders", ("o_custkey",), "rated_customers", ("c_custkey",), witness="rating"),
)
