
from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable
from functools import reduce

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from hirelattice.functions import (  # noqa: E402
    calendar_day, clip, days_between, month_of, padded_id, plain_number, safe_ratio, trailing_number,
)
from hirelattice.operators import matching, metrics  # noqa: E402
from hirelattice.plans import audit, growing, hiring, recruiting, runs, star  # noqa: E402
from hirelattice.schemas import PAYLOAD  # noqa: E402
from hirelattice.session import fresh_folder  # noqa: E402
from hirelattice.sources import csv_files, tables  # noqa: E402
from hirelattice.streaming import alerts  # noqa: E402
from oracles import hiring_sql, operator_sql, star_sql  # noqa: E402

try:  # the corpus operators are an optional subpackage; so is all that only they import
    import corpus_pipeline  # noqa: E402
    import hirelattice.llm.registry as corpus  # noqa: E402
except ImportError:
    corpus = None

SMOKE_FOLDER = "/root/testdata/sf0.001"
PROJECT = "hiring-audit"

Query = Callable[[SparkSession, str], DataFrame]


def entry(spark: SparkSession) -> DataFrame:
    """The audit of the star tables: all nineteen checks, scored."""
    return audit.audit_fused(star.CHECKS, star.read_tables(spark, SMOKE_FOLDER))


def _on_star(build: Callable[[dict], DataFrame]) -> Query:
    return lambda spark, folder: build(star.read_tables(spark, folder))


def _on_hiring(build: Callable[[dict], DataFrame]) -> Query:
    return lambda spark, folder: build(hiring.stored_tables(spark, folder))


def _scratch_namespace(spark: SparkSession) -> str:
    name = f"hl_{uuid.uuid4().hex}"
    return tables.create_namespace(spark, name, fresh_folder(spark, "namespace"))


# --- operators --------------------------------------------------------------------------


def _key_conditions(t: dict) -> DataFrame:
    """The conditions of the integrity gate as (condition, holds) rows."""

    def member(child: str, key: str, parent: str) -> DataFrame:
        return matching.all_members(t[child], t[parent], [key])

    vacancies = t["vacancies"]
    closed = vacancies.dropna(subset=["closed_at"])
    still_open = vacancies.where(F.col("status") == "open")
    conditions = {
        "vacancies have clients": member("vacancies", "client_id", "clients"),
        "applications have vacancies": member("applications", "vacancy_id", "vacancies"),
        "applications have candidates": member("applications", "candidate_id", "candidates"),
        "placements have vacancies": member("placements", "vacancy_id", "vacancies"),
        "placements have candidates": member("placements", "candidate_id", "candidates"),
        "closed on or after opening": metrics.every_row(closed, F.col("closed_at") >= F.col("opened_at"), "holds"),
        "open means not closed": metrics.every_row(still_open, F.col("closed_at").isNull(), "holds"),
        "every vacancy is filled": metrics.every_row(vacancies, F.col("status") == "filled", "holds"),
    }
    rows = [df.select(F.lit(name).alias("condition"), "holds") for name, df in conditions.items()]
    result = rows[0]
    for row in rows[1:]:
        result = result.unionByName(row)
    return result


def _scalar_functions(t: dict) -> DataFrame:
    day = calendar_day("o_orderdate")
    order_id = padded_id("ord_", F.col("o_orderkey") + 1, 6)
    return t["orders"].select(
        "o_orderkey",
        month_of(day).alias("order_month"),
        day.alias("order_day"),
        days_between(F.lit("1995-01-01").cast("date"), day).alias("age_days"),
        clip(days_between(F.lit("1995-01-01").cast("date"), day), 100, 2000).alias("age_clipped"),
        F.date_add(day, 30).alias("due_day"),
        F.greatest(day, F.lit("1997-01-01").cast("date")).alias("later_day"),
        F.when(F.weekday(day) < 5, "weekday").otherwise("weekend").alias("day_kind"),
        order_id.alias("order_id"),
        trailing_number(order_id, "ord_").alias("order_number"),
        safe_ratio(F.col("o_orderkey"), F.col("o_custkey")).alias("key_ratio"),
        F.abs(F.col("o_custkey") - F.lit(500)).alias("distance"),
        F.substring("o_orderpriority", 1, 4).alias("priority_start"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("order_time"),
        plain_number("o_totalprice").alias("price_text"),
    )


def _orphan_documents(t: dict) -> DataFrame:
    documents = t["documents"].select("doc_id", "lang", "source", "n_chars")
    return matching.orphan_rows(documents, t["labels"], ["doc_id"])


def _labelled_documents(t: dict) -> DataFrame:
    documents = t["documents"].select("doc_id", "lang", "source", "n_chars")
    return matching.member_rows(documents, t["labels"], ["doc_id"])


def _customers_without_orders(t: dict) -> DataFrame:
    return matching.orphan_count_of_few(t["customer"], t["orders"], ["c_custkey"], ["o_custkey"])


# --- sources ----------------------------------------------------------------------------


def _load_hiring_csv(spark: SparkSession, folder: str, *only: str) -> tuple[str, DataFrame]:
    """Write the hiring tables (or some) as CSV, load them into a new namespace; the load report."""
    exported = fresh_folder(spark, "csv")
    for name, frame in hiring.stored_tables(spark, folder).items():
        if name in (only or recruiting.TABLES):
            csv_files.write_csv(frame, exported, name)
    namespace = _scratch_namespace(spark)
    return namespace, tables.load_folder(spark, exported, namespace)


def _csv_load_report(spark: SparkSession, folder: str) -> DataFrame:
    _, report = _load_hiring_csv(spark, folder)
    return report.select(F.split_part("table", F.lit("."), F.lit(2)).alias("table"), "rows")


def _csv_loaded(table: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        namespace, _ = _load_hiring_csv(spark, folder, table)
        return tables.read_namespace(spark, namespace, [table])[table].drop("_loaded_at")

    return query


def _csv_loaded_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents through a CSV whose texts hold line breaks and quotes, read in splits."""
    exported = fresh_folder(spark, "csv")
    documents = star.read_tables(spark, folder)["documents"].select("doc_id", "text", "n_chars")
    path = csv_files.write_csv(documents, exported, "documents", multiline=True)
    loaded = csv_files.read_csv(spark, path, documents.schema, missing=[], multiline=True)
    return loaded.select("doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"), "n_chars")


def _csv_inferred_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders through a CSV read without a schema."""
    exported = fresh_folder(spark, "csv")
    orders = star.read_tables(spark, folder)["orders"]
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    path = csv_files.write_csv(orders.select(*columns, F.to_date("o_orderdate").alias("o_orderday")), exported, "orders")
    return csv_files.read_csv(spark, path)


def _load_stamps(spark: SparkSession, folder: str) -> DataFrame:
    """Different load stamps per table, and rows without one."""
    namespace, _ = _load_hiring_csv(spark, folder)
    rows = [
        frame.agg(F.count_distinct("_loaded_at").alias("stamps"), F.count_if(F.col("_loaded_at").isNull()).alias("unstamped"))
        .select(F.lit(name).alias("table"), "stamps", "unstamped")
        for name, frame in tables.read_namespace(spark, namespace).items()
    ]
    return reduce(DataFrame.unionByName, rows)


def _table_replaced(spark: SparkSession, folder: str) -> DataFrame:
    """Store the orders, then replace them by their status totals: new rows, new schema."""
    table = f"{_scratch_namespace(spark)}.report"
    orders = star.read_tables(spark, folder)["orders"]
    tables.replace_table(orders, table)
    tables.replace_table(orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders")), table)
    return spark.table(table)


def _table_kept(spark: SparkSession, folder: str) -> DataFrame:
    """A replacement that fails on the way: the stored rows are still there."""
    table = f"{_scratch_namespace(spark)}.report"
    orders = star.read_tables(spark, folder)["orders"]
    tables.replace_table(orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders")), table)
    broken = F.raise_error(F.lit("broken on purpose")).cast("bigint")
    try:
        tables.replace_table(orders.select(F.when(F.col("o_orderkey") >= 0, broken).alias("orders")), table)
    except Exception as failed:
        if "broken on purpose" not in str(failed):
            raise
    return spark.table(table)


def _table_replaced_by_month(spark: SparkSession, folder: str) -> DataFrame:
    """Store all orders by month, replace them by the finished ones, append the open ones."""
    table = f"{_scratch_namespace(spark)}.orders"
    orders = star.read_tables(spark, folder)["orders"].withColumn("order_month", month_of(calendar_day("o_orderdate")))
    tables.replace_table(orders, table, ["order_month"])
    tables.replace_table(orders.where("o_orderstatus = 'F'"), table, ["order_month"])
    tables.append_table(orders.where("o_orderstatus = 'O'"), table, ["order_month"])
    return spark.table(table).groupBy("order_month").agg(
        F.count(F.lit(1)).alias("orders"), F.min("o_orderkey").alias("first_order"), F.max("o_orderkey").alias("last_order")
    )


def _run_log_appended_once(spark: SparkSession, folder: str) -> DataFrame:
    """A run log from events: half of it, then all of it, then all of it again."""
    table = f"{_scratch_namespace(spark)}.runs"
    log = star.run_log_from_events(star.read_tables(spark, folder))
    tables.append_table(log.where(F.col("run_id") % 2 == 0), table, once=["run_id"])
    for _ in range(2):
        tables.append_table(log, table, once=["run_id"])
    return spark.table(table).select("run_id", "status", "checks_total", "checks_failed", "error_message")


# --- tables that grow ---------------------------------------------------------------------


def _monthly_revenue_kept(spark: SparkSession, folder: str) -> DataFrame:
    """Monthly revenue from kept states: half of the placements at first, one month wrong; the rest appended, the month replaced."""
    placements = hiring.stored_tables(spark, folder)["placements"]
    namespace = _scratch_namespace(spark)
    kept = growing.MonthlyTotals(spark, f"{namespace}.placements", f"{namespace}.months", "placed_at", "placement_fee_usd")
    early, wrong = F.col("placed_at") < F.lit("1996-01-01").cast("date"), F.trunc("placed_at", "YEAR") == F.lit("1995-01-01").cast("date")
    kept.build(placements.where(early).withColumn("placement_fee_usd", F.when(wrong, 1.0).otherwise(F.col("placement_fee_usd"))))
    kept.append(placements.where(~F.coalesce(early, F.lit(False))))
    kept.replace_months(placements.where(wrong))
    return kept.report(month="placement_month", counted="placements", total="revenue_usd", mean="avg_fee_usd")


def _ids_on_growth(spark: SparkSession, folder: str) -> DataFrame:
    """Orders numbered in three batches by year, the second one twice: numbers go on, none changes."""
    table = f"{_scratch_namespace(spark)}.orders"
    orders = star.read_tables(spark, folder)["orders"].select("o_orderkey", F.year("o_orderdate").alias("o_year"))
    for batch, rows in (("a", "o_year < 1994"), ("b", "o_year = 1994"), ("b", "o_year = 1994"), ("c", "o_year > 1994")):
        growing.append_numbered(orders.where(rows), table, ["o_orderkey"], "order_id", "ord_", 6, batch)
    return spark.table(table).select("order_id", "o_orderkey", "batch")


def _recent_runs_by_day(spark: SparkSession, folder: str) -> DataFrame:
    """The newest runs of a log stored by day, from its newest days only."""
    table = f"{_scratch_namespace(spark)}.runs"
    log = star.run_log_from_events(star.read_tables(spark, folder)).withColumn("run_day", calendar_day("started_at"))
    tables.replace_table(log.repartition("run_day"), table, ["run_day"])
    columns = ["started_at", "run_type", "status", "checks_total", "checks_failed", "error_message"]
    return growing.newest_rows(spark.table(table), "run_day", "started_at", "run_id", columns, runs.RECENT_RUNS)


# --- validation runs ----------------------------------------------------------------------


def _faulty_audit(spark: SparkSession, folder: str) -> DataFrame:
    return recruiting.audit_checks(recruiting.inject_faults(hiring.stored_tables(spark, folder)))


def _audit_from_counters(spark: SparkSession, folder: str) -> DataFrame:
    """Counters of the clean tables are kept, those of the tables with faults put in their place, then audited."""
    stored = f"{_scratch_namespace(spark)}.counters"
    clean = hiring.stored_tables(spark, folder)
    faulty = recruiting.inject_faults(clean)
    audit.store_counters(recruiting.CHECKS, clean, stored, buckets=8)
    changed = ["clients", "vacancies", "placements", "marketing_daily", "sales_deals"]
    audit.store_counters(recruiting.CHECKS, faulty, stored, buckets=8, only=changed)
    return audit.audit_stored(recruiting.CHECKS, spark.table(stored))


def _validate(spark: SparkSession, folder: str, namespace: str, build=None) -> runs.RunOutcome:
    return runs.run_validation(
        spark, build or (lambda: _faulty_audit(spark, folder)),
        audit_table=f"{namespace}.audit_checks", run_log=f"{namespace}.pipeline_runs", project=PROJECT,
    )


def _audit_readback(spark: SparkSession, folder: str) -> DataFrame:
    namespace = _scratch_namespace(spark)
    _validate(spark, folder, namespace)
    return runs.read_audit(spark.table(f"{namespace}.audit_checks"))


def _run_log(spark: SparkSession, folder: str) -> DataFrame:
    """Two validation runs, two log rows."""
    namespace = _scratch_namespace(spark)
    _validate(spark, folder, namespace)
    _validate(spark, folder, namespace)
    logged = spark.table(f"{namespace}.pipeline_runs")
    return logged.select("run_type", "status", "checks_total", "checks_failed", "error_message")


def _audit_stamps(spark: SparkSession, folder: str) -> DataFrame:
    """How many different instants a stored audit carries, and rows without one."""
    namespace = _scratch_namespace(spark)
    _validate(spark, folder, namespace)
    audited = spark.table(f"{namespace}.audit_checks")
    return audited.agg(F.count_distinct("checked_at").alias("stamps"), F.count_if(F.col("checked_at").isNull()).alias("unstamped"))


def _run_log_success(spark: SparkSession, folder: str) -> DataFrame:
    """The log row of a run over the checks that pass."""
    namespace = _scratch_namespace(spark)
    _validate(spark, folder, namespace, lambda: _faulty_audit(spark, folder).where("status = 'PASS'"))
    return spark.table(f"{namespace}.pipeline_runs").select("status", "checks_total", "checks_failed", "error_message")


def _broken_run(spark: SparkSession, folder: str) -> runs.RunOutcome:
    """A run that breaks with a long message about the orders it saw."""

    def build() -> DataFrame:
        raise RuntimeError(f"audit stopped after {star.read_tables(spark, folder)['orders'].count()} orders; " * 40)

    return _validate(spark, folder, _scratch_namespace(spark), build)


def _run_error_log(spark: SparkSession, folder: str) -> DataFrame:
    return _broken_run(spark, folder).record.select("status", "checks_total", "checks_failed", "error_message")


def _run_error_failures(spark: SparkSession, folder: str) -> DataFrame:
    return _broken_run(spark, folder).payload.select("status", "total", "failed", "passed", F.inline("failures")).drop("status")


def _gate_writes(spark: SparkSession, folder: str) -> DataFrame:
    """Does the gate let the clean and the faulty tables be written, and how many were?"""
    clean = hiring.stored_tables(spark, folder)
    rows = []
    for case, frames in (("clean", clean), ("faulty", recruiting.inject_faults(clean))):
        written = recruiting.write_if_sound(frames, _scratch_namespace(spark))
        rows.append(spark.range(1).select(
            F.lit(case).alias("case"), F.lit(written > 0).alias("passed"), F.lit(written).cast("bigint").alias("tables_written")
        ))
    return reduce(DataFrame.unionByName, rows)


def _payload(spark: SparkSession, folder: str) -> DataFrame:
    return _validate(spark, folder, _scratch_namespace(spark)).payload


def _run_summary(spark: SparkSession, folder: str) -> DataFrame:
    """The summary after a trip through its JSON text."""
    body = runs.payload_json(_payload(spark, folder))
    return body.select(F.from_json("body", PAYLOAD).alias("p")).select("p.status", "p.total", "p.failed", "p.passed")


def _run_failures(spark: SparkSession, folder: str) -> DataFrame:
    return _payload(spark, folder).select(F.inline("failures"))


def _alert_stream(spark: SparkSession, folder: str) -> DataFrame:
    """A summary published twice, before and after the stream has read it: one alert."""
    published, sent, progress = (fresh_folder(spark, kind) for kind in ("summaries", "alerts", "progress"))
    payload = _payload(spark, folder)
    for _ in range(2):
        alerts.publish_summary(payload, published)
        alerts.start_alerts(alerts.summary_stream(spark, published), sent, progress).awaitTermination()
    return spark.read.parquet(sent).select("message")


def queries() -> dict[str, Query]:
    star_reports = {
        "star_days_to_ship_by_priority": star.days_to_ship_by_priority,
        "star_finish_rate_by_month": star.finish_rate_by_month,
        "star_event_funnel": star.event_funnel,
        "star_purchase_rate_by_segment": star.purchase_rate_by_segment,
        "star_cost_per_purchase_by_segment": star.cost_per_purchase_by_segment,
        "star_monthly_order_value": star.monthly_order_value,
        "star_orders_by_status": star.orders_by_status,
        "star_finish_ratio": star.finish_ratio,
        "star_audit_checks": lambda t: audit.audit_fused(star.CHECKS, t),
        "star_audit_by_branch": lambda t: audit.audit_by_branch(star.CHECKS, t),
        "star_audit_overview": lambda t: runs.audit_overview(audit.audit_fused(star.CHECKS, t)),
        "star_failing_checks": lambda t: runs.failing_checks(audit.audit_fused(star.CHECKS, t)),
        "recent_runs": lambda t: runs.recent_runs(star.run_log_from_events(t)),
        "problem_rate_by_day": lambda t: runs.problem_rate_by_day(star.run_log_from_events(t)),
        "first_seen_users": star.first_seen_users,
        "rarest_customer": lambda t: metrics.rarest_value(t["orders"], "o_custkey"),
        "scalar_functions": _scalar_functions,
        "orphan_documents": _orphan_documents,
        "labelled_documents": _labelled_documents,
        "customers_without_orders": _customers_without_orders,
        **{
            f"check_{c.check_name}": lambda t, c=c: audit.audit_by_branch([c], t)
            for c in [*star.CHECKS, star.LINE_PARTS, star.RATED_CUSTOMERS]
        },
    }
    hiring_reports = {
        "time_to_fill_by_department": lambda t: recruiting.time_to_fill_by_department(t["vacancies"]),
        "fill_rate_by_open_month": lambda t: recruiting.fill_rate_by_open_month(t["vacancies"]),
        "hiring_funnel": lambda t: recruiting.hiring_funnel(t["applications"]),
        "hire_rate_by_channel": lambda t: recruiting.hire_rate_by_channel(t["applications"], t["candidates"]),
        "cost_per_hire_by_channel": lambda t: recruiting.cost_per_hire_by_channel(
            t["applications"], t["candidates"], t["marketing_daily"]
        ),
        "monthly_revenue": lambda t: recruiting.monthly_revenue(t["placements"]),
        "deals_by_stage": lambda t: recruiting.deals_by_stage(t["sales_deals"]),
        "win_rate": lambda t: recruiting.win_rate(t["sales_deals"]),
        "audit_checks": recruiting.audit_checks,
        "failing_checks": lambda t: runs.failing_checks(recruiting.audit_checks(t)),
        "integrity_gate_checks": lambda t: audit.audit_fused(recruiting.GATE, t),
        "key_conditions": _key_conditions,
        "fault_audit_checks": lambda t: recruiting.audit_checks(recruiting.inject_faults(t)),
        "fault_report": lambda t: recruiting.injected_report(t, recruiting.inject_faults(t)),
        "fault_clients": lambda t: recruiting.inject_faults(t)["clients"],
        "fault_placements": lambda t: recruiting.inject_faults(t)["placements"],
        "fault_vacancies": lambda t: recruiting.inject_faults(t)["vacancies"],
        "fault_marketing": lambda t: recruiting.inject_faults(t)["marketing_daily"],
        "fault_deals": lambda t: recruiting.inject_faults(t)["sales_deals"],
        "fault_orphaned_vacancies": lambda t: recruiting.orphaned_vacancies(
            {**t, "clients": recruiting.inject_faults(t)["clients"]}
        ),
        **{f"hiring_{name}": lambda t, name=name: t[name] for name in recruiting.TABLES},
    }
    return {
        **{name: _on_star(build) for name, build in star_reports.items()},
        **{name: _on_hiring(build) for name, build in hiring_reports.items()},
        "csv_load_report": _csv_load_report,
        "csv_loaded_vacancies": _csv_loaded("vacancies"),
        "csv_loaded_sales_deals": _csv_loaded("sales_deals"),
        "csv_loaded_marketing_daily": _csv_loaded("marketing_daily"),
        "csv_loaded_documents": _csv_loaded_documents,
        "csv_inferred_orders": _csv_inferred_orders,
        "csv_load_stamps": _load_stamps,
        "table_replaced": _table_replaced,
        "table_kept_when_replacing_fails": _table_kept,
        "table_replaced_by_month": _table_replaced_by_month,
        "run_log_appended_once": _run_log_appended_once,
        "monthly_revenue_kept": _monthly_revenue_kept,
        "ids_on_growth": _ids_on_growth,
        "recent_runs_by_day": _recent_runs_by_day,
        "audit_from_counters": _audit_from_counters,
        "audit_stamps": _audit_stamps,
        "run_log_success": _run_log_success,
        "run_error_log": _run_error_log,
        "run_error_failures": _run_error_failures,
        "run_error_alert": lambda spark, folder: runs.alert_message(_broken_run(spark, folder).payload).select("message"),
        "gate_writes": _gate_writes,
        "audit_readback": _audit_readback,
        "run_log": _run_log,
        "run_summary": _run_summary,
        "run_failures": _run_failures,
        "run_console_lines": lambda spark, folder: runs.console_lines(_payload(spark, folder)),
        "run_alert": lambda spark, folder: runs.alert_message(_payload(spark, folder)).select("message"),
        "alert_stream": _alert_stream,
        **({**corpus.queries(), "pipeline": corpus_pipeline.run} if corpus else {}),
    }


def oracle_sql() -> dict[str, str]:
    return {
        **star_sql.REPORTS,
        **star_sql.SINGLE_CHECKS,
        **hiring_sql.REPORTS,
        **operator_sql.queries(PROJECT),
        **(corpus.oracle_sql() if corpus else {}),
        **({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus and corpus_pipeline.ORACLE_SQL else {}),
    }
