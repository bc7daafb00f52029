"""Run-log views and dashboard datasets.

The run log holds one row per progress event: ``event_id, timestamp,
event_type, origin{pipeline_name, flow_name}, message, details`` with
``details`` a JSON string. It is parsed once with ``from_json`` into a struct
and read by field access, instead of re-parsing the text per path (§4).

The latest event per (flow, day) is a ``max_by`` aggregate ordered by
(timestamp, event_id): partial aggregation keeps it cheap even when one flow
writes most of the log, where a ``row_number`` window would send every event of
that flow and day to one task.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values (must equal the reference): event filters and JSON layout.
FLOW_PROGRESS = "flow_progress"
RUNNING = "RUNNING"
COMPLETED_PREFIX = "Completed %"
QUARANTINE_FLOW = "quarantine"
DETAILS_SCHEMA = (
    "struct<flow_progress: struct<status: string, "
    "metrics: struct<num_upserted_rows: bigint, num_output_rows: bigint, "
    "source_metrics: array<struct<source_name: string>>>, "
    "data_quality: struct<warned_records: bigint, "
    "expectations: array<struct<name: string, failed_records: int>>>>>"
)
# Dashboard selector defaults.
DEFAULT_LAYER = "bronze"
DEFAULT_EXPECTATION_TABLE = "silver.transactions"
DEFAULT_EXPECTATION_DATE = dt.date(2026, 5, 27)


def _progress(log: DataFrame, pipeline: str, catalog: str, silver_only: bool) -> DataFrame:
    flow = F.col("origin.flow_name")
    cond = ((F.col("event_type") == FLOW_PROGRESS)
            & (F.col("origin.pipeline_name") == pipeline)
            & (flow != f"{catalog}.silver.{QUARANTINE_FLOW}")
            & F.col("message").like(COMPLETED_PREFIX))
    if silver_only:
        cond = cond & flow.like(f"{catalog}.silver.%")
    d = F.from_json("details", DETAILS_SCHEMA)
    return (log.where(cond)
            .withColumn("_d", d)
            .where(F.col("_d.flow_progress.status") == RUNNING))


def latest_per_flow_day(log: DataFrame, pipeline: str, catalog: str, silver_only: bool = True) -> DataFrame:
    """Newest qualifying event per (flow, day) (E1), details already parsed."""
    p = _progress(log, pipeline, catalog, silver_only)
    day = F.col("timestamp").cast("date")
    payload = F.struct("event_id", "timestamp", F.col("origin.pipeline_name").alias("pipeline_name"),
                       "message", "details", "_d")
    order = F.struct("timestamp", "event_id")
    return (p.groupBy(F.col("origin.flow_name").alias("flow_name"), day.alias("processing_date"))
            .agg(F.max_by(payload, order).alias("_e"))
            .select("processing_date", "flow_name", "_e.*"))


def _summary_columns(latest: DataFrame, catalog: str) -> list[Column]:
    flow = F.col("flow_name")
    m = F.col("_d.flow_progress.metrics")
    first_source = F.get(m["source_metrics"], 0)["source_name"]
    return [
        "processing_date",
        "pipeline_name",
        F.rtrim(F.substring_index(first_source, "[", -1), F.lit("]")).alias("source_table"),
        F.get(F.split(flow, r"\.", 3), 1).alias("layer"),
        flow.alias("sink_table"),
        F.when(flow.like(f"{catalog}.silver.%"), m["num_upserted_rows"])
        .otherwise(m["num_output_rows"]).cast("int").alias("upserted_rows"),
        F.col("_d.flow_progress.data_quality.warned_records").cast("int").alias("rejected_rows"),
    ]


def run_log_latest(log: DataFrame, pipeline: str, catalog: str) -> DataFrame:
    """Newest qualifying event per silver flow and day (E1), with its status
    read straight from the JSON text."""
    return latest_per_flow_day(log, pipeline, catalog).select(
        "processing_date", "flow_name", "pipeline_name", "event_id", "timestamp", "message",
        F.get_json_object("details", "$.flow_progress.status").alias("status"))


def run_log_summary(log: DataFrame, pipeline: str, catalog: str) -> DataFrame:
    """Per silver flow and day: source, layer, sink, upserted and rejected rows."""
    latest = latest_per_flow_day(log, pipeline, catalog, silver_only=True)
    return latest.select(*_summary_columns(latest, catalog))


def run_log_rates(log: DataFrame, pipeline: str, catalog: str) -> DataFrame:
    """I1 over all layers plus rejected share in percent, decimal(5,2)."""
    latest = latest_per_flow_day(log, pipeline, catalog, silver_only=False)
    s = latest.select(*_summary_columns(latest, catalog))
    rate = (F.try_divide(F.col("rejected_rows"), F.col("upserted_rows") + F.col("rejected_rows")) * 100)
    return s.withColumn("rate_rejected", rate.cast("decimal(5,2)"))


def run_log_expectations(log: DataFrame, pipeline: str, catalog: str) -> DataFrame:
    """One row per silver flow, day and rule: failed records and their share of
    warned records as decimal(3,2) (I2, F4)."""
    latest = latest_per_flow_day(log, pipeline, catalog, silver_only=True)
    dq = F.col("_d.flow_progress.data_quality")
    rows = latest.select(
        "processing_date", "pipeline_name",
        F.get(F.split("flow_name", r"\.", 3), 1).alias("layer"),
        F.col("flow_name").alias("sink_table"),
        F.explode(dq["expectations"]).alias("e"),
        dq["warned_records"].cast("int").alias("total_rejected"),
    )
    failed = F.col("e.failed_records").cast("int")
    return rows.select(
        "processing_date", "pipeline_name", "layer", "sink_table",
        F.col("e.name").alias("expectation"),
        failed.alias("rejected_records"),
        F.try_divide(failed, F.col("total_rejected")).cast("decimal(3,2)").alias("rate_rejected"),
    )


def run_log_by_table(log: DataFrame, pipeline: str, catalog: str, table: str) -> DataFrame:
    """History of one silver table, newest day first."""
    return (run_log_summary(log, pipeline, catalog)
            .where(F.col("sink_table").like(f"%.silver.{table}"))
            .orderBy(F.col("processing_date").desc()))


# ----------------------------------------------------------- dashboard

def _filtered(ds: DataFrame, **equals) -> DataFrame:
    for col, value in equals.items():
        if value is not None:
            ds = ds.where(F.col(col) == F.lit(value))
    return ds


def dash_detail(rates: DataFrame, layer: str | None = DEFAULT_LAYER, date=None) -> DataFrame:
    """Unaggregated detail table."""
    return _filtered(rates, layer=layer, processing_date=date).select(
        "pipeline_name", "layer", "sink_table", "upserted_rows", "rejected_rows")


def dash_rate_by_table(rates: DataFrame, layer: str | None = None, date=None) -> DataFrame:
    """Sum of percent rates per sink table, as the bar chart shows it."""
    return (_filtered(rates, layer=layer, processing_date=date)
            .groupBy("sink_table").agg(F.sum("rate_rejected").alias("sum_rate_rejected")))


def dash_rejected_by_rule(expectations: DataFrame, sink_table: str | None = None, date=None) -> DataFrame:
    """Rejected records per rule."""
    return (_filtered(expectations, sink_table=sink_table, processing_date=date)
            .groupBy("expectation").agg(F.sum("rejected_records").alias("sum_rejected_records")))


def _by_month(expectations: DataFrame, agg: Column, sink_table, date) -> DataFrame:
    month = F.date_trunc("MONTH", F.col("processing_date")).cast("date")
    return (_filtered(expectations, sink_table=sink_table, processing_date=date)
            .groupBy(month.alias("month")).agg(agg)
            .orderBy(F.col("month").desc()))


def dash_max_rate_month(expectations: DataFrame, sink_table: str | None = None, date=None) -> DataFrame:
    """Largest rule share per month, newest first."""
    return _by_month(expectations, F.max("rate_rejected").alias("max_rate_rejected"), sink_table, date)


def dash_avg_rate_month(expectations: DataFrame, sink_table: str | None = None, date=None) -> DataFrame:
    """Mean rule share per month, newest first."""
    return _by_month(expectations, F.avg("rate_rejected").alias("avg_rate_rejected"), sink_table, date)


def dash_rejected_by_day(expectations: DataFrame, sink_table: str | None = None) -> DataFrame:
    """Rejected records per day."""
    return (_filtered(expectations, sink_table=sink_table)
            .groupBy("processing_date").agg(F.sum("rejected_records").alias("sum_rejected_records")))


def dash_filter_values(log: DataFrame, pipeline: str, catalog: str) -> DataFrame:
    """All five selector lists of the dashboard with their default selections
    (D11): each value with how many rows also match the other selectors.

    One scan: every latest event gives a row for the summary and one for each
    of its expectations (silver flows); one aggregate over grouping sets counts
    them by layer, day and table, and every list picks its counter.
    """
    table = f"{catalog}.{DEFAULT_EXPECTATION_TABLE}"
    latest = latest_per_flow_day(log, pipeline, catalog, silver_only=False)
    expected = F.when(F.col("flow_name").like(f"{catalog}.silver.%"), F.col("_d.flow_progress.data_quality.expectations"))
    kinds = F.concat(F.array(F.lit("summary")), F.coalesce(F.transform(expected, lambda _: F.lit("expectations")), F.expr("cast(array() as array<string>)")))
    rows = latest.select("processing_date", F.get(F.split("flow_name", r"\.", 3), 1).alias("layer"), F.col("flow_name").alias("sink_table"), F.explode(kinds).alias("kind"))
    sets = [["kind", c] for c in ("layer", "processing_date", "sink_table")]
    counted = rows.groupingSets([[F.col(c) for c in s] for s in sets], "kind", "layer", "processing_date", "sink_table").agg(
        *[F.grouping(c).alias(f"_no_{c}") for _, c in sets],
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("layer") == DEFAULT_LAYER).alias("of_layer"),
        F.count_if(F.col("processing_date") == F.lit(DEFAULT_EXPECTATION_DATE)).alias("of_date"), F.count_if(F.col("sink_table") == table).alias("of_table"))
    # list, what it counts, by which column, with which selection of the others
    lists = [("summary.layer", "summary", "layer", "rows"), ("summary.processing_date", "summary", "processing_date", "of_layer"),
             ("expectations.sink_table", "expectations", "sink_table", "of_date"), ("expectations.processing_date", "expectations", "processing_date", "of_table"),
             ("trend.sink_table", "expectations", "sink_table", "rows")]
    facets = F.array(*[F.when((F.col("kind") == kind) & (F.col(f"_no_{c}") == 0), F.struct(
        F.lit(name).alias("filter_name"), F.col(c).cast("string").alias("value"), F.col(n).alias("associativity"))) for name, kind, c, n in lists])
    return counted.select(F.explode(F.filter(facets, lambda x: x.isNotNull())).alias("f")).select("f.*")


def expectation_totals(log: DataFrame, pipeline: str) -> DataFrame:
    """Failed records per flow and rule summed over every progress event of
    the pipeline (what the per-batch expectation counters add up to)."""
    d = F.from_json("details", DETAILS_SCHEMA)
    e = (log.where((F.col("event_type") == FLOW_PROGRESS) & (F.col("origin.pipeline_name") == pipeline))
         .select(F.col("origin.flow_name").alias("flow_name"),
                 F.explode(d["flow_progress"]["data_quality"]["expectations"]).alias("e")))
    return (e.groupBy("flow_name", F.col("e.name").alias("expectation"))
            .agg(F.sum("e.failed_records").alias("failed_records")))
