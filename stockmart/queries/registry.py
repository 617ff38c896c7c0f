"""One query per operator, each over the whole generated tables.

Results are brought to plain wire types (long, double, text, boolean) for comparison; the library
functions underneath return decimals, dates and timestamps.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockmart.functions.measures import STOCK_MEASURES, stock_level_sums, value_buckets
from stockmart.functions.period import Period
from stockmart.functions import scalar
from stockmart.functions.scalar import moment
from stockmart.functions.status import StatusColumns, movement_type
from stockmart.operators import archive, asof, dims, merge, quality, stockout
from stockmart.operators.text_agg import sorted_list
from stockmart.params import EnumSet, NaParams
from stockmart.plans import (
    enrich,
    inventory_value,
    jobs,
    sales_cost,
    settlement,
    stock_level,
    summary,
)
from stockmart.plans.balances import Balances
from stockmart.schemas import BALANCE_MONTH, LEVELS, SUMMARY_KEYS
from stockmart.session import session_dir
from stockmart.sources.facts import MONTH, history
from stockmart.sources.star_views import star_tables
from stockmart.sources.tables import TableSet, incremental
from stockmart.steps import Steps, write
from stockmart.streaming import incremental as streaming

PERIOD = Period(1998, 6)
NOW = dt.datetime(2001, 8, 15)
WAREHOUSE_KEYS = ("company_key", "warehouse_key")
_loaded: set[str] = set()


def wire(df: DataFrame) -> DataFrame:
    def plain(field: T.StructField):
        column = F.col(field.name)
        if isinstance(field.dataType, (T.DecimalType, T.FloatType)):
            return column.cast("double").alias(field.name)
        if isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            return column.cast("bigint").alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return F.date_format(column, "yyyy-MM-dd").alias(field.name)
        if isinstance(field.dataType, (T.TimestampNTZType, T.TimestampType)):
            return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(field.name)
        return column

    return df.select(*[plain(f) for f in df.schema.fields])


class Context:
    """Tables, parameters and enums of one run."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.tables: TableSet = star_tables(spark, sf_dir)
        self.params: NaParams = self.tables.na_params()
        self.enums: EnumSet = self.tables.enums(*enrich.ENUM_NAMES)
        self.status = StatusColumns(self.enums)

    def steps(self) -> Steps:
        """A chain of steps below the session's folder; the last one lives as long as the session."""
        return Steps(f"{session_dir(self.spark)}/steps-{uuid.uuid4().hex}")

    def transactions(self, **options) -> DataFrame:
        return enrich.stock_transactions(self.tables, self.enums, **options)

    def stock_fact(self) -> DataFrame:
        """The stored stock level fact, loaded by the first query of a session that reads it.

        As-of, summary and validation queries read the fact several times; they run on the stored
        table like reports do, and not on several copies of the load.
        """
        name = hashlib.md5(self.sf_dir.encode()).hexdigest()[:12]
        fact = jobs.stock_level_table(self.spark, f"{session_dir(self.spark)}/{name}/stock_level")
        if fact.path not in _loaded:
            with fact.steps() as step:
                fact.replace(stock_level.build(self.tables, self.params, self.enums, step=step))
            _loaded.add(fact.path)
        return fact.read()

    def history_summary(self, **options) -> DataFrame:
        stored = {"step": self.steps()} | options
        return summary.build_history(
            self.stock_fact(), self.tables, self.params, NOW, month_column=MONTH, **stored
        )


Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Callable[[Context], DataFrame]) -> Callable[[Context], DataFrame]:
    QUERIES[build.__name__] = lambda spark, sf_dir: wire(build(Context(spark, sf_dir)))
    return build


# Transactions: gates, classification, postings -------------------------------------------------


@query
def movement_totals(c: Context) -> DataFrame:
    rows = stock_level.classify(c.transactions(keep_null_category=True, postings=False), c.enums)
    keyed = dims.resolve_keys(
        rows, c.tables, [dims.INVENTORY_DIMENSION, dims.WAREHOUSE_OR_NULL], c.params
    )
    month = F.date_format(F.trunc("date_physical", "month"), "yyyy-MM").alias("month")
    sums = stock_level_sums(c.status, F.col("qty"))
    return keyed.groupBy("company_code", "warehouse_key", month, "movement_type").agg(
        F.count(F.lit(1)).alias("transactions"), *[s.alias(n) for n, s in sums.items()]
    )


@query
def transaction_type_counts(c: Context) -> DataFrame:
    rows = stock_level.classify(c.transactions(keep_null_category=True, postings=False), c.enums)
    return rows.groupBy("transaction_type", "movement_type").agg(
        F.count(F.lit(1)).alias("transactions"), F.sum("qty").alias("quantity")
    )


@query
def transaction_status_labels(c: Context) -> DataFrame:
    rows = stock_level.classify(
        enrich.with_origin(c.tables["invent_trans"], c.tables["invent_trans_origin"]), c.enums
    )
    return rows.groupBy("transaction_status", "status_issue", "status_receipt").agg(
        F.count(F.lit(1)).alias("transactions")
    )


def _by_category(c: Context, keep_null: bool) -> DataFrame:
    rows = c.transactions(keep_null_category=keep_null, postings=False)
    return rows.groupBy("reference_category").agg(
        F.count(F.lit(1)).alias("transactions"), F.sum("qty").alias("quantity")
    )


@query
def category_null_dropped(c: Context) -> DataFrame:
    return _by_category(c, keep_null=False)


@query
def category_null_kept(c: Context) -> DataFrame:
    return _by_category(c, keep_null=True)


@query
def incremental_batch(c: Context) -> DataFrame:
    """A full load, one batch of an incremental load, and an incremental load without batch id."""
    trans = c.tables["invent_trans"]
    loads = {
        "full": incremental(trans, "B3", enabled=False),
        "batch": incremental(trans, "B3", enabled=True),
        "batch without id": incremental(trans, None, enabled=True),
        "batch without id, all": incremental(trans, None, enabled=True, null_id_means_all=True),
    }
    out = None
    for name, rows in loads.items():
        part = rows.agg(
            F.lit(name).alias("load"), F.count(F.lit(1)).alias("transactions"),
            F.countDistinct("execution_id").alias("batches"), F.sum("qty").alias("quantity"),
        )
        out = part if out is None else out.unionByName(part)
    return out


@query
def postings_by_role(c: Context) -> DataFrame:
    rows = inventory_value.with_posting_choice(c.transactions())
    return rows.select(
        F.col("rec_id").alias("record_id"), "posting_type",
        F.col("chosen_cost").alias("cost_amount"), "voucher_number", "default_dimension_id",
        "voucher_number_physical", "voucher_number_financial",
    )


@query
def star_keys_unknown_member(c: Context) -> DataFrame:
    trans = c.tables["invent_trans"].withColumn("company_code", F.col("data_area_id"))
    keyed = dims.resolve_keys(
        trans, c.tables,
        [dims.COMPANY, dims.PRODUCT, dims.CURRENCY, dims.INVENTORY_DIMENSION,
         dims.PRODUCT_INVENTORY, dims.PRODUCT_VARIANT, dims.WAREHOUSE_OR_NULL, dims.LOAD,
         dims.transaction_date(c.params, "date_physical")],
        c.params, ["rec_id"], c.steps(),
    )
    return keyed.select(
        F.col("rec_id").alias("record_id"), "company_key", "product_key", "currency_key",
        "inventory_dimension_key", "product_inventory_key", "product_variant_key",
        "warehouse_key", "load_key", "transaction_date",
    )


@query
def dimension_key_check(c: Context) -> DataFrame:
    """Fact keys checked back against their dimensions, per product and size."""
    fact = c.stock_fact().select(*summary.FACT_KEYS)
    checked = summary.confirm_keys(fact, c.tables, c.steps())
    return checked.groupBy("company_key", "product_key", "inventory_size_key").agg(
        F.count(F.lit(1)).alias("transactions"),
        F.count("warehouse_key").alias("with_warehouse"),
        F.count("product_inventory_key").alias("with_product_inventory"),
        F.count("inventory_dimension_key").alias("with_dimension"),
    )


@query
def value_buckets_by_status(c: Context) -> DataFrame:
    buckets = value_buckets(c.status, F.col("qty"), F.col("cost_amount_posted"))
    rows = c.tables["invent_trans"].withColumn("movement_type", movement_type(c.status))
    return rows.groupBy("data_area_id", "movement_type").agg(
        *[F.sum(b).alias(n) for n, b in buckets.items()]
    )


# Facts -----------------------------------------------------------------------------------------


@query
def stock_level_fact(c: Context) -> DataFrame:
    return stock_level.build(c.tables, c.params, c.enums, step=c.steps())


@query
def inventory_value_fact(c: Context) -> DataFrame:
    return inventory_value.build(c.tables, c.params, c.enums, step=c.steps())


@query
def settlement_fact(c: Context) -> DataFrame:
    return settlement.build(c.tables, c.params, c.enums, step=c.steps())


# Upserts and deletes ---------------------------------------------------------------------------


@query
def orphan_delete(c: Context) -> DataFrame:
    """Facts of all lines against a source that lost some lines and the company of others."""
    trans = c.tables["invent_trans"]
    fact = trans.select(
        F.col("rec_id").alias("record_id"),
        F.when(F.col("currency_code") == "CUR0", F.lit(0)).otherwise(F.col("rec_id"))
        .alias("stock_level_key"), "qty",
    )
    source = trans.filter(F.col("data_lake_modified").isNotNull()).select(
        "rec_id",
        F.when(F.col("packing_slip_returned") == 0, F.col("data_area_id")).alias("data_area_id"),
    )
    return merge.delete_orphans(fact, source, "record_id", "stock_level_key")


COMPARED = ("qty", "status_issue", "status_receipt", "invoice_id")


def _merge_sides(c: Context) -> tuple[DataFrame, DataFrame]:
    """A fact loaded up to 1999 in which returns had not been booked, and all lines since 1997."""
    rows = c.tables["invent_trans"].select("rec_id", "date_physical", *COMPARED, "invoice_returned")
    returned = F.col("invoice_returned") == 1
    target = rows.filter(F.col("date_physical") < moment(dt.datetime(2000, 1, 1))).withColumns({
        "qty": F.when(returned, F.lit(0)).otherwise(F.col("qty")).cast("decimal(18,4)"),
        "loads": F.lit(1),
    })
    source = rows.filter(F.col("date_physical") >= moment(dt.datetime(1997, 1, 1)))
    columns = ["rec_id", *COMPARED]
    return target.select(*columns, "loads"), source.select(*columns)


@query
def upsert_changed_only(c: Context) -> DataFrame:
    target, source = _merge_sides(c)
    out = merge.upsert(target, source, ["rec_id"], compare=COMPARED,
                       on_update={"loads": F.lit(2)}, on_insert={"loads": F.lit(1)})
    return out.withColumnRenamed(merge.ACTION, "action")


@query
def upsert_always(c: Context) -> DataFrame:
    target, source = _merge_sides(c)
    out = merge.upsert(target, source, ["rec_id"],
                       on_update={"loads": F.lit(2)}, on_insert={"loads": F.lit(1)})
    return out.withColumnRenamed(merge.ACTION, "action")


@query
def upsert_row_counts(c: Context) -> DataFrame:
    target, source = _merge_sides(c)
    merged = merge.upsert(target, source, ["rec_id"], compare=COMPARED)
    return merge.action_counts(merged).withColumnRenamed(merge.ACTION, "action")


@query
def update_only(c: Context) -> DataFrame:
    source = c.tables["sales_line"].select(
        F.col("data_area_id").alias("company_code"),
        F.col("invent_trans_id").alias("inventory_transaction_id"), "cost_price",
    )
    out = merge.update_only(
        c.tables["fact_sales_orders"], source, ["company_code", "inventory_transaction_id"],
        compare=["cost_price"], on_update={"ea_is_deleted": F.lit(False)},
    )
    return out.select("company_code", "inventory_transaction_id", "cost_price",
                      "gross_margin_amount", "ea_is_deleted",
                      F.col(merge.ACTION).alias("action"))


@query
def duplicate_merge_keys(c: Context) -> DataFrame:
    keys = ["invent_trans_origin", "status_issue", "status_receipt", "invoice_id"]
    return merge.duplicate_keys(c.tables["invent_trans"], keys)


# As-of, running and validity -------------------------------------------------------------------


def _asof(c: Context, find: Callable[..., DataFrame], bound: dt.date, ties: str) -> DataFrame:
    fact = c.stock_fact()
    base = fact.filter(PERIOD.contains(F.col("transaction_date"))).select(*WAREHOUSE_KEYS).distinct()
    return find(base, fact, WAREHOUSE_KEYS, "transaction_date", STOCK_MEASURES, bound, ties=ties)


@query
def asof_before_ties_all(c: Context) -> DataFrame:
    return _asof(c, asof.latest_before, PERIOD.start, "all")


@query
def asof_before_ties_sum(c: Context) -> DataFrame:
    return _asof(c, asof.latest_before, PERIOD.start, "sum")


@query
def asof_on_or_before(c: Context) -> DataFrame:
    return _asof(c, asof.latest_on_or_before, PERIOD.end, "all")


@query
def running_level(c: Context) -> DataFrame:
    return asof.running_level(c.stock_fact(), WAREHOUSE_KEYS, "transaction_date", STOCK_MEASURES)


@query
def price_validity(c: Context) -> DataFrame:
    return sales_cost.price_intervals(
        c.tables["invent_item_price"], c.tables["invent_dim"]
    ).drop("data_lake_modified")


@query
def price_at_order(c: Context) -> DataFrame:
    prices = sales_cost.price_intervals(c.tables["invent_item_price"], c.tables["invent_dim"])
    sites = c.tables["invent_dim"]
    lines = c.tables["sales_line"].join(sites, ["invent_dim_id", "data_area_id"], "left")
    on = {"item_id": "item_id", "invent_site_id": "invent_site_id",
          "data_area_id": "data_area_id"}
    carry = {"half_open_price": "price", "expiry_date": "expiry_date"}
    df = asof.valid_at(lines, prices, on, "created_datetime", carry, half_open=True)
    # A closed interval ends a day earlier, and it is part of the half-open one.
    in_closed = F.col("created_datetime") <= F.col("expiry_date")
    df = df.withColumn("closed_price", F.when(in_closed, F.col("half_open_price")))
    return df.select("invent_trans_id", "data_area_id", "item_id", "created_datetime",
                     "closed_price", "half_open_price")


@query
def sales_cost_refresh(c: Context) -> DataFrame:
    costs = sales_cost.build(c.tables, c.enums, step=c.steps())
    out = sales_cost.refresh(c.tables["fact_sales_orders"], costs, moment(NOW))
    return out.withColumnRenamed(merge.ACTION, "action")


# Monthly summary -------------------------------------------------------------------------------


@query
def monthly_movements(c: Context) -> DataFrame:
    fact = c.stock_fact().withColumns({
        "month": F.date_format(F.trunc("transaction_date", "month"), "yyyy-MM"),
        "warehouse_key": F.coalesce("warehouse_key", c.params.key()),
    })
    return summary.movements(fact, ("company_key", "warehouse_key", "month"), types="distinct")


@query
def transaction_type_list(c: Context) -> DataFrame:
    fact = c.stock_fact().withColumn(
        "month", F.date_format(F.trunc("transaction_date", "month"), "yyyy-MM")
    )
    return sorted_list(fact, ["company_key", "warehouse_key", "month"], "transaction_type",
                       "transaction_types")


@query
def transaction_type_list_repeated(c: Context) -> DataFrame:
    """The list with a label per row, as the one-month definition has it, at the summary's grain."""
    fact = c.stock_fact().withColumn(
        "month", F.date_format(F.trunc("transaction_date", "month"), "yyyy-MM")
    )
    return sorted_list(fact, [*summary.FACT_KEYS, "month"], "transaction_type",
                       "transaction_types", form="all")


def _without_audit(df: DataFrame) -> DataFrame:
    return df.drop("ea_process_datetime", "ea_last_update_datetime")


@query
def monthly_summary(c: Context) -> DataFrame:
    return _without_audit(c.history_summary())


@query
def monthly_summary_running(c: Context) -> DataFrame:
    return _without_audit(c.history_summary(level="running", types="distinct"))


@query
def monthly_summary_period(c: Context) -> DataFrame:
    return _without_audit(
        summary.build(c.stock_fact(), c.tables, c.params, PERIOD, NOW, ties="all",
                      month_column=MONTH)
    )


@query
def monthly_summary_stockouts(c: Context) -> DataFrame:
    """All months with stockout days up to the run date and product counts."""
    return _without_audit(c.history_summary(health_until=NOW.date()))


@query
def stockout_days(c: Context) -> DataFrame:
    """Days without stock of the products of every warehouse in every month up to the run date."""
    keys = ("company_key", "product_key", "warehouse_key")
    balances = asof.running_level(
        c.stock_fact(), keys, "transaction_date", ["physical_stock_quantity"]
    )
    found = stockout.spells(balances, keys, "transaction_date", "physical_stock_quantity",
                            NOW.date(), c.params.na_datetime.date())
    return stockout.by_month(found, keys).groupBy(*WAREHOUSE_KEYS, "month").agg(
        F.count(F.lit(1)).alias("products_out"),
        *[F.sum(n).alias(n) for n in ("stockout_days", "stockout_spells")],
    )


@query
def summary_job_stockouts(c: Context) -> DataFrame:
    """Stockout days and product counts of two stored months, built from balances."""
    stored = _stored_summary(c, health_until=NOW.date()).rows()
    return stored.select("year", "month", *summary.KEYS, *summary.HEALTH)


def _tables_of(c: Context, name: str, *makers):
    """New stored tables below the session's folder for a query that runs loads."""
    root = f"{session_dir(c.spark)}/{name}-{uuid.uuid4().hex}"
    made = [make(c.spark, f"{root}/{i}") for i, make in enumerate(makers)]
    for table in made:
        table.create()
    return made


@query
def monthly_summary_after_archive(c: Context) -> DataFrame:
    """All months once the detail older than half a year has moved to the archive."""
    fact, cold = _tables_of(c, "archived", jobs.stock_level_table, jobs.stock_level_table)
    fact.replace(c.stock_fact().drop(MONTH))
    jobs.archive_detail(fact, cold, NOW.date(), c.params)
    rows = fact.read().unionByName(cold.read())
    return _without_audit(
        summary.build_history(rows, c.tables, c.params, NOW, month_column=MONTH)
    )


def _stored_summary(c: Context, **options):
    """June and July 1998 in a stored summary, from balances; June is built twice."""
    target, held = _tables_of(c, "summary", jobs.summary_table, Balances)
    name = hashlib.md5(c.sf_dir.encode()).hexdigest()[:12]
    rows = c.stock_fact()
    fact = jobs.stock_level_table(c.spark, f"{session_dir(c.spark)}/{name}/stock_level")
    held.rebuild(rows, c.tables, c.params)
    for period in (PERIOD, Period(1998, 7), PERIOD):
        jobs.build_monthly_summary(c.tables, c.params, fact, target, period, NOW, balances=held,
                                   **options)
    return target


@query
def load_monthly_summary(c: Context) -> DataFrame:
    rows = _without_audit(_stored_summary(c).rows())
    return rows.withColumn("has_key", F.col("summary_key") > 0).drop("summary_key")


@query
def dq_negatives_period(c: Context) -> DataFrame:
    """A check of one month of the stored summary."""
    return quality.negatives(_stored_summary(c).rows(), PERIOD)


# Loads: all rows with other values first, then as they are, but for some that count as gone.


def _other_values(rows: DataFrame, measure: str) -> DataFrame:
    return rows.withColumn(measure, (F.col(measure) + 1).cast(rows.schema[measure].dataType))


def _gone(rows: DataFrame) -> DataFrame:
    """Every seventh record without a company, and without a status where it has one."""
    lost = F.col("rec_id") % 7 == 0
    blank = {"data_area_id": F.lit(None), "status_issue": F.lit(0), "status_receipt": F.lit(0)}
    return rows.withColumns({
        name: F.when(lost, value.cast(rows.schema[name].dataType)).otherwise(F.col(name))
        for name, value in blank.items() if name in rows.columns
    })


def _load_twice(c: Context, make, load, source: str, measure: str, key: str) -> DataFrame:
    (fact,) = _tables_of(c, "load", make)
    rows = c.tables[source]
    for state in (_other_values(rows, measure), _gone(rows)):
        load(c.tables.replacing(**{source: state}), fact, NOW)
    return _with_key(fact.rows(), key)


def _with_key(rows: DataFrame, key: str) -> DataFrame:
    rows = rows.withColumn("has_key", F.col(key) > 0)
    return rows.drop(key, "ea_process_datetime", "ea_is_deleted")


@query
def stream_over_archive(c: Context) -> DataFrame:
    """Detail and archive after a load, a move to the archive, a second load without some records,
    and a stream that brings all records."""
    fact, cold = _tables_of(c, "stream", jobs.stock_level_table, jobs.stock_level_table)
    rows = c.tables["invent_trans"]
    first = c.tables.replacing(invent_trans=_other_values(rows, "qty"))
    jobs.load_stock_levels(first, fact, NOW, archive=cold)
    jobs.archive_detail(fact, cold, NOW.date(), c.params)
    second = c.tables.replacing(invent_trans=_gone(rows))
    jobs.load_stock_levels(second, fact, NOW, archive=cold)
    landing = f"{session_dir(c.spark)}/landing-{uuid.uuid4().hex}"
    write(rows.repartition(2), f"{landing}/in")
    stream = c.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{landing}/in")
    running = streaming.start(stream, c.tables, fact, f"{landing}/state", clock=lambda: NOW, archive=cold)
    running.awaitTermination()
    return _with_key(history(fact, cold).select(*fact.schema.names), "stock_level_key")


@query
def monthly_balances(c: Context) -> DataFrame:
    """Balances of all months, kept up to date by a load and by one that corrects all its rows."""
    fact, held = _tables_of(c, "balances", jobs.stock_level_table, Balances)
    rows = c.tables["invent_trans"]
    for state in (_other_values(rows, "qty"), rows):
        jobs.load_stock_levels(c.tables.replacing(invent_trans=state), fact, NOW, balances=held)
    return held.closes.rows().groupBy(BALANCE_MONTH).agg(
        F.count(F.lit(1)).alias("keys"),
        *[F.sum(m).alias(m) for p in ("", "total_") for m in (f"{p}{x}" for x in LEVELS)],
    )


@query
def load_stock_levels(c: Context) -> DataFrame:
    return _load_twice(c, jobs.stock_level_table, jobs.load_stock_levels, "invent_trans", "qty",
                   "stock_level_key")


@query
def load_inventory_value(c: Context) -> DataFrame:
    return _load_twice(c, jobs.inventory_value_table, jobs.load_inventory_value, "invent_trans", "qty",
                   "inventory_value_key")


@query
def load_settlements(c: Context) -> DataFrame:
    return _load_twice(c, jobs.settlement_table, jobs.load_settlements, "invent_settlement",
                   "cost_amount_adjustment", "inventory_settlement_key")


@query
def period_labels(c: Context) -> DataFrame:
    """Label and run tag of every month of the summary."""
    # The distinct months need no movements, so nothing is stored for them.
    months = c.history_summary(step=None).select("year", "month", "period_end_date").distinct()
    return months.select(
        "year", "month", scalar.period_label(F.col("year"), F.col("month")).alias("period"),
        scalar.run_label(F.col("period_end_date").cast("timestamp_ntz")).alias("run"),
    )


@query
def kpi_dio(c: Context) -> DataFrame:
    return c.history_summary().select(
        *quality.GRAIN, "eom_physical_stock_quantity", "total_outbound_quantity",
        "days_inventory_outstanding",
    )


@query
def kpi_turnover(c: Context) -> DataFrame:
    return c.history_summary().select(
        *quality.GRAIN, "average_physical_stock_quantity", "total_outbound_quantity",
        "stock_turnover_ratio",
    )


@query
def retention_split(c: Context) -> DataFrame:
    """Detail and archive volume per month at the run date."""
    detail, old = archive.split_by_age(
        c.stock_fact(), "transaction_date", NOW.date(), c.params.na_datetime.date()
    )
    both = detail.withColumn("tier", F.lit("detail")).unionByName(
        old.withColumn("tier", F.lit("archive"))
    )
    month = F.date_format(F.trunc("transaction_date", "month"), "yyyy-MM").alias("month")
    return both.groupBy("tier", month).agg(F.count(F.lit(1)).alias("rows"))


# Validation of the monthly summary -------------------------------------------------------------


@query
def dq_completeness(c: Context) -> DataFrame:
    return quality.completeness(c.history_summary())


@query
def dq_balance(c: Context) -> DataFrame:
    return quality.balance(c.history_summary())


@query
def dq_dio_top20(c: Context) -> DataFrame:
    return quality.dio(c.history_summary())


@query
def dq_dio_order(c: Context) -> DataFrame:
    """The report's rows with the places they come out at; its limit leaves one partition."""
    place = (F.monotonically_increasing_id() + 1).alias("place")
    return quality.dio(c.history_summary()).select(place, *quality.GRAIN)


@query
def dq_turnover_top20(c: Context) -> DataFrame:
    return quality.turnover(c.history_summary())


@query
def dq_average(c: Context) -> DataFrame:
    return quality.average(c.history_summary())


@query
def dq_counts(c: Context) -> DataFrame:
    return quality.counts(c.history_summary())


@query
def dq_nulls(c: Context) -> DataFrame:
    return quality.nulls(c.history_summary())


@query
def dq_negatives(c: Context) -> DataFrame:
    return quality.negatives(c.history_summary())


@query
def dq_period_dates(c: Context) -> DataFrame:
    return quality.period_dates(c.history_summary())


@query
def dq_run_summary(c: Context) -> DataFrame:
    return quality.run_summary(c.history_summary())


@query
def run_outcomes(c: Context) -> DataFrame:
    """Reports of a summary run that works and of a merge whose source repeats its keys."""
    (target,) = _tables_of(c, "outcomes", jobs.summary_table)
    rows = c.history_summary(first=PERIOD, last=PERIOD)
    repeated = ["invent_trans_origin", "status_issue", "status_receipt", "invoice_id"]
    trans = c.tables["invent_trans"]
    runs = {
        "summary": lambda: target.merge(rows, list(SUMMARY_KEYS)).rows,
        "repeated keys": lambda: merge.assert_unique(trans, repeated),
    }
    found = [(name, quality.attempt(job)) for name, job in runs.items()]
    return c.spark.createDataFrame(
        [(name, run.ok, run.rows, run.error is not None and "not unique" in run.error)
         for name, run in found],
        "job string, worked boolean, rows long, repeated_keys boolean",
    )


# The same checks on a summary with defects in every month.


def _seeded(c: Context) -> DataFrame:
    summary_rows = c.history_summary()
    for i, name in enumerate(("days_inventory_outstanding", "stock_turnover_ratio",
                              "average_physical_stock_quantity")):
        wrong = F.col("product_key") % 5 == i
        summary_rows = summary_rows.withColumn(
            name, F.when(wrong, F.col(name) + 1).otherwise(F.col(name))
        )
    return summary_rows


@query
def dq_dio_seeded(c: Context) -> DataFrame:
    return quality.dio(_seeded(c))


@query
def dq_turnover_seeded(c: Context) -> DataFrame:
    return quality.turnover(_seeded(c))


@query
def dq_average_seeded(c: Context) -> DataFrame:
    return quality.average(_seeded(c))
