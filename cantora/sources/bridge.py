"""Star schema over the driver's tables (the test-data bridge).

The reference's warehouse has five dimensions and four daily facts. The driver
ships TPC-H-like tables instead, so this module maps them, column for column, to
the reference's star schema:

==================  ==========================================================
date_id             ship date of the line item
product / brand     ``p_brand`` (the product dimension is at brand grain)
region / canton     customer nation, language region = the nation's region
channel             order priority (its leading digit is the key)
payer               supplier
units, gross        quantity, extended price as NUMERIC(14,2)
rebate, promo spend gross x discount, gross x tax (decimal arithmetic)
==================  ==========================================================

Every expression here has a twin in ``plans/oracle_sql.py`` so that DuckDB can
rebuild the same star for the correctness oracle.

Scale: the fact build is lineitem x orders x customer x part, all equi-joins on
keys. These sides grow with the data, so they are left to Catalyst + AQE
(sort-merge, or a broadcast only when the runtime size is under the threshold).
Dimensions that are small by construction (days of the calendar, brands,
nations, priorities) are broadcast by Spark where it measures them to be small.
Queries read the star as ``sources.warehouse`` publishes it.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cantora.functions.dates import week_start
from cantora.sources.store import month_of
from cantora.sources.tables import Tables

MONEY = "decimal(14,2)"


def gross_money(price: Column) -> Column:
    return price.cast(MONEY)


class Star:
    """Lazily-built star schema: ``Star(Tables(spark, dir)).fct_sales`` ..."""

    def __init__(self, tables: Tables, months: list[str] | None = None):
        self.t = tables
        self.spark = tables.spark
        self.months = months     # None: all; else the facts hold these months only

    # ------------------------------------------------------------------ base
    @cached_property
    def sales_lines(self) -> DataFrame:
        """One row per line item with the keys and measures of all facts."""
        li = self.t.lineitem.select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
            "l_extendedprice", "l_discount", "l_tax", "l_shipdate")
        if self.months is not None:
            li = li.where(in_months("l_shipdate", self.months))
        # the digits of the keys are cut out once an order and part; the shuffles of lines carry no longer text
        o = self.t.orders.select(
            F.col("o_orderkey").alias("l_orderkey"), "o_custkey", channel_digits(F.col("o_orderpriority")).alias("channel"))
        c = self.t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
        p = self.t.part.select(F.col("p_partkey").alias("l_partkey"), product_digits(F.col("p_brand")).alias("product"))
        # orders x customer first (order-sized), so the line-item stream is
        # shuffled twice (order key, part key) instead of three times
        oc = o.join(c, "o_custkey")
        j = li.join(oc, "l_orderkey").join(p, "l_partkey")
        units = F.col("l_quantity").cast("int")
        gross = gross_money(F.col("l_extendedprice"))
        return j.select(
            F.col("l_orderkey").alias("order_key"),
            F.col("l_linenumber").alias("line_no"),
            F.col("l_shipdate").cast("date").alias("date_id"),
            F.col("product").cast("int").alias("product_id"),
            F.col("c_nationkey").alias("region_id"),
            F.col("channel").cast("int").alias("channel_id"),
            F.col("l_suppkey").alias("payer_id"),
            units.alias("units"),
            gross.alias("gross_sales_chf"),
            F.col("l_discount"), F.col("l_tax"), F.col("l_shipdate"),
        )

    # ----------------------------------------------------------------- facts
    @cached_property
    def fct_sales(self) -> DataFrame:
        s = self.sales_lines
        cents = (F.col("gross_sales_chf") * 100).cast("bigint")
        units = F.col("units").cast("bigint")
        q = F.expr("(2 * cents_ + units_) div (2 * units_)")
        return (s.withColumns({"cents_": cents, "units_": units})
                .select("order_key", "line_no", "date_id", "product_id", "region_id",
                        "channel_id", "units",
                        F.when(F.col("units_") > 0,
                               (q.cast("decimal(14,0)") * F.lit("0.01").cast("decimal(3,2)")))
                        .cast("decimal(12,2)").alias("list_price_chf"),
                        "gross_sales_chf"))

    @cached_property
    def fct_rebates(self) -> DataFrame:
        s = self.sales_lines
        return s.select(
            "order_key", "line_no", "date_id", "product_id", "payer_id", "region_id",
            (F.col("gross_sales_chf") * F.col("l_discount").cast("decimal(4,2)"))
            .cast(MONEY).alias("rebate_chf"))

    @cached_property
    def fct_promo(self) -> DataFrame:
        s = self.sales_lines
        return s.select(
            "order_key", "line_no", "date_id", "product_id", "region_id", "channel_id",
            (F.col("gross_sales_chf") * F.col("l_tax").cast("decimal(4,2)"))
            .cast(MONEY).alias("spend_chf"),
            F.greatest(F.lit(1), F.floor(F.col("units") / 10).cast("int")).alias("touchpoints"))

    @cached_property
    def fct_forecast(self) -> DataFrame:
        from cantora.operators.forecast import baseline_uplift_fact
        return baseline_uplift_fact(self.fct_sales, self.fct_rebates, self.fct_promo)

    # ------------------------------------------------------------------ dims
    @cached_property
    def dim_date(self) -> DataFrame:
        """Daily calendar over min..max ship date of the source line items. The
        bounds come from a one-column aggregate of the line-item scan (no join);
        the spine is generated on executors."""
        d = F.col("l_shipdate").cast("date")
        bounds = self.t.lineitem.agg(F.min(d).alias("lo"), F.max(d).alias("hi"))
        return calendar_from_bounds(bounds)

    @cached_property
    def dim_product(self) -> DataFrame:
        p = self.t.part.select("p_brand", "p_name", "p_type")
        g = p.groupBy("p_brand").agg(
            F.min("p_name").alias("molecule"),
            F.min("p_type").alias("atc_code"),
            F.min("p_type").alias("indication"))
        pid = product_id_of(F.col("p_brand"))
        return g.select(
            pid.alias("product_id"), F.col("p_brand").alias("brand"), "molecule",
            "atc_code", "indication",
            F.date_add(F.lit("1995-01-01").cast("date"), pid * 30).alias("launch_date"))

    @cached_property
    def dim_region(self) -> DataFrame:
        n = self.t.nation.select("n_nationkey", "n_name", "n_regionkey")
        r = self.t.region.select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
        return n.join(r, "n_regionkey", "left").select(
            F.col("n_nationkey").alias("region_id"), F.col("n_name").alias("canton"),
            F.col("r_name").alias("language_region"))

    @cached_property
    def dim_payer(self) -> DataFrame:
        return self.t.supplier.select(
            F.col("s_suppkey").alias("payer_id"), F.col("s_name").alias("payer_name"),
            F.lit("Insurer").alias("payer_type"))

    @cached_property
    def dim_channel(self) -> DataFrame:
        pr = self.t.orders.select("o_orderpriority").distinct()
        return pr.select(channel_id_of(F.col("o_orderpriority")).alias("channel_id"),
                         F.col("o_orderpriority").alias("channel_name"))


def in_months(col: str, months: list[str]) -> Column:
    """Rows of these months; the range around them reaches the scan's filters."""
    named = sorted(m for m in months if m != "none")
    hit = month_of(F.col(col).cast("date")).isin(*months)
    if named and "none" not in months:
        last = F.add_months(F.lit(named[-1]).cast("date"), 1).cast("timestamp_ntz")
        hit = hit & (F.col(col) >= F.lit(named[0]).cast("timestamp_ntz")) & (F.col(col) < last)
    return hit


def product_digits(brand: Column) -> Column:
    return F.regexp_extract(brand, "[0-9]+", 0)


def product_id_of(brand: Column) -> Column:
    return product_digits(brand).cast("int")


def channel_digits(priority: Column) -> Column:
    return F.substring(priority, 1, 1)


def channel_id_of(priority: Column) -> Column:
    return channel_digits(priority).cast("int")


def calendar_from_bounds(bounds: DataFrame, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """``dim_date`` rows for every day between two date columns of a one-row
    frame: date_id, year, month, ISO week, month_start, week_start."""
    d = bounds.select(F.explode(F.sequence(F.col(lo), F.col(hi))).alias("date_id"))
    return d.select(
        "date_id",
        F.year("date_id").alias("year"),
        F.month("date_id").alias("month"),
        F.weekofyear("date_id").alias("week"),
        F.trunc("date_id", "month").alias("month_start"),
        week_start(F.col("date_id")).alias("week_start"),
    )
