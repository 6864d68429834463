"""Raw landing: TEXT copies of the facts with lineage, and their staging views.

``as_text`` / ``add_lineage`` / ``ingest_ts`` are the landing primitives; the
``raw_*`` builders push a fact through the fault chain first (the reference's
raw tables are messy on purpose). They are landed once, as batches with a
ledger (``warehouse.Warehouse.raw``), and every later query reads what was landed.
Staging views clean every cell with ``functions.clean``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cantora.functions.clean import clean_date, clean_int, clean_numeric, clean_text
from cantora.operators import faults

DEFAULT_SOURCE = "erp"


def as_text(df: DataFrame) -> DataFrame:
    """Every column to string; NULL stays NULL."""
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def add_lineage(df: DataFrame, source_system: str = DEFAULT_SOURCE,
                source_file: str | None = None) -> DataFrame:
    return df.withColumns({"source_system": F.lit(source_system),
                           "source_file": F.lit(source_file or f"{source_system}_batch.csv")})


def ingest_ts(df: DataFrame, stamp: DataFrame) -> DataFrame:
    """Attach ``raw_ingest_ts`` from a one-row frame (size proven, broadcast)."""
    return df.crossJoin(F.broadcast(stamp.select(F.col(stamp.columns[0]).alias("raw_ingest_ts"))))


# The clock of each feed: its batches are stamped with the newest event of this type.
CLOCKS = {"sales": "purchase", "rebates": "click", "promo": "view", "forecast": "signup"}


def ingest_stamp(tables, which: str) -> DataFrame:
    """The ingest timestamp of a batch landed now: newest event of the feed's clock."""
    return tables.events.where(F.col("event_type") == CLOCKS[which]).agg(F.max("ts").alias("raw_ingest_ts"))


# clean-row builders: the reference's fact frames before messing
def sales_base(star) -> DataFrame:
    s = star.fct_sales
    return s.select("date_id", "product_id", "region_id",
                    "channel_id", "units", "list_price_chf", "gross_sales_chf",
                    faults.row_key(["order_key", "line_no", "date_id", "product_id", "region_id",
                                    "channel_id", "units", "gross_sales_chf"]).alias("raw_key"))


def rebates_base(star) -> DataFrame:
    r = star.fct_rebates
    return r.select("date_id", "product_id", "payer_id",
                    "region_id", "rebate_chf",
                    faults.row_key(["order_key", "line_no", "date_id", "product_id", "payer_id",
                                    "region_id", "rebate_chf"]).alias("raw_key"))


def promo_base(star) -> DataFrame:
    p = star.fct_promo
    return p.select("date_id", "product_id", "region_id",
                    "channel_id", "spend_chf", "touchpoints",
                    faults.row_key(["order_key", "line_no", "date_id", "product_id", "region_id",
                                    "channel_id", "spend_chf"]).alias("raw_key"))


def forecast_base(star) -> DataFrame:
    f = star.fct_forecast
    return f.select("date_id", "product_id", "region_id",
                    "baseline_units", "uplift_units", "forecast_units",
                    faults.row_key(["date_id", "product_id", "region_id"]).alias("raw_key"))


# fault-chain specs per raw table: numeric columns, FK columns, date column
RAW_SPECS = {
    "sales": (sales_base, ["units", "list_price_chf", "gross_sales_chf"],
              ["product_id", "region_id", "channel_id"], "sales_raw.csv"),
    "rebates": (rebates_base, ["rebate_chf"], ["product_id", "payer_id", "region_id"], "rebates_raw.csv"),
    "promo": (promo_base, ["spend_chf", "touchpoints"], ["product_id", "region_id", "channel_id"],
              "promo_raw.csv"),
    "forecast": (forecast_base, ["baseline_units", "uplift_units", "forecast_units"],
                 ["product_id", "region_id"], "forecast_raw.csv"),
}


def messed(star, which: str) -> DataFrame:
    """The rows of a batch: clean fact -> fault chain -> TEXT -> lineage + ingest ts."""
    build, numeric, fks, fname = RAW_SPECS[which]
    base = build(star)
    cuts = star.warehouse.cuts(which, faults.chain_stages(numeric, fks, "date_id", True), star.warehouse.fact_version(which))
    out = add_lineage(faults.mess(base, numeric, fks, "date_id", dupes=True, cuts=cuts), DEFAULT_SOURCE, fname)
    return ingest_ts(out, ingest_stamp(star.t, which))


def raw_frame(star, which: str) -> DataFrame:
    """``<which>_raw`` as landed (``Warehouse.raw``): one scan."""
    return star.warehouse.raw(which)


# ------------------------------------------------------------------ staging
def stg_sales(raw: DataFrame) -> DataFrame:
    return raw.select(clean_date("date_id").alias("date_id"), clean_text("product_id").alias("product_id"),
                      clean_text("region_id").alias("region_id"), clean_text("channel_id").alias("channel_id"),
                      clean_int("units").alias("units"), clean_numeric("list_price_chf").alias("list_price_chf"),
                      clean_numeric("gross_sales_chf").alias("gross_sales_chf"))


def stg_rebates(raw: DataFrame) -> DataFrame:
    return raw.select(clean_date("date_id").alias("date_id"), clean_text("product_id").alias("product_id"),
                      clean_text("payer_id").alias("payer_id"), clean_text("region_id").alias("region_id"),
                      clean_numeric("rebate_chf").alias("rebate_chf"))


def stg_promo(raw: DataFrame) -> DataFrame:
    """``touchpoints`` stays text, as in the reference."""
    return raw.select(clean_date("date_id").alias("date_id"), clean_text("product_id").alias("product_id"),
                      clean_text("region_id").alias("region_id"), clean_text("channel_id").alias("channel_id"),
                      clean_numeric("spend_chf").alias("spend_chf"), clean_text("touchpoints").alias("touchpoints"))


def stg_forecast(raw: DataFrame) -> DataFrame:
    return raw.select(clean_date("date_id").alias("date_id"), clean_text("product_id").alias("product_id"),
                      clean_text("region_id").alias("region_id"),
                      clean_numeric("baseline_units").alias("baseline_units"),
                      clean_numeric("uplift_units").alias("uplift_units"),
                      clean_numeric("forecast_units").alias("forecast_units"))


STAGING = {"sales": stg_sales, "rebates": stg_rebates, "promo": stg_promo, "forecast": stg_forecast}
