"""The published warehouse of one input folder: core star, raw landing, fault cuts.

Everything the queries share is built once, published as versioned tables
(``sources.store``) under the shared folder and brought up to date when the
input files change: the joined sales lines by month (a new month of line items
rebuilds that month), the forecast fact from its first changed month on, the
dimensions when their inputs change, and the raw tables as landed batches. The
same plans thus run in tests, in the bench and on a cluster.
"""

from __future__ import annotations

import hashlib
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cantora.operators import faults
from cantora.session import ensure_checkpoint_dir
from cantora.sources.bridge import Star, in_months
from cantora.sources.store import Store, derive, land_batch, ledger, month_of, publish, publish_whole
from cantora.sources.tables import Tables

DIMS = {  # dimension -> tables it is built from
    "dim_date": ["lineitem"], "dim_product": ["part"], "dim_region": ["nation", "region"],
    "dim_payer": ["supplier"], "dim_channel": ["orders"],
}
FEEDS = ("sales", "rebates", "promo", "forecast")


class StoredStar(Star):
    """The star as published: facts are projections of the stored sales lines."""

    def __init__(self, warehouse: Warehouse):
        super().__init__(warehouse.tables)
        self.warehouse = warehouse

    @cached_property
    def lines_version(self) -> dict:
        return self.warehouse.lines()

    @cached_property
    def sales_lines(self) -> DataFrame:
        return self.warehouse.store("sales_lines").read(self.lines_version)

    @cached_property
    def fct_forecast(self) -> DataFrame:
        return self.warehouse.store("fct_forecast").read(self.warehouse.forecast(self.lines_version))

    def of_months(self, months: list[str] | None) -> StoredStar:
        """This version's star with the sales lines of some months only."""
        if months is None:
            return self
        out = StoredStar(self.warehouse)
        out.__dict__["lines_version"] = self.lines_version
        out.__dict__["sales_lines"] = self.warehouse.store("sales_lines").read(self.lines_version, months)
        return out

    def __getattribute__(self, name):
        if name in DIMS:
            return object.__getattribute__(self, "warehouse").dim(name)
        return object.__getattribute__(self, name)


class Warehouse:
    def __init__(self, spark: SparkSession, sf_dir: str, root: str | None = None):
        self.spark, self.tables = spark, Tables(spark, sf_dir)
        name = hashlib.md5(self.tables.sf_dir.encode()).hexdigest()[:12]
        self.root = root or f"{ensure_checkpoint_dir(spark).rstrip('/')}/warehouse/{name}"

    def store(self, name: str) -> Store:
        return Store(self.spark, f"{self.root}/{name}")

    def star(self) -> StoredStar:
        return StoredStar(self)

    # ------------------------------------------------------------------- core
    def lines(self) -> dict:
        paths = self.tables.paths
        return publish(self.store("sales_lines"), paths["lineitem"], "l_shipdate", [paths["orders"], paths["customer"], paths["part"]],
                       lambda months: Star(Tables(self.spark, self.tables.sf_dir), months).sales_lines, "date_id")

    def forecast(self, lines: dict) -> dict:
        from cantora.operators.forecast import baseline_uplift_fact

        def build(months):
            s = self.star()
            s.__dict__["lines_version"] = lines
            f = baseline_uplift_fact(s.fct_sales, s.fct_rebates, s.fct_promo)
            return f if months is None else f.where(in_months("date_id", months))

        # a baseline looks back over earlier days of its series
        return derive(self.store("fct_forecast"), lines, build, lambda: month_of(F.col("date_id")), later=True)

    def dim(self, name: str) -> DataFrame:
        s = self.store(name)
        m = publish_whole(s, [self.tables.paths[t] for t in DIMS[name]], lambda: getattr(Star(Tables(self.spark, self.tables.sf_dir)), name))
        return s.read(m)

    def build_core(self) -> None:
        star = self.star()
        for name in ("sales_lines", "fct_forecast", *DIMS):
            getattr(star, name)

    # -------------------------------------------------------------------- raw
    def cuts(self, which: str, stages: list[faults.Stage], fact: dict) -> dict[str, str | None]:
        """Cut hash of every fault stage of one raw table; found once per version of its
        fact and kept in a manifest (one value a stage)."""
        from cantora.sources import raw

        def change(old: dict | None) -> dict | None:
            have = old["cuts"] if old and old["upstream"] == fact["parts"] else {}
            missing = [s for s in stages if s.name not in have]
            if not missing:
                return None
            return {"upstream": fact["parts"], "cuts": have | faults.stage_cuts(raw.RAW_SPECS[which][0](self.star()), "raw_key", missing)}

        return self.store(f"cuts_{which}").update(change)["cuts"]

    def fact_version(self, which: str) -> dict:
        lines = self.lines()
        return self.forecast(lines) if which == "forecast" else lines

    def raw(self, which: str) -> DataFrame:
        """``<which>_raw`` as landed: one batch per version of its fact, truncate and load."""
        from cantora.sources import raw
        s, fact = self.store(f"raw_{which}"), self.fact_version(which)
        m = land_batch(s, f"{which}-{fact['version']:08d}", lambda: raw.messed(self.star(), which), raw.RAW_SPECS[which][3], replace=True)
        return s.read(m)

    def build_raw(self) -> None:
        """Land what is not landed; the four feeds' jobs run side by side."""
        self.forecast(self.lines())
        with ThreadPoolExecutor(len(FEEDS)) as pool:
            list(pool.map(self.raw, FEEDS))

    def ledger(self) -> DataFrame:
        """table_name, batch_id, source_file, n_rows, raw_ingest_ts of every landed batch."""
        return ledger(self.spark, {f"{w}_raw": self.store(f"raw_{w}") for w in FEEDS})


def star(spark: SparkSession, sf_dir: str) -> StoredStar:
    return Warehouse(spark, sf_dir).star()
