"""Keys: dense surrogate keys and insert-if-absent seeding."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cantora.session import scratch_path
from cantora.sources.store import WHOLE, Store


def dense_key(df: DataFrame, order_cols: list[str], name: str = "sk",
              partitions: int | None = None, after: int = 0) -> DataFrame:
    """after+1..after+n in the (total) order of ``order_cols`` without a single-partition
    window and with one shuffle: rows are range-partitioned, sorted and written with
    their number in the partition (reliable storage, survives executor loss), and
    the partitions' counts, one row each, are summed up before them."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # monotonically_increasing_id: the partition's number above 33 bits, the row's below
    r = df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols).withColumn("_at", F.monotonically_increasing_id())
    path = scratch_path(spark, "dense-key")
    r.write.parquet(path)
    r = spark.read.parquet(path).withColumn("_pid", F.shiftright("_at", 33))
    counts = r.groupBy("_pid").agg(F.count(F.lit(1)).alias("_c"))
    offs = counts.select("_pid", F.coalesce(
        F.sum("_c").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("_off"))
    number = F.col("_off") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1 + after
    return r.join(F.broadcast(offs), "_pid").withColumn(name, number.cast("long")).drop("_pid", "_at", "_off")


class KeyMap:
    """Surrogate keys that stay: business key -> serial number, in a versioned table
    (``sources.store``) to which each load adds a part with its new keys."""

    def __init__(self, store: Store, business: list[str], name: str = "sk"):
        self.store, self.business, self.name = store, business, name

    def _same(self, a: DataFrame, b: DataFrame):
        out = F.lit(True)
        for c in self.business:
            out = out & a[c].eqNullSafe(b[c])
        return out

    def assign(self, df: DataFrame, upstream: dict | None = None) -> dict:
        """Number the business keys of ``df`` that the map lacks, after its largest number,
        in their order; equal rows share a number. ``upstream`` names the version of
        the rows: a version that was loaded last is not looked at again."""
        def change(old: dict | None) -> dict | None:
            if old and upstream is not None and old["upstream"] == upstream:
                return None
            new, top = df.select(*self.business).distinct(), 0
            if old:
                have = self.store.read(old)
                new = new.join(have, self._same(new, have), "left_anti")
                top = old["largest"]
            wrote = self.store.write(dense_key(new, self.business, self.name, after=top))
            part = self.store.spark.read.parquet(f"{self.store.root}/{wrote['parts'][WHOLE]}")
            largest = part.agg(F.max(self.name)).first()[0] or top
            parts = old["parts"] if old else {}
            return {"schema": wrote["schema"], "parts": {**parts, f"{len(parts):06d}": wrote["parts"][WHOLE]}, "upstream": upstream, "largest": largest}

        return self.store.update(change)

    def keyed(self, df: DataFrame, upstream: dict | None = None) -> DataFrame:
        """The distinct business keys of ``df`` with their numbers. After a single load these
        are the map itself; later the rows that went are left out."""
        m = self.assign(df, upstream)
        rows = self.store.read(m)
        return rows if len(m["parts"]) == 1 else rows.join(df, self._same(rows, df), "left_semi")


def seed_append(dim: DataFrame, seed: DataFrame, key: str, name_col: str) -> DataFrame:
    """Insert-if-absent: seed rows whose name is not in the dimension get new
    keys after the current maximum (the seed is a short literal list; the
    existing maximum is a one-row aggregate)."""
    new = seed.join(dim.select(name_col), name_col, "left_anti")
    mx = dim.agg(F.coalesce(F.max(key), F.lit(0)).alias("_mx"))
    w = Window.orderBy("_ord")
    new = new.crossJoin(F.broadcast(mx)).select(
        (F.col("_mx") + F.row_number().over(w)).cast(dim.schema[key].dataType).alias(key), name_col)
    return dim.select(key, name_col).unionByName(new)
