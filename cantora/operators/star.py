"""Star joins: facts to dimensions.

Marts group facts by (year, month, brand, canton) after an inner join to the
date, product and region dimensions. Because all three join keys are also
(functionally) grouping keys and the dimension keys are unique, the sum can be
taken in two steps without changing the result:

1. partial sums per (date_id, product_id, region_id) straight off the fact
   (map-side combine, one shuffle whose size is bounded by days x products x
   regions, not by fact rows; a hot key is already collapsed in the map task);
2. inner joins of that daily aggregate to the dimensions, and the final sum at
   month grain.

The joins therefore never see raw fact rows. Join strategy is left to Spark's
size checks: the static estimate against ``autoBroadcastJoinThreshold`` and
AQE's runtime statistics turn the dimension side into a broadcast when, and
only when, it is measured small; otherwise a sort-merge join runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DAY_GRAIN = ["date_id", "product_id", "region_id"]
MONTH_GRAIN = ["year", "month", "brand", "canton"]


def daily_rollup(fact: DataFrame, sums: dict[str, str], extra_keys=()) -> DataFrame:
    """Σ of fact columns per day x product x region (x extra keys)."""
    keys = [*DAY_GRAIN, *extra_keys]
    return fact.groupBy(*keys).agg(*[F.sum(src).alias(out) for out, src in sums.items()])


def attach_dims(daily: DataFrame, star, date_cols=("year", "month"),
                product_cols=("brand",), region_cols=("canton",), how="inner") -> DataFrame:
    """Join a day-grain frame to the date, product and region dimensions."""
    d = star.dim_date.select("date_id", *date_cols)
    p = star.dim_product.select("product_id", *product_cols)
    r = star.dim_region.select("region_id", *region_cols)
    return daily.join(d, "date_id", how).join(p, "product_id", how).join(r, "region_id", how)


def star_monthly(fact: DataFrame, star, sums: dict[str, str]) -> DataFrame:
    """``SELECT year, month, brand, canton, SUM(..) FROM fact JOIN dims GROUP BY 1..4``."""
    daily = daily_rollup(fact, sums)
    joined = attach_dims(daily, star)
    return joined.groupBy(*MONTH_GRAIN).agg(*[F.sum(c).alias(c) for c in sums])


def left_join_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on equal keys; NULL keys never match (SQL semantics)."""
    return left.join(right, keys, "left")


# ------------------------------------------------------- row-level dimension joins
BROADCAST_BYTES = 64 << 20
HOT_SHARE = 0.01       # a key of more than this share of the rows is hot: at most 100 keys
SALTS = 64


def size_of(df: DataFrame) -> int:
    """Bytes of a frame by Spark's statistics: of a stored dimension, of its files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def hot_keys(fact: DataFrame, key: str, share: float = HOT_SHARE) -> list:
    """Keys that hold more than ``share`` of the rows (counted map-side, exactly; at most
    1 / ``share`` values reach the driver)."""
    counts = fact.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = F.broadcast(counts.agg(F.sum("n").alias("_all")))
    return [r[0] for r in counts.crossJoin(total).where(F.col("n") > share * F.col("_all")).select(key).collect()]


def dim_join(fact: DataFrame, dim: DataFrame, key: str, how: str = "inner", limit: int = BROADCAST_BYTES) -> DataFrame:
    """``fact`` joined to ``dim`` on ``key`` (``inner``, ``left`` or ``left_semi``) without sending
    raw fact rows to one task per key. A dimension of at most ``limit`` bytes is
    broadcast, and no fact row is exchanged. A larger one is joined by (key, salt):
    rows of hot keys are dealt over many salts, whose dimension rows are copied as
    often, and rows without a key go past the join."""
    if size_of(dim) <= limit:
        return fact.join(F.broadcast(dim), key, how)
    hot = hot_keys(fact, key)
    kind = fact.schema[key].dataType
    is_hot = F.col(key).isin(*[F.lit(h).cast(kind) for h in hot]) if hot else F.lit(False)
    salt = F.when(is_hot, F.pmod(F.xxhash64(*fact.columns), F.lit(SALTS)).cast("int")).otherwise(0)
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    rows = fact.where(F.col(key).isNotNull()).withColumn("_salt", salt)
    joined = rows.join(dim.withColumn("_salt", F.explode(copies)), [key, "_salt"], how).drop("_salt")
    if how != "left":
        return joined
    unkeyed = fact.where(F.col(key).isNull())
    return joined.unionByName(unkeyed, allowMissingColumns=True).select(*joined.columns)
