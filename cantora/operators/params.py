"""Saved forecast parameters: canonical scope keys, upsert, lookup.

The table is versioned by ``updated_at``; an upsert is a union of the old and
new versions reduced to the newest row per (scope_level, key1, key2) with
``max_by`` on a struct (a partial aggregate). ``ParamTable`` keeps it in the shared
folder: a save writes the merged rows and commits them as the next version if
nobody else did meanwhile; else it merges with the winner's rows and tries again,
so that no writer's rows are lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cantora.sources.store import Store

# Fixed values of the reference's parameter table.
S_GLOBAL = "__GLOBAL__"
S_ALL = "__ALL__"
KEY = ["scope_level", "scope_key1", "scope_key2"]
SCHEMA = ("scope_level string, scope_key1 string, scope_key2 string, alpha double, beta double, train_start date, "
          "train_end date, updated_at timestamp_ntz, fit_method string, promo_lag int")
COLS = ["alpha", "beta", "train_start", "train_end", "updated_at", "fit_method", "promo_lag"]


def canonical_keys(level: Column, k1: Column, k2: Column) -> tuple[Column, Column]:
    """global -> (__GLOBAL__, __GLOBAL__); brand -> (k1, __ALL__); else (k1, k2)."""
    key1 = F.when(level == "global", F.lit(S_GLOBAL)).otherwise(k1.cast("string"))
    key2 = F.when(level == "global", F.lit(S_GLOBAL)).when(level == "brand", F.lit(S_ALL)) \
        .otherwise(k2.cast("string"))
    return key1, key2


def newest(params: DataFrame) -> DataFrame:
    """Newest row per scope key (ties on updated_at broken by the rest)."""
    row = F.struct(*[F.col(c) for c in COLS])
    order = F.struct("updated_at", "fit_method", "alpha", "beta")
    g = params.groupBy(*KEY).agg(F.max_by(row, order).alias("_r"))
    return g.select(*KEY, *[F.col(f"_r.{c}").alias(c) for c in COLS])


def upsert(existing: DataFrame, new: DataFrame) -> DataFrame:
    return newest(existing.select(*KEY, *COLS).unionByName(new.select(*KEY, *COLS)))


def lookup_each(params: DataFrame, scopes: DataFrame) -> DataFrame:
    """The newest saved row of every scope (scope_level, k1, k2) that has one; scopes
    are canonicalised as they are when saved."""
    key1, key2 = canonical_keys(F.col("scope_level"), F.col("k1"), F.col("k2"))
    wanted = scopes.select("scope_level", key1.alias("scope_key1"), key2.alias("scope_key2")).distinct()
    return newest(params).join(wanted, KEY, "left_semi")


def lookup(params: DataFrame, level: str, k1: str | None = None, k2: str | None = None) -> DataFrame:
    """``load_saved_params``: the newest row of one scope, or none."""
    scope = params.sparkSession.createDataFrame([(level, k1, k2)], "scope_level string, k1 string, k2 string")
    return lookup_each(params, scope)


class ParamTable:
    """Saved parameters in a versioned table (``sources.store``)."""

    def __init__(self, store: Store):
        self.store = store

    def rows(self) -> DataFrame:
        """The newest row of every scope, as of now; none before the first save."""
        m = self.store.manifest()
        if m is None:
            return self.store.spark.createDataFrame([], SCHEMA)
        return self.store.read(m)

    def save(self, new: DataFrame) -> int:
        """Insert or replace on the three-part key; returns the version that holds the rows."""
        def change(old: dict | None) -> dict:
            rows = new.select(*KEY, *COLS)
            return self.store.write(newest(rows) if old is None else upsert(self.store.read(old), rows))
        return self.store.update(change)["version"]

    def lookup(self, level: str, k1: str | None = None, k2: str | None = None) -> DataFrame:
        return lookup(self.rows(), level, k1, k2)
