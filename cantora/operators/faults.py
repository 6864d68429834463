"""Fault injection for the raw landing test-bed, repeatable and exact.

The reference masks exactly ``floor(rate * n)`` random rows per fault. Here a
row's fate is decided by ``md5(seed | stage | row_key)``: a stage masks the k
rows with the smallest hashes, i.e. every row whose hash is <= the k-th
smallest hash (the stage's *cut*). Choices inside a masked cell (which messy
format, which broken key) come from other digits of the same hash. DuckDB can
replay all of it, so every fault key has a full oracle.

Scale: masks depend only on the clean row's key, so the cuts of all stages are
found together in one aggregate pass over the base frame, whose hashes near the
expected cuts are narrowed further (``stage_cuts``). The cuts are constants, one a
stage; every fault is then a column expression in one projection.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cantora.session import ensure_checkpoint_dir

# Fixed values of the reference's test-bed.
SEED = "20250813"
RATE_TYPES = 0.15
RATE_DATES = 0.08
RATE_FK = 0.02
RATE_DUPES = 0.02
FK_LOW, FK_HIGH = 900000, 999999  # broken keys are drawn from [900000, 999999)


@dataclass(frozen=True)
class Stage:
    name: str          # e.g. "num:units", "fk:product_id", "date:date_id", "dupe"
    rate: float
    at_least_one: bool = False


def row_key(cols: list[str]) -> Column:
    """Stable key of a clean row: md5 of its columns as text."""
    return F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in cols]))


def stage_hash(stage: str, key: Column, seed: str = SEED) -> Column:
    return F.md5(F.concat_ws("|", F.lit(seed), F.lit(stage), key))


def hex_int(h: Column, start: int, length: int = 8) -> Column:
    return F.conv(F.substring(h, start, length), 16, 10).cast("bigint")


# digits of the hash that each level of the selection adds; the last takes the rest
LEVELS = (3, 4, 25)
SIGMAS = 6   # half the width of the band that is kept in the first pass, in standard deviations of a cut's place


def _band(rate: float, n: int) -> tuple[str, str]:
    """Digits of the first level from which, and before which, a cut is to be expected."""
    top = 16 ** LEVELS[0]
    half = SIGMAS * math.sqrt(rate * (1 - rate) / n) * top + 1
    lo, hi = max(0, math.floor(rate * top - half)), math.ceil(rate * top + half)
    return f"{lo:0{LEVELS[0]}x}", f"{hi:0{LEVELS[0]}x}" if hi < top else "g"


def _picked(base: DataFrame, key_col: str, stages: dict[int, Stage], seed: str, pick) -> DataFrame:
    """(stage, h, c): how often each (stage, h) comes that ``pick(i, hash)`` gives for a row; null gives none. The
    hashes are columns of their own, as an expression under ``inline`` is worked out wherever it stands."""
    hashes = base.select(*[stage_hash(s.name, F.col(key_col), seed).alias(f"h{i}") for i, s in stages.items()])
    rows = F.array(*[pick(i, F.col(f"h{i}")) for i in stages])
    return hashes.select(F.inline(rows)).where("stage is not null").groupBy("stage", "h").agg(F.count(F.lit(1)).alias("c"))


def _row(i: int, h: Column) -> Column:
    return F.struct(F.lit(i).alias("stage"), h.alias("h"))


def stage_cuts(base: DataFrame, key_col: str, stages: list[Stage], seed: str = SEED) -> dict[str, str | None]:
    """Name of each stage -> its k-th smallest hash (None when k = 0).

    One pass over the base counts the hashes of each stage below a narrow band around the place where
    its cut is to be expected, and keeps those in the band (about n / 1,000 a stage, fewer the larger n).
    Should the counts tell that the k-th row is not there, as where few rows come many times, two more
    passes find its bucket among 4,096 and the hashes of that. The kept hashes are narrowed by histograms
    of at most 65,536 buckets a stage. One row a stage and level reaches the driver and enters the next
    as a constant, so no plan nests those before it."""
    n = base.count()
    rank = {i: min(n, max(1, math.floor(s.rate * n))) if s.at_least_one else math.floor(s.rate * n) for i, s in enumerate(stages)}
    left = {i: s for i, s in enumerate(stages) if rank[i]}
    if not left:
        return {s.name: None for s in stages}
    ensure_checkpoint_dir(base.sparkSession)
    prefix = dict.fromkeys(left, "")
    w = Window.partitionBy("stage").orderBy("b").rowsBetween(Window.unboundedPreceding, 0)

    def of_stage(values: dict) -> Column:
        return F.create_map(*[F.lit(x) for i in left for x in (i, values[i])])[F.col("stage")]

    def narrow(hist: DataFrame) -> None:
        found = hist.withColumn("cum", F.sum("c").over(w)).where(F.col("cum") >= of_stage(rank))
        for x in found.groupBy("stage").agg(F.min(F.struct("b", "cum", "c")).alias("t")).select("stage", "t.*").collect():
            prefix[x.stage] += x.b
            rank[x.stage] -= x.cum - x.c

    def level(rows: DataFrame, k: int) -> DataFrame:
        return rows.groupBy("stage", F.substring("h", 1 + sum(LEVELS[:k]), LEVELS[k]).alias("b")).agg(F.sum("c").alias("c"))

    bands = {i: _band(s.rate, n) for i, s in left.items()}
    near = _picked(base, key_col, left, seed, lambda i, h: F.when(h < bands[i][1], _row(i, F.when(h >= bands[i][0], h)))).checkpoint()
    counts = {r.stage: r for r in near.groupBy("stage").agg(F.sum(F.when(F.col("h").isNull(), F.col("c")).otherwise(0)).alias("below"), F.sum("c").alias("upto")).collect()}
    hit = [i for i in left if i in counts and counts[i].below < rank[i] <= counts[i].upto]
    missed = {i: s for i, s in left.items() if i not in hit}
    kept = near.where(F.col("h").isNotNull() & F.col("stage").isin(hit))
    for i in hit:
        rank[i] -= counts[i].below
    if hit:
        narrow(level(kept, 0))
    if missed:
        narrow(_picked(base, key_col, missed, seed, lambda i, h: _row(i, F.substring(h, 1, LEVELS[0]))).withColumnRenamed("h", "b"))
        kept = kept.unionByName(_picked(base, key_col, missed, seed, lambda i, h: F.when(F.startswith(h, F.lit(prefix[i])), _row(i, h)))).checkpoint()
    for k in (1, 2):
        narrow(level(kept.where(F.startswith("h", of_stage(prefix))), k))
    return {s.name: prefix.get(i) for i, s in enumerate(stages)}


def with_masks(base: DataFrame, key_col: str, stages: list[Stage], seed: str = SEED, cuts: dict[str, str | None] | None = None) -> DataFrame:
    """Add ``_h<i>`` (stage hash) and boolean ``_m<i>`` (masked) columns: one
    projection, as the cuts are constants (found here unless given)."""
    cuts = stage_cuts(base, key_col, stages, seed) if cuts is None else cuts
    cols = {}
    for i, s in enumerate(stages):
        h = stage_hash(s.name, F.col(key_col), seed)
        cols[f"_h{i}"] = h
        cols[f"_m{i}"] = F.lit(False) if cuts[s.name] is None else h <= F.lit(cuts[s.name])
    return base.withColumns(cols)


# --------------------------------------------------------------------------
# messy cell forms
# --------------------------------------------------------------------------
def messy_number(x: Column, h: Column) -> Column:
    """One of six forms by hash: plain 2-dec, thousands comma, rounded int
    (half-even), decimal comma, empty, ``NULL``."""
    d = x.cast("decimal(18,2)")
    plain = d.cast("string")
    pick = hex_int(h, 25) % 6
    return (F.when(pick == 0, plain)
            .when(pick == 1, F.format_number(d, 2))
            .when(pick == 2, F.bround(d, 0).cast("bigint").cast("string"))
            .when(pick == 3, F.replace(plain, F.lit("."), F.lit(",")))
            .when(pick == 4, F.lit(""))
            .otherwise(F.lit("NULL")))


def messy_date(d: Column, h: Column) -> Column:
    """One of four forms by hash: ISO, DD.MM.YYYY, MM/DD/YYYY, ISO + midnight."""
    pick = hex_int(h, 25) % 4
    return (F.when(pick == 0, F.date_format(d, "yyyy-MM-dd"))
            .when(pick == 1, F.date_format(d, "dd.MM.yyyy"))
            .when(pick == 2, F.date_format(d, "MM/dd/yyyy"))
            .otherwise(F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit(" 00:00:00"))))


def broken_key(h: Column) -> Column:
    return (F.lit(FK_LOW) + hex_int(h, 25) % (FK_HIGH - FK_LOW)).cast("string")


# --------------------------------------------------------------------------
# the chain: numeric -> FK -> dates -> duplicates, then TEXT
# --------------------------------------------------------------------------
def chain_stages(numeric: list[str], fks: list[str], date_col: str | None,
                 dupes: bool) -> list[Stage]:
    st = [Stage(f"num:{c}", RATE_TYPES) for c in numeric]
    st += [Stage(f"fk:{c}", RATE_FK) for c in fks]
    if date_col:
        st.append(Stage(f"date:{date_col}", RATE_DATES))
    if dupes:
        st.append(Stage("dupe", RATE_DUPES, at_least_one=True))
    return st


def mess(base: DataFrame, numeric: list[str], fks: list[str], date_col: str | None,
         dupes: bool = True, key_col: str = "raw_key", cuts: dict[str, str | None] | None = None) -> DataFrame:
    """Apply the fault chain to a clean frame that carries ``key_col``; every
    business column comes out as TEXT. Duplicates are exact copies of the
    masked (already messed) rows, appended."""
    stages = chain_stages(numeric, fks, date_col, dupes)
    x = with_masks(base, key_col, stages, cuts=cuts)
    business = [c for c in base.columns if c != key_col]
    out = {}
    for c in business:
        out[c] = F.col(c).cast("string")
    for i, s in enumerate(stages):
        kind, _, col = s.name.partition(":")
        h, m = F.col(f"_h{i}"), F.col(f"_m{i}")
        if kind == "num":
            out[col] = F.when(m, messy_number(F.col(col), h)).otherwise(out[col])
        elif kind == "fk":
            out[col] = F.when(m, broken_key(h)).otherwise(out[col])
        elif kind == "date":
            out[col] = F.when(m, messy_date(F.col(col), h)).otherwise(out[col])
    cols = [out[c].alias(c) for c in business] + [F.col(key_col)]
    messed = x.select(*cols, *([F.col(f"_m{len(stages) - 1}").alias("_dupe")] if dupes else []))
    if not dupes:
        return messed
    # a masked row is emitted twice in the same pass (no second scan)
    n_out = F.when(F.col("_dupe"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return messed.select("*", F.explode(n_out).alias("_copy")).drop("_dupe", "_copy")
