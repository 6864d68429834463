"""Registered data-quality queries and the
orphan anti-join (§2.4).

Each check is one aggregate per table (``count_if`` per column, unpivoted with
``stack``/``explode``), or one pass with left joins to the dimensions for FK
edges, so a table is scanned once per check whatever the number of columns
or edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cantora.functions.scalar import r6
from cantora.operators import semantic
from cantora.operators.quantiles import group_quantiles
from cantora.plans import marts
from cantora.plans.cleaning import chain_sql, stg_sql
from cantora.plans.oracle_sql import R6, with_star
from cantora.plans.registry import star_query
from cantora.sources import raw as R

# Fixed values of the reference's checks.
FRESH_WARN_H = 2
FRESH_ERROR_H = 6
AS_OF = "2024-03-01 00:00:00"


def _unpivot(agg: DataFrame, cols: list[str], name: str, value: str) -> DataFrame:
    arr = F.array(*[F.struct(F.lit(c).alias(name), F.col(c).alias(value)) for c in cols])
    keep = [c for c in agg.columns if c not in cols]
    return agg.select(*keep, F.explode(arr).alias("_x")).select(*keep, f"_x.{name}", f"_x.{value}")


def not_null_checks(table: str, df: DataFrame, tests: list[tuple[str, str]]) -> DataFrame:
    """One aggregate per table; one output row per (column, severity) test."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c, _ in tests])
    sev = {c: s for c, s in tests}
    u = _unpivot(agg, [c for c, _ in tests], "column_name", "failures")
    sevcol = F.create_map(*[x for c, s in sev.items() for x in (F.lit(c), F.lit(s))])[F.col("column_name")]
    return u.select(F.lit(table).alias("table_name"), "column_name", "failures", sevcol.alias("severity")) \
        .withColumn("status", F.when(F.col("failures") == 0, "pass")
                    .when(F.col("severity") == "warn", "warn").otherwise("error"))


STG_TESTS = [("product_id", "error"), ("region_id", "error"), ("date_id", "warn")]
MART_TESTS = [("year", "error"), ("month", "error"), ("brand", "error"), ("canton", "error")]


def _nn_sql(table: str, tests) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS failures, "
        f"'{s}' AS severity FROM {table}" for c, s in tests)


@star_query("dq_not_null", with_star(
    ",".join(stg_sql(w) for w in ("sales", "rebates", "promo", "forecast")) + ",\nnn AS (" + " UNION ALL ".join(
        [_nn_sql(f"stg_{w}", STG_TESTS) for w in ("sales", "rebates", "promo", "forecast")]
        + [_nn_sql(m, MART_TESTS) for m in ("mart_gtn_waterfall", "mart_brand_perf", "mart_forecast_accuracy")])
    + ")\nSELECT table_name, column_name, failures, severity, CASE WHEN failures = 0 THEN 'pass' "
      "WHEN severity = 'warn' THEN 'warn' ELSE 'error' END AS status FROM nn"))
def q_dq_not_null(star):
    """The 24 not-null tests: product_id / region_id (error) and date_id (warn)
    on the four staging views, year / month / brand / canton on the three marts."""
    parts = [not_null_checks(f"stg_{w}", R.STAGING[w](R.raw_frame(star, w)), STG_TESTS)
             for w in ("sales", "rebates", "promo", "forecast")]
    parts += [not_null_checks(n, fn(star), MART_TESTS) for n, fn in (
        ("mart_gtn_waterfall", marts.mart_gtn_waterfall), ("mart_brand_perf", marts.mart_brand_perf),
        ("mart_forecast_accuracy", marts.mart_forecast_accuracy))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@star_query("dq_freshness", with_star(
    ",".join(chain_sql(w) for w in ("sales", "rebates", "promo", "forecast")) + ",\nfr AS (" + " UNION ALL ".join(
        f"SELECT '{w}_raw' AS table_name, max(raw_ingest_ts) AS newest FROM raw_{w}"
        for w in ("sales", "rebates", "promo", "forecast")) + f""")
SELECT table_name, newest, TIMESTAMP '{AS_OF}' AS as_of,
       {R6(f"date_diff('second', newest, TIMESTAMP '{AS_OF}') / 3600.0")} AS age_hours,
       CASE WHEN newest IS NULL THEN 'error'
            WHEN date_diff('second', newest, TIMESTAMP '{AS_OF}') > {FRESH_ERROR_H} * 3600 THEN 'error'
            WHEN date_diff('second', newest, TIMESTAMP '{AS_OF}') > {FRESH_WARN_H} * 3600 THEN 'warn' ELSE 'pass' END AS status
FROM fr""", marts=False))
def q_dq_freshness(star):
    """Age of the newest ``raw_ingest_ts`` of each raw table against a fixed
    as-of time: warn after 2 h, error after 6 h."""
    parts = [R.raw_frame(star, w).agg(F.max("raw_ingest_ts").alias("newest"))
             .select(F.lit(f"{w}_raw").alias("table_name"), "newest")
             for w in ("sales", "rebates", "promo", "forecast")]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    as_of = F.lit(AS_OF).cast("timestamp_ntz")
    # whole seconds between two NTZ timestamps (second boundaries crossed, as
    # date_diff counts them); no session time zone involved
    secs = F.timestamp_diff("SECOND", F.date_trunc("second", F.col("newest")),
                            F.date_trunc("second", F.col("as_of")))
    u = u.withColumn("as_of", as_of)
    return u.select("table_name", "newest", "as_of", r6(secs / 3600.0).alias("age_hours"),
                    F.when(F.col("newest").isNull(), "error")
                    .when(secs > FRESH_ERROR_H * 3600, "error")
                    .when(secs > FRESH_WARN_H * 3600, "warn").otherwise("pass").alias("status"))


def key_uniqueness(name: str, df: DataFrame, keys: list[str]) -> DataFrame:
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("c"))
    return per_key.agg(F.sum("c").alias("n_rows"), F.count(F.lit(1)).alias("n_keys"),
                       F.count_if(F.col("c") > 1).alias("duplicated_keys")).select(
        F.lit(name).alias("table_name"), F.lit(",".join(keys)).alias("key_cols"),
        F.col("n_rows").cast("bigint").alias("n_rows"), "n_keys", "duplicated_keys",
        (F.col("duplicated_keys") == 0).alias("is_unique"))


def _uniq_sql(name, table, keys):
    k = ", ".join(keys)
    return (f"SELECT '{name}' AS table_name, '{','.join(keys)}' AS key_cols, CAST(SUM(c) AS BIGINT) AS n_rows, "
            f"CAST(COUNT(*) AS BIGINT) AS n_keys, CAST(COUNT(*) FILTER (WHERE c > 1) AS BIGINT) AS duplicated_keys, "
            f"COUNT(*) FILTER (WHERE c > 1) = 0 AS is_unique FROM (SELECT {k}, COUNT(*) AS c FROM {table} GROUP BY {k})")


UNIQ = [("fct_sales", ["order_key", "line_no"]), ("fct_forecast", ["date_id", "product_id", "region_id"]),
        ("dim_product", ["product_id"]), ("dim_region", ["region_id"]), ("dim_date", ["date_id"])]


@star_query("dq_unique", with_star(" UNION ALL ".join(_uniq_sql(n, n, k) for n, k in UNIQ), marts=False))
def q_dq_unique(star):
    """Uniqueness of keys: fact business keys and dimension keys."""
    out = None
    for n, k in UNIQ:
        p = key_uniqueness(n, getattr(star, n), k)
        out = p if out is None else out.unionByName(p)
    return out


# FK edges of facts and staging views: (column, parent dim, parent key)
EDGES = {
    "sales": [("date_id", "dim_date", "date_id"), ("product_id", "dim_product", "product_id"),
              ("region_id", "dim_region", "region_id"), ("channel_id", "dim_channel", "channel_id")],
    "rebates": [("date_id", "dim_date", "date_id"), ("product_id", "dim_product", "product_id"),
                ("payer_id", "dim_payer", "payer_id"), ("region_id", "dim_region", "region_id")],
    "promo": [("date_id", "dim_date", "date_id"), ("product_id", "dim_product", "product_id"),
              ("region_id", "dim_region", "region_id"), ("channel_id", "dim_channel", "channel_id")],
    "forecast": [("date_id", "dim_date", "date_id"), ("product_id", "dim_product", "product_id"),
                 ("region_id", "dim_region", "region_id")],
}


def _key_text(c):
    """One form of a key for every table: a number without its notation, a date, or the text as it is."""
    text = c.cast("string")
    return F.coalesce(F.when(text.rlike("^ *[+-]?[0-9]+ *$"), text.try_cast("decimal(38,0)").cast("string")), text)


def fk_orphans(children: dict[str, tuple[DataFrame, list]], parents: dict[str, DataFrame]) -> DataFrame:
    """child, column_name, parent, child_rows, null_keys, orphans, ok of every FK edge.

    ``children`` maps a table's name to its frame and edges. Each table is scanned
    once: its rows are stacked to (edge, key) and counted map-side, so that a hot
    key leaves a task as one row. The distinct keys of all edges then meet the keys
    of all dimensions in a single join. NULL keys are no orphans and counted apart."""
    counts = []
    for name, (df, edges) in children.items():
        stack = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(d).alias("parent"), _key_text(F.col(c)).alias("key")) for c, d, _ in edges])
        keys = df.select(F.explode(stack).alias("e")).select("e.*")
        counts.append(keys.groupBy(F.lit(name).alias("child"), "column_name", "parent", "key").agg(F.count(F.lit(1)).alias("n")))
    have = {(d, k) for _, edges in children.values() for _, d, k in edges}
    known = [parents[d].select(F.lit(d).alias("_dim"), _key_text(F.col(k)).alias("_key")).distinct() for d, k in sorted(have)]
    j = _union(counts).join(_union(known), (F.col("parent") == F.col("_dim")) & (F.col("key") == F.col("_key")), "left")
    n = F.col("n")
    out = j.groupBy("child", "column_name", "parent").agg(
        F.sum(n).alias("child_rows"), F.sum(F.when(F.col("key").isNull(), n).otherwise(0)).alias("null_keys"),
        F.sum(F.when(F.col("key").isNotNull() & F.col("_key").isNull(), n).otherwise(0)).alias("orphans"))
    return out.withColumn("ok", F.col("orphans") == 0)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _dims(star) -> dict[str, DataFrame]:
    return {d: getattr(star, d) for d in sorted({d for edges in EDGES.values() for _, d, _ in edges})}


def _fk_sql(which, child="stg"):
    parts = []
    for col, dim, key in EDGES[which]:
        cast = f"s.{col}" if col == "date_id" else f"TRY_CAST(s.{col} AS BIGINT)"
        parts.append(
            f"SELECT '{child}_{which}' AS child, '{col}' AS column_name, '{dim}' AS parent, "
            f"CAST(COUNT(*) AS BIGINT) AS child_rows, CAST(COUNT(*) FILTER (WHERE s.{col} IS NULL) AS BIGINT) AS null_keys, "
            f"CAST(COUNT(*) FILTER (WHERE s.{col} IS NOT NULL AND d.{key} IS NULL) AS BIGINT) AS orphans, "
            f"COUNT(*) FILTER (WHERE s.{col} IS NOT NULL AND d.{key} IS NULL) = 0 AS ok "
            f"FROM {child}_{which} s LEFT JOIN (SELECT DISTINCT {key} FROM {dim}) d ON d.{key} = {cast}")
    return " UNION ALL ".join(parts)


@star_query("dq_relationships", with_star(
    ",".join(stg_sql(w) for w in EDGES) + "\n" + " UNION ALL ".join([_fk_sql(w) for w in EDGES] + [_fk_sql(w, "fct") for w in EDGES]), marts=False))
def q_dq_relationships(star):
    """Every FK edge of the four staging views and of the four core facts: one result
    row per edge with its NULL keys and orphans (the broken keys of the fault chain
    show up in staging)."""
    children = {f"stg_{w}": (R.STAGING[w](R.raw_frame(star, w)), EDGES[w]) for w in EDGES}
    children |= {f"fct_{w}": (getattr(star, f"fct_{w}"), EDGES[w]) for w in EDGES}
    return fk_orphans(children, _dims(star))


@star_query("dq_orphans", with_star(stg_sql("sales") + "\n" + _fk_sql("sales"), marts=False))
def q_dq_orphans(star):
    """Sales staging rows without a dimension row, per FK edge."""
    return fk_orphans({"stg_sales": (R.stg_sales(R.raw_frame(star, "sales")), EDGES["sales"])}, _dims(star))


@star_query("join_anti_orphans", with_star(stg_sql("sales") + """
SELECT s.product_id, CAST(COUNT(*) AS BIGINT) AS orphan_rows
FROM stg_sales s LEFT JOIN dim_product p ON p.product_id = TRY_CAST(s.product_id AS BIGINT)
WHERE p.product_id IS NULL AND s.product_id IS NOT NULL GROUP BY s.product_id""", marts=False))
def q_join_anti_orphans(star):
    """Anti-join (LEFT JOIN .. IS NULL): staging sales keys with no product."""
    s = R.stg_sales(R.raw_frame(star, "sales")).filter(F.col("product_id").isNotNull())
    d = star.dim_product.select(F.col("product_id").cast("bigint").alias("_pid"))
    o = s.join(d, s["product_id"].try_cast("bigint") == d["_pid"], "left_anti")
    return o.groupBy("product_id").agg(F.count(F.lit(1)).alias("orphan_rows"))


def pk_check(name: str, df: DataFrame, keys: list[str]) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct(*keys).alias("n_distinct"),
                  F.count_if(F.greatest(*[F.col(c).isNull() for c in keys]) if len(keys) > 1
                             else F.col(keys[0]).isNull()).alias("null_keys")).select(
        F.lit(name).alias("table_name"), "n_rows", "n_distinct", "null_keys",
        ((F.col("n_rows") == F.col("n_distinct")) & (F.col("null_keys") == 0)).alias("pk_ok"))


PKS = [("dim_date", ["date_id"]), ("dim_product", ["product_id"]), ("dim_region", ["region_id"]),
       ("dim_payer", ["payer_id"]), ("dim_channel", ["channel_id"]), ("fct_sales", ["order_key", "line_no"])]


@star_query("dq_pk", with_star(" UNION ALL ".join(
    f"SELECT '{n}' AS table_name, CAST(COUNT(*) AS BIGINT) AS n_rows, "
    f"CAST(COUNT(DISTINCT ({', '.join(k)})) AS BIGINT) AS n_distinct, "
    f"CAST(COUNT(*) FILTER (WHERE {' OR '.join(c + ' IS NULL' for c in k)}) AS BIGINT) AS null_keys, "
    f"COUNT(*) = COUNT(DISTINCT ({', '.join(k)})) AND COUNT(*) FILTER (WHERE {' OR '.join(c + ' IS NULL' for c in k)}) = 0 AS pk_ok "
    f"FROM {n}" for n, k in PKS), marts=False))
def q_dq_pk(star):
    """Primary keys unique and not null: rows, distinct keys, NULL keys."""
    out = None
    for n, k in PKS:
        p = pk_check(n, getattr(star, n), k)
        out = p if out is None else out.unionByName(p)
    return out


@star_query("dq_dupe_keys", with_star(stg_sql("sales") + """
SELECT date_id, product_id, region_id, channel_id, CAST(COUNT(*) AS BIGINT) AS n
FROM stg_sales GROUP BY date_id, product_id, region_id, channel_id HAVING COUNT(*) > 1""", marts=False))
def q_dq_dupe_keys(star):
    """Duplicate business keys (date, product, region, channel) in staging sales."""
    s = R.stg_sales(R.raw_frame(star, "sales"))
    return s.groupBy("date_id", "product_id", "region_id", "channel_id").agg(
        F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


@star_query("dq_month_overflow", with_star("""
SELECT CAST(date_trunc('month', date_id) AS DATE) AS month_start, product_id, region_id, CAST(COUNT(*) AS BIGINT) AS n
FROM fct_sales GROUP BY 1, 2, 3 HAVING COUNT(*) > 31
ORDER BY n DESC, month_start, product_id, region_id LIMIT 10""", marts=False))
def q_dq_month_overflow(star):
    """Grain check: month x product x region groups with more than 31 daily
    rows, the first 10 (top-n on a grouped, filtered aggregate)."""
    g = star.fct_sales.groupBy(F.trunc("date_id", "month").alias("month_start"), "product_id", "region_id") \
        .agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 31)
    return g.orderBy(F.desc("n"), "month_start", "product_id", "region_id").limit(10)


@star_query("dq_date_gaps", with_star("""
SELECT d.date_id, d.month_start FROM dim_date d
WHERE NOT EXISTS (SELECT 1 FROM fct_sales s WHERE s.date_id = d.date_id)""", marts=False))
def q_dq_date_gaps(star):
    """Calendar days with no sales (spine LEFT ANTI the observed dates)."""
    seen = star.fct_sales.select("date_id").distinct()
    return star.dim_date.select("date_id", "month_start").join(seen, "date_id", "left_anti")


NP_COLS = ["date_id", "product_id", "region_id", "channel_id", "units", "list_price_chf", "gross_sales_chf"]


@star_query("dq_null_profile", with_star(stg_sql("sales") + "\n" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS nulls, "
    f"CAST(COUNT(*) AS BIGINT) AS n_rows, CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS null_share "
    f"FROM stg_sales" for c in NP_COLS), marts=False))
def q_dq_null_profile(star):
    """Unexpected NULLs per column of staging sales (one aggregate)."""
    s = R.stg_sales(R.raw_frame(star, "sales"))
    a = s.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in NP_COLS])
    u = _unpivot(a, NP_COLS, "column_name", "nulls")
    return u.select("column_name", "nulls", "n_rows",
                    (F.col("nulls").cast("double") / F.col("n_rows").cast("double")).alias("null_share"))


@star_query("dq_outliers", with_star(f"""
q AS (SELECT brand, quantile_cont(CAST(net AS DOUBLE), 0.25) AS q1, quantile_cont(CAST(net AS DOUBLE), 0.75) AS q3
      FROM canton_m GROUP BY brand)
SELECT c.brand, c.canton, c.month_start, CAST(c.net AS DOUBLE) AS net,
       {R6('q.q1 - 1.5 * (q.q3 - q.q1)')} AS lo, {R6('q.q3 + 1.5 * (q.q3 - q.q1)')} AS hi
FROM canton_m c JOIN q ON c.brand = q.brand
WHERE CAST(c.net AS DOUBLE) < q.q1 - 1.5 * (q.q3 - q.q1) OR CAST(c.net AS DOUBLE) > q.q3 + 1.5 * (q.q3 - q.q1)"""))
def q_dq_outliers(star):
    """Canton-month net outside [Q1 - 1.5 IQR, Q3 + 1.5 IQR] of its brand
    (exact quartiles per brand by histogram and refinement, joined back)."""
    c = semantic.canton_month(star).select("brand", "canton", "month_start", "net")
    q = group_quantiles(c, ["brand"], "net", [0.25, 0.75]).select("brand", "q")
    j = c.join(q, "brand")
    q1, q3 = F.col("q")[0], F.col("q")[1]
    lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    x = F.col("net").cast("double")
    return j.filter((x < lo) | (x > hi)).select("brand", "canton", "month_start", "net",
                                                r6(lo).alias("lo"), r6(hi).alias("hi"))


@star_query("dq_month_coverage", with_star("""
c AS (SELECT brand, COUNT(DISTINCT month_start) AS n_months,
             date_diff('month', min(month_start), max(month_start)) + 1 AS span FROM brand_m GROUP BY brand)
SELECT brand, CAST(n_months AS BIGINT) AS n_months, CAST(span AS INTEGER) AS span_months,
       n_months < span AS has_gap, n_months >= 13 AND n_months = span AS l12m_ok,
       n_months >= 24 AND n_months = span AS yoy_ok
FROM c"""))
def q_dq_month_coverage(star):
    """Months of history per brand: at least 13 without a gap for L12M, 24
    for YoY."""
    bm = semantic.brand_month(star)
    c = bm.groupBy("brand").agg(F.countDistinct("month_start").alias("n_months"),
                                (F.months_between(F.max("month_start"), F.min("month_start")).cast("int") + 1)
                                .alias("span_months"))
    n, s = F.col("n_months"), F.col("span_months")
    return c.select("brand", "n_months", "span_months", (n < s).alias("has_gap"),
                    ((n >= 13) & (n == s)).alias("l12m_ok"), ((n >= 24) & (n == s)).alias("yoy_ok"))


@star_query("dq_reconcile", with_star("""
SELECT 'gross' AS measure, CAST((SELECT SUM(gross_sales_chf) FROM mart_gtn_waterfall) AS DOUBLE) AS mart_total,
       CAST((SELECT SUM(gross_sales_chf) FROM fct_sales) AS DOUBLE) AS source_total,
       CAST((SELECT SUM(gross_sales_chf) FROM mart_gtn_waterfall) - (SELECT SUM(gross_sales_chf) FROM fct_sales) AS DOUBLE) AS diff
UNION ALL SELECT 'rebates', CAST((SELECT SUM(rebates_chf) FROM mart_gtn_waterfall) AS DOUBLE),
       CAST((SELECT SUM(rebate_chf) FROM fct_rebates) AS DOUBLE),
       CAST((SELECT SUM(rebates_chf) FROM mart_gtn_waterfall) - (SELECT SUM(rebate_chf) FROM fct_rebates) AS DOUBLE)
UNION ALL SELECT 'units', CAST((SELECT SUM(units) FROM mart_brand_perf) AS DOUBLE),
       CAST((SELECT SUM(units) FROM fct_sales) AS DOUBLE),
       CAST((SELECT SUM(units) FROM mart_brand_perf) - (SELECT SUM(units) FROM fct_sales) AS DOUBLE)
UNION ALL SELECT 'promo', CAST((SELECT SUM(promo_spend) FROM mart_brand_perf) AS DOUBLE),
       CAST((SELECT SUM(spend_chf) FROM fct_promo) AS DOUBLE),
       CAST((SELECT SUM(promo_spend) FROM mart_brand_perf) - (SELECT SUM(spend_chf) FROM fct_promo) AS DOUBLE)"""))
def q_dq_reconcile(star):
    """Mart totals against source fact totals (exact decimals), difference."""
    g = marts.mart_gtn_waterfall(star).agg(F.sum("gross_sales_chf").alias("g"), F.sum("rebates_chf").alias("r"))
    p = marts.mart_brand_perf(star).agg(F.sum("units").alias("u"), F.sum("promo_spend").alias("p"))
    s = star.fct_sales.agg(F.sum("gross_sales_chf").alias("sg"), F.sum("units").alias("su"))
    r = star.fct_rebates.agg(F.sum("rebate_chf").alias("sr"))
    pr = star.fct_promo.agg(F.sum("spend_chf").alias("sp"))
    one = g.crossJoin(p).crossJoin(s).crossJoin(r).crossJoin(pr)  # one-row aggregates
    rows = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(a).cast("double").alias("mart_total"),
                              F.col(b).cast("double").alias("source_total"),
                              (F.col(a) - F.col(b)).cast("double").alias("diff"))
                     for m, a, b in (("gross", "g", "sg"), ("rebates", "r", "sr"), ("units", "u", "su"),
                                     ("promo", "p", "sp"))])
    return one.select(F.explode(rows).alias("x")).select("x.*")

