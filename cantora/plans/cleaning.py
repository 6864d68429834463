"""Registered raw-landing, cleaning, staging, fault and dimension queries
(SURVEY §2.1 landing keys, §2.2, §2.10 fault keys) with DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from cantora.functions import clean as C
from cantora.functions.dates import make_month, period_label
from cantora.operators import faults
from cantora.sources import raw as R
from cantora.plans.oracle_sql import with_star
from cantora.plans.registry import star_query

# --------------------------------------------------------------------------
# DuckDB twins: cleaning macros and the fault chain
# --------------------------------------------------------------------------
NULL_LIKE = "upper(trim({0}, ' ')) IN ('', 'NULL', 'N/A', 'NA')"


def clean_text_sql(c: str) -> str:
    return f"NULLIF(trim(regexp_replace(CAST({c} AS VARCHAR), '^\\s*NULL\\s*$', '', 'i'), ' '), '')"


def clean_int_sql(c: str) -> str:
    return (f"CASE WHEN {c} IS NULL OR {NULL_LIKE.format(c)} THEN NULL "
            f"ELSE TRY_CAST(NULLIF(regexp_replace({c}, '[^0-9]', '', 'g'), '') AS INTEGER) END")


def clean_numeric_sql(c: str) -> str:
    s1 = f"translate(replace(trim({c}, ' '), '{C.UNICODE_MINUS}', '-'), '{C.NUMBER_NOISE}', '')"
    eu = (f"CASE WHEN regexp_matches({s1}, '{C.EU_GROUPED}') OR (regexp_matches({s1}, '{C.COMMA_DECIMAL}') "
          f"AND {s1} NOT LIKE '%,%,%') THEN replace(replace({s1}, '.', ''), ',', '.') END")
    us = (f"CASE WHEN regexp_matches({s1}, '{C.US_GROUPED_DECIMAL}') OR regexp_matches({s1}, '{C.US_GROUPED_INT}') "
          f"THEN replace({s1}, ',', '') END")
    simple = (f"CASE WHEN regexp_matches({s1}, '{C.DOT_DECIMAL}') THEN {s1} "
              f"WHEN regexp_matches({s1}, '{C.COMMA_DECIMAL}') THEN replace({s1}, ',', '.') "
              f"WHEN regexp_matches({s1}, '{C.PLAIN_INT}') THEN {s1} END")
    return (f"CASE WHEN {c} IS NULL OR {NULL_LIKE.format(c)} THEN NULL "
            f"ELSE TRY_CAST(NULLIF(COALESCE({eu}, {us}, {simple}), '') AS DECIMAL(38,10)) END")


def clean_date_sql(c: str) -> str:
    t = f"trim({c}, ' ')"
    return (f"CASE WHEN {c} IS NULL OR {NULL_LIKE.format(c)} THEN NULL "
            f"WHEN regexp_matches({t}, '{C.ISO_DATE}') THEN CAST(try_strptime(replace({t}, '/', '-'), '%Y-%m-%d') AS DATE) "
            f"WHEN regexp_matches({t}, '{C.DOTTED_DATE}') THEN CAST(try_strptime({t}, '%d.%m.%Y') AS DATE) "
            f"WHEN regexp_matches({t}, '{C.SLASH_DATE}') THEN CASE WHEN TRY_CAST(split_part({t}, '/', 1) AS INTEGER) > 12 "
            f"THEN CAST(try_strptime({t}, '%d/%m/%Y') AS DATE) ELSE CAST(try_strptime({t}, '%m/%d/%Y') AS DATE) END END")


def hex_int_sql(h: str) -> str:
    return f"CAST(('0x' || substr({h}, 25, 8)) AS BIGINT)"


def messy_number_sql(x: str, h: str) -> str:
    d = f"CAST({x} AS DECIMAL(18,2))"
    return (f"CASE {hex_int_sql(h)} % 6 WHEN 0 THEN CAST({d} AS VARCHAR) "
            f"WHEN 1 THEN format('{{:,.2f}}', CAST({d} AS DOUBLE)) "
            f"WHEN 2 THEN CAST(CAST(round_even({d}, 0) AS BIGINT) AS VARCHAR) "
            f"WHEN 3 THEN replace(CAST({d} AS VARCHAR), '.', ',') WHEN 4 THEN '' ELSE 'NULL' END")


def messy_date_sql(d: str, h: str) -> str:
    return (f"CASE {hex_int_sql(h)} % 4 WHEN 0 THEN strftime({d}, '%Y-%m-%d') "
            f"WHEN 1 THEN strftime({d}, '%d.%m.%Y') WHEN 2 THEN strftime({d}, '%m/%d/%Y') "
            f"ELSE strftime({d}, '%Y-%m-%d') || ' 00:00:00' END")


def broken_key_sql(h: str) -> str:
    return f"CAST({faults.FK_LOW} + {hex_int_sql(h)} % {faults.FK_HIGH - faults.FK_LOW} AS VARCHAR)"


def _key_sql(cols: list[str]) -> str:
    return "md5(concat_ws('|', " + ", ".join(f"CAST({c} AS VARCHAR)" for c in cols) + "))"


BASES_SQL = {
    "sales": ("fct_sales", ["date_id", "product_id", "region_id", "channel_id", "units", "list_price_chf",
                            "gross_sales_chf"],
              ["order_key", "line_no", "date_id", "product_id", "region_id", "channel_id", "units",
               "gross_sales_chf"]),
    "rebates": ("fct_rebates", ["date_id", "product_id", "payer_id", "region_id", "rebate_chf"],
                ["order_key", "line_no", "date_id", "product_id", "payer_id", "region_id", "rebate_chf"]),
    "promo": ("fct_promo", ["date_id", "product_id", "region_id", "channel_id", "spend_chf", "touchpoints"],
              ["order_key", "line_no", "date_id", "product_id", "region_id", "channel_id", "spend_chf"]),
    "forecast": ("fct_forecast", ["date_id", "product_id", "region_id", "baseline_units", "uplift_units",
                                  "forecast_units"], ["date_id", "product_id", "region_id"]),
}


def chain_sql(which: str, numeric=True, fk=True, dates=True, dupes=True, lineage=True,
              name: str | None = None) -> str:
    """CTEs ending in ``<name>`` (default ``raw_<which>``): the fault chain."""
    _, num_cols, fk_cols, fname = R.RAW_SPECS[which]
    fact, cols, key_cols = BASES_SQL[which]
    stages = faults.chain_stages(num_cols if numeric else [], fk_cols if fk else [],
                                 "date_id" if dates else None, dupes)
    p = f"{which}_{'n' if numeric else ''}{'f' if fk else ''}{'d' if dates else ''}{'u' if dupes else ''}"
    name = name or f"raw_{which}"
    hashes = ", ".join(f"md5(concat_ws('|', '{faults.SEED}', '{s.name}', raw_key)) AS h{i}"
                       for i, s in enumerate(stages))
    ks = []
    for i, s in enumerate(stages):
        k = f"floor(CAST({s.rate!r} AS DOUBLE) * n)"
        if s.at_least_one:
            k = f"LEAST(n, GREATEST(1, {k}))"
        ks.append(f"(SELECT max(h) FROM (SELECT h{i} AS h, ROW_NUMBER() OVER (ORDER BY h{i}) AS rn FROM {p}_h) "
                  f"WHERE rn <= (SELECT CAST({k} AS BIGINT) FROM (SELECT COUNT(*) AS n FROM {p}_h))) AS cut{i}")
    out = {c: f"CAST({c} AS VARCHAR)" for c in cols}
    for i, s in enumerate(stages):
        kind, _, col = s.name.partition(":")
        m = f"COALESCE(h{i} <= cut{i}, FALSE)"
        if kind == "num":
            out[col] = f"CASE WHEN {m} THEN {messy_number_sql(col, f'h{i}')} ELSE {out[col]} END"
        elif kind == "fk":
            out[col] = f"CASE WHEN {m} THEN {broken_key_sql(f'h{i}')} ELSE {out[col]} END"
        elif kind == "date":
            out[col] = f"CASE WHEN {m} THEN {messy_date_sql(col, f'h{i}')} ELSE {out[col]} END"
    sel = ", ".join(f"{v} AS {c}" for c, v in out.items())
    dup = f"COALESCE(h{len(stages) - 1} <= cut{len(stages) - 1}, FALSE)" if dupes else "FALSE"
    lin = (f", 'erp' AS source_system, '{fname}' AS source_file, "
           f"(SELECT max(ts) FROM events WHERE event_type = '{R.CLOCKS[which]}') AS raw_ingest_ts") if lineage else ""
    return f"""
{p}_b AS (SELECT {', '.join(cols)}, {_key_sql(key_cols)} AS raw_key FROM {fact}),
{p}_h AS (SELECT *{', ' + hashes if hashes else ''} FROM {p}_b),
{p}_c AS (SELECT {', '.join(ks) if ks else '1 AS _none'}),
{p}_x AS (SELECT {sel}, raw_key, {dup} AS _dupe FROM {p}_h CROSS JOIN {p}_c),
{name} AS (
  SELECT {', '.join(cols)}, raw_key{lin} FROM {p}_x
  UNION ALL SELECT {', '.join(cols)}, raw_key{lin} FROM {p}_x WHERE _dupe
)"""


STG_COLS = {
    "sales": [("date_id", clean_date_sql), ("product_id", clean_text_sql), ("region_id", clean_text_sql),
              ("channel_id", clean_text_sql), ("units", clean_int_sql), ("list_price_chf", clean_numeric_sql),
              ("gross_sales_chf", clean_numeric_sql)],
    "rebates": [("date_id", clean_date_sql), ("product_id", clean_text_sql), ("payer_id", clean_text_sql),
                ("region_id", clean_text_sql), ("rebate_chf", clean_numeric_sql)],
    "promo": [("date_id", clean_date_sql), ("product_id", clean_text_sql), ("region_id", clean_text_sql),
              ("channel_id", clean_text_sql), ("spend_chf", clean_numeric_sql), ("touchpoints", clean_text_sql)],
    "forecast": [("date_id", clean_date_sql), ("product_id", clean_text_sql), ("region_id", clean_text_sql),
                 ("baseline_units", clean_numeric_sql), ("uplift_units", clean_numeric_sql),
                 ("forecast_units", clean_numeric_sql)],
}


def stg_sql(which: str) -> str:
    cols = ", ".join(f"{fn(c)} AS {c}" for c, fn in STG_COLS[which])
    return f"{chain_sql(which)},\nstg_{which} AS (SELECT {cols} FROM raw_{which})"


def _dbl_decimals(which: str, prefix: str = "") -> str:
    """Final select of a staging view: decimals as doubles (registry rule)."""
    out = []
    for c, fn in STG_COLS[which]:
        out.append(f"CAST({prefix}{c} AS DOUBLE) AS {c}" if fn is clean_numeric_sql else f"{prefix}{c}")
    return ", ".join(out)


RAW_TEXT_COLS = {k: v[1] + ["raw_key", "source_system", "source_file", "raw_ingest_ts"] for k, v in BASES_SQL.items()}


# --------------------------------------------------------------------------
# landing keys
# --------------------------------------------------------------------------
def _raw(star, which):
    return R.raw_frame(star, which)


for _w in ("sales", "rebates", "promo", "forecast"):
    def _land(star, _w=_w):
        return _raw(star, _w)
    _land.__doc__ = (f"Land ``{_w}_raw``: the {_w} fact through the fault chain, as TEXT with lineage "
                     "and ingest time, landed once as a batch of the ledger and read back.")
    star_query(f"raw_land_{_w}", with_star(f"""{chain_sql(_w)}
SELECT {', '.join(RAW_TEXT_COLS[_w])} FROM raw_{_w}""", marts=False))(_land)


@star_query("lineage_cols", with_star("""
SELECT CAST(date_id AS VARCHAR) AS date_id, CAST(product_id AS VARCHAR) AS product_id,
       CAST(payer_id AS VARCHAR) AS payer_id, CAST(region_id AS VARCHAR) AS region_id,
       CAST(rebate_chf AS VARCHAR) AS rebate_chf, 'erp' AS source_system, 'erp_batch.csv' AS source_file
FROM fct_rebates""", marts=False))
def q_lineage_cols(star):
    """``add_lineage`` with the defaults: source 'erp', file '<source>_batch.csv'."""
    r = star.fct_rebates.select("date_id", "product_id", "payer_id", "region_id", "rebate_chf")
    return R.add_lineage(R.as_text(r))


@star_query("cast_all_text", with_star("""
SELECT CAST(date_id AS VARCHAR) AS date_id, CAST(product_id AS VARCHAR) AS product_id,
       CAST(region_id AS VARCHAR) AS region_id, CAST(channel_id AS VARCHAR) AS channel_id,
       CAST(spend_chf AS VARCHAR) AS spend_chf, CAST(touchpoints AS VARCHAR) AS touchpoints
FROM fct_promo""", marts=False))
def q_cast_all_text(star):
    """``as_text``: every column to string, NULL stays NULL."""
    p = star.fct_promo.select("date_id", "product_id", "region_id", "channel_id", "spend_chf", "touchpoints")
    return R.as_text(p)


@star_query("ingest_ts", with_star(",".join(chain_sql(w) for w in R.CLOCKS) + "\n" + " UNION ALL ".join(
    f"SELECT '{w}_raw' AS table_name, raw_ingest_ts, CAST(COUNT(*) AS BIGINT) AS n_rows FROM raw_{w} GROUP BY raw_ingest_ts"
    for w in R.CLOCKS), marts=False))
def q_ingest_ts(star):
    """Stamp and rows of every landed batch, as the ledger has them: the row of the
    ledger is published by the commit that publishes the batch's data."""
    star.warehouse.build_raw()
    return star.warehouse.ledger().select("table_name", "raw_ingest_ts", "n_rows")


# --------------------------------------------------------------------------
# cleaning functions over the landed raw cells
# --------------------------------------------------------------------------
@star_query("clean_text", with_star(f"""{chain_sql('sales')}
SELECT product_id AS raw_product_id, {clean_text_sql('product_id')} AS product_id,
       channel_id AS raw_channel_id, {clean_text_sql('channel_id')} AS channel_id
FROM raw_sales""", marts=False))
def q_clean_text(star):
    """``clean_text`` on the raw sales key cells."""
    r = _raw(star, "sales")
    return r.select(F.col("product_id").alias("raw_product_id"), C.clean_text("product_id").alias("product_id"),
                    F.col("channel_id").alias("raw_channel_id"), C.clean_text("channel_id").alias("channel_id"))


@star_query("clean_int", with_star(f"""{chain_sql('sales')}
SELECT units AS raw_units, {clean_int_sql('units')} AS units FROM raw_sales""", marts=False))
def q_clean_int(star):
    """``clean_int`` on the raw sales units cells (strips every non-digit)."""
    r = _raw(star, "sales")
    return r.select(F.col("units").alias("raw_units"), C.clean_int("units").alias("units"))


@star_query("clean_numeric", with_star(f"""{chain_sql('sales')}
SELECT gross_sales_chf AS raw_gross, CAST({clean_numeric_sql('gross_sales_chf')} AS DOUBLE) AS gross_sales_chf,
       list_price_chf AS raw_price, CAST({clean_numeric_sql('list_price_chf')} AS DOUBLE) AS list_price_chf
FROM raw_sales""", marts=False))
def q_clean_numeric(star):
    """``clean_numeric`` on the raw sales money cells (EU, then US, then simple)."""
    r = _raw(star, "sales")
    return r.select(F.col("gross_sales_chf").alias("raw_gross"), C.clean_numeric("gross_sales_chf").alias("gross_sales_chf"),
                    F.col("list_price_chf").alias("raw_price"), C.clean_numeric("list_price_chf").alias("list_price_chf"))


@star_query("clean_date", with_star(f"""{chain_sql('sales')}
SELECT date_id AS raw_date, {clean_date_sql('date_id')} AS date_id FROM raw_sales""", marts=False))
def q_clean_date(star):
    """``clean_date`` on the raw sales date cells."""
    r = _raw(star, "sales")
    return r.select(F.col("date_id").alias("raw_date"), C.clean_date("date_id").alias("date_id"))


for _w in ("sales", "rebates", "promo", "forecast"):
    def _stg(star, _w=_w):
        return R.STAGING[_w](_raw(star, _w))
    _stg.__doc__ = f"Staging view ``stg_{_w}``: every raw cell cleaned to its type."
    star_query(f"stg_{_w}", with_star(f"""{stg_sql(_w)}
SELECT {_dbl_decimals(_w)} FROM stg_{_w}""", marts=False))(_stg)


# --------------------------------------------------------------------------
# fault keys
# --------------------------------------------------------------------------
@star_query("fault_mask", with_star("""
b AS (SELECT order_key, line_no, date_id, product_id, region_id, channel_id, units, gross_sales_chf,
             md5(concat_ws('|', '20250813', 'mask', md5(concat_ws('|', CAST(order_key AS VARCHAR), CAST(line_no AS VARCHAR),
                 CAST(date_id AS VARCHAR), CAST(product_id AS VARCHAR), CAST(region_id AS VARCHAR),
                 CAST(channel_id AS VARCHAR), CAST(units AS VARCHAR), CAST(gross_sales_chf AS VARCHAR))))) AS h
      FROM fct_sales)
SELECT order_key, line_no, date_id, CAST(gross_sales_chf AS DOUBLE) AS gross_sales_chf, h AS mask_hash
FROM b WHERE h <= (SELECT max(h) FROM (SELECT h, ROW_NUMBER() OVER (ORDER BY h) AS rn FROM b)
                   WHERE rn <= (SELECT floor(CAST(0.15 AS DOUBLE) * COUNT(*)) FROM b))""", marts=False))
def q_fault_mask(star):
    """``floor(0.15 n)`` sales rows picked without replacement, repeatably:
    the rows with the smallest md5(seed | 'mask' | row key)."""
    s = star.fct_sales
    key = faults.row_key(["order_key", "line_no", "date_id", "product_id", "region_id", "channel_id",
                          "units", "gross_sales_chf"])
    b = s.select("order_key", "line_no", "date_id", "gross_sales_chf", key.alias("raw_key"))
    stages = [faults.Stage("mask", faults.RATE_TYPES)]
    cuts = star.warehouse.cuts("sales", stages, star.lines_version)
    m = faults.with_masks(b, "raw_key", stages, cuts=cuts)
    return m.filter("_m0").select("order_key", "line_no", "date_id", "gross_sales_chf",
                                  F.col("_h0").alias("mask_hash"))


def _partial(star, which, **kw):
    build, numeric, fks, _ = R.RAW_SPECS[which]
    base = build(star)
    cuts = star.warehouse.cuts(which, faults.chain_stages(numeric, fks, "date_id", True), star.warehouse.fact_version(which))
    return faults.mess(base, numeric if kw.get("numeric") else [], fks if kw.get("fk") else [],
                       "date_id" if kw.get("dates") else None, dupes=kw.get("dupes", False), cuts=cuts)


_SALES_TXT = "date_id, product_id, region_id, channel_id, units, list_price_chf, gross_sales_chf, raw_key"

for _key, _kw in (("fault_numeric", dict(numeric=True)), ("fault_dates", dict(dates=True)),
                  ("fault_dupes", dict(dupes=True)), ("fault_fk", dict(fk=True))):
    def _f(star, _kw=_kw):
        return _partial(star, "sales", **_kw)
    _f.__doc__ = f"Sales rows after only the ``{_key}`` injector (TEXT cells)."
    _args = dict(numeric=False, fk=False, dates=False, dupes=False, lineage=False, name="faulted")
    _args.update(_kw)
    star_query(_key, with_star(f"""{chain_sql('sales', **_args)}
SELECT {_SALES_TXT} FROM faulted""", marts=False))(_f)


@star_query("fault_roundtrip", with_star(f"""{stg_sql('sales')},
orig AS (SELECT {_key_sql(BASES_SQL['sales'][2])} AS raw_key, * FROM fct_sales),
cmp AS (
  SELECT o.date_id = {clean_date_sql('k.date_id')} AS ok_date,
         o.product_id = TRY_CAST({clean_text_sql('k.product_id')} AS INTEGER) AS ok_product,
         o.region_id = TRY_CAST({clean_text_sql('k.region_id')} AS INTEGER) AS ok_region,
         o.channel_id = TRY_CAST({clean_text_sql('k.channel_id')} AS INTEGER) AS ok_channel,
         o.units = {clean_int_sql('k.units')} AS ok_units,
         o.list_price_chf = {clean_numeric_sql('k.list_price_chf')} AS ok_price,
         o.gross_sales_chf = {clean_numeric_sql('k.gross_sales_chf')} AS ok_gross
  FROM raw_sales k JOIN orig o ON k.raw_key = o.raw_key
)
SELECT col AS column_name, CAST(COUNT(*) AS BIGINT) AS cells,
       CAST(SUM(CASE WHEN ok THEN 1 ELSE 0 END) AS BIGINT) AS recovered,
       CAST(SUM(CASE WHEN ok THEN 1 ELSE 0 END) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS share_recovered
FROM cmp UNPIVOT INCLUDE NULLS (ok FOR col IN (ok_date, ok_product, ok_region, ok_channel, ok_units, ok_price, ok_gross))
GROUP BY col""", marts=False))
def q_fault_roundtrip(star):
    """Full chain (numeric -> FK -> dates -> dupes -> TEXT -> lineage) and the
    staging clean-up, then the share of cells recovered per column, matched
    to the clean row through the lineage key (one equi-join)."""
    raw = _raw(star, "sales")
    st = raw.select(
        "raw_key", *[c.alias(n) for n, c in (
            ("date_id", C.clean_date("date_id")), ("product_id", C.clean_text("product_id")),
            ("region_id", C.clean_text("region_id")), ("channel_id", C.clean_text("channel_id")),
            ("units", C.clean_int("units")), ("list_price_chf", C.clean_numeric("list_price_chf")),
            ("gross_sales_chf", C.clean_numeric("gross_sales_chf")))])
    o = star.fct_sales.select(faults.row_key(BASES_SQL["sales"][2]).alias("raw_key"),
                              *[F.col(c).alias("o_" + c) for c in BASES_SQL["sales"][1]])
    j = st.join(o, "raw_key")
    eq = {
        "ok_date": F.col("date_id") == F.col("o_date_id"),
        "ok_product": F.col("product_id").try_cast("int") == F.col("o_product_id"),
        "ok_region": F.col("region_id").try_cast("int") == F.col("o_region_id"),
        "ok_channel": F.col("channel_id").try_cast("int") == F.col("o_channel_id"),
        "ok_units": F.col("units") == F.col("o_units"),
        "ok_price": F.col("list_price_chf") == F.col("o_list_price_chf"),
        "ok_gross": F.col("gross_sales_chf") == F.col("o_gross_sales_chf"),
    }
    stacked = j.select(F.explode(F.array(*[F.struct(F.lit(k).alias("column_name"), v.alias("ok"))
                                           for k, v in eq.items()])).alias("x")).select("x.*")
    g = stacked.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("cells"),
        F.sum(F.when(F.col("ok"), 1).otherwise(0)).cast("bigint").alias("recovered"))
    return g.withColumn("share_recovered", F.col("recovered").cast("double") / F.col("cells").cast("double"))


# --------------------------------------------------------------------------
# dimensions
# --------------------------------------------------------------------------
@star_query("dim_date", with_star("SELECT * FROM dim_date", marts=False))
def q_dim_date(star):
    """Daily calendar: date_id, year, month, ISO week, month_start, week_start (Tuesday weeks)."""
    return star.dim_date


@star_query("dim_region", with_star("SELECT * FROM dim_region", marts=False))
def q_dim_region(star):
    """Regions (nations) with their language region."""
    return star.dim_region


@star_query("dim_payer", with_star("SELECT * FROM dim_payer", marts=False))
def q_dim_payer(star):
    """Payers (suppliers) and type."""
    return star.dim_payer


@star_query("dim_product", with_star("SELECT * FROM dim_product", marts=False))
def q_dim_product(star):
    """Products at brand grain: molecule, ATC code, indication, launch date."""
    return star.dim_product


@star_query("dim_channel", with_star("SELECT * FROM dim_channel", marts=False))
def q_dim_channel(star):
    """Channels (distinct order priorities) with their key."""
    return star.dim_channel


# --------------------------------------------------------------------------
# scalar function surfaces
# --------------------------------------------------------------------------
@star_query("scalar_dates", with_star("""
SELECT date_id, make_date(year, month, 1) AS month_start, CAST(date_trunc('month', date_id) AS DATE) AS trunc_month,
       CAST(month(date_id) AS INTEGER) AS month_num, CAST(strptime(CAST(date_id AS VARCHAR), '%Y-%m-%d') AS DATE) AS parsed,
       CAST(date_id - INTERVAL 1 YEAR AS DATE) AS year_ago, CAST(week(date_id) AS INTEGER) AS iso_week
FROM dim_date""", marts=False))
def q_scalar_dates(star):
    """Date functions in use: make_date, trunc to month, month, to_date,
    interval minus, ISO week."""
    d = star.dim_date
    return d.select("date_id", make_month(F.col("year"), F.col("month")).alias("month_start"),
                    F.trunc("date_id", "month").alias("trunc_month"), F.month("date_id").alias("month_num"),
                    F.to_date(F.col("date_id").cast("string"), "yyyy-MM-dd").alias("parsed"),
                    F.add_months("date_id", -12).alias("year_ago"), F.weekofyear("date_id").alias("iso_week"))


@star_query("scalar_strings", with_star("""
SELECT p.brand, r.canton, upper(trim(lower(p.brand), ' ')) AS up, replace(p.brand, 'Brand#', 'B') AS short,
       translate(r.canton, 'AEIOU', 'aeiou') AS tr, regexp_replace(p.brand, '[^0-9]', '', 'g') AS digits,
       split_part(p.brand, '#', 2) AS part2, p.brand LIKE 'Brand#1%' AS like1,
       regexp_matches(r.canton, '^[A-Z_]+[0-9]+$') AS rx, lpad(CAST(p.product_id AS VARCHAR), 3, '0') AS padded
FROM (SELECT DISTINCT product_id, region_id FROM fct_sales) s
JOIN dim_product p ON s.product_id = p.product_id JOIN dim_region r ON s.region_id = r.region_id""", marts=False))
def q_scalar_strings(star):
    """String functions in use (trim, upper, replace, translate, regexp_replace,
    split_part, LIKE, regex match, zero-pad) on the sold brand x canton pairs."""
    s = star.fct_sales.select("product_id", "region_id").distinct()
    j = s.join(star.dim_product.select("product_id", "brand"), "product_id") \
        .join(star.dim_region.select("region_id", "canton"), "region_id")
    b, c = F.col("brand"), F.col("canton")
    return j.select(b, c, F.upper(F.trim(F.lower(b))).alias("up"),
                    F.replace(b, F.lit("Brand#"), F.lit("B")).alias("short"),
                    F.translate(c, "AEIOU", "aeiou").alias("tr"),
                    F.regexp_replace(b, "[^0-9]", "").alias("digits"),
                    F.split_part(b, F.lit("#"), F.lit(2)).alias("part2"),
                    b.like("Brand#1%").alias("like1"), c.rlike("^[A-Z_]+[0-9]+$").alias("rx"),
                    F.lpad(F.col("product_id").cast("string"), 3, "0").alias("padded"))


@star_query("scalar_math", with_star("""
SELECT year, month, brand, canton, CAST(abs(abs_error_units) AS DOUBLE) AS abs_err,
       CAST(GREATEST(0, uplift_units) AS DOUBLE) AS pos_uplift, CAST(NULLIF(actual_units, 0) AS BIGINT) AS nz_actual,
       CAST(COALESCE(forecast_units, 0) AS DOUBLE) AS fc0,
       CASE WHEN actual_units > forecast_units THEN 'under' WHEN actual_units < forecast_units THEN 'over' ELSE 'exact' END AS bias,
       CAST(LEAST(GREATEST(uplift_units, CAST(-0.4 * actual_units AS DECIMAL(38,2))), CAST(0.5 * actual_units AS DECIMAL(38,2))) AS DOUBLE) AS clipped,
       sqrt(CAST(actual_units AS DOUBLE)) AS sqrt_units, CAST(round(forecast_units, 0) AS DOUBLE) AS fc_round,
       CAST(trunc(forecast_units) AS BIGINT) AS fc_int
FROM mart_forecast_accuracy"""))
def q_scalar_math(star):
    """Math and conditionals in use: abs, greatest, nullif, coalesce, case,
    clip, max(0, .), sqrt, round, casts (on exact decimals)."""
    from cantora.plans import marts
    m = marts.mart_forecast_accuracy(star)
    a, f, u = F.col("actual_units"), F.col("forecast_units"), F.col("uplift_units")
    lo = (F.lit("-0.4").cast("decimal(2,1)") * a)
    hi = (F.lit("0.5").cast("decimal(2,1)") * a)
    return m.select("year", "month", "brand", "canton", F.abs("abs_error_units").alias("abs_err"),
                    F.greatest(F.lit(0), u).alias("pos_uplift"), F.nullif(a, F.lit(0)).alias("nz_actual"),
                    F.coalesce(f, F.lit(0)).alias("fc0"),
                    F.when(a > f, "under").when(a < f, "over").otherwise("exact").alias("bias"),
                    F.least(F.greatest(u, lo), hi).alias("clipped"),
                    F.sqrt(a.cast("double")).alias("sqrt_units"), F.round(f, 0).alias("fc_round"),
                    f.cast("bigint").alias("fc_int"))


@star_query("period_label", with_star("""
SELECT DISTINCT year, month, year || '-' || lpad(CAST(month AS VARCHAR), 2, '0') AS period FROM exec_m"""))
def q_period_label(star):
    """'YYYY-MM' labels of the mart months."""
    from cantora.operators import semantic
    e = semantic.exec_monthly(star).select("year", "month").distinct()
    return e.withColumn("period", period_label(F.col("year"), F.col("month")))

