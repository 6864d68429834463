"""Dense surrogate keys, insert-if-absent seeding, parameter upsert."""
from pyspark.sql import functions as F

from cantora.operators import keys
from cantora.operators import params as P


def test_dense_key_is_row_number(spark, star_small):
    s = star_small.fct_sales.select("order_key", "line_no", "date_id", "product_id", "units", "gross_sales_chf")
    k = keys.dense_key(s, s.columns, "sk", partitions=4)
    rows = k.orderBy("sk").collect()
    assert [r.sk for r in rows] == list(range(1, len(rows) + 1))
    ordered = sorted(rows, key=lambda r: tuple(r[c] for c in s.columns))
    assert [r.sk for r in ordered] == list(range(1, len(rows) + 1))


def test_seed_append_insert_if_absent(spark):
    dim = spark.createDataFrame([(1, "Retail"), (2, "Online")], "channel_id int, channel_name string")
    seed = spark.createDataFrame([(0, "Retail"), (1, "Hospital")], "_ord int, channel_name string")
    out = sorted(tuple(r) for r in keys.seed_append(dim, seed, "channel_id", "channel_name").collect())
    assert out == [(1, "Retail"), (2, "Online"), (3, "Hospital")]
    again = keys.seed_append(spark.createDataFrame(out, dim.schema), seed, "channel_id", "channel_name")
    assert again.count() == 3


def test_upsert_newest_wins_and_lookup(spark):
    cols = "scope_level string, scope_key1 string, scope_key2 string, alpha double, beta double, " \
           "train_start date, train_end date, updated_at timestamp_ntz, fit_method string, promo_lag int"
    old = spark.sql("SELECT 'brand', 'B1', '__ALL__', 0.1D, -0.1D, DATE'2020-01-01', DATE'2020-12-01', "
                    "TIMESTAMP_NTZ'2025-01-01 00:00:00', 'OLS', 0").toDF(*[c.split()[0] for c in cols.split(", ")])
    new = spark.sql("SELECT 'brand', 'B1', '__ALL__', 0.2D, -0.2D, DATE'2020-01-01', DATE'2020-12-01', "
                    "TIMESTAMP_NTZ'2025-01-02 00:00:00', 'WLS', 1").toDF(*old.columns)
    up = P.upsert(old, new).collect()
    assert len(up) == 1 and up[0].alpha == 0.2 and up[0].fit_method == "WLS"
    hit = P.lookup(old.unionByName(new), "brand", "B1").collect()
    assert hit[0].alpha == 0.2
    assert P.lookup(old, "brand", "B2").count() == 0
    k1, k2 = P.canonical_keys(F.lit("global"), F.lit("x"), F.lit("y"))
    assert spark.range(1).select(k1, k2).collect()[0][:] == ("__GLOBAL__", "__GLOBAL__")


def test_keys_stay_over_loads(spark, tmp_path):
    from cantora.sources.store import Store
    m = keys.KeyMap(Store(spark, f"{tmp_path}/keys"), ["a", "b"], "sk")

    def load(rows, version):
        return {(r.a, r.b): r.sk for r in m.keyed(spark.createDataFrame(rows, "a int, b string"), version).collect()}

    one = load([(3, "x"), (1, None), (2, "y"), (2, "y"), (None, "z")], {"v": 1})
    assert one == {(None, "z"): 1, (1, None): 2, (2, "y"): 3, (3, "x"): 4}
    assert load([(9, "unread")], {"v": 1}) == one                      # the same version is not looked at again
    two = load([(3, "x"), (0, "new"), (1, None), (5, "new")], {"v": 2})
    assert two == {(1, None): 2, (3, "x"): 4, (0, "new"): 5, (5, "new"): 6}
    assert load([(2, "y"), (None, "z"), (7, "q")], {"v": 3}) == {(None, "z"): 1, (2, "y"): 3, (7, "q"): 7}
    assert load([], {"v": 4}) == {}


def test_profile_of_any_table(spark):
    from cantora.operators.profile import profiles
    df = spark.createDataFrame([(k, k // 2, None if k == 3 else k, f"t{k:05}", None) for k in range(5000)], "id long, half int, `odd name` int, s string, none double")
    got = {r.column_name: r for r in profiles({"t": df, "empty": df.limit(0)}).where("table_name = 't'").collect()}
    assert {c for c, r in got.items() if r.is_key} == {"id", "s"} and {c for c, r in got.items() if r.has_nulls} == {"odd name", "none"}
    assert got["s"].max_value == "t04999" and got["none"].min_value is None and got["odd name"].nulls == 1
    assert abs(got["half"].approx_distinct - 2500) < 100
    near = spark.range(5000).select(F.when(F.col("id") == 77, 78).otherwise(F.col("id")).alias("v"))     # one value twice: no key
    assert not profiles({"near": near}).first().is_key


def test_relationships_count_null_keys_apart(spark):
    from cantora.plans.quality import fk_orphans
    child = spark.createDataFrame([("1", "2024-01-01"), (" 01 ", "2024-01-01"), (None, None), ("9", "2024-01-02"), ("x1", "2024-01-02")] + [("2", "2024-01-01")] * 50, "p string, d string")
    edges = [("p", "dim_p", "id"), ("d", "dim_d", "d")]
    dims = {"dim_p": spark.createDataFrame([(1,), (2,), (2,)], "id int"), "dim_d": spark.sql("SELECT DATE'2024-01-01' AS d")}
    got = {(r.child, r.column_name): (r.child_rows, r.null_keys, r.orphans, r.ok) for r in fk_orphans({"a": (child, edges), "b": (child.limit(0), edges)}, dims).collect()}
    assert got == {("a", "p"): (55, 1, 2, False), ("a", "d"): (55, 1, 2, False)}
