"""Versioned tables: commits, races, months replaced, batches landed once."""
import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from cantora.operators import params as P
from cantora.sources import raw as R
from cantora.sources.store import LostRace, Store, derive, land_batch, ledger, month_of, publish, put_new
from cantora.sources.warehouse import Warehouse

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def days(spark, path, spec):
    df = spark.createDataFrame([(dt.date.fromisoformat(d), v) for d, v in spec], "d date, v long").coalesce(1)
    df.write.mode("append").parquet(path)


def test_put_new_never_overwrites(spark, tmp_path):
    p = f"file://{tmp_path}/a/x.json"
    assert put_new(spark, p, "one") and not put_new(spark, p, "two")
    assert open(f"{tmp_path}/a/x.json").read() == "one"


def test_a_new_month_rebuilds_that_month_only(spark, tmp_path):
    src, built = f"{tmp_path}/in", []
    days(spark, src, [("2024-01-03", 1), ("2024-02-05", 2)])
    store, child = Store(spark, f"{tmp_path}/t"), Store(spark, f"{tmp_path}/m")

    def build(months):
        built.append(months)
        df = spark.read.parquet(src)
        return df if months is None else df.where(month_of(F.col("d")).isin(*months))

    def up():
        return publish(store, src, "d", [], build, "d")

    def sums(m):
        return derive(child, m, lambda months: store.read(m, months).groupBy(F.trunc("d", "month").alias("m")).agg(F.sum("v").alias("v")), lambda: month_of(F.col("m")))

    one = up()
    assert up() == one and built == [None]                       # unchanged inputs: nothing is built
    first = sums(one)
    days(spark, src, [("2024-03-01", 5), ("2024-03-09", 6)])
    two = up()
    assert built == [None, ["2024-03-01"]] and two["version"] == 2
    assert two["parts"]["2024-01-01"] == one["parts"]["2024-01-01"]
    assert rows(store.read(one)) == rows(spark.read.parquet(src).where("d < '2024-03-01'"))    # the old version still stands
    assert rows(store.read()) == rows(spark.read.parquet(src))
    days(spark, src, [("2024-02-20", 10)])
    three = up()
    assert three["touched"] == ["2024-02-01"]
    second = sums(three)
    assert second["touched"] == ["2024-02-01", "2024-03-01"] and second["parts"]["2024-01-01"] == first["parts"]["2024-01-01"]
    assert rows(child.read()) == [(dt.date(2024, 1, 1), 1), (dt.date(2024, 2, 1), 12), (dt.date(2024, 3, 1), 11)]


def test_a_removed_file_takes_its_rows_away_and_a_lookup_rebuilds_all(spark, tmp_path):
    src, look = f"{tmp_path}/in", f"{tmp_path}/look"
    for k, spec in enumerate(([("2024-01-03", 1)], [("2024-02-05", 2), (None, 9)])):
        spark.createDataFrame([(dt.date.fromisoformat(d) if d else None, v) for d, v in spec], "d date, v long").coalesce(1).write.parquet(f"{src}/f{k}")
    spark.range(1).coalesce(1).write.parquet(look)
    store = Store(spark, f"{tmp_path}/t")

    def build(df):
        return lambda months: df if months is None else df.where(month_of(F.col("d")).isin(*months))

    m = publish(store, src + "/f1", "d", [look], build(spark.read.parquet(f"{src}/f1")), "d")
    assert sorted(m["parts"]) == ["2024-02-01", "none"]
    spark.range(2).coalesce(1).write.mode("append").parquet(look)
    assert publish(store, src + "/f1", "d", [look], build(spark.read.parquet(f"{src}/f1")), "d")["touched"] is None
    spark.createDataFrame([(dt.date(2024, 5, 1), 4)], "d date, v long").coalesce(1).write.mode("overwrite").parquet(f"{src}/f1")
    m = publish(store, src + "/f1", "d", [look], build(spark.read.parquet(f"{src}/f1")), "d")
    assert m["touched"] == ["2024-02-01", "2024-05-01", "none"] and sorted(m["parts"]) == ["2024-05-01"]
    assert rows(store.read()) == [(dt.date(2024, 5, 1), 4)]


def test_a_batch_lands_once_and_the_ledger_has_it(spark, tmp_path):
    store, calls = Store(spark, f"{tmp_path}/raw"), []

    def batch(n, ts):
        calls.append(n)
        return spark.range(n).select(F.col("id").cast("string").alias("cell"), F.lit(ts).cast("timestamp_ntz").alias("raw_ingest_ts"))

    for _ in range(2):
        land_batch(store, "b1", lambda: batch(3, "2024-01-01 10:00:00"), "b1.csv")
        land_batch(store, "b2", lambda: batch(4, "2024-01-01 12:30:00"), "b2.csv")
    assert calls == [3, 4] and store.read().count() == 7
    land_batch(store, "b3", lambda: batch(2, "2024-01-02 00:00:00.25"), "b3.csv", replace=True)
    assert store.read().count() == 2
    led = ledger(spark, {"t_raw": store}).orderBy("batch_id").collect()
    assert [(r.batch_id, r.n_rows, str(r.raw_ingest_ts)) for r in led] == [
        ("b1", 3, "2024-01-01 10:00:00"), ("b2", 4, "2024-01-01 12:30:00"), ("b3", 2, "2024-01-02 00:00:00.250000")]
    with pytest.raises(ValueError):
        land_batch(store, "b4", lambda: (_ for _ in ()).throw(ValueError("feed broke")), "b4.csv")
    assert store.version() == 3


def _params(spark, level, key, alpha, stamp):
    return spark.createDataFrame([(level, key, "__ALL__", alpha, -0.1, None, None, dt.datetime.fromisoformat(stamp), "OLS", 0)], P.SCHEMA)


def test_writers_at_the_same_time_lose_no_row(spark, tmp_path):
    table, errors = P.ParamTable(Store(spark, f"{tmp_path}/params")), []
    gate = threading.Barrier(4)

    def writer(k):
        try:
            gate.wait()
            for j in range(3):
                table.save(_params(spark, "brand", f"B{k}{j}", k + j / 10, "2025-01-01T00:00:00"))
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    threads = [threading.Thread(target=writer, args=(k,)) for k in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not errors and table.store.version() == 12
    assert {r.scope_key1 for r in table.rows().collect()} == {f"B{k}{j}" for k in range(4) for j in range(3)}
    table.save(_params(spark, "brand", "B00", 9.0, "2025-01-02T00:00:00"))
    table.save(_params(spark, "brand", "B00", 1.0, "2024-01-02T00:00:00"))      # older than what is saved
    assert table.lookup("brand", "B00").first().alpha == 9.0 and table.lookup("brand", "none").count() == 0
    assert table.rows().count() == 12


def test_lost_races_end_with_an_error(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/t")

    def change(old):
        store.commit(store.version(), {"parts": {}})     # another writer is always first
        return {"parts": {}}

    with pytest.raises(LostRace):
        store.update(change, attempts=3)


def test_queries_read_what_was_landed(spark, tmp_path):
    w = Warehouse(spark, SF, root=f"file://{tmp_path}/w")
    w.build_raw()
    before = {r.table_name: (r.batch_id, r.raw_ingest_ts) for r in w.ledger().collect()}
    assert len({ts for _, ts in before.values()}) == 4
    star = Warehouse(spark, SF, root=f"file://{tmp_path}/w").star()
    plan = R.stg_sales(R.raw_frame(star, "sales"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "Exchange" not in plan
    assert {r.table_name: (r.batch_id, r.raw_ingest_ts) for r in w.ledger().collect()} == before
    assert w.store("raw_sales").version() == 1
