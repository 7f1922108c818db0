import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from orderloom.config import RunConfig
from orderloom.operators import merge
from orderloom.plans import models, warehouse
from orderloom.schemas import RAW_ORDERS, TABLES
from orderloom.sources import testtables
from orderloom.sources.ledger import load_new_files, loaded_files
from orderloom.sources.staging import discard, shared_dir, stage
from orderloom.sources.tables import LayerTables
from orderloom.streaming import incremental

SF = "/root/testdata/sf0.001"
NOW = datetime(2024, 1, 1)


@pytest.fixture()
def tables(spark, tmp_path):
    t = LayerTables(spark, str(tmp_path / "lake"), prefix=f"x{abs(hash(str(tmp_path)))}_")
    t.create_layers()
    return t


def test_staging_uses_the_named_folder(spark):
    staged = stage(spark.range(3).withColumn("t", F.lit(NOW).cast("timestamp_ntz")), "x")
    assert staged.inputFiles()[0].replace("file://", "").startswith(shared_dir(spark).replace("file:", "").rstrip("/"))
    assert staged.count() == 3 and dict(staged.dtypes)["t"] == "timestamp_ntz"


def test_refresh_from_itself_and_append(spark, tables):
    days = spark.createDataFrame([(date(2020, 1, 1), 1)], "order_date date, orders bigint")
    tables.replace("gold.kpi_daily_revenue", days)
    for _ in range(3):
        tables.replace("gold.kpi_daily_revenue", tables.read("gold.kpi_daily_revenue").withColumn("orders", F.col("orders") + 1))
    tables.append("gold.kpi_daily_revenue", days)
    tables.append("gold.kpi_daily_revenue", days.filter("orders < 0"))
    assert sorted(r["orders"] for r in tables.read("gold.kpi_daily_revenue").collect()) == [1, 4]
    assert tables.read("gold.kpi_daily_revenue").schema == TABLES["gold.kpi_daily_revenue"]


def _days(spark, n):
    return spark.createDataFrame([(date(2020, 1, 1), n)], "order_date date, orders bigint")


def test_two_versions_are_kept(spark, tables, tmp_path):
    name = "gold.kpi_daily_revenue"
    for n in range(5):
        tables.replace(name, _days(spark, n))
    folder = tmp_path / "lake" / "gold" / "kpi_daily_revenue"
    assert len(tables.versions(name)) == len(list(folder.glob("v-*"))) == 2
    tables.drop_old_versions(name)
    assert len(list(folder.glob("v-*"))) == 1
    assert [r["orders"] for r in tables.read(name).collect()] == [4]


def test_a_reader_of_a_leased_version_still_finishes(spark, tables, tmp_path):
    name, folder = "gold.kpi_daily_revenue", tmp_path / "lake" / "gold" / "kpi_daily_revenue"
    tables.replace(name, _days(spark, 100))
    with tables.leased(name) as frame:
        for n in range(5):
            tables.replace(name, _days(spark, n))
        assert [r["orders"] for r in frame.collect()] == [100]
        assert len(list(folder.glob("v-*"))) == 3
    tables.replace(name, _days(spark, 5))
    assert len(list(folder.glob("v-*"))) == len(tables.versions(name)) == 2


def test_a_lease_that_ran_out_holds_nothing(spark, tables):
    name = "gold.kpi_daily_revenue"
    tables.replace(name, _days(spark, 100))
    with tables.leased(name, hours=0):
        for n in range(4):
            tables.replace(name, _days(spark, n))
        assert len(tables.versions(name)) == 2


def _orders(spark, rows):
    return spark.createDataFrame(rows, "order_id string, order_status string")


def _files(tmp_path, name):
    return {p: p.stat().st_mtime_ns for p in (tmp_path / "lake" / name.replace(".", "/")).rglob("*.parquet")}


def _by_id(tables):
    return {r["order_id"]: (r["order_status"], r["updated_at"]) for r in tables.read("silver.orders").collect()}


def test_a_delivery_rewrites_its_buckets_only(spark, tables, tmp_path):
    later = datetime(2025, 1, 1)
    tables.upsert("silver.orders", _orders(spark, [(f"o{i}", "created") for i in range(200)]), ["order_id"], run_ts=NOW)
    before, parts = _files(tmp_path, "silver.orders"), tables.manifest("silver.orders")["parts"]
    assert len(parts) == 16
    tables.upsert("silver.orders", _orders(spark, [("o7", "delivered")]), ["order_id"], run_ts=later)
    now = tables.manifest("silver.orders")["parts"]
    assert sum(now[p] != parts[p] for p in parts) == 1 and set(now) == set(parts)
    after = _files(tmp_path, "silver.orders")
    kept = {p for p in before if not any(str(p).startswith(parts[b].replace("file:", "")) for b in parts if now[b] != parts[b])}
    assert {p: after[p] for p in kept} == {p: before[p] for p in kept} and len(kept) >= 15
    rows = _by_id(tables)
    assert len(rows) == 200 and rows.pop("o7") == ("delivered", later) and set(rows.values()) == {("created", NOW)}
    plan = tables.read("silver.orders")._jdf.queryExecution().toString()
    assert "_bucket" in plan and "_bucket" not in tables.read("silver.orders").columns


def test_keyless_rows_have_a_bucket_of_their_own(spark, tables):
    for k in range(2):
        tables.upsert("silver.orders", _orders(spark, [("o1", f"s{k}"), (None, f"lost{k}"), (None, f"lost{k}")]), ["order_id"], run_ts=NOW)
    rows = sorted(((r["order_id"], r["order_status"]) for r in tables.read("silver.orders").collect()), key=repr)
    assert rows == [("o1", "s1"), (None, "lost0"), (None, "lost0"), (None, "lost1"), (None, "lost1")]
    assert "-1" in tables.manifest("silver.orders")["parts"]


def test_another_session_finds_the_newest_version(spark, tables):
    tables.upsert("silver.orders", _orders(spark, [("o1", "created"), ("o2", "created")]), ["order_id"], run_ts=NOW)
    tables.replace("gold.kpi_daily_revenue", _days(spark, 8))
    again = LayerTables(spark, tables.root, prefix=tables.prefix + "again_")
    again.create_layers()
    for name in ("silver.orders", "gold.kpi_daily_revenue"):
        again.create_table(name)
    assert _by_id(again) == _by_id(tables)
    assert [r["orders"] for r in again.read("gold.kpi_daily_revenue").collect()] == [8]


def test_discard_deletes_only_the_staged_frame(spark):
    a, b = stage(spark.range(3), "a"), stage(spark.range(4), "b")
    discard(a)
    assert b.count() == 4
    with pytest.raises(Exception, match="FAILED_READ_FILE|PATH_NOT_FOUND|does not exist"):
        a.collect()


def test_nan_and_zone_are_dropped_on_the_way_in(spark, tables):
    row = spark.createDataFrame([("m", float("nan"))], "model_name string, metric_value double")
    tables.append("ml.model_metrics", row.withColumn("run_ts", F.lit(NOW)))
    stored = tables.read("ml.model_metrics").first()
    assert stored["metric_value"] is None and stored["run_ts"] == NOW and stored["notes"] is None


def test_columns_are_added_once(spark, tables):
    old = spark.createDataFrame([("c1", "town")], "customer_id string, customer_city string")
    tables.create_table("silver.customers", old.schema)
    tables.append("silver.customers", old)
    for _ in range(2):
        tables.create_table("silver.customers")
    got = tables.read("silver.customers")
    assert set(got.columns) == set(TABLES["silver.customers"].names)
    assert got.first()["customer_unique_id"] is None and got.first()["customer_city"] == "town"


def test_create_all_is_repeatable(tables):
    for _ in range(2):
        tables.create_all()
    assert all(tables.read(n).schema == s for n, s in TABLES.items())


@pytest.fixture(scope="module")
def raw_files(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("raw"))
    items = merge.latest_per_key(testtables.bronze_order_items(spark, SF), merge.ORDER_ITEMS_KEY, ())
    frames = {
        "orders": testtables.bronze_orders(spark, SF),
        "order_items": items.select(testtables.bronze_order_items(spark, SF).columns),
        "customers": testtables.bronze_customers(spark, SF),
    }
    for name, df in frames.items():
        df.write.option("header", True).option("compression", "gzip").csv(f"{folder}/{name}_dataset.csv")
    return folder


def test_warehouse_then_models(spark, tables, raw_files):
    # The smallest tables hold few repeat buyers, so one order is enough to be active.
    cfg = RunConfig(raw_path=raw_files, run_ts=NOW, min_orders_lifetime=1)
    args = (spark, tables.root, cfg, tables.prefix)
    first = {r["obj"]: r["row_count"] for r in warehouse.run_warehouse(*args, fail_on_dq=True).layer_counts.collect()}
    gold = tables.read("gold.kpi_customer_rfm").collect()
    again = {r["obj"]: r["row_count"] for r in warehouse.run_warehouse(*args, load=False).layer_counts.collect()}
    assert first == again and all(first.values())
    assert sorted(gold) == sorted(tables.read("gold.kpi_customer_rfm").collect())
    view, table = tables.read("gold.v_kpi_monthly_revenue"), tables.read("gold.kpi_monthly_revenue")
    assert sorted(view.collect()) == sorted(table.collect())

    models.evaluate_baseline(tables, cfg)
    before = set(os.listdir(shared_dir(spark).replace("file:", "")))
    run = models.train_and_register(tables, cfg)
    assert set(os.listdir(shared_dir(spark).replace("file:", ""))) <= before  # staged frames went with the run
    status = {r["model_name"]: r["status"] for r in tables.read("ml.model_registry").collect()}
    assert len(status) == 2 and status.pop(run.best) == "CHAMPION" and set(status.values()) == {"CHALLENGER"}
    names = {(r["model_name"], r["split_name"]) for r in tables.read("ml.model_metrics").collect()}
    assert {("churn_baseline", None), ("logreg_calibrated_ext", "holdout_ext"), (run.best, "holdout"), (run.best, "cv_fold_1")} <= names
    folds = {m: len([s for n, s in names if n == m and s.startswith("cv_fold")]) for m in ("logreg_calibrated", "hgb_challenger")}
    assert folds["logreg_calibrated"] == folds["hgb_challenger"] > 40
    scores = tables.read("ml.customer_repeat_score")
    assert scores.filter("churn_score between 0 and 1").count() == scores.count() > 0
    assert tables.read("ml.model_calibration_diagnostics").agg(F.sum("sample_size")).first()[0] > 0
    assert run.registry.count() == 2 and run.deciles.select("model_name").distinct().count() == 2


def test_new_files_are_merged_once(spark, tables, tmp_path):
    tables.create_table("silver.orders")
    folder = tmp_path / "in"
    folder.mkdir()
    header = "a,b,c,d,e,f,g,h\n"

    def deliver(name, *rows):
        (folder / name).write_text(header + "".join(f"{o},c,{s},2020-01-01 00:00:00,,,,\n" for o, s in rows))
        incremental.merge_new_orders(tables, str(folder), str(tmp_path / "progress"), run_ts=NOW).awaitTermination()
        return {r["order_id"]: r["order_status"] for r in tables.read("silver.orders").collect()}

    assert deliver("1_orders_dataset.csv", ("o1", "created"), ("o2", "created")) == {"o1": "created", "o2": "created"}
    assert deliver("2_orders_dataset.csv", ("o2", "delivered"), ("o3", "created")) == {
        "o1": "created", "o2": "delivered", "o3": "created",
    }


def test_newest_file_wins_and_keyless_orders_stay(spark, tables, tmp_path):
    tables.create_table("silver.orders")
    folder = tmp_path / "in"
    folder.mkdir()
    header = "a,b,c,d,e,f,g,h\n"
    for k, (name, rows) in enumerate(
        (("1_orders_dataset.csv", ("o1,c,shipped", ",c,lost1")), ("2_orders_dataset.csv", ("o1,c,delivered", ",c,lost2")))
    ):
        path = folder / name
        path.write_text(header + "".join(f"{r},2020-01-01 00:00:00,,,,\n" for r in rows))
        os.utime(path, (1_600_000_000 + 60 * k,) * 2)
    incremental.merge_new_orders(tables, str(folder), str(tmp_path / "progress"), run_ts=NOW).awaitTermination()
    rows = [(r["order_id"], r["order_status"]) for r in tables.read("silver.orders").collect()]
    assert sorted(rows, key=repr) == [("o1", "delivered"), (None, "lost1"), (None, "lost2")]


def test_the_stream_rewrites_the_delivered_buckets_only(spark, tables, tmp_path):
    tables.upsert("silver.orders", _orders(spark, [(f"o{i}", "created") for i in range(100)]), ["order_id"], run_ts=NOW)
    parts = tables.manifest("silver.orders")["parts"]
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "1_orders_dataset.csv").write_text("a,b,c,d,e,f,g,h\no5,c,delivered,2020-01-01 00:00:00,,,,\n")
    incremental.merge_new_orders(tables, str(folder), str(tmp_path / "progress"), run_ts=NOW).awaitTermination()
    now = tables.manifest("silver.orders")["parts"]
    assert sum(now[p] != parts[p] for p in parts) == 1
    assert _by_id(tables)["o5"][0] == "delivered" and len(_by_id(tables)) == 100


def _order_file(folder, name, *ids):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("a,b,c,d,e,f,g,h\n" + "".join(f"{i},c,created,2020-01-01 00:00:00,,,,\n" for i in ids))


def _load(tables, folder, **options):
    return load_new_files(tables, "bronze.orders_raw", f"{folder}/*orders_dataset.csv*", RAW_ORDERS, NOW, **options)


def _ids(tables):
    return sorted(r["order_id"] for r in tables.read("bronze.orders_raw").collect())


def test_a_file_enters_bronze_once(spark, tables, tmp_path):
    folder = tmp_path / "in"
    _order_file(folder, "1_orders_dataset.csv", "o1", "o2")
    assert [_load(tables, folder), _load(tables, folder)] == [1, 0] and _ids(tables) == ["o1", "o2"]
    _order_file(folder, "2_orders_dataset.csv", "o3")
    assert _load(tables, folder) == 1 and _ids(tables) == ["o1", "o2", "o3"]
    _order_file(folder, "2_orders_dataset.csv", "o3", "o4")  # the same name, another length
    assert _load(tables, folder) == 1 and _ids(tables) == ["o1", "o2", "o3", "o3", "o4"]
    assert _load(tables, folder, force=True) == 2 and len(_ids(tables)) == 9
    assert _load(tables, folder, replace=True) == 2 and _ids(tables) == ["o1", "o2", "o3", "o4"]
    assert _load(tables, folder) == 0
    ledger = loaded_files(tables, "bronze.orders_raw")
    assert sorted(os.path.basename(r["file_path"]) for r in ledger.collect()) == ["1_orders_dataset.csv", "2_orders_dataset.csv"]


def test_a_load_that_broke_off_is_done_again(spark, tables, tmp_path, monkeypatch):
    folder = tmp_path / "in"
    _order_file(folder, "1_orders_dataset.csv", "o1")

    def broken(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(LayerTables, "add_load", broken)
        with pytest.raises(RuntimeError, match="lost"):
            _load(tables, folder)
    assert _ids(tables) == [] and loaded_files(tables, "bronze.orders_raw").count() == 0
    assert _load(tables, folder) == 1 and _ids(tables) == ["o1"]


def test_a_repeated_run_loads_nothing_twice(spark, tables, raw_files):
    cfg = RunConfig(raw_path=raw_files, run_ts=NOW)
    args = (spark, tables.root, cfg, tables.prefix)
    warehouse.run_warehouse(*args, append_bronze=True)
    once, silver = tables.read("bronze.orders_raw").count(), tables.read("silver.orders").count()
    warehouse.run_warehouse(*args, append_bronze=True)
    assert tables.read("bronze.orders_raw").count() == once and tables.read("silver.orders").count() == silver
    warehouse.run_warehouse(*args, append_bronze=True, force_load=True, on_duplicate="latest")
    assert tables.read("bronze.orders_raw").count() == 2 * once and tables.read("silver.orders").count() == silver
