"""Queries on rows that only larger tables have."""

import os

from compare import connect, differences
from pyspark.sql import functions as F

from starfold.checks.oracles import ORACLES
from starfold.checks.queries import QUERIES
from starfold.checks.staged_views import staged
from starfold.operators.lookup import hot_keys
from starfold.plans.refresh import Warehouse
from starfold.plans.specs import BY_NAME
from starfold.sources.files import write_json
from starfold.sources.store import Store

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events"


def moved(folder, **changed):
    """The smallest tables in `folder`, those named with other columns (as SQL of DuckDB's `replace`)."""
    con = connect(SF)
    for table in TABLES.split():
        columns = f"* replace ({changed[table]})" if table in changed else "*"
        con.execute(f"copy (select {columns} from {table}) to '{folder}/{table}.parquet' (format parquet)")
    for table in TABLES.split():
        con.execute(f"create or replace view {table} as select * from '{folder}/{table}.parquet'")
    return con


def test_a_number_beyond_the_coordinates_is_null(spark, folder):
    moved(folder, lineitem="l_suppkey + 9995 as l_suppkey")
    found = {r.as_coordinate for r in QUERIES["safe_casts"](spark, folder).select("as_coordinate").distinct().collect()}
    assert None in found and len(found) > 1


BEYOND = {"part": "p_partkey + 50000 as p_partkey", "supplier": "s_suppkey + 4000 as s_suppkey"}


def test_rows_of_days_beyond_the_calendar_count(spark, folder):
    con = moved(folder, **BEYOND)
    for name in (
        "capital_to_exit declared_rules exit_comparison fk_violations_of_facts fund_history ipo_valuation_by_year "
        "late_arriving_companies list_tables validation_report run_log_summary"
    ).split():
        assert differences(QUERIES[name](spark, folder), con, ORACLES[name]) is None, name


def test_days_beyond_the_calendar_are_listed_when_loaded(spark, folder):
    moved(folder, **BEYOND)
    warehouse = Warehouse(spark, f"{folder}/warehouse", load_all_days=True)
    warehouse.refresh_calendar()
    warehouse.refresh_table(BY_NAME["dim_company"], staged(spark, folder, "company"))
    warehouse.refresh_table(BY_NAME["fact_funds"], staged(spark, folder, "funds"))
    listed = {r.value for r in warehouse.broken_references().collect()}
    later = {r.funded_at for r in warehouse.table("fact_funds").filter("funded_at > 21001231").collect()}
    assert later and listed == later
    assert [r.n_rejected for r in warehouse.log.read().filter("process = 'load' and table_name = 'fact_funds'").collect()] == [0]


def test_only_keys_of_full_hashes_are_counted(spark):
    rows = spark.range(200_000).select(F.when(F.col("id") % 4 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"))
    rows = rows.unionByName(spark.range(100).select(F.lit(None).cast("long").alias("k")))
    hot = hot_keys(rows, ["k"], 20_000)
    assert [(r.k, r._parts) for r in hot.collect()] == [(7, 3)]
    plan = hot._jdf.queryExecution().executedPlan().toString()
    counted = plan[: plan.index("BroadcastExchange")]
    assert "LeftSemi" in counted and "keys=[k#" in counted


def test_joined_partitions_are_small_unless_the_session_says_otherwise(spark, folder):
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name, None)
    try:
        spark.conf.unset(name)
        Store(spark, folder)
        assert spark.conf.get(name) == str(16 * 1024 * 1024)
        spark.conf.set(name, "32m")
        Store(spark, folder)
        assert spark.conf.get(name) == "32m"
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def test_reports_are_packed(spark, folder):
    write_json(spark.range(10).select("id", F.lit(None).cast("string").alias("none")), f"{folder}/report")
    assert [n for n in os.listdir(f"{folder}/report") if n.startswith("part-") and not n.endswith(".json.gz")] == []
    assert spark.read.json(f"{folder}/report").count() == 10
