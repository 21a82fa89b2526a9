import datetime

import pytest
from pyspark.sql import functions as F

from starfold.operators.upsert import DuplicateKeys
from starfold.plans import runlog
from starfold.plans.marts import Dimension, build, investee_mismatches, rounds_of, stage_database_rows
from starfold.plans.refresh import Warehouse, landed, stage
from starfold.plans.runlog import RunLog
from starfold.plans.specs import BY_NAME, PARTICIPATION, RULES, TableSpec
from starfold.sources.files import created_on_day_before
from starfold.sources.store import Store

COLUMNS = {
    "company": "office_id object_id description region city state_code country_code latitude longitude created_at",
    "people": "people_id object_id first_name last_name affiliation_name birthplace created_at",
    "relationships": "relationship_id person_object_id relationship_object_id title start_at end_at is_past sequence created_at",
    "acquisition": "acquisition_id acquiring_object_id acquired_object_id acquired_at price_amount price_currency_code term_code created_at",
    "funding_rounds": "funding_round_id object_id funded_at funding_round_type funding_round_code raised_amount_usd pre_money_valuation_usd post_money_valuation_usd participants is_first_round is_last_round created_at",
    "investments": "investment_id funding_round_id funded_object_id investor_object_id created_at",
    "funds": "fund_id object_id funded_at name raised_amount raised_currency_code created_at",
    "ipos": "ipo_id object_id public_at valuation_currency_code raised_currency_code valuation_amount raised_amount stock_symbol created_at",
    "milestones": "milestone_id object_id milestone_at description milestone_code created_at",
}
D1, D2 = "2010-01-01 08:00:00.000", "2010-01-02 09:00:00.000"


def frame(spark, table, rows):
    names = COLUMNS[table].split()
    data = [tuple(row.get(n) for n in names) for row in rows]
    return spark.createDataFrame(data, ", ".join(f"{n} string" for n in names))


def day_one():
    return {
        "company": [
            dict(office_id="1", object_id="c:1", city="Bonn", latitude="50.5", created_at=D1),
            dict(office_id="2", object_id="c:2", created_at=D1),
            dict(office_id="3", object_id="c:2", city="Second office", created_at=D1),
        ],
        "people": [dict(people_id="1", object_id="p:1", first_name="A", created_at=D1)],
        "relationships": [
            dict(relationship_id="1", person_object_id="p:1", relationship_object_id="c:1", start_at="2009-01-01 00:00:00.000", is_past="TRUE", created_at=D1),
            dict(relationship_id="2", person_object_id="p:9", relationship_object_id="c:1", start_at="2009-01-01", created_at=D1),
        ],
        "acquisition": [dict(acquisition_id="1", acquiring_object_id="c:1", acquired_object_id="c:2", acquired_at="2009-05-06", price_amount="10.555", created_at=D1)],
        "funding_rounds": [dict(funding_round_id="1", object_id="c:1", funded_at="2008-01-01", raised_amount_usd="100", is_first_round="t", created_at=D1)],
        "investments": [
            dict(investment_id="1", funding_round_id="1", investor_object_id="c:2", funded_object_id="c:1", created_at=D1),
            dict(investment_id="2", funding_round_id="77", investor_object_id="c:2", funded_object_id="c:9", created_at=D1),
            dict(investment_id="3", investor_object_id="c:1", created_at=D1),
        ],
        "funds": [dict(fund_id="1", object_id="c:1", name="F", raised_amount="5", created_at=D1)],
        "ipos": [dict(ipo_id="1", object_id="c:2", public_at="1850-01-01", created_at=D1), dict(ipo_id="2", object_id="c:2", public_at="2010-02", created_at=D1)],
        "milestones": [dict(milestone_id="1", object_id="c:1", milestone_at="bad", description="x", created_at=D1)],
    }


def day_two():
    """New rows, and changed rows that carry the second day's date."""
    return {
        "company": [dict(office_id="1", object_id="c:1", city="Köln", created_at=D2), dict(office_id="9", object_id="c:9", created_at=D2)],
        "people": [dict(people_id="1", object_id="p:1", first_name="A", last_name="B", created_at=D2), dict(people_id="2", object_id="p:9", created_at=D2)],
        "relationships": [],
        "acquisition": [dict(acquisition_id="1", acquiring_object_id="c:1", acquired_object_id="c:9", acquired_at="2009-05-07", created_at=D2), dict(acquisition_id="2", acquiring_object_id="c:9", created_at=D2)],
        "funding_rounds": [dict(funding_round_id="77", object_id="c:9", funded_at="2009-01-01", raised_amount_usd="7", created_at=D2)],
        "investments": [dict(investment_id="4", funding_round_id="1", investor_object_id="c:9", created_at=D2)],
        "funds": [],
        "ipos": [dict(ipo_id="3", object_id="c:9", public_at="2010-03-03", created_at=D2)],
        "milestones": [dict(milestone_id="1", object_id="c:1", milestone_at="2009-09-09", created_at=D2)],
    }


def staged_frames(staging, tables):
    return {t: staging.read(t) for t in tables if staging.current(t)}


def stage_all(spark, staging, log, data, run_date=None):
    for table, records in data.items():
        stage(staging, log, table, stage_database_rows(frame(spark, table, records)), "source", run_date)


def contents(warehouse, as_rows):
    """Table rows with surrogate ids replaced by natural keys."""
    company = {r.company_id: r.company_nk for r in warehouse.table("dim_company").collect()}
    people = {r.people_id: r.people_nk for r in warehouse.table("dim_people").collect()}
    found = {}
    for name in (*BY_NAME, PARTICIPATION):
        if name.startswith("temp_"):
            continue
        spec = BY_NAME.get(name)
        own = spec.surrogate if isinstance(spec, TableSpec) else "investment_round_participation_id"
        df = warehouse.table(name).drop("created_at", own)
        rows = []
        for row in df.collect():
            values = row.asDict()
            for column in values:
                if column.endswith("company_id"):
                    values[column] = company.get(values[column])
                if column == "people_id":
                    values[column] = people.get(values[column])
            rows.append(tuple(sorted((k, str(v)) for k, v in values.items())))
        found[name] = sorted(rows)
    return found


def test_two_days_equal_a_full_rebuild(spark, folder, as_rows):
    daily = Warehouse(spark, f"{folder}/daily")
    staging = Store(spark, f"{folder}/staging")
    stage_all(spark, staging, daily.log, day_one())
    daily.refresh_all(staged_frames(staging, COLUMNS))
    ids = {r.company_nk: r.company_id for r in daily.table("dim_company").collect()}
    assert ids == {"c:1": 1, "c:2": 2}

    stage_all(spark, staging, daily.log, day_two(), run_date="2010-01-03")
    daily.refresh_all(staged_frames(staging, COLUMNS), run_date="2010-01-03")
    later = {r.company_nk: r.company_id for r in daily.table("dim_company").collect()}
    assert later == {"c:1": 1, "c:2": 2, "c:9": 3}

    full = Warehouse(spark, f"{folder}/full")
    full.refresh_all(staged_frames(staging, COLUMNS))
    assert contents(daily, as_rows) == contents(full, as_rows)

    acquisition = {r.acquisition_nk: r for r in daily.table("fact_acquisition").collect()}
    assert acquisition[1].acquired_at == 20090507 and acquisition[1].price_amount is None
    participation = {r.investment_nk: r for r in daily.table(PARTICIPATION).collect()}
    assert participation[2].investee_company_id == 3 and participation[3].funded_at is None
    # Relationships are always rebuilt whole, so a person who arrives later is found.
    assert daily.table("fact_relationships").filter("relationship_nk = 2").first().people_id == 2


def test_late_company_of_an_unchanged_row_needs_a_full_run(spark, folder):
    """A lookup that fails stays NULL until the row itself is refreshed."""
    warehouse = Warehouse(spark, folder)
    funds = [dict(fund_id="1", object_id="c:5", created_at=D1)]
    company = [dict(office_id="1", object_id="c:5", created_at=D2)]
    warehouse.refresh_calendar()
    warehouse.refresh_table(BY_NAME["dim_company"], frame(spark, "company", [dict(object_id="c:1", created_at=D1)]))
    warehouse.refresh_table(BY_NAME["fact_funds"], frame(spark, "funds", funds))
    assert warehouse.table("fact_funds").first().company_id is None
    warehouse.refresh_table(BY_NAME["dim_company"], frame(spark, "company", company), "2010-01-03")
    warehouse.refresh_table(BY_NAME["fact_funds"], frame(spark, "funds", funds))
    assert warehouse.table("fact_funds").first().company_id == 2


def test_a_waiting_row_is_repaired_by_the_next_daily_run(spark, folder):
    warehouse = Warehouse(spark, folder)
    warehouse.refresh_calendar()
    spec = BY_NAME["fact_funds"]
    funds = [dict(fund_id="1", object_id="c:5", name="old", created_at=D1), dict(fund_id="2", created_at=D1), dict(fund_id="3", object_id="c:6", created_at=D1)]
    warehouse.refresh_table(BY_NAME["dim_company"], frame(spark, "company", [dict(object_id="c:1", created_at=D1)]))
    warehouse.refresh_table(spec, frame(spark, "funds", funds), "2010-01-02")
    assert {r.fund_nk: r.company_id for r in warehouse.table("fact_funds").collect()} == {1: None, 2: None, 3: None}
    assert sorted(r.fund_id for r in warehouse.table("pending_fact_funds").collect()) == ["1", "3"]
    # The company comes with a day on which no fund is staged.
    warehouse.refresh_table(BY_NAME["dim_company"], frame(spark, "company", [dict(object_id="c:5", created_at=D2)]), "2010-01-03")
    warehouse.refresh_table(spec, frame(spark, "funds", funds), "2010-01-03")
    found = {r.fund_nk: (r.fund_id, r.company_id, r.fund_name) for r in warehouse.table("fact_funds").collect()}
    assert found == {1: (1, 2, "old"), 2: (2, None, None), 3: (3, None, None)}
    assert [r.fund_id for r in warehouse.table("pending_fact_funds").collect()] == ["3"]
    # A waiting row that is staged anew is taken as it is now.
    late = [dict(fund_id="3", object_id="c:5", name="new", created_at=D2)]
    warehouse.refresh_table(spec, frame(spark, "funds", late), "2010-01-03")
    assert warehouse.table("fact_funds").filter("fund_nk = 3").first().fund_name == "new"
    assert warehouse.table("pending_fact_funds").count() == 0


def test_a_daily_run_opens_the_files_of_its_day(spark, folder):
    staging, log = Store(spark, f"{folder}/staging"), RunLog(spark, f"{folder}/log")
    rows = frame(spark, "milestones", [dict(milestone_id=str(i), created_at=(D1, D2)[i % 2]) for i in range(6)])
    stage(staging, log, "milestones", rows, "source")
    day = created_on_day_before(landed(staging, "milestones"), "created_at", "2010-01-03")
    plan = landed(staging, "milestones").filter(day)
    text = plan._jdf.queryExecution().executedPlan().toString()
    filters = text[text.index("PartitionFilters") : text.index("PushedFilters")]
    assert "ds#" in filters and "_keyed" in filters
    assert sorted(r.milestone_id for r in plan.collect()) == ["1", "3", "5"]
    assert {p.split("ds=")[1].split("/")[0] for p in plan.inputFiles()} <= {"2010-01-01", "2010-01-02"}
    # A later daily run replaces its own day's slice alone.
    stage(staging, log, "milestones", frame(spark, "milestones", [dict(milestone_id="9", created_at=D2)]), "source", "2010-01-03")
    assert sorted((str(r.ds), r.milestone_id) for r in landed(staging, "milestones").collect()) == [
        ("2010-01-01", "0"), ("2010-01-01", "2"), ("2010-01-01", "4"), ("2010-01-02", "9")
    ]
    assert staging.read("milestones").count() == 7


def test_daily_runs_from_slices_equal_those_from_whole_tables(spark, folder, as_rows):
    results = []
    for way in ("whole", "slices"):
        warehouse, staging = Warehouse(spark, f"{folder}/{way}"), Store(spark, f"{folder}/{way}/staging")
        for data, run_date in ((day_one(), None), (day_two(), "2010-01-03")):
            stage_all(spark, staging, warehouse.log, data, run_date)
            frames = staged_frames(staging, COLUMNS)
            if way == "slices" and run_date:
                frames |= {t: landed(staging, t) for t in ("company", "acquisition", "funds", "ipos", "milestones")}
            warehouse.refresh_all(frames, run_date)
        results.append(contents(warehouse, as_rows))
    assert results[0] == results[1]


def test_rounds_are_reduced_before_anything_else(spark):
    rounds = frame(spark, "funding_rounds", [dict(funding_round_id=i, object_id="c:1") for i in ("1", "1.0", "2", "x", None)])
    investments = frame(spark, "investments", [dict(investment_id="1", funding_round_id=i) for i in ("1", "1", "y", None)])
    assert sorted(r.funding_round_id for r in rounds_of(investments, rounds).collect()) == ["1", "1.0"]
    company = Dimension(spark.createDataFrame([("c:1", 1)], "company_nk string, company_id long"), 1)
    built = build(BY_NAME["temp_funding_rounds"], rounds_of(investments, rounds), {"dim_company": company})
    plan = built._jdf.queryExecution().optimizedPlan().toString()
    # Inner nodes stand below outer ones: the reduction lies under the grouping and under the lookup.
    assert plan.index("LeftSemi") > plan.index("Window") and plan.index("LeftSemi") > plan.index("LeftOuter")


def test_investments_without_a_number_are_set_aside(spark, folder):
    warehouse = Warehouse(spark, folder)
    warehouse.refresh_calendar()
    warehouse.refresh_table(BY_NAME["dim_company"], frame(spark, "company", [dict(object_id="c:1")]))
    rows = [dict(investment_id=i, funding_round_id="1") for i in ("a", "b", "7")]
    warehouse.refresh_participation(frame(spark, "investments", rows), frame(spark, "funding_rounds", [dict(funding_round_id="1")]))
    assert [r.investment_nk for r in warehouse.table(PARTICIPATION).collect()] == [7]
    assert [r.n_rejected for r in warehouse.log.read().filter(f"process = 'load' and table_name = '{PARTICIPATION}'").collect()] == [2]


def test_checks_of_all_tables(spark, folder, as_rows):
    warehouse, staging = Warehouse(spark, f"{folder}/w"), Store(spark, f"{folder}/s")
    stage_all(spark, staging, warehouse.log, day_one())
    warehouse.refresh_all(staged_frames(staging, COLUMNS))
    assert set(warehouse.loaded()) == set(RULES)
    logged = warehouse.log.read().filter("process = 'check'").collect()
    assert [(r.status, r.n_rejected) for r in logged] == [("success", 0)]
    people = warehouse.table("dim_people")
    warehouse.store.commit("dim_people", people.unionByName(people).withColumn("last_name", F.lit("x" * 300)))
    warehouse.store.commit("dim_company", warehouse.table("dim_company").filter("company_id = 1"))
    assert warehouse.check() == 4 + 4
    assert as_rows(warehouse.broken_rules().filter("violations > 0")) == [
        ("dim_people", "max_length", "last_name", 2), ("dim_people", "unique", "people_id", 1), ("dim_people", "unique", "people_nk", 1)
    ]
    assert as_rows(warehouse.broken_references(), "table_name", "column_name", "dimension", "value", "n_rows") == [
        ("fact_acquisition", "acquired_company_id", "dim_company", 2, 1),
        ("fact_investment_round_participation", "investor_company_id", "dim_company", 2, 2),
        ("fact_ipos", "company_id", "dim_company", 2, 1),
    ]


def test_dates_outside_the_calendar_are_set_aside(spark, folder):
    warehouse = Warehouse(spark, folder)
    warehouse.refresh_calendar()
    warehouse.refresh_table(BY_NAME["dim_company"], frame(spark, "company", [dict(object_id="c:2")]))
    warehouse.refresh_table(BY_NAME["fact_ipos"], frame(spark, "ipos", day_one()["ipos"]))
    assert [r.ipo_nk for r in warehouse.table("fact_ipos").collect()] == [2]
    rejected = spark.read.parquet(f"{folder}/rejected/fact_ipos/run=full").collect()
    assert [(r.ipo_nk, r.public_at) for r in rejected] == [(1, 18500101)]


def test_too_long_texts_are_set_aside(spark, folder):
    warehouse = Warehouse(spark, folder)
    warehouse.refresh_calendar()
    rows = [dict(object_id="c:1", description="d" * 9999, city="x" * 255), dict(object_id="c:2", city="x" * 256), dict(object_id="c" * 256)]
    warehouse.refresh_table(BY_NAME["dim_company"], frame(spark, "company", rows))
    assert [r.company_nk for r in warehouse.table("dim_company").collect()] == ["c:1"]
    assert spark.read.parquet(f"{folder}/rejected/dim_company/run=full").count() == 2
    assert [r.n_rejected for r in warehouse.log.read().filter("process = 'load'").collect()] == [2]


def test_rows_without_a_key_are_set_aside_and_counted(spark, folder):
    staging, log = Store(spark, f"{folder}/staging"), RunLog(spark, f"{folder}/log")
    rows = frame(spark, "funds", [dict(fund_id="1"), dict(fund_id="1"), dict(name="a"), dict(name="a"), dict(name="b")])
    stage(staging, log, "funds", rows, "source")
    assert [r.fund_id for r in staging.read("funds").collect()] == ["1"]
    aside = spark.read.parquet(f"{staging.root}/_landed/funds").filter("_keyed = 0")
    assert sorted(r.name for r in aside.collect()) == ["a", "a", "b"]
    stage(staging, log, "funds", rows.filter("fund_id is null"), "source")
    found = {(r.status, r.n_rejected) for r in log.read().collect()}
    assert found == {("success", 3), ("skip", 3)}


def test_nothing_new_is_a_skip_and_a_failure_is_logged(spark, folder, as_rows):
    warehouse = Warehouse(spark, folder)
    warehouse.refresh_calendar()
    staging = Store(spark, f"{folder}/staging")
    stage(staging, warehouse.log, "funds", None, "source")
    stage(staging, warehouse.log, "funds", frame(spark, "funds", []), "source")
    warehouse.refresh_table(BY_NAME["dim_company"], frame(spark, "company", []))
    assert warehouse.store.current("dim_company") is None
    twice = [dict(acquisition_id="1"), dict(acquisition_id="1", term_code="x")]
    warehouse.refresh_table(BY_NAME["dim_company"], frame(spark, "company", [dict(object_id="c:1")]))
    with pytest.raises(DuplicateKeys):
        warehouse.refresh_table(BY_NAME["fact_acquisition"], frame(spark, "acquisition", twice))
    assert as_rows(runlog.summary(warehouse.log.read())) == [
        ("staging", "load", "skip", 2, 0),
        ("warehouse", "load", "failed", 1, 0),
        ("warehouse", "load", "success", 1, 0),
        ("warehouse", "transform", "skip", 1, 0),
        ("warehouse", "transform", "success", 2, 0),
        ("warehouse", "validation", "success", 2, 0),
    ]
    failed = warehouse.log.read().filter("status = 'failed'").first()
    assert "1 keys are repeated" in failed.error_msg and failed.table_name == "fact_acquisition"
    assert isinstance(failed.etl_date, datetime.datetime) and failed.etl_date.microsecond == 0
    with pytest.raises(ValueError):
        warehouse.log.add("staging", "load", "skipped", "source", "funds")


def test_investee_mismatches(spark, as_rows):
    data = day_one()
    data["investments"].append(dict(investment_id="5", funding_round_id="1", funded_object_id="c:8"))
    found = investee_mismatches(frame(spark, "investments", data["investments"]), frame(spark, "funding_rounds", data["funding_rounds"]))
    assert as_rows(found, "investment_id", "funded_object_id", "object_id") == [("5", "c:8", "c:1")]


def test_only_the_needed_columns_are_read(spark, folder):
    frame(spark, "company", day_one()["company"]).write.parquet(f"{folder}/c")
    plan = build(BY_NAME["dim_company"], spark.read.parquet(f"{folder}/c")).select("company_nk", "city")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "office_id" not in text and "created_at" not in text


def test_spread_build_equals_broadcast_build(spark, as_rows):
    company = spark.createDataFrame([("c:1", 1), ("c:2", 2)], "company_nk string, company_id long")
    rows = frame(spark, "acquisition", day_one()["acquisition"] * 3)
    results = [
        as_rows(build(BY_NAME["fact_acquisition"], rows, {"dim_company": Dimension(company, n)})) for n in (2, None)
    ]
    assert results[0] == results[1] and len(results[0]) == 3
