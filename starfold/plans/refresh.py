"""Staging and warehouse runs: build, validate and load each table in order."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from starfold.operators.calendar import calendar
from starfold.operators.lookup import matching
from starfold.operators.quality import broken_references_of, missing_report, rule_violations
from starfold.operators.upsert import KEYED, landed_rows, load, load_extracted
from starfold.plans import runlog
from starfold.plans.marts import PENDING, Dimension, build, build_participation, rounds_of
from starfold.plans.runlog import RunLog
from starfold.plans.specs import (
    DIMENSION_KEYS,
    DIMENSIONS,
    FACTS,
    FUNDING_ROUNDS,
    INVESTMENTS,
    PARTICIPATION,
    PARTICIPATION_ID,
    PARTICIPATION_KEY,
    REFERRED_KEYS,
    RULES,
    STAGED_KEYS,
    TableSpec,
)
from starfold.sources.files import created_on_day_before, day_before, write_json
from starfold.sources.store import Store


def stage(staging: Store, log: RunLog, table: str, rows: DataFrame | None, source: str, run_date: str | None = None) -> None:
    """Upsert one source table's text rows into staging.

    With a run date only the rows created on the day before are taken. When a
    source repeats a key, as offices of one company do, the first row by its other
    columns is kept. Rows without a key are set aside and counted in the log. The
    source is read once, into files by day (see `landed`), and loaded from there.
    """

    def work() -> tuple[bool, int]:
        if rows is None:
            return False, 0
        batch = rows if run_date is None else day_before(rows, "created_at", run_date)
        day = None if run_date is None else str(date.fromisoformat(run_date) - timedelta(days=1))
        return load_extracted(staging, table, batch, STAGED_KEYS[table], f"{staging.root}/_landed/{table}", day=day)

    _logged(log, "staging", "load", source, table, work)


def landed(staging: Store, table: str) -> DataFrame:
    """The rows of a staged table as they were landed, by day of creation (`ds`).

    A daily run that reads these opens the files of its day alone. A row that was staged again on a later day is in both
    days' slices, so a run for an earlier day sees it as it was then.
    """
    version = staging.current(table)
    if version is None:
        raise LookupError(f"{table} has not been staged")
    return landed_rows(staging.spark, f"{staging.root}/_landed/{table}", version.columns).filter(f"{KEYED} = 1").drop(KEYED)


def _logged(log: RunLog, step: str, process: str, source: str, table: str, work: Callable[[], tuple[bool, int]]) -> bool:
    """Log how `work` ends; it returns whether there was anything to do and how many rows it set aside."""
    try:
        done, n_rejected = work()
    except Exception as error:
        log.add(step, process, runlog.FAILED, source, table, str(error))
        raise
    log.add(step, process, runlog.SUCCESS if done else runlog.SKIP, source, table, n_rejected=n_rejected)
    return done


def split_by_rules(
    rows: DataFrame, date_cols: tuple[str, ...], lengths: Mapping[str, int], days: DataFrame, required: tuple[str, ...] = ()
) -> tuple[DataFrame, DataFrame]:
    """(rows that fit the table, the other rows).

    Required columns have a value. Date keys must be calendar days or NULL, and texts no longer than declared. The
    calendar is one contiguous range of valid dates, so a key made from a date is in
    it exactly when it lies between the first and the last.
    """
    checks = [F.col(c).isNull() | (F.length(c) <= n) for c, n in lengths.items()]
    checks += [F.col(c).isNotNull() for c in required]
    if date_cols:
        first, last = days.agg(F.min("date_id"), F.max("date_id")).first()
        checks += [F.col(c).isNull() | F.col(c).between(first, last) for c in date_cols]
    good = reduce(lambda a, b: a & b, checks, F.lit(True))
    return rows.filter(good), rows.filter(~good)


class Warehouse:
    """Dimension and fact tables in a versioned store, refreshed from staged tables.

    Rows with a date outside the calendar are set aside; with `load_all_days` they are loaded like others, and
    `broken_references` lists their days.
    """

    def __init__(self, spark: SparkSession, root: str, load_all_days: bool = False) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.load_all_days = load_all_days
        self.store = Store(spark, f"{self.root}/tables")
        self.log = RunLog(spark, f"{self.root}/run_log")

    def table(self, name: str) -> DataFrame:
        return self.store.read(name)

    def dimension(self, name: str) -> Dimension:
        version = self.store.current(name)
        if version is None:
            raise LookupError(f"{name} has not been loaded")
        nk, dimension_id = DIMENSION_KEYS[name]
        return Dimension(self.store.read(name).select(nk, dimension_id), version.rows)

    def dimensions_of(self, *specs: TableSpec) -> dict[str, Dimension]:
        return {name: self.dimension(name) for name in {k.dimension for s in specs for k in s.lookups}}

    def refresh_calendar(self) -> None:
        if self.store.current("dim_date") is None:
            self.store.commit("dim_date", calendar(self.spark).coalesce(1))

    def _slice(self, name: str, run_date: str | None) -> str:
        day = "full" if run_date is None else run_date
        return f"{self.root}/transformed/{name}/run={day}"

    def refresh(
        self,
        name: str,
        rows: DataFrame,
        key: tuple[str, ...],
        surrogate: str,
        date_cols: tuple[str, ...] = (),
        lengths: Mapping[str, int] | None = None,
        run_date: str | None = None,
        null_safe: bool = False,
        required: tuple[str, ...] = (),
    ) -> None:
        """Write built rows, report their missing values, load them.

        Rows that break a declared rule are written to `rejected` and counted in the log, not loaded.
        """
        path = self._slice(name, run_date)
        rejected = path.replace("/transformed/", "/rejected/")

        def written() -> DataFrame:
            return self.spark.read.parquet(path).drop(PENDING)

        def transform() -> tuple[bool, int]:
            rows.write.mode("overwrite").parquet(path)
            return not written().isEmpty(), 0

        def validate() -> tuple[bool, int]:
            report = missing_report(written(), name, key, date_cols)
            write_json(report, path.replace("/transformed/", "/invalid/"))
            return True, 0

        def insert() -> tuple[bool, int]:
            batch, n_rejected = written(), 0
            held_dates = () if self.load_all_days else date_cols
            if held_dates or lengths or required:
                batch, others = split_by_rules(batch, held_dates, lengths or {}, self.table("dim_date"), required)
                others.write.mode("overwrite").parquet(rejected)
                n_rejected = self.spark.read.parquet(rejected).count()
            load(self.store, name, batch, key, surrogate, null_safe)
            return True, n_rejected

        if _logged(self.log, "warehouse", "transform", "staging", name, transform):
            _logged(self.log, "warehouse", "validation", "transformed", name, validate)
            _logged(self.log, "warehouse", "load", "transformed", name, insert)

    def _pending(self, name: str) -> str:
        return f"pending_{name}"

    def _with_pending(self, spec: TableSpec, staged: DataFrame) -> DataFrame:
        """Staged rows of a daily run, and those that waited for a dimension's row and are not staged anew."""
        table, staged = self._pending(spec.name), staged.select(*spec.staged_columns)
        if self.store.current(table) is None:
            return staged
        own = spec.fields[0].sources[0]
        waiting = self.store.read(table).join(staged.select(own), own, "left_anti")
        return staged.unionByName(waiting)

    def _keep_pending(self, spec: TableSpec, path: str) -> None:
        """Rows whose dimension's row has not come replace those that waited before."""
        rows = self.spark.read.parquet(path)
        if PENDING not in rows.columns:
            return
        waiting, table = rows.filter(F.col(PENDING).isNotNull()).select(f"{PENDING}.*"), self._pending(spec.name)
        if self.store.current(table) is not None or not waiting.isEmpty():
            self.store.commit(table, waiting)

    def refresh_table(self, spec: TableSpec, staged: DataFrame, run_date: str | None = None) -> None:
        """Build and load one table; a daily run takes the day's rows.

        A row with a key that its dimension lacks is loaded with NULL and kept waiting as it was staged. Every later
        daily run takes the waiting rows too, so the fact gets its id in the run after the dimension's row came.
        """
        if run_date is not None and spec.refresh == "daily":
            staged = day_before(staged, "created_at", run_date)
            staged = self._with_pending(spec, staged) if spec.lookups else staged
        waits = spec.refresh == "daily" and bool(spec.lookups)
        rows = build(spec, staged, self.dimensions_of(spec), pending=waits)
        self.refresh(spec.name, rows, spec.key, spec.surrogate, spec.date_cols, spec.lengths, run_date)
        if waits:
            self._keep_pending(spec, self._slice(spec.name, run_date))

    def refresh_participation(self, investments: DataFrame, rounds: DataFrame, run_date: str | None = None) -> None:
        """The day's investments, and those of the day's rounds; rounds that none of these names are left out first."""
        dimensions = self.dimensions_of(INVESTMENTS, FUNDING_ROUNDS)
        if run_date is not None:
            changed = day_before(rounds, "created_at", run_date).select("funding_round_id")
            flagged = matching(investments, changed, flag="_round_changed")
            flagged = flagged.filter(F.col("_round_changed") | created_on_day_before(flagged, "created_at", run_date))
            path = f"{self.root}/transformed/_investments/run={run_date}"
            flagged.select(*INVESTMENTS.staged_columns).write.mode("overwrite").parquet(path)
            investments = self.spark.read.parquet(path)
            rounds = rounds_of(investments, rounds)
        rows = build_participation(investments, rounds, dimensions)
        self.refresh(
            PARTICIPATION,
            rows,
            PARTICIPATION_KEY,
            PARTICIPATION_ID,
            ("funded_at",),
            FUNDING_ROUNDS.lengths,
            run_date,
            null_safe=True,
            # Staged investments have a key of text; those whose text is no number can't be told apart.
            required=PARTICIPATION_KEY[:1],
        )

    def loaded(self) -> list[str]:
        return [name for name in RULES if self.store.current(name) is not None]

    def broken_rules(self) -> DataFrame:
        """(table_name, rule, column_name, violations) of the declared rules of all loaded tables, a scan for each."""
        parts = []
        for name in self.loaded():
            rules = RULES[name]
            found = rule_violations(self.table(name), rules.required, rules.unique, rules.lengths)
            parts.append(found.select(F.lit(name).alias("table_name"), "*"))
        return reduce(DataFrame.unionByName, parts)

    def broken_references(self) -> DataFrame:
        """(table_name, column_name, dimension, value, n_rows) of values of all loaded facts that their dimension lacks."""
        names = self.loaded()
        tables = {n: (self.table(n), RULES[n].refers_to) for n in names if RULES[n].refers_to}
        dimensions = {n: (self.table(n), key) for n, key in REFERRED_KEYS.items() if n in names}
        return broken_references_of(tables, dimensions)

    def check(self, run_date: str | None = None) -> int:
        """Report rules and references that the loaded tables break, count the violations in the log, and return them."""
        counts = []

        def report() -> tuple[bool, int]:
            for name, found, n in (
                ("_rules", self.broken_rules().filter("violations > 0"), "violations"),
                ("_references", self.broken_references(), "n_rows"),
            ):
                path = self._slice(name, run_date).replace("/transformed/", "/invalid/")
                write_json(found, path)
                written = self.spark.read.schema(found.schema).json(path)
                counts.append(written.agg(F.coalesce(F.sum(n), F.lit(0))).first()[0])
            return True, sum(counts)

        _logged(self.log, "warehouse", "check", "warehouse", "all", report)
        return sum(counts)

    def refresh_all(self, staged: Mapping[str, DataFrame], run_date: str | None = None) -> None:
        """Calendar, dimensions, then facts, then the checks. Staged tables that are absent are skipped.

        A daily run may be given landed rows (see `landed`) of tables that it takes one day of: all but companies' and
        people's relationships, investments and rounds.
        """
        self.refresh_calendar()
        for spec in (*DIMENSIONS, *FACTS):
            if spec.staged in staged:
                self.refresh_table(spec, staged[spec.staged], run_date)
        if "investments" in staged and "funding_rounds" in staged:
            self.refresh_participation(staged["investments"], staged["funding_rounds"], run_date)
        if any(RULES[name].refers_to for name in self.loaded()):
            self.check(run_date)
