"""Questions over the loaded star schema.

Events are first counted per company and day, or per company and quarter. A
company has at most one row per calendar day after that, so neither a join nor a
window receives an unbounded group, however many events one company has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from starfold.functions.dates import is_known, key_to_date
from starfold.operators.lookup import hot_keys, spread_left_join


def _year(key: str) -> Column:
    return F.floor(F.col(key) / 10000).cast("int")


def _quarter(key: str) -> Column:
    return F.quarter(key_to_date(F.col(key)))


def known_dates(df: DataFrame, key: str) -> DataFrame:
    """Rows whose date is not the unknown date."""
    return df.filter(is_known(F.col(key)))


def rounds_of(participation: DataFrame) -> DataFrame:
    """One row per funding round; its attributes repeat on every participation row."""
    return (
        participation.filter("funding_round_nk is not null")
        .groupBy("funding_round_nk")
        .agg(
            F.max("investee_company_id").alias("investee_company_id"),
            F.max("funded_at").alias("funded_at"),
            F.max("raised_amount").alias("raised_amount"),
        )
    )


def top_acquirers(acquisitions: DataFrame, companies: DataFrame, k: int = 10) -> DataFrame:
    """The `k` companies that acquire most often; ties go to the larger sum, then the lower id."""
    top = (
        acquisitions.filter("acquiring_company_id is not null")
        .groupBy(F.col("acquiring_company_id").alias("company_id"))
        .agg(F.count("*").alias("n_acquisitions"), F.sum("price_amount").alias("total_price"))
        .orderBy(F.desc("n_acquisitions"), F.desc_nulls_last("total_price"), "company_id")
        .limit(k)
    )
    # k rows are broadcast, the dimension is scanned.
    named = companies.select("company_id", "company_nk", "country_code")
    return named.join(F.broadcast(top), "company_id").select(
        "company_id", "company_nk", "country_code", "n_acquisitions", "total_price"
    )


def ipo_valuation_by_year(ipos: DataFrame, years: int = 5) -> DataFrame:
    """Average IPO valuation per year and currency in the newest `years` years of the data."""
    per_year = (
        known_dates(ipos, "public_at")
        .groupBy(_year("public_at").alias("year"), F.col("valuation_currency_code").alias("currency_code"))
        .agg(
            F.count("*").alias("n_ipos"),
            F.count("valuation_amount").alias("n_valued"),
            F.sum("valuation_amount").alias("total_valuation"),
        )
    )
    newest = known_dates(ipos, "public_at").agg(F.max(_year("public_at")).alias("_newest"))
    wanted = newest.select(F.explode(F.sequence(F.col("_newest") - (years - 1), "_newest")).alias("year"))
    return (
        # The other side is `years` rows.
        per_year.join(F.broadcast(wanted), "year", "left_semi")
        .withColumn("avg_valuation", F.col("total_valuation").cast("double") / F.nullif("n_valued", F.lit(0)))
    )


def _members(participation: DataFrame) -> DataFrame:
    """One row for each investor of each round."""
    return participation.select("funding_round_nk", "investor_company_id").dropna().distinct()


def co_investors(participation: DataFrame) -> DataFrame:
    """For every investor: rounds, rounds shared with others, and seats of others in those rounds.

    Seats are a round's investors minus one, so no pairs are formed. `partners_of` lists the partners themselves.
    """
    members = _members(participation)
    sizes = members.groupBy("funding_round_nk").agg(F.count("*").alias("size"))
    attached = spread_left_join(
        members,
        sizes,
        ["funding_round_nk"],
        hot=hot_keys(participation, ["funding_round_nk"]),
        spread=F.xxhash64("investor_company_id"),
    )
    return attached.groupBy("investor_company_id").agg(
        F.count("*").alias("n_rounds"),
        F.count_if(F.col("size") > 1).alias("shared_rounds"),
        F.sum(F.col("size") - 1).alias("partner_seats"),
    )


def partners_of(participation: DataFrame, investors: DataFrame | list[int]) -> DataFrame:
    """Every partner of the investors that the caller names, and the rounds they share.

    `investors` is a list of company ids, or a table whose first column holds them. A round carries at most as many of
    these investors as are named, so each participation yields at most so many rows.
    """
    members = _members(participation)
    if isinstance(investors, DataFrame):
        named = investors.select(F.col(investors.columns[0]).alias("investor_company_id"))
        chosen = members.join(named, "investor_company_id", "left_semi")
    else:
        chosen = members.filter(F.col("investor_company_id").isin(investors))
    focus = (
        chosen.groupBy("funding_round_nk")
        .agg(F.collect_set("investor_company_id").alias("focus"))
    )
    attached = spread_left_join(
        members.withColumnRenamed("investor_company_id", "partner_company_id"),
        focus,
        ["funding_round_nk"],
        hot=hot_keys(participation, ["funding_round_nk"]),
        spread=F.xxhash64("partner_company_id"),
    )
    return (
        attached.select("partner_company_id", F.explode("focus").alias("investor_company_id"))
        .filter("partner_company_id <> investor_company_id")
        .groupBy("investor_company_id", "partner_company_id")
        .agg(F.count("*").alias("shared_rounds"))
    )


def round_to_milestone(participation: DataFrame, milestones: DataFrame) -> DataFrame:
    """Each dated round with its company's next later milestone and the days between."""
    rounds = known_dates(rounds_of(participation), "funded_at").filter("investee_company_id is not null")
    round_days = (
        known_dates(participation, "funded_at")
        .filter("investee_company_id is not null and funding_round_nk is not null")
        .groupBy(F.col("investee_company_id").alias("company_id"), F.col("funded_at").alias("day"))
        .agg(F.lit(None).cast("bigint").alias("milestone_nk"))
    )
    milestone_days = (
        known_dates(milestones, "milestone_at")
        .filter("company_id is not null")
        .groupBy("company_id", F.col("milestone_at").alias("day"))
        .agg(F.min("milestone_nk").alias("milestone_nk"))
    )
    # One row per company and day, so a window holds no more rows than the calendar.
    days = (
        round_days.unionByName(milestone_days)
        .groupBy("company_id", "day")
        .agg(F.max("milestone_nk").alias("milestone_nk"))
    )
    later = Window.partitionBy("company_id").orderBy(F.desc("day")).rowsBetween(Window.unboundedPreceding, -1)
    event = F.when(F.col("milestone_nk").isNotNull(), F.struct("day", "milestone_nk"))
    upcoming = days.select(
        F.col("company_id").alias("investee_company_id"),
        F.col("day").alias("funded_at"),
        F.last(event, ignorenulls=True).over(later).alias("next"),
    ).filter("next is not null")
    keys = ["investee_company_id", "funded_at"]
    matched = spread_left_join(
        rounds, upcoming, keys, hot_keys(participation, keys), F.xxhash64("funding_round_nk")
    )
    return matched.select(
        "funding_round_nk",
        F.col("investee_company_id").alias("company_id"),
        "funded_at",
        "next.milestone_nk",
        F.col("next.day").alias("milestone_at"),
        F.date_diff(key_to_date(F.col("next.day")), key_to_date(F.col("funded_at"))).alias("days_between"),
    )


def fund_history(funds: DataFrame) -> DataFrame:
    """Per company, currency and day: raised then, raised so far, and the former fund's day."""
    per_day = (
        known_dates(funds, "funded_at")
        .filter("company_id is not null")
        .groupBy("company_id", "raised_currency_code", "funded_at")
        .agg(F.count("*").alias("n_funds"), F.sum("raised_amount").alias("raised"))
    )
    history = Window.partitionBy("company_id", "raised_currency_code").orderBy("funded_at")
    so_far = history.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per_day.select(
        "*",
        F.sum("raised").over(so_far).alias("raised_so_far"),
        F.sum("n_funds").over(so_far).alias("funds_so_far"),
        F.lag("funded_at").over(history).alias("former_funded_at"),
    )


def acquisition_rollup(acquisitions: DataFrame, companies: DataFrame) -> DataFrame:
    """Acquisitions and their value by year, quarter and region of the acquired company, with subtotals."""
    per_company = (
        known_dates(acquisitions, "acquired_at")
        .groupBy(
            F.col("acquired_company_id").alias("company_id"),
            _year("acquired_at").alias("year"),
            _quarter("acquired_at").alias("quarter"),
        )
        .agg(F.count("*").alias("n"), F.sum("price_amount").alias("price"))
    )
    regions = companies.select("company_id", "region")
    return (
        per_company.join(regions, "company_id", "left")
        .withColumn("region", F.coalesce("region", F.lit("Unknown")))
        .rollup("year", "quarter", "region")
        .agg(
            F.grouping_id().cast("int").alias("level"),
            F.sum("n").alias("n_acquisitions"),
            F.sum("price").alias("total_price"),
        )
    )


def _exits(acquisitions: DataFrame, ipos: DataFrame) -> DataFrame:
    """(kind, day, n_exits, value) per day; at most two rows per calendar day."""

    def per_day(df: DataFrame, kind: str, key: str, amount: str) -> DataFrame:
        return (
            known_dates(df, key)
            .groupBy(F.col(key).alias("day"))
            .agg(F.count("*").alias("n_exits"), F.sum(F.col(amount).cast("decimal(20,2)")).alias("exit_value"))
            .withColumn("kind", F.lit(kind))
        )

    return per_day(acquisitions, "acquisition", "acquired_at", "price_amount").unionByName(
        per_day(ipos, "ipo", "public_at", "valuation_amount")
    )


def exit_comparison(acquisitions: DataFrame, ipos: DataFrame) -> DataFrame:
    """Per year: exits and their value through acquisition and through IPO."""
    def of(kind: str, column: str) -> Column:
        return F.sum(F.when(F.col("kind") == kind, F.col(column)))

    return (
        _exits(acquisitions, ipos)
        .groupBy(_year("day").alias("year"))
        .agg(
            F.coalesce(of("acquisition", "n_exits"), F.lit(0)).alias("n_acquisitions"),
            F.coalesce(of("ipo", "n_exits"), F.lit(0)).alias("n_ipos"),
            of("acquisition", "exit_value").alias("acquisition_value"),
            of("ipo", "exit_value").alias("ipo_value"),
        )
    )


def capital_to_exit(participation: DataFrame, acquisitions: DataFrame, ipos: DataFrame) -> DataFrame:
    """Per funded company: capital raised, value of its exits, and their ratio."""
    capital = (
        rounds_of(participation)
        .filter("investee_company_id is not null")
        .groupBy(F.col("investee_company_id").alias("company_id"))
        .agg(F.count("*").alias("n_rounds"), F.sum("raised_amount").alias("capital_in"))
    )

    def per_company(df: DataFrame, company: str, amount: str) -> DataFrame:
        return (
            df.filter(F.col(company).isNotNull())
            .groupBy(F.col(company).alias("company_id"))
            .agg(F.count("*").alias("n"), F.sum(F.col(amount).cast("decimal(20,2)")).alias("amount"))
        )

    exits = (
        per_company(acquisitions, "acquired_company_id", "price_amount")
        .unionByName(per_company(ipos, "company_id", "valuation_amount"))
        .groupBy("company_id")
        .agg(F.sum("n").alias("n_exits"), F.sum("amount").alias("exit_value"))
    )
    # One row per company on both sides.
    return capital.join(exits, "company_id", "left").select(
        "company_id",
        "n_rounds",
        "capital_in",
        F.coalesce("n_exits", F.lit(0)).alias("n_exits"),
        "exit_value",
        (F.col("exit_value").cast("double") / F.nullif(F.col("capital_in").cast("double"), F.lit(0.0))).alias(
            "exit_per_capital"
        ),
    )


def exit_trend(acquisitions: DataFrame, ipos: DataFrame, days: DataFrame) -> DataFrame:
    """Exits by kind for every week, month, quarter and year that has one."""
    periods = F.array(
        *[
            F.struct(F.lit(name).alias("period"), F.col(column).alias("starts_on"))
            for name, column in (
                ("week", "first_day_of_week"),
                ("month", "first_day_of_month"),
                ("quarter", "first_day_of_quarter"),
                ("year", "first_day_of_year"),
            )
        ]
    )
    dated = _exits(acquisitions, ipos).join(
        F.broadcast(days.select(F.col("date_id").alias("day"), periods.alias("periods"))), "day"
    )
    return (
        dated.select("kind", "n_exits", "exit_value", F.inline("periods"))
        .groupBy("kind", "period", "starts_on")
        .agg(F.sum("n_exits").alias("n_exits"), F.sum("exit_value").alias("exit_value"))
    )


def exit_seasonality(acquisitions: DataFrame, ipos: DataFrame, days: DataFrame) -> DataFrame:
    """Exits by kind and calendar month over all years, and the mean per year that has one."""
    calendar = days.select(F.col("date_id").alias("day"), "month_actual", "month_name", "year_actual")
    return (
        _exits(acquisitions, ipos)
        .join(F.broadcast(calendar), "day")
        .groupBy("kind", "month_actual", "month_name")
        .agg(F.sum("n_exits").alias("n_exits"), F.count_distinct("year_actual").alias("n_years"))
        .withColumn("exits_per_year", F.col("n_exits") / F.col("n_years"))
    )


def career_path(relationships: DataFrame) -> DataFrame:
    """Each dated position with its step in the person's career and the next step's day.

    Positions that start on the same day are one step.
    """
    dated = known_dates(relationships, "start_at").filter("people_id is not null")
    order = Window.partitionBy("people_id").orderBy("start_at")
    # One row per person and day.
    steps = (
        dated.select("people_id", "start_at")
        .distinct()
        .select(
            "people_id",
            "start_at",
            F.row_number().over(order).alias("step_no"),
            F.lead("start_at").over(order).alias("next_start_at"),
        )
    )
    joined = spread_left_join(dated, steps, ["people_id", "start_at"])
    return joined.select(
        "people_id",
        "step_no",
        "relationship_nk",
        "title",
        "company_id",
        "start_at",
        "next_start_at",
        F.date_diff(key_to_date(F.col("next_start_at")), key_to_date(F.col("start_at"))).alias("days_to_next"),
    )


def career_contribution(relationships: DataFrame) -> DataFrame:
    """Per person: positions, and the companies they were held at."""
    return (
        relationships.filter("people_id is not null")
        .groupBy("people_id")
        .agg(F.count("*").alias("n_positions"), F.count_distinct("company_id").alias("n_companies"))
    )


def milestones_by_region(milestones: DataFrame, companies: DataFrame) -> DataFrame:
    """All regions with milestones, ranked by their number; equal counts share a rank."""
    per_company = (
        milestones.filter("company_id is not null").groupBy("company_id").agg(F.count("*").alias("n"))
    )
    by_region = (
        per_company.join(companies.select("company_id", "region"), "company_id")
        .groupBy("region")
        .agg(F.sum("n").alias("n_milestones"), F.count("*").alias("n_companies"))
    )
    # One row per region is ranked.
    return by_region.withColumn("place", F.rank().over(Window.orderBy(F.desc("n_milestones"))))
