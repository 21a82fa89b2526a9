"""Questions on small tables, against plain Python."""

import random
from collections import defaultdict
from decimal import Decimal
from itertools import accumulate

from starfold.operators.calendar import calendar
from starfold.plans import analytics

UNKNOWN = 21000101


def table(spark, data, schema):
    """A table whose decimal columns are given as whole numbers."""
    amounts = [i for i, column in enumerate(schema.split(", ")) if "decimal" in column]
    rows = [tuple(Decimal(v) if i in amounts and v is not None else v for i, v in enumerate(row)) for row in data]
    return spark.createDataFrame(rows, schema)


def some_days(rng, n):
    return [rng.choice([UNKNOWN, rng.randint(2000, 2003) * 10000 + rng.randint(1, 3) * 100 + rng.randint(1, 4)]) for _ in range(n)]


def participation(spark, rng, n=400):
    rounds = {r: (rng.choice([1, 2, 3, None]), day) for r, day in enumerate(some_days(rng, 40))}
    # Round 0 holds a third of all participations.
    data = []
    for i in range(n):
        r = 0 if i % 3 == 0 else rng.choice([*range(40), None])
        company, day = rounds[r] if r is not None else (None, None)
        data.append((i, r, rng.choice([10, 11, 12, 13, 14, None]), company, day, None if r is None else 100 + r))
    schema = "investment_nk long, funding_round_nk long, investor_company_id long, investee_company_id long, funded_at int, raised_amount decimal(15,2)"
    return data, rounds, table(spark, data, schema)


def test_co_investors(spark, as_rows):
    data, _, df = participation(spark, random.Random(1))
    of = defaultdict(set)
    for _, r, investor, *_ in data:
        if r is not None and investor is not None:
            of[r].add(investor)
    rounds = defaultdict(int)
    for members in of.values():
        for m in members:
            rounds[m] += 1
    top = sorted(rounds, key=lambda i: (-rounds[i], i))[:2]
    expected = defaultdict(int)
    for members in of.values():
        for a in top:
            if a in members:
                for b in members - {a}:
                    expected[a, b] += 1
    got = {(r[0], r[1]): r[2] for r in analytics.partners_of(df, top).collect()}
    assert got == dict(expected)
    seats = {
        m: (rounds[m], sum(m in s and len(s) > 1 for s in of.values()), sum(len(s) - 1 for s in of.values() if m in s))
        for m in rounds
    }
    assert {r[0]: tuple(r[1:]) for r in analytics.co_investors(df).collect()} == seats


def test_round_to_milestone(spark):
    rng = random.Random(2)
    _, rounds, df = participation(spark, rng)
    milestones = [(i, rng.choice([1, 2, None]), day) for i, day in enumerate(some_days(rng, 60))]
    found = analytics.round_to_milestone(df, table(spark, milestones, "milestone_nk long, company_id long, milestone_at int"))
    got = {r.funding_round_nk: (r.milestone_at, r.milestone_nk) for r in found.collect()}
    used = {r.funding_round_nk for r in df.collect()}
    expected = {}
    for nk, (company, day) in rounds.items():
        if nk in used and company is not None and day != UNKNOWN:
            later = sorted((d, m) for m, c, d in milestones if c == company and d != UNKNOWN and d > day)
            expected[nk] = later[0] if later else (None, None)
    assert got == expected


def test_fund_history(spark, as_rows):
    rng = random.Random(3)
    data = [(rng.choice([1, 2, None]), rng.choice(["USD", None]), day, rng.randint(-5, 50)) for day in some_days(rng, 80)]
    df = table(spark, data, "company_id long, raised_currency_code string, funded_at int, raised_amount decimal(20,2)")
    per_day = defaultdict(list)
    for company, code, day, amount in data:
        if company is not None and day != UNKNOWN:
            per_day[company, code, day].append(amount)
    groups = defaultdict(list)
    for company, code, day in sorted(per_day, key=lambda k: k[2]):
        groups[company, code].append(day)
    expected = []
    for (company, code), days in groups.items():
        raised = [sum(per_day[company, code, d]) for d in days]
        counts = [len(per_day[company, code, d]) for d in days]
        for d, n, a, s, c, former in zip(days, counts, raised, accumulate(raised), accumulate(counts), [None, *days]):
            expected.append((company, code, d, n, a, s, c, former))
    got = [tuple(int(v) if i in (4, 5) else v for i, v in enumerate(r)) for r in analytics.fund_history(df).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_career_path_steps(spark, as_rows):
    data = [(1, "a", 1, 9, 20000101), (2, "b", 1, 9, 20000101), (3, "c", 1, 8, 20010101), (4, "d", 1, 8, UNKNOWN), (5, "e", None, 8, 20000101), (6, "f", 2, 8, 19990101)]
    df = table(spark, data, "relationship_nk long, title string, people_id long, company_id long, start_at int")
    got = as_rows(analytics.career_path(df), "relationship_nk", "step_no", "next_start_at", "days_to_next")
    assert got == [(1, 1, 20010101, 366), (2, 1, 20010101, 366), (3, 2, None, None), (6, 1, None, None)]
    assert as_rows(analytics.career_contribution(df)) == [(1, 4, 2), (2, 1, 1)]


def test_capital_counts_a_round_once(spark):
    data, rounds, df = participation(spark, random.Random(4))
    empty_sales = table(spark, [(1, 500), (1, 250), (None, 9)], "acquired_company_id long, price_amount decimal(15,2)")
    ipos = table(spark, [(2, 1000)], "company_id long, valuation_amount decimal(20,2)")
    got = {r.company_id: r for r in analytics.capital_to_exit(df, empty_sales, ipos).collect()}
    used = {r for _, r, *_ in data if r is not None}
    for company in (1, 2, 3):
        capital = sum(100 + r for r in used if rounds[r][0] == company)
        assert got[company].capital_in == capital
    assert (got[1].exit_value, got[1].n_exits, got[2].exit_value, got[3].exit_value) == (750, 2, 1000, None)


def test_top_acquirers_breaks_ties_by_sum_then_id(spark):
    data = [(1, 5), (1, 5), (2, 9), (2, 9), (3, 5), (3, 5), (None, 1), (4, None)]
    df = table(spark, data, "acquiring_company_id long, price_amount decimal(15,2)")
    companies = table(spark, [(i, f"c:{i}", "X") for i in range(1, 5)], "company_id long, company_nk string, country_code string")
    got = analytics.top_acquirers(df, companies, k=2).orderBy("company_id").collect()
    assert [(r.company_id, r.n_acquisitions) for r in got] == [(1, 2), (2, 2)]


def test_trend_leaves_out_the_unknown_date(spark):
    sales = table(spark, [(UNKNOWN, 1), (20100105, 2), (20100106, 3)], "acquired_at int, price_amount decimal(15,2)")
    ipos = table(spark, [], "public_at int, valuation_amount decimal(20,2)")
    got = analytics.exit_trend(sales, ipos, calendar(spark)).collect()
    assert {(r.period, str(r.starts_on), r.n_exits, int(r.exit_value)) for r in got} == {
        ("week", "2010-01-04", 2, 5), ("month", "2010-01-01", 2, 5), ("quarter", "2010-01-01", 2, 5), ("year", "2010-01-01", 2, 5)
    }
