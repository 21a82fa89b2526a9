"""For each query, SQL that computes the same rows another way, run by DuckDB."""

from __future__ import annotations

import re

from starfold.checks.queries import ABSENT_DAY, LOADED, SLICE_RUN_DATE
from starfold.checks.staged_views import STAGED_SQL, for_duckdb

ORACLES: dict[str, str] = {}

_CTES: dict[str, str] = {f"stg_{name}": for_duckdb(sql) for name, sql in STAGED_SQL.items()}


def _day(text: str) -> str:
    """Date text to key, unknown date for anything else."""
    return f"coalesce(cast(strftime(try_cast({text} as date), '%Y%m%d') as int), 21000101)"


def _moment(text: str) -> str:
    return f"coalesce(cast(strftime(try_strptime({text}, '%Y-%m-%d %H:%M:%S.%g'), '%Y%m%d') as int), 21000101)"


def _first(table: str, key: str, columns: str) -> str:
    """One row per key: the first by the other columns, NULLs first."""
    order = ", ".join(f"{c.strip()} nulls first" for c in columns.split(","))
    return (
        f"select * from (select {key}, {columns}, "
        f"row_number() over (partition by {key} order by {order}) rn from {table}) where rn = 1"
    )


def _money(column: str, kind: str = "decimal(15,2)") -> str:
    return f"try_cast({column} as {kind})"


_CTES |= {
    "one_company": _first(
        "stg_company", "object_id", "description, region, city, state_code, country_code, latitude, longitude"
    ),
    "built_company": """
        select object_id company_nk, description, region, coalesce(city, 'Unknown') city,
          coalesce(state_code, 'N/A') state_code, country_code,
          cast(cast(latitude as float) as decimal(10,6)) latitude,
          cast(cast(longitude as float) as decimal(10,6)) longitude
        from one_company""",
    "dim_company": "select row_number() over (order by company_nk) company_id, * from built_company",
    "one_people": _first("stg_people", "object_id", "first_name, last_name, affiliation_name, birthplace"),
    "built_people": """
        select object_id people_nk, first_name, last_name, affiliation_name affiliation, birthplace,
          concat_ws(' ', first_name, last_name) full_name
        from one_people""",
    "dim_people": "select row_number() over (order by people_nk) people_id, * from built_people",
    "fact_relationships": f"""
        select cast(relationship_id as bigint) relationship_nk, title, {_moment('start_at')} start_at,
          {_moment('end_at')} end_at,
          case when is_past is null then 'Unknown' when is_past = 'TRUE' then 'Past'
            when is_past = 'FALSE' then 'Current' else is_past end relationship_status,
          cast(sequence as int) relationship_order, people_id, company_id
        from stg_relationships
        left join dim_people on people_nk = person_object_id
        left join dim_company on company_nk = relationship_object_id""",
    "fact_acquisition": f"""
        select cast(acquisition_id as bigint) acquisition_nk, {_day('acquired_at')} acquired_at,
          {_money('price_amount')} price_amount, price_currency_code, coalesce(term_code, 'Unknown') term_code,
          a.company_id acquiring_company_id, b.company_id acquired_company_id
        from stg_acquisition
        left join dim_company a on a.company_nk = acquiring_object_id
        left join dim_company b on b.company_nk = acquired_object_id""",
    "one_round": _first(
        "stg_funding_rounds",
        "funding_round_id",
        "object_id, funded_at, funding_round_type, funding_round_code, raised_amount_usd, "
        "pre_money_valuation_usd, post_money_valuation_usd, participants, is_first_round, is_last_round",
    ),
    "temp_funding_rounds": f"""
        select cast(funding_round_id as bigint) funding_round_nk, {_day('funded_at')} funded_at, funding_round_type,
          funding_round_code, raised_amount_usd raised_amount, pre_money_valuation_usd pre_money_valuation,
          post_money_valuation_usd post_money_valuation, cast(participants as int) number_of_participants,
          case when is_first_round = 'true' then 'First Round' else 'Not First Round' end round_position_desc,
          case when is_last_round = 'true' then 'Last Round' else 'Ongoing Round' end round_stage_desc,
          company_id investee_company_id
        from one_round left join dim_company on company_nk = object_id""",
    "one_investment": _first("stg_investments", "investment_id", "funding_round_id, investor_object_id"),
    "temp_investments": """
        select cast(investment_id as bigint) investment_nk, cast(funding_round_id as bigint) funding_round_nk,
          company_id investor_company_id
        from one_investment left join dim_company on company_nk = investor_object_id""",
    "fact_investment_round_participation": f"""
        select investment_nk, i.funding_round_nk, investor_company_id, investee_company_id, funded_at,
          funding_round_type, funding_round_code, {_money('raised_amount')} raised_amount,
          {_money('pre_money_valuation')} pre_money_valuation, {_money('post_money_valuation')} post_money_valuation,
          number_of_participants, round_position_desc, round_stage_desc
        from temp_investments i left join temp_funding_rounds r on i.funding_round_nk = r.funding_round_nk""",
    "one_fund": _first("stg_funds", "fund_id", "object_id, funded_at, name, raised_amount, raised_currency_code"),
    "fact_funds": f"""
        select cast(fund_id as bigint) fund_nk, {_day('funded_at')} funded_at, name fund_name,
          {_money('raised_amount', 'decimal(20,2)')} raised_amount, raised_currency_code, company_id
        from one_fund left join dim_company on company_nk = object_id""",
    "one_ipo": _first(
        "stg_ipos",
        "ipo_id",
        "object_id, public_at, valuation_currency_code, raised_currency_code, valuation_amount, raised_amount, "
        "stock_symbol",
    ),
    "fact_ipos": f"""
        select cast(ipo_id as bigint) ipo_nk, {_day('public_at')} public_at, valuation_currency_code,
          raised_currency_code, {_money('valuation_amount', 'decimal(20,2)')} valuation_amount,
          {_money('raised_amount', 'decimal(20,2)')} raised_amount, stock_symbol, company_id
        from one_ipo left join dim_company on company_nk = object_id""",
    "one_milestone": _first("stg_milestones", "milestone_id", "object_id, milestone_at, description, milestone_code"),
    "fact_milestones": f"""
        select cast(milestone_id as bigint) milestone_nk, {_day('milestone_at')} milestone_at, m.description,
          milestone_code, company_id
        from one_milestone m left join dim_company on company_nk = object_id""",
    "days": """
        select cast(d as date) d, cast(strftime(d, '%Y%m%d') as int) date_id
        from generate_series(timestamp '1900-01-01', timestamp '2100-12-31', interval 1 day) t(d)""",
    "dim_date": """
        select date_id, d date_actual,
          cast(day(d) as varchar) || case when day(d) in (11, 12, 13) then 'th'
            else case day(d) % 10 when 1 then 'st' when 2 then 'nd' when 3 then 'rd' else 'th' end end day_suffix,
          strftime(d, '%A') day_name, cast(dayofyear(d) as int) day_of_year,
          cast((day(d) + 6) // 7 as int) week_of_month, cast(weekofyear(d) as int) week_of_year,
          strftime(d, '%G-%V') week_of_year_iso, cast(month(d) as int) month_actual, strftime(d, '%B') month_name,
          strftime(d, '%b') month_name_abbreviated, cast(quarter(d) as int) quarter_actual,
          case quarter(d) when 1 then 'First' when 2 then 'Second' when 3 then 'Third' else 'Fourth' end quarter_name,
          cast(year(d) as int) year_actual,
          cast(date_trunc('week', d) as date) first_day_of_week,
          cast(date_trunc('week', d) + interval 6 day as date) last_day_of_week,
          cast(date_trunc('month', d) as date) first_day_of_month,
          cast(date_trunc('month', d) + interval 1 month - interval 1 day as date) last_day_of_month,
          cast(date_trunc('quarter', d) as date) first_day_of_quarter,
          cast(date_trunc('quarter', d) + interval 3 month - interval 1 day as date) last_day_of_quarter,
          cast(date_trunc('year', d) as date) first_day_of_year,
          cast(date_trunc('year', d) + interval 1 year - interval 1 day as date) last_day_of_year,
          strftime(d, '%m%Y') mmyyyy, strftime(d, '%m/%d/%Y') mmddyyyy,
          case when isodow(d) in (6, 7) then 'Weekend' else 'Weekday' end weekend_indr
        from days""",
    "rounds": """
        select distinct funding_round_nk, investee_company_id, funded_at, raised_amount
        from fact_investment_round_participation where funding_round_nk is not null""",
    "exits": """
        select 'acquisition' kind, acquired_at day_key, cast(price_amount as decimal(20,2)) amount
        from fact_acquisition where acquired_at <> 21000101
        union all
        select 'ipo', public_at, valuation_amount from fact_ipos where public_at <> 21000101""",
}


def _needed(sql: str) -> list[str]:
    """Names of the parts `sql` uses, each after the parts it uses itself."""
    found: list[str] = []

    def visit(text: str) -> None:
        for name in _CTES:
            if name not in found and re.search(rf"\b{name}\b", text):
                visit(_CTES[name].replace(name, ""))
                if name not in found:
                    found.append(name)

    visit(sql)
    return found


def oracle(name: str, sql: str) -> None:
    parts = ",\n".join(f"{part} as ({_CTES[part]})" for part in _needed(sql))
    if not parts:
        ORACLES[name] = sql
    elif sql.lstrip().lower().startswith("with "):
        ORACLES[name] = f"with {parts},\n{sql.lstrip()[5:]}"
    else:
        ORACLES[name] = f"with {parts}\n{sql}"


oracle("dim_company", "select * from built_company")
oracle("dim_people", "select * from built_people")
for _name in (
    "fact_relationships",
    "fact_acquisition",
    "temp_funding_rounds",
    "temp_investments",
    "fact_investment_round_participation",
    "fact_funds",
    "fact_ipos",
    "fact_milestones",
):
    oracle(_name, f"select * from {_name}")
oracle(
    "fact_acquisition_legacy_money",
    """select f.* exclude (price_amount), try_cast(s.price_amount as decimal(10,0)) price_amount
    from fact_acquisition f join stg_acquisition s on cast(s.acquisition_id as bigint) = acquisition_nk""",
)

# Sources and sinks

oracle(
    "incremental_slice",
    f"""select * from stg_milestones
    where cast(left(created_at, 10) as date) = date '{SLICE_RUN_DATE}' - interval 1 day""",
)
oracle("csv_roundtrip", "select cast(doc_id as varchar) doc_id, text, lang, source from documents")
oracle("parquet_partition_roundtrip", "select *, cast(left(created_at, 10) as date) ds from stg_milestones")
oracle(
    "missing_slice_skip",
    f"""select max(left(created_at, 10)) ds, 'success' status,
      count(*) filter (created_at = (select max(created_at) from stg_milestones)) n_rows from stg_milestones
    union all select '{ABSENT_DAY}', 'skip', 0""",
)
_CTES["clean_pages"] = """
    select created_at, milestone_at, milestone_code, milestone_id, object_id, source_url, updated_at,
      trim(replace(replace(replace(description, chr(10), ' '), chr(13), ''), '"', ''''),
        chr(9) || chr(10) || chr(13) || ' ') description,
      case when trim(source_description) in ('', 'nan', 'None') then null
        else replace(source_description, '"', '''') end source_description
    from stg_raw_pages"""
oracle("milestone_pages", "select * from clean_pages")
oracle(
    "backfill_windows",
    """with bounds as (select min(cast(milestone_at as date)) lo, max(cast(milestone_at as date)) hi from clean_pages),
    starts as (
      select cast(i as int) window_no, cast(lo + to_years(cast(i as int)) as date) start_date, hi
      from bounds, generate_series(0, 300) t(i) where lo + to_years(cast(i as int)) <= hi),
    windows as (
      select window_no, start_date,
        coalesce(lead(start_date) over (order by window_no), cast(hi + interval 1 day as date)) end_date from starts)
    select window_no, start_date, end_date, count(*) n_records
    from windows join (select distinct * from clean_pages) on cast(milestone_at as date) >= start_date
      and cast(milestone_at as date) < end_date
    group by all""",
)
oracle(
    "list_tables",
    " union all ".join(f"select '{name}' table_name, cast(1 as bigint) as version, count(*) as \"rows\" from {name}" for name in LOADED),
)

# Projection, cleaning and scalar functions

oracle("select_rename", "select object_id company_nk, description, region, country_code from stg_company")
oracle(
    "clean_newlines",
    """select doc_id, replace(text, chr(10), ' ') as text, replace(lang, chr(10), ' ') lang,
      replace(source, chr(10), ' ') source, n_chars from documents""",
)


def _null_token(column: str) -> str:
    return f"case when {column} in ('', 'nan', 'None') then null else {column} end {column}"


oracle(
    "null_tokens",
    "select "
    + ", ".join(
        map(
            _null_token,
            (
                "created_at",
                "description",
                "milestone_at",
                "milestone_code",
                "milestone_id",
                "object_id",
                "source_description",
                "source_url",
                "updated_at",
            ),
        )
    )
    + " from stg_raw_pages",
)
_BLANKS = "(select string_agg(chr(c), '') from (select unnest([9,10,11,12,13,28,29,30,31,32,133,160,5760,8192,8193,8194,8195,8196,8197,8198,8199,8200,8201,8202,8232,8233,8239,8287,12288]) c))"


def _repaired(text: str) -> str:
    return f"trim(replace(replace(replace({text}, chr(10), ' '), chr(13), ''), '\"', ''''), {_BLANKS})"


oracle(
    "clean_text",
    f"""select page_id, {_repaired('url')} url, {_repaired('html')} html,
      {_repaired("' ' || chr(9) || '\"' || url || '\" ' || chr(13) || chr(10)")} quoted_url,
      {_repaired("chr(10) || html")} extra_html
    from pages""",
)
oracle(
    "clean_conversation_text",
    f'select conv_id, turn, {_repaired("role")} as "role", {_repaired("text")} as text from conversations',
)
oracle(
    "fill_defaults",
    "select object_id, coalesce(city, 'Unknown') city, coalesce(state_code, 'N/A') state_code from stg_company",
)
oracle("full_name", "select people_id, concat_ws(' ', first_name, last_name) full_name from stg_people")
oracle(
    "flag_labels",
    """select funding_round_id,
      case when is_first_round = 'true' then 'First Round' else 'Not First Round' end round_position_desc,
      case when is_last_round = 'true' then 'Last Round' else 'Ongoing Round' end round_stage_desc
    from stg_funding_rounds""",
)
oracle(
    "tri_state_label",
    """select relationship_id,
      case when is_past is null then 'Unknown' when is_past = 'TRUE' then 'Past' when is_past = 'FALSE' then 'Current'
        else is_past end relationship_status,
      case upper(is_past) when 'TRUE' then 'Past' when 'FALSE' then 'Current'
        else coalesce(is_past, 'Unknown') end status_any_case
    from stg_relationships""",
)


def _whole(kind: str) -> str:
    return (
        r"case when regexp_full_match(number_text, '\s*[+-]?\d+(\.\d*)?\s*') "
        f"then try_cast(trunc(try_cast(trim(number_text) as decimal(38,4))) as {kind}) end"
    )


oracle(
    "safe_casts",
    f"""select row_name, {_whole('bigint')} as_long, {_whole('int')} as_int,
      try_cast(amount_text as decimal(15,2)) as_declared, try_cast(amount_text as decimal(10,0)) as_whole,
      cast(cast(float_text as float) as decimal(10,6)) as_coordinate
    from stg_numbers""",
)
oracle("date_key", f"select acquisition_id, {_day('acquired_at')} acquired_at from stg_acquisition")
oracle(
    "timestamp_key",
    f"select relationship_id, {_moment('start_at')} start_at, {_moment('end_at')} end_at from stg_relationships",
)
oracle(
    "profile_filter",
    """select *, 'missing' as "check" from stg_people where first_name is null
    union all select *, 'equals' from stg_people where affiliation_name = 'BUILDING'""",
)

# Joins

oracle(
    "lookup_surrogate",
    "select ipo_id, company_id from stg_ipos left join dim_company on company_nk = object_id",
)
oracle(
    "role_playing_lookup",
    """select acquisition_id, a.company_id acquiring_company_id, b.company_id acquired_company_id
    from stg_acquisition left join dim_company a on a.company_nk = acquiring_object_id
    left join dim_company b on b.company_nk = acquired_object_id""",
)
oracle(
    "lookup_without_broadcast",
    """select investment_id, funding_round_id, company_id investor_company_id
    from stg_investments left join dim_company on company_nk = investor_object_id""",
)
_CTES["order_target"] = """
    select o_orderkey nk, o_orderstatus status, cast(floor(o_totalprice * 100 + 0.5) as bigint) amount,
      o_orderpriority priority
    from orders"""
_CTES["order_batch"] = """
    select l_orderkey * 2 nk, min(case when l_returnflag <> 'N' then l_returnflag end) status,
      cast(sum(floor(l_extendedprice * 100 + 0.5)) as bigint) amount
    from lineitem group by 1"""
oracle(
    "insert_only_load",
    """select nk, status, amount from order_target
    union all select * from order_batch where nk not in (select nk from order_target)""",
)
oracle(
    "fk_violations",
    """with late as (
      select cast(strftime(cast(l_shipdate as date) + interval 1248 month, '%Y%m%d') as bigint) k from lineitem)
    select 'company_id' column_name, l_partkey as value, count(*) n_rows from lineitem
    where not exists (select 1 from dim_company where company_id = l_partkey) group by l_partkey
    union all
    select 'shipped_at', k, count(*) from late where not exists (select 1 from days where date_id = k) group by k""",
)

# Columns that refer to each dimension, and how many of its rows the query leaves out.
_REFERENCES = {
    "dim_date": {
        "fact_relationships": "start_at end_at", "fact_acquisition": "acquired_at", "fact_funds": "funded_at",
        "fact_ipos": "public_at", "fact_milestones": "milestone_at", "fact_investment_round_participation": "funded_at",
    },
    "dim_company": {
        "fact_relationships": "company_id", "fact_acquisition": "acquiring_company_id acquired_company_id",
        "fact_funds": "company_id", "fact_ipos": "company_id", "fact_milestones": "company_id",
        "fact_investment_round_participation": "investor_company_id investee_company_id",
    },
    "dim_people": {"fact_relationships": "people_id"},
}
_LOST = {"dim_date": "v % 100 = 15", "dim_company": "v % 7 = 3", "dim_people": "v % 5 = 1"}
oracle(
    "fk_violations_of_facts",
    " union all ".join(
        f"""select '{table}' table_name, '{c}' column_name, '{dimension}' dimension, cast(v as bigint) as "value", count(*) n_rows
        from (select {c} v from {table}) where {_LOST[dimension]} group by v"""
        for dimension, tables in _REFERENCES.items() for table, columns in tables.items() for c in columns.split()
    ),
)

# Duplicates and set operations

oracle("dedup_by_key", "select investment_id, funding_round_id, investor_object_id from one_investment")
oracle("dedup_rows", "select distinct funding_round_id, investor_object_id from stg_investments")
oracle(
    "append_dedup",
    """select acquiring_object_id object_id, acquired_at happened_at from stg_acquisition
    union select object_id, funded_at from stg_funding_rounds""",
)

# Data quality and profiling

_TABLE_COLUMNS = {
    "dim_company": ("company_id", "company_nk", "description region city state_code country_code latitude longitude", ""),
    "dim_people": ("people_id", "people_nk", "first_name last_name affiliation birthplace full_name", ""),
    "fact_relationships": (
        "relationship_id",
        "relationship_nk",
        "title start_at end_at relationship_status relationship_order people_id company_id",
        "start_at end_at",
    ),
    "fact_acquisition": (
        "acquisition_id",
        "acquisition_nk",
        "acquired_at price_amount price_currency_code term_code acquiring_company_id acquired_company_id",
        "acquired_at",
    ),
    "fact_funds": (
        "fund_id",
        "fund_nk",
        "funded_at fund_name raised_amount raised_currency_code company_id",
        "funded_at",
    ),
    "fact_ipos": (
        "ipo_id",
        "ipo_nk",
        "public_at valuation_currency_code raised_currency_code valuation_amount raised_amount stock_symbol company_id",
        "public_at",
    ),
    "fact_milestones": (
        "milestone_id",
        "milestone_nk",
        "milestone_at description milestone_code company_id",
        "milestone_at",
    ),
    "fact_investment_round_participation": (
        "investment_round_participation_id",
        "investment_nk, funding_round_nk",
        "investor_company_id investee_company_id funded_at funding_round_type funding_round_code raised_amount "
        "pre_money_valuation post_money_valuation number_of_participants round_position_desc round_stage_desc",
        "funded_at",
    ),
}


def _missing(column: str, dates: str) -> str:
    return f"{column} = 21000101" if column in dates.split() else f"{column} is null"


def _summary(table: str) -> str:
    surrogate, _, columns, dates = _TABLE_COLUMNS[table]
    rows = [f"select '{table}' table_name, '{surrogate}' column_name, 0 num_missing"]
    rows += [f"select '{table}', '{c}', count(*) from {table} where {_missing(c, dates)}" for c in columns.split()]
    return " union all ".join(rows)


oracle("validation_report", " union all ".join(map(_summary, _TABLE_COLUMNS)))


def _detail(table: str) -> str:
    _, key, columns, dates = _TABLE_COLUMNS[table]
    return " union all ".join(
        f"select '{c}' column_name, {key} from {table} where {_missing(c, dates)}" for c in columns.split()
    )


oracle("validation_detail", _detail("fact_relationships"))
oracle(
    "validation_report_json",
    f"""with summary as ({_summary(LOADED[-1])}), detail as ({_detail(LOADED[-1])})
    select table_name, s.column_name, num_missing, investment_nk, funding_round_nk
    from summary s left join detail d on s.column_name = d.column_name""",
)
oracle(
    "constraint_violations",
    """select 'ipos' table_name, 'not_null' rule, 'ipo_id' column_name, count(*) violations from stg_ipos where ipo_id is null
    union all select 'ipos', 'not_null', 'public_at', count(*) from stg_ipos where public_at is null
    union all select 'ipos', 'not_null', 'raised_amount', count(*) from stg_ipos where raised_amount is null
    union all select 'ipos', 'unique', 'ipo_id', count(ipo_id) - count(distinct ipo_id) from stg_ipos
    union all select 'ipos', 'unique', 'public_at,valuation_amount', count(*) - count(distinct (public_at, valuation_amount))
      from stg_ipos where public_at is not null and valuation_amount is not null
    union all select 'ipos', 'max_length', 'stock_symbol', count(*) from stg_ipos where length(stock_symbol) > 5
    union all select 'ipos', 'max_length', 'object_id', count(*) from stg_ipos where length(object_id) > 255
    union all select 'ipos', 'fits_decimal', 'valuation_amount', count(*) from stg_ipos
      where valuation_amount is not null and try_cast(valuation_amount as decimal(10,0)) is null
    union all select 'ipos', 'fits_decimal', 'raised_amount', count(*) from stg_ipos
      where raised_amount is not null and try_cast(raised_amount as decimal(15,2)) is null
    union all select 'investments', 'unique', 'investment_id', count(*) - count(distinct investment_id) from stg_investments
    union all select 'investments', 'max_length', 'investor_object_id', count(*) from stg_investments
      where length(investor_object_id) > 4""",
)


_LENGTHS = {
    "dim_company": "company_nk region city state_code country_code",
    "dim_people": "people_nk first_name last_name affiliation birthplace full_name",
    "fact_relationships": "relationship_status",
    "fact_acquisition": "price_currency_code term_code",
    "fact_funds": "fund_name raised_currency_code",
    "fact_ipos": "valuation_currency_code raised_currency_code stock_symbol",
    "fact_milestones": "milestone_code",
    "fact_investment_round_participation": "funding_round_type funding_round_code round_position_desc round_stage_desc",
}


def _rule(table: str, rule: str, column: str, violations: str, where: str = "true") -> str:
    return f"select '{table}' table_name, '{rule}' rule, '{column}' column_name, {violations} violations from {table} where {where}"


def _rules(table: str) -> list[str]:
    surrogate, key, *_ = _TABLE_COLUMNS[table]
    # Surrogate ids are given out here by a number for each row, so none is missing or repeated.
    rows = [_rule(table, rule, surrogate, "0", "true limit 1") for rule in ("not_null", "unique")]
    rows = [f"select * from ({row})" for row in rows]
    parts = key.replace(" ", "").split(",")
    whole = " and ".join(f"{c} is not null" for c in parts)
    rows.append(_rule(table, "unique", ",".join(parts), f"count(*) - count(distinct ({key}))", whole))
    return rows + [_rule(table, "max_length", c, "count(*)", f"length({c}) > 10") for c in _LENGTHS[table].split()]


oracle(
    "declared_rules",
    " union all ".join(
        [
            _rule("dim_date", "not_null", "date_id", "count(*)", "date_id is null"),
            _rule("dim_date", "unique", "date_id", "count(*) - count(distinct date_id)"),
            _rule("dim_company", "unique", "region,city", "count(*) - count(distinct (region, city))", "region is not null and city is not null"),
            _rule("dim_company", "unique", "state_code", "count(state_code) - count(distinct state_code)"),
            *(row for table in _LENGTHS for row in _rules(table)),
        ]
    ),
)

_ROUND_COLUMNS = (
    "funding_round_id object_id funded_at funding_round_type funding_round_code raised_amount_usd "
    "pre_money_valuation_usd post_money_valuation_usd participants is_first_round is_last_round"
)
_STAGED_COLUMNS = {
    "company": "office_id object_id description region city state_code country_code latitude longitude created_at",
    "people": "people_id object_id first_name last_name affiliation_name birthplace",
    "relationships": "relationship_id person_object_id relationship_object_id title start_at end_at is_past sequence",
    "acquisition": "acquisition_id acquiring_object_id acquired_object_id acquired_at price_amount "
    "price_currency_code term_code",
    "funding_rounds": _ROUND_COLUMNS,
    "investments": "investment_id funding_round_id investor_object_id",
    "funds": "fund_id object_id name funded_at raised_amount raised_currency_code",
    "ipos": "ipo_id object_id public_at valuation_currency_code raised_currency_code valuation_amount raised_amount "
    "stock_symbol",
    "milestones": "milestone_id object_id milestone_at description milestone_code created_at",
}
oracle(
    "profile_info",
    " union all ".join(
        f"select '{t}' table_name, '{c}' column_name, count(*) n_rows, count({c}) n_non_null, 'string' data_type "
        f"from stg_{t}"
        for t, columns in _STAGED_COLUMNS.items()
        for c in columns.split()
    ),
)
oracle("profile_distinct", "select distinct end_at from stg_relationships")
oracle(
    "profile_missing_pct",
    " union all ".join(
        f"select '{c}' column_name, count(*) filter ({c} is null) / count(*) * 100 as value from stg_funding_rounds"
        for c in _ROUND_COLUMNS.split()
    ),
)
_DATE_TEXT = r"'^[0-9]{4}-(0?[1-9]|1[0-2])-(0?[1-9]|[12][0-9]|3[01])\b'"
oracle(
    "profile_valid_date_pct",
    " union all ".join(
        f"select '{c}' column_name, count(*) filter (regexp_matches({c}, {_DATE_TEXT})) / count(*) * 100 as value "
        "from stg_acquisition"
        for c in ("acquired_at", "price_amount")
    ),
)
oracle(
    "profile_negative",
    """select 'raised_amount' column_name, bool_or(try_cast(raised_amount as decimal(15,2)) < 0) as value from stg_funds
    union all select 'fund_id', bool_or(cast(fund_id as bigint) < 0) from stg_funds""",
)
oracle(
    "profile_value_counts",
    "select investor_object_id as value, count(*) n_rows from stg_investments group by investor_object_id",
)
oracle(
    "profile_report",
    f"""select 'relationship_id' column_name, 'data_type' as "check", 'string' as value, cast(null as decimal(5,2)) percent
    union all select 'sequence', 'data_type', 'string', null
    union all select 'title', 'unique_value', title, null from (select distinct title from stg_relationships)
    union all select 'is_past', 'unique_value', is_past, null from (select distinct is_past from stg_relationships)
    union all select 'start_at', 'percentage_missing_value', null,
      cast(round(count(*) filter (start_at is null) / count(*) * 100, 2) as decimal(5,2)) from stg_relationships
    union all select 'end_at', 'percentage_missing_value', null,
      cast(round(count(*) filter (end_at is null) / count(*) * 100, 2) as decimal(5,2)) from stg_relationships
    union all select 'start_at', 'percentage_valid_date', null,
      cast(round(count(*) filter (regexp_matches(start_at, {_DATE_TEXT})) / count(*) * 100, 2) as decimal(5,2))
      from stg_relationships""",
)

# Calendar

oracle(
    "dim_date",
    f"""with keyed as (select acquisition_id, {_day('acquired_at')} k from stg_acquisition)
    select acquisition_id, c.* from keyed left join dim_date c on k = date_id""",
)

oracle(
    "calendar_days",
    f"""with acquired as (select {_day('acquired_at')} k, count(*) n from stg_acquisition group by 1)
    select c.*, n n_acquisitions from dim_date c left join acquired on k = date_id""",
)

# Loading

oracle(
    "upsert_single_key",
    """select row_number() over (order by nk) id, nk, case when b.nk is null then t.status else b.status end status,
      case when b.nk is null then t.amount else b.amount end amount, priority
    from order_target t left join order_batch b using (nk)
    union all
    select (select count(*) from order_target) + row_number() over (order by nk), nk, status, amount, null
    from order_batch where nk not in (select nk from order_target)""",
)

ORACLES["upsert_in_buckets"] = ORACLES["upsert_single_key"]


def _lines(line: str) -> str:
    return f"""select l_orderkey order_nk, {line} line_nk,
      cast(sum(floor(l_quantity * 100 + 0.5)) as bigint) quantity, count(*) n_lines
      from lineitem group by all"""


oracle(
    "upsert_composite_key",
    f"""with a as ({_lines('l_linenumber')}), b as ({_lines('l_linenumber + 2')})
    select row_number() over (order by a.order_nk, a.line_nk) id, a.order_nk, a.line_nk,
      coalesce(b.quantity, a.quantity) quantity, a.n_lines
    from a left join b on a.order_nk = b.order_nk and a.line_nk = b.line_nk
    union all
    select (select count(*) from a) + row_number() over (order by order_nk, line_nk), order_nk, line_nk, quantity, null
    from b where not exists (select 1 from a where a.order_nk = b.order_nk and a.line_nk = b.line_nk)""",
)
_SPARSE = _lines("case when l_linenumber > 2 then l_linenumber end")
oracle(
    "upsert_null_key",
    f"""with a as ({_SPARSE}), n as (select count(*) n from a)
    select row_number() over (order by order_nk, line_nk nulls first) id, order_nk, line_nk,
      case when line_nk is null then quantity else quantity + 1 end quantity, n_lines from a
    union all
    select n + row_number() over (order by order_nk), order_nk, line_nk, quantity + 1, n_lines
    from a, n where line_nk is null""",
)
oracle(
    "upsert_null_safe_key",
    f"""with a as ({_SPARSE})
    select row_number() over (order by order_nk, line_nk nulls first) id, order_nk, line_nk, quantity + 1 quantity, n_lines
    from a""",
)
oracle("first_load", "select * from dim_company")
oracle(
    "assign_surrogate",
    "select 1000 + row_number() over (order by acquisition_id) id, acquisition_id nk from stg_acquisition",
)
oracle(
    "batch_duplicate_keys",
    "select investment_id, count(*) n_rows from stg_investments group by investment_id having count(*) > 1",
)

oracle(
    "run_log_summary",
    # Eight tables are built, validated and loaded; the driver tables have no row that a declared rule rejects.
    """select 'warehouse' step, unnest(['transform', 'validation', 'load']) process, 'success' status,
      cast(8 as bigint) n_runs, cast(0 as bigint) n_rejected""",
)

# Staging and daily runs

oracle(
    "stage_from_database",
    """select milestone_id, object_id, milestone_at, replace(description, chr(10), ' ') description, milestone_code,
      created_at from stg_milestones""",
)
oracle("stage_from_files", "select * from stg_people")
oracle("stage_from_pages", "select * from clean_pages")
oracle("stage_from_landed_stream", "select * from clean_pages")
oracle(
    "daily_refresh",
    f"""select row_number() over (order by milestone_nk) milestone_id, milestone_nk, f.milestone_at, f.description,
      case when left(created_at, 10) = cast(cast(date '{SLICE_RUN_DATE}' - interval 1 day as date) as varchar)
        then upper(f.milestone_code) else f.milestone_code end milestone_code, company_id
    from fact_milestones f join stg_milestones s on cast(s.milestone_id as bigint) = milestone_nk""",
)

oracle(
    "daily_refresh_from_slices",
    f"""select row_number() over (order by milestone_nk) milestone_id, f.*
    from fact_milestones f join stg_milestones s on cast(s.milestone_id as bigint) = milestone_nk
    where left(created_at, 10) = cast(cast(date '{SLICE_RUN_DATE}' - interval 1 day as date) as varchar)""",
)
# Rows were created on 2024-01-10 and the nine days after it, by the last digit of their key.
_DAYS_ON = f"datediff('day', date '2024-01-10', date '{SLICE_RUN_DATE}' - interval 1 day)"
oracle(
    "daily_participation",
    f"""select row_number() over (order by investment_nk, funding_round_nk nulls first) investment_round_participation_id, p.*
    from fact_investment_round_participation p
    where investment_nk % 10 = {_DAYS_ON}
      or funding_round_nk in (select funding_round_nk from temp_funding_rounds where (funding_round_nk % 10 + 10) % 10 = {_DAYS_ON})""",
)
oracle(
    "late_arriving_companies",
    """select ipo_nk, public_at, stock_symbol, company_nk, company_id is null waits
    from fact_ipos left join dim_company using (company_id)""",
)
oracle(
    "merged_profiles",
    " union all ".join(
        f"""select '{c}' column_name, count(*) n_rows, count(*) - count({c}) n_missing, count(distinct {c}) n_exact,
        true within_bound from stg_milestones"""
        for c in ("milestone_id", "object_id", "milestone_at", "milestone_code")
    ),
)
oracle(
    "stage_typed_rows",
    """select cast(event_id as varchar) milestone_id, cast(cast(ts as date) as varchar) created_at,
      cast(cast(value as decimal(12,2)) as varchar) amount, case when user_id % 2 = 0 then 'true' else 'false' end is_even,
      replace(replace(props, chr(13), ' '), chr(10), ' ') props
    from events""",
)

# Questions

oracle(
    "partners_of_investors",
    """with m as (
      select distinct funding_round_nk r, investor_company_id i from fact_investment_round_participation
      where funding_round_nk is not null and investor_company_id is not null)
    select a.i investor_company_id, b.i partner_company_id, count(*) shared_rounds
    from m a join m b on a.r = b.r and a.i <> b.i where a.i % 20 = 0 group by a.i, b.i""",
)
oracle(
    "top_acquirers",
    """select company_id, company_nk, country_code, count(*) n_acquisitions, sum(price_amount) total_price
    from fact_acquisition join dim_company on company_id = acquiring_company_id
    group by all order by n_acquisitions desc, total_price desc, company_id limit 10""",
)
oracle(
    "ipo_valuation_by_year",
    """with dated as (select *, public_at // 10000 as y from fact_ipos where public_at <> 21000101)
    select cast(y as int) as "year", valuation_currency_code currency_code, count(*) n_ipos, count(valuation_amount) n_valued,
      sum(valuation_amount) total_valuation, cast(sum(valuation_amount) as double) / count(valuation_amount) avg_valuation
    from dated where y > (select max(y) from dated) - 5 group by y, valuation_currency_code""",
)
oracle(
    "co_investors",
    """with m as (
      select distinct funding_round_nk r, investor_company_id i from fact_investment_round_participation
      where funding_round_nk is not null and investor_company_id is not null),
    sized as (select r, count(*) size from m group by r)
    select i investor_company_id, count(*) n_rounds, count(*) filter (where size > 1) shared_rounds,
      cast(sum(size - 1) as bigint) partner_seats
    from m join sized using (r) group by i""",
)
oracle(
    "round_to_milestone",
    """with dated as (select * from rounds where funded_at <> 21000101 and investee_company_id is not null),
    ahead as (
      select funding_round_nk, m.milestone_nk, m.milestone_at,
        row_number() over (partition by funding_round_nk order by m.milestone_at, m.milestone_nk) rn
      from dated join fact_milestones m on m.company_id = investee_company_id
        and m.milestone_at > funded_at and m.milestone_at <> 21000101)
    select funding_round_nk, investee_company_id company_id, funded_at, milestone_nk, milestone_at,
      cast(cast(strptime(cast(milestone_at as varchar), '%Y%m%d') as date)
        - cast(strptime(cast(funded_at as varchar), '%Y%m%d') as date) as int) days_between
    from dated left join (select * from ahead where rn = 1) using (funding_round_nk)""",
)
oracle(
    "fund_history",
    """with d as (
      select company_id, raised_currency_code, funded_at, count(*) n_funds, sum(raised_amount) raised from fact_funds
      where funded_at <> 21000101 and company_id is not null group by all)
    select *, (select sum(raised) from d e where e.company_id = d.company_id
        and e.raised_currency_code = d.raised_currency_code and e.funded_at <= d.funded_at) raised_so_far,
      (select cast(sum(n_funds) as bigint) from d e where e.company_id = d.company_id
        and e.raised_currency_code = d.raised_currency_code and e.funded_at <= d.funded_at) funds_so_far,
      (select max(funded_at) from d e where e.company_id = d.company_id
        and e.raised_currency_code = d.raised_currency_code and e.funded_at < d.funded_at) former_funded_at
    from d""",
)
oracle(
    "acquisition_rollup",
    """with located as (
      select cast(acquired_at // 10000 as int) as y, cast((acquired_at // 100 % 100 + 2) // 3 as int) as q,
        coalesce(region, 'Unknown') region, price_amount
      from fact_acquisition left join dim_company on company_id = acquired_company_id where acquired_at <> 21000101)
    select y as "year", q as "quarter", region, cast(grouping(y, q, region) as int) as "level",
      count(*) n_acquisitions, sum(price_amount) total_price
    from located group by rollup (y, q, region)""",
)
oracle(
    "exit_comparison",
    """select cast(day_key // 10000 as int) as "year", count(*) filter (kind = 'acquisition') n_acquisitions,
      count(*) filter (kind = 'ipo') n_ipos, sum(amount) filter (kind = 'acquisition') acquisition_value,
      sum(amount) filter (kind = 'ipo') ipo_value
    from exits group by day_key // 10000""",
)
oracle(
    "capital_to_exit",
    """with capital as (
      select investee_company_id company_id, count(*) n_rounds, sum(raised_amount) capital_in from rounds
      where investee_company_id is not null group by investee_company_id),
    sold as (
      select acquired_company_id company_id, cast(price_amount as decimal(20,2)) amount from fact_acquisition
      union all select company_id, valuation_amount from fact_ipos),
    gains as (select company_id, count(*) n, sum(amount) amount from sold where company_id is not null group by company_id)
    select c.company_id, n_rounds, capital_in, coalesce(n, 0) n_exits, amount exit_value,
      cast(amount as double) / cast(capital_in as double) exit_per_capital
    from capital c left join gains g on c.company_id = g.company_id""",
)
oracle(
    "exit_trend",
    " union all ".join(
        f"""select kind, '{period}' period, cast(date_trunc('{period}', d) as date) starts_on, count(*) n_exits,
        sum(amount) exit_value from exits join days on day_key = date_id group by all"""
        for period in ("week", "month", "quarter", "year")
    ),
)
oracle(
    "exit_seasonality",
    """select kind, cast(month(d) as int) month_actual, strftime(d, '%B') month_name, count(*) n_exits,
      count(distinct year(d)) n_years, count(*) / count(distinct year(d)) exits_per_year
    from exits join days on day_key = date_id group by all""",
)
oracle(
    "career_path",
    """with dated as (select * from fact_relationships where people_id is not null and start_at <> 21000101),
    steps as (select distinct people_id, start_at from dated)
    select d.people_id, cast(dense_rank() over (partition by d.people_id order by d.start_at) as int) step_no,
      relationship_nk, title, company_id, d.start_at, n.start_at next_start_at,
      cast(cast(strptime(cast(n.start_at as varchar), '%Y%m%d') as date)
        - cast(strptime(cast(d.start_at as varchar), '%Y%m%d') as date) as int) days_to_next
    from dated d left join (
      select people_id, start_at as from_day, lead(start_at) over (partition by people_id order by start_at) start_at
      from steps) n on n.people_id = d.people_id and from_day = d.start_at""",
)
oracle(
    "career_contribution",
    """select people_id, count(*) n_positions, count(distinct company_id) n_companies
    from fact_relationships where people_id is not null group by people_id""",
)
oracle(
    "milestones_by_region",
    """with counted as (
      select region, count(*) n_milestones, count(distinct company_id) n_companies
      from fact_milestones join dim_company using (company_id) group by region)
    select *, cast(rank() over (order by n_milestones desc) as int) place from counted""",
)
