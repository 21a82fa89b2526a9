"""The warehouse tables: columns, keys, lookups and declared rules."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from starfold.functions.casts import to_decimal, to_float, to_int, to_long
from starfold.functions.dates import date_key, timestamp_key
from starfold.functions.labels import flag_label, full_name, or_default, past_or_current


def as_is(c: Column) -> Column:
    return c


@dataclass(frozen=True)
class Field:
    """A target column computed from one or more staged columns."""

    name: str
    sources: tuple[str, ...]
    make: Callable[..., Column] = as_is
    max_length: int | None = None

    def column(self) -> Column:
        return self.make(*map(F.col, self.sources)).alias(self.name)


def field(name: str, source: str | None = None, make: Callable[..., Column] = as_is, max_length: int | None = None) -> Field:
    return Field(name, (source or name,), make, max_length)


@dataclass(frozen=True)
class Lookup:
    """A staged natural key that becomes a dimension's surrogate id."""

    source: str
    dimension: str
    as_id: str

    @property
    def nk(self) -> str:
        return self.as_id.removesuffix("_id") + "_nk"


@dataclass(frozen=True)
class TableSpec:
    name: str
    staged: str
    key: tuple[str, ...]
    fields: tuple[Field, ...]
    lookups: tuple[Lookup, ...] = ()
    surrogate: str | None = None
    one_row_per: str | None = None
    date_cols: tuple[str, ...] = ()
    refresh: str = "daily"

    @property
    def staged_columns(self) -> list[str]:
        names = [s for f in self.fields for s in f.sources] + [k.source for k in self.lookups]
        return list(dict.fromkeys(names))

    @property
    def lengths(self) -> dict[str, int]:
        return {f.name: f.max_length for f in self.fields if f.max_length}


# (dimension, natural key, surrogate id)
DIMENSION_KEYS = {
    "dim_company": ("company_nk", "company_id"),
    "dim_people": ("people_nk", "people_id"),
}


def legacy_money(c: Column) -> Column:
    """Amounts as whole units of at most ten digits; larger ones become NULL."""
    return to_decimal(10, 0)(c)


def declared_money(c: Column) -> Column:
    return to_decimal(15, 2)(c)


def wide_money(c: Column) -> Column:
    return to_decimal(20, 2)(c)


DIM_COMPANY = TableSpec(
    name="dim_company",
    staged="company",
    key=("company_nk",),
    surrogate="company_id",
    one_row_per="object_id",
    fields=(
        field("company_nk", "object_id", max_length=255),
        field("description"),
        field("region", max_length=255),
        field("city", make=or_default("Unknown"), max_length=255),
        field("state_code", make=or_default("N/A"), max_length=255),
        field("country_code", max_length=255),
        field("latitude", make=lambda c: to_float(c).try_cast("decimal(10,6)")),
        field("longitude", make=lambda c: to_float(c).try_cast("decimal(10,6)")),
    ),
)

DIM_PEOPLE = TableSpec(
    name="dim_people",
    staged="people",
    key=("people_nk",),
    surrogate="people_id",
    one_row_per="object_id",
    refresh="full",
    fields=(
        field("people_nk", "object_id", max_length=255),
        field("first_name", max_length=255),
        field("last_name", max_length=255),
        field("affiliation", "affiliation_name", max_length=255),
        field("birthplace", max_length=255),
        Field("full_name", ("first_name", "last_name"), full_name, 255),
    ),
)

FACT_RELATIONSHIPS = TableSpec(
    name="fact_relationships",
    staged="relationships",
    key=("relationship_nk",),
    surrogate="relationship_id",
    refresh="full",
    date_cols=("end_at", "start_at"),
    fields=(
        field("relationship_nk", "relationship_id", to_long),
        field("title"),
        field("start_at", make=timestamp_key),
        field("end_at", make=timestamp_key),
        field("relationship_status", "is_past", past_or_current, 255),
        field("relationship_order", "sequence", to_int),
    ),
    lookups=(
        Lookup("person_object_id", "dim_people", "people_id"),
        Lookup("relationship_object_id", "dim_company", "company_id"),
    ),
)


def acquisition_spec(money: Callable[[Column], Column] = declared_money) -> TableSpec:
    return TableSpec(
        name="fact_acquisition",
        staged="acquisition",
        key=("acquisition_nk",),
        surrogate="acquisition_id",
        date_cols=("acquired_at",),
        fields=(
            field("acquisition_nk", "acquisition_id", to_long),
            field("acquired_at", make=date_key),
            field("price_amount", make=money),
            field("price_currency_code", max_length=255),
            field("term_code", make=or_default("Unknown"), max_length=255),
        ),
        lookups=(
            Lookup("acquiring_object_id", "dim_company", "acquiring_company_id"),
            Lookup("acquired_object_id", "dim_company", "acquired_company_id"),
        ),
    )


FACT_ACQUISITION = acquisition_spec()

FUNDING_ROUNDS = TableSpec(
    name="temp_funding_rounds",
    staged="funding_rounds",
    key=("funding_round_nk",),
    one_row_per="funding_round_id",
    date_cols=("funded_at",),
    fields=(
        field("funding_round_nk", "funding_round_id", to_long),
        field("funded_at", make=date_key),
        field("funding_round_type", max_length=255),
        field("funding_round_code", max_length=255),
        field("raised_amount", "raised_amount_usd"),
        field("pre_money_valuation", "pre_money_valuation_usd"),
        field("post_money_valuation", "post_money_valuation_usd"),
        field("number_of_participants", "participants", to_int),
        field("round_position_desc", "is_first_round", flag_label("First Round", "Not First Round"), 50),
        field("round_stage_desc", "is_last_round", flag_label("Last Round", "Ongoing Round"), 50),
    ),
    lookups=(Lookup("object_id", "dim_company", "investee_company_id"),),
)

INVESTMENTS = TableSpec(
    name="temp_investments",
    staged="investments",
    key=("investment_nk",),
    one_row_per="investment_id",
    fields=(
        field("investment_nk", "investment_id", to_long),
        field("funding_round_nk", "funding_round_id", to_long),
    ),
    lookups=(Lookup("investor_object_id", "dim_company", "investor_company_id"),),
)

PARTICIPATION = "fact_investment_round_participation"
PARTICIPATION_KEY = ("investment_nk", "funding_round_nk")
PARTICIPATION_ID = "investment_round_participation_id"
ROUND_AMOUNTS = ("raised_amount", "pre_money_valuation", "post_money_valuation")

FACT_FUNDS = TableSpec(
    name="fact_funds",
    staged="funds",
    key=("fund_nk",),
    surrogate="fund_id",
    one_row_per="fund_id",
    date_cols=("funded_at",),
    fields=(
        field("fund_nk", "fund_id", to_long),
        field("funded_at", make=date_key),
        field("fund_name", "name", max_length=255),
        field("raised_amount", make=wide_money),
        field("raised_currency_code", max_length=255),
    ),
    lookups=(Lookup("object_id", "dim_company", "company_id"),),
)

FACT_IPOS = TableSpec(
    name="fact_ipos",
    staged="ipos",
    key=("ipo_nk",),
    surrogate="ipo_id",
    one_row_per="ipo_id",
    date_cols=("public_at",),
    fields=(
        field("ipo_nk", "ipo_id", to_long),
        field("public_at", make=date_key),
        field("valuation_currency_code", max_length=255),
        field("raised_currency_code", max_length=255),
        field("valuation_amount", make=wide_money),
        field("raised_amount", make=wide_money),
        field("stock_symbol", max_length=255),
    ),
    lookups=(Lookup("object_id", "dim_company", "company_id"),),
)

FACT_MILESTONES = TableSpec(
    name="fact_milestones",
    staged="milestones",
    key=("milestone_nk",),
    surrogate="milestone_id",
    one_row_per="milestone_id",
    date_cols=("milestone_at",),
    fields=(
        field("milestone_nk", "milestone_id", to_long),
        field("milestone_at", make=date_key),
        field("description"),
        field("milestone_code", max_length=255),
    ),
    lookups=(Lookup("object_id", "dim_company", "company_id"),),
)

DIMENSIONS = (DIM_COMPANY, DIM_PEOPLE)
FACTS = (FACT_RELATIONSHIPS, FACT_ACQUISITION, FACT_FUNDS, FACT_IPOS, FACT_MILESTONES)
BY_NAME = {spec.name: spec for spec in (*DIMENSIONS, *FACTS, FUNDING_ROUNDS, INVESTMENTS)}

# Staged tables and the keys they are loaded by.
STAGED_KEYS = {
    "company": "object_id",
    "funds": "fund_id",
    "acquisition": "acquisition_id",
    "funding_rounds": "funding_round_id",
    "investments": "investment_id",
    "ipos": "ipo_id",
    "milestones": "milestone_id",
    "people": "people_id",
    "relationships": "relationship_id",
}


@dataclass(frozen=True)
class Rules:
    """What a loaded table must hold to: columns that have a value, unique keys, longest texts, references."""

    required: tuple[str, ...]
    unique: tuple[tuple[str, ...], ...]
    lengths: dict[str, int]
    refers_to: dict[str, str]


def _rules(surrogate: str, key: tuple[str, ...], lengths: dict[str, int], lookups: tuple[Lookup, ...], dates: tuple[str, ...]) -> Rules:
    refers_to = {k.as_id: k.dimension for k in lookups} | {c: "dim_date" for c in dates}
    return Rules((surrogate,), ((surrogate,), key), lengths, refers_to)


# The declared rules of every loaded table.
RULES = {
    "dim_date": Rules(("date_id",), (("date_id",),), {}, {}),
    **{s.name: _rules(s.surrogate, s.key, s.lengths, s.lookups, s.date_cols) for s in (*DIMENSIONS, *FACTS)},
    PARTICIPATION: _rules(
        PARTICIPATION_ID, PARTICIPATION_KEY, FUNDING_ROUNDS.lengths, (*INVESTMENTS.lookups, *FUNDING_ROUNDS.lookups),
        FUNDING_ROUNDS.date_cols,
    ),
}
# The key that references to a dimension hold.
REFERRED_KEYS = {"dim_date": "date_id"} | {name: dimension_id for name, (_, dimension_id) in DIMENSION_KEYS.items()}
