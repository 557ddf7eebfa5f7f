"""Table, hub, link and satellite definitions.

Column names and types below are the fixed data model of the warehouse.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

STRING, DOUBLE, BIGINT, DATE, INSTANT = (
    T.StringType(),
    T.DoubleType(),
    T.LongType(),
    T.DateType(),
    T.TimestampNTZType(),
)


def struct(*columns: tuple) -> T.StructType:
    """Schema from ``(name, type)`` or ``(name, type, "required")`` entries."""
    return T.StructType([T.StructField(c[0], c[1], nullable=len(c) < 3) for c in columns])


@dataclass(frozen=True)
class TableSpec:
    """One stored table: shape, keys, layout and value rules."""

    name: str
    schema: T.StructType
    keys: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    bucket_by: str | None = None
    subpath: str | None = None
    checks: dict[str, str] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def not_null(self) -> list[str]:
        return [f.name for f in self.schema if not f.nullable]

    def location(self, base: str) -> str:
        return f"{base.rstrip('/')}/{self.subpath or self.name}"


@dataclass(frozen=True)
class HubSpec:
    """A business key and its hash key."""

    table: TableSpec
    hash_key: str
    business_key: str


@dataclass(frozen=True)
class LinkSpec:
    """A combination of business keys; ``hubs`` are the hubs it points at, in key order."""

    table: TableSpec
    link_key: str
    hubs: tuple[HubSpec, ...]

    @property
    def business_keys(self) -> list[str]:
        return [h.business_key for h in self.hubs]


@dataclass(frozen=True)
class SatSpec:
    """Descriptive attributes of a hub or link; ``versioned`` adds validity intervals."""

    table: TableSpec
    parent_key: str
    attributes: tuple[str, ...]
    versioned: bool


AUDIT = (("Load_DTS", INSTANT, "required"), ("Record_Source", STRING, "required"))
PRICES = (
    ("Open", DOUBLE),
    ("High", DOUBLE),
    ("Low", DOUBLE),
    ("Close", DOUBLE),
    ("Volume", BIGINT),
    ("Dividends", DOUBLE),
    ("Stock_Splits", DOUBLE),
)
PRICE_COLUMNS = tuple(name for name, _ in PRICES)
VALIDITY = (("Effective_DTS", INSTANT, "required"), ("End_DTS", INSTANT))

#: Value rules of a daily bar: rule name -> condition a good row meets.
BAR_CHECKS = {
    "date_check": "Date IS NOT NULL",
    "symbol_check": "Symbol IS NOT NULL",
    "positive_open": "Open IS NOT NULL AND Open > 0",
    "positive_high": "High IS NOT NULL AND High > 0",
    "positive_low": "Low IS NOT NULL AND Low > 0",
    "positive_close": "Close IS NOT NULL AND Close > 0",
    "positive_volume": "Volume IS NOT NULL AND Volume > 0",
}

#: A minute bar needs its key; its prices are not judged.
MINUTE_CHECKS = {"datetime_check": "DateTime IS NOT NULL", "symbol_check": "Symbol IS NOT NULL"}
COMPANY_CHECKS = {"symbol_check": "symbol IS NOT NULL"}

# Bronze
HISTORICALS = TableSpec(
    "historicals",
    struct(("Date", DATE), ("Symbol", STRING), *PRICES),
    keys=("Symbol", "Date"),
    bucket_by="Symbol",  # a folder for each symbol would be far too many
    checks=BAR_CHECKS,
)
MINUTE_HISTORICALS = TableSpec(
    "minute_historicals",
    struct(("DateTime", INSTANT), ("Symbol", STRING), *PRICES),
    keys=("Symbol", "DateTime"),
    bucket_by="Symbol",
    subpath="historicals_minute",
    checks=MINUTE_CHECKS,
)
COMPANY = TableSpec(
    "company",
    struct(
        ("symbol", STRING),
        ("longName", STRING),
        ("marketCap", BIGINT),
        ("priceToEarnings", DOUBLE),
        ("dividendYield", DOUBLE),
        ("totalRevenue", BIGINT),
        ("netIncome", BIGINT),
        ("bookValuePerShare", DOUBLE),
        ("priceToBook", DOUBLE),
        ("forwardEps", DOUBLE),
    ),
    keys=("symbol",),
    checks=COMPANY_CHECKS,
)
BRONZE_TABLES = (HISTORICALS, COMPANY, MINUTE_HISTORICALS)

# Hubs
HUB_INSTRUMENT = HubSpec(
    TableSpec(
        "hub_instrument",
        struct(("Instrument_HK", STRING, "required"), ("Symbol", STRING, "required"), *AUDIT),
        keys=("Instrument_HK",),
        bucket_by="Instrument_HK",
    ),
    "Instrument_HK",
    "Symbol",
)
HUB_CALENDAR = HubSpec(
    TableSpec(
        "hub_calendar",
        struct(("Calendar_HK", STRING, "required"), ("Date", DATE, "required"), *AUDIT),
        keys=("Calendar_HK",),
    ),
    "Calendar_HK",
    "Date",
)
HUB_TIME = HubSpec(
    TableSpec(
        "hub_time",
        struct(("Time_HK", STRING, "required"), ("DateTime", INSTANT, "required"), *AUDIT),
        keys=("Time_HK",),
    ),
    "Time_HK",
    "DateTime",
)
HUBS = (HUB_INSTRUMENT, HUB_CALENDAR, HUB_TIME)

# Links
LINK_INSTRUMENT_DAY = LinkSpec(
    TableSpec(
        "link_instrument_day",
        struct(
            ("Instrument_Day_LK", STRING, "required"),
            ("Instrument_HK", STRING, "required"),
            ("Calendar_HK", STRING, "required"),
            *AUDIT,
        ),
        keys=("Instrument_Day_LK",),
        bucket_by="Instrument_Day_LK",
    ),
    "Instrument_Day_LK",
    (HUB_INSTRUMENT, HUB_CALENDAR),
)
LINK_INSTRUMENT_MINUTE = LinkSpec(
    TableSpec(
        "link_instrument_minute",
        struct(
            ("Instrument_Minute_LK", STRING, "required"),
            ("Instrument_HK", STRING, "required"),
            ("Time_HK", STRING, "required"),
            *AUDIT,
        ),
        keys=("Instrument_Minute_LK",),
        bucket_by="Instrument_Minute_LK",
    ),
    "Instrument_Minute_LK",
    (HUB_INSTRUMENT, HUB_TIME),
)
LINKS = (LINK_INSTRUMENT_DAY, LINK_INSTRUMENT_MINUTE)

# Satellites
SAT_DAY_PRICES = SatSpec(
    TableSpec(
        "sat_instrument_day_prices",
        struct(
            ("Instrument_Day_LK", STRING, "required"),
            *PRICES,
            ("Hash_Diff", STRING),
            *AUDIT,
        ),
        keys=("Instrument_Day_LK", "Hash_Diff"),
        bucket_by="Instrument_Day_LK",
    ),
    "Instrument_Day_LK",
    PRICE_COLUMNS,
    versioned=False,
)
SAT_MINUTE_PRICES = SatSpec(
    TableSpec(
        "sat_instrument_minute_prices",
        struct(
            ("Instrument_Minute_LK", STRING, "required"),
            *PRICES,
            ("Hash_Diff", STRING),
            AUDIT[0],
            *VALIDITY,
            AUDIT[1],
        ),
        keys=("Instrument_Minute_LK", "Effective_DTS"),
        bucket_by="Instrument_Minute_LK",
    ),
    "Instrument_Minute_LK",
    PRICE_COLUMNS,
    versioned=True,
)
SAT_COMPANY_INFO = SatSpec(
    TableSpec(
        "sat_company_info",
        struct(
            ("Instrument_HK", STRING, "required"),
            ("longName", STRING),
            ("marketCap", BIGINT),
            ("Hash_Diff", STRING),
            AUDIT[0],
            *VALIDITY,
            AUDIT[1],
        ),
        keys=("Instrument_HK", "Effective_DTS"),
        bucket_by="Instrument_HK",
    ),
    "Instrument_HK",
    ("longName", "marketCap"),
    versioned=True,
)
SATELLITES = (SAT_DAY_PRICES, SAT_MINUTE_PRICES, SAT_COMPANY_INFO)

VAULT_TABLES = tuple(s.table for s in (*HUBS, *LINKS, *SATELLITES))

# Raw landing files. Dates stay text: the offset is part of the value.
RAW_BAR_VALUES = tuple((n.replace("_", " "), t) for n, t in PRICES)
RAW_DAILY = struct(("Date", STRING), *RAW_BAR_VALUES)
RAW_MINUTE = struct(("Datetime", STRING), *RAW_BAR_VALUES)
RAW_COMPANY = struct(
    ("symbol", STRING),
    ("longName", STRING),
    ("marketCap", BIGINT),
    ("currentPrice", DOUBLE),
    ("trailingEps", DOUBLE),
    ("dividendYield", DOUBLE),
    ("totalRevenue", BIGINT),
    ("netIncomeToCommon", BIGINT),
    ("bookValue", DOUBLE),
    ("priceToBook", DOUBLE),
    ("forwardEps", DOUBLE),
)


@dataclass(frozen=True)
class Grain:
    """Everything that differs between daily and minute bars."""

    name: str
    time: str
    raw_time: str
    raw_schema: T.StructType
    raw_glob: str
    bronze: TableSpec
    hub: HubSpec
    link: LinkSpec
    sat: SatSpec
    range_name: str
    period: str  # table partition of the vault's bar-sized tables


DAY = Grain(
    "daily",
    "Date",
    "Date",
    RAW_DAILY,
    "*/historical/daily.csv",
    HISTORICALS,
    HUB_CALENDAR,
    LINK_INSTRUMENT_DAY,
    SAT_DAY_PRICES,
    "Intraday_Range",
    "year",
)
MINUTE = Grain(
    "minute",
    "DateTime",
    "Datetime",
    RAW_MINUTE,
    "*/historical_minute/minute.csv",
    MINUTE_HISTORICALS,
    HUB_TIME,
    LINK_INSTRUMENT_MINUTE,
    SAT_MINUTE_PRICES,
    "Intra_Minute_Range",
    "month",
)
