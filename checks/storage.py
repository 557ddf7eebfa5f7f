"""Queries over scans, sinks, batch logs and the table registry.

Each writes whole frames to a new shared folder and returns what is read back.
"""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import frames as fr
from checks.frames import LOADS, sql
from checks.registry import ORACLES, query
from pricevault import catalog as cat
from pricevault import shared_dir
from pricevault.operators.views import create_views, view_name
from pricevault.plans.jobs import register_vault
from pricevault.schemas import (
    BRONZE_TABLES,
    COMPANY,
    DAY,
    HISTORICALS,
    MINUTE,
    PRICE_COLUMNS,
    VAULT_TABLES,
)
from pricevault.session import shuffles_freed
from pricevault.sources.landing import land_once, read_landed
from pricevault.sources.readers import (
    SYMBOL_PARTITION,
    read_bars_csv,
    read_company_json,
    read_source,
)
from pricevault.sources.tablelog import (
    append,
    append_log,
    by_partition,
    ensure_table,
    history,
    overwrite,
    read_as_of,
    read_log,
)

PRICES = "Open, High, Low, Close, Volume, Dividends, Stock_Splits"
RAW = PRICES.replace("Stock_Splits", 'Stock_Splits AS "Stock Splits"')
BARS = f"Date, Symbol, {PRICES}"
HIST = sql(f"SELECT {BARS} FROM hist", "hist")
EVEN = "CAST(substr(Symbol, 2) AS BIGINT) % 2 = 0"


# Scans


@query(
    "src_csv_daily",
    sql(
        f"SELECT Symbol, strftime(Date, '%Y-%m-%d') || ' 00:00:00' || "
        f"CASE WHEN {EVEN} THEN '-05:00' ELSE '+09:00' END AS Date, {RAW} FROM hist",
        "hist",
    ),
)
def src_csv_daily(spark, d):
    base, raw = shared_dir(spark, "landing-daily"), fr.raw_daily(fr.hist(spark, d))
    land_once(raw, base, 1, "csv")
    return read_landed(spark, base, raw.schema, "csv")


@query(
    "src_csv_minute",
    sql(
        f"SELECT Symbol, CASE WHEN {EVEN} "
        "THEN strftime(DateTime - INTERVAL 5 HOUR, '%Y-%m-%d %H:%M:%S') || '-05:00' "
        "ELSE strftime(DateTime + INTERVAL 9 HOUR, '%Y-%m-%d %H:%M:%S') || '+09:00' END AS Datetime, "
        f"{RAW} FROM minute",
        "minute",
    ),
)
def src_csv_minute(spark, d):
    """One folder per symbol, as raw zones of single fetches have it: symbol from the path."""
    base, raw = shared_dir(spark, "landing-minute"), fr.raw_minute(fr.minute(spark, d))
    files = by_partition(raw, ["Symbol"]).write.partitionBy("Symbol")
    files.option("header", True).csv(base)
    return read_bars_csv(spark, base, MINUTE, "Symbol=*/*.csv", SYMBOL_PARTITION)


@query("src_json_company", sql("SELECT * FROM raw3", "raw3"))
def src_json_company(spark, d):
    base = shared_dir(spark, "landing-company")
    fr.raw_company(spark, d, 3).write.json(base)
    return read_company_json(spark, base, "*.json")


@query("src_table", HIST)
def src_table(spark, d):
    base, schema = shared_dir(spark, "named"), fr.new_schema()
    overwrite(fr.hist(spark, d), f"{base}/bars")
    cat.create_schema(spark, schema, base)
    cat.register_external(spark, f"{schema}.bars", f"{base}/bars")
    return read_source(spark, table=f"{schema}.bars")


@query("src_path", HIST)
def src_path(spark, d):
    base = shared_dir(spark, "path")
    overwrite(fr.hist(spark, d), base)
    return read_source(spark, table="not.used", path=base)


@query("src_parquet", "SELECT * FROM customer")
def src_parquet(spark, d):
    return read_source(spark, path=f"{d}/customer.parquet")


def _bar_log(spark, d) -> DataFrame:
    """Three batches: early bars, corrected late bars, early bars again."""
    base, bars = shared_dir(spark, "log"), fr.hist(spark, d)
    feeds = {1: fr.early(bars), 2: fr.late(fr.restated(bars)), 3: fr.early(bars)}
    at = "Load_DTS"
    for k, rows in feeds.items():
        append_log(rows.withColumn(at, F.lit(LOADS[k]).cast("timestamp_ntz")), base, k)
    schema = bars.withColumn(at, F.lit(LOADS[1]).cast("timestamp_ntz")).schema
    return read_log(spark, base, schema)


@query("src_as_of", sql(f"SELECT {BARS} FROM merged", "merged"))
def src_as_of(spark, d):
    return read_as_of(_bar_log(spark, d), HISTORICALS.keys, 2).drop("Load_DTS")


@query(
    "src_history",
    sql(
        f"""
        SELECT CAST(1 AS BIGINT) AS batch_id, TIMESTAMP '{LOADS[1]}' AS Load_DTS,
               count(*) AS n_rows, count(*) AS n_inserted, CAST(0 AS BIGINT) AS n_updated FROM early
        UNION ALL
        SELECT 2, TIMESTAMP '{LOADS[2]}', count(*), count(*) - count(e.Symbol), count(e.Symbol)
        FROM late l LEFT JOIN early e ON e.Symbol = l.Symbol AND e.Date = l.Date
        UNION ALL
        SELECT 3, TIMESTAMP '{LOADS[3]}', count(*), 0, count(*) FROM early""",
        "early",
        "late",
    ),
)
def src_history(spark, d):
    return history(_bar_log(spark, d), HISTORICALS.keys)


# Sinks


@query(
    "snk_append_partitioned",
    sql(f"SELECT {BARS}, CAST(extract(year FROM Date) AS INTEGER) AS Bar_Year FROM hist", "hist"),
)
def snk_append_partitioned(spark, d):
    base = shared_dir(spark, "append")
    bars = fr.hist(spark, d).withColumn("Bar_Year", F.year("Date"))
    split = F.lit(fr.EARLY_BEFORE).cast("date")
    append(bars.filter(F.col("Date") < split), base, ["Bar_Year"])
    append(bars.filter(F.col("Date") >= split), base, ["Bar_Year"])
    return spark.read.schema(bars.schema).parquet(base)


@query("snk_append_log", sql(f"SELECT {BARS} FROM hist2", "hist2"))
def snk_append_log(spark, d):
    """The same batch written twice: the second write replaces the first."""
    base, bars = shared_dir(spark, "append-log"), fr.hist(spark, d)
    append_log(bars, base, 1)
    append_log(fr.restated(bars), base, 1)
    return read_log(spark, base, bars.schema).drop("_batch_id")


@query("snk_overwrite", HIST)
def snk_overwrite(spark, d):
    base, bars = shared_dir(spark, "overwrite"), fr.hist(spark, d)
    overwrite(fr.early(bars), base)
    overwrite(bars, base)
    return spark.read.parquet(base)


@query("snk_ensure_empty", HIST)
def snk_ensure_empty(spark, d):
    """An ensured table takes rows, and ensuring it again keeps them."""
    base, bars = shared_dir(spark, "ensure"), fr.hist(spark, d)
    ensure_table(spark, base, HISTORICALS.schema)
    append(bars, base)
    ensure_table(spark, base, HISTORICALS.schema)
    return spark.read.schema(HISTORICALS.schema).parquet(base)


@query(
    "snk_land_once",
    sql(
        f"SELECT {BARS} FROM hist h WHERE Date < DATE '1992-06-01' OR NOT EXISTS (SELECT 1 FROM hist f "
        "WHERE f.Symbol = h.Symbol AND f.Date < DATE '1992-06-01')",
        "hist",
    ),
)
def snk_land_once(spark, d):
    base, bars = shared_dir(spark, "land-once"), fr.hist(spark, d)
    land_once(bars.filter(F.col("Date") < F.lit("1992-06-01").cast("date")), base, 1, "json")
    land_once(bars, base, 2, "json")
    return read_landed(spark, base, bars.schema, "json")


# Registry


def _filled(spark, d, buckets: int = 0) -> str:
    """A new schema with all tables created and loaded from bars and the stored vault."""
    base, schema = shared_dir(spark, "tables"), fr.new_schema()
    frames = {
        **fr.stored_vault(spark, d),
        "historicals": fr.hist(spark, d),
        "minute_historicals": fr.minute(spark, d),
        "company": fr.company(spark, d, 3),
    }
    specs = [s for s in (*BRONZE_TABLES, *VAULT_TABLES) if s.name in frames]
    cat.create_tables(spark, specs, base, schema, buckets=buckets)
    with shuffles_freed(spark):
        for spec in specs:
            frames[spec.name].select(*spec.columns).write.insertInto(f"{schema}.{spec.name}")
    return schema


def _counts(spark, schema: str, names) -> DataFrame:
    parts = [
        spark.table(f"{schema}.{n}").agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(n).alias("table_name"), "n_rows"
        )
        for n in names
    ]
    return reduce(DataFrame.unionByName, parts)


VAULT_CTES = ("day_versions", "versions", "minute_versions", "company3")
TABLE_COUNTS = """
    SELECT 'historicals' AS table_name, count(*) AS n_rows FROM hist UNION ALL
    SELECT 'minute_historicals', count(*) FROM minute UNION ALL
    SELECT 'company', count(*) FROM company3 UNION ALL
    SELECT 'hub_instrument', count(*) FROM (SELECT Symbol FROM hist UNION SELECT Symbol FROM minute
      UNION SELECT symbol FROM feed) UNION ALL
    SELECT 'hub_calendar', count(DISTINCT Date) FROM hist UNION ALL
    SELECT 'hub_time', count(DISTINCT DateTime) FROM minute UNION ALL
    SELECT 'link_instrument_day', count(*) FROM hist UNION ALL
    SELECT 'link_instrument_minute', count(*) FROM minute UNION ALL
    SELECT 'sat_instrument_day_prices', count(*) FROM day_versions UNION ALL
    SELECT 'sat_instrument_minute_prices', count(*) FROM minute_versions UNION ALL
    SELECT 'sat_company_info', count(*) FROM versions"""


@query("cat_create", sql(TABLE_COUNTS, *VAULT_CTES))
def cat_create(spark, d):
    """Created tables take their rows; counts are read back by table name."""
    schema = _filled(spark, d, buckets=4)
    return _counts(spark, schema, [s.name for s in (*BRONZE_TABLES, *VAULT_TABLES)])


@query(
    "cat_list",
    sql(f"SELECT table_name AS tableName, n_rows FROM ({TABLE_COUNTS})", *VAULT_CTES),
)
def cat_list(spark, d):
    """The registry's listing, with the rows behind each entry."""
    schema = _filled(spark, d)
    listed = cat.list_tables(spark, schema).filter("NOT isTemporary").select("tableName")
    names = [t.name for t in spark.catalog.listTables(schema) if not t.isTemporary]
    counts = _counts(spark, schema, names).withColumnRenamed("table_name", "tableName")
    return listed.join(counts, "tableName")


@query(
    "cat_schemas",
    sql(f"SELECT 1 AS n_schemas, CAST(count(*) AS BIGINT) AS n_tables, CAST(sum(n_rows) AS BIGINT) AS n_rows FROM ({TABLE_COUNTS})", *VAULT_CTES),
)
def cat_schemas(spark, d):
    """A filled schema as the registry lists it, with its tables and their rows."""
    schema = _filled(spark, d)
    listed = cat.list_schemas(spark).filter(F.col("namespace") == schema)
    listed = listed.groupBy(F.lit("all").alias("of")).agg(F.count("*").cast("int").alias("n_schemas"))
    counts = _counts(spark, schema, [s.name for s in (*BRONZE_TABLES, *VAULT_TABLES)])
    counts = counts.groupBy(F.lit("all").alias("of")).agg(F.count("*").alias("n_tables"), F.sum("n_rows").alias("n_rows"))
    return listed.join(counts, "of").drop("of")


def _named_view(spark, d, grain) -> DataFrame:
    schema = _filled(spark, d)
    create_views(spark, schema)
    view = spark.table(f"{schema}.{view_name(grain)}")
    return view.withColumn(grain.range_name, F.round(grain.range_name, 6))


@query("cat_view_daily", ORACLES["view_daily"])
def cat_view_daily(spark, d):
    """The daily view by its name in the schema."""
    return _named_view(spark, d, DAY)


@query("cat_view_minute", ORACLES["view_minute"])
def cat_view_minute(spark, d):
    """The minute view by its name in the schema."""
    return _named_view(spark, d, MINUTE)


def _job_view(spark, d, grain) -> DataFrame:
    schema = fr.new_schema()
    register_vault(spark, fr.stored_vault_base(spark, d), schema)
    create_views(spark, schema)
    view = spark.table(f"{schema}.{view_name(grain)}")
    return view.withColumn(grain.range_name, F.round(grain.range_name, 6))


@query("cat_job_view_daily", ORACLES["view_daily"])
def cat_job_view_daily(spark, d):
    """The daily view by name, over tables that three batches of jobs have filled."""
    return _job_view(spark, d, DAY)


@query("cat_job_view_minute", ORACLES["view_minute"])
def cat_job_view_minute(spark, d):
    """The minute view by name, over tables that three batches of jobs have filled."""
    return _job_view(spark, d, MINUTE)


@query(
    "cat_describe",
    sql(
        " UNION ALL ".join(
            f"SELECT '{f.name}' AS col_name, '{f.dataType.simpleString()}' AS data_type, "
            f"count({f.name}) AS n_values FROM company3"
            for f in COMPANY.schema
        ),
        "company3",
    ),
)
def cat_describe(spark, d):
    """A table's described columns, with the values each one holds."""
    base, schema = shared_dir(spark, "describe"), fr.new_schema()
    name = f"{schema}.{COMPANY.name}"
    cat.create_tables(spark, [COMPANY], base, schema)
    fr.company(spark, d, 3).write.insertInto(name)
    described = cat.describe_table(spark, name).select("col_name", "data_type")
    counted = spark.table(name).agg(*[F.count(c).alias(c) for c in COMPANY.columns])
    values = counted.unpivot([], COMPANY.columns, "col_name", "n_values")
    return described.join(values, "col_name")


@query("cat_repoint", HIST)
def cat_repoint(spark, d):
    """Files of an external table survive a change of its entry's place and back."""
    base, other, schema = shared_dir(spark, "here"), shared_dir(spark, "there"), fr.new_schema()
    spec = HISTORICALS
    cat.create_tables(spark, [spec], base, schema)
    fr.hist(spark, d).select(*spec.columns).write.insertInto(f"{schema}.{spec.name}")
    cat.create_tables(spark, [spec], other, schema, repoint=True)
    cat.create_tables(spark, [spec], base, schema, repoint=True)
    return spark.table(f"{schema}.{spec.name}")


@query(
    "cat_register",
    sql(f"SELECT {BARS}, CAST(extract(year FROM Date) AS INTEGER) AS Bar_Year FROM hist", "hist"),
)
def cat_register(spark, d):
    base, schema = shared_dir(spark, "register"), fr.new_schema()
    bars = fr.hist(spark, d).withColumn("Bar_Year", F.year("Date"))
    append(bars, f"{base}/bars", ["Bar_Year"])
    cat.create_schema(spark, schema, base)
    cat.register_external(spark, f"{schema}.bars", f"{base}/bars")
    return spark.table(f"{schema}.bars")


@query(
    "cat_view",
    sql("SELECT Symbol, Date, High - Low AS Intraday_Range FROM hist WHERE Volume > 10", "hist"),
)
def cat_view(spark, d):
    base, schema = shared_dir(spark, "view"), fr.new_schema()
    overwrite(fr.hist(spark, d), f"{base}/bars")
    cat.create_schema(spark, schema, base)
    cat.register_external(spark, f"{schema}.bars", f"{base}/bars")
    name = f"{schema}.ranges"
    cat.create_view(spark, name, f"SELECT Symbol FROM {schema}.bars")
    cat.create_view(
        spark,
        name,
        f"SELECT Symbol, Date, High - Low AS Intraday_Range FROM {schema}.bars WHERE Volume > 10",
    )
    cat.create_view(spark, name, f"SELECT Date FROM {schema}.bars", replace=False)
    return spark.table(name)


@query(
    "cat_partitioned",
    sql("SELECT DateTime, Symbol, " + PRICES + " FROM minute", "minute"),
)
def cat_partitioned(spark, d):
    """A table partitioned by symbol, written through the registry and found again."""
    base, schema = shared_dir(spark, "partitioned"), fr.new_schema()
    spec = replace(MINUTE.bronze, partition_by=("Symbol",), bucket_by=None)  # an own definition
    cat.create_tables(spark, [spec], base, schema)
    rows = fr.minute(spark, d)
    append(rows, spec.location(base), spec.partition_by)
    cat.create_tables(spark, [spec], base, schema, repoint=True)
    return spark.table(f"{schema}.{spec.name}").select("DateTime", "Symbol", *PRICE_COLUMNS)
