"""Small cases with known answers."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from pricevault.functions import hash_diff, hash_key, movement, parse_date, parse_datetime, ratio
from pricevault.operators import analytics as an
from pricevault.operators.history import as_of, current, scd2_apply, scd2_history
from pricevault.operators.keyed import unique_keys, upsert
from pricevault.operators.quality import assert_not_null, key_gate, split_by_rules
from pricevault.operators.wrangle import ensure_symbol, to_bronze, to_bronze_company
from pricevault.plans.staging import stage_bars, with_audit
from pricevault.schemas import (
    BAR_CHECKS,
    DAY,
    HISTORICALS,
    HUB_INSTRUMENT,
    MINUTE,
    RAW_COMPANY,
    RAW_DAILY,
    RAW_MINUTE,
    SAT_COMPANY_INFO,
)

AGES = [("Alice", 30), ("Bob", 25), ("Charlie", 35)]
PAY = [("Alice", "female", 5000), ("Bob", "M=male", 6000), ("Charlie", "female", 4000)]


def test_people_reports(spark):
    people = spark.createDataFrame(AGES, "name string, age long")
    assert an.oldest(people).first().asDict() == {"name": "Charlie", "age": 35}
    assert an.youngest(people).first().asDict() == {"name": "Bob", "age": 25}
    assert an.column_mean(people, "age", "mean_age").first()[0] == 30.0
    paid = spark.createDataFrame(PAY, "name string, gender string, salary long")
    assert an.lowest_paid(paid, "female").first() == ("Charlie", "female", 4000)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_raw_times_do_not_depend_on_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        raw = spark.createDataFrame(
            [
                ("2025-01-02 00:00:00-05:00",),
                ("2025-01-02 09:30:00+09:00",),
                ("2025-03-09 02:30:00Z",),
                ("2025-13-02 00:00:00-05:00",),
                ("soon",),
                ("2025-01-02soon",),
                ("2025-01-02",),
                (None,),
            ],
            "t string",
        )
        rows = raw.select(parse_date("t"), parse_datetime("t")).collect()
        assert [r[0] for r in rows] == [date(2025, 1, 2), date(2025, 1, 2), date(2025, 3, 9)] + [None] * 5
        assert [r[1] for r in rows] == [
            datetime(2025, 1, 2, 5),
            datetime(2025, 1, 2, 0, 30),
            datetime(2025, 3, 9, 2, 30),
            *[None] * 5,
        ]
        keys = raw.select(parse_datetime("t").alias("d")).select(hash_key("d"), F.md5(F.lit("2025-01-02 05:00:00")))
        assert keys.first()[0] == keys.first()[1]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_raw_bars_to_bronze(spark):
    values = (1.0, 2.0, 0.5, 1.5, 10, 0.0, 0.0)
    daily = spark.createDataFrame([("2025-01-02 00:00:00+09:00", *values)], RAW_DAILY)
    row = to_bronze(daily, DAY, "AB.TO").first()
    assert row.asDict() == {
        "Date": date(2025, 1, 2), "Symbol": "AB.TO", "Open": 1.0, "High": 2.0, "Low": 0.5,
        "Close": 1.5, "Volume": 10, "Dividends": 0.0, "Stock_Splits": 0.0,
    }
    minutes = spark.createDataFrame([("2025-01-02 09:31:00-05:00", *values)], RAW_MINUTE)
    shaped = to_bronze(minutes, MINUTE, "AB.TO")
    assert shaped.columns == MINUTE.bronze.columns
    assert shaped.first().DateTime == datetime(2025, 1, 2, 14, 31)
    with pytest.raises(ValueError):
        ensure_symbol(daily)


def test_company_ratio_without_earnings_is_null(spark):
    facts = spark.createDataFrame(
        [("A", "a", 1, 10.0, 0.0, 0.1, 2, 3, 4.0, 5.0, 6.0), ("B", "b", 1, 10.0, 4.0, 0.1, 2, 3, 4.0, 5.0, 6.0)],
        RAW_COMPANY,
    )
    rows = {r.symbol: r for r in to_bronze_company(facts).collect()}
    assert rows["A"].priceToEarnings is None
    assert rows["B"].priceToEarnings == 2.5
    assert (rows["B"].netIncome, rows["B"].bookValuePerShare) == (3, 4.0)
    assert facts.select(ratio("currentPrice", "trailingEps")).first()[0] is None


def test_movement_of_flat_and_unknown_bars(spark):
    bars = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (3.0, 2.0), (None, 2.0)], "Open double, Close double")
    assert [r[0] for r in bars.select(movement()).collect()] == ["up", "down", "down", "down"]


def test_hash_diff_tells_apart_what_plain_text_confuses(spark):
    rows = [
        ("a|b", "c", 1.0),
        ("a", "b|c", 1.0),
        (None, "c", 1.0),
        ("", "c", 1.0),
        (r"\N", "c", 1.0),
        ("a", "c", None),
        ("a", "c", float("nan")),
        ("a", "c", float("inf")),
        ("a", "c", 1e13),
        ("a", "c", 1e14),
        ("a", "c", 0.000001),
        ("a", "c", 0.0),
    ]
    df = spark.createDataFrame(rows, "x string, y string, z double")
    hashes = [r[0] for r in df.select(hash_diff(df.schema, df.columns)).collect()]
    assert None not in hashes
    assert len(set(hashes)) == len(rows)


def test_hash_diff_sees_every_change_but_the_sign_of_zero(spark):
    values = [0.1 + 0.2, 0.3, 123.4567891, 123.4567892, 4e-7, 0.0, 1e13, 1e13 + 0.01, 9.1e15, 9.1e15 + 2, 5e-324]
    df = spark.createDataFrame([(v,) for v in [*values, -0.0]], "z double")
    *hashes, minus_zero = [r[0] for r in df.select(hash_diff(df.schema, ["z"])).collect()]
    assert len(set(hashes)) == len(values) and minus_zero == hashes[values.index(0.0)]


def test_duplicate_source_key_fails_or_keeps_the_first(spark):
    source = spark.createDataFrame([("A", 2), ("A", 1), ("B", 3)], "k string, v int")
    kept = unique_keys(source, ["k"], ["v"], on_duplicate="first")
    assert sorted(kept.collect()) == [("A", 1), ("B", 3)]
    with pytest.raises(Exception, match="duplicate merge key: A"):
        unique_keys(source, ["k"], ["v"]).collect()
    with pytest.raises(ValueError):
        unique_keys(source, ["k"], ["v"], on_duplicate="ignore")


def test_upsert_with_null_keys_never_matches(spark):
    target = spark.createDataFrame([("A", 1), (None, 2)], "k string, v int")
    source = spark.createDataFrame([("A", 9), (None, 8)], "k string, v int")
    rows = sorted(upsert(target, source, ["k"]).collect(), key=str)
    assert rows == sorted([("A", 9), (None, 2), (None, 8)], key=str)


def test_key_gate(spark):
    df = spark.createDataFrame([("A", 1), ("", 2), (None, 3), ("B", None)], "s string, n int")
    assert [tuple(r) for r in key_gate(df, ["s", "n"]).collect()] == [("A", 1)]


def test_broken_rules_are_named_and_rows_are_kept(spark):
    bars = spark.createDataFrame(
        [
            (date(2025, 1, 2), "A", 1.0, 1.0, 1.0, 1.0, 1, 0.0, 0.0),
            (date(2025, 1, 3), "A", -1.0, 1.0, 1.0, None, 0, 0.0, 0.0),
            (None, None, 1.0, 1.0, 1.0, 1.0, 1, 0.0, 0.0),
        ],
        HISTORICALS.schema,
    )
    ok, bad = split_by_rules(bars, BAR_CHECKS)
    assert ok.count() == 1
    assert sorted(r.broken_rules for r in bad.collect()) == [
        "date_check,symbol_check",
        "positive_open,positive_close,positive_volume",
    ]


def test_missing_required_value_stops_the_job(spark):
    schema = HUB_INSTRUMENT.table.columns
    rows = spark.createDataFrame(
        [("hk", None, datetime(2025, 1, 1), "s")], "a string, b string, c timestamp_ntz, d string"
    ).toDF(*schema)
    with pytest.raises(Exception, match="hub_instrument.Symbol must not be NULL"):
        assert_not_null(rows, HUB_INSTRUMENT.table).collect()


def test_staging_makes_one_key_of_untidy_symbols(spark):
    bars = spark.createDataFrame(
        [(date(2025, 1, 2), s, 1.0, 1.0, 1.0, 1.0, 1, 0.0, 0.0) for s in ("ab", " AB ", "Ab", "  ")],
        HISTORICALS.schema,
    )
    staged = stage_bars(bars, DAY, "2025-02-01 00:00:00", "test").collect()
    assert {r.Symbol for r in staged} == {"AB"}
    assert len({r.Instrument_Day_LK for r in staged}) == 1
    assert {r.Load_DTS for r in staged} == {datetime(2025, 2, 1)}


def test_load_times_are_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        one = spark.range(1)
        now = with_audit(one, None, "s").first().Load_DTS
        assert abs(now - datetime.now(timezone.utc).replace(tzinfo=None)) < timedelta(minutes=5)
        noon = datetime(2025, 1, 1, 12, tzinfo=timezone(timedelta(hours=-5)))
        assert with_audit(one, noon, "s").first().Load_DTS == datetime(2025, 1, 1, 17)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


# History

SAT = "Instrument_HK string, longName string, marketCap long, Hash_Diff string, Load_DTS timestamp_ntz, Record_Source string"


def _feed(spark, *rows):
    """Rows of (key, hash, day of January)."""
    return spark.createDataFrame(
        [(k, "n", 1, h, datetime(2025, 1, d), "s") for k, h, d in rows], SAT
    )


def _versions(df):
    return sorted(
        (r.Instrument_HK, r.Hash_Diff, r.Effective_DTS.day, r.End_DTS and r.End_DTS.day)
        for r in df.collect()
    )


FEED = [
    ("a", "A", 1), ("a", "B", 2), ("a", "A", 3), ("a", "A", 4),  # there and back, then a repeat
    ("b", "X", 1), ("b", "Y", 4),  # absent in between
    ("c", "N", 2), ("c", "N", 3),  # comes late, never changes
]
WANTED = [
    ("a", "A", 1, 2), ("a", "A", 3, None), ("a", "B", 2, 3),
    ("b", "X", 1, 4), ("b", "Y", 4, None),
    ("c", "N", 2, None),
]


def test_history_from_a_feed(spark):
    assert _versions(scd2_history(_feed(spark, *FEED), ["Instrument_HK"])) == WANTED


def test_history_batch_by_batch(spark):
    history = spark.createDataFrame([], SAT_COMPANY_INFO.table.schema)
    for day in (1, 2, 3, 4):
        batch = _feed(spark, *[r for r in FEED if r[2] == day])
        history = scd2_apply(history, batch, ["Instrument_HK"], datetime(2025, 1, day))
    assert _versions(history) == WANTED
    again = scd2_apply(history, _feed(spark, ("a", "A", 5)), ["Instrument_HK"], datetime(2025, 1, 5))
    assert _versions(again) == WANTED
    assert current(history).count() == 3
    at_two = as_of(history, datetime(2025, 1, 2))
    assert sorted((r.Instrument_HK, r.Hash_Diff) for r in at_two.collect()) == [
        ("a", "B"), ("b", "X"), ("c", "N"),
    ]


def test_late_batch_is_refused(spark):
    history = spark.createDataFrame([], SAT_COMPANY_INFO.table.schema)
    keys = ["Instrument_HK"]
    history = scd2_apply(history, _feed(spark, ("a", "A", 5)), keys, datetime(2025, 1, 5))
    with pytest.raises(Exception, match="not later"):
        scd2_apply(history, _feed(spark, ("a", "B", 3)), keys, datetime(2025, 1, 3)).collect()


class _Session:
    """The settings of a session, without one."""

    def __init__(self, master: str, **conf: str):
        self.conf, self.sparkContext = {"spark.sql.warehouse.dir": "file:/tmp/warehouse", **conf}, self
        self.master = master


def test_scratch_folders_are_shared():
    from pricevault import shared_dir

    assert shared_dir(_Session("local[4]"), "x").startswith("file:/tmp/warehouse/pricevault/x-")
    shared = {"spark.checkpoint.dir": "file:/mnt/shared/"}
    assert shared_dir(_Session("spark://a:7077", **shared), "x").startswith("file:/mnt/shared/pricevault/x-")
    store = {"spark.sql.warehouse.dir": "s3a://lake/warehouse"}
    assert shared_dir(_Session("spark://a:7077", **store), "x").startswith("s3a://lake/warehouse/pricevault/x-")
    with pytest.raises(ValueError, match="this machine alone"):
        shared_dir(_Session("spark://a:7077"), "x")
