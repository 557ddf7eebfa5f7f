"""Value rules: gate on keys, split into accepted and rejected rows, hard checks."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricevault.schemas import TableSpec

BROKEN = "broken_rules"


def key_gate(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Rows whose business keys are all present; text keys must not be empty."""
    for name in names:
        df = df.filter(F.col(name).isNotNull())
        if isinstance(df.schema[name].dataType, T.StringType):
            df = df.filter(F.length(name) > 0)
    return df


def _holds(rule: str) -> Column:
    return F.coalesce(F.expr(rule), F.lit(False))


def broken_rules(rules: Mapping[str, str]) -> Column:
    """Names of the rules a row breaks, comma-joined; empty for a good row."""
    return F.concat_ws(",", *[F.when(~_holds(r), F.lit(n)) for n, r in rules.items()])


def split_by_rules(df: DataFrame, rules: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """Accepted rows, and rejected rows with the names of the rules they break."""
    judged = df.withColumn(BROKEN, broken_rules(rules))
    return judged.filter(F.col(BROKEN) == "").drop(BROKEN), judged.filter(F.col(BROKEN) != "")


def rule_counts(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Rows that break each rule, one row per rule, from one pass without a row shuffle."""
    counted = df.agg(*[F.count_if(~_holds(r)).alias(n) for n, r in rules.items()])
    names = list(rules)
    return counted.unpivot([], names, "rule", "n_broken")


def not_null_rules(spec: TableSpec) -> dict[str, str]:
    return {f"{name}_not_null": f"`{name}` IS NOT NULL" for name in spec.not_null}


def assert_not_null(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The same rows; the job stops at a NULL in a required column of ``spec``."""
    for name in spec.not_null:
        error = F.raise_error(F.lit(f"{spec.name}.{name} must not be NULL")).cast("boolean")
        df = df.filter(F.when(F.col(name).isNotNull(), True).otherwise(error))
    return df
