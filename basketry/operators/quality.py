"""Checks on tables, each in one pass over its table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import Contract

# Names of the daily tables.
DAILY_TABLES = ("daily_revenue_by_category", "daily_top_cities", "daily_order_funnel")


def _rows(df: DataFrame, table: str, measures: dict[str, Column], passed) -> DataFrame:
    names = list(measures)
    one = df.agg(*[m.alias(f"m{i}") for i, m in enumerate(measures.values())])
    checks = F.array(*[
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(name).alias("check_name"),
            F.col(f"m{i}").alias("value"),
            passed(name, F.col(f"m{i}")).alias("passed"),
        )
        for i, name in enumerate(names)
    ])
    return one.select(F.explode(checks).alias("c")).select("c.*")


def table_checks(df: DataFrame, table: str) -> DataFrame:
    """The table has rows and no nulls."""
    measures = {"row_count": F.count("*")}
    measures |= {f"nulls:{c}": F.count_if(F.col(c).isNull()) for c in df.columns}
    return _rows(df, table, measures, lambda name, v: v > 0 if name == "row_count" else v == 0)


def daily_checks(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [table_checks(df, name) for name, df in tables.items()])


def contract_checks(df: DataFrame, name: str, contract: Contract) -> DataFrame:
    """Rows that miss a required field or hold a value outside the allowed ones. Columns the table
    does not have count as missing in every row."""
    present = set(df.columns)
    measures: dict[str, Column] = {}
    for field in contract.required:
        bad = F.col(field).isNull() if field in present else F.lit(True)
        measures[f"required:{field}"] = F.count_if(bad)
    for field, values in contract.allowed.items():
        known = F.col(field).isNull() | F.col(field).isin(*values) if field in present else F.lit(True)
        measures[f"allowed:{field}"] = F.count_if(~known)
    return _rows(df, name, measures, lambda _, v: v == 0)
