"""What is in the tables: inventory, schema search, samples, column profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallychain.operators.frames import group, pick_first, top_k, union_all


def table_inventory(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows, column count and column names per table."""
    return union_all(
        [
            group(
                df,
                [],
                f"'{name}' AS table_name",
                "count(*) AS n_rows",
                f"CAST({len(df.columns)} AS BIGINT) AS n_columns",
                f"'{', '.join(df.columns)}' AS columns",
            )
            for name, df in tables.items()
        ]
    )


def schema_search(tables: dict[str, DataFrame], keywords: list[str]) -> DataFrame:
    """Columns whose name contains a keyword, with their non-null rows."""
    hits = []
    for name, df in tables.items():
        found = [c for c in df.columns if any(k.lower() in c.lower() for k in keywords)]
        if found:
            counts = group(df, [], *[f"count(`{c}`) AS `{c}`" for c in found])
            hits.append(
                counts.unpivot([], found, "column_name", "non_null").selectExpr(
                    f"'{name}' AS table_name", "column_name", "non_null"
                )
            )
    return union_all(hits)


def sample_rows(df: DataFrame, columns: list[str], n: int, *order: str) -> DataFrame:
    """The first ``n`` rows in ``order``."""
    return top_k(df, n, *order).select(*columns)


def min_max_range(df: DataFrame, column: str, *by: str) -> DataFrame:
    return group(
        df,
        list(by),
        f"min({column}) AS first_value",
        f"max({column}) AS last_value",
        f"count({column}) AS n_values",
    )


def value_counts(df: DataFrame, column: str, dropna: bool = True) -> DataFrame:
    """Rows per value, most frequent first."""
    rows = df.where(F.col(column).isNotNull()) if dropna else df
    return group(rows, column, "count(*) AS n_rows").orderBy(F.desc("n_rows"), column)


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys held by more than one row. Empty is what lookup joins rely on."""
    return group(df, list(keys), "count(*) AS n_rows").where("n_rows > 1")


def column_profile_approx(df: DataFrame, name: str) -> DataFrame:
    """The profile in one pass without a shuffle of values, for very large tables.

    Distinct values are estimated; the samples are the smallest and the largest value.
    """
    cols = df.columns
    wide = group(
        df,
        [],
        "count(*) AS total",
        *[
            agg
            for i, c in enumerate(cols)
            for agg in (
                f"count(`{c}`) AS n{i}",
                f"approx_count_distinct(`{c}`) AS d{i}",
                f"concat_ws(', ', CAST(min(`{c}`) AS STRING), CAST(max(`{c}`) AS STRING)) AS s{i}",
            )
        ],
    )
    rows = ", ".join(
        f"'{c}', '{t}', CAST(total - n{i} AS DOUBLE) * 100 / total, d{i}, s{i}"
        for i, (c, t) in enumerate(df.dtypes)
    )
    return wide.selectExpr(
        f"stack({len(cols)}, {rows}) AS (column_name, data_type, null_pct, distinct_values, samples)"
    ).selectExpr(f"'{name}' AS table_name", "*")


def column_profile(df: DataFrame, name: str, samples: int = 3) -> DataFrame:
    """Type, null share, distinct values and the smallest sample values of every column.

    The frame is turned into (column, value) pairs that are counted before the
    shuffle; the samples are picked by rank, so no set of values is ever
    gathered whole.
    """
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS STRING)" for c in df.columns)
    values = group(
        df.selectExpr(f"stack({len(df.columns)}, {pairs}) AS (column_name, value)"),
        ["column_name", "value"],
        "count(*) AS n",
    )
    stats = group(
        values,
        "column_name",
        "sum(n) AS total",
        "sum(CASE WHEN value IS NULL THEN n ELSE 0 END) AS nulls",
        "count(value) AS distinct_values",
    )
    picked = group(
        pick_first(values.where("value IS NOT NULL"), ["column_name"], "value", n=samples),
        "column_name",
        "array_join(array_sort(collect_list(value)), ', ') AS samples",
    )
    types = " ".join(f"WHEN '{c}' THEN '{t}'" for c, t in df.dtypes)
    return stats.join(picked, "column_name", "left").selectExpr(
        f"'{name}' AS table_name",
        "column_name",
        f"CASE column_name {types} END AS data_type",
        "CAST(nulls AS DOUBLE) * 100 / total AS null_pct",
        "distinct_values",
        "samples",
    )
