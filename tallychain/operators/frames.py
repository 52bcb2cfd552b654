"""Small DataFrame shorthands."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def group(df: DataFrame, keys: list[str] | str, *aggs: str) -> DataFrame:
    """``GROUP BY keys`` with aggregates as SQL text; no keys gives one row."""
    names = [keys] if isinstance(keys, str) else keys
    return df.groupBy(*names).agg(*[F.expr(a) for a in aggs])


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def with_totals(df: DataFrame, keys: list[str], *measures: str) -> DataFrame:
    """Rows of ``df`` plus subtotals per leading key and a grand total, labelled ALL.

    ``df`` is already grouped by ``keys``, so the rollup expands a handful of
    rows and not the detail.
    """
    sums = [F.expr(f"sum({m}) AS {m}") for m in measures]
    flags = [F.expr(f"grouping({k}) AS _total_{k}") for k in keys]
    rolled = df.rollup(*keys).agg(*sums, *flags)
    labels = [f"CASE WHEN _total_{k} = 1 THEN 'ALL' ELSE {k} END AS {k}" for k in keys]
    return rolled.selectExpr(*labels, *measures)


def share_of_total(df: DataFrame, measure: str, name: str = "share_pct") -> DataFrame:
    """Percentage of ``measure`` over all rows of an already grouped frame."""
    whole = group(df, [], f"CAST(sum({measure}) AS DOUBLE) AS total").scalar()
    part = F.col(measure).cast("double") * 100
    return df.withColumn(name, F.coalesce(F.try_divide(part, whole), F.lit(0.0)))


def ordering(order: tuple[str, ...]) -> list:
    """``"x DESC"`` / ``"x"`` as sort columns; nulls always come last."""
    return [
        F.expr(o[:-5]).desc_nulls_last() if o.endswith(" DESC") else F.expr(o).asc_nulls_last()
        for o in order
    ]


def top_k(df: DataFrame, k: int, *order: str) -> DataFrame:
    """First ``k`` rows. End ``order`` in a unique key, or ties are cut at random."""
    return df.orderBy(*ordering(order)).limit(k)


def pick_first(df: DataFrame, keys: list[str], *order: str, n: int = 1) -> DataFrame:
    """The first ``n`` rows of each group.

    Spark keeps only the ``n`` best rows per group and task before the shuffle
    (WindowGroupLimit), so a group of any size is safe.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*ordering(order)))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def key_set(df: DataFrame, *cols: str) -> DataFrame:
    """Distinct non-null keys of a side on which a key may repeat any number of times.

    Repeats collapse before the shuffle, and without nulls an anti join stays
    an ordinary equi-join instead of a NULL-aware one.
    """
    return keys_of(df, *cols).distinct()


def keys_of(df: DataFrame, *cols: str) -> DataFrame:
    """Non-null keys of a side on which keys do not repeat, such as the hub.

    Left as a bare projection, so that the join's exchange sits directly below
    it and AQE can split a hot key on the other side.
    """
    return df.select(*cols).na.drop()
