"""The canonical relations as Parquet: normalise once, query many times.

Facts are laid out by month, the unit in which they arrive, are re-run and are
asked for, so a period filter reads only its months. They are not bucketed by
id: a bucket is read by one task, and an id with a third of the rows would make
that task the job.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallychain.config import Period
from tallychain.functions.dates import in_period, month_label

# relation -> expression of the month it is filed under; None is a small table
MONTH_OF = {
    "hub": "created_date",
    "hub_refund": "refund_date",
    "gateway_txn": "txn_date",
    "settlement": "settled_date",
    "gateway_refund": "settled_date",
    "ledger": "ledger_date",
    "bank": None,
}
#: the date a period of each relation means
DATE_OF = {name: date or "bank_date" for name, date in MONTH_OF.items()}


def store(df: DataFrame, path: str, month_of: str | None = None) -> None:
    """Replace the table, or only the months present in ``df`` if ``month_of`` is given.

    ``rebalance`` splits large months over several writers and merges small ones.
    """
    if month_of is None:
        df.hint("rebalance").write.mode("overwrite").parquet(path)
        return
    rows = df.selectExpr("*", f"{month_label(month_of)} AS file_month")
    (
        rows.hint("rebalance", F.col("file_month"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("file_month")
        .parquet(path)
    )


def load(
    spark: SparkSession, root: str, name: str, period: Period | None = None
) -> DataFrame:
    """The relation, or its rows of ``period`` by the date it is filed under.

    The period is also asked of the partition, so that other months are not opened.
    """
    df = spark.read.parquet(f"{root}/{name}")
    filed = "file_month" in df.columns
    if period is not None:
        df = df.where(in_period(DATE_OF[name], period))
        if filed:
            last = period.end - timedelta(days=1)
            # The partition value may have been read as text or as a date.
            months = (str(period.start)[:7], str(last)[:7])
            low, high = (
                (f"'{a}'" if dict(df.dtypes)["file_month"] == "string" else f"DATE'{a}-01'")
                for a in months
            )
            df = df.where(f"file_month >= {low} AND file_month <= {high}")
    return df.drop("file_month") if filed else df
