"""Monthly sums that add up: any span of months is answered from them, not from the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallychain.config import MONEY_SUM
from tallychain.functions.money import total
from tallychain.operators.frames import group
from tallychain.operators.refresh import FILED_BY, filed_in

KEYS = ["recon_month", "gateway", "created_month", "trace_status"]
SUMS = ["sett_gross", "sett_net", "sett_fee"]


def partials(base: DataFrame) -> DataFrame:
    """Base rows by settled month, gateway, month of creation and trace status.

    Counts and settlement amounts only: these belong to a row, so that parts add up. Hub
    and ledger amounts belong to an id, which may be settled in several months.
    """
    return group(
        base.selectExpr("*", "coalesce(source_month, 'NOT IN HUB') AS created_month"),
        KEYS,
        "count(*) AS n_rows",
        *[f"CAST(sum({m}) AS {MONEY_SUM}) AS {m}" for m in SUMS],
    )


def partials_store(base: DataFrame, path: str, months: list | None = None) -> None:
    """Replace the sums of the months ``base`` covers, or of ``months`` alone, as ``refresh`` returns them."""
    rows = base if months is None else base.where(filed_in(months))
    (
        partials(rows)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*FILED_BY)
        .parquet(path)
    )


def partials_load(spark: SparkSession, path: str) -> DataFrame:
    month = F.expr("left(CAST(recon_month AS STRING), 7)")
    return spark.read.parquet(path).withColumn("recon_month", month)


def between_months(sums: DataFrame, first: str | None, last: str | None) -> DataFrame:
    """The sums settled from month ``first`` to month ``last``, both as ``2026-01``, either open."""
    if first is not None:
        sums = sums.where(F.col("recon_month") >= first)
    if last is not None:
        sums = sums.where(F.col("recon_month") <= last)
    return sums


def source_month_waterfall(sums: DataFrame, first: str | None = None, last: str | None = None) -> DataFrame:
    """As ``settlements.source_month_waterfall``, from sums."""
    return group(
        between_months(sums, first, last).withColumnRenamed("recon_month", "settled_month"),
        ["gateway", "settled_month", "created_month"],
        "sum(n_rows) AS sett_rows",
        f"{total('sett_gross')} AS gross",
        f"{total('sett_net')} AS net",
    )


def month_compare(sums: DataFrame, first: tuple[str, str], second: tuple[str, str]) -> DataFrame:
    """Two spans of settlement months side by side, by trace status."""

    def cols(span: tuple[str, str], name: str) -> list[str]:
        cond = f"recon_month BETWEEN '{span[0]}' AND '{span[1]}'"
        return [
            f"sum(CASE WHEN {cond} THEN n_rows ELSE 0 END) AS rows_{name}",
            f"{total('sett_gross', cond)} AS gross_{name}",
        ]

    spans = " OR ".join(f"recon_month BETWEEN '{a}' AND '{b}'" for a, b in (first, second))
    return group(sums.where(spans), "trace_status", *cols(first, "first"), *cols(second, "second"))


def cumulative(sums: DataFrame, first: str | None = None, last: str | None = None) -> DataFrame:
    """Rows and amounts of each gateway up to the end of each month, from ``first`` on."""
    monthly = group(
        between_months(sums, first, last).where("recon_month IS NOT NULL"),
        ["gateway", "recon_month"],
        "sum(n_rows) AS n_rows",
        *[f"{total(m)} AS {m}" for m in SUMS],
    )
    # A row for each gateway and month reaches this window.
    so_far = "OVER (PARTITION BY gateway ORDER BY recon_month ROWS UNBOUNDED PRECEDING)"
    return monthly.selectExpr(
        "gateway",
        "recon_month",
        f"sum(n_rows) {so_far} AS n_rows",
        *[f"CAST(sum({m}) {so_far} AS {MONEY_SUM}) AS {m}" for m in SUMS],
    )
