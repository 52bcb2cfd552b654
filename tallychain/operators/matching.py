"""Join shapes the layers are made of.

Every key is normalised when the relation is built, so all of these are plain
equi-joins; AQE chooses between broadcast and sort-merge by measured size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallychain.functions.dates import month_start
from tallychain.functions.money import safe_pct, total
from tallychain.functions.status import bank_label
from tallychain.operators.base import bank_daily, one_hub_row, with_deposits
from tallychain.operators.frames import group, key_set, keys_of, union_all


def _by_keys(
    left: DataFrame, right: DataFrame, keys: tuple[str, ...], how: str, repeats: bool, salts: int
) -> DataFrame:
    partners = key_set(right, *keys) if repeats else keys_of(right, *keys)
    if salts <= 1:
        return left.join(partners, list(keys), how)
    # Every salt sees every key, so the result does not depend on the salt drawn.
    drawn = left.withColumn("_salt", F.floor(F.rand(7) * salts))
    spread = partners.withColumn("_salt", F.expr(f"explode(sequence(0L, {salts - 1}L))"))
    return drawn.join(spread, [*keys, "_salt"], how).select(*left.columns)


def unmatched(
    left: DataFrame, right: DataFrame, *keys: str, repeats: bool = True, salts: int = 1
) -> DataFrame:
    """Rows of ``left`` without a partner. Null keys never match and are kept.

    ``repeats=False`` says that keys of ``right`` are unique: its exchange then
    stays bare and AQE splits a hot key on the left. If both sides repeat, give
    ``salts`` to spread each left key over that many tasks; the distinct keys of
    ``right`` are copied as often.
    """
    return _by_keys(left, right, keys, "left_anti", repeats, salts)


def matched(
    left: DataFrame, right: DataFrame, *keys: str, repeats: bool = True, salts: int = 1
) -> DataFrame:
    """Rows of ``left`` with a partner, each once. Arguments as in ``unmatched``."""
    return _by_keys(left, right, keys, "left_semi", repeats, salts)


def unmatched_in_all(left: DataFrame, rights: list[DataFrame], key: str) -> DataFrame:
    """Rows of ``left`` that none of several tables knows: one join, not one per table."""
    return unmatched(left, union_all([r.select(key) for r in rights]), key)


def monthly_merge(settlement: DataFrame, bank: DataFrame) -> DataFrame:
    """Two month series side by side, months of either side kept."""
    left = group(
        settlement.where("is_forward").selectExpr(
            f"{month_start('settled_date')} AS month", "sett_net"
        ),
        "month",
        f"{total('sett_net')} AS sett_net",
    )
    right = group(
        bank.selectExpr(f"{month_start('bank_date')} AS month", "deposit"),
        "month",
        f"{total('deposit')} AS deposit",
    )
    return left.join(right, "month", "full").selectExpr(
        "month", "coalesce(sett_net, 0) AS sett_net", "coalesce(deposit, 0) AS deposit"
    )


def deposits_by_label(settlement: DataFrame, bank: DataFrame) -> DataFrame:
    """Net per day joined to the deposit of the account the gateway pays into."""
    days = group(
        settlement.where("is_forward"), ["gateway", "settled_date"], "sum(sett_net) AS net"
    ).selectExpr("*", f"{bank_label('gateway')} AS bank_label")
    deposits = group(bank, ["bank_label", "bank_date"], "sum(deposit) AS deposit")
    joined = days.join(
        deposits.withColumnRenamed("bank_date", "settled_date"), ["bank_label", "settled_date"], "left"
    )
    return group(
        joined,
        ["gateway", "bank_label"],
        "count(*) AS sett_days",
        "count(deposit) AS bank_days",
        f"{total('net')} AS net",
        f"{total('deposit')} AS deposit",
    )


def date_level_match(settlement: DataFrame, bank: DataFrame) -> DataFrame:
    """Days on which both sides have rows, and how far apart they are in total."""
    days = group(
        settlement.where("is_forward"),
        ["gateway", "settled_date"],
        "count(*) AS n",
        "sum(sett_net) AS net",
    )
    deposits = bank_daily(bank).withColumnRenamed("bank_date", "settled_date")
    return group(
        days.join(deposits, ["gateway", "settled_date"]),
        "gateway",
        "count(*) AS matched_days",
        "sum(n) AS sett_rows",
        f"{total('net')} AS sett_net",
        f"{total('bank_daily_deposit')} AS bank_deposit",
    ).selectExpr(
        "*",
        "bank_deposit - sett_net AS gap",
        safe_pct("bank_deposit - sett_net", "sett_net") + " AS gap_pct",
    )


def lookup_join(
    settlement: DataFrame, hub: DataFrame, ledger_pick: DataFrame, bank: DataFrame
) -> DataFrame:
    """Settlement rows with bank, hub and ledger looked up, unclassified."""
    hubs = one_hub_row(hub).join(ledger_pick, "order_id", "left").withColumnRenamed(
        "settle_key", "settlement_order_id"
    )
    return with_deposits(settlement.join(hubs, ["gateway", "settlement_order_id"], "left"), bank)
