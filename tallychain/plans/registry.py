"""Named queries: a DataFrame plan and, beside it, the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from copy import copy
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallychain.operators import base as base_ops
from tallychain.config import Period
from tallychain.functions.dates import in_period
from tallychain.plans import sample
from tallychain.plans.oracle import with_relations
from tallychain.session import shuffles_freed
from tallychain.sources import landed, relations, warehouse
from tallychain.sources.tables import scan


class Chain:
    """The canonical relations over one data folder. All lazy; nothing is cached."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def table(self, name: str) -> DataFrame:
        return scan(self.spark, f"{self.root}/{name}.parquet")

    @cached_property
    def orders(self) -> DataFrame:
        return self.table("orders")

    @cached_property
    def lineitem(self) -> DataFrame:
        return self.table("lineitem")

    @cached_property
    def spine(self) -> DataFrame:
        return sample.order_spine(self.orders)

    @cached_property
    def hub(self) -> DataFrame:
        return relations.hub(sample.hub_txn(self.spine))

    @cached_property
    def hub_refund(self) -> DataFrame:
        return relations.hub_refund(sample.hub_refund(self.spine))

    @cached_property
    def gateway_txn(self) -> DataFrame:
        return relations.gateway_txn(self.gateway_txn_feed)

    @cached_property
    def gateway_txn_feed(self) -> DataFrame:
        return sample.gateway_txn_feed(self.spine)

    @cached_property
    def settlement_feed(self) -> DataFrame:
        return sample.settlement_feed(self.spine, self.lineitem)

    @cached_property
    def settlement(self) -> DataFrame:
        return relations.settlement(self.settlement_feed)

    @cached_property
    def gateway_refund(self) -> DataFrame:
        return relations.gateway_refund(self.gateway_refund_feed)

    @cached_property
    def gateway_refund_feed(self) -> DataFrame:
        return sample.gateway_refund_feed(self.spine)

    @cached_property
    def ledger_sources(self) -> dict[str, DataFrame]:
        return sample.ledger_sources(self.spine)

    @cached_property
    def ledger(self) -> DataFrame:
        return relations.ledger(self.ledger_sources)

    @cached_property
    def bank_feed(self) -> DataFrame:
        return sample.bank_feed(self.settlement, self.gateway_refund, self.spine)

    @cached_property
    def bank(self) -> DataFrame:
        return relations.bank(self.bank_feed)

    @cached_property
    def base(self) -> DataFrame:
        return base_ops.recon_base(self.settlement, self.hub, self.ledger, self.bank)

    def within(self, name: str, period: Period) -> DataFrame:
        """The rows of a relation whose month-filing date lies in ``period``."""
        return getattr(self, name).where(in_period(warehouse.DATE_OF[name], period))

    def month(self, period: Period) -> base_ops.Run:
        """The monthly run: base table and deposits of one period."""
        return base_ops.run(
            self.within("settlement", period), self.hub, self.ledger, self.bank, period
        )


class StoredChain(Chain):
    """The same relations read from a warehouse written by ``store_chain``."""

    def __init__(self, spark: SparkSession, root: str, stored: str):
        super().__init__(spark, root)
        for name in warehouse.MONTH_OF:
            self.__dict__[name] = warehouse.load(spark, stored, name)
        self.stored = stored

    def within(self, name: str, period: Period) -> DataFrame:
        return warehouse.load(self.spark, self.stored, name, period)


class FileChain(Chain):
    """The same relations built from landed source files (``sources.landed``)."""

    def __init__(self, spark: SparkSession, root: str, tables: dict[str, DataFrame]):
        super().__init__(spark, root)
        self.__dict__.update(landed.relations_of(tables))


def kept(chain: Chain, path: str, *names: str, columns: dict[str, list[str]] | None = None) -> Chain:
    """The chain with ``names`` derived once, in this order, and read from Parquet from then on.

    For a query that asks for a relation several times: each time is a join of whole tables else.
    ``columns`` are those of a relation that the query asks for, if not all.
    """
    # A plain chain may have derived others from them before.
    known = Chain(chain.spark, chain.root) if type(chain) is Chain else copy(chain)
    for name in names:
        rows = getattr(known, name)
        if columns and name in columns:
            rows = rows.select(columns[name])
        with shuffles_freed(chain.spark):
            rows.write.parquet(f"{path}/{name}", compression="zstd")
        known.__dict__[name] = chain.spark.read.schema(rows.schema).parquet(f"{path}/{name}")
    return known


def store_chain(chain: Chain, path: str, by_month: bool = True) -> None:
    """Normalise the source files once and keep the relations as Parquet.

    The relations are independent, so small ones do not wait for large ones.
    Deposits are derived from stored settlements and come last.
    """
    known = Chain(chain.spark, chain.root)

    def store(name: str) -> None:
        month_of = warehouse.MONTH_OF[name] if by_month else None
        warehouse.store(getattr(known, name), f"{path}/{name}", month_of)
        known.__dict__[name] = warehouse.load(chain.spark, path, name)

    with ThreadPoolExecutor(max_workers=4) as pool:
        list(pool.map(store, [n for n in warehouse.MONTH_OF if n != "bank"]))
    store("bank")


Plan = Callable[[Chain], DataFrame]
_PLANS: dict[str, Plan] = {}
_SQL: dict[str, str] = {}
_BODY: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Plan], Plan]:
    """Register a plan under ``name`` with the SQL that computes the same rows."""

    def register(plan: Plan) -> Plan:
        if name in _PLANS:
            raise ValueError(f"duplicate query {name}")
        _PLANS[name] = plan
        if sql is not None:
            _BODY[name] = sql
            _SQL[name] = with_relations(sql)
        return plan

    return register


def body(name: str) -> str:
    """The SQL a query was registered with, without the relations in front."""
    return _BODY[name]


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles: the one money type both sides of a check render alike."""
    money = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)]
    return df.withColumns({c: F.col(c).cast("double") for c in money}) if money else df


def run(name: str, chain: Chain) -> DataFrame:
    return comparable(_PLANS[name](chain))


def _load() -> None:
    from tallychain.plans import catalog  # noqa: F401


def plans() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()

    def bind(name: str) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, root: run(name, Chain(spark, root))

    return {name: bind(name) for name in _PLANS}


def sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
