"""Connected components over an edge table, without gathering it anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallychain.llm.tables import stored


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.col("b").cast("decimal(38,0)"))
    ).first()
    return tuple(row)


def _pull(pairs: DataFrame, strict: bool) -> DataFrame:
    """Point the neighbours of each node at the least node around it.

    ``pairs`` holds (a, b): b is a neighbour of a. The least neighbours are
    stored before they are joined back, so both join inputs are plain exchanges
    and AQE can split a node that has very many neighbours.
    """
    least = stored(
        pairs.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("low")).select(
            "n", F.least("n", "low").alias("low")
        ),
        "component-least",
    )
    joined = pairs.join(least, pairs["a"] == least["n"])
    moved = joined.filter("b > a") if strict else joined
    return moved.select(F.col("b").alias("a"), F.col("low").alias("b"))


def roots(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node with an edge; root is the least node reachable.

    Alternates two star operations (Kiveris et al., 2014) until the edges no
    longer change; each keeps the components and never adds edges. Input:
    integer columns a, b in either order, loops and repeats allowed. Every round
    is stored in the shared folder. An empty edge table gives an empty result.
    """
    forward = edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    current = stored(forward.distinct(), "component-edges")
    known = _state(current)
    for _ in range(rounds):
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = stored(_pull(both, strict=True).filter("a <> b").distinct(), "component-edges")
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        small = _pull(down, strict=False).unionByName(
            down.groupBy("a").agg(F.min("b").alias("b"))
        )
        current = stored(small.filter("a <> b").distinct(), "component-edges")
        now = _state(current)
        if now == known:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
        known = now
    raise RuntimeError(f"components not settled after {rounds} rounds")
