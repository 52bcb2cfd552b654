"""URL filtering as safe-browsing lists do it, in DataFrame operations.

A url is expanded into host suffixes times path prefixes. The first four bytes of
an expression's SHA-256 meet those of the rules in an equi-join, the full digests
confirm, and of the rules that fit the longest decides. Only distinct urls are
expanded, so a url that many pages share is judged once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallychain.llm.tables import stored

#: Hex digits of the short hash.
SHORT = 8
ALLOW, BLOCK = "allow", "block"
#: (host, path, verdict)
RULES = (
    ("net", "/", BLOCK),
    ("example.net", "/en/", ALLOW),
    ("example.com", "/de/", BLOCK),
    ("org", "/fr/", ALLOW),
)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3))


def host(url: Column) -> Column:
    """From after the first :// up to / ? # or the end; empty without ://."""
    return F.coalesce(lower_ascii(F.regexp_extract(_rest(url), r"(?s)^[^/?#]*", 0)), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host up to ? # or the end; empty without ://."""
    return F.coalesce(F.regexp_extract(_rest(url), r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))


def rules_table(spark: SparkSession, rules=RULES) -> DataFrame:
    """The rules as a table of literals."""
    rows = [
        F.struct(*[F.lit(v).alias(n) for n, v in zip(("host", "path", "verdict"), rule)])
        for rule in rules
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def _digest(host_part: Column, path_part: Column) -> Column:
    # A host holds no "/" and a path begins with one or is empty, so the two parts
    # of a url can be told apart; for rules of other forms the separator does it.
    return F.sha2(F.concat(host_part, F.lit("\n"), path_part), 256)


def suffixes(name: Column, counts: list[int]) -> Column:
    """The last ``n`` labels of the host for each ``n`` of ``counts`` that it has."""
    labels = F.split(name, r"\.", -1)
    return F.transform(
        F.filter(F.array(*[F.lit(n) for n in counts]).cast("array<int>"), lambda n: n <= F.size(labels)),
        lambda n: F.array_join(F.slice(labels, -n, n), "."),
    )


def judge(pages: DataFrame, rules: DataFrame, default: str = ALLOW) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of ``pages``.

    ``rules``: host, path, verdict. A rule fits its host and all subdomains if the
    url's path starts with the rule's. The longest rule wins, then the longer host,
    then block over allow. Rules with a null part are ignored; hosts of rules are
    lower-cased. A url that no rule fits, null included, has rule null and the
    ``default`` verdict. Repeated rows get a row each; an empty table gives an empty
    result; other columns are ignored.
    """
    own = rules.filter("host is not null and path is not null and verdict is not null").select(
        lower_ascii(F.col("host")).alias("rule_host"), F.col("path").alias("rule_path"), F.col("verdict")
    )
    # Prefixes and suffixes are only taken at lengths that some rule has: distinct
    # integers, no more of them than the longest rule has characters or labels.
    lengths = [r[0] for r in own.select(F.length("rule_path")).distinct().collect()]
    labels = [r[0] for r in own.select(F.size(F.split("rule_host", r"\.", -1))).distinct().collect()]
    listed = own.select(
        _digest(F.col("rule_host"), F.col("rule_path")).alias("digest"),
        F.concat("rule_host", "rule_path").alias("rule"),
        F.length("rule_host").alias("n_host"),
        "verdict",
    ).withColumn("short", F.substring("digest", 1, SHORT))
    urls = pages.select("url").filter("url is not null").distinct()
    hosts = urls.select(
        "url", path(F.col("url")).alias("path"), F.explode(suffixes(host(F.col("url")), labels)).alias("suffix")
    )
    prefixes = F.filter(
        F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.length("path")
    )
    expressions = hosts.select("url", "path", "suffix", F.explode(prefixes).alias("n")).select(
        "url", _digest(F.col("suffix"), F.substr("path", F.lit(1), F.col("n"))).alias("full")
    )
    fits = (
        expressions.withColumn("short", F.substring("full", 1, SHORT))
        .join(listed, "short")
        .filter("full = digest")
    )
    best = fits.groupBy("url").agg(
        F.max(
            F.struct(F.length("rule").alias("n"), "n_host", F.col("verdict") == BLOCK, "rule", "verdict")
        ).alias("best")
    )
    # Stored, so that both sides of the last join are plain exchanges and AQE can split
    # a url, or null, that very many pages have.
    ruled = stored(
        best.select(
            F.col("url").alias("ruled_url"), F.col("best.rule").alias("rule"), F.col("best.verdict").alias("ruling")
        ),
        "url-ruled",
    )
    slim = pages.select("page_id", "url")
    return slim.join(ruled, slim["url"] == ruled["ruled_url"], "left").select(
        "page_id",
        host(F.col("url")).alias("host"),
        path(F.col("url")).alias("path"),
        "rule",
        F.coalesce("ruling", F.lit(default)).alias("verdict"),
    )
