"""URL filter: pattern rules indexed by their rarest literal token.

A rule is a regular expression with the literal tokens that every URL it fits
must hold. Each rule is filed under the one of its tokens that the corpus has
least often. A URL looks up its own tokens in that index and runs only the
expressions of the rules found there.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varspark.llm.columns import ascii_lower

TOKEN = r"[A-Za-z0-9]+"


class Rule(NamedTuple):
    """``pattern`` is matched against host and path joined; the highest ``rank``, then the longest name, wins."""

    name: str
    verdict: str
    pattern: str
    tokens: list[str]
    rank: int


def site_rule(verdict: str, host: str, path: str) -> Rule:
    """Fits the host and its subdomains where the path starts with ``path``."""
    site = host + path
    return Rule(site, verdict, rf"^(?:[^/]*\.)?{re.escape(site)}", re.findall(TOKEN, host), 2)


def name_rule(label: str) -> Rule:
    """Blocks hosts with this label; weaker than any site rule."""
    return Rule(f"*.{label}.*", "block", rf"^(?:[^/]*\.)?{re.escape(label)}\.", re.findall(TOKEN, label), 1)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; empty without."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_tokens(site: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(site, F.lit(TOKEN), F.lit(0)))


def rule_index(pages: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """The rules, each under its rarest token: the one that fewest of the pages' URLs hold.

    The counts are over all pages, and summed before the rules' tokens are picked from them.
    """
    spark = pages.sparkSession
    table = spark.createDataFrame(
        [tuple(r) for r in rules], "name string, verdict string, pattern string, tokens array<string>, rank int"
    )
    wanted = table.select(F.explode("tokens").alias("token")).distinct()
    seen = (
        pages.select(F.explode(url_tokens(F.concat(host_of(F.col("url")), path_of(F.col("url"))))).alias("token"))
        .groupBy("token")
        .agg(F.count("*").alias("n"))
        .join(wanted, "token")
    )
    filed = (
        table.select("name", F.explode("tokens").alias("token"))
        .join(seen, "token", "left")
        .groupBy("name")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)), "token"))["token"].alias("token"))
    )
    return table.drop("tokens").join(filed, "name")


def judge_urls(pages: DataFrame, rules: Iterable[Rule], otherwise: str = "allow") -> DataFrame:
    """Verdict for each page: page_id, host, path, rule, verdict, matched.

    Each input row gives one row, repeated rows included; other columns are
    ignored. A null URL, or one without ``://``, has an empty host and path, fits no rule
    and gets ``otherwise``, as every URL without a fitting rule does. Where
    several rules fit, higher rank, then greater length, then the name decides. ``rule``
    names a site rule, ``matched`` any rule. An empty table gives no rows.
    """
    rules = list(rules)
    base = pages.select("page_id", "url").select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    # The empty token keeps a row for every page, fitting rules or not.
    looked_up = base.withColumn(
        "token", F.explode(F.concat(F.array(F.lit("")), url_tokens(F.concat("host", "path"))))
    ).join(rule_index(pages, rules), "token", "left")
    fits = F.regexp_like(F.concat("host", "path"), F.col("pattern"))
    best = (
        looked_up.where((F.col("token") == "") | fits)
        .groupBy("page_id", "host", "path")
        .agg(
            F.count_if(F.col("token") == "").alias("copies"),
            F.max(F.when(F.col("name").isNotNull(), F.struct("rank", F.length("name"), "name", "verdict"))).alias("best"),
        )
    )
    return best.select(
        "page_id",
        "host",
        "path",
        F.when(F.col("best.rank") == 2, F.col("best.name")).alias("rule"),
        F.coalesce("best.verdict", F.lit(otherwise)).alias("verdict"),
        F.col("best.name").alias("matched"),
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"),
    ).drop("copy")
