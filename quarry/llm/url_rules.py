"""URL filters: pattern rules fetched by their rarest literal token.

A rule is a regular expression with the literal tokens that every URL it matches must hold as
whole tokens. The index keeps each rule under the one of its tokens that the corpus' URLs hold
least often. A URL's tokens fetch the rules filed under them, and only those run their regular
expression. Everything is DataFrame expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Token characters are ASCII letters and digits and everything beyond ASCII.
_BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``name`` is reported, ``pattern`` runs on ``host + path`` (and, behind a ``#``, the query), ``tokens`` are whole tokens of every match, and the highest ``priority`` wins."""

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    priority: int
    listed: bool = True


def _quoted(text: str) -> str:
    return "".join(c if c.isalnum() else "\\" + c for c in text)


def host_rule(verdict: str, rule: str) -> Rule:
    """A rule like ``example.com/en/``: the host and all its subdomains, paths from ``/en/`` on.

    Tokens are the host's labels and those path parts that a ``/`` ends; longer rules win.
    """
    import re

    host, slash, rest = rule.partition("/")
    closed = rest[: rest.rfind("/") + 1]
    tokens = tuple(t for t in re.split(_BREAK, f"{host}/{closed}") if t)
    return Rule(rule, verdict, rf"^([^/#]*\.)?{_quoted(host + slash + rest)}", tokens, len(rule))


def lower_ascii(c: Column) -> Column:
    return F.translate(c, _UPPER, _LOWER)


def url_host(url: Column) -> Column:
    """Lower-cased text after the first ``://`` up to ``/``, ``?``, ``#`` or the end; else empty."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_tokens(target: Column) -> Column:
    """The distinct tokens of a target (host, path and query)."""
    return F.array_distinct(F.filter(F.split(target, _BREAK), lambda t: t != ""))


def rule_index(spark_urls: DataFrame, rules: list[Rule]) -> DataFrame:
    """(token, rank, name, verdict, pattern, priority, listed): each rule under its rarest token.

    ``spark_urls`` has one row per distinct URL with its ``tokens``. Token counts come from all
    of them; ties go to the smaller token. Rules without tokens are filed under the empty token,
    which every URL fetches.
    """
    spark = spark_urls.sparkSession
    rows = [(i, r.name, r.verdict, r.pattern, r.priority, r.listed, list(r.tokens) or [""])
            for i, r in enumerate(rules)]
    table = spark.createDataFrame(
        rows, "rank int, name string, verdict string, pattern string, priority int, listed boolean, "
              "tokens array<string>")
    wanted = sorted({t for r in rows for t in r[-1]})
    counts = (spark_urls.select(F.explode("tokens").alias("token"))
              .filter(F.col("token").isin(wanted))
              .groupBy("token").agg(F.count("*").alias("uses")))
    each = table.withColumn("token", F.explode("tokens")).drop("tokens")
    return (each.join(counts, "token", "left")
            .groupBy("rank", "name", "verdict", "pattern", "priority", "listed")
            .agg(F.min(F.struct(F.coalesce("uses", F.lit(0)).alias("uses"), "token")).alias("best"))
            .select(F.col("best.token").alias("token"), "rank", "name", "verdict", "pattern", "priority", "listed"))


def filter_urls(pages: DataFrame, rules: list[Rule], url: str = "url", default: str = "allow") -> DataFrame:
    """(``url``, host, path, rule, verdict) for each distinct URL of ``pages``, null included.

    The matching rule of the highest priority decides (ties: the earlier rule); ``rule`` is its
    name if it is ``listed``, else null. A URL that no rule matches gets ``default``. Null, empty
    and malformed URLs have empty host and path and match nothing but patterns on empty text.
    The rules are the caller's list, so the index is as small as that list.
    """
    parts = (pages.select(F.col(url).alias("url")).distinct()
             .select("url", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path")))
    query = F.coalesce(F.regexp_extract("url", r"(?s)^.*?://[^?]*(\?[^#]*)", 1), F.lit(""))
    target = F.concat("host", "path", F.lit("#"), query)
    parts = parts.withColumn("target", target).withColumn(
        "tokens", F.concat(url_tokens(F.col("target")), F.array(F.lit(""))))
    index = rule_index(parts, rules)
    hits = (parts.select("url", "target", F.explode("tokens").alias("token"))
            .join(index, "token")
            .filter(F.expr("target RLIKE pattern"))
            .groupBy(F.col("url").alias("hit_url"))
            .agg(F.max(F.struct("priority", (-F.col("rank")).alias("order"), "name", "verdict", "listed")).alias("hit")))
    return (parts.join(hits, F.col("url").eqNullSafe(F.col("hit_url")), "left")
            .select("url", "host", "path",
                    F.when(F.col("hit.listed"), F.col("hit.name")).alias("rule"),
                    F.coalesce("hit.verdict", F.lit(default)).alias("verdict")))


def judge(pages: DataFrame, rules: list[Rule], url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` rows as (their first columns, host, path, rule, verdict): :func:`filter_urls`
    brought back to every row. Columns of ``pages`` named like a result are left out."""
    made = ("host", "path", "rule", "verdict")
    keep = [c for c in pages.columns if c not in made]
    found = filter_urls(pages, rules, url, default).select(F.col("url").alias("_judged"), *made)
    rows = pages.select(*keep)
    return rows.join(found, F.col(url).eqNullSafe(F.col("_judged")), "left").select(*keep, *made)
