"""URL filters: pattern rules behind an index of their rarest literal token."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import LOWER, UPPER
from tickloom.session import staged

#: (verdict, host, path): host and its subdomains, paths that begin so.
HOST_RULES = (
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/"))
#: (verdict, name, pattern over host and path, literal tokens that each match holds).
PATTERNS = (
    ("block", "spam_farm", r"(?i)(^|[./-])spam[.-]farm([^a-z0-9]|$)", ("spam", "farm")),
    ("block", "casino", r"(?i)(^|[^a-z0-9])casino([^a-z0-9]|$)", ("casino",)),
    ("block", "adult_host", r"(?i)(^|[^a-z0-9])(?:xxx)([^a-z0-9]|$)", ("xxx",)),
    ("block", "login_form", r"(?i)/(?:wp-)?login(\.php)?([^a-z0-9]|$)", ("login",)),
    ("block", "cart", r"(?i)/cart/checkout([^a-z0-9]|$)", ("cart", "checkout")),
)


#: Rules whose index may be broadcast.
INDEX_RULES = 50_000


def _small(side: DataFrame) -> DataFrame:
    """Broadcast if it is as small as that."""
    return F.broadcast(side) if side.limit(INDEX_RULES + 1).count() <= INDEX_RULES else side


def host_of(url: Column) -> Column:
    """From behind the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.regexp_extract(_behind(url), "^([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_behind(url), "^[^/?#]*([^?#]*)", 1)


def _behind(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def rule_table(spark: SparkSession, host_rules: Sequence = HOST_RULES,
               patterns: Sequence = PATTERNS) -> DataFrame:
    """All rules as regular expressions over host and path, with the tokens a match must hold.

    Of a path the part behind its last separator may go on in the URL, so it is no whole token.
    """
    rows = []
    for verdict, host, path in host_rules:
        whole = re.sub(r"[A-Za-z0-9]+$", "", path)
        tokens = [t for t in re.split("[^a-z0-9]+", f"{host.lower()} {whole.lower()}") if t]
        rows.append((f"{host}{path}", True, f"^(?:[^/]*\\.)?{_literal(host.lower() + path)}",
                     verdict, len(host) + len(path), tokens))
    for verdict, name, pattern, tokens in patterns:
        rows.append((name, False, pattern, verdict, 0, list(tokens)))
    return spark.createDataFrame(rows, "rule string, by_host boolean, pattern string, "
                                 "verdict string, weight int, tokens array<string>")


def _literal(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9/])", r"\\\1", text)


def judge_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url",
               default: str = "allow") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``pattern`` and ``verdict``.

    Each distinct URL is split into tokens ([a-z0-9] runs of the lower-cased host and path). Each
    rule waits at the one of its tokens that the fewest URLs hold; a rule without tokens waits at
    the empty one, which each URL has. URLs and rules meet by an equi-join on the token, and only
    those pairs run a regular expression. The index is broadcast while it has ``INDEX_RULES`` rules or
    fewer, and met by a shuffle beyond. Of the host rules that fit, the longest wins (block
    before allow, then by name); without one, the patterns decide (block before allow, then by
    name); else ``default``. ``rule`` names the host rule, ``pattern`` the pattern that decided.

    Defined cases: a null URL, or one without ``://``, has an empty host and path and gets
    ``default`` unless a rule without tokens fits. Rows stay as they are, repeated ones too. No
    rules: ``default`` for all. A very long URL is one row like others. Columns of the result's names
    are replaced; others may have any name.
    """
    urls = pages.select(F.coalesce(url_col, F.lit("")).alias("_url")).distinct().select(
        "_url", F.concat(host_of(F.col("_url")), path_of(F.col("_url"))).alias("_place"))
    needed = rules.select("rule", F.explode(F.when(F.size("tokens") == 0, F.array(F.lit("")))
                                            .otherwise(F.col("tokens"))).alias("_token"))
    found = F.split(F.translate("_place", UPPER, LOWER), "[^a-z0-9]+")
    if not rules.where(F.size("tokens") == 0).isEmpty():  # every URL has the empty token
        found = F.concat(F.array(F.lit("")), found)
    tokens = urls.select("_url", "_place", F.explode(F.array_distinct(found)).alias("_token"))
    # Only tokens of rules are counted: the few names travel to the URLs, not the URLs to them.
    counts = tokens.join(_small(needed.select("_token").distinct()), "_token", "left_semi") \
        .groupBy("_token").agg(F.count("*").alias("_urls"))
    rarest = needed.join(counts, "_token", "left").groupBy("rule").agg(
        F.min_by("_token", F.struct(F.coalesce("_urls", F.lit(0)), "_token")).alias("_token"))
    index = staged(rules.drop("tokens").join(rarest, "rule"), "rule_index")
    fits = tokens.join(_small(index), "_token").where(F.regexp_like("_place", F.col("pattern")))
    best = fits.groupBy("_url").agg(F.max(F.struct(
        "by_host", "weight", (F.col("verdict") == "block").alias("block"), "rule", "verdict"))
        .alias("_best"))
    made = ("host", "path", "rule", "pattern", "verdict")
    others = [c for c in pages.columns if c not in made]
    keyed = pages.select(F.coalesce(url_col, F.lit("")).alias("_url"),
                         F.struct(*others or [F.lit(0)]).alias("_page"))
    joined = keyed.join(best, "_url", "left")
    return joined.select(
        *[F.col("_page").getField(c).alias(c) for c in others],
        host_of(F.col("_url")).alias("host"), path_of(F.col("_url")).alias("path"),
        F.when(F.col("_best.by_host"), F.col("_best.rule")).alias("rule"),
        F.when(~F.col("_best.by_host"), F.col("_best.rule")).alias("pattern"),
        F.coalesce("_best.verdict", F.lit(default)).alias("verdict"))
