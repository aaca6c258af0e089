"""URL filter: pattern rules indexed by their rarest literal token.

Two kinds of rules: ``Rule`` is a host with all its subdomains and a path prefix in which ``*`` stands for any text;
``HostWord`` is a word that the host holds between characters other than letters and digits. The literal tokens of a rule
are the runs of ASCII letters and digits that every URL it fits must hold as complete runs. Each rule is filed under the
token that the fewest URLs hold; a URL fetches the rules filed under its own tokens, and only those run their regular
expression. The longest ``Rule`` that fits wins; without one a fitting ``HostWord`` decides, and without that the
default verdict holds.

Cases: a null URL or one without ``://`` has an empty host and path and gets the default verdict; equal
URLs are judged once; a rule without any literal token is tried on every URL; an empty table gives
no rows. Other columns are kept as they are.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tabload.llm.common import bounded, fresh

DEFAULT_VERDICT = "allow"


@dataclass(frozen=True)
class Rule:
    """``verdict`` (allow or block) for ``host`` and its subdomains where the path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path

    @property
    def regex(self) -> str:
        """Over host and path put together; the host has no slash, the path is empty or starts with one."""
        host = rf"(?:[^/]*\.)?{_quote(self.host)}" if self.host else "[^/]*"
        path = r"[\s\S]*".join(_quote(piece) for piece in self.path.split("*"))
        return f"^{host}{path}" if path else rf"^{host}(?:/|\z)"

    @property
    def tokens(self) -> list[str]:
        # a run at the end of the path, or beside a star, may be longer in the URL
        whole = re.sub(r"[A-Za-z0-9]*\*[A-Za-z0-9]*", "*", self.path)
        return re.findall("[A-Za-z0-9]+", f"{self.host}/" + re.sub(r"[A-Za-z0-9]+\Z", "", whole))


@dataclass(frozen=True)
class HostWord:
    """``verdict`` for hosts that hold ``word`` (lower-case letters and digits) as a complete run."""

    word: str
    verdict: str

    @property
    def name(self) -> str | None:
        return None

    @property
    def regex(self) -> str:
        return rf"^(?:[^/]*[^a-z0-9/])?{self.word}(?:[^a-z0-9]|\z)"

    @property
    def tokens(self) -> list[str]:
        return [self.word]


def _quote(text: str) -> str:
    """A literal in a Java regular expression."""
    return re.sub(r"([^\w\s/-])", r"\\\1", text, flags=re.ASCII)


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    # only A-Z change, whatever the locale
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def _tokens(host: Column, path: Column) -> Column:
    """The runs of letters and digits, and the empty token under which rules without one are filed."""
    return F.array_distinct(F.concat(F.split(F.concat(host, path), "[^A-Za-z0-9]+"), F.array(F.lit(""))))


def index_rules(urls: DataFrame, rules: list[Rule | HostWord]) -> DataFrame:
    """The rules, each under its rarest token among ``urls`` (columns host, path).

    Counting runs one job over all URLs and returns at most one row per rule token.
    """
    spark = urls.sparkSession
    tokens = sorted({(token,) for rule in rules for token in rule.tokens})
    wanted = bounded(spark.createDataFrame(tokens, "rule_token string"), len(tokens))
    held = urls.select(F.explode(_tokens(F.col("host"), F.col("path"))).alias("token"))
    counts = held.join(wanted, F.col("token") == F.col("rule_token"), "left_semi").groupBy("token").count()
    seen = {row["token"]: row["count"] for row in counts.collect()}
    filed = [
        (min(rule.tokens, key=lambda token: (seen.get(token, 0), token), default=""),
         rule.name, rule.verdict, rule.regex, len(rule.name or ""))
        for rule in rules
    ]
    return bounded(spark.createDataFrame(filed, "filed string, rule string, verdict string, regex string, length int"), len(filed))


def judge_urls(
    pages: DataFrame, rules: list[Rule | HostWord], url_col: str = "url", default: str = DEFAULT_VERDICT,
) -> DataFrame:
    """``pages`` with ``host, path, rule, verdict``, which take the place of columns of their names; all others are kept."""
    if not rules:
        return pages.withColumns({
            "host": host_of(F.col(url_col)), "path": path_of(F.col(url_col)),
            "rule": F.lit(None).cast("string"), "verdict": F.lit(default),
        })
    # One row per host and path: the copies of a popular URL are combined before the shuffle.
    urls = pages.select(host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path")).distinct()
    index = index_rules(urls, rules)
    fits = (
        urls.withColumn("token", F.explode(_tokens(F.col("host"), F.col("path"))))
        .join(index, F.col("token") == F.col("filed"))
        .filter(F.expr("concat(host, path) rlike regex"))
        .groupBy("host", "path")
        .agg(F.max(F.struct("length", "rule", "verdict")).alias("best"))
    )
    judged = pages.withColumns({"host": host_of(F.col(url_col)), "path": path_of(F.col(url_col))})
    best, own_host, own_path = (fresh(judged, name) for name in ("best", "fits_host", "fits_path"))
    found = fits.select(F.col("host").alias(own_host), F.col("path").alias(own_path), F.col("best").alias(best))
    return (
        judged.join(found, (F.col("host") == F.col(own_host)) & (F.col("path") == F.col(own_path)), "left")
        .withColumns({"rule": F.col(f"{best}.rule"), "verdict": F.coalesce(F.col(f"{best}.verdict"), F.lit(default))})
        .drop(own_host, own_path, best)
    )
