"""URL filter: pattern rules indexed by their rarest literal token.

A rule's literal tokens are runs of letters and digits that stand whole,
between other characters, in every URL that it can match.  The rule is filed
under that one of them which the fewest URLs hold.  A URL's own tokens fetch
the rules filed under them, and only those run their regular expression.
Rules without a literal token are run on every URL.

Everything is DataFrame functions.  Site rules (host and path prefix) decide
first, the longest one winning; where none fits, pattern rules decide: block
if one that blocks matches and none that allows, else allow.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

RULE_ROWS = 50_000           # rules sent to every task; more are joined by shuffle
ALWAYS = ""                  # the index entry of rules without a literal token


@dataclass(frozen=True)
class Rule:
    """``pattern`` is run on host + path for site rules, else on the whole
    URL in lower case; ``tokens`` are its literal tokens, lower case."""
    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    site: bool = False


def whole_tokens(text: str) -> list[str]:
    return [x for x in re.split("[^a-z0-9]+", text.lower()) if x]


def site_rule(rule: str, verdict: str) -> Rule:
    """From ``host/path``: fits the host and its subdomains, paths from there."""
    host, _, path = rule.partition("/")
    labels = whole_tokens(host) if host.isascii() else []
    # the last path token may go on in the URL, unless something ends it
    within = whole_tokens(path[:max([i + 1 for i, c in enumerate(path) if not c.isalnum()], default=0)]) if path.isascii() else []
    pattern = r"^([^/]*\.)?" + re.escape(host.lower()) + "/" + re.escape(path)
    return Rule(rule, verdict, pattern, tuple(dict.fromkeys(labels + within)), True)


def word_rule(*words: str, verdict: str = "block", name: str | None = None) -> Rule:
    """Fits URLs that hold the words (letters, digits, - and _) one after the
    other, each standing by itself."""
    each = [rf"(?<![a-z0-9]){re.escape(w.lower())}(?![a-z0-9])" for w in words]
    return Rule(name or "*".join(words), verdict, "(?s)" + ".*".join(each), tuple(dict.fromkeys(t for w in words for t in whole_tokens(w))))


SITES = (site_rule("net/", "block"), site_rule("example.net/en/", "allow"),
         site_rule("example.com/de/", "block"), site_rule("org/fr/", "allow"))
WORDS = (word_rule("spam-farm"), word_rule("cheap-pills"), word_rule("casino"), word_rule("free", "download"), word_rule("adult"),
         word_rule("login"), word_rule("cheap-pills", "about", verdict="allow"))


def parts(url: Column) -> tuple[Column, Column]:
    """(host in lower case, path); both empty without ``://``."""
    url = F.coalesce(url, F.lit(""))
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    # DOTALL: a line break is an ordinary character
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), path


def tokens(url: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.array_distinct(F.array_append(F.split(F.translate(F.coalesce(url, F.lit("")), upper, upper.lower()), "[^a-z0-9]+", -1), F.lit(ALWAYS)))


def _rules_frame(spark: SparkSession, rules) -> DataFrame:
    rows = [(i, r.name, r.verdict, r.pattern, r.site, list(r.tokens)) for i, r in enumerate(rules)]
    return spark.createDataFrame(rows, "rule_id int, name string, rule_verdict string, pattern string, site boolean, literals array<string>")


def index(urls: DataFrame, rules) -> DataFrame:
    """Each rule with ``token``, the one of its literals that the fewest rows
    of ``urls`` (url) hold; equal ones by alphabet."""
    frame = _rules_frame(urls.sparkSession, rules)
    small = F.broadcast if len(rules) <= RULE_ROWS else lambda df: df
    literals = frame.select("rule_id", F.explode("literals").alias("token"))
    held = urls.select(F.explode(tokens(F.col("url"))).alias("token"))
    counts = held.join(small(literals.select("token").distinct()), "token", "left_semi").groupBy("token").count()
    ranked = literals.join(counts, "token", "left").groupBy("rule_id").agg(
        F.min(F.struct(F.coalesce("count", F.lit(0)).alias("n"), "token")).alias("rarest"))
    return frame.drop("literals").join(ranked, "rule_id", "left").withColumn("token", F.coalesce("rarest.token", F.lit(ALWAYS))).drop("rarest")


def judged(pages: DataFrame, rules=SITES + WORDS, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Per row of ``pages``: page_id, host, path, rule (the site rule, else
    null), verdict, pattern_rule (the first pattern rule that decided, else
    null).

    A null URL, or one without ``://``, has an empty host and path and meets
    no site rule; repeated rows come back repeated; other columns aren't
    read; an empty table gives an empty result.
    """
    urls = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
    small = F.broadcast if len(rules) <= RULE_ROWS else lambda df: df
    # each distinct URL is judged once, however often it occurs
    distinct = urls.select("url").distinct()
    filed = index(distinct, rules)
    host, path = parts(F.col("url"))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    low = F.translate(F.coalesce("url", F.lit("")), upper, upper.lower())
    candidates = distinct.select("url", F.explode(tokens(F.col("url"))).alias("token")).join(small(filed), "token")
    hits = candidates.withColumn("target", F.when(F.col("site"), F.concat(*parts(F.col("url")))).otherwise(low)).where(F.rlike("target", F.col("pattern")))
    order = F.struct(F.length("name").alias("length"), (-F.col("rule_id")).alias("first"), F.col("name"), F.col("rule_verdict"))
    decided = hits.groupBy("url").agg(
        F.max(F.when(F.col("site"), order)).alias("best"),
        F.min(F.when(~F.col("site") & (F.col("rule_verdict") == "allow"), F.struct("rule_id", "name"))).alias("allows"),
        F.min(F.when(~F.col("site") & (F.col("rule_verdict") == "block"), F.struct("rule_id", "name"))).alias("blocks"))
    by_pattern = F.when(F.col("allows").isNull() & F.col("blocks").isNotNull(), "block").otherwise("allow")
    out = urls.join(decided.withColumnRenamed("url", "judged_url"), F.col("url").eqNullSafe(F.col("judged_url")), "left")
    return out.select("page_id", host.alias("host"), path.alias("path"), F.col("best.name").alias("rule"),
                      F.coalesce("best.rule_verdict", by_pattern).alias("verdict"),
                      F.when(F.col("best").isNull(), F.coalesce("allows.name", "blocks.name")).alias("pattern_rule"))
