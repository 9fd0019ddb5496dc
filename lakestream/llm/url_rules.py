"""URL filters: listed rules first, then association rules mined by Spark's FP-growth.

The listed rules label the URLs they fit. The tokens of a labelled URL (the
labels of its host and its suffixes, path segments with numbers made equal,
query keys) and its label are a basket; FP-growth mines the frequent ones, and
rules from token combinations to a label stay if their confidence and support
suffice and no rule with fewer tokens says the same as confidently. A URL that
no listed rule fits gets the label of the best mined rule all of whose tokens
it has: the most confident, then the best supported, the longest, the first by
name. They are found by an inverted index: each rule stands under its rarest
token only, and a URL looks up its own tokens.

Baskets are counted once each: equal ones are mined with the others, as the
confidence of a rule counts URLs.

Results on odd rows: a null URL, or one without ``://``, has empty host and
path and no tokens, and is allowed, like any URL that no rule speaks of;
repeated rows each get their row; an empty table gives an empty result; other
columns aren't carried. With no labelled URL nothing is mined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestream.llm._tables import written
from lakestream.operators.enrich import fits_broadcast

#: Least share of labelled URLs that a combination is in, and least share of those that have the label.
SUPPORT, CONFIDENCE = 0.01, 0.8
ALLOW, BLOCK = "allow", "block"
_LABEL = "label="
#: The rules that queries use: (host and path, verdict).
RULES = (("org/", ALLOW), ("example.org/es/", BLOCK), ("example.org/en/1", BLOCK), ("com/fr/", ALLOW), ("com/de/", BLOCK))


def url_host(url: F.Column) -> F.Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z in lower case; empty if there is none."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: F.Column) -> F.Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def listed_rule(host: F.Column, path: F.Column, rules: Sequence[tuple[str, str]]) -> F.Column:
    """Struct ``rule``, ``verdict`` of the longest rule that fits; null if none does."""
    found = F.lit(None).cast("struct<rule: string, verdict: string>")
    for rule, verdict in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        at = rule.index("/")
        own, start = rule[:at], rule[at:]
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(start)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def url_tokens(url: F.Column, host: F.Column, path: F.Column) -> F.Column:
    """Distinct tokens: ``host:`` and a host or suffix of it, ``path:`` and a segment, ``query:`` and a key."""
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    suffixes = F.when(F.size(labels) > 0, F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.concat(F.lit("host:"), F.array_join(F.slice(labels, i, F.size(labels)), ".")))).otherwise(
        F.array().cast("array<string>"))
    segments = F.transform(F.filter(F.split(path, "/"), lambda x: x != ""),
                           lambda x: F.concat(F.lit("path:"), F.regexp_replace(x, "[0-9]+", "0")))
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    keys = F.transform(F.filter(F.split(query, "&"), lambda x: x != ""),
                       lambda x: F.concat(F.lit("query:"), F.substring_index(x, "=", 1)))
    return F.array_distinct(F.concat(suffixes, segments, keys))


def mine(baskets: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """``tokens``, ``verdict``, ``confidence``, ``support`` of the rules that stay; baskets: ``tokens``, ``verdict``."""
    items = baskets.select(F.concat("tokens", F.array(F.concat(F.lit(_LABEL), "verdict"))).alias("items"))
    found = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(items).associationRules
    rules = found.where(F.col("consequent")[0].startswith(_LABEL) & ~F.exists("antecedent", lambda x: x.startswith(_LABEL)))
    rules = written(rules.select(F.array_sort("antecedent").alias("tokens"),
                                 F.substring(F.col("consequent")[0], len(_LABEL) + 1, 100).alias("verdict"),
                                 "confidence", "support"), "rules")
    # a rule that a part of its tokens makes just as well says nothing new; parts share its first or another token
    parts = rules.select(F.col("tokens").alias("part"), F.col("verdict").alias("says"), F.col("confidence").alias("sure"),
                         F.col("tokens")[0].alias("token"))
    worse = rules.select("*", F.explode("tokens").alias("token")).join(parts, "token").where(
        (F.col("says") == F.col("verdict")) & (F.col("sure") >= F.col("confidence"))
        & (F.size("part") < F.size("tokens")) & (F.size(F.array_except("part", "tokens")) == 0))
    return rules.join(worse.select("tokens", "verdict").distinct(), ["tokens", "verdict"], "left_anti")


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, id_col: str = "page_id", url_col: str = "url",
                support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """Per row: the id, ``host``, ``path``, ``rule`` (the listed one that fits), ``verdict``, ``mined`` (tokens of the mined one)."""
    url = F.col("url")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url")).select(
        "id", "url", url_host(url).alias("host"), url_path(url).alias("path"))
    rows = rows.withColumn("listed", listed_rule(F.col("host"), F.col("path"), rules))
    rows = rows.withColumn("tokens", url_tokens(url, F.col("host"), F.col("path")))
    labelled = rows.where("listed is not null").select("tokens", F.col("listed.verdict").alias("verdict"))
    mined = None if labelled.isEmpty() else mine(labelled, support, confidence)
    # equal token sets are looked up once
    asked = rows.where("listed is null and size(tokens) > 0").select(F.array_sort("tokens").alias("tokens")).distinct()
    if mined is not None:
        rarity = _rarity(mined)
        index = _small(written(mined.join(rarity, "tokens"), "index"))
        hits = asked.select(F.col("tokens").alias("own"), F.explode("tokens").alias("token")).join(index, "token")
        hits = hits.where(F.size(F.array_except("tokens", "own")) == 0)
        rank = F.struct("confidence", "support", F.size("tokens").alias("size"), F.col("verdict"), "tokens")
        best = _small(written(hits.groupBy("own").agg(F.max(rank).alias("best")), "best"))
        # listed rows look nothing up, so they are in no join
        unlisted = rows.where("listed is null").withColumn("own", F.array_sort("tokens")).join(best, "own", "left").drop("own")
        rows = rows.where("listed is not null").unionByName(unlisted, allowMissingColumns=True)
    else:
        rows = rows.withColumn("best", F.lit(None).cast("struct<verdict: string, tokens: array<string>>"))
    return rows.select(F.col("id").alias(id_col), "host", "path", F.col("listed.rule").alias("rule"),
                       F.coalesce("listed.verdict", "best.verdict", F.lit(ALLOW)).alias("verdict"),
                       F.when(F.col("listed").isNull(), F.col("best.tokens")).alias("mined"))


def _small(df: DataFrame) -> DataFrame:
    """A written table, broadcast to its joins if it measures small; else they shuffle, and adaptive execution splits hot keys."""
    return F.broadcast(df) if fits_broadcast(df) else df


def _rarity(rules: DataFrame) -> DataFrame:
    """The token under which each rule's tokens stand: the one that the fewest rules have, the first of equals."""
    spread = rules.select("tokens", F.explode("tokens").alias("token")).distinct()
    count = spread.groupBy("token").agg(F.count("*").alias("n"))
    return spread.join(count, "token").groupBy("tokens").agg(F.min(F.struct("n", "token")).alias("least")).select(
        "tokens", F.col("least.token").alias("token"))
