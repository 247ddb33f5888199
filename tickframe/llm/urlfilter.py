"""URL rules by host suffix and path prefix.

Every URL is expanded into the expressions that could name it (each host suffix joined with each path prefix), the
expressions meet the rules in an equi-join on a short hash prefix, the full digest confirms a hit, and the longest
confirmed rule decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A rule set of at most so many rows is broadcast; a larger one is joined by shuffle.
BROADCAST_RULES = 100_000
SALTS = 32


def url_host(url: Column) -> Column:
    """Text between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z lower-cased; '' without ``://`` or for null."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """Text from the end of the host up to ``?`` or ``#``; '' without ``://`` or for null."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def expressions(host: Column, path: Column, max_labels: int, lengths: list[int]) -> Column:
    """Host suffixes of up to ``max_labels`` labels, each joined with the path's prefixes of the given lengths."""
    labels = F.split(host, r"\.")
    first = F.greatest(F.size(labels) - F.lit(max_labels) + 1, F.lit(1))
    suffixes = F.transform(F.sequence(first, F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fitting = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length(path))
    pairs = F.transform(suffixes, lambda s: F.transform(fitting, lambda n: F.concat(s, F.substring(path, F.lit(1), n))))
    return F.when(host == "", F.array(F.lit(""))).otherwise(F.concat(F.array(F.lit("")), F.flatten(pairs)))


def prepare_rules(rules: DataFrame) -> DataFrame:
    """One row per short hash prefix with the rules under it. Of rules with equal host and path, ``block`` wins."""
    named = rules.select(F.translate("host", UPPER, LOWER).alias("h"), F.coalesce("path", F.lit("")).alias("p"), "verdict").where("h <> ''")
    one = named.groupBy(F.concat("h", "p").alias("rule")).agg(F.max("verdict").alias("verdict"), F.max(F.length("h")).alias("host_len"))
    digest = F.sha2("rule", 256)
    one = one.select(F.substring(digest, 1, 8).alias("prefix"), F.struct(digest.alias("digest"), F.length("rule").alias("len"), "host_len", "rule", "verdict").alias("r"))
    return one.groupBy("prefix").agg(F.collect_list("r").alias("candidates"))


def apply_rules(pages: DataFrame, rules: DataFrame, default: str = "allow", broadcast_rules: int = BROADCAST_RULES) -> DataFrame:
    """Judge ``pages(page_id, url, ...)`` by ``rules(host, path, verdict)``.

    Returns one row per input row: page_id, host, path, rule, verdict, url. Among the rules whose host equals the URL's
    host or one of its parent domains, and whose path starts the URL's path, the longest text decides (then the longer
    host). Without a rule, ``rule`` is null and the verdict is ``default``. A null URL, or one without ``://``, has an
    empty host and path and fits no rule; repeated rows, and rows without a page_id, each get their row; other columns
    are not read; empty tables give an empty result.
    """
    shape = rules.agg(F.max(F.size(F.split("host", r"\."))).alias("labels"), F.collect_set(F.length(F.coalesce("path", F.lit("")))).alias("lengths")).first()
    order = ["page_id", "host", "path", "rule", "verdict", "url"]
    base = pages.select("page_id", "url", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    if not shape["lengths"]:
        return base.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)}).select(*order)
    table = prepare_rules(rules)
    exploded = base.select("*", F.posexplode(expressions(F.col("host"), F.col("path"), shape["labels"], sorted(shape["lengths"]))).alias("pos", "expr"))
    exploded = exploded.withColumn("digest", F.sha2("expr", 256)).withColumn("prefix", F.substring("digest", 1, 8))
    if rules.limit(broadcast_rules + 1).count() <= broadcast_rules:
        hits = exploded.join(F.broadcast(table), "prefix", "left")
    else:  # a frequent prefix is dealt over SALTS tasks, its rules are repeated for each
        salted = table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        hits = exploded.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")).join(salted, ["prefix", "salt"], "left")
    confirmed = F.array_max(F.transform(F.filter("candidates", lambda r: r["digest"] == F.col("digest")), lambda r: F.struct(r["len"].alias("len"), r["host_len"].alias("host_len"), r["rule"].alias("rule"), r["verdict"].alias("verdict"))))
    best = hits.groupBy("page_id", "url", "host", "path").agg(F.max(confirmed).alias("best"), F.count_if(F.col("pos") == 0).alias("copies"))
    best = best.withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))))
    return best.withColumns({"rule": F.col("best.rule"), "verdict": F.coalesce("best.verdict", F.lit(default))}).select(*order)
