"""URL rules by a sort-merge range join: one sort, and a sweep that keeps a stack of the rules open at each place.

A rule (host, path, verdict) fits its host and all subdomains where the url's path starts with the rule's. Hosts are turned
round by labels (``com.example.www``), so a rule's host is a prefix of its subdomains' and every url stands once under
each of its sites, that is host prefixes, that has rules. Under a site a rule is an interval of paths: it opens at its path and
closes behind the last path that starts with it. Intervals nest or are apart, so in path order the stack needs no memory of its
own: its height is a running sum of openings and closings, and its top at a url of height h is the rule opened last at that
height. Over a url's sites the longest rule (host and path together, then host) wins.

A site is cut into slots of about ``SLOT`` urls, each with all rules of the site (a slot never has fewer urls than the site has
rules, so rules are copied at most once per url); a site that a third of all urls share is many slots. Nothing is collected and
no window holds state beyond a sum and a rule.

Defined cases: a null url, or one without ``://``, has empty host and path and gets what a rule for the empty host says, else the
default. A null host or path in a rule is the empty text. Of rules with equal host and path the last verdict in text order counts
(``block`` over ``allow``). Repeated rows are each answered, null ids too; an empty rule table leaves the default everywhere. Very
long urls are judged whole. Only ``keep`` and the url column are read, so other columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reviewmill.llm.common import written

SLOT = 1_000
MAX_BROADCAST_SITES = 100_000  # rows of (site, counts) that may be broadcast; beyond it the join is left to Spark
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BEHIND = b"\xff"  # greater than any byte of UTF-8


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased; empty where there is none."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1), _UPPER, _LOWER)


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def _labels(name: str) -> Column:
    """Labels of a host, last first."""
    return F.reverse(F.split(name, r"\.", -1))


def _small(sites: DataFrame) -> DataFrame:
    return F.broadcast(sites) if sites.limit(MAX_BROADCAST_SITES + 1).count() <= MAX_BROADCAST_SITES else sites


def _sweep(events: DataFrame) -> DataFrame:
    """The urls among the events that lie within a rule's interval, with the rule on top of the stack there."""
    in_order = Window.orderBy("edge", "turn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    level = F.sum("step").over(in_order.partitionBy("site", "slot"))
    top = F.last("rule", ignorenulls=True).over(in_order.partitionBy("site", "slot", "level"))
    return events.withColumn("level", level).withColumn("top", top).where("turn = 1 AND level > 0").select("row", "top.*")


def judge(pages: DataFrame, rules: DataFrame, keep: tuple[str, ...] = ("page_id",), url: str = "url", default: str = "allow") -> DataFrame:
    """``keep`` columns, host, path, rule (host and path of the rule that wins, else null) and verdict, one row per page."""
    text = rules.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("host", "path")), "verdict")
    unique = text.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    placed = written(unique.select("*", F.array_join(_labels("host"), ".").alias("site"), F.size(_labels("host")).alias("depth")), "url-rules")
    deepest = placed.agg(F.max("depth")).first()[0] or 0

    kept = [F.col(name).alias(f"keep_{k}") for k, name in enumerate(keep)]
    numbered = pages.select(*kept, host(F.col(url)).alias("host"), path(F.col(url)).alias("path")).withColumn("row", F.monotonically_increasing_id())
    addresses = written(numbered, "url-addresses")

    labels = _labels("host")
    depths = F.when(F.lit(deepest) > 0, F.sequence(F.lit(1), F.least(F.size(labels), F.lit(deepest))))
    under = addresses.select("row", "path", F.explode(F.transform(depths, lambda d: F.array_join(F.slice(labels, F.lit(1), d), "."))).alias("site"))
    ruled = placed.groupBy("site").agg(F.count("*").alias("n_rules"))
    counts = under.join(_small(ruled), "site").groupBy("site", "n_rules").agg(F.count("*").alias("n"))
    slots = written(counts.select("site", F.ceil(F.col("n") / F.greatest(F.lit(SLOT), "n_rules")).alias("slots")), "url-slots")

    met = _small(slots)
    urls = under.join(met, "site").select(
        "site", F.pmod(F.xxhash64("row"), "slots").alias("slot"), F.col("path").cast("binary").alias("edge"), F.lit(1).alias("turn"),
        F.lit(0).alias("step"), F.lit(None).cast("struct<size:int,host_size:int,rule:string,verdict:string>").alias("rule"), "row")
    rule = F.struct(
        (F.length("host") + F.length("path")).alias("size"), F.length("host").alias("host_size"),
        F.concat("host", "path").alias("rule"), "verdict").alias("rule")
    dealt = placed.join(met, "site").select("site", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1)).alias("slot"), "path", rule)
    opens, closes = F.col("path").cast("binary"), F.concat(F.col("path").cast("binary"), F.lit(_BEHIND))
    edges = dealt.select("site", "slot", F.explode(F.array(
        F.struct(opens.alias("edge"), F.lit(0).alias("turn"), F.lit(1).alias("step"), F.col("rule").alias("rule")),
        F.struct(closes.alias("edge"), F.lit(2).alias("turn"), F.lit(-1).alias("step"), F.lit(None).alias("rule")))).alias("e")).select(
        "site", "slot", "e.*", F.lit(None).cast("long").alias("row"))

    best = _sweep(urls.unionByName(edges)).groupBy("row").agg(F.max(F.struct("size", "host_size", "rule", "verdict")).alias("best"))
    return addresses.join(best, "row", "left").select(
        *(F.col(f"keep_{k}").alias(name) for k, name in enumerate(keep)), "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
