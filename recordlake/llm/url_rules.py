"""URL filters: nested prefix rules found by one sorted sweep."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordlake.functions import literal_rows
from recordlake.llm.batches import quoted, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Scheme end, host, path: a host ends at "/", "?", "#" or the end, a path at "?", "#" or the end.
URL = "://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def canonical_key(labels: Column, path: Column) -> Column:
    """Host labels from the last one on, then the path, as bytes.

    "/" and "?" stand in no host, and "?" in no path: a rule's key is a prefix of exactly the
    keys below it.
    """
    return F.concat(F.array_join(labels, "/"), F.lit("?"), path).cast("binary")


def rule_table(spark, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules given as (host, path, verdict), as a table."""
    names = ("host", "path", "verdict")
    return literal_rows(spark, [dict(zip(names, map(F.lit, rule))) for rule in rules])


def clean_rules(rules: DataFrame) -> DataFrame:
    """Rules with a host, which is lower-cased as the URLs' are, each once with its last verdict."""
    return (
        rules.where(F.col("host") != "")
        .groupBy(F.translate("host", UPPER, LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"))
        .agg(F.max("verdict").alias("verdict"))
        .withColumn("labels", F.reverse(F.split("host", r"\.")))
    )


def judged_urls(
    df: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = "allow"
) -> DataFrame:
    """The longest rule that fits each URL, and its verdict.

    ``rules`` has ``host``, ``path`` and ``verdict``. A rule fits its host and all subdomains, A-Z
    in hosts being lower-cased, if the URL's path starts with the rule's. The longest text of host
    and path wins, of equally long ones that with the longer host; if one rule has several
    verdicts, the last in the alphabet counts, so block beats allow. Rules with a null or an empty
    host fit nothing; a null path is empty.

    Returns a row per row: the key, ``host``, ``path``, ``rule`` (null if none fits), ``verdict``.
    A null URL, or one without "://", has an empty host and path and the default verdict. Other
    columns are not read, keys may be null, repeated rows are judged each, and empty tables of
    either kind are in order.

    One sort-merge pass: each URL stands in the sweep once for every trailing part of its host
    that a rule could name, each rule as the interval of keys that it is a prefix of. Intervals
    nest, so the rules open at a key are a stack. The number of open intervals is the height of
    the stack, and the last interval that opened at that height is its top. The sorted sequence
    is cut into ranges that are swept apart: a range begins with the rules open at the cut, which
    are those that opened in an earlier range and do not end before it. Their number is that of the
    rules nested at the cut, so neither the rules nor the URLs are repeated. Equal keys may lie in
    several ranges, so a host of any size is spread; equal rows are swept once.
    """
    clean = clean_rules(rules)
    # One number: no URL needs more trailing parts of its host than the deepest rule has.
    depth = clean.agg(F.coalesce(F.max(F.size("labels")), F.lit(0))).first()[0]
    events = stored(sweep_events(df, clean, depth, key, url), "url-events")
    swept = swept_ranges(events.unionByName(open_at_cuts(events)))
    best = swept.where("kind = 1").groupBy("page").agg(F.max("top").alias("best"))
    each = best.select("page.*", "best", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("page.copies"))))
    return each.select(
        F.col("key").alias(key),
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )


def sweep_events(df: DataFrame, clean: DataFrame, depth: int, key: str, url: str) -> DataFrame:
    """Openings (``kind`` 0), URLs (1) and endings (2) by ranges of their ``place``: ``share``."""
    rule = F.struct(
        (F.length("host") + F.length("path")).alias("length"),
        F.length("host").alias("host_length"),
        F.concat("host", "path").alias("rule"),
        "verdict",
    )
    none = F.lit(None)
    opened = clean.select(canonical_key(F.col("labels"), F.col("path")).alias("place"), rule.alias("opens"))
    ends = opened.select(F.concat("place", F.unhex(F.lit("FF"))).alias("place"), "opens")
    pages = df.select(F.col(quoted(key)).alias("key"), F.col(quoted(url)).alias("url"))
    pages = pages.groupBy("key", "url").agg(F.count("*").alias("copies"))
    labels = F.reverse(F.split("host", r"\."))
    parts = F.sequence(F.lit(0), F.least(F.size(labels), F.lit(depth)))
    pages = pages.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    # Two rows with the same key and other URLs may have the same host and path.
    page = F.struct("key", "host", "path", "copies", F.xxhash64("url").alias("of"), F.hash("url").alias("and"))
    searched = pages.withColumn("part", F.explode(parts)).select(
        canonical_key(F.slice(labels, 1, F.col("part")), F.col("path")).alias("place"), page.alias("page")
    )
    events = (
        opened.select("place", F.lit(0).alias("kind"), "opens", none.alias("page"))
        .unionAll(searched.select("place", F.lit(1), none, "page"))
        .unionAll(ends.select("place", F.lit(2), "opens", none))
    )
    tie = F.xxhash64("page", "opens")
    ranges = events.repartitionByRange("place", "kind", tie)
    return ranges.withColumn("share", F.spark_partition_id())


def open_at_cuts(events: DataFrame) -> DataFrame:
    """The rules open where a range begins, as openings (``kind`` -1) of that range.

    A rule that opens in one range and ends in a later one is open at every cut between.
    """
    rules = events.where("kind <> 1").groupBy("opens").agg(
        F.min(F.when(F.col("kind") == 0, F.col("place"))).alias("place"),
        F.min(F.when(F.col("kind") == 0, F.col("share"))).alias("from"),
        F.max(F.when(F.col("kind") == 2, F.col("share"))).alias("to"),
    )
    cuts = F.sequence(F.col("from") + 1, F.col("to"))
    return rules.where(F.col("from") < F.col("to")).select(
        "place", F.lit(-1).alias("kind"), "opens",
        F.lit(None).cast(events.schema["page"].dataType).alias("page"), F.explode(cuts).alias("share"),
    )


def swept_ranges(events: DataFrame) -> DataFrame:
    """Each range swept in the order of places; what is open stands before what opens.

    Adds ``height`` and ``top``, the opening on top of the stack. An opening counts at its own
    height; a URL sees the height of the stack it stands under.
    """
    order = [F.col("kind") >= 0, F.col("place"), F.col("kind")]
    so_far = Window.partitionBy("share").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    change = F.when(F.col("kind") <= 0, 1).when(F.col("kind") == 2, -1).otherwise(0)
    swept = events.withColumn("height", F.sum(change).over(so_far)).where("kind < 2")
    level = Window.partitionBy("share", "height").orderBy(*order)
    level = level.rowsBetween(Window.unboundedPreceding, 0)
    top = F.last(F.col("opens"), ignorenulls=True).over(level)
    return swept.withColumn("top", F.when(F.col("height") > 0, top))
