"""URL rules by a sort-merge range join.

A rule's key is its reversed host, a byte no text contains, and its path, so
the urls below it are one interval of sorted keys. A url is laid out once for
each suffix of its host that is as short as the rules' hosts. Urls and the two
ends of every rule are sorted together into ranges; a sweep over them keeps a
stack of the rules that are open. Intervals of one host nest, so the stack is
followed by its depth: what closing a rule uncovers is the last rule opened at
the depth that is left. A range that begins inside a rule takes over the top
of the stack from the range before.

Only DataFrame functions are used. Ranges cut through a frequent host, its
urls being told apart by path and row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martflow.llm.common import shuffle_partitions, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes that UTF-8 never uses: between host and path, and after the last key of a rule.
BETWEEN, AFTER = bytes([0xFE]), bytes([0xFF])
CLOSE, OPEN, URL = 0, 1, 2


def with_host_and_path(pages: DataFrame, url: str = "url") -> DataFrame:
    """page_id, host and path; both empty for a null url or one without ``://``."""
    start = F.instr(F.col(url), "://")
    rest = F.when(start > 0, F.substring(F.col(url), start + 3, F.length(url))).otherwise("")
    return (
        pages.select("page_id", F.coalesce(rest, F.lit("")).alias("_rest"))
        .withColumn("_host", F.regexp_extract("_rest", r"^[^/?#]*", 0))
        .select(
            "page_id",
            F.translate("_host", UPPER, LOWER).alias("host"),
            F.regexp_extract(F.expr("substring(_rest, length(_host) + 1)"), r"^[^?#]*", 0).alias("path"),
        )
    )


def _labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\."))


def _key(labels: Column, path: Column) -> Column:
    return F.concat(F.array_join(labels, ".").cast("binary"), F.lit(BETWEEN), path.cast("binary"))


def _events(rules: DataFrame) -> DataFrame:
    """Both ends of every rule in key order, with the rule on top of the stack after each."""
    one_each = (
        rules.filter("host is not null and path is not null and verdict is not null")
        .groupBy(F.translate("host", UPPER, LOWER).alias("host"), "path")
        .agg(F.max("verdict").alias("verdict"))
    )
    rule = F.struct(
        F.length(F.concat("host", "path")).alias("length"), F.concat("host", "path").alias("rule"), "verdict"
    )
    key = _key(_labels(F.col("host")), F.col("path"))
    ends = F.array(
        F.struct(key.alias("key"), F.lit(OPEN).alias("kind"), rule.alias("opened")),
        F.struct(F.concat(key, F.lit(AFTER)).alias("key"), F.lit(CLOSE).alias("kind"), F.lit(None).alias("opened")),
    )
    steps = one_each.select("host", F.inline(ends))
    depth = F.sum(F.when(F.col("kind") == OPEN, 1).otherwise(-1)).over(Window.partitionBy("host").orderBy("key", "kind"))
    at_depth = Window.partitionBy("host", "depth").orderBy("key", "kind")
    top = F.when(F.col("depth") > 0, F.last("opened", ignorenulls=True).over(at_depth))
    return steps.withColumn("depth", depth).select("key", "kind", F.struct(top.alias("top")).alias("stack"))


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """Every row of ``pages`` (page_id, url) with host, path, rule and verdict.

    ``rules`` has host, path and verdict. A rule fits its host and all
    subdomains if the path begins with the rule's; the longest wins by length of
    host and path together, and of two equal rules the verdict later in the
    alphabet (block before allow). Without a fitting rule, as for null urls,
    urls without ``://`` and empty paths, the rule is null and the verdict
    ``default``. Repeated pages and null ids keep their rows; further columns
    are ignored; an empty table gives an empty result, and no rules mean
    ``default`` for all. Rules with a null are left out.
    """
    spark = pages.sparkSession
    deepest = rules.agg(F.max(F.size(F.split("host", r"\.")))).first()[0] or 0
    urls = with_host_and_path(pages).withColumn("row", F.monotonically_increasing_id())
    suffixes = F.filter(
        F.sequence(F.lit(1), F.lit(max(deepest, 1))),
        lambda n: (n <= F.size(F.split("host", r"\."))) & (F.col("host") != "") & F.lit(deepest > 0),
    )
    keys = urls.select("*", F.explode_outer(suffixes).alias("n")).select(
        F.when(F.col("n").isNotNull(), _key(F.slice(_labels(F.col("host")), 1, F.col("n")), F.col("path")))
        .otherwise(F.lit(b""))
        .alias("key"),
        F.lit(URL).alias("kind"),
        F.struct("row", "page_id", "host", "path").alias("page"),
    )
    together = _events(rules).unionByName(keys, allowMissingColumns=True).withColumn("row", F.col("page.row"))
    ranges = stored(
        together.repartitionByRange(shuffle_partitions(spark), "key", "kind", "row").withColumn(
            "range", F.spark_partition_id()
        ),
        "url-ranges",
    )
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # A row for each range.
    taken_over = (
        ranges.groupBy("range")
        .agg(F.max_by("stack", F.when(F.col("stack").isNotNull(), F.struct("key", "kind"))).alias("last"))
        .select("range", F.last("last", ignorenulls=True).over(before).alias("taken_over"))
    )
    sweep = Window.partitionBy("range").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    found = (
        ranges.withColumn("stack", F.last("stack", ignorenulls=True).over(sweep))
        .filter(F.col("kind") == URL)
        .join(taken_over, "range")
        .select("page.*", F.coalesce("stack", "taken_over")["top"].alias("top"))
    )
    # Of the rules for the suffixes of one host, the longest.
    return (
        found.groupBy("row", "page_id", "host", "path")
        .agg(F.max("top").alias("top"))
        .select(
            "page_id",
            "host",
            "path",
            F.col("top.rule").alias("rule"),
            F.coalesce("top.verdict", F.lit(default)).alias("verdict"),
        )
    )
