"""Verdicts on urls by prefix rules: a sort-merge range join, with DataFrame functions only.

A rule (host, path) becomes the interval of all keys that begin with its key: the host's labels
reversed, a separator, the path. A url becomes one key for its host and each domain above it, so
that a rule fits exactly when one of those keys lies in its interval. Within a domain the
intervals of rules are nested or apart; each start puts a rule on the stack of active ones and
each end gives the stack back to the rule around it. Keys and interval bounds are sorted
together, and each key takes the rule on top of the stack at the last bound before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldsignal.llm.common import LOWER, UPPER, same_key

#: Tasks that share the keys of one domain.
SALTS = 32
DEFAULT_VERDICT = "allow"
# The rules of the query, as host, path, verdict.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty if there is none."""
    host = F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ?, # or the end; empty if there is no ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _key(host: Column, path: Column) -> Column:
    """The canonical key, as bytes: labels from the top domain down, a zero, the path."""
    labels = F.array_join(F.reverse(F.split(host, r"\.")), ".")
    return F.encode(F.concat(labels, F.lit("\0"), path), "utf-8")


def rules_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, "host string, path string, verdict string")


def _bounds(rules: DataFrame) -> DataFrame:
    """domain, key, place, rule, verdict, size: the stack's top from each start and end of a rule on.

    The rule around another is the longest whose path is a proper prefix of its path, on the same host.
    """
    rules = rules.groupBy(F.translate("host", UPPER, LOWER).alias("domain"), F.col("path").alias("rule_path")).agg(
        F.min("verdict").alias("verdict")
    )
    rules = rules.withColumn("rule", F.concat("domain", "rule_path")).withColumn("size", F.length("rule"))
    shorter = F.expr("transform(sequence(0, greatest(length(rule_path) - 1, 0)), n -> left(rule_path, n))")
    inner = rules.where(F.length("rule_path") > 0).select("domain", "rule_path", F.explode(shorter).alias("part"))
    outer = rules.select(
        "domain", F.col("rule_path").alias("part"), F.struct("size", "rule", "verdict").alias("outer")
    )
    around = inner.join(outer, ["domain", "part"]).groupBy("domain", "rule_path").agg(F.max("outer").alias("outer"))
    rules = rules.join(around, ["domain", "rule_path"], "left")
    key = _key(F.col("domain"), F.col("rule_path"))
    start = F.struct(key.alias("key"), F.col("rule"), F.col("verdict"), F.col("size"))
    # No byte of a text is 0xFF: the end lies behind every key with this prefix. Of ends at one
    # key none is needed but the outermost, and of a start and an end at one key the start.
    end = F.struct(
        F.concat(key, F.unhex(F.lit("FF"))).alias("key"),
        F.col("outer.rule").alias("rule"),
        F.col("outer.verdict").alias("verdict"),
        F.col("outer.size").alias("size"),
    )
    return rules.select("domain", F.explode(F.array(start, end)).alias("b")).select("domain", "b.*")


def judge(pages: DataFrame, rules: DataFrame, default: str = DEFAULT_VERDICT, salts: int = SALTS) -> DataFrame:
    """page_id, host, path, rule, verdict of every row: the longest rule that fits, else ``default``.

    A null url, or one without ://, has an empty host and path; then only a rule for the empty
    host could fit. Of rules with the same host and path the verdict that sorts first holds.
    Repeated rows stay. Equal urls are judged once; the keys of a domain are dealt to ``salts``
    tasks, to each of which the bounds of the rules (few, as against the urls) are copied.
    """
    urls = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    distinct = urls.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    above = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda n: F.array_join(F.slice(labels, n, 999_999), "."))
    keys = distinct.select("host", "path", F.explode(above).alias("domain"))
    bounds = _bounds(rules)
    # Domains without a rule need no sweep.
    keys = keys.join(bounds.select("domain").distinct(), "domain", "left_semi")
    points = keys.select(
        "domain",
        F.pmod(F.xxhash64("host", "path"), F.lit(salts)).alias("salt"),
        _key(F.col("domain"), F.col("path")).alias("key"),
        F.lit(1).alias("place"),
        F.lit(None).cast("struct<rule:string,verdict:string,size:int>").alias("top"),
        "host",
        "path",
    )
    marks = bounds.select(
        "domain",
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("salt"),
        "key",
        F.lit(0).alias("place"),
        F.struct("rule", "verdict", "size").alias("top"),
        F.lit(None).cast("string").alias("host"),
        F.lit(None).cast("string").alias("path"),
    )
    sweep = Window.partitionBy("domain", "salt").orderBy("key", "place").rowsBetween(Window.unboundedPreceding, 0)
    swept = points.union(marks).withColumn("active", F.last("top", ignorenulls=True).over(sweep)).where("place = 1")
    fit = swept.where("active.rule is not null").groupBy("host", "path").agg(
        F.max(F.struct("active.size", "active.rule", "active.verdict")).alias("best")
    )
    return same_key(urls, fit, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
