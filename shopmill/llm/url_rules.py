"""Block and allow rules for urls, by a sort-merge range join of prefixes.

A rule (host, path) fits its host and all subdomains, if the url's path starts
with the rule's; of several rules the longest wins. A canonical key is the
host with its labels reversed, a slash (which no host has), and the path, as
bytes; so a rule is the interval from its own key to that key and a byte which no text
has. A url is looked up under its host and each parent domain.

1. Intervals are nested or apart. A sweep over their ends keeps the stack of the
   rules that are open: the number of open ones is a running sum, and a rule
   that opens as the n-th stands at place n. Where one closes, the rule at the top
   is the last one that opened at the place below, so rules become disjoint
   segments.
2. Segment starts and distinct url keys are sorted together by range
   partitions. A window carries the last segment start on to the urls behind
   it; a partition begins with the last start of the partitions before.
3. The longest rule of a url's keys is joined back to all its rows.

Everything is DataFrame work. A key that many urls share is one row of the
sweep, and partitions hold ranges of keys, so no host gathers in one task.
A null url, or one without ``://``, has an empty host and path and no rule. A
path that is empty starts with no rule's path. Repeated rows are judged
alike; of rules with one host and path the blocking one counts; rules of null
host, path or verdict take no part, nor do hosts with a slash, which fit nothing. Empty tables give empty results, no rules
the default verdict. Columns other than ``page_id`` and ``url`` are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shopmill.llm.ordered import latest, running

#: The rules of the registered query: verdict, host, path.
RULES = (
    ("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"),
)
#: The verdict where no rule fits.
DEFAULT = "allow"
#: Parts a key's host from its path.
PART = "/"
#: Sorts behind every continuation of a key: no byte of UTF-8.
LAST = b"\xff"
#: Marks a segment in which no rule is active.
NONE = ""
ACTIVE = "struct<rule:string,size:int,verdict:string>"


def lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parts(url: str = "url") -> tuple[Column, Column]:
    """Host and path of a url; both empty without ``://``."""
    text = F.coalesce(F.col(url), F.lit(""))
    at = F.locate("://", text)
    rest = F.substr(text, at + 3)
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^([^?#]*)", 1)
    return F.when(at > 0, lower(host)).otherwise(""), F.when(at > 0, path).otherwise("")


def reversed_host(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.")), ".")


def key_of(domain: Column) -> Column:
    return F.concat(domain, F.lit(PART), F.col("path")).cast("binary")


def segments(rules: DataFrame) -> DataFrame:
    """``key, place, active``: from each key on, which rule is active (none: an empty rule)."""
    known = rules.where("host IS NOT NULL AND path IS NOT NULL AND verdict IS NOT NULL").where(~F.contains("host", F.lit(PART)))
    known = known.groupBy(lower(F.col("host")).alias("host"), "path").agg(F.max("verdict").alias("verdict"))
    active = F.struct(F.concat("host", "path").alias("rule"), (F.length("host") + F.length("path")).alias("size"), "verdict")
    known = known.select(key_of(reversed_host(F.col("host"))).alias("key"), active.alias("active"))
    # At one key what closes comes first.
    opens = known.select("key", F.lit(1).alias("place"), F.lit(1).alias("step"), "active")
    closes = known.select(F.concat("key", F.lit(LAST)).alias("key"), F.lit(0).alias("place"), F.lit(-1).alias("step"), F.lit(None).cast(ACTIVE).alias("active"))
    order = [F.col("key"), F.col("place")]
    ends = running(opens.unionByName(closes), order, before=F.col("step")).withColumn("depth", F.col("before") + F.col("step"))
    top = latest(ends, order, "active", "top", by=["depth"])
    none = F.struct(F.lit(NONE).alias("rule"), F.lit(0).alias("size"), F.lit("").alias("verdict"))
    return top.select("key", "place", F.when(F.col("depth") > 0, F.col("top")).otherwise(none).alias("active"))


def sweep(keys: DataFrame, starts: DataFrame) -> DataFrame:
    """For each distinct ``key``, the active segment (``rule``, ``size``, ``verdict``)."""
    asked = keys.select("key", F.lit(2).alias("place"), F.lit(None).cast(ACTIVE).alias("active"))
    swept = latest(starts.unionByName(asked), [F.col("key"), F.col("place")], "active", "found")
    return swept.where("place = 2").select("key", "found.*").where(F.col("rule") != NONE)


def judge(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for each page."""
    host, path = parts()
    split = pages.select("page_id", host.alias("host"), path.alias("path"))
    urls = split.select("host", "path").where("host <> ''").distinct()
    labels = F.split("host", r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.reverse(F.slice(labels, i, F.size(labels))), "."))
    asked = urls.select("host", "path", F.explode(parents).alias("domain"))
    asked = asked.withColumn("key", key_of(F.col("domain")))
    found = sweep(asked.select("key").distinct(), segments(rules))
    longest = F.max_by(F.struct("rule", "verdict"), F.struct("size", "rule"))
    best = asked.join(found, "key").groupBy("host", "path").agg(longest.alias("best"))
    return split.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")
    )


def op3_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    rows = [F.struct(F.lit(v).alias("verdict"), F.lit(h).alias("host"), F.lit(p).alias("path")) for v, h, p in RULES]
    rules = spark.range(1).select(F.inline(F.array(*rows)))
    return judge(spark.read.parquet(f"{folder}/pages.parquet"), rules)


STATEMENT = """
WITH cut AS (
    SELECT page_id, strpos(coalesce(url, ''), '://') > 0 AS there,
        substr(url, strpos(url, '://') + 3) AS rest
    FROM pages
), hosts AS (
    SELECT page_id, there, rest, CASE WHEN there THEN regexp_extract(rest, '^([^/?#]*)', 1) ELSE '' END AS raw FROM cut
), split AS (
    SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        CASE WHEN there THEN regexp_extract(substr(rest, length(raw) + 1), '^([^?#]*)', 1) ELSE '' END AS path
    FROM hosts
), judged AS (
    SELECT page_id, host, path, CASE
        WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
        WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
        WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
        WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
    FROM split
)
SELECT page_id, host, path, rule,
    CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM judged
"""
