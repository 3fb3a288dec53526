"""URL filters: a sort-merge range join of hosts with nested rules.

A host is written with its labels reversed and a dot after each
(``www.example.com`` -> ``com.example.www.``), so the hosts that a rule covers
are exactly those whose key starts with the rule's key: one interval of the
sorted order, and two rules' intervals nest or are disjoint. Sorting rules and
distinct hosts together and sweeping once, the rule host that starts last
before a host carries the stack of all rule hosts open there; the entries of
that stack that cover the host are its active rules. Paths are then tested
against the active rules alone, and the longest rule wins.

Everything is DataFrame functions. The sweep runs in range partitions; each
gets the last rule host that starts before it (one row per partition), so no
partition needs another's rows. Hosts are made distinct first: a host that
holds a third of all pages is one row of the sweep, and pages meet their
verdict in a join that AQE splits.

Defined results: a null url or one without ``://`` has empty host and path, no
rule and the default verdict; repeated page rows are judged each; an empty
rule table gives every page the default; a rule given twice counts once, and
where one rule is given with both verdicts, ``block`` stands. Other columns
of the pages are left out of the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sessionlens.llm.common import stored, table

ALLOW, BLOCK = "allow", "block"
# The rules of the registered query (host, path, verdict).
RULES = (
    ("com", "/", ALLOW),
    ("example.com", "/en/", BLOCK),
    ("www.example.com", "/en/", ALLOW),
    ("net", "/es/", BLOCK),
    ("net", "/fr/", BLOCK),
)


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def rule_stacks(rules: DataFrame) -> DataFrame:
    """(key, stack): for each distinct rule host the rules open at its start,
    its own and those of the hosts above it. The hosts above a host are found
    by equality on its suffixes, so nothing is compared pairwise."""
    one = (
        rules.where(F.col("host").isNotNull() & F.col("path").isNotNull())
        .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
        .select(host_key(F.col("host")).alias("rule_key"), "host", "path", "verdict")
    )
    own = one.groupBy("rule_key").agg(F.collect_list(F.struct("rule_key", "host", "path", "verdict")).alias("rules"))
    labels = F.split(F.col("key"), r"\.")
    above = (
        own.select(F.col("rule_key").alias("key"))
        .withColumn("depth", F.explode(F.sequence(F.lit(1), F.size(labels) - 1)))
        .select("key", F.concat(F.array_join(F.slice(labels, F.lit(1), F.col("depth")), "."), F.lit(".")).alias("rule_key"))
    )
    return above.join(own, "rule_key").groupBy("key").agg(F.flatten(F.collect_list("rules")).alias("stack"))


def sweep(hosts: DataFrame, stacks: DataFrame) -> DataFrame:
    """(key, active): each host key with the rules that cover it."""
    empty = F.lit(None).cast(stacks.schema["stack"].dataType)
    events = stacks.select("key", "stack", F.lit(True).alias("is_rule")).unionByName(
        hosts.select("key", empty.alias("stack"), F.lit(False).alias("is_rule"))
    )
    ordered = stored(
        events.repartitionByRange("key").withColumn("part", F.spark_partition_id()), "url-sweep"
    )  # written: the partition numbers must not change between the two uses
    last = F.max_by("stack", "key").alias("opened")
    opened = ordered.where("is_rule").groupBy("part").agg(last)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per range partition
    carried = (
        ordered.select("part").distinct().join(opened, "part", "left")
        .select("part", F.last("opened", ignorenulls=True).over(before).alias("carried"))
    )
    order = Window.partitionBy("part").orderBy("key", F.col("is_rule").desc())
    swept = ordered.join(F.broadcast(carried), "part").withColumn(
        "open", F.coalesce(F.last("stack", ignorenulls=True).over(order), F.col("carried"))
    )
    active = F.filter("open", lambda r: F.col("key").startswith(r["rule_key"]))
    return swept.where(~F.col("is_rule")).select("key", active.alias("active")).where(F.size("active") > 0)


def judge(pages: DataFrame, rules: DataFrame, default: str = ALLOW) -> DataFrame:
    """(page_id, host, path, rule, verdict) for each row of ``pages``
    (page_id, url) under ``rules`` (host, path, verdict)."""
    split = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    split = split.withColumn("key", host_key(F.col("host")))
    active = sweep(split.select("key").distinct(), rule_stacks(rules))
    fits = F.filter("active", lambda r: F.col("path").startswith(r["path"]))
    # Longest first; a struct compares by its first field, then the verdict.
    ranked = F.transform(fits, lambda r: F.struct(
        (F.length(r["host"]) + F.length(r["path"])).alias("size"), r["verdict"].alias("verdict"),
        F.concat(r["host"], r["path"]).alias("rule"),
    ))
    best = F.array_max(ranked)
    return split.join(active, "key", "left").select(
        "page_id", "host", "path", best["rule"].alias("rule"), F.coalesce(best["verdict"], F.lit(default)).alias("verdict")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return judge(table(spark, sf_dir, "pages"), rules)


def _oracle() -> str:
    values = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
    return f"""
with rules(rule_host, rule_path, rule_verdict) as (values {values}),
cut as (
  select page_id, row_number() over () as n,
         case when strpos(coalesce(url, ''), '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest
  from pages),
parts as (
  select page_id, n, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from cut),
best as (
  select n, arg_max(rule_host || rule_path, length(rule_host || rule_path)) as rule,
         arg_max(rule_verdict, length(rule_host || rule_path)) as verdict
  from parts, rules
  where (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
  group by n)
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from parts left join best using (n)
"""


ORACLE_SQL = _oracle()
