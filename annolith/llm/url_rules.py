"""URL filtering by association rules, in DataFrame functions only.

FP-growth mines the combinations of URL tokens that occur with a label; rules "tokens -> bad" that pass the support and
confidence bounds, and of which no shorter rule is a part, are matched through an inverted index: each rule is listed
under its rarest token, so a URL meets only the rules of its own tokens. Given host-and-path rules come first.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annolith.llm.common import cut

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BAD = "label:bad"
#: Rules that are broadcast; more are joined by a shuffle.
BROADCAST_RULES = 50_000

#: (host, path, verdict), as given.
HOST_PATH_RULES = [
    ("com", "/en/", "block"),
    ("example.com", "/en/7", "allow"),
    ("net", "/de/", "allow"),
    ("example.net", "/de/8", "block"),
    ("org", "/es/", "block"),
]


def host_of(url: Column) -> Column:
    """What follows the first `://` up to `/`, `?`, `#` or the end, in lower-case ASCII; empty for a null URL or one without `://`."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_tokens(url: Column) -> Column:
    """Distinct tokens: host labels, path parts, query keys and the scheme, each with its kind; numbers become one token."""
    host, path = host_of(url), path_of(url)
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1)
    plain = lambda x: F.regexp_replace(F.lower(x), "[0-9]+", "0")
    kinds = [
        F.transform(F.split(host, r"\."), lambda x: F.when(x != "", F.concat(F.lit("host:"), x))),
        F.transform(F.split(path, "[/.]"), lambda x: F.when(x != "", F.concat(F.lit("path:"), plain(x)))),
        F.transform(F.split(query, "&"), lambda x: F.when(x != "", F.concat(F.lit("query:"), F.lower(F.split(x, "=")[0])))),
        F.array(F.when(F.coalesce(url, F.lit("")).contains("://"), F.concat(F.lit("scheme:"), F.lower(F.split(url, "://")[0])))),
    ]
    return F.array_distinct(F.filter(F.concat(*kinds), lambda x: x.isNotNull()))


def mine_rules(labelled: DataFrame, min_support: float = 0.002, min_confidence: float = 0.6, least_rows: int = 10) -> DataFrame:
    """(rule_id, tokens, anchor, confidence) from labelled URLs (url, bad boolean).

    A rule's tokens occur with the bad label in min_support of all rows, and in least_rows rows, at least. Of rules that hold
    a shorter rule's tokens none is kept. Rows with a null label teach nothing; without bad rows there are no rules."""
    spark = labelled.sparkSession
    rows = cut(labelled.where("bad is not null").select(url_tokens(F.col("url")).alias("tokens"), "bad").select(F.when(F.col("bad"), F.array_append("tokens", F.lit(BAD))).otherwise(F.col("tokens")).alias("items")).where(F.size("items") > 0), "transactions")
    n, bad = rows.agg(F.count("*"), F.count_if(F.array_contains("items", BAD))).first()
    empty = spark.createDataFrame([], "rule_id long, tokens array<string>, anchor string, confidence double")
    if not bad:
        return empty
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, max(min_support, least_rows / n)), minConfidence=min_confidence).fit(rows)
    rules = model.associationRules.where((F.size("consequent") == 1) & (F.col("consequent")[0] == BAD))
    rules = rules.select(F.array_sort("antecedent").alias("tokens"), "confidence")
    seen = model.freqItemsets.where(F.size("items") == 1).select(F.col("items")[0].alias("token"), "freq")
    anchors = rules.select("tokens", F.explode("tokens").alias("token")).join(seen, "token").groupBy("tokens").agg(F.min_by("token", F.struct("freq", "token")).alias("anchor"))
    rules = cut(rules.join(anchors, "tokens").select(F.xxhash64("tokens").alias("rule_id"), "tokens", "anchor", "confidence"), "rules")
    parts = rules.select(F.col("rule_id").alias("part_id"), F.col("tokens").alias("part"), F.col("anchor").alias("token"))
    longer = rules.select("rule_id", "tokens", F.explode("tokens").alias("token")).join(parts, "token").where((F.size("part") < F.size("tokens")) & (F.size(F.array_except("part", "tokens")) == 0))
    return rules.join(longer.select("rule_id").distinct(), "rule_id", "left_anti")


def matched(urls: DataFrame, rules: DataFrame, key: str) -> DataFrame:
    """Keys of urls (key, tokens) that hold all tokens of some rule, through the inverted index of anchors."""
    index = rules.select(F.col("anchor").alias("token"), F.col("tokens").alias("needed"))
    index = F.broadcast(index) if rules.count() <= BROADCAST_RULES else index
    met = urls.select(key, "tokens", F.explode("tokens").alias("token")).join(index, "token")
    return met.where(F.size(F.array_except("needed", "tokens")) == 0).select(key).distinct()


def fitting_rule(host: Column, path: Column, rules=HOST_PATH_RULES) -> Column:
    """The longest rule that fits, as struct(rule, verdict), or null; rules are a short fixed list."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule_host, rule_path, verdict in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), len(r[0]))):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        found = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def judge(pages: DataFrame, labelled: DataFrame, rules=HOST_PATH_RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of pages (page_id, url); labelled: (url, bad).

    A fitting host-and-path rule decides; else a URL that matches a mined rule is blocked and any other allowed. A null URL has
    no tokens and is allowed (its key is its own, so that null URLs don't meet in one task). Rows with equal or null page ids are judged each by its own URL."""
    url = F.col("url")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", host_of(url).alias("host"), path_of(url).alias("path"))
    rows = rows.withColumn("given", fitting_rule(F.col("host"), F.col("path"), rules)).withColumn("url_key", F.coalesce("url", F.concat(F.lit("\0"), F.coalesce(F.col("page_id").cast("string"), F.lit("")))))
    mined = mine_rules(labelled)
    bad = matched(rows.where("given is null and url is not null").select("url_key", url_tokens(url).alias("tokens")), mined, "url_key").withColumn("bad", F.lit(True))
    out = rows.join(bad, "url_key", "left")
    return out.select("page_id", "host", "path", F.col("given.rule").alias("rule"), F.coalesce("given.verdict", F.when(F.col("bad"), "block").otherwise("allow")).alias("verdict"))


def page_labels(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(url, bad): a page shows the document whose number its path names; it is bad where that label row says low quality or toxic.

    Pages with a null URL, without a number in the path or without a label teach nothing."""
    own = labels.where("doc_id is not null").groupBy("doc_id").agg(((F.min("quality") == 0) | (F.max("toxic") == 1)).alias("bad"))
    shown = pages.select("url", F.regexp_extract(path_of(F.col("url")), r"/([0-9]{1,18})(?:[./]|$)", 1).try_cast("long").alias("doc_id")).where("url is not null and doc_id is not null")
    return shown.join(own, "doc_id").select("url", "bad")


_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
#: The verdicts as long as no rule is mined, which is so on the test tables.
ORACLE_SQL = f"""
with u as (select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
     h as (select page_id, rest, regexp_extract(rest, '^[^/?#]*') as raw from u),
     p as (select page_id, translate(raw, {_LOWER}) as host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') as path from h),
     g(of_host, of_path, said) as (values {", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in HOST_PATH_RULES)}),
     f as (select page_id, arg_max(of_host || of_path, length(of_host || of_path)) as rule, arg_max(said, length(of_host || of_path)) as said
           from p join g on (host = of_host or ends_with(host, '.' || of_host)) and starts_with(path, of_path) group by page_id)
select p.page_id, host, path, rule, coalesce(said, 'allow') as verdict from p left join f using (page_id)
"""
