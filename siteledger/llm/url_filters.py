"""URL filters: longest host and path rule, then a blocked Bloom filter with an exact join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .bloom import build_filter, possible
from .common import keep

MOST_RULES = 1000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://`` or for a null url."""
    found = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.when(found, host).otherwise(""), F.when(found, path).otherwise("")


def canonical(host: Column, path: Column) -> Column:
    """``www.`` and ``m.`` prefixes, index pages, ``.html`` and closing slashes do not tell pages apart."""
    site = F.regexp_replace(host, r"^(www|m)\.", "")
    page = F.regexp_replace(F.regexp_replace(path, r"(/index)?\.html?$", ""), r"/+$", "")
    return F.when((host == "") & (path == ""), F.lit(None)).otherwise(F.concat(site, page))


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null.

    ``rules`` are (verdict, host, path), at most MOST_RULES.  Equal lengths: the longer host,
    then ``block`` before ``allow``, then the smaller text.
    """
    if len(rules) > MOST_RULES:
        raise ValueError(f"at most {MOST_RULES} rules")
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r[0] != "block", r))
    picked = F.lit(None).cast("struct<rule: string, verdict: string>")
    for verdict, site, start in reversed(ordered):
        fits = ((host == site) | host.endswith("." + site)) & path.startswith(start)
        picked = F.when(fits, F.struct(F.lit(site + start).alias("rule"),
                                       F.lit(verdict).alias("verdict"))).otherwise(picked)
    return picked


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]], listed: DataFrame,
          page_id: str = "page_id", url: str = "url", listed_url: str = "url") -> DataFrame:
    """page_id, host, path, canonical, rule, verdict, listed for every row.

    A fitting rule decides.  Else a page is blocked if its canonical URL is on the list:
    the broadcast filter (bounded size) lets sure misses pass without a shuffle, and only possible
    hits meet the list in a hash join, which is exact.  A hot URL is a skewed probe side, which
    the join splits at run time; list entries are made distinct first.

    Null urls and urls without ``://`` have empty host and path, no canonical form and pass as
    ``allow``.  Null or empty list entries are ignored; an empty list blocks nothing.  Repeated
    rows are judged each; other columns are not looked at.  Runs jobs (writes the list).
    """
    host, path = parts(F.col(url))
    split = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    ruled = split.withColumn("_rule", rule_for(F.col("host"), F.col("path"), rules)) \
        .withColumn("canonical", canonical(F.col("host"), F.col("path")))
    l_host, l_path = parts(F.col(listed_url))
    from_list = listed.select(l_host.alias("host"), l_path.alias("path")) \
        .select(canonical(F.col("host"), F.col("path")).alias("canonical")) \
        .where(F.col("canonical").isNotNull()).distinct()
    entries = keep(from_list, "listed")
    bloom, blocks = build_filter(entries, "canonical", entries.count())
    bloom = keep(bloom, "bloom")
    tested = possible(ruled, "canonical", bloom, blocks)
    open_hit = F.col("_maybe") & F.col("_rule").isNull()
    hits = tested.where(open_hit).join(
        entries.withColumn("listed", F.lit(True)), "canonical", "left")
    passed = tested.where(~open_hit).withColumn("listed", F.lit(False))
    columns = ["page_id", "host", "path", "canonical", "_rule",
               F.coalesce("listed", F.lit(False)).alias("listed")]
    both = passed.select(*columns).unionAll(hits.select(*columns))
    method = F.when(F.col("listed"), "block").otherwise("allow")
    return both.select("page_id", "host", "path", "canonical", F.col("_rule.rule").alias("rule"),
                       F.coalesce(F.col("_rule.verdict"), method).alias("verdict"), "listed")
