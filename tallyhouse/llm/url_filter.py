"""URL filter: rules by host and path first, else a list of canonical URLs behind a blocked Bloom filter.

A list too long for the filter raises the share of possible hits, and the exact join behind it removes them. URLs
that the filter rejects are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.llm.bloom import marked

SALTS = 8
#: (host, path, verdict); of several that fit, the longest wins. Fixed values.
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end; empty if there is none."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1), UPPER, LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def canonical(host: Column, path: Column) -> Column:
    """Host without ``www.`` or ``m.``, path without ``.html``, ``index`` or closing slashes; scheme, query and fragment fall away."""
    return F.concat(F.regexp_replace(host, r"^(www|m)\.", ""), F.regexp_replace(path, r"(/index)?(\.html?)?/*$", ""))


def judge(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str, str]] = RULES, url: str = "url", key: str = "page_id") -> DataFrame:
    """One row per page: key, host, path, rule, canonical, listed, verdict.

    ``listed`` has a column ``canonical``; repeats and nulls in it do nothing. A null URL, or one without
    ``://``, has empty host and path, fits no rule and is allowed. Repeated rows are judged each.
    """
    listed = listed.select("canonical").where(F.col("canonical").isNotNull() & (F.col("canonical") != "")).distinct()
    p = pages.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{url}`").alias("_url")).select("_key", host(F.col("_url")).alias("host"), path(F.col("_url")).alias("path"))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, q, v in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):
        fits = ((F.col("host") == h) | F.col("host").endswith(f".{h}")) & F.col("path").startswith(q)
        rule, verdict = F.when(fits, h + q).otherwise(rule), F.when(fits, v).otherwise(verdict)
    p = p.select("*", rule.alias("rule"), verdict.alias("_ruled"), canonical(F.col("host"), F.col("path")).alias("canonical"))
    columns = ["_key", "host", "path", "rule", "_ruled", "canonical"]
    probed = marked(p, listed, "canonical", "_maybe").select(*columns, (F.col("_maybe") & (F.col("canonical") != "")).alias("_maybe"))
    salted = listed.select("canonical", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])).alias("_salt"), F.lit(True).alias("listed"))
    hits = probed.where("_maybe").select(*columns, F.pmod(F.xxhash64("_key"), F.lit(SALTS)).cast("int").alias("_salt")).join(salted.hint("merge"), ["canonical", "_salt"], "left").select(*columns, F.coalesce("listed", F.lit(False)).alias("listed"))
    judged = hits.unionByName(probed.where("NOT _maybe").select(*columns, F.lit(False).alias("listed")))
    return judged.select(F.col("_key").alias(key), "host", "path", "rule", "canonical", "listed", F.coalesce("_ruled", F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"))


def repeated(pages: DataFrame, url: str = "url") -> DataFrame:
    """Canonical URLs that more than one page has: a list derived from a crawl."""
    u = F.col(f"`{url}`")
    c = canonical(host(u), path(u)).alias("canonical")
    return pages.select(c).groupBy("canonical").count().where((F.col("count") > 1) & (F.col("canonical") != "")).select("canonical")
