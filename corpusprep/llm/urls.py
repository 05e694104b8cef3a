"""URL filters: host-suffix and path-prefix expressions, joined on short hashes and confirmed by full digests.

A rule (host, path, verdict) fits a URL whose host is the rule's or a subdomain of it and whose path starts
with the rule's.  A URL's expressions are its host suffixes, cut at dots, times its path prefixes, cut
after slashes; a rule is filed under its host and its path up to the last slash.  URL and rule meet on the
first 32 bits of the expression's SHA-256; what meets is confirmed by the whole digest and by the rest of
the rule's path.  Of several rules that fit the one with the longest host and path wins, then the one
with the longer host, then a block.

No URL is cut short: expressions with more labels or slashes than any rule has cannot meet a rule, so they are
not made.  The rules' side is as large as the list; Spark broadcasts it only where its bytes allow, and
splits hot expressions (a third of all URLs on one host) of a shuffled join.

Defined cases: a null URL or one without ``://`` has an empty host and path and no rule; so has an empty
host.  Rules are compared with a lower-cased host (A-Z); rules without host or verdict fit nothing, a null path is
empty; a rule listed twice counts once, and a block wins over an allow of the same host and path.  Repeated pages are rows like others; null
ids stay null; an empty table or list gives no rows or no rules.  Columns other than those named are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Fields of a rule in its order of precedence: the largest struct wins.
_RANK = ("length", "host_length", "block")


def _after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    return F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise(F.lit(""))


def url_host(url: Column) -> Column:
    return F.translate(F.regexp_extract(_after_scheme(F.coalesce(url, F.lit(""))), "^[^/?#]*", 0), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(F.coalesce(url, F.lit(""))), "^[^/?#]*([^?#]*)", 1)


def _count(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char)))


def _short(digest: Column) -> Column:
    """The first 32 bits of a digest."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def compile_rules(rules: DataFrame) -> DataFrame:
    """The rule list (host, path, verdict) as joined: staged, one row per host and path."""
    host, path = F.translate("host", _UPPER, _LOWER), F.coalesce("path", F.lit(""))
    clean = rules.select(host.alias("r_host"), path.alias("r_path"), F.lower("verdict").alias("r_verdict"))
    one = clean.filter("r_host <> '' AND r_verdict IN ('allow', 'block')").groupBy("r_host", "r_path").agg(F.max("r_verdict").alias("r_verdict"))
    # up to the last slash: the whole path without what follows it
    folder = F.substr("r_path", F.lit(1), F.length("r_path") - F.length(F.substring_index("r_path", "/", -1)))
    filed = F.when(F.instr("r_path", "/") > 0, folder).otherwise(F.lit(""))
    digest = F.sha2(F.concat("r_host", filed), 256)
    return stage(one.withColumn("filed", filed).select(
        "r_host", "r_path", "r_verdict", (_count(F.col("r_host"), ".") + 1).alias("labels"), _count(F.col("filed"), "/").alias("slashes"),
        digest.alias("digest"), _short(digest).alias("short"),
        (F.length("r_host") + F.length("r_path")).alias("length"), F.length("r_host").alias("host_length"),
        (F.col("r_verdict") == "block").alias("block")), "url_rules")


def expressions(host: Column, path: Column, labels: int, slashes: int) -> Column:
    """Every host suffix of up to ``labels`` labels followed by every path prefix of up to ``slashes`` slashes."""
    some = lambda n, top: F.sequence(F.lit(1), F.least(n, F.lit(top)).cast("int"))
    hosts = F.when(host == "", F.array().cast("array<string>")).otherwise(
        F.transform(some(_count(host, ".") + 1, max(labels, 1)), lambda k: F.call_function("substring_index", host, F.lit("."), -k)))
    cut = lambda j: F.concat(F.call_function("substring_index", path, F.lit("/"), j), F.lit("/"))
    deep = F.least(_count(path, "/"), F.lit(slashes))
    paths = F.concat(F.array(F.lit("")), F.when(deep < 1, F.array().cast("array<string>")).otherwise(F.transform(some(deep, max(slashes, 1)), cut)))
    return F.flatten(F.transform(hosts, lambda h: F.transform(paths, lambda p: F.concat(h, p))))


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """(id, url, host, path, rule, verdict) for every row of ``pages``; without a rule that fits, rule is null and verdict ``default``."""
    listed = compile_rules(rules)
    # two numbers: how far the rules reach
    labels, slashes = listed.agg(F.max("labels"), F.max("slashes")).first()
    rows = stage(pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.monotonically_increasing_id().alias("row"))
                 .withColumns({"host": url_host(F.col("url")), "path": url_path(F.col("url"))}), "url_pages")
    made = rows.select("row", "path", F.explode(expressions(F.col("host"), F.col("path"), labels or 0, slashes or 0)).alias("said"))
    hashed = made.withColumn("said", F.sha2("said", 256)).select("row", "path", "said", _short(F.col("said")).alias("short"))
    met = hashed.join(listed, "short").filter((F.col("said") == F.col("digest")) & F.startswith("path", "r_path"))
    rank = F.struct(*_RANK, F.concat("r_host", "r_path").alias("rule"), F.col("r_verdict").alias("verdict"))
    best = met.groupBy("row").agg(F.max(rank).alias("best"))
    return rows.join(best, "row", "left").select(
        "id", "url", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


def keep_allowed(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """The rows of ``pages`` whose URL is not blocked, as they are."""
    judged = judge(pages, rules, url_col, url_col, default)
    blocked = judged.filter("verdict = 'block'").select(F.col("url").alias("blocked_url")).distinct()
    return pages.join(blocked, pages[url_col].eqNullSafe(blocked["blocked_url"]), "left_anti")
