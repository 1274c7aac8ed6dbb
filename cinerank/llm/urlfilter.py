"""Operator 9: URL rules through a blocked Bloom filter and an exact join.

All DataFrame expressions; no Python runs on the executors. A rule is a host
and a path prefix; it fits its host and all subdomains, if the URL's path
starts with the rule's path. Of the rules that fit, the longest written one
wins, then the one with the longer host, then a block.

Each URL has few possible rule keys: its host's last labels times its path's
prefixes of lengths that rules have. A blocked Bloom filter of the listed
keys (one 64-bit word a block, three bits a key) drops most of them; the
rest meet the list in a hash join, which removes false positives. The filter
has at most MAX_BLOCKS words, so its broadcast stays under 16 MB; a longer
list only lets more keys through to the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinerank.llm.common import columns

MAX_BLOCKS = 1 << 20
KEYS_PER_BLOCK = 4

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first `://` up to `/`, `?`, `#` or the end, A-Z
    lower-cased; path: from there up to `?`, `#` or the end. Both are empty
    for null or without `://`."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER), F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 2)


def _bits(key: Column) -> Column:
    h, out = F.xxhash64(key, F.lit(7)), F.lit(0).cast("long")
    for shift in (0, 6, 12):
        at = F.shiftright(h, shift).bitwiseAND(F.lit(63).cast("long")).cast("int")
        out = out.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), at))
    return out


def bloom_filter(keys: DataFrame, blocks: int) -> DataFrame:
    """`(block, word)` of the column `key`: at most `blocks` rows."""
    return keys.select(F.pmod(F.xxhash64("key"), F.lit(blocks)).alias("block"), _bits(F.col("key")).alias("b")).groupBy(
        "block").agg(F.bit_or("b").alias("word"))


def possible(keys: DataFrame, words: DataFrame, blocks: int) -> DataFrame:
    """The rows of `keys` whose `key` the filter may hold."""
    own = _bits(F.col("key"))
    return keys.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks))).join(F.broadcast(words), "block").where(
        F.col("word").bitwiseAND(own) == own).drop("block", "word")


def judge(pages: DataFrame, rules: DataFrame, *, url: str = "url", default: str = "allow") -> DataFrame:
    """`pages` with host, path, rule and verdict of each row.

    `rules` has host, path and verdict (`allow` or `block`); null or empty
    hosts and null paths are no rules, repeated ones count once. rule is the
    winning rule as written, host then path, else null with the `default`
    verdict. Rows keep their number; columns of the four names are replaced.
    No rows give no rows.
    """
    rules = columns(rules, "host", "path", "verdict").select(
        F.translate("host", _UPPER, _LOWER).alias("r_host"), F.col("path").alias("r_path"), "verdict").where(
        "r_host <> '' and r_path is not null").groupBy("r_host", "r_path").agg(F.max("verdict").alias("r_verdict"))
    rules = rules.withColumn("key", F.concat_ws("\n", "r_host", "r_path"))
    shape = rules.agg(F.count("*").alias("n"), F.max(F.size(F.split("r_host", r"\."))).alias("labels"),
                      F.collect_set(F.length("r_path")).alias("lengths")).first()  # lengths: no more than the longest path
    keep = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    host, path = host_and_path(F.col(f"`{url}`"))
    pages = pages.select(*[F.col(f"`{c}`") for c in keep], host.alias("host"), path.alias("path"))
    if not shape["n"]:
        return pages.select("*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    blocks = 1
    while blocks < MAX_BLOCKS and blocks * KEYS_PER_BLOCK < shape["n"]:
        blocks *= 2
    blocks = max(blocks, 64)
    seen = pages.where("host <> ''").select("host", "path").distinct()
    part = F.split("host", r"\.")
    tails = F.transform(F.sequence(F.lit(1), F.least(F.size(part), F.lit(shape["labels"]))),
                        lambda k: F.array_join(F.slice(part, F.size(part) - k + 1, k), "."))
    lengths = F.array(*[F.lit(x) for x in sorted(shape["lengths"])])
    heads = F.transform(F.filter(lengths, lambda n: n <= F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n))
    keys = seen.select("host", "path", F.explode(tails).alias("t"), heads.alias("heads")).select(
        "host", "path", "t", F.explode("heads").alias("h")).select("host", "path", F.concat_ws("\n", "t", "h").alias("key"))
    hits = possible(keys, bloom_filter(rules.select("key"), blocks), blocks).join(rules, "key")
    best = hits.groupBy("host", "path").agg(F.max(F.struct(
        (F.length("r_host") + F.length("r_path")).alias("n"), F.length("r_host").alias("m"),
        F.col("r_verdict").alias("verdict"), F.concat("r_host", "r_path").alias("rule"))).alias("best"))
    out = pages.join(best, ["host", "path"], "left")
    return out.select(*[F.col(f"`{c}`") for c in keep], "host", "path", F.col("best.rule").alias("rule"),
                      F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
