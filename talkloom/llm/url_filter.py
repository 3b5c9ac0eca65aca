"""URL rules behind a blocked Bloom filter, in DataFrame expressions only.

A rule is (host, path prefix, verdict) and fits its host and all subdomains. A url's
candidates are the rule-shaped canonical keys it could match: each suffix of its host
with each prefix of its path whose length some rule has. The filter, four 64-bit words
per block, drops candidates that are certainly no rule; possible hits go to an exact
hash join on the key, which removes false positives; the longest rule wins, of equally
long ones the one with the longer host, and ``block`` over ``allow``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from talkloom.llm.work import internal, small

BITS_PER_RULE = 16
FILTER_BYTES = 32 << 20
WORDS = 4
#: Odd multipliers, one per word of a block.
SPREAD = (0x47B6137B44974D91, 0x2DF1424B5C1E0A57, 0x705495C72DF1424B, 0x1EFC49479EFC4947)
ROW, KEYS, KEY, BEST, WORDS_OF = internal("row", "keys", "key", "best", "words")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without one."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def block_of(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def bit(key: Column, word: int) -> Column:
    """The bit a key sets in a word of its block."""
    place = F.shiftrightunsigned(F.xxhash64(key, F.lit(SPREAD[word])), 58).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("long"), place)


def filter_words(rules: DataFrame, blocks: int) -> DataFrame:
    """One row: the words of all blocks, ``WORDS`` per block, as an array of longs."""
    ors = [F.bit_or(bit(F.col("key"), i)).alias(f"w{i}") for i in range(WORDS)]
    set_ = rules.groupBy(block_of(F.col("key"), blocks).alias("block")).agg(*ors)
    pairs = set_.agg(F.map_from_entries(F.collect_list(F.struct("block", F.array(*(f"w{i}" for i in range(WORDS)))))).alias("m"))
    empty = F.array(*[F.lit(0).cast("long")] * WORDS)
    at = F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda b: F.coalesce(F.element_at("m", b), empty))
    return pairs.select(F.flatten(at).alias("words"))


def may_hold(words: Column, blocks: int, key: Column) -> Column:
    base = block_of(key, blocks) * WORDS
    tests = [F.get(words, base + i).bitwiseAND(bit(key, i)) != 0 for i in range(WORDS)]
    return tests[0] & tests[1] & tests[2] & tests[3]


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", url: str = "url") -> DataFrame:
    """Per page: id, host, path, rule (host and path of the winner or null), verdict.

    ``rules``: host, path, verdict; a null or empty host is ignored, repeated rules count
    once. Null urls and those without ``://`` have no host and get ``default``. Repeated
    page rows each give a row.
    """
    listed = (
        rules.where(F.coalesce(F.col("host"), F.lit("")) != "")
        .select(F.translate("host", UPPER, LOWER).alias("h"), F.coalesce(F.col("path"), F.lit("")).alias("p"), F.col("verdict").alias("v"))
        .select(F.concat("h", "p").alias("key"), F.length("h").alias("h"), F.length("p").alias("p"), F.size(F.split("h", r"\.")).alias("labels"), "v")
        .groupBy("key", "h", "p", "labels").agg(F.max("v").alias("v"))
    )
    n, labels, lengths = listed.agg(F.count("*"), F.max("labels"), F.collect_set("p")).first()
    rows = pages.select(F.col(id_col), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    if not n:
        return rows.select(id_col, "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    parts = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.least(F.size(parts), F.lit(labels))), lambda k: F.array_join(F.slice(parts, -k, k), "."))
    prefixes = F.filter(F.array(*[F.lit(x) for x in sorted(lengths)]), lambda k: k <= F.length("path"))
    keys = F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda k: F.struct(F.concat(s, F.substring("path", F.lit(1), k)).alias("key"), F.length(s).alias("h")))))
    keys = F.when(F.col("host") == "", F.array().cast("array<struct<key:string,h:int>>")).otherwise(keys)
    rows = rows.withColumn(ROW, F.monotonically_increasing_id()).withColumn(KEYS, keys)
    blocks = max(1, n * BITS_PER_RULE // (64 * WORDS))
    if blocks * WORDS * 8 <= FILTER_BYTES:  # a longer list is joined without the filter: same rows
        rows = rows.withColumn(WORDS_OF, filter_words(listed, blocks).scalar())
        rows = rows.withColumn(KEYS, F.filter(KEYS, lambda k: may_hold(F.col(WORDS_OF), blocks, k["key"])))
    hits = rows.select(ROW, id_col, "host", "path", F.explode_outer(KEYS).alias(KEY)).withColumn("key", F.col(KEY)["key"]).withColumn("h", F.col(KEY)["h"])
    exact = small(listed.select("key", "h", "v"), 100)
    found = hits.join(exact, ["key", "h"], "left")
    best = F.max(F.when(F.col("v").isNotNull(), F.struct(F.length("key").alias("n"), F.col("h"), F.col("v"), F.col("key")))).alias(BEST)
    one = found.groupBy(ROW).agg(best, *[F.first(c).alias(c) for c in (id_col, "host", "path")])
    return one.select(id_col, "host", "path", F.col(BEST)["key"].alias("rule"), F.coalesce(F.col(BEST)["v"], F.lit(default)).alias("verdict"))
