"""URL filters: rules by host and path, and a list of URLs behind a blocked Bloom filter."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktab.llm.common import fresh
from sparktab.session import materialize

#: Bits per listed URL, words of 32 bits per block (one bit is set in each), and bytes up to which the filter is sent to all tasks.
BITS_PER_URL, BLOCK_WORDS, SEND_BYTES = 16, 8, 64 << 20
#: One odd multiplier per word of a block.
SALTS = (0x47B6137B, 0x44974D91, 0x8824AD5B, 0xA2B7289D, 0x705495C7, 0x2DF1424B, 0x9EFC4947, 0x5C6BFB31)


@dataclass(frozen=True)
class Rule:
    """A host with all its subdomains, a path prefix, and the verdict there."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules of the query.
RULES = (Rule("block", "net"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without one."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without a leading www or m and without a port, path without index file and final slashes; no scheme, query or fragment."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), r"^(?:www|m)\.", ""), r":[0-9]*$", "")
    path = F.regexp_replace(F.regexp_replace(path_of(url), r"/index\.html?$", "/"), r"/+$", "")
    return F.when(host == "", F.lit(None).cast("string")).otherwise(F.concat(host, path))


def matching_rule(host: Column, path: Column, rules: tuple[Rule, ...], of) -> Column:
    """A property of the longest rule that fits (the last of equal length); null without one."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        out = F.when(fits, F.lit(of(rule))).otherwise(out)
    return out


def _place(url: Column, blocks: int) -> tuple[Column, list[Column]]:
    """The block of a URL and its bit in each word: upper and lower half of one hash."""
    h = F.xxhash64(url)
    block = F.pmod(F.shiftrightunsigned(h, 32), F.lit(blocks))
    low = h.bitwiseAND(F.lit(0x3FFFFFFF))  # 30 bits, so that no product overflows
    bits = [F.shiftrightunsigned((low * F.lit(s)).bitwiseAND(F.lit(0xFFFFFFFF)), 27) for s in SALTS[:BLOCK_WORDS]]
    return block, [F.call_function("shiftleft", F.lit(1).cast("long"), b.cast("int")) for b in bits]


def bloom_blocks(urls: DataFrame, column: str, blocks: int) -> DataFrame:
    """``block, w0..w7``: the filter as a table, every block the bitwise or of its URLs."""
    block, bits = _place(F.col(column), blocks)
    return urls.select(block.alias("block"), *[b.alias(f"w{i}") for i, b in enumerate(bits)]).groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(BLOCK_WORDS)])


def listed_urls(urls: DataFrame, listed: DataFrame) -> DataFrame:
    """Of the distinct canonical URLs (column ``canonical``) those that are listed.

    The filter passes possible hits, and a hash join with the list itself takes
    false ones out. A filter of proven small size is sent to all tasks, so only
    possible hits are shuffled; a larger one is joined on the block.
    """
    listed = materialize(listed.where("canonical is not null").select("canonical").distinct(), "listed")
    n = listed.count()
    blocks = max(1, n * BITS_PER_URL // (32 * BLOCK_WORDS))
    bloom = materialize(bloom_blocks(listed, "canonical", blocks), "bloom")
    if blocks * BLOCK_WORDS * 8 <= SEND_BYTES:
        bloom = F.broadcast(bloom)
    block, bits = _place(F.col("canonical"), blocks)
    probes = urls.where("canonical is not null").select("canonical", block.alias("block"), *[b.alias(f"b{i}") for i, b in enumerate(bits)])
    passed = probes.join(bloom, "block").where(" and ".join(f"w{i} & b{i} <> 0" for i in range(BLOCK_WORDS)))
    return passed.select("canonical").join(listed.hint("shuffle_hash"), "canonical", "left_semi")


def url_filter(df: DataFrame, listed: DataFrame, url_col: str = "url", rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, dict[str, str]]:
    """The table with host, path, canonical URL, rule and verdict, and the new columns' names.

    ``listed`` has a column ``canonical`` (nulls are ignored, repeats count
    once). The longest rule decides; without a rule a listed URL is blocked and
    any other allowed. Null or odd URLs have empty host and path and are allowed;
    repeated rows each get their verdict; an empty table gives an empty one.
    Only distinct canonical URLs go through the filter, so a URL on a third of
    all rows is probed once per task.
    """
    names = {k: fresh(df, k) for k in ("host", "path", "canonical", "rule", "verdict")}
    url = F.col(url_col)
    out = df.withColumn(names["host"], host_of(url)).withColumn(names["path"], path_of(url)).withColumn(names["canonical"], canonical(url))
    out = out.withColumn(names["rule"], matching_rule(F.col(names["host"]), F.col(names["path"]), rules, lambda r: r.name))
    verdict = matching_rule(F.col(names["host"]), F.col(names["path"]), rules, lambda r: r.verdict)
    is_open = F.col(names["rule"]).isNull() & F.col(names["canonical"]).isNotNull()
    distinct = out.where(is_open).select(F.col(names["canonical"]).alias("canonical")).distinct()
    hits = materialize(listed_urls(distinct, listed), "hits").select(F.col("canonical").alias(names["canonical"]), F.lit("block").alias(names["verdict"]))
    judged = out.where(is_open).join(hits, names["canonical"], "left").withColumn(names["verdict"], F.coalesce(names["verdict"], F.lit("allow")))
    decided = out.where(~is_open).withColumn(names["verdict"], F.coalesce(verdict, F.lit("allow")))
    columns = [*df.columns, *names.values()]
    return decided.select(*columns).unionByName(judged.select(*columns)), names
