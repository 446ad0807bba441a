"""URL filters: host and path rules, and a blocked Bloom filter in front of an exact join.

A list of canonical URLs is folded into a blocked Bloom filter: a key picks one block of 256 bits
and sets one bit in each of the block's eight 32-bit lanes. The filter is built with one
aggregation (``bit_or`` per lane, combined map-side) and has at most ``max_blocks`` rows whatever
the length of the list, so broadcasting it is bounded (2**18 blocks: some 25 MB as Spark holds them, enough for
four million keys; of longer lists more URLs pass, for the join to sort out). URLs that miss the filter
are certainly unlisted and take no part in a shuffle; possible hits go to an exact
equi-join on the canonical URL, which removes the false positives. The join's list side has one
row a key and both sides are plain exchanges, so AQE splits a URL that many pages share.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ripplebook.llm.common import Scratch

LANES = 8
#: Odd multipliers, one a lane, that spread one hash over the lanes (fixed values of split block Bloom filters).
SALTS = (0x47B6137B, 0x44974D91, 0x8824AD5B, 0xA2B7289D, 0x705495C7, 0x2DF1424B, 0x9EFC4947, 0x5C6BFB31)
#: Query parameters that never change what a URL names.
TRACKING = r"^(ref|fbclid|gclid|utm_[a-z]+|session|sid)(=|$)"


@dataclass(frozen=True)
class HostRule:
    """``verdict`` for URLs of ``host`` and its subdomains whose path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def _after_scheme(url: Column) -> Column:
    """What follows the first ``://``; null where the url is null or has none."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url)))


def host_of(url: Column) -> Column:
    """Up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty where there is no ``://``."""
    host = F.regexp_extract(_after_scheme(url), r"(?s)^([^/?#]*)", 1)
    return F.coalesce(
        F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit("")
    )


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end; empty where there is no ``://``."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical_url(url: Column) -> Column:
    """host + path + sorted query, without scheme, port 80/443, ``www.``, fragment, tracking parameters,
    ``index.html`` and trailing slashes. Null where the url has no host."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), r":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_replace(path_of(url), r"/index\.html?$", "/"), r"/+$", "")
    asked = F.regexp_extract(_after_scheme(url), r"(?s)^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(
        F.filter(F.split(asked, "&"), lambda p: (p != "") & ~F.lower(p).rlike(TRACKING))
    )
    query = F.array_join(kept, "&")
    whole = F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
    return F.when(host != "", whole)


def rule_column(host: Column, path: Column, rules: tuple[HostRule, ...]) -> Column:
    """The longest rule that fits, as struct(rule, verdict); null where none does. Compiled to one CASE."""
    out = None
    for r in sorted(rules, key=lambda r: (-len(r.text), r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        value = F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def _block_and_lanes(key: Column, blocks: int) -> tuple[Column, list[Column]]:
    """Block number and, a lane, the number of the bit that the key sets there."""
    h = F.xxhash64(key)
    block = F.pmod(F.shiftrightunsigned(h, 32), F.lit(blocks))
    low = h.bitwiseAND(F.lit(0xFFFFFFFF))
    # (low * salt) mod 2**32, top five bits; the product stays below 2**63 in halves
    part, hi = low.bitwiseAND(F.lit(0xFFFF)), F.shiftright(low, 16)
    lanes = []
    for salt in SALTS:
        product = part * F.lit(salt) + F.shiftleft((hi * F.lit(salt)).bitwiseAND(F.lit(0xFFFF)), 16)
        lanes.append(F.shiftrightunsigned(product.bitwiseAND(F.lit(0xFFFFFFFF)), 27))
    return block, lanes


def block_count(n_keys: int, bits_per_key: int, max_blocks: int) -> int:
    """A power of two of 256-bit blocks that gives ``bits_per_key``, ``max_blocks`` at most."""
    want = max(1, -(-n_keys * bits_per_key // (32 * LANES)))
    return min(max_blocks, 1 << (want - 1).bit_length())


def build_filter(listed: DataFrame, key: str, blocks: int) -> DataFrame:
    """(block, lane0..lane7): the blocked Bloom filter of a column; one row per block in use."""
    block, lanes = _block_and_lanes(F.col(key), blocks)
    set_bits = [F.expr(f"shiftleft(1, cast(b{i} as int))").alias(f"m{i}") for i in range(LANES)]
    keyed = listed.filter(F.col(key).isNotNull()).select(
        block.alias("__block"), *[b.alias(f"b{i}") for i, b in enumerate(lanes)]
    )
    return (
        keyed.select("__block", *set_bits)
        .groupBy("__block")
        .agg(*[F.bit_or(f"m{i}").alias(f"__lane{i}") for i in range(LANES)])
    )


def probe_filter(rows: DataFrame, key: str, bloom: DataFrame, blocks: int, flag: str) -> DataFrame:
    """``rows`` with a boolean ``flag``: whether the filter may hold the key. Null keys never hit."""
    block, lanes = _block_and_lanes(F.col(key), blocks)
    hit = F.lit(True)
    for i in range(LANES):
        hit = hit & (F.expr(f"(shiftright(__lane{i}, cast(__b{i} as int)) & 1)") == 1)
    with_bits = rows.withColumns({"__block": block} | {f"__b{i}": b for i, b in enumerate(lanes)})
    joined = with_bits.join(F.broadcast(bloom), "__block", "left")  # at most `blocks` rows of 40 bytes
    return joined.select(
        *[F.col(f"`{c}`") for c in rows.columns],
        F.coalesce(hit & F.col(key).isNotNull(), F.lit(False)).alias(flag),
    )


def judge_urls(
    pages: DataFrame,
    listed: DataFrame,
    rules: tuple[HostRule, ...] = (),
    *,
    url: str = "url",
    listed_key: str = "canonical_url",
    bits_per_key: int = 16,
    max_blocks: int = 1 << 18,
) -> DataFrame:
    """``pages`` with host, path, canonical_url, rule, maybe_listed, listed and verdict.

    A fitting rule's verdict holds; else listed URLs are blocked and all others allowed. Null urls and
    urls without ``://`` have empty host and path, no canonical form and are allowed unless a rule fits.
    Repeated rows get equal verdicts; columns of these names are replaced, all others pass through.
    ``listed`` may hold nulls and repeats. An empty list blocks nothing.
    """
    added = ("host", "path", "canonical_url", "rule", "maybe_listed", "listed", "verdict")
    pages = pages.drop(*[c for c in added if c in pages.columns])
    u = F.col(url)
    rows = pages.withColumns({"host": host_of(u), "path": path_of(u), "canonical_url": canonical_url(u)})
    keys = listed.select(F.col(listed_key).alias("__key")).filter(F.col("__key").isNotNull()).distinct()
    keys = Scratch(pages.sparkSession, "urls").save(keys, "listed")
    blocks = block_count(keys.count(), bits_per_key, max_blocks)
    probed = probe_filter(rows, "canonical_url", build_filter(keys, "__key", blocks), blocks, "maybe_listed")
    # the join key is null for rows that missed the filter: they match nothing and are never moved by value
    hits = probed.filter("maybe_listed").join(
        keys.withColumn("listed", F.lit(True)), F.col("canonical_url") == F.col("__key"), "left"
    ).drop("__key")
    missed = probed.filter(~F.col("maybe_listed")).withColumn("listed", F.lit(None).cast("boolean"))
    all_rows = missed.unionByName(hits).withColumn("listed", F.coalesce("listed", F.lit(False)))
    fits = rule_column(F.col("host"), F.col("path"), rules)
    out = all_rows.withColumn("__fit", fits)
    return out.select(
        *[F.col(f"`{c}`") for c in all_rows.columns],
        F.col("__fit.rule").alias("rule"),
        F.coalesce(F.col("__fit.verdict"), F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"),
    )
