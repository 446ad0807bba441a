"""Keys, names, outcomes and symbols."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Symbols by the words that name them, in order of preference (fixed values).
SYMBOL_WORDS = (("BTC", ("bitcoin", "btc")), ("ETH", ("ethereum", "ether", "eth")), ("SOL", ("solana", "sol")))
#: Series and slug names of the five-minute markets (fixed values).
SERIES_SLUGS = {"BTC": "btc-up-or-down-5m", "ETH": "eth-up-or-down-5m", "SOL": "sol-up-or-down-5m"}
SLUG_PREFIXES = {"BTC": "btc", "ETH": "eth", "SOL": "sol"}


def key(prefix: str, *parts: Column) -> Column:
    """``prefix:part:part``; null where a part is null."""
    return F.concat(F.lit(prefix), *[F.concat(F.lit(":"), p.cast("string")) for p in parts])


def safe_name(name: Column) -> Column:
    """A file name of letters, digits, dot, dash and underscore; ``.jsonl`` unless it ends in .json or .jsonl."""
    clean = F.regexp_replace(name, "[^A-Za-z0-9._-]", "_")
    return F.when(clean.endswith(".json") | clean.endswith(".jsonl"), clean).otherwise(F.concat(clean, F.lit(".jsonl")))


def outcome(name: Column) -> Column:
    """Up and down as YES and NO, all else upper-cased."""
    upper = F.upper(F.trim(name))
    return F.when(upper == "UP", "YES").when(upper == "DOWN", "NO").otherwise(upper)


def symbol_in(*texts: Column) -> Column:
    """The first symbol that any text names as a whole word; null if none does."""
    words = F.split(F.lower(F.concat_ws(" ", *texts)), "[^0-9A-Za-z]")
    out = None
    for symbol, names in SYMBOL_WORDS:
        named = F.arrays_overlap(words, F.array(*[F.lit(n) for n in names]))
        out = F.when(named, symbol) if out is None else out.when(named, symbol)
    return out


def hour_bucket(ts_ns: Column) -> Column:
    """Whole hours since the epoch, truncated towards zero. Exact: no division of doubles."""
    hour = F.lit(3_600_000_000_000)
    return F.call_function("div", ts_ns, hour)


def window_floor(seconds: Column, width: int = 300) -> Column:
    """The start of the ``width``-second window that holds a time."""
    return seconds - F.pmod(seconds, F.lit(width))
