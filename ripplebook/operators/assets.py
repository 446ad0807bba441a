"""Asset lists: distinct unions that keep an order, pruning, limits, and YES/NO rows of markets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _one_of_each(df: DataFrame, key: str, order: list[str], pick) -> DataFrame:
    """``pick`` over the order, combined before the shuffle, so a hot key is a row a task."""
    rest = [c for c in df.columns if c != key]
    by = F.struct(*order) if len(order) > 1 else F.col(order[0])
    top = df.groupBy(key).agg(pick(F.struct(*rest), by).alias("r"))
    return top.select(key, "r.*").select(*df.columns)


def first_wins(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row of each key in the order given."""
    return _one_of_each(df, key, order, F.min_by)


def last_wins(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last row of each key in the order given."""
    return _one_of_each(df, key, order, F.max_by)


def merge(first: DataFrame, second: DataFrame, key: str, order: str) -> DataFrame:
    """Rows of both, ``first`` before ``second``, the first of each key kept."""
    both = first.withColumn("__src", F.lit(0)).unionByName(second.withColumn("__src", F.lit(1)))
    return first_wins(both, key, ["__src", order]).orderBy("__src", order).drop("__src")


def prune(assets: DataFrame, failed: DataFrame, key: str) -> DataFrame:
    """Assets whose key is not among the failed."""
    return assets.join(failed.select(key).distinct(), key, "left_anti")


def take(assets: DataFrame, order: str, n: int) -> DataFrame:
    return assets.orderBy(order).limit(n)


def yes_no_rows(markets: DataFrame) -> DataFrame:
    """A YES and a NO row of each market (symbol, condition_id, yes_asset_id, no_asset_id)."""
    return markets.select("symbol", "condition_id", F.expr("stack(2, 'YES', yes_asset_id, 'NO', no_asset_id) as (outcome, asset_id)"))


def zip_outcomes(markets: DataFrame, names: str, tokens: str) -> DataFrame:
    """A row a token (``pos``, ``token``, ``outcome``) beside the other columns: the name at its place, or else ``outcome-<place>``.

    Names without a token are left out.
    """
    rest = [c for c in markets.columns if c not in (names, tokens)]
    each = markets.select(*rest, F.col(names).alias("__names"), F.posexplode(tokens).alias("pos", "token"))
    outcome = F.coalesce(F.get("__names", F.col("pos")), F.concat(F.lit("outcome-"), F.col("pos").cast("string")))
    return each.select(*rest, "pos", "token", outcome.alias("outcome"))
