"""Order-book arithmetic on arrays of (price, size) levels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A fill counts as done when less than this is left (the spacing of doubles at 1).
EPSILON = 2.220446049250313e-16


def prices(levels: Column) -> Column:
    return F.transform(levels, lambda x: x["price"])


def best_bid(bids: Column) -> Column:
    """Highest price; null for an empty side."""
    return F.array_max(prices(bids))


def best_ask(asks: Column) -> Column:
    """Lowest price; null for an empty side."""
    return F.array_min(prices(asks))


def depth(levels: Column) -> Column:
    """Sum of sizes in array order, zero and negative ones included; 0.0 for an empty side."""
    return F.aggregate(F.transform(levels, lambda x: x["size"]), F.lit(0.0), lambda s, x: s + x)


def spread(bid: Column, ask: Column) -> Column:
    return ask - bid


def valid_levels(levels: Column) -> Column:
    """Levels of finite price and finite, positive size."""
    finite = lambda v: ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    return F.filter(levels, lambda x: finite(x["price"]) & finite(x["size"]) & (x["size"] > 0))


def _compare(a: Column, b: Column) -> Column:
    """Order of two prices, where a NaN equals anything."""
    return F.when(F.isnan(a) | F.isnan(b), 0).when(a < b, -1).when(a > b, 1).otherwise(0)


def sorted_levels(levels: Column, ascending: bool) -> Column:
    """By price; levels of one price keep their order (the position breaks ties)."""
    placed = F.transform(levels, lambda x, i: F.struct(x["price"].alias("price"), x["size"].alias("size"), i.alias("i")))

    def order(a: Column, b: Column) -> Column:
        by_price = _compare(a["price"], b["price"]) * (1 if ascending else -1)
        return F.when(by_price != 0, by_price).otherwise(F.when(a["i"] < b["i"], -1).when(a["i"] > b["i"], 1).otherwise(0))

    return F.transform(F.array_sort(placed, order), lambda x: F.struct(x["price"].alias("price"), x["size"].alias("size")))


def top_levels(levels: Column, n: int, ascending: bool) -> Column:
    """The best ``n`` levels of a side."""
    return F.slice(sorted_levels(levels, ascending), 1, n)


def fill_cost(levels: Column, quantity: float) -> Column:
    """Cost of filling ``quantity`` from levels that are best first; null where they do not suffice.

    Levels of no size are passed over. A quantity of zero or less costs 0.
    """
    if quantity <= 0:
        return F.lit(0.0)
    start = F.struct(F.lit(float(quantity)).alias("left"), F.lit(0.0).alias("cost"), F.lit(False).alias("done"))

    def step(acc: Column, x: Column) -> Column:
        take = F.least(acc["left"], x["size"])
        left, cost = acc["left"] - take, acc["cost"] + take * x["price"]
        skip = acc["done"] | (x["size"] <= 0)
        return F.when(skip, acc).otherwise(F.struct(left.alias("left"), cost.alias("cost"), (left <= EPSILON).alias("done")))

    return F.aggregate(levels, start, step, lambda acc: F.when(acc["done"], acc["cost"]))


def cost_to_buy(asks: Column, quantity: float) -> Column:
    return fill_cost(sorted_levels(asks, True), quantity)


def proceeds_to_sell(bids: Column, quantity: float) -> Column:
    return fill_cost(sorted_levels(bids, False), quantity)
