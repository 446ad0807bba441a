"""Expression tables."""

import pytest
from pyspark.sql import functions as F

from ripplebook.functions import book, json_fields, text

LEVELS = "array<struct<price:double,size:double>>"


def one(spark, column, **values):
    kinds = ", ".join(f"{k} {LEVELS if isinstance(v, list) else 'double' if isinstance(v, float) else 'bigint' if isinstance(v, int) else 'string'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], kinds).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("levels", "q", "want"),
    [
        ([(0.6, 3.0), (0.625, 4.0)], 5, 3.05), ([(0.625, 4.0), (0.6, 3.0)], 5, 3.05), ([(0.6, 3.0)], 5, None), ([], 5, None), ([(0.6, 3.0)], 0, 0.0),
        ([(0.5, 0.0), (0.6, -1.0), (0.7, 5.0)], 5, 3.5),
    ],
)
def test_fill(spark, levels, q, want):
    assert one(spark, book.cost_to_buy(F.col("v"), q), v=levels) == (pytest.approx(want) if want else want)


def test_sides(spark):
    v = [(0.5, 1.0), (0.4, 0.0), (0.6, -2.0)]
    assert (one(spark, book.best_bid(F.col("v")), v=v), one(spark, book.best_ask(F.col("v")), v=v), one(spark, book.depth(F.col("v")), v=v)) == (0.6, 0.4, -1.0)
    assert one(spark, book.best_bid(F.col("v")), v=[]) is None and one(spark, book.depth(F.col("v")), v=[]) == 0.0
    assert [tuple(x) for x in one(spark, book.top_levels(F.col("v"), 2, False), v=v)] == [(0.6, -2.0), (0.5, 1.0)]


def test_text(spark):
    assert [one(spark, text.outcome(F.col("v")), v=v) for v in (" up", "Down ", "maybe")] == ["YES", "NO", "MAYBE"]
    assert [one(spark, text.symbol_in(F.col("v")), v=v) for v in ("Bitcoin?", "some-eth-5m", "solid", "sol/usd")] == ["BTC", "ETH", None, "SOL"]
    assert [one(spark, text.safe_name(F.col("v")), v=v) for v in ("a b", "x/y.json", "k.jsonl")] == ["a_b.jsonl", "x_y.json", "k.jsonl"]
    assert [one(spark, text.hour_bucket(F.col("v")), v=v) for v in (3_599_999_999_999, 3_600_000_000_000, -1)] == [0, 1, 0]
    assert one(spark, text.window_floor(F.col("v")), v=1234) == 1200


def test_json_fields(spark):
    v = F.parse_json("v")
    t = '{"s":"x","n":12,"f":1.5,"b":true,"bt":"false","bad":"yes","o":{},"num":"2.5","arr":["a",1],"js":"[\\"p\\",\\"q\\"]","ms":1700000000000,"ns":1700000000000000000,"iso":"2024-01-01T00:00:00Z","blank":" ","day":"2024-01-01"}'
    ask = lambda c: one(spark, c, v=t)
    assert [ask(json_fields.string_field(v, n)) for n in ("s", "n", "b", "o", "none")] == ["x", "12", None, None, None]
    assert ask(json_fields.string_field(v, "o", "s")) == "x"
    assert [ask(json_fields.bool_field(v, n)) for n in ("b", "bt", "bad", "n")] == [True, False, None, None]
    assert [ask(json_fields.number_field(v, n)) for n in ("n", "num", "s", "b")] == [12.0, 2.5, None, None]
    assert ask(json_fields.string_array(json_fields.field(v, "arr"))) == ["a"]
    assert ask(json_fields.string_array(json_fields.field(v, "js"))) == ["p", "q"]
    assert ask(json_fields.string_array(json_fields.field(v, "none"))) == []
    assert ask(json_fields.timestamp_ms(v, "blank", "ms")) == ask(json_fields.timestamp_ms(v, "ns")) == 1_700_000_000_000
    assert ask(json_fields.timestamp_ms(v, "iso")) == 1_704_067_200_000
    with pytest.raises(Exception, match="not a timestamp"):
        ask(json_fields.timestamp_ms(v, "day"))
