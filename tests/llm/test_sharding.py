import zlib
from collections import Counter

import pytest

from ripplebook.llm import sharding
from tests.llm.util import awkward, empty, prose


def check(rows, n, shards=16):
    by = Counter(r.shard for r in rows)
    assert len(rows) == n and max(by.values()) - min([by[s] for s in range(shards)]) <= 1
    for s in range(shards):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(by[s]))


def test_laws_on_awkward_rows(spark):
    df = awkward(spark)
    rows = sharding.shard_documents(df).collect()
    check(rows, df.count())
    for r in rows:
        if r.doc_id == 8:
            assert (r.size, r.text_crc32) == (3, zlib.crc32("é".encode()))
        if r.doc_id in (1, 2):
            assert (r.size, r.text_crc32) == (1, 0)
    assert sharding.shard_documents(empty(spark)).count() == 0


@pytest.mark.parametrize("hot", [0, 400])
def test_groups_stay_whole_where_they_fit(spark, hot):
    texts = [(i, prose(i, 5)) for i in range(600)] + [(1000 + i, f"pair {i // 3}") for i in range(240)] + [(5000 + i, "hot") for i in range(hot)]
    df = spark.createDataFrame(texts, "doc_id bigint, text string")
    out = sharding.shard_documents(df)
    rows = out.collect()
    check(rows, len(texts))
    spread = {}
    for r in rows:
        spread.setdefault(bytes(r.hub), set()).add(r.shard)
    cut = sharding.cut_edges(out).first()
    quota = len(texts) / 16
    assert cut.linked == 240 - 80 + max(0, hot - 1) and cut.kept + cut.cut == cut.linked
    if hot:  # a group larger than a shard takes few more shards than it must
        assert max(map(len, spread.values())) <= hot / quota + 3
    assert cut.cut <= 0.1 * cut.linked


def test_same_result_again(spark):
    df = awkward(spark)
    key = lambda: sorted(map(str, sharding.shard_documents(df).collect()))
    assert key() == key()


def test_other_partitions_give_the_same_shards(spark):
    texts = [(i, prose(i, 5)) for i in range(500)] + [(1000 + i, f"pair {i // 3}") for i in range(240)] + [(None, None), (7000, "")]
    df = spark.createDataFrame(texts, "doc_id bigint, text string")
    shards = lambda n: sorted(map(str, sharding.shard_documents(df.repartition(n)).collect()))
    assert shards(1) == shards(7)


def test_a_row_repeated_over_and_over_is_spread(spark):
    rows = [(1, "same")] * 300 + [(i, prose(i, 5)) for i in range(2, 400)]
    check(sharding.shard_documents(spark.createDataFrame(rows, "doc_id bigint, text string")).collect(), len(rows))
