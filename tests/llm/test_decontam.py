import numpy as np
import pytest

from ripplebook.llm import decontam as d
from tests.llm.util import awkward, empty, prose

ITEM = "Which of these seven ancient harbours was first rebuilt in stone after the great flood of that long winter?"


def bench(spark):
    rows = [(1, ITEM), (1, ITEM), (2, prose(999, 40)), (3, None), (4, ""), (5, "too short"), (None, "null id " * 20)]
    return spark.createDataFrame([(*r, "x") for r in rows], "item_id bigint, text string, row string")


def changed(text, *places):
    words = text.split()
    for p in places:
        words[p] = "changed"
    return " ".join(words)


def planted():
    wrap = lambda k, t: f"{prose(400 + k, 60)} {t} {prose(500 + k, 60)}"
    return [(200, wrap(0, ITEM)), (201, wrap(1, ITEM.upper().replace(" ", "\n"))), (202, wrap(2, changed(ITEM, 4, 11))), (203, wrap(3, changed(ITEM, 2, 8, 15))), (204, ITEM)] + [(300 + k, prose(600 + k, 200)) for k in range(20)]


def test_planted_items_are_found(spark):
    rows = d.overlaps(awkward(spark, planted()), bench(spark)).collect()
    assert sorted((r.doc_id, r.item_id) for r in rows) == [(200 + k, 1) for k in range(5)]
    n = len(ITEM.split())
    exact = next(r for r in rows if r.doc_id == 200)
    assert exact.matches == exact.n_item == n and exact.end - exact.start == n
    assert d.overlaps(empty(spark), bench(spark)).count() == 0
    assert d.overlaps(awkward(spark, planted()), bench(spark).filter("false")).count() == 0


def test_clean(spark):
    df = awkward(spark, planted())
    out = d.clean(df, bench(spark))
    assert out.columns == df.columns
    ids = [r.doc_id for r in out.collect()]
    assert len(ids) == df.count() - 5 and not any(i is not None and 200 <= i < 210 for i in ids)


def test_seeds_against_a_slow_form():
    t = d.token_hashes("one two three four five six seven eight nine ten eleven twelve")
    where, what = d.seed_hashes(t)
    assert len(where) == sum(len(t) - m[-1] for m in d.MASKS)
    t2 = t.copy()
    t2[4] = 17  # a place that the third mask ignores at position 0
    same = what == d.seed_hashes(t2)[1]
    third = np.flatnonzero(where == 0)[2]
    assert 4 not in d.MASKS[2] and same[third] and not same[np.flatnonzero(where == 0)[0]]


def test_extend():
    doc, item = np.array([9, 1, 2, 3, 8, 5, 6, 7, 0]), np.array([1, 2, 3, 4, 5, 6, 7])
    assert d.extend(doc, item, 1, 2) == (1, 8, 6)
    assert d.extend(doc, item, 1, 5) == (1, 8, 6)


def test_overlap_between_two_fragments_is_found(spark):
    item = prose(4000, 56)
    gaps = [*range(8, 15), *range(41, 48)]
    df = awkward(spark, [(200, f"{prose(4001, 60)} {changed(item, *gaps)} {prose(4002, 60)}")])
    bench = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    (r,) = d.overlaps(df, bench).collect()
    assert (r.doc_id, r.start, r.end, r.matches) == (200, 75, 101, 26)
    assert 200 not in {x.doc_id for x in d.clean(df, bench).collect()}


@pytest.mark.parametrize("seed", range(30))
def test_segments_against_brute_force(seed):
    """The overlap given is the best of all segments of the extensions around the hits."""
    rng = np.random.default_rng(seed)
    item = np.arange(1, 61)
    doc = np.where(rng.random(60) < rng.choice([0.5, 0.7, 0.8]), item, 0)
    hits = np.flatnonzero(doc == item).tolist()
    ranges = [d.extend(doc, item, 0, h)[:2] for h in hits]
    same = (doc == item).astype(int)
    want = max((same[i:j].sum() for a, b in ranges for i in range(a, b) for j in range(i + 1, b + 1) if same[i:j].mean() >= 0.75), default=0)
    got = d.best_segment(doc, item, 0, hits, 10, 0.75)
    assert (got[2] if got else 0) == (want if want >= 10 else 0)
    assert got is None or (same[got[0] : got[1]].sum() == got[2] and got[2] >= 0.75 * (got[1] - got[0]))


def test_a_core_that_passes_is_not_lost_by_its_extension():
    flags = np.array([1] * 10 + [0, 0, 1, 1, 1, 1, 1] * 12 + [0] * 14)
    item = np.arange(1, len(flags) + 1)
    doc = np.where(flags == 1, item, 0)
    start, end, same = d.extend(doc, item, 0, 0)
    assert same == 70 < 0.75 * (end - start)
    start, end, same = d.best_segment(doc, item, 0, [0], 10, 0.75)
    assert start == 0 and same >= 60 and same >= 0.75 * (end - start)


def test_items_without_id_and_short_items_are_found(spark):
    item = prose(4100, 30)
    df = awkward(spark, [(200, f"{prose(4101, 60)} {item} {prose(4102, 60)}"), (201, f"{prose(4103, 60)} Quintessential zebra, maps! {prose(4104, 60)}"), (202, f"{prose(4105, 60)} zebra maps {prose(4106, 60)}")])
    bench = spark.createDataFrame([(None, item), (None, "xylophone " * 9), (7, "quintessential zebra maps")], "item_id bigint, text string")
    got = d.overlaps(df, bench).collect()
    assert sorted((r.doc_id, r.item_id or 0, r.matches, r.n_item) for r in got) == [(200, 0, 30, 30), (201, 7, 3, 3)]
    assert {200, 201, 202} & {x.doc_id for x in d.clean(df, bench).collect()} == {202}


def best_of_all(doc, item, need):
    """Whether any segment of any diagonal has ``need`` equal tokens and three in four equal (tokens of no diagonal with so many are passed over)."""
    at = {}
    for p, t in enumerate(item.tolist()):
        at.setdefault(t, []).append(p)
    diagonals = {}
    for q, t in enumerate(doc.tolist()):
        for p in at.get(t, ()):
            diagonals.setdefault(q - p, []).append(p)
    for places in diagonals.values():
        for a in range(len(places)):
            for z in range(a + need - 1, len(places)):
                if 4 * (z - a + 1) >= 3 * (places[z] - places[a] + 1):
                    return True
    return False


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_overlaps_against_all_diagonals(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/sf{sf}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"/root/testdata/sf{sf}/benchmark.parquet")
    got = d.overlaps(docs, items).collect()
    found = {(r.doc_id, r.item_id) for r in got}
    tokens = {r.doc_id: d.token_hashes(r.text) for r in docs.collect()}
    want = {(i, r.item_id) for r in items.collect() for item in [d.token_hashes(r.text)] for i, doc in tokens.items() if best_of_all(doc, item, min(10, max(1, len(item) - 2)))}
    assert found <= want and len(got) == len(found)
    print(len(want), len(found))
    assert len(found) >= 0.99 * len(want) > 0
    assert {i for i, _ in found} == {i for i, _ in want}


def test_the_filter_grows_with_the_benchmark_and_loses_no_seed(spark):
    assert d.filter_bits(0) == d.filter_bits(1000) == d.LEAST_BITS and d.filter_bits(10**6) == 1 << 26 and d.filter_bits(10**12) == d.MOST_BITS
    seeds = np.random.default_rng(3).integers(-(2**63), 2**63, 3000)
    bits = d._bloom(spark.createDataFrame([(int(x),) for x in seeds], "seed bigint"))
    assert len(d._may_hold(bits, seeds)) == 3000
    assert len(d._may_hold(bits, np.random.default_rng(4).integers(-(2**63), 2**63, 200_000))) < 3


def test_a_hit_between_the_outer_ones_is_verified(spark):
    """Equal at tokens 0-6, 20-34 and 53-59 of 60: neither rim is an overlap, the middle is."""
    item = prose(4200, 60)
    df = awkward(spark, [(200, f"{prose(4201, 60)} {changed(item, *range(7, 20), *range(35, 53))} {prose(4202, 60)}")])
    (r,) = d.overlaps(df, spark.createDataFrame([(1, item)], "item_id bigint, text string")).collect()
    assert (r.doc_id, r.end - r.start, r.matches) == (200, 15, 15)
