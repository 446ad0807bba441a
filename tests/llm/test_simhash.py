import re

import numpy as np
import pytest
import xxhash

from ripplebook.llm import gray_index, simhash
from ripplebook.llm.common import Scratch
from ripplebook.llm.components import connected_components
from tests.llm.util import awkward, empty, prose


def fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    ws = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not ws:
        return 0
    grams = [" ".join(ws[i : i + 4]) for i in range(max(1, len(ws) - 3))]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def classes(items, linked):
    """Smallest member of each item's class under a relation, by brute force."""
    up = list(range(len(items)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(items)):
        for j in range(i):
            if linked(items[i], items[j]):
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(items))]


def texts():
    out = []
    for g in range(12):
        words = prose(g, 150).split()
        for k in range(6):
            w = list(words)
            w[10 * k % 150] = f"new{k}"
            out.append((100 + 10 * g + k, " ".join(w)))
    return out


@pytest.mark.parametrize("cap", [1 << 17, 4])
def test_classes_against_brute_force(spark, cap):
    df = awkward(spark, texts())
    rows = [(r.doc_id, r.text) for r in df.collect()]
    got = simhash.near_duplicate_classes(df, cap=cap).collect()
    fps = [fingerprint(t) for _, t in rows]
    root = classes(fps, lambda a, b: (a ^ b).bit_count() <= 4)
    least = {}
    for (i, _), r in zip(rows, root, strict=True):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    want = [(i, f"{f:016x}", least.get(r)) for (i, _), f, r in zip(rows, fps, root, strict=True)]
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.fingerprint, r.component_id)) for r in got)
    assert simhash.near_duplicate_classes(empty(spark)).count() == 0


@pytest.mark.parametrize("seed", range(12))
def test_index_against_brute_force(seed):
    rng = np.random.default_rng(seed)
    W, n = int(rng.choice([1, 4])), int(rng.integers(2, 150))
    centres = rng.integers(0, 2**63, (int(rng.integers(1, 20)), W), dtype=np.uint64)
    fp = centres[rng.integers(0, len(centres), n)].copy()
    for i in range(n):
        for _ in range(int(rng.integers(0, 7))):
            fp[i, rng.integers(0, W)] ^= np.uint64(1) << np.uint64(rng.integers(0, 64))
    group = rng.integers(0, 3, n)
    items = [(g, [int(x) for x in f]) for g, f in zip(group, fp, strict=True)]
    want = classes(items, lambda a, b: a[0] == b[0] and sum((x ^ y).bit_count() for x, y in zip(a[1], b[1], strict=True)) <= 4)
    got = gray_index.link(group, fp, 4).tolist()
    pairs = set(zip(want, got, strict=True))
    assert len(pairs) == len(set(want)) == len(set(got))


def test_gray_rank_orders_neighbours():
    ranks = np.arange(64, dtype=np.uint64)
    codes = ranks ^ (ranks >> np.uint64(1))
    assert gray_index.gray_rank(codes[:, None])[:, 0].tolist() == ranks.tolist()


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = np.random.default_rng(seed)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 120, (90, 2))] + [(i, i + 1) for i in range(200, 260)] + [(300, i) for i in range(301, 340)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint"), Scratch(spark, "t")).collect()}
    near = {frozenset(e) for e in edges}
    nodes = sorted({x for e in edges for x in e if e[0] != e[1]})
    want = classes(nodes, lambda a, b: frozenset((a, b)) in near)
    assert got == {n: nodes[w] for n, w in zip(nodes, want, strict=True)}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint"), Scratch(spark, "t")).count() == 0


def test_components_of_long_chains(spark):
    """Chains in order, interleaved (every other node a local minimum) and shuffled."""
    n = 3000
    line = [(i, i + 1) for i in range(n)]
    mixed = [(10_000 + (i // 2 if i % 2 else n + i // 2), 10_000 + ((i + 1) // 2 if i % 2 == 0 else n + (i + 1) // 2)) for i in range(n)]
    order = (20_000 + np.random.default_rng(5).permutation(n)).tolist()
    edges = [*line, *mixed, *zip(order, order[1:], strict=False)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint"), Scratch(spark, "t")).collect()}
    low = min(x for e in mixed for x in e)
    assert got == {x: r for es, r in ((line, 0), (mixed, low), (edges[2 * n :], 20_000)) for e in es for x in e}


def test_one_of_each_stays(spark):
    df = awkward(spark, texts())
    kept = simhash.keep_one_of_each(df)
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == df.columns
    assert {i for i in ids if i is not None and i >= 100} == {100 + 10 * g for g in range(12)}
    assert sum(i in (1, 2, 3) for i in ids) == 1 and sum(i in (4, 5) for i in ids) == 1 and {6, 8, 9, None} <= set(ids)
    assert simhash.keep_one_of_each(empty(spark)).count() == 0


@pytest.mark.parametrize("block", [512, 8])
def test_similarity_is_exact_at_the_threshold(spark, monkeypatch, block):
    """Pairs of 200 shingles that share 178 (0.802) or 177 (0.794), and classes of a common base: against brute force."""
    monkeypatch.setattr(simhash, "BLOCK", block)
    rows = []
    for k in range(80):
        words = prose(1000 + k, 204).split()
        keep = 178 + 4 if k % 2 else 177 + 4
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(words[:keep] + [f"tail{k}n{i}" for i in range(204 - keep)]))]
    base = prose(5000, 204).split()
    for k in range(40):
        cut = [*base]
        cut[(k * 37) % 200] = f"one{k}"
        cut[(k * 61 + 9) % 200] = f"two{k}"
        rows.append((1000 + k, " ".join(cut)))
    sets = [{" ".join(t.lower().split()[i : i + 5]) for i in range(200)} for _, t in rows]
    root = classes(sets, lambda a, b: len(a & b) >= 0.8 * len(a | b))
    got = simhash.keep_one_of_each(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted(r.doc_id for r in got.collect()) == sorted({rows[r][0] for r in root})


def shingles(text):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_filter_against_exact_similarity_of_all_documents(spark):
    """Of 1,000 documents: classes of those linked at 0.8 or more, by an inverted index; one of each class stays and no other goes."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    sets = {r.doc_id: shingles(r.text) for r in docs.collect()}
    at = {}
    for i, s in sets.items():
        for x in s:
            at.setdefault(x, []).append(i)
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, s in sets.items():
        both = {}
        for x in s:
            for j in at[x]:
                if j < i:
                    both[j] = both.get(j, 0) + 1
        for j, n in both.items():
            if n >= 0.8 * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    blank = min((i for i, s in sets.items() if not s), default=None)
    want = {find(i) for i, s in sets.items() if s} | ({blank} if blank is not None else set())
    kept = {r.doc_id for r in simhash.keep_one_of_each(docs).select("doc_id").collect()}
    assert len(want) < len(sets) and len(kept - want) <= 0.05 * (len(sets) - len(want)) and want <= kept


def test_pairs_compared_a_document_do_not_grow_with_the_corpus():
    """Unlike documents with near copies of a few: pairs that share a key of a band, a document, over three sizes."""
    rng = np.random.default_rng(8)
    shares = []
    for n in (500, 2000, 8000):
        keys = []
        for k in range(n):
            own = rng.integers(0, 2**63, 40, dtype=np.uint64)
            keys.append(simhash.band_keys(own))
            if k % 20 == 0:
                keys.append(simhash.band_keys(np.r_[own[:38], rng.integers(0, 2**63, 2, dtype=np.uint64)]))
        pairs = 0
        for band in np.array(keys).T:
            _, counts = np.unique(band, return_counts=True)
            pairs += int((counts * (counts - 1) // 2).sum())
        shares.append(pairs / len(keys))
    assert max(shares) < 1.2 * min(shares)
