"""Hamming links through a Gray-order hierarchical index.

Fingerprints (``W`` 64-bit words) are sorted by Gray rank, so neighbours in the order share most bits.
Runs of ``FAN`` rows form leaves and runs of ``FAN`` nodes form upper nodes; a node keeps the bits on
which all rows below agree (mask and pattern), factored out of its children. Searching pairs of nodes
from the top, the differences on jointly fixed bits accumulate; a pair of whole groups is dropped as
soon as they exceed the radius. Pairs whose rows are all linked to each other already are dropped too:
only connectivity is asked for, so a dense group of near copies costs far less than all its pairs, and
it leaves as a star of (row, root) links.

Distribution: each row is routed under several masked bit patterns (``routes``). Rows of one pattern
meet in one partition, stream in sorted by pattern and are linked in bounded buffers. A pattern with
more than ``cap`` rows is set aside and finished exactly in pairs of blocks, each pair its own task.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripplebook.llm.common import Scratch

FAN = 8
#: Pairs of nodes that are expanded at a time (each gives FAN * FAN at most).
STEP = 1 << 14


def gray_rank(fp: np.ndarray) -> np.ndarray:
    """Rank of each row of an (n, W) uint64 array in Gray order, as (n, W) words, high word first."""
    out = fp.copy()
    for s in (1, 2, 4, 8, 16, 32):
        out ^= out >> np.uint64(s)
    odd = np.zeros(len(fp), bool)
    for w in range(fp.shape[1]):
        low = (out[:, w] & np.uint64(1)).astype(bool)  # parity of the word's own bits
        out[odd, w] = ~out[odd, w]
        odd ^= low
    return out


def _count(bits: np.ndarray) -> np.ndarray:
    return np.bitwise_count(bits).sum(axis=1, dtype=np.int32)


def _union(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merges the classes of a[i] and b[i]; ``labels`` keeps each class's smallest member."""
    while len(a):
        x, y = labels[a], labels[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        if not len(a):
            return
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = labels[labels]
            if np.array_equal(up, labels):
                break
            labels[:] = up


def _levels(group: np.ndarray, fp: np.ndarray):
    """Per level: first child of each node (with an end mark), its group, mask and pattern."""
    low = high = fp
    levels = []
    while True:
        n = len(group)
        new = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        rank = np.arange(n) - np.repeat(new, np.diff(np.r_[new, n]))
        starts = np.flatnonzero(rank % FAN == 0)
        low, high = np.bitwise_and.reduceat(low, starts), np.bitwise_or.reduceat(high, starts)
        group = group[starts]
        mask = ~(low ^ high)
        levels.append((np.r_[starts, n], group, mask, low & mask))
        if len(np.unique(group)) == len(group):
            return levels


def _cross(a0, a1, b0, b1, same):
    """All (i, j) of a0..a1 and b0..b1 of each pair of nodes; i < j where the two are one. With the pair's number."""
    na, nb = a1 - a0, b1 - b0
    total = na * nb
    pair = np.repeat(np.arange(len(a0)), total)
    k = np.arange(len(pair)) - np.repeat(np.cumsum(total) - total, total)
    i, j = a0[pair] + k // nb[pair], b0[pair] + k % nb[pair]
    return pair, i, j, same[pair]


def link(group: np.ndarray, fp: np.ndarray, radius: int) -> np.ndarray:
    """Class of each row: rows of one ``group`` link where they differ in ``radius`` bits at most.

    Returns for each row the number of the class's representative row.
    """
    n = len(group)
    result = np.arange(n)
    if n < 2:
        return result
    ranks = gray_rank(fp)
    order = np.lexsort((*ranks.T[::-1], group))
    group, fp = group[order], np.ascontiguousarray(fp[order])
    labels = np.arange(n)
    near = np.flatnonzero((group[1:] == group[:-1]) & (_count(fp[1:] ^ fp[:-1]) <= radius))
    _union(labels, near, near + 1)
    levels = _levels(group, fp)
    top = len(levels) - 1

    def pure() -> list[np.ndarray]:
        """Per level, a node's class if all its rows are of one, else -1."""
        lo, hi, out = labels, labels, []
        for starts, *_ in levels:
            lo, hi = np.minimum.reduceat(lo, starts[:-1]), np.maximum.reduceat(hi, starts[:-1])
            out.append(np.where(lo == hi, lo, -1))
        return out

    classes = pure()
    roots = np.arange(len(levels[top][1]))
    zeros = np.zeros((len(roots), fp.shape[1]), np.uint64)
    # (level, nodes a, nodes b, differences so far, bits they were counted on)
    stack = [(top, roots, roots, _count(zeros), levels[top][2])]
    while stack:
        level, a, b, so_far, seen = stack.pop()
        if len(a) > STEP:
            stack.append((level, a[STEP:], b[STEP:], so_far[STEP:], seen[STEP:]))
            a, b, so_far, seen = a[:STEP], b[:STEP], so_far[:STEP], seen[:STEP]
        ca, cb = classes[level][a], classes[level][b]
        open_ = ~((ca == cb) & (ca >= 0))
        a, b, so_far, seen = a[open_], b[open_], so_far[open_], seen[open_]
        if not len(a):
            continue
        starts = levels[level][0]
        pair, i, j, same = _cross(starts[a], starts[a + 1], starts[b], starts[b + 1], a == b)
        if level == 0:
            good = ~same | (i < j)
            i, j = i[good], j[good]
            good = labels[i] != labels[j]
            i, j = i[good], j[good]
            good = _count(fp[i] ^ fp[j]) <= radius
            if good.any():
                _union(labels, i[good], j[good])
                classes = pure()
            continue
        good = ~same | (i <= j)
        pair, i, j = pair[good], i[good], j[good]
        _, _, masks, patterns = levels[level - 1]
        both = masks[i] & masks[j]
        diff = so_far[pair] + _count((patterns[i] ^ patterns[j]) & both & ~seen[pair])
        good = diff <= radius
        i, j, diff, both = i[good], j[good], diff[good], both[good]
        by = np.argsort(diff, kind="stable")  # the nearest first: what they link prunes the rest
        stack.append((level - 1, i[by], j[by], diff[by], both[by]))
    # the smallest sorted position represents a class
    result[order] = order[labels]
    return result


def pigeonhole_masks(bits: int, radius: int, blocks: int) -> list[int]:
    """Masks of ``blocks - radius`` of the ``blocks`` runs of bits: fingerprints within ``radius`` agree on one mask at least."""
    edges = [bits * k // blocks for k in range(blocks + 1)]
    runs = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(pick) for pick in combinations(runs, blocks - radius)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def masked_routes(words: list[str], masks: list[int]) -> DataFrame:
    """Column with one (route, key words) per mask: the fingerprint's bits under the mask. Native."""
    W = len(words)
    parts = []
    for r, m in enumerate(masks):
        keys = [F.col(w).bitwiseAND(F.lit(_signed((m >> (64 * (W - 1 - k))) & (2**64 - 1))).cast("bigint")) for k, w in enumerate(words)]
        key = keys[0] if W == 1 else F.xxhash64(*keys)
        parts.append(F.struct(F.lit(r).alias("route"), key.alias("key")))
    return F.explode(F.array(*parts))


def _linked(batches: Iterator[pa.RecordBatch], words: int, radius: int, cap: int, keys: int, buffer_rows: int):
    """Streams rows sorted by their key columns; yields star links and, of groups over ``cap``, the rows.

    Columns in: ``keys`` key columns, vid, words. Out: a, b (a link; b is null for a set-aside row),
    block, route, key.
    """
    names = ["a", "b", "block", "route", "key"]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64()]

    def emit(cols):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)

    def finish(rows: np.ndarray):
        """rows: whole groups, as int64 columns keys, vid, words."""
        if len(rows) < 2:
            return
        new = np.r_[True, (rows[1:, :keys] != rows[:-1, :keys]).any(axis=1)]
        group = np.cumsum(new) - 1
        several = np.bincount(group)[group] > 1
        if not several.any():
            return
        rows, group = rows[several], group[several]
        vid, fp = rows[:, keys], np.ascontiguousarray(rows[:, keys + 1 :]).view(np.uint64)
        rep = link(group, fp, radius)
        linked = np.flatnonzero(rep != np.arange(len(rep)))
        if len(linked):
            none = pa.nulls(len(linked), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(vid[linked]), pa.array(vid[rep[linked]]), none, none, pa.nulls(len(linked), pa.int64())], names=names
            )

    held: list[np.ndarray] = []
    size = 0
    over: np.ndarray | None = None  # key of the group that is being set aside
    done = 0

    def aside(rows: np.ndarray):
        nonlocal done
        block = (done + np.arange(len(rows))) // max(1, cap // 2)
        done += len(rows)
        none = pa.nulls(len(rows), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows[:, keys]), none, pa.array(block.astype(np.int32)), pa.array(rows[:, 0].astype(np.int32)), pa.array(rows[:, 1])], names=names
        )

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns])
        if over is not None:
            goes_on = (rows[:, :keys] == over).all(axis=1)
            if goes_on.any():
                yield from aside(rows[goes_on])
                rows = rows[~goes_on]
            if not len(rows):
                continue
            over = None
        held.append(rows)
        size += len(rows)
        if size < buffer_rows:
            continue
        rows = np.concatenate(held)
        last = (rows[:, :keys] == rows[-1, :keys]).all(axis=1)
        yield from finish(rows[~last])
        rows = rows[last]
        if len(rows) > cap:
            over, done, held, size = rows[-1, :keys].copy(), 0, [], 0
            yield from aside(rows)
        else:
            held, size = [rows], len(rows)
    if held:
        rows = np.concatenate(held)
        last = (rows[:, :keys] == rows[-1, :keys]).all(axis=1)
        yield from finish(rows[~last])
        if last.sum() > cap:
            over, done = rows[-1, :keys].copy(), 0
            yield from aside(rows[last])
        else:
            yield from finish(rows[last])


def hamming_links(
    points: DataFrame,
    words: list[str],
    radius: int,
    routes,
    scratch: Scratch,
    *,
    cap: int = 1 << 17,
) -> DataFrame:
    """(a, b): links between ``vid`` values of ``points`` that join all rows within ``radius`` bits.

    ``points`` has distinct fingerprints: vid (bigint) and the ``words`` columns (bigint), high word
    first. ``routes`` explodes a row to its structs (route, key). Two rows within the radius that
    share a route are connected by the links given; links never join rows that are not connected.
    """
    W = len(words)
    out = "a bigint, b bigint, block int, route int, key bigint"
    routed = points.select("vid", *words, routes.alias("r")).select("r.route", "r.key", "vid", *words)
    sorted_ = routed.repartition("route", "key").sortWithinPartitions("route", "key")
    found = sorted_.mapInArrow(lambda it: _linked(it, W, radius, cap, 2, max(cap + 1, 1 << 16)), out)
    found = scratch.save(found, "links")
    links = found.filter(F.col("b").isNotNull()).select("a", "b")
    aside = found.filter(F.col("b").isNull()).select("route", "key", "block", F.col("a").alias("vid"))
    if aside.isEmpty():
        return links
    blocks = aside.groupBy("route", "key").agg((F.max("block") + 1).alias("n"))
    paired = (
        aside.join(blocks, ["route", "key"])
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
        .select("route", "key", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"), "vid")
        .join(points.select("vid", *words), "vid")
        .select("route", "key", "p", "q", "vid", *words)
    )
    dealt = paired.repartition("route", "key", "p", "q").sortWithinPartitions("route", "key", "p", "q")
    whole = 1 << 62  # a pair of blocks holds `cap` rows at most
    more = dealt.mapInArrow(lambda it: _linked(it, W, radius, whole, 4, 1 << 16), out)
    return links.unionByName(scratch.save(more, "block-links").select("a", "b"))
