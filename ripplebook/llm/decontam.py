"""Benchmark decontamination: spaced seeds, a seed join, and verified substitution-tolerant overlaps.

A spaced seed is a fixed mask over ``span`` consecutive tokens that reads some and ignores others, so a
hash of what it reads survives substitutions at the ignored places. Seeds of all benchmark items and of
all training documents are joined by hash; each hit names a (document, item, diagonal) and the overlap
around it is extended both ways with a mismatch penalty. Every hit that no extension covers yet is extended,
and the longest part of an extension that is long and alike enough is kept.

Documents pass through a Bloom filter of the benchmark's seed hashes first (sized by their number, 32 MB at most),
so only documents with a possible hit leave the scan, as token hashes. The join then removes the filter's
false positives. A document's tokens are read once more, to cut out what lies along each diagonal, so that a
candidate carries an item's length of tokens at most. All joins are on saved tables, so AQE splits hot seeds and items.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripplebook.llm.common import Scratch

#: Places read by each seed, weight 7 over spans of 7 to 11 tokens: the first reads all, the others skip fixed places.
MASKS = (
    (0, 1, 2, 3, 4, 5, 6),
    (0, 1, 2, 4, 5, 7, 8),
    (0, 2, 3, 5, 6, 8, 10),
    (0, 1, 3, 6, 7, 9, 10),
)
#: Items of fewer tokens have no seed; a hash of the whole item and its length stands in for one.
SHORTEST = min(mask[-1] for mask in MASKS) + 1
TOKENS = re.compile(r"[^\W_]+")
#: The filter has BITS_A_SEED bits a seed or more, between these bounds (128 KB to 32 MB), and a seed sets PROBES of them, so
#: one foreign seed in some two million passes: a document has thousands. Beyond the upper bound more documents pass, for the
#: join to sort out.
BITS_A_SEED, LEAST_BITS, MOST_BITS, PROBES = 64, 1 << 20, 1 << 28, 6
#: An overlap must have this many equal tokens (fewer only for items that are shorter) and this share of equal ones.
MIN_MATCHES, MIN_SHARE = 10, 0.75
MISMATCH, DROP = 2, 8


def token_hashes(text: str | None) -> np.ndarray:
    """A 63-bit hash of each token of the text, case-folded, punctuation left out."""
    hash_ = xxhash.xxh64_intdigest
    return np.array([hash_(w) >> 1 for w in TOKENS.findall((text or "").casefold())], np.int64)


def seed_hashes(tokens: np.ndarray, lengths: tuple[int, ...] = ()) -> tuple[np.ndarray, np.ndarray]:
    """(position, hash) of every seed of every mask and of all runs of so many tokens; the mask is part of the hash."""
    where, what = [], []
    t = tokens.view(np.uint64)
    for m, mask in [*enumerate(MASKS), *((len(MASKS) + n, tuple(range(n))) for n in lengths)]:
        n = len(t) - mask[-1]
        if n <= 0:
            continue
        h = np.full(n, (0x9E3779B97F4A7C15 * (m + 1)) & (2**64 - 1), np.uint64)
        for place in mask:
            h = (h ^ t[place : place + n]) * np.uint64(0xFF51AFD7ED558CCD)
            h ^= h >> np.uint64(32)
        where.append(np.arange(n))
        what.append(h.view(np.int64))
    if not where:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(where), np.concatenate(what)


def _bit(hashes: np.ndarray, k: int, size: int) -> np.ndarray:
    """The k-th of a seed's PROBES places in a filter of ``size`` bits, a power of two (double hashing)."""
    h = hashes.view(np.uint64)
    return (h + np.uint64(k) * (h >> np.uint64(36))) & np.uint64(size - 1)


def _may_hold(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Numbers of the hashes whose places are all set; later places are read for what passed the earlier."""
    left = np.arange(len(hashes))
    for k in range(PROBES):
        at = _bit(hashes[left], k, 8 * len(bits))
        left = left[(bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1]
    return left


def extend(doc: np.ndarray, item: np.ndarray, diagonal: int, at: int) -> tuple[int, int, int]:
    """(start, end, matches) in the document of the best overlap along a diagonal through position ``at``.

    From ``at`` outwards each equal token scores 1 and each other one -MISMATCH; an arm ends where its
    score has fallen ``DROP`` below its best.
    """
    lo, hi = max(0, diagonal), min(len(doc), len(item) + diagonal)
    same = doc[lo:hi] == item[lo - diagonal : hi - diagonal]

    def arm(flags: np.ndarray) -> int:
        if not len(flags):
            return 0
        score = np.cumsum(np.where(flags, 1, -MISMATCH))
        peak = np.maximum.accumulate(np.maximum(score, 0))
        fallen = np.flatnonzero(peak - score >= DROP)
        score = score[: fallen[0]] if len(fallen) else score
        return int(np.argmax(score)) + 1 if len(score) and score.max() > 0 else 0

    k = at - lo
    right, left = arm(same[k:]), arm(same[:k][::-1])
    start, end = k - left, k + right
    return lo + start, lo + end, int(same[start:end].sum())


def best_segment(doc: np.ndarray, item: np.ndarray, diagonal: int, hits: list[int], need: int, min_share: float) -> tuple[int, int, int] | None:
    """(start, end, matches) of the overlap with most matches along a diagonal, of those that meet both bounds.

    Looks at the extension around each of ``hits`` (document positions) that lies in none before it; within an
    extension, at all segments whose share of equal tokens is ``min_share`` or more.
    """
    best, done = None, -1
    for at in sorted(hits):
        if at < done:
            continue
        lo, done, _ = extend(doc, item, diagonal, at)
        same = doc[lo:done] == item[lo - diagonal : done - diagonal]
        count = np.r_[0, np.cumsum(same)]
        if count[-1] < need:
            continue
        # share >= min_share where surplus[j] >= surplus[i]; for each end j the first such i
        surplus = count - (min_share - 1e-12) * np.arange(len(count))
        i = np.searchsorted(-np.minimum.accumulate(surplus), -surplus, side="left")
        matches = count - count[i]
        j = int(np.argmax(matches))
        if matches[j] >= max(need, 1) and (best is None or matches[j] > best[2]):
            equal = np.flatnonzero(same[i[j] : j]) + int(i[j])  # unequal tokens at the rims count for nothing
            best = (lo + int(equal[0]), lo + int(equal[-1]) + 1, int(matches[j]))
    return best


def _seeds_of(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """(item, tokens) of the benchmark with one row an item."""

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            toks = [token_hashes(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(toks, pa.list_(pa.int64()))], names=["item_id", "item_tokens"])

    kind = dict(items.dtypes)[item_id]
    return items.select(F.col(item_id).alias("item_id"), F.col(text).alias("t")).mapInArrow(run, f"item_id {kind}, item_tokens array<bigint>")


def _explode_seeds(tokens: DataFrame, item_kind: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            keys, pos, what = [], [], []
            for i, t in enumerate(b.column(1).to_pylist()):
                p, h = seed_hashes(np.array(t or [], np.int64), (len(t),) if t and len(t) < SHORTEST else ())
                keys.append(np.full(len(p), i))
                pos.append(p)
                what.append(h)
            at = pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64))
            cat = lambda x: pa.array(np.concatenate(x) if x else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), cat(pos).cast(pa.int32()), cat(what)], names=["item_id", "item_pos", "seed"])

    return tokens.mapInArrow(run, f"item_id {item_kind}, item_pos int, seed bigint")


def filter_bits(n_seeds: int) -> int:
    return min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_A_SEED * n_seeds - 1).bit_length() if n_seeds else 0))


def _bloom(seeds: DataFrame) -> np.ndarray:
    """A filter with PROBES bits set for each benchmark seed; a small row of every 8 bytes comes back, 2**22 at most."""
    size = filter_bits(seeds.count())
    low, step = F.col("seed").bitwiseAND(F.lit(size - 1)), F.shiftrightunsigned("seed", 36)
    at = F.explode(F.array(*[(low + F.lit(k) * step).bitwiseAND(F.lit(size - 1)) for k in range(PROBES)]))
    word = seeds.select(at.alias("at")).select(F.shiftright("at", 6).cast("int").alias("w"), F.expr("shiftleft(1L, cast(at & 63 as int))").alias("v"))
    got = word.groupBy("w").agg(F.bit_or("v").alias("v")).toArrow()
    out = np.zeros(size // 64, np.int64)
    out[got.column("w").to_numpy()] = got.column("v").to_numpy()
    return out.view(np.uint8)


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    min_matches: int = MIN_MATCHES,
    min_share: float = MIN_SHARE,
    with_row: bool = False,
) -> DataFrame:
    """One row per (document, item) that overlap: doc_id, item_id, start, end (token positions in the
    document, end exclusive), matches, n_item (the item's tokens) and, on demand, row (the text's hash).

    The longest overlap of each pair is given. An overlap counts if it has ``min_matches`` equal tokens (for
    items of fewer than ``min_matches`` + 2 tokens: all but two) and ``min_share`` of its tokens are equal.
    Items with fewer tokens than the shortest seed are found where they occur whole and unchanged. Null and empty
    texts match nothing; rows of one id and one text are reported once, repeated items once per distinct (id, text).
    Items without an id are reported with a null item_id.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "decontam")
    items = scratch.save(_seeds_of(benchmark.select(item_id, item_text).distinct(), item_id, item_text), "items")
    item_kind, doc_kind = dict(items.dtypes)["item_id"], dict(docs.dtypes)[doc_id]
    items = items.withColumn("item_key", F.xxhash64("item_id", "item_tokens"))
    items = scratch.save(items, "keyed-items")
    seeds = scratch.save(_explode_seeds(items.select("item_key", "item_tokens"), "bigint").withColumnRenamed("item_id", "item_key"), "seeds")
    short = items.select(F.size("item_tokens").alias("n")).filter(f"n BETWEEN 1 AND {SHORTEST - 1}").distinct()
    lengths = tuple(sorted(r.n for r in short.collect()))  # six numbers at most
    bloom = spark.sparkContext.broadcast(_bloom(seeds))  # MOST_BITS / 8 bytes at most

    at = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    rows = docs.select(at.alias("row"), F.col(doc_id).alias("doc_id"), F.col(text).alias("t"))

    def scan(batches: Iterator[pa.RecordBatch]):
        bits = bloom.value
        for b in batches:
            keep, toks, pos, what = [], [], [], []
            for i, t in enumerate(b.column(2).to_pylist()):
                tokens = token_hashes(t)
                p, h = seed_hashes(tokens, lengths)
                hit = _may_hold(bits, h)
                if len(hit):
                    keep.append(i)
                    toks.append(tokens)
                    pos.append(p[hit].astype(np.int32))
                    what.append(h[hit])
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(at), b.column(1).take(at), pa.array(toks, pa.list_(pa.int64())), pa.array(pos, pa.list_(pa.int32())), pa.array(what, pa.list_(pa.int64()))],
                names=["row", "doc_id", "tokens", "pos", "seed"],
            )

    hits = scratch.save(rows.mapInArrow(scan, f"row bigint, doc_id {doc_kind}, tokens array<bigint>, pos array<int>, seed array<bigint>"), "hits")
    hits = scratch.save(hits.dropDuplicates(["row", "doc_id"]).withColumn("doc_key", F.xxhash64("row", "doc_id")), "distinct-hits")
    each = hits.select("doc_key", F.explode(F.arrays_zip("pos", "seed")).alias("s")).select("doc_key", "s.pos", "s.seed")
    met = each.join(seeds, "seed").select("doc_key", "item_key", "pos", (F.col("pos") - F.col("item_pos")).alias("diagonal"))
    diagonals = met.groupBy("doc_key", "item_key", "diagonal").agg(F.collect_set("pos").alias("hits"))  # an item's length at most
    diagonals = scratch.save(diagonals, "diagonals")
    sized = diagonals.join(items.select("item_key", F.size("item_tokens").alias("n_item")), "item_key")
    asked = sized.groupBy("doc_key").agg(F.collect_list(F.struct("item_key", "diagonal", "n_item", "hits")).alias("asks"))  # of one document
    asked = scratch.save(asked, "asked").join(hits.select("doc_key", "row", "doc_id", "tokens"), "doc_key").select("row", "doc_id", "tokens", "asks")

    def along(batches: Iterator[pa.RecordBatch]):
        """Of each document and diagonal: the document's tokens that lie beside the item, from ``first`` on."""
        for b in batches:
            who, first, cut = [], [], []
            counts = np.diff(b.column(3).offsets.to_numpy())
            asks = b.column(3).flatten()
            ends, sizes = asks.field("diagonal").to_pylist(), asks.field("n_item").to_pylist()
            k = 0
            for i, n in enumerate(counts.tolist()):
                tokens = b.column(2)[i].values.to_numpy()
                for j in range(k, k + n):
                    lo = max(0, ends[j])
                    who.append(i)
                    first.append(lo)
                    cut.append(tokens[lo : sizes[j] + ends[j]])
                k += n
            at = pa.array(who, pa.int64())
            fields = [b.column(0).take(at), b.column(1).take(at), pa.array(first, pa.int32()), pa.array(cut, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*fields, *[asks.field(c) for c in ("item_key", "diagonal", "hits")]], names=["row", "doc_id", "first", "beside", "item_key", "diagonal", "hits"])

    sides = asked.mapInArrow(along, f"row bigint, doc_id {doc_kind}, first int, beside array<bigint>, item_key bigint, diagonal int, hits array<int>")
    sides = scratch.save(sides, "candidates")
    pairs = sides.join(items.select("item_key", "item_id", "item_tokens"), "item_key")
    pairs = pairs.select("row", "doc_id", "item_id", "beside", "item_tokens", "diagonal", "hits", "item_key", "first")

    def verify(batches: Iterator[pa.RecordBatch]):
        schema = pa.schema([("i", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("matches", pa.int32()), ("n_item", pa.int32())])
        for b in batches:
            out: list[list] = [[], [], [], [], []]
            doc_tokens, item_tokens = b.column(3), b.column(4)
            for i, (d, hits, lo) in enumerate(zip(b.column(5).to_pylist(), b.column(6).to_pylist(), b.column(8).to_pylist(), strict=True)):
                doc, item = doc_tokens[i].values.to_numpy(), item_tokens[i].values.to_numpy()
                found = best_segment(doc, item, d - lo, [h - lo for h in hits], min(min_matches, max(1, len(item) - 2)), min_share)
                if found:
                    for col, v in zip(out, (i, found[0] + lo, found[1] + lo, found[2], len(item)), strict=True):
                        col.append(v)
            at = pa.array(out[0], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(k).take(at) for k in (0, 1, 2, 7)] + [pa.array(c, t) for c, t in zip(out[1:], schema.types[1:], strict=True)],
                names=["row", "doc_id", "item_id", "item_key", "start", "end", "matches", "n_item"],
            )

    found = pairs.mapInArrow(verify, f"row bigint, doc_id {doc_kind}, item_id {item_kind}, item_key bigint, start int, end int, matches int, n_item int")
    best = found.groupBy("row", "doc_id", "item_id", "item_key").agg(
        F.max_by(F.struct("start", "end", "matches", "n_item"), F.struct("matches", F.col("start") * -1)).alias("b")
    )
    return best.select(*(["row"] if with_row else []), "doc_id", "item_id", "b.start", "b.end", "b.matches", "b.n_item")


def clean(docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that overlap no benchmark item, columns as they are.

    Rows are known by their id and their text's hash, so no copy of the texts is made.
    """
    scratch = Scratch(docs.sparkSession, "decontam-clean")
    found = overlaps(docs, benchmark, doc_id=doc_id, text=text, with_row=True, **options)
    found = scratch.save(found.select(F.col("row").alias("__row"), F.col("doc_id").alias("__id")).distinct(), "found")
    same = (F.xxhash64(F.coalesce(F.col(text), F.lit(""))) == F.col("__row")) & F.col(doc_id).eqNullSafe(F.col("__id"))
    return docs.join(found, same, "left_anti")
