"""SimHash near-duplicates: fingerprints of whole texts, linked through the Gray-order index.

Fingerprints are made in Arrow batches, a text at a time; equal fingerprints are folded into one
point with map-side combining, so exact copies never meet in one task as rows. Links between points
come from :mod:`gray_index` as stars, classes from :mod:`components`. The filter takes such classes as candidates
only and links documents within them by the exact similarity of their shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ripplebook.llm.common import Scratch
from ripplebook.llm.components import connected_components
from ripplebook.llm.gray_index import hamming_links, masked_routes, pigeonhole_masks

SEED = 42


def shingle_hashes(text: bytes, size: int) -> np.ndarray:
    """XXH64 of each ``size``-word shingle of a text (A-Z lower-cased, words joined by one space).

    Fewer words: the whole sequence is the one shingle. No words: nothing.
    """
    words = text.lower().split()  # bytes: lowers A-Z only, splits at ASCII white space only
    if not words:
        return np.zeros(0, np.uint64)
    whole, hash_ = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= size:
        return np.array([hash_(whole, SEED)], np.uint64)
    at = np.zeros(len(words) + 1, np.int64)
    np.cumsum([len(w) + 1 for w in words], out=at[1:])
    starts, ends = at[: len(words) - size + 1].tolist(), (at[size:] - 1).tolist()
    return np.array([hash_(whole[s:e], SEED) for s, e in zip(starts, ends, strict=True)], np.uint64)


def majority(hashes: np.ndarray) -> int:
    """A 64-bit number whose bit is set where it is set in over half the hashes."""
    if len(hashes) == 0:
        return 0
    counts = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 16):
        part = hashes[k : k + (1 << 16)]
        counts += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def _mixed(hashes: np.ndarray, k: int) -> np.ndarray:
    """The k-th further hash of each hash (splitmix64 finaliser; the first is the hash itself)."""
    if k == 0:
        return hashes
    x = hashes + np.uint64((0x9E3779B97F4A7C15 * k) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprint(text: bytes, shingle: int, words: int = 1) -> list[int]:
    """``words`` 64-bit words of fingerprint; all zero for a text without words."""
    hashes = shingle_hashes(text, shingle)
    return [majority(_mixed(hashes, k)) for k in range(words)]


def with_fingerprints(docs: DataFrame, text: str, shingle: int, words: int, keep: list[Column]) -> DataFrame:
    """``keep`` columns, a row number and fp0.. (bigint, the bits of an unsigned word)."""
    rows = docs.select(*keep, F.monotonically_increasing_id().alias("row"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("__text"))
    names = [c for c in rows.columns if c != "__text"]

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            last = batch.num_columns - 1
            fps = np.array([fingerprint(t, shingle, words) for t in batch.column(last).to_pylist()], np.uint64).reshape(-1, words)
            cols = [batch.column(i) for i in range(last)] + [pa.array(fps[:, k].copy().view(np.int64)) for k in range(words)]
            yield pa.RecordBatch.from_arrays(cols, names=names + [f"fp{k}" for k in range(words)])

    schema = ", ".join([f"`{n}` {t}" for n, t in rows.dtypes if n != "__text"] + [f"fp{k} bigint" for k in range(words)])
    return rows.mapInArrow(run, schema)


def cluster(marked: DataFrame, words: list[str], radius: int, routes: Column, scratch: Scratch, cap: int = 1 << 17) -> DataFrame:
    """``marked`` (saved; with ``row`` and the words) with ``root``: the smallest row of its class.

    Classes: rows that are connected by links of ``radius`` differing bits at most, over shared routes.
    """
    points = scratch.save(marked.groupBy(*words).agg(F.min("row").alias("vid")), "points")
    links = hamming_links(points, words, radius, routes, scratch, cap=cap)
    classes = connected_components(links, scratch)
    rooted = points.join(classes.select(F.col("node").alias("vid"), "root"), "vid", "left")
    rooted = scratch.save(rooted.select(*words, F.coalesce("root", "vid").alias("root")), "rooted")
    return marked.join(rooted, words)


def near_duplicate_classes(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = 4,
    radius: int = 4,
    blocks: int = 6,
    cap: int = 1 << 17,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    Fingerprints link where ``radius`` bits at most differ; all links are found (pigeonhole: of
    ``blocks`` runs of bits, ``blocks - radius`` agree). component_id is the class's smallest doc_id,
    null only if all its ids are null. Null and blank texts have the zero fingerprint, linked like any
    other; repeated rows are in one class; an empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    marked = scratch.save(with_fingerprints(docs, text, shingle, 1, [F.col(doc_id).alias("doc_id")]), "marked")
    routes = masked_routes(["fp0"], pigeonhole_masks(64, radius, blocks))
    rooted = scratch.save(cluster(marked, ["fp0"], radius, routes, scratch, cap), "classes")
    least = scratch.save(rooted.groupBy("root").agg(F.min("doc_id").alias("component_id")), "least")
    return rooted.join(least, "root").select(
        "doc_id", F.lpad(F.lower(F.hex("fp0")), 16, "0").alias("fingerprint"), "component_id"
    )


#: The wide fingerprint of the near-duplicate filter: 256 bits, so that the share of differing bits tells the
#: similarity of 5-word shingle sets to some 0.035. Unlike texts differ in 128 bits, give or take 8.
WIDE_WORDS = 4
#: Documents link where the exact Jaccard similarity of their shingle sets is this or more.
SIMILARITY = 0.8
#: Similarity 0.8 means 0.15 of the bits differ, 39 of 256, give or take 6. The radius only spares comparisons, so
#: it lies four deviations beyond.
WIDE_RADIUS = 64
#: Routes are bands of minima: two sets of similarity 0.8 agree on one of 40 bands of 7 with probability 0.9999.
BANDS, BAND = 40, 7
#: Odd factors; the products of a shingle hash with them stand for its hashes in as many orders.
FACTORS = np.random.default_rng(11).integers(0, 2**63, BANDS * BAND, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Members of a class of candidates that are compared in one task, about; larger classes are compared in pairs of blocks.
BLOCK = 512


def band_keys(shingles: np.ndarray) -> np.ndarray:
    """A key of each of the BANDS bands of a set of shingle hashes; none for the empty set."""
    if not len(shingles):
        return np.zeros(0, np.uint64)
    least = np.full(len(FACTORS), 2**64 - 1, np.uint64)
    for k in range(0, len(shingles), 1 << 12):
        np.minimum(least, np.multiply.outer(FACTORS, shingles[k : k + (1 << 12)]).min(axis=1), out=least)
    out = np.zeros(BANDS, np.uint64)
    for part in least.reshape(BANDS, BAND).T:
        out = (out ^ part) * np.uint64(0xFF51AFD7ED558CCD)
        out ^= out >> np.uint64(32)
    return out


def _with_bands(docs: DataFrame, text: str, shingle: int, keep: list[Column]) -> DataFrame:
    """``keep`` columns, a row number, fp0.. of the shingle set, sig (the set's hash) and bands."""
    rows = docs.select(*keep, F.monotonically_increasing_id().alias("row"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("__text"))
    names = [c for c in rows.columns if c != "__text"]
    more = [f"fp{k}" for k in range(WIDE_WORDS)] + ["sig", "bands"]

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            last = batch.num_columns - 1
            fps, sigs, bands = [], [], []
            for t in batch.column(last).to_pylist():
                own = np.unique(shingle_hashes(t, shingle))
                fps.append([majority(_mixed(own, k)) for k in range(WIDE_WORDS)])
                sigs.append(xxhash.xxh64_intdigest(own.tobytes(), SEED))
                bands.append(band_keys(own).view(np.int64))
            fp = np.array(fps, np.uint64).reshape(-1, WIDE_WORDS)
            cols = [batch.column(i) for i in range(last)] + [pa.array(fp[:, k].copy().view(np.int64)) for k in range(WIDE_WORDS)]
            cols += [pa.array(np.array(sigs, np.uint64).view(np.int64)), pa.array(bands, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(cols, names=names + more)

    schema = ", ".join([f"`{n}` {t}" for n, t in rows.dtypes if n != "__text"] + [f"{c} bigint" for c in more[:-1]] + ["bands array<bigint>"])
    return rows.mapInArrow(run, schema)


def _similar_pairs(vid, block, fp, sets, radius: int, similarity: float, across: bool) -> list[tuple[int, int]]:
    """Pairs of rows (across blocks only, on demand) of ``similarity`` or more, as many as connect all rows that have such pairs."""
    n = len(vid)
    labels, sizes, out = np.arange(n), np.array([len(x) for x in sets]), []
    for i in range(n - 1):
        rest = slice(i + 1, n)
        differ = np.bitwise_count(fp[rest] ^ fp[i]).sum(axis=1, dtype=np.int32)
        small, large = np.minimum(sizes[rest], sizes[i]), np.maximum(sizes[rest], sizes[i])
        good = (differ <= radius) & (labels[rest] != labels[i]) & (small >= similarity * large - 1e-9)
        if across:
            good &= block[rest] != block[i]
        near = np.flatnonzero(good)
        for j in (near[np.argsort(differ[near], kind="stable")] + i + 1).tolist():
            if labels[i] == labels[j]:
                continue
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if both >= similarity * (sizes[i] + sizes[j] - both) - 1e-9:
                out.append((int(vid[i]), int(vid[j])))
                labels[labels == labels[j]] = labels[i]
    return out


def _verified_links(docs: DataFrame, text: str, shingle: int, members: DataFrame, radius: int, similarity: float, scratch: Scratch) -> DataFrame:
    """(a, b): links between ``vid`` values that join all ``members`` (vid, root, at, id, fp0..) of one candidate
    class (``root``) whose shingle sets have the similarity. ``docs`` has the columns __row_at and __row_id to find the texts by."""
    words = [f"fp{k}" for k in range(WIDE_WORDS)]
    sizes = members.groupBy("root").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    dealt = members.join(sizes, "root").withColumn("block", F.pmod(F.xxhash64("vid"), F.col("blocks")).cast("int"))
    same = (F.col("__row_at") == F.col("at")) & F.col("__row_id").eqNullSafe(F.col("id"))
    texts = docs.select("__row_at", "__row_id", F.coalesce(F.col(text), F.lit("")).cast("binary").alias("__text")).join(dealt.hint("merge"), same)
    texts = texts.dropDuplicates(["__row_at", "__row_id"]).select("vid", "root", "block", "blocks", *words, "__text")

    def sets(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            own = [np.unique(shingle_hashes(t, shingle)).view(np.int64) for t in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(own, pa.list_(pa.int64()))], names=[*b.schema.names[:-1], "shingles"])

    schema = "vid bigint, root bigint, block int, blocks int, " + ", ".join(f"{w} bigint" for w in words) + ", shingles array<bigint>"
    held = scratch.save(texts.mapInArrow(sets, schema), "sets")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    paired = held.withColumn("other", other).withColumn("p", F.least("block", "other")).withColumn("q", F.greatest("block", "other"))

    def verify(t: pa.Table) -> pa.Table:
        fp = np.column_stack([t.column(w).to_numpy() for w in words]).view(np.uint64)
        own = [x.values.to_numpy().view(np.uint64) for x in t.column("shingles")]
        across = t.column("p")[0].as_py() != t.column("q")[0].as_py()
        found = _similar_pairs(t.column("vid").to_numpy(), t.column("block").to_numpy(), fp, own, radius, similarity, across)
        a, b = zip(*found, strict=True) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    grouped = paired.select("root", "p", "q", "vid", "block", *words, "shingles").groupBy("root", "p", "q")
    links = scratch.save(grouped.applyInArrow(verify, "a bigint, b bigint"), "verified")
    scratch.drop(held)
    return links


def keep_one_of_each(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = 5,
    radius: int = WIDE_RADIUS,
    cap: int = 1 << 17,
) -> DataFrame:
    """``docs`` with one document of each near-duplicate class, columns as they are.

    Documents link where the exact Jaccard similarity of their sets of ``shingle``-word shingles is 0.8 or more.
    Bands of minima and wide fingerprints choose which are compared: they miss a pair at 0.8 with a probability of some
    0.0001. The smallest doc_id of a class stays (null ids last, ties by the text's hash), so of repeated rows
    (one id, one text) one does. Texts without words are all alike: one stays. An empty table stays empty.
    """
    scratch = Scratch(docs.sparkSession, "simhash-keep")
    # a row is known by its id and its text's hash: texts are not copied, and are moved twice, by the joins for sets and for the result
    at = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    keyed = docs.withColumn("__row_at", at)
    marked = scratch.save(_with_bands(docs, text, shingle, [at.alias("at"), F.col(doc_id).alias("doc_id")]), "marked")
    words = [f"fp{k}" for k in range(WIDE_WORDS)]
    # equal sets are one point; its smallest row stands for them
    vids = marked.groupBy("sig", "fp0").agg(F.min("row").alias("row"))
    points = marked.join(vids.select("row"), "row").select(F.col("row").alias("vid"), "sig", *words, "bands", "at", F.col("doc_id").alias("id"))
    points = scratch.save(points, "points")
    routes = F.explode(F.expr("transform(bands, (key, route) -> named_struct('route', route, 'key', key))"))
    candidates = connected_components(hamming_links(points, words, radius, routes, scratch, cap=cap), scratch)
    members = points.drop("sig", "bands").join(candidates.select(F.col("node").alias("vid"), "root"), "vid")
    members = scratch.save(members, "members")
    links = _verified_links(keyed.withColumn("__row_id", F.col(doc_id)), text, shingle, members, radius, SIMILARITY, scratch)
    verified = connected_components(links, scratch)
    rooted = points.select("sig", "fp0", "vid").join(verified.select(F.col("node").alias("vid"), "root"), "vid", "left")
    rooted = scratch.save(rooted.select("sig", "fp0", F.coalesce("root", "vid").alias("root")), "rooted")
    classes = scratch.save(marked.join(rooted, ["sig", "fp0"]).select("root", "at", "doc_id"), "classes")
    # two plain minima rather than a minimum of structs, which Spark would sort for
    least = scratch.save(classes.groupBy("root").agg(F.min("doc_id").alias("least")), "least")
    stays = classes.join(least, "root").filter(F.col("doc_id").eqNullSafe(F.col("least"))).groupBy("root").agg(
        F.min("at").alias("__at"), F.first("doc_id").alias("__id")
    )
    stays = scratch.save(stays.select("__at", "__id"), "stays")
    scratch.keep_only(stays)
    kept = keyed.join(stays.hint("merge"), (F.col("__row_at") == F.col("__at")) & F.col(doc_id).eqNullSafe(F.col("__id")), "left_semi")
    # repeated rows have one key; they lie together after the join, so this moves nothing
    return kept.dropDuplicates([doc_id, "__row_at"]).select(*[F.col(f"`{c}`") for c in docs.columns])
