"""Best-fit packing of token pieces into sequences: large-item matching, then best fit.

Whole texts are tokenised in Arrow batches; only lengths and checksums leave the workers, in a
durable table. Pieces are dealt into blocks of about ``block_rows`` by a hash of id and text, and where rows share
both by a stored row number, so a block fits one task's memory at any corpus size, no repeated row can fill
one, and the packing does not depend on how rows are dealt out. Each block
is packed on its own; a block wastes at most part of one sequence against packing all at once
(one in some 2,000).

Within a block: pieces above a third of the capacity can share a sequence at most two at a time;
the largest unmatched one takes the largest partner that fits (greedy matching). Then all smaller
pieces, largest first, go into the tightest remaining gap (best fit), opening a sequence only where
no gap is wide enough.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripplebook.llm.common import Scratch

CAPACITY = 2048
END_ID = 0
#: Characters on which all Unicode versions agree (ASCII, Latin-1 letters, Latin Extended-A, common quotes and dashes).
PLAIN = regex.compile(r"[\x00-\x7e¡-ž‐-‧€]*")


def tokenizer_paths(name: str = "byte_bpe_50k") -> tuple[str, str]:
    """The vocabulary as a ``tokenizers`` file and as merge ranks, from the installed data package."""
    import public_tokenizers

    return public_tokenizers.path(f"{name}.json"), public_tokenizers.path(f"{name}.tiktoken")


@functools.lru_cache(maxsize=2)
def _encoders(json_path: str, ranks_path: str):
    import base64
    import os

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    slow = Tokenizer.from_file(json_path)
    slow.encode_special_tokens = True
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return slow, fast


def encode(text: str, paths: tuple[str, str]) -> list[int]:
    """Ids of one whole text, without special tokens.

    The merge-rank encoder and the ``tokenizers`` file hold one vocabulary and give equal ids; the
    former is some four times as fast and takes the texts whose characters both classify alike, the
    latter takes all others.
    """
    slow, fast = _encoders(*paths)
    if PLAIN.fullmatch(text):
        return fast.encode_ordinary(text)
    return slow.encode(text, add_special_tokens=False).ids


def cut(ids: np.ndarray, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole ones at the end, a shorter first one if needed."""
    n = len(ids)
    if n <= capacity:
        return [(0, n)]
    first = n % capacity
    starts = ([0] if first else []) + list(range(first, n, capacity))
    return [(s, (first if s == 0 and first else capacity)) for s in starts]


def _pieces(batches: Iterator[pa.RecordBatch], paths: tuple[str, str], capacity: int, end_id: int):
    schema = pa.schema(
        [("__row", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    )
    for batch in batches:
        rows, texts = batch.column(0).to_pylist(), batch.column(1)
        out: list[list] = [[], [], [], [], []]
        for row, text in zip(rows, texts, strict=True):
            ids = encode(text.as_py() or "", paths)
            ids.append(end_id)
            raw = np.asarray(ids, dtype="<u4")
            for k, (start, length) in enumerate(cut(raw, capacity)):
                for col, v in zip(out, (row, k, start, length, zlib.crc32(raw[start : start + length].tobytes())), strict=True):
                    col.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, schema.types, strict=True)], schema=schema)


def pack_lengths(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each piece of one block. Deterministic for a given order of pieces."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.full(len(lengths), -1, np.int64), np.zeros(len(lengths), np.int64)
    gap_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_gaps = 0  # bit g is set while gap_bins[g] has a bin
    n_bins = 0
    by_length: list[list[int]] = [[] for _ in range(capacity + 1)]
    large = [int(i) for i in order if 3 * lengths[i] > capacity]
    waiting = 0  # bit n is set while an unmatched large piece of length n is left
    for i in reversed(large):
        by_length[lengths[i]].append(i)
        waiting |= 1 << int(lengths[i])
    for i in large:
        if bins[i] >= 0:
            continue
        size = int(lengths[i])
        bins[i], room = n_bins, capacity - size
        by_length[size].pop()  # pieces of one length leave in order, so this is piece i
        if not by_length[size]:
            waiting &= ~(1 << size)
        fits = waiting & ((1 << (room + 1)) - 1)
        if fits:
            other = fits.bit_length() - 1
            j = by_length[other].pop()
            if not by_length[other]:
                waiting &= ~(1 << other)
            bins[j], offsets[j] = n_bins, size
            room -= other
        gap_bins[room].append(n_bins)
        open_gaps |= 1 << room
        n_bins += 1
    for i in order[len(large) :]:
        size = int(lengths[i])
        wide = open_gaps >> size
        if wide:
            gap = size + (wide & -wide).bit_length() - 1
            b = gap_bins[gap].pop()
            if not gap_bins[gap]:
                open_gaps &= ~(1 << gap)
        else:
            b, gap, n_bins = n_bins, capacity, n_bins + 1
        bins[i], offsets[i] = b, capacity - gap
        gap_bins[gap - size].append(b)
        open_gaps |= 1 << (gap - size)
    return bins, offsets


def _pack_block(table: pa.Table, capacity: int) -> pa.Table:
    table = table.sort_by([("__key", "ascending"), ("__row", "ascending"), ("piece", "ascending")])
    lengths = table.column("length").to_numpy()
    bins, offsets = pack_lengths(lengths, capacity)
    block = table.column("__block").to_numpy()
    drop = [c for c in table.column_names if c not in ("__block",)]
    return table.select(drop).append_column("sequence_id", pa.array(block.astype(np.int64) * (1 << 32) + bins)).append_column(
        "offset", pa.array(offsets)
    )


def pack(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    block_rows: int = 4096,
    paths: tuple[str, str] | None = None,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are one piece of the end id alone. Every row of ``docs`` is packed, repeated
    and null ids included; ``sequence_id`` is unique over the result. An empty table gives no rows.
    """
    paths = paths or tokenizer_paths()
    scratch = Scratch(docs.sparkSession, "packing")
    key = F.xxhash64(doc_id, F.coalesce(F.col(text), F.lit("")))
    rows = docs.select(F.monotonically_increasing_id().alias("__row"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), key.alias("__key"))

    def tokenise(batches, paths=paths):
        for batch in batches:
            (out,) = list(_pieces(iter([batch.select([0, 2])]), paths, capacity, end_id))
            at = {r: i for i, r in enumerate(batch.column(0).to_pylist())}
            of = pa.array([at[r] for r in out.column(0).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(1).take(of), batch.column(3).take(of), *out.columns], names=["doc_id", "__key", *out.schema.names])

    kind = dict(rows.dtypes)["doc_id"]
    pieces = rows.mapInArrow(tokenise, f"doc_id {kind}, __key bigint, __row bigint, piece int, start bigint, length bigint, ids_crc32 bigint")
    pieces = scratch.save(pieces, "pieces")
    blocks = max(1, -(-pieces.count() // block_rows))
    twins = pieces.filter("piece = 0").groupBy("__key").agg(F.count("*").alias("n")).filter("n > 1").select("__key", F.lit(True).alias("__twin"))
    told = pieces.join(scratch.save(twins, "twins"), "__key", "left")
    by = F.xxhash64("__key", "piece", F.when(F.col("__twin"), F.col("__row")))
    dealt = told.withColumn("__block", F.pmod(by, F.lit(blocks)).cast("int")).drop("__twin")
    packed = dealt.groupBy("__block").applyInArrow(
        lambda t: _pack_block(t, capacity),
        f"doc_id {kind}, __key bigint, __row bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    )
    return packed.drop("__key", "__row")


def render(docs: DataFrame, packed: DataFrame, *, capacity: int = CAPACITY, end_id: int = END_ID, paths: tuple[str, str] | None = None) -> DataFrame:
    """(sequence_id, ids): the token ids of each packed sequence, at most ``capacity`` a row.

    For unique, non-null doc_ids. Documents are tokenised again rather than kept, so that packing
    moves lengths and not tokens.
    """
    paths = paths or tokenizer_paths()
    plan = packed.groupBy("doc_id").agg(F.collect_list(F.struct("start", "length", "sequence_id", "offset")).alias("plan"))

    def slices(batches):
        for batch in batches:
            out: list[list] = [[], [], []]
            for text, plan_ in zip(batch.column(0), batch.column(1), strict=True):
                ids = encode(text.as_py() or "", paths) + [end_id]
                for p in plan_.as_py():
                    for col, v in zip(out, (p["sequence_id"], p["offset"], ids[p["start"] : p["start"] + p["length"]]), strict=True):
                        col.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.list_(pa.int32()))],
                names=["sequence_id", "offset", "ids"],
            )

    parts = docs.select("doc_id", "text").join(plan, "doc_id").select("text", "plan")
    cut_up = parts.mapInArrow(slices, "sequence_id bigint, offset bigint, ids array<int>")
    whole = cut_up.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    return whole.select("sequence_id", F.flatten(F.transform("p", lambda x: x["ids"])).alias("ids"))
