"""Sharding by balanced label propagation. Native: DataFrame operations only.

Documents that share a hub (here: an equal text) are linked. Each starts in a shard by the hash of its
key; in each round every hub elects, from the histogram of its documents' shards, the most frequent
shards with room, as few as can take them all, and its documents elsewhere ask to move there. Demand is counted per shard
and priority bucket (a bounded table: shards * PRIORITIES rows), and only as many buckets are let in as
the shard's quota has room for; so rounds are aggregations and equi-joins on saved tables, a hub of any
size is pre-aggregated map-side, and its documents' join is one that AQE splits. Documents without links
move last, into whatever room is left: a final exact pass numbers the documents of each shard, linked
ones first, and hands the overhang of full shards to those below their quota, so counts differ by one at
most and only unlinked documents move where they suffice.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ripplebook.llm.common import Scratch

PRIORITIES = 1024
#: Documents that one task numbers at a time.
BUCKET_ROWS = 20_000


def _pick(values: list[int], index: Column) -> Column:
    """values[index] as a literal array look-up."""
    return F.element_at(F.array(*[F.lit(int(v)).cast("bigint") for v in values]), index.cast("int") + 1)


def propagate(nodes: DataFrame, shards: int, quotas: list[int], rounds: int, scratch: Scratch) -> DataFrame:
    """``nodes`` (row, node, hub, shard; linked documents only) after at most ``rounds`` rounds of moves.

    No shard's linked documents come to exceed its quota through moves into it.
    """
    state = scratch.save(nodes, "state")
    for number in range(rounds):
        sizes = [0] * shards
        for r in state.groupBy("shard").agg(F.count("*").alias("n")).collect():  # a row a shard
            sizes[r["shard"]] = r["n"]
        room = [max(0, q - s) for q, s in zip(quotas, sizes, strict=True)]
        votes = state.groupBy("hub", "shard").agg(F.count("*").alias("n"))
        votes = votes.withColumn("open", _pick(room, F.col("shard")) > 0)
        # a hub's documents gather where most of them are and room is: in as few open shards as can take them all
        each = F.struct("n", F.xxhash64("hub", "shard").alias("h"), "shard", (F.col("n") + _pick(room, F.col("shard"))).alias("takes"))
        ranked = F.sort_array(F.collect_list(F.when(F.col("open"), each)), asc=False)  # a row a shard at most
        elected = votes.groupBy("hub").agg(ranked.alias("r"), F.sum("n").alias("total"), F.count("*").alias("spread"))
        short = lambda x, i: F.aggregate(F.slice("r", F.lit(1), i), F.lit(0).cast("bigint"), lambda a, y: a + y["takes"]) < F.col("total")
        elected = elected.filter("spread > 1 and size(r) > 0").select("hub", F.filter("r", short).alias("r"))
        elected = elected.select("hub", F.transform("r", lambda x: x["shard"]).alias("targets"), F.array_min(F.transform("r", lambda x: x["n"])).alias("to_n"))
        elected = scratch.save(elected, "elected")
        if elected.isEmpty():
            break
        joined = state.join(elected, "hub", "left").withColumn("pri", F.pmod(F.xxhash64("node", F.lit(number)), F.lit(PRIORITIES)))
        turn = F.pmod(F.xxhash64("node", F.lit(-1 - number)), F.size("targets")).cast("int")
        stays = F.array_contains("targets", F.col("shard"))
        joined = joined.withColumn("to", F.when(~stays, F.get("targets", turn)))
        joined = scratch.save(joined.select("row", "node", "hub", "shard", "to", "to_n", "pri"), "asked")
        # in a shard that is full a hub's documents stay if they are no fewer than in the elected ones
        here = scratch.save(votes.select("hub", "shard", F.col("n").alias("here_n"), "open"), "votes")
        asked = joined.join(here, ["hub", "shard"]).withColumn(
            "asks", F.col("to").isNotNull() & (F.col("open") | (F.col("here_n") < F.col("to_n")))
        )
        asked = scratch.save(asked.select("row", "node", "hub", "shard", "to", "pri", F.coalesce("asks", F.lit(False)).alias("asks")), "asking")
        demand = {}
        for r in asked.filter("asks").groupBy("to", "pri").agg(F.count("*").alias("n")).collect():  # shards * PRIORITIES rows at most
            demand[r["to"], r["pri"]] = r["n"]
        if not demand:
            break
        admitted = []
        for s in range(shards):
            taken, limit = 0, 0
            while limit < PRIORITIES and taken + demand.get((s, limit), 0) <= room[s]:
                taken += demand.get((s, limit), 0)
                limit += 1
            admitted.append(limit)
        moves = F.col("asks") & (F.col("pri") < _pick(admitted, F.col("to")))
        after = scratch.save(asked.select("row", "node", "hub", F.when(moves, F.col("to")).otherwise(F.col("shard")).alias("shard")), "state")
        scratch.drop(state, elected, joined, here, asked)
        state = after
        if not any(admitted):
            break
    return state


def _numbered(placed: DataFrame, shards: int, scratch: Scratch) -> tuple[DataFrame, list[int]]:
    """``placed`` (row, node, linked, shard) with ``at``: position in the shard, linked documents first.

    Numbered in buckets of about BUCKET_ROWS: row_number within a bucket, plus the sizes of those before.
    """
    total = placed.count()
    split = max(1, -(-total // (shards * BUCKET_ROWS)))
    # by the row's hash, so that neither a hub nor an id can fill a bucket; linked documents come first
    bucket = F.pmod(F.xxhash64("node"), F.lit(split)) + F.when(F.col("linked"), 0).otherwise(split)
    keyed = scratch.save(placed.withColumn("bucket", bucket.cast("int")), "keyed")
    counts = keyed.groupBy("shard", "bucket").agg(F.count("*").alias("n"))  # some 2 * total / BUCKET_ROWS rows
    w = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = scratch.save(counts.withColumn("before", F.coalesce(F.sum("n").over(w), F.lit(0))), "offsets")
    rank = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("node", "row"))
    ranked = scratch.save(keyed.withColumn("rank", rank), "ranked")
    out = ranked.join(offsets.select("shard", "bucket", "before"), ["shard", "bucket"])
    sizes = [0] * shards
    for r in offsets.groupBy("shard").agg(F.sum("n").alias("n")).collect():
        sizes[r["shard"]] = r["n"]
    return out.withColumn("at", F.col("before") + F.col("rank") - 1), sizes


def shard_documents(
    docs: DataFrame,
    *,
    shards: int = 16,
    doc_id: str = "doc_id",
    text: str = "text",
    rounds: int = 8,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, hub, linked, shard, slot.

    Law ``rows``: shards' counts differ by one at most. Equal texts are links (null counts as empty);
    size is the text's UTF-8 bytes plus 1. ``slot`` runs from 0 without gaps in each shard. Repeated and
    null ids are rows like any other; an empty table gives no rows. Placement follows ids and texts, not how rows are dealt
    out: the same rows in other files get the same shards (rows equal in id and text are told apart as scanned).
    """
    scratch = Scratch(docs.sparkSession, "sharding")
    body = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(body) + 1).cast("bigint").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.unhex(F.sha2(body, 256)).alias("hub"),
    )
    base = scratch.save(base.withColumn("key", F.xxhash64("doc_id", "hub")), "base")
    total = base.count()
    # what places a row is a hash of its id and text; rows that share both are spread by their row number
    twins = scratch.save(base.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key"), "twins")
    told = base.join(twins.withColumn("twin", F.lit(True)), "key", "left")
    base = scratch.save(told.withColumn("node", F.when(F.col("twin"), F.xxhash64("key", "row")).otherwise(F.col("key"))).drop("key", "twin"), "nodes")
    quotas = [total // shards + (s < total % shards) for s in range(shards)]
    shared = scratch.save(base.groupBy("hub").agg(F.count("*").alias("n")).filter("n > 1").select("hub"), "hubs")
    start = F.pmod(F.xxhash64("node", "hub"), F.lit(shards)).cast("int")
    nodes = base.join(shared, "hub", "left_semi").select("row", "node", "hub", start.alias("shard"))
    state = propagate(nodes, shards, quotas, rounds, scratch)
    held = [0] * shards
    for r in state.groupBy("shard").agg(F.count("*").alias("n")).collect():
        held[r["shard"]] = r["n"]
    # unlinked documents go by hash into the room that is left, in proportion
    left = [max(0, q - h) for q, h in zip(quotas, held, strict=True)]
    scale, acc, ends = max(1, sum(left)), 0, []
    for x in left:
        acc += x
        ends.append(acc)
    spot = F.pmod(F.xxhash64("node"), F.lit(scale))
    fill = reduce(lambda e, s: e.when(spot < ends[s], F.lit(s)), range(1, shards), F.when(spot < ends[0], F.lit(0))).otherwise(F.lit(shards - 1))
    placed = base.select("row", "node").join(state.select("row", F.col("shard").alias("s")), "row", "left")
    placed = placed.select("row", "node", F.col("s").isNotNull().alias("linked"), F.coalesce("s", fill).cast("int").alias("shard"))
    at, sizes = _numbered(placed, shards, scratch)
    # exact evening: positions past the quota leave, in order, for the free slots of shards below theirs
    over_before, vacant_before, o, v = [], [], 0, 0
    for s in range(shards):
        over_before.append(o)
        vacant_before.append(v)
        o += max(0, sizes[s] - quotas[s])
        v += max(0, quotas[s] - sizes[s])
    leaves = F.col("at") >= _pick(quotas, F.col("shard"))
    turn = _pick(over_before, F.col("shard")) + F.col("at") - _pick(quotas, F.col("shard"))
    takers = [s for s in range(shards) if sizes[s] < quotas[s]] or [0]
    to = F.lit(takers[0])
    for s in takers[1:]:
        to = F.when(turn >= vacant_before[s], F.lit(s)).otherwise(to)
    moved = at.withColumn("to", F.when(leaves, to).otherwise(F.col("shard")).cast("int"))
    slot = F.when(leaves, _pick(sizes, F.col("to")) + turn - _pick(vacant_before, F.col("to"))).otherwise(F.col("at"))
    final = scratch.save(moved.select("row", "linked", F.col("to").alias("shard"), slot.cast("bigint").alias("slot")), "final")
    return base.join(final, "row").select("doc_id", "size", "text_crc32", "hub", "linked", "shard", "slot")


def cut_edges(sharded: DataFrame) -> DataFrame:
    """(linked, kept, cut): star links (each document to one of its hub) that shards keep and cut.

    A hub of n documents in k shards keeps n - k of n - 1 links.
    """
    parts = sharded.groupBy("hub", "shard").agg(F.count("*").alias("n")).groupBy("hub").agg(F.sum("n").alias("n"), F.count("*").alias("k"))
    return parts.agg(
        F.sum(F.col("n") - 1).alias("linked"), F.sum(F.col("n") - F.col("k")).alias("kept"), F.sum(F.col("k") - 1).alias("cut")
    )
