"""Substring dedup: content-defined chunks by a gear rolling hash, deduplicated by digest.

A text's words, joined by single spaces, run through a gear hash of which 16 bytes' reach is read; a chunk
ends after a word whose hash is the least of the ``REACH_CUT`` words on either side, after MAX words at the latest. As
ends depend on nearby bytes only (never on the cut before), an insertion moves the ends around it and no others, and a
passage that two documents share has the same chunks in both, but for some words at its rims. Chunks are compared by
128-bit digests: one aggregation (combined map-side, so a passage in a third of all rows is one row a task) finds those of
several documents, one join gives each later occurrence its place in the first document. Neighbouring chunks that lie side by
side in one first document too make runs, so a run is a passage of that document word for word. Runs are widened by the
words themselves, ``REACH`` of them and four times as many each further time, up to the first that differs. What then has
``min_words`` or more is a repeat; repeats within others are left out.

Chunks carry digests and positions only; word hashes leave the scan around rims, where the chunk beside is not told already.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ripplebook.llm.common import SPACES, WORD, Scratch
from ripplebook.llm.url_filter import block_count, build_filter, probe_filter

REACH_CUT, MAX = 4, 64
REACH = 16
MIN_WORDS = 20
#: Places of one chunk in its first document that its later occurrences are dealt to in turn; a lookup width, no cap on what is found.
PLACES = 64
WORDS = re.compile(WORD)
#: One random number a byte value; any fixed table serves.
GEAR = np.random.default_rng(20).integers(0, 2**32, 256, dtype=np.uint32)


def gear(data: bytes) -> np.ndarray:
    """The rolling hash after each byte: h = 2h + GEAR[byte] mod 2**32, which the last 32 bytes fix (its low 16 bits: the last 16)."""
    h = GEAR[np.frombuffer(data, np.uint8)]
    reach = 1
    while reach < 32:  # twice the reach a step
        if len(h) > reach:
            h[reach:] = h[reach:] + (h[:-reach].copy() << np.uint32(reach))
        reach *= 2
    return h


def chunk_ends(at_ends: np.ndarray) -> list[int]:
    """Word numbers after which chunks end, from the rolling hash after each word."""
    n = len(at_ends)
    value = (at_ends & np.uint32(0xFFFF)).astype(np.int32)
    edge = np.full(REACH_CUT, 1 << 16, np.int32)
    least = np.lib.stride_tricks.sliding_window_view(np.r_[edge, value, edge], REACH_CUT).min(axis=1)
    # less than all before and no more than all after: the first of equal words
    good = (np.flatnonzero((value < least[:n]) & (value <= least[REACH_CUT + 1 : REACH_CUT + 1 + n])) + 1).tolist()
    out, last = [], 0
    for e in [*good, n]:
        while e - last > MAX:
            last += MAX
            out.append(last)
        if e > last:
            out.append(e)
            last = e
    return out


def chunks_of(text: bytes) -> tuple[list[int], list[int], np.ndarray, list[int]]:
    """(start words, lengths in words, digests (n, 2), how many equal chunks come before) of a text's chunks."""
    words = text.split()
    if not words:
        return [], [], np.zeros((0, 2), np.int64), []
    data = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 2
    stops = chunk_ends(gear(data)[ends])
    starts = [0, *stops[:-1]]
    begin = np.r_[0, ends[:-1] + 2]
    digest, seen, nth = xxhash.xxh3_128_digest, {}, []
    raw = [digest(data[a:b]) for a, b in zip(begin[starts].tolist(), (ends[np.array(stops) - 1] + 1).tolist(), strict=True)]
    for d in raw:
        nth.append(k := seen.get(d, 0))
        seen[d] = k + 1
    return starts, [b - a for a, b in zip(starts, stops, strict=True)], np.frombuffer(b"".join(raw), "<i8").reshape(-1, 2), nth


def chunk_table(rows: DataFrame) -> DataFrame:
    """row, doc_id, start, words, d0, d1, nth for each chunk of ``rows`` (row, doc_id, text)."""
    kind = dict(rows.dtypes)["doc_id"]
    names = ["row", "doc_id", "start", "words", "d0", "d1", "nth"]

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            at, start, size, digests, nth = [], [], [], [np.zeros((0, 2), np.int64)], []
            for i, text in enumerate(batch.column(2).to_pylist()):
                s, n, d, k = chunks_of(text)
                at.append(np.full(len(s), i))
                start += s
                size += n
                digests.append(d)
                nth += k
            take = pa.array(np.concatenate([np.zeros(0, np.int64), *at]).astype(np.int64))
            d = np.concatenate(digests)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array(start, pa.int32()), pa.array(size, pa.int32())]
                + [pa.array(np.ascontiguousarray(d[:, k])) for k in (0, 1)]
                + [pa.array(nth, pa.int32())],
                names=names,
            )

    binary = rows.select("row", "doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    return binary.mapInArrow(run, f"row bigint, doc_id {kind}, start int, words int, d0 bigint, d1 bigint, nth int")


def _text_hash(text: str):
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def repeated_spans(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    min_words: int = MIN_WORDS,
    scratch: Scratch | None = None,
) -> DataFrame:
    """Passages that an earlier document has too: row (the text's hash; a document is known by it and its id),
    doc_id, start, end (word numbers, end exclusive), n_words and first_doc_id, which has the same words in a row.

    The document of the smallest doc_id keeps a passage; it is a repeat in all others (null ids come last;
    passages of null ids alone are kept). Rows of one doc_id are one document: they do not repeat each other.
    Null and empty texts have no chunks; rows of one id and one text give each span once. Spans within longer ones are
    left out; spans may overlap where their words have different first documents.
    """
    scratch = scratch or Scratch(docs.sparkSession, "substring")
    rows = docs.select(_text_hash(text).alias("row"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    chunks = scratch.save(chunk_table(rows), "chunks")
    shared = chunks.groupBy("d0", "d1").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count("*").alias("n"), F.count("doc_id").alias("ids"))
    shared = shared.filter((F.col("hi") > F.col("lo")) | ((F.col("ids") < F.col("n")) & F.col("lo").isNotNull()))
    shared = scratch.save(shared.select("d0", "d1", "lo"), "shared")
    all_of = scratch.save(chunks.join(shared, ["d0", "d1"]), "occurrences")
    scratch.drop(chunks, shared)
    # places in the first document: of one text, if several rows have its id
    places = all_of.filter(F.col("doc_id") == F.col("lo")).groupBy("d0", "d1", "row").agg(F.slice(F.sort_array(F.collect_set("start")), 1, PLACES).alias("at"))
    first = places.groupBy("d0", "d1").agg(F.min("row").alias("row0"), F.min_by("at", "row").alias("at"))
    first = scratch.save(first, "first")
    later = all_of.filter(F.col("doc_id").isNull() | (F.col("doc_id") > F.col("lo"))).withColumn("idh", F.xxhash64("doc_id"))
    later = scratch.save(later.dropDuplicates(["row", "idh", "start"]), "later")
    scratch.drop(all_of)
    placed = later.join(first, ["d0", "d1"]).withColumn("at0", F.get("at", F.pmod(F.col("nth"), F.size("at"))))
    placed = placed.select("row", "idh", "doc_id", "start", (F.col("start") + F.col("words")).alias("end"), "lo", "row0", "at0")
    of_doc = Window.partitionBy("row", "idh").orderBy("start")  # a document's own marked chunks
    before = lambda c: F.lag(c).over(of_doc)
    follows = (before("end") == F.col("start")) & (before("lo") == F.col("lo")) & (before("row0") == F.col("row0"))
    follows &= before(F.col("at0") + F.col("end") - F.col("start")) == F.col("at0")
    marked = placed.withColumn("new", F.when(follows, 0).otherwise(1)).withColumn("run", F.sum("new").over(of_doc))
    runs = marked.groupBy("row", "idh", "run").agg(
        F.min("doc_id").alias("doc_id"), F.min("start").alias("start"), F.max("end").alias("end"), F.min("lo").alias("lo"), F.min("row0").alias("row0"), F.min("at0").alias("at0")
    )
    # a rim need not be read where a run that is long enough goes on from another, nor beyond the next run of one passage
    long = F.col("end") - F.col("start") >= min_words
    beside = lambda f, mine, its: F.coalesce(long & f(long).over(of_doc) & (f(its).over(of_doc) == F.col(mine)), F.lit(False))
    runs = runs.withColumns({"diagonal": F.col("at0") - F.col("start"), "told_left": beside(F.lag, "start", "end"), "told_right": beside(F.lead, "end", "start")})
    along = ["row", "idh", "row0", "lo", "diagonal"]
    of_pair = Window.partitionBy(*along).orderBy("start")
    far = F.lit(1 << 30)
    runs = runs.withColumns({"most_left": F.coalesce(F.col("start") - F.lag("end").over(of_pair), far), "most_right": F.coalesce(F.lead("start").over(of_pair) - F.col("end"), far)})
    runs = scratch.save(runs, "runs")
    scratch.drop(later, first)
    wider = _widened(docs, doc_id, text, runs, scratch)
    wide = runs.join(wider, ["row", "idh", "run"], "left").select(
        *along, "doc_id", (F.col("start") - F.coalesce("left", F.lit(0))).alias("start"), (F.col("end") + F.coalesce("right", F.lit(0))).alias("end")
    )
    # runs that have met are one passage
    apart = F.when(F.lag("end").over(of_pair) >= F.col("start"), 0).otherwise(1)
    met = wide.withColumn("apart", apart).withColumn("passage", F.sum("apart").over(of_pair))
    found = met.groupBy(*along, "passage").agg(F.min("doc_id").alias("doc_id"), F.min("start").alias("start"), F.max("end").alias("end"))
    found = found.filter(F.col("end") - F.col("start") >= min_words)
    ahead = Window.partitionBy("row", "idh").orderBy("start", F.col("end").desc(), "lo").rowsBetween(Window.unboundedPreceding, -1)
    spans = found.withColumn("reached", F.max("end").over(ahead)).filter("reached is null or end > reached")
    return spans.select("row", "doc_id", "start", "end", (F.col("end") - F.col("start")).alias("n_words"), F.col("lo").alias("first_doc_id"))


def _near(words: list[bytes], side: int, at: int, reach: int) -> list[int]:
    """Hashes of up to ``reach`` words from word ``at`` on (side 1) or before it (side -1), nearest first."""
    near = words[at : at + reach] if side > 0 else words[max(0, at - reach) : at][::-1]
    return [xxhash.xxh3_64_intdigest(w) - 2**63 for w in near]


def _read_around(texts: DataFrame, asks: DataFrame) -> DataFrame:
    """``asks`` (row, idh, side, here, words and more) with ``near``, the hashes of so many words; ``texts`` has row, idh and __text (binary).

    A text's asks travel with it as one array.
    """
    more = [c for c in asks.columns if c not in ("row", "idh")]
    kinds = dict(asks.dtypes)
    asked = asks.groupBy("row", "idh").agg(F.collect_list(F.struct(*more)).alias("asks"))  # of one document
    met = texts.join(asked.hint("merge"), ["row", "idh"]).select("row", "idh", "asks", "__text")

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            lists = b.column(2)
            counts = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten()
            side, here, size = (flat.field(c).to_pylist() for c in ("side", "here", "words"))
            out, k = [], 0
            for n, body in zip(counts.tolist(), b.column(3), strict=True):
                words = body.as_py().split()
                out += [_near(words, side[j], here[j], size[j]) for j in range(k, k + n)]
                k += n
            take = pa.array(np.repeat(np.arange(len(counts)), counts))
            fields = [flat.field(c) for c in more]
            yield pa.RecordBatch.from_arrays([b.column(0).take(take), b.column(1).take(take), *fields, pa.array(out, pa.list_(pa.int64()))], names=["row", "idh", *more, "near"])

    return met.mapInArrow(run, ", ".join(["row bigint", "idh bigint", *[f"{c} {kinds[c]}" for c in more], "near array<bigint>"]))


def _widened(docs: DataFrame, doc_id: str, text: str, runs: DataFrame, scratch: Scratch) -> DataFrame:
    """row, idh, run, left, right: by how many words the runs go on that are not told to end (null on a side that is).

    Texts are read once a time for both documents of a rim. After the first time few are left to read: a Bloom filter
    of them (bounded, see :mod:`url_filter`) keeps the others from being moved.
    """
    texts = docs.select(_text_hash(text).alias("row"), F.xxhash64(doc_id).alias("idh"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("__text"))
    rim = lambda s, told, at, at0, most: F.when(~told & (at > 0) & (at0 > 0), F.struct(F.lit(s).alias("side"), at.alias("here"), at0.alias("there"), most.alias("most")))
    left = rim(-1, F.col("told_left"), F.col("start"), F.col("at0"), F.col("most_left"))
    right = rim(1, F.col("told_right"), F.col("end"), F.col("end") + F.col("diagonal"), F.col("most_right"))
    going = runs.select("row", "idh", "run", "row0", F.xxhash64("lo").alias("idh0"), F.explode(F.array_compact(F.array(left, right))).alias("r"))
    columns = ["row", "idh", "run", "row0", "idh0", "side", "here", "there", "most", "n"]
    going = scratch.save(going.select("row", "idh", "run", "row0", "idh0", "r.*", F.lit(0).alias("n")).select(*columns), "going")
    done, reach, first = [], REACH, True
    while not going.isEmpty():
        theirs = going.select(F.col("row0").alias("row"), F.col("idh0").alias("idh"), "side", F.col("there").alias("here")).distinct()
        none = {c: F.lit(None).cast(t) for c, t in going.dtypes if c not in theirs.columns}
        asks = going.withColumn("words", F.least(F.lit(reach), F.col("most"))).unionByName(theirs.withColumns(none | {"words": F.lit(reach)}))
        read = texts
        if not first:
            keys = scratch.save(asks.select("row").distinct(), "asked")
            blocks = block_count(keys.count(), 16, 1 << 18)
            read = probe_filter(texts, "row", build_filter(keys, "row", blocks), blocks, "__asked").filter("__asked").drop("__asked")
        near = scratch.save(_read_around(read, asks.select("row", "idh", *[c for c in asks.columns if c not in ("row", "idh")])), "near")
        its = near.filter("run is null").select(F.col("row").alias("row0"), F.col("idh").alias("idh0"), "side", F.col("here").alias("there"), F.col("near").alias("its"))
        its = its.dropDuplicates(["row0", "idh0", "side", "there"])  # repeated rows answer as often
        differs = F.expr("array_position(zip_with(near, its, (x, y) -> coalesce(x = y, x is null)), false)")  # 0: nowhere
        got = F.when(differs > 0, differs - 1).otherwise(F.size("near")).cast("int")
        met = near.filter("run is not null").join(its, ["row0", "idh0", "side", "there"]).withColumn("got", got)
        step = F.col("side") * F.col("got")
        moved = {"here": F.col("here") + step, "there": F.col("there") + step, "most": F.col("most") - F.col("got"), "n": F.col("n") + F.col("got")}
        met = met.select(*[moved.get(c, F.col(c)).alias(c) for c in columns], ((F.col("got") == reach) & (F.col("most") > reach)).alias("on"))
        met = scratch.save(met.distinct(), "widened")
        scratch.drop(going, near)
        done.append(met.filter("NOT on").drop("on"))
        going, first = met.filter("on").drop("on"), False
        reach *= 4
    out = done[0] if done else going
    for df in done[1:]:
        out = out.unionByName(df)
    by = lambda s: F.max(F.when(F.col("side") == s, F.col("n")))
    return out.groupBy("row", "idh", "run").agg(by(-1).alias("left"), by(1).alias("right"))


def cut_words(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans and the white space after each; spans may overlap."""
    at = [m.span() for m in WORDS.finditer(text)]
    out, done = [], 0
    for a, b in sorted(spans):
        begin, end = at[a][0], at[b][0] if b < len(at) else len(text)
        if begin > done:
            out.append(text[done:begin])
        done = max(done, end)
    out.append(text[done:])
    return "".join(out)


def remove_repeats(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", n_chars: str | None = "n_chars", **options) -> DataFrame:
    """``docs`` without its repeated passages, columns as they are; ``n_chars``, where there is one, is counted anew.

    Documents of which no word is left are dropped; documents that had none to begin with stay.
    """
    scratch = Scratch(docs.sparkSession, "substring-cut")
    spans = repeated_spans(docs, doc_id=doc_id, text=text, scratch=scratch, **options)
    spans = spans.groupBy("row", "doc_id").agg(F.collect_list(F.struct("start", "end")).alias("__spans"))  # of one document
    spans = scratch.save(spans.select(F.col("row").alias("__row"), F.col("doc_id").alias("__id"), "__spans"), "spans")
    scratch.keep_only(spans)
    keyed = docs.withColumn("__row_at", _text_hash(text))
    same = (F.col("__row_at") == F.col("__row")) & F.col(doc_id).eqNullSafe(F.col("__id"))
    joined = keyed.join(spans.hint("merge"), same, "left").select(*[F.col(f"`{c}`") for c in docs.columns], "__spans")
    names = [c for c in joined.columns if c != "__spans"]

    def run(batches: Iterator[pa.RecordBatch]):
        at, sp = joined_columns.index(text), joined_columns.index("__spans")
        for b in batches:
            texts = b.column(at).to_pylist()
            for i, s in enumerate(b.column(sp).to_pylist()):
                if s:
                    texts[i] = cut_words(texts[i], [(x["start"], x["end"]) for x in s])
            cols = [pa.array(texts, b.column(at).type) if c == text else b.column(joined_columns.index(c)) for c in names]
            yield pa.RecordBatch.from_arrays([*cols, pa.array([bool(s) for s in b.column(sp).to_pylist()])], names=[*names, "__cut"])

    joined_columns = joined.columns
    kinds = dict(joined.dtypes)
    out = joined.mapInArrow(run, ", ".join([f"`{c}` {kinds[c]}" for c in names] + ["__cut boolean"]))
    out = out.filter(~F.col("__cut") | (F.btrim(F.col(text), F.lit(SPACES)) != "")).drop("__cut")
    if n_chars and n_chars in docs.columns:
        out = out.withColumn(n_chars, F.char_length(text).cast(kinds[n_chars]))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
