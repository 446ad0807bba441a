"""Chat formatting: a hidden Markov model over marker and line features, decoded by Viterbi.

Input is raw transcript text in parts (transcript id, order, text); a part may hold any number of lines
or turns. States are (role, first line of a turn or a further one); a line's observation is its speaker
marker, whether a blank line stands before it, whether it asks, its length and its first letter. Counts
over a bounded sample of transcripts with known roles give the probabilities.

Transcripts of any length are decoded exactly without meeting in one task. Lines leave the scan as one byte
each, the code of their features; these are range-partitioned by transcript and order and cut into blocks. A block's
best scores between any two states form a matrix, matrices of a transcript's blocks are chained (one small
row a block) to find the state in which each block is entered and left, and then every block is decoded on its
own. Texts are moved twice, when a part meets the states of its lines and when the parts of a turn meet.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ripplebook.llm.common import Scratch

ROLES = ("system", "user", "assistant")
#: Names that speakers go by, fixed values.
SPEAKERS = {
    "system": "system sys context instructions setup",
    "user": "user human you question q prompt customer client instruction input me",
    "assistant": "assistant ai bot model answer a gpt response agent output reply",
}
_NAMES = {n: r for r, names in SPEAKERS.items() for n in names.split()}
#: A marker: a name between brackets, bars, hashes or asterisks, or before a colon.
MARKER = re.compile(
    r"^\s*(?:(?:<\|?|\[|\(|#{1,6}\s*|\*\*)\s*(?P<a>[^\W\d_]{1,14})\s*(?:\|?>|\]|\)|\*\*|:)\s*:?|(?P<b>[^\W\d_]{1,14})\s*[:>])\s?(?:\*\*)?", re.UNICODE
)
#: Lines of one block; a transcript longer than that is decoded in several.
BLOCK_LINES = 4096
#: State 2r is the first line of a turn of role r, 2r + 1 a further line.
STATES = 2 * len(ROLES)
#: How many values each feature has: marker (none, role, other name), blank before, question, length, first letter.
SIZES = (len(ROLES) + 2, 2, 2, 3, 3)
CODES = int(np.prod(SIZES))
#: What each feature's value counts in a line's code.
PLACES = tuple(int(np.prod(SIZES[k + 1 :])) for k in range(len(SIZES)))
BLANK = PLACES[1]


def observe(line: str, blank_before: bool) -> tuple[tuple[int, ...], str]:
    """(feature values, the line without its marker). A marker of an unknown name stays in the line."""
    mark, content = 0, line
    if m := MARKER.match(line):
        name = (m["a"] or m["b"]).lower()
        if name in _NAMES:
            mark, content = 1 + ROLES.index(_NAMES[name]), line[m.end() :]
        else:
            mark = len(ROLES) + 1
    body = content.strip()
    first = 0 if not body else 1 if body[0].isupper() else 2
    length = 0 if len(body) < 40 else 1 if len(body) < 120 else 2
    return (mark, int(blank_before), int(body.endswith("?")), length, first), content


@dataclass
class Model:
    start: np.ndarray  # log probability of a transcript's first state
    move: np.ndarray  # of the next state, by state
    emit: list[np.ndarray]  # of each feature's value, by state

    def scores(self, features: np.ndarray) -> np.ndarray:
        """(lines, states) log probabilities of the observed features."""
        return sum(e[:, features[:, k]].T for k, e in enumerate(self.emit))

    def code_scores(self) -> np.ndarray:
        """(CODES, states) the same for each code of a line."""
        return self.scores(np.column_stack(np.unravel_index(np.arange(CODES), SIZES)))


def code(values: tuple[int, ...]) -> int:
    return sum(v * p for v, p in zip(values, PLACES, strict=True))


def lines_of(text: str) -> tuple[list[str], list[int], bool]:
    """(lines that are not blank, blank lines before each, whether the text ends in a blank line)."""
    lines, gaps, gap = [], [], 0
    for line in text.split("\n"):
        if line.strip():
            lines.append(line)
            gaps.append(gap)
            gap = 0
        else:
            gap += 1
    return lines, gaps, gap > 0


def learn(transcripts: list[list[tuple[str, str]]]) -> Model:
    """Counts with add-one smoothing over transcripts given as (role, raw part of one turn) lists."""
    start, move = np.ones(STATES), np.full((STATES, STATES), 0.1)
    emit = [np.ones((STATES, n)) for n in SIZES]
    for r in range(len(ROLES)):  # what is possible without any example: go on, or hand over
        start[2 * r + 1] = 1e-6
        for q in range(len(ROLES)):
            if q != r:
                move[2 * q : 2 * q + 2, 2 * r + 1] = 1e-6  # a turn's further line follows a line of its role only
        # the marker that names a role speaks for it
        emit[0][2 * r, 1 + r] += 20
        emit[0][2 * r + 1, 0] += 20
        emit[0][2 * r + 1, 1 : 1 + len(ROLES)] = 0.02  # a further line hardly ever looks like a new turn
    for turns in transcripts:
        last, blank = None, False
        for role, text in turns:
            if role not in ROLES:
                continue
            new = True
            for line in text.split("\n"):
                if not line.strip():
                    blank = True
                    continue
                s = 2 * ROLES.index(role) + (not new)
                values, _ = observe(line, blank)
                for k, v in enumerate(values):
                    emit[k][s, v] += 1
                if last is None:
                    start[s] += 1
                else:
                    move[last, s] += 1
                last, new, blank = s, False, False
    log = lambda x: np.log(x / x.sum(axis=-1, keepdims=True))
    return Model(log(start), log(move), [log(e) for e in emit])


def transfer(model: Model, scores: np.ndarray) -> np.ndarray:
    """(from, to) best score of a block, entered after a line in state ``from``, its last line in ``to``."""
    m = model.move + scores[0]
    for s in scores[1:]:
        m = (m[:, :, None] + model.move[None]).max(axis=1) + s
    return m


def viterbi(model: Model, scores: np.ndarray, enter: np.ndarray, end: int | None) -> np.ndarray:
    """Best states of a block's lines; ``enter`` scores the first line's states, ``end`` fixes the last one."""
    n = len(scores)
    back = np.zeros((n, STATES), np.int8)
    v = enter + scores[0]
    for i in range(1, n):
        paths = v[:, None] + model.move
        back[i] = paths.argmax(axis=0)
        v = paths.max(axis=0) + scores[i]
    out = np.zeros(n, np.int8)
    out[-1] = int(v.argmax()) if end is None else end
    for i in range(n - 1, 0, -1):
        out[i - 1] = back[i, out[i]]
    return out


def chain(model: Model, matrices: list[np.ndarray]) -> tuple[list[np.ndarray | None], list[int]]:
    """(scores of the state before each block, None for the first; last state of each block) of the best path.

    The first matrix is (1, states): the first block's best scores from the transcript's start.
    """
    v = [matrices[0][0]]
    for m in matrices[1:]:
        v.append((v[-1][:, None] + m).max(axis=0))
    ends = [int(v[-1].argmax())]
    for k in range(len(matrices) - 1, 0, -1):
        ends.append(int((v[k - 1] + matrices[k][:, ends[-1]]).argmax()))
    return [None, *v[:-1]], ends[::-1]


def render_turn(role: Column, text: Column) -> Column:
    """The canonical form of a turn."""
    return F.concat(F.lit("<|im_start|>"), role, F.lit("\n"), text, F.lit("<|im_end|>\n"))


_PIECE = "key string, part {kind}, pid bigint, off int, obs binary, ends_blank boolean"


def _pieces(batches: Iterator[pa.RecordBatch], block_lines: int):
    """(key, part, pid, text) to codes of lines, ``block_lines`` a row; a part without lines is one row too."""
    for batch in batches:
        who, off, obs, ends = [], [], [], []
        for i, text in enumerate(batch.column(3).to_pylist()):
            lines, gaps, ends_blank = lines_of(text or "")
            codes = bytes(code(observe(x, g > 0)[0]) for x, g in zip(lines, gaps, strict=True))
            for k in range(0, max(1, len(codes)), block_lines):
                who.append(i)
                off.append(k)
                obs.append(codes[k : k + block_lines])
                ends.append(ends_blank and k + block_lines >= len(codes))
        at = pa.array(who, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c).take(at) for c in range(3)], pa.array(off, pa.int32()), pa.array(obs, pa.binary()), pa.array(ends, pa.bool_())],
            names=["key", "part", "pid", "off", "obs", "ends_blank"],
        )


_PLACED = "key string, pid bigint, off int, obs binary, seg int, blk int, pos int"


def _placed(batches: Iterator[pa.RecordBatch], block_lines: int):
    """Pieces in order to pieces with their block and place in it; a repeated piece is read once.

    Blank lines at the end of a part stand before the next part's first line. A last row (blk -1) tells whether the
    task's last transcript ended in a blank line.
    """
    seg = TaskContext.get().partitionId()
    names = [c.split()[0] for c in _PLACED.split(", ")]
    types = [pa.string(), pa.int64(), pa.int32(), pa.binary(), *[pa.int32()] * 3]
    key, blk, pos, blank, last = None, 0, 0, False, None

    def batch_of(rows: list[tuple]):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    for batch in batches:
        out = []
        for k, pid, off, obs, ends in zip(*[batch.column(c).to_pylist() for c in ("key", "pid", "off", "obs", "ends_blank")], strict=True):
            if (k, pid, off) == last:
                continue
            last = (k, pid, off)
            if k != key:
                key, blk, pos, blank = k, 0, 0, False
            if not obs:
                blank = True
                continue
            if blank and off == 0:
                obs = _after_blank(obs)
            done = 0
            while done < len(obs):  # a piece is no longer than a block, so it lies in two at most
                if pos >= block_lines:
                    blk, pos = blk + 1, 0
                some = obs[done : done + block_lines - pos]
                out.append((k, pid, off + done, some, seg, blk, pos))
                done, pos = done + len(some), pos + len(some)
            blank = ends
        if out:
            yield batch_of(out)
    if last is not None:
        yield batch_of([(key, None, None, None, seg, -1, int(blank))])


def _after_blank(obs: bytes) -> bytes:
    """The codes of lines of which the first has a blank line before it."""
    return obs if obs[0] // BLANK % 2 else bytes([obs[0] + BLANK]) + obs[1:]


def _edges(placed: DataFrame) -> dict[int, str]:
    """The transcript that each task goes on with after a blank line that another has seen; a row a task on the driver."""
    rows = sorted((r.seg, r.key, bool(r.pos)) for r in placed.filter("blk = -1").select("seg", "key", "pos").collect())
    return {after[0]: before[1] for before, after in zip(rows, rows[1:], strict=False) if before[2]}


def _by_block(batches: Iterator[pa.RecordBatch], n_keys: int = 3):
    """Tables of whole blocks, from batches sorted by their first ``n_keys`` columns."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_pylist() for k in range(n_keys)]
        keys = list(zip(*cols, strict=True))
        start = 0
        for i, k in enumerate(keys):
            if k != last:
                if i > start:
                    held.append(batch.slice(start, i - start))
                if held:
                    yield last, pa.Table.from_batches(held)
                held, last, start = [], k, i
        held.append(batch.slice(start))
    if held:
        yield last, pa.Table.from_batches(held)


def parse_transcripts(
    parts: DataFrame,
    model: Model,
    *,
    transcript_id: str = "conv_id",
    order: str = "part",
    text: str = "text",
    block_lines: int = BLOCK_LINES,
) -> DataFrame:
    """One row per recovered turn: the id, turn (from 0), role, text and rendered; other columns are not kept.

    A turn's text is its lines without the marker of its first line and without blank lines at either end; blank lines
    between lines of one part stay. Roles are those of ROLES: what others say is read as a turn, or as part of a
    turn, of one of them. Parts of one id are read in the order given (nulls first; parts of one order by a hash of their text,
    so the result does not depend on how rows are dealt out); parts that are equal in id, order and text are read once.
    A null id is an id like any other. Transcripts of blank lines only have no turns.
    """
    scratch = Scratch(parts.sparkSession, "chat")
    id_kind, order_kind = dict(parts.dtypes)[transcript_id], dict(parts.dtypes)[order]
    key = F.coalesce(F.concat(F.lit("v"), F.col(transcript_id).cast("string")), F.lit("null"))
    pid = F.xxhash64(F.col(order).isNull(), F.col(order), F.coalesce(F.col(text), F.lit("")))
    texts = parts.select(key.alias("key"), F.col(order).alias("part"), pid.alias("pid"), F.col(text).alias("text"))
    kind = _PIECE.format(kind=order_kind)
    pieces = scratch.save(texts.mapInArrow(lambda it: _pieces(it, block_lines), kind), "pieces")
    by = ["key", "part", "pid", "off"]
    ranged = pieces.repartitionByRange(*by).sortWithinPartitions(*by)
    placed = scratch.save(ranged.mapInArrow(lambda it: _placed(it, block_lines), _PLACED), "placed")
    scratch.drop(pieces)
    edges = _edges(placed)
    placed = placed.filter("blk >= 0")
    blocks = placed.select("key", "seg", "blk").distinct()
    several = scratch.save(blocks.groupBy("key").agg(F.count("*").alias("blocks")).filter("blocks > 1").select("key"), "several")
    told = model.code_scores()

    def scores(k: str, seg: int, blk: int, table: pa.Table) -> np.ndarray:
        obs = b"".join(table.column("obs").to_pylist())
        if blk == 0 and edges.get(seg) == k:
            obs = _after_blank(obs)
        return told[np.frombuffer(obs, np.uint8)]

    # transcripts of several blocks: a matrix a block, chained
    def matrices(batches: Iterator[pa.RecordBatch]):
        for (k, seg, blk), t in _by_block(batches):
            s = scores(k, seg, blk, t)
            m0 = (model.start + s[0])[None]
            for row in s[1:]:
                m0 = (m0[:, :, None] + model.move[None]).max(axis=1) + row
            yield pa.RecordBatch.from_arrays(
                [pa.array([k]), pa.array([seg], pa.int32()), pa.array([blk], pa.int32()), pa.array([m0.ravel().tolist()]), pa.array([transfer(model, s).ravel().tolist()])],
                names=["key", "seg", "blk", "first", "later"],
            )

    def dealt(df: DataFrame) -> DataFrame:
        return df.repartition("key", "seg", "blk").sortWithinPartitions("key", "seg", "blk", "pos")

    in_order = ["key", "seg", "blk", "pos", "pid", "off", "obs"]
    cut = dealt(placed.select(*in_order).join(several, "key", "left_semi"))
    mats = cut.mapInArrow(matrices, "key string, seg int, blk int, first array<double>, later array<double>")

    def chained(table: pa.Table) -> pa.Table:
        table = table.sort_by([("seg", "ascending"), ("blk", "ascending")])
        first, later = table.column("first").to_pylist(), table.column("later").to_pylist()
        ms = [np.array(first[0]).reshape(1, STATES), *[np.array(x).reshape(STATES, STATES) for x in later[1:]]]
        enter, ends = chain(model, ms)
        rows = [x.tolist() if x is not None else None for x in enter]
        out = table.select(["key", "seg", "blk"]).append_column("enter", pa.array(rows, pa.list_(pa.float64())))
        return out.append_column("end_state", pa.array(ends, pa.int32()))

    links = mats.groupBy("key").applyInArrow(chained, "key string, seg int, blk int, enter array<double>, end_state int")
    links = scratch.save(links, "links")

    def decode(batches: Iterator[pa.RecordBatch]):
        """Pieces with the states of their lines and the number of turns that start in the block before them (``k0``) and in them."""
        names = ["key", "seg", "blk", "pos", "pid", "off"]
        for (k, seg, blk), t in _by_block(batches):
            enter, end = t.column("enter")[0].as_py(), t.column("end_state")[0].as_py()
            first = model.start if enter is None else (np.array(enter)[:, None] + model.move).max(axis=0)
            states = viterbi(model, scores(k, seg, blk, t), first, end)
            if enter is None:
                states[0] &= ~1  # a transcript's first line starts a turn
            sizes = [len(x) for x in t.column("obs").to_pylist()]
            cuts = np.cumsum([0, *sizes])
            before = np.r_[0, np.cumsum(states % 2 == 0)][cuts]
            runs = [states[a:z].astype(np.uint8).tobytes() for a, z in zip(cuts, cuts[1:], strict=False)]
            new = [pa.array(runs, pa.binary()), pa.array(before[:-1], pa.int64()), pa.array(np.diff(before), pa.int64())]
            yield from pa.Table.from_arrays([*[t.column(c) for c in names], *new], names=[*names, "states", "k0", "starts"]).to_batches()

    joined = dealt(placed.select(*in_order).join(links, ["key", "seg", "blk"], "left"))
    decoded = joined.mapInArrow(decode, "key string, seg int, blk int, pos int, pid bigint, off int, states binary, k0 bigint, starts bigint")
    decoded = scratch.save(decoded, "states")
    # turns: starts within the block, plus those of the transcript's earlier blocks
    starts = decoded.join(several, "key", "left_semi").groupBy("key", "seg", "blk").agg(F.sum("starts").alias("n"))
    earlier = Window.partitionBy("key").orderBy("seg", "blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = scratch.save(starts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n"), "offsets")
    numbered = decoded.join(offsets, ["key", "seg", "blk"], "left").withColumn("turn0", F.col("k0") + F.coalesce("before", F.lit(0)) - 1)
    of_part = numbered.groupBy("key", "pid").agg(F.array_sort(F.collect_list(F.struct("off", "states", "turn0", "seg", "blk", "pos"))).alias("told"))
    of_part = scratch.save(of_part, "told")
    scratch.keep_only(of_part)
    met = texts.select("key", "pid", "text").join(of_part.hint("merge"), ["key", "pid"]).select("key", "text", "told")

    def fragments(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for k, body, told in zip(*[batch.column(c).to_pylist() for c in range(3)], strict=True):
                for row in _fragments(body, told):
                    for col, v in zip(out, (k, *row), strict=True):
                        col.append(v)
            types = [pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=["key", "turn", "seg", "blk", "pos", "role", "content"])

    shares = met.mapInArrow(fragments, "key string, turn bigint, seg int, blk int, pos int, role string, content string")
    # a set: what a repeated row gives again counts once
    grouped = shares.groupBy("key", "turn").agg(F.array_sort(F.collect_set(F.struct("seg", "blk", "pos", "role", "content"))).alias("x"))
    content = F.btrim(F.array_join(F.transform("x", lambda v: v["content"]), "\n"), F.lit(" \t\n\r"))
    ident = F.when(F.col("key") != "null", F.substring("key", F.lit(2), F.length("key"))).cast(id_kind)
    out = grouped.select(ident.alias(transcript_id), "turn", F.col("x")[0]["role"].alias("role"), content.alias("text"))
    return out.withColumn("rendered", render_turn(F.col("role"), F.col("text")))


def _fragments(body: str, told: list[dict]) -> Iterator[tuple[int, int, int, int, str, str]]:
    """(turn, block's task, block, place, role, text) of each turn's share of a part, from the states of its lines."""
    lines, gaps, _ = lines_of(body)
    held: list[str] = []
    at = None
    for piece in told:
        turn = piece["turn0"]
        for i, state in enumerate(piece["states"]):
            line, gap = lines[piece["off"] + i], gaps[piece["off"] + i]
            if state % 2 == 0:
                turn += 1
                line = observe(line, False)[1]
            if at is None or at[0] != turn:
                if at is not None:
                    yield (*at, "\n".join(held))
                held, at = [line], (turn, piece["seg"], piece["blk"], piece["pos"] + i, ROLES[state // 2])
            else:
                held += [""] * gap + [line]
    if at is not None:
        yield (*at, "\n".join(held))


#: Ways in which raw transcripts mark (system, user, assistant) turns; the last part is what ends a turn.
STYLES = (
    (("System: ", "User: ", "Assistant: "), ""),
    (("### System:\n", "### Instruction:\n", "### Response:\n"), "\n"),
    (("<|system|>", "<|user|>", "<|assistant|>"), ""),
    (("[SYS] ", "[HUMAN] ", "[AI] "), "\n"),
    (("**System:** ", "**Human:** ", "**Bot:** "), "\n"),
    (("Context: ", "Q: ", "A: "), ""),
)


def raw_parts(conversations: DataFrame) -> DataFrame:
    """(conv_id, part, text, role): clean conversations as raw transcripts, marked in a style that the id's hash
    picks, one marker in eight left out (never the first). Turns of roles other than ROLES, null ones included,
    have no marker. Other columns are not kept. Native."""
    style = F.pmod(F.xxhash64("conv_id"), F.lit(len(STYLES)))
    role = F.array_position(F.array(*[F.lit(r) for r in ROLES]), F.col("role"))
    mark, tail = F.lit(""), F.lit("")
    for s, (marks, end) in enumerate(STYLES):
        for r, m in enumerate(marks):
            mark = F.when((style == s) & (role == r + 1), F.lit(m)).otherwise(mark)
        tail = F.when(style == s, F.lit(end)).otherwise(tail)
    bare = (F.col("turn") > 0) & (F.pmod(F.xxhash64("conv_id", "turn"), F.lit(8)) == 0)
    body = F.coalesce("text", F.lit(""))
    return conversations.select(
        "conv_id", F.col("turn").alias("part"), F.concat(F.when(bare, "").otherwise(mark), body, tail).alias("text"), "role"
    )


#: Bounds of the sample: turns of a conversation, and characters of a turn (longer ones are no examples).
SAMPLE_TURNS, SAMPLE_CHARS = 32, 4096


def training_sample(conversations: DataFrame, bound: int) -> list[list[tuple[str, str]]]:
    """Raw turns with their roles of the ``bound`` conversations of the smallest id hash, SAMPLE_TURNS of each at most.

    Of several rows of one turn the least (role, text) counts, so the sample does not depend on how rows are dealt out.
    """
    ids = conversations.select("conv_id").filter("conv_id is not null").distinct().orderBy(F.xxhash64("conv_id"), "conv_id").limit(bound)
    picked = conversations.sparkSession.createDataFrame(ids.collect(), ids.schema)
    short = conversations.filter((F.col("turn") >= 0) & (F.col("turn") < SAMPLE_TURNS) & (F.length("text") <= SAMPLE_CHARS))
    rows = raw_parts(short.join(F.broadcast(picked), "conv_id")).groupBy("conv_id", "part").agg(F.min(F.struct("role", "text")).alias("t"))
    out: dict = {}
    for r in rows.select("conv_id", "part", "t.role", "t.text").collect():  # bound * SAMPLE_TURNS rows at most
        out.setdefault(r["conv_id"], []).append((r["part"], r["role"], r["text"]))
    return [[(role, text) for _, role, text in sorted(v, key=lambda x: x[0])] for _, v in sorted(out.items())]
