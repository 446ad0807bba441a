from itertools import product

import numpy as np
import pytest

from ripplebook.llm import chat


def model():
    turns = [("system", "System: be kind."), ("user", "User: what is it?\nI wonder."), ("assistant", "Assistant: A long answer follows here.\nAnd goes on."), ("user", "and then?"), ("assistant", "Assistant: Nothing.")]
    return chat.learn([turns, turns[1:]] * 10)


@pytest.mark.parametrize("seed", range(6))
def test_viterbi_and_chain_against_all_paths(seed):
    rng = np.random.default_rng(seed)
    m, n = model(), 5
    scores = m.scores(np.column_stack([rng.integers(0, k, n) for k in chat.SIZES]))
    total = lambda p: m.start[p[0]] + scores[0, p[0]] + sum(m.move[a, b] + scores[i, b] for i, (a, b) in enumerate(zip(p, p[1:], strict=False), 1))
    best = max(product(range(chat.STATES), repeat=n), key=total)
    assert tuple(chat.viterbi(m, scores, m.start, None)) == best
    parts = [scores[:2], scores[2:3], scores[3:]]
    first = (m.start + parts[0][0])[None]
    first = (first[:, :, None] + m.move[None]).max(axis=1) + parts[0][1]
    enter, ends = chat.chain(m, [first, *[chat.transfer(m, p) for p in parts[1:]]])
    path = []
    for p, e, z in zip(parts, enter, ends, strict=True):
        path += chat.viterbi(m, p, m.start if e is None else (e[:, None] + m.move).max(axis=0), z).tolist()
    assert total(path) == pytest.approx(total(best))


def test_codes_hold_all_features():
    codes = {chat.code(v) for v in product(*map(range, chat.SIZES))}
    assert codes == set(range(chat.CODES)) and chat.CODES < 256
    m = model()
    values = [v for v in product(*map(range, chat.SIZES))]
    assert np.allclose(m.code_scores()[[chat.code(v) for v in values]], m.scores(np.array(values)))


def test_awkward_parts(spark):
    rows = [(1, 0, "User: hello?\nmore text"), (1, 1, "Assistant: yes."), (1, 1, "Assistant: yes."), (2, 0, None), (2, 1, "\n \n"), (None, 0, "[HUMAN] who?"), (3, None, "Note: not a speaker"), (4, 0, "word " * 20_000)]
    df = spark.createDataFrame([(*r, "z") for r in rows], "conv_id bigint, part bigint, text string, key string")
    got = chat.parse_transcripts(df, model()).collect()
    by = {}
    for r in got:
        by.setdefault(r.conv_id, []).append((r.turn, r.role, r.text))
    # a row repeated in id, order and text is read once
    assert sorted(by[1]) == [(0, "user", "hello?\nmore text"), (1, "assistant", "yes.")]
    assert 2 not in by and by[None] == [(0, "user", "who?")] and by[3][0][2].startswith("Note: not")
    assert next(r for r in got if r.conv_id is None).rendered == "<|im_start|>user\nwho?<|im_end|>\n"
    assert chat.parse_transcripts(df.filter("false"), model()).count() == 0


def test_blank_lines_within_a_turn_stay(spark):
    text = "User: first\n\n\nsecond paragraph\n\nAssistant: an answer\n\n- with a list\n\n"
    rows = [(1, 0, text), (1, 1, "goes on here"), (1, 2, "\n\nUser: thanks, what now?")]
    turns = [("user", "User: a question\n\nwith two paragraphs"), ("assistant", "Assistant: an answer\n\n- and a list\nof things"), ("user", "User: well?")]
    df = spark.createDataFrame(rows, "conv_id bigint, part bigint, text string")
    got = sorted((r.turn, r.role, r.text) for r in chat.parse_transcripts(df, chat.learn([turns] * 20)).collect())
    assert got == [(0, "user", "first\n\n\nsecond paragraph"), (1, "assistant", "an answer\n\n- with a list\ngoes on here"), (2, "user", "thanks, what now?")]


def test_the_result_does_not_depend_on_how_rows_are_dealt_out(spark):
    """One, three and seven partitions, blocks of two lines, parts of one order with different texts, and blank lines at parts' edges."""
    c = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").filter("conv_id % 3 = 0")
    m = chat.learn(chat.training_sample(c, 50))
    parts = chat.raw_parts(c).drop("role")
    more = [(10**6, 0, "User: one?\n"), (10**6, 1, ""), (10**6, 2, "it is so"), (10**6, 2, "and so"), (10**6, 3, "more of it\n\n"), (10**6, 4, "Assistant: yes")]
    parts = parts.unionByName(spark.createDataFrame(more, "conv_id bigint, part bigint, text string"))
    want = sorted(map(tuple, chat.parse_transcripts(parts, m).collect()))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (1, 3, 7):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
            assert sorted(map(tuple, chat.parse_transcripts(parts.repartition(n), m, block_lines=2 if n > 1 else chat.BLOCK_LINES).collect())) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_roles_of_conversations_held_out(spark):
    """Learned on four in five conversations, judged on the others; and on their turns without a marker alone."""
    from pyspark.sql import functions as F

    from ripplebook.llm.common import crc_mod

    c = spark.read.parquet("/root/testdata/sf0.1/conversations.parquet")
    m = chat.learn(chat.training_sample(c.filter(crc_mod(F.col("conv_id"), 5) != 0), 2000))
    held = c.filter(crc_mod(F.col("conv_id"), 5) == 0)
    parts = chat.raw_parts(held)
    roles = {(r.conv_id, r.text): r.role for r in chat.parse_transcripts(parts.drop("role"), m).collect()}
    raw = parts.collect()
    unmarked = {(r.conv_id, r.part) for r in raw if chat.observe(r.text.split("\n")[0], False)[0][0] == 0}
    truth = [(r.conv_id, r.turn, r.role, r.text.strip()) for r in held.collect() if r.text and r.text.strip()]
    right = lambda rows: sum(roles.get((i, t)) == role for i, _, role, t in rows) / len(rows)
    bare = [r for r in truth if r[:2] in unmarked]
    print(len(truth), right(truth), len(bare), right(bare))
    assert len(bare) > 50 and right(truth) > 0.9


def test_roles_of_other_names_and_null_roles(spark):
    rows = [(1, 0, "user", "what?"), (1, 1, "tool", "some output"), (1, 2, None, "nobody said it"), (1, 3, "assistant", "done.")]
    parts = chat.raw_parts(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).collect()
    assert [p.text.strip() for p in sorted(parts, key=lambda p: p.part)][1:3] == ["some output", "nobody said it"]
    got = chat.parse_transcripts(spark.createDataFrame(parts).drop("role"), model()).collect()
    assert {r.role for r in got} <= set(chat.ROLES) and "some output" in " ".join(r.text for r in got)
