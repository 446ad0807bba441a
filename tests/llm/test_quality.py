import re

import duckdb

from ripplebook.llm import quality, queries
from tests.llm.util import SCHEMA, awkward, empty, prose


def brute(text):
    text = text or ""
    ws = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams, cover = {}, set()
    for i in range(len(ws) - 2):
        grams.setdefault(tuple(ws[i : i + 3]), []).append(i)
    for at in grams.values():
        if len(at) > 1:
            cover.update(p for i in at for p in (i, i + 1, i + 2))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(cover))


def test_figures_against_brute_force(spark):
    texts = [(20, "a b c a b c a"), (21, "x\ny\nx\n \n \nx"), (22, "## a|b <c> $ % & *"), (23, prose(1, 60) + "\n" + prose(1, 60)), (24, "\x0b a\x0cb \u00a0 c\r\n")]
    got = quality.judge(awkward(spark, texts)).select("doc_id", "text", "quality").collect()
    for r in got:
        q = r.quality
        assert (q.n_words, q.word_chars, q.n_symbols, q.n_dup_lines, q.n_repeat_words) == brute(r.text), r.doc_id
    assert len(got) == 16


def test_sql_agrees(spark, tmp_path):
    texts = [(30 + k, prose(k, 70) + " #" * (8 * k)) for k in range(6)]
    awkward(spark, texts).filter("doc_id is not null").dropDuplicates(["doc_id"]).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, queries.op9_quality_rules(spark, str(tmp_path)).collect()))
    db = duckdb.connect()
    db.sql(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    assert got == sorted(db.sql(queries.ORACLE_SQL["op9_quality_rules"]).fetchall())
    assert any(r[-1] for r in got) and not all(r[-1] for r in got)


def test_filter_keeps_columns_and_rows(spark):
    df = awkward(spark)
    kept = quality.keep_good(df)
    assert kept.columns == df.columns
    want = sorted(str(r.doc_id) for r in quality.judge(df).filter("kept").collect())
    assert sorted(str(r.doc_id) for r in kept.collect()) == want and want.count("4") == 2
    assert quality.keep_good(empty(spark)).count() == 0 and quality.judge(empty(spark)).count() == 0
    assert SCHEMA.split(", ")[0] == "doc_id bigint"
