import re

import corpus_pipeline
from ripplebook.llm import queries
from tests.llm.util import awkward, prose


def test_stages_on_planted_rows(spark, tmp_path):
    """Each stage against what brute force says of its own input."""
    passage = prose(77, 70)
    texts = [(100 + k, prose(100 + k, 90)) for k in range(30)] + [(500, prose(100, 90)), (501, prose(101, 90).replace("river", "brook", 1))]
    texts += [(600, f"{prose(600, 60)} {passage} {prose(601, 60)}"), (601, f"{prose(602, 60)} {passage} {prose(603, 60)}"), (700, f"{prose(700, 80)} {prose(999, 40)} {prose(701, 80)}"), (800, "| a " * 90)]
    df = awkward(spark, texts).select("doc_id", "text", "lang", "source", "n_chars")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, prose(999, 40))], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, seen = df, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/out-{name}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/out-{name}")
        if name != "pack":
            assert docs.columns == before.columns
        seen[name] = {r.doc_id for r in docs.select("doc_id").collect()}
    assert not {1, 2, 3, 8, 9, 800} & seen["quality_rules"] and {100, 500, 600, 700} <= seen["quality_rules"]
    assert seen["quality_rules"] - seen["near_dedup"] == {5, 500, 501}
    assert seen["near_dedup"] == seen["substring_dedup"] and seen["substring_dedup"] - seen["decontaminate"] == {700}
    assert seen["pack"] == seen["decontaminate"]
    cut = {r.doc_id: r.text for r in spark.read.parquet(f"{tmp_path}/out-substring_dedup").collect()}
    assert passage in cut[600] and len(re.findall(r"\S+", cut[601])) <= 130
    again = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(map(str, again.select("doc_id", "piece", "ids_crc32").collect())) == sorted(map(str, docs.select("doc_id", "piece", "ids_crc32").collect()))


def test_every_operator_is_registered():
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{k}" for k in range(1, 11)]
    assert len(corpus_pipeline.STAGES) == 5
