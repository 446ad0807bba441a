import random

from ripplebook.llm import langid
from ripplebook.llm.queries import op7_language_id
from tests.llm.util import awkward, empty


def sample():
    en = ["the house of the king and the queen", "walking under the bridge with them", "this thing that they thought was right"]
    de = ["das haus und die straße der stadt", "nicht ohne die größe zu wissen", "wir gehen durch den wald nach hause"]
    texts = [f"{t} {k}" for k in range(30) for t in en + de]
    return texts, ["en" if t.rsplit(" ", 1)[0] in en else "de" for t in texts]


def test_small_model():
    m = langid.learn(*sample())
    r = langid.Reader(m)
    assert r.predict("they thought the bridge was right")[0] == "en" and r.predict("die größe der straße")[0] == "de"
    assert r.predict(None) == r.predict("") == r.predict("12 34 !") == ("und", 0.0)
    assert r.predict("x")[1] <= r.predict("the house of the king and the queen")[1]
    empty_model = langid.learn([], [])
    assert langid.Reader(empty_model).predict("words")[0] == "und"


def test_rows(spark):
    m = langid.learn(*sample())
    got = langid.identify(awkward(spark), m).collect()
    assert len(got) == 11 and all(0 <= r.score <= 1 for r in got)
    assert {r.doc_id: r.lang_pred for r in got if r.doc_id in (1, 2, 3)} == {1: "und", 2: "und", 3: "und"}
    assert langid.identify(empty(spark), m).count() == 0


def test_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    got = op7_language_id(spark, "/root/testdata/sf0.01").join(docs, "doc_id").filter("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in got) / len(got) > 0.98


def test_rejection_and_calibration(spark):
    """Few texts of known languages are rejected, many of a made-up one; scores are about as right as they say."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    m = langid.learn(*langid.training_sample(docs.filter("doc_id % 2 = 0"), 300))
    rng = random.Random(5)
    strange = [(10**6 + k, " ".join("".join(rng.choice("bcdfghjklmnpqrstvwxz") for _ in range(rng.randint(3, 9))) for _ in range(12)), None) for k in range(100)]
    rows = langid.identify(docs.filter("doc_id % 2 = 1").unionByName(spark.createDataFrame(strange, docs.schema)), m).collect()
    known, made_up = [r for r in rows if r.doc_id < 10**6], [r for r in rows if r.doc_id >= 10**6]
    share = lambda some: sum(r.rejected for r in some) / len(some)
    print(m.threshold, m.temperature, share(known), share(made_up))
    assert share(known) < 0.06 and share(made_up) > 0.5
    assert all(r.rejected == (r.lang_pred == "und" or r.score < m.threshold) for r in rows)
    right = [r.lang_pred == r.lang for r in known if r.lang_pred != "und"]
    mean = sum(r.score for r in known if r.lang_pred != "und") / len(right)
    assert abs(mean - sum(right) / len(right)) < 0.05


def test_columns_kept_and_replaced(spark):
    m = langid.learn(*sample())
    df = awkward(spark).withColumnRenamed("score", "rejected").withColumnRenamed("root", "lang_pred")
    out = langid.identify(df, m)
    assert out.columns == [*[c for c in df.columns if c not in ("rejected", "lang_pred")], "lang_pred", "score", "rejected"]
    assert langid.identify(df, m, keep=["doc_id"]).columns == ["doc_id", "lang_pred", "score", "rejected"]


def test_the_sample_does_not_depend_on_partitions_and_is_bounded(spark, monkeypatch):
    rows = [(k, f"text number {k}", f"l{k % 3}") for k in range(600)] + [(10_000, "x" * 300, "l0")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    monkeypatch.setattr(langid, "SAMPLE_CHARS", 200)
    one, other = langid.training_sample(df.repartition(1), 50), langid.training_sample(df.repartition(7), 50)
    assert one == other and 60 < len(one[0]) <= 300 and "x" * 300 not in one[0]
    monkeypatch.setattr(langid, "MOST_LANGUAGES", 2)
    assert len(set(langid.training_sample(df, 50)[1])) == 2


def test_many_languages_take_no_more_memory(spark):
    names = [f"l{k}" for k in range(400)]
    r = langid.Reader(langid.Model(names, langid.np.zeros((langid.BUCKETS, 400)), langid.np.zeros(400)))
    assert r.sums.nbytes <= 8 * langid.CACHED_SCORES
    assert r.predict(" ".join(f"word{chr(97 + k % 26)}{k}x" for k in range(30_000)))[0] in names
