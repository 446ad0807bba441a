import random

import pytest

from ripplebook.llm import toxicity as t
from ripplebook.llm.queries import op4_toxicity
from tests.llm.util import awkward, empty, prose


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@pytest.mark.parametrize("seed", range(5))
def test_automaton_against_distances(seed):
    rng = random.Random(seed)
    terms = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(3, 11))) for _ in range(12)})
    trie = t.Trie(dict.fromkeys(terms, False))
    for _ in range(400):
        w = "".join(rng.choice("abc") for _ in range(rng.randint(2, 12)))
        near = [(d, x) for x in terms if (d := distance(w, x)) <= min(t.edit_budget(len(w)), t.edit_budget(len(x)))]
        best = min(near, default=None) if t.edit_budget(len(w)) else None
        got = trie.fuzzy(w)
        assert (got and (got[1], got[0])) == best
        assert trie.exact(w) == (w if w in terms else None)


def sample():
    texts, labels = [], []
    for i in range(400):
        y = int(i % 5 == 0)
        words = prose(i, 40).split()
        if y:
            for k in range(2):
                words.insert(3 + 9 * k, random.Random(i + k).choice(["frobnicator", "zarglebad"]))
        texts.append(" ".join(words))
        labels.append(y)
    return texts, labels


def test_learned_terms_misspellings_and_quotes():
    model = t.learn(*sample())
    assert {"frobnicator", "zarglebad"} == set(model.weights) and not any(model.stems.values())
    s = t.Scorer(model)
    plain, wrong = s.evidence("you frobnicator"), s.evidence("you frobnicater")
    quoted, clean = s.evidence('he wrote "frobnicator" once'), s.evidence("a quiet garden")
    assert plain > wrong > clean == (0.0, 0.0) and quoted < s.evidence("a frobnicator once")
    assert s.evidence("") == (0.0, 0.0) and t.Scorer(t.Model()).evidence("x") == (0.0, 0.0)


def test_disguised_and_misspelled_inflections():
    """Inflections of a stem are matched with edits, and digits or symbols within words as the letters they look like."""
    texts, labels = [], []
    for i in range(600):
        words, y = prose(i, 40).split(), int(i % 3 == 0)
        if y:
            words[5] = ["zarglers", "zargling", "zarglesome"][i // 3 % 3]
        texts.append(" ".join(words))
        labels.append(y)
    s = t.Scorer(t.learn(texts, labels))
    assert any(s.model.stems.values()) and {"zarglers", "zargling", "zarglesome"} <= set(s.model.weights)
    hit = lambda text: s.evidence(text)[0]
    assert hit("a zarglefoo") > 0 and 0 < hit("a sargling") < hit("a zargling") and hit("a quiet garden") == 0
    assert 0 < hit("a z4rgl1ng") < hit("a zargling") and hit("a zarg*ling") > 0 and hit("garden!zargling") == hit("garden zargling")
    assert hit("a3b rock+roll 12 5 o'clock") == 0


def test_scores(spark):
    model = t.learn(*sample())
    got = t.score(awkward(spark, [(50, "you frobnicator you zarglebad")]), model).collect()
    assert len(got) == 12 and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r.score for r in got}
    assert by[50] > 0.5 > by[1] == by[2] == min(by.values())
    assert t.score(empty(spark), model).count() == 0
    none = t.learn([], [])
    assert all(r.score < 0.5 for r in t.score(awkward(spark), none).collect())


def test_held_out(spark):
    got = op4_toxicity(spark, "/root/testdata/sf0.1").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").filter("held_out").collect()
    hits, toxic, named = sum(r.predicted == r.toxic == 1 for r in got), sum(r.toxic == 1 for r in got), sum(r.predicted for r in got)
    print(hits, toxic, named, len(got))
    assert hits >= 0.9 * toxic > 50 and hits >= 0.95 * named


def test_an_id_of_both_labels_and_of_several_texts(spark):
    docs = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c"), (3, "d" * 50), (4, None)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 0), (2, 0), (3, 1), (4, 1), (None, 1)], "doc_id bigint, toxic int")
    texts, marks, share = t.training_sample(docs, labels, 10, doc_id="doc_id", text="text", label="toxic")
    assert (texts, marks) == (["a", "c", "d" * 50], [1, 0, 1]) and share == 0.75


def test_context_factors_follow_the_sample():
    """Where quoted terms are always clean and bare ones toxic, quoting takes nearly all of a hit's weight; where it tells nothing, it takes less than at first."""

    def rows(quoted_is_clean):
        out = []
        for i in range(600):
            words, y = prose(i, 30).split(), int(i % 3 == 0)
            quoted = (not y) if quoted_is_clean else i % 2 == 0
            if y or i % 3 == 1 and quoted_is_clean:
                words.insert(9, '"frobnicator"' if quoted else "frobnicator")
            out.append((" ".join(words), y))
        return zip(*out, strict=True)

    base = t.Model().factors
    seen = lambda texts, m: [t.Scorer(m).found(x) for x in texts]
    lexicon = t.Model({"frobnicator": 3.0}, {"frobnicator": False})
    for clean in (True, False):
        texts, y = rows(clean)
        y = t.np.asarray(y, float)
        factors, _ = t._fitted(seen(texts, lexicon), y, t.np.ones(len(y)), base)
        assert (factors[0] == min(t.CHOICES[0]) if clean else factors[0] > base[0]) and factors[2:] == base[2:]


def test_columns_kept(spark):
    model = t.learn(*sample())
    df = awkward(spark)
    assert t.score(df, model).columns == [*[c for c in df.columns if c != "score"], "score"]
    assert t.score(df, model, keep=["doc_id"]).columns == ["doc_id", "score"]


def test_no_labels(spark, tmp_path):
    awkward(spark).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, None), (None, 1)], "doc_id bigint, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert {r.predicted for r in op4_toxicity(spark, str(tmp_path)).collect()} == {0}
