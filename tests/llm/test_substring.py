import pytest

from ripplebook.llm import substring as s
from tests.llm.util import awkward, empty, prose

PASSAGE = " ".join(f"passage{k}word" for k in range(60))


def planted():
    out = [(200 + k, f"{prose(50 + k, 40)} {PASSAGE} {prose(90 + k, 70)}") for k in range(8)]
    return out + [(300 + k, prose(300 + k, 150)) for k in range(20)]


def test_gear_is_the_rolling_hash():
    data = bytes(range(256)) * 2
    h, want = 0, []
    for b in data:
        h = (2 * h + int(s.GEAR[b])) % 2**32
        want.append(h)
    assert s.gear(data).tolist() == want and s.gear(b"").tolist() == []


def test_chunks_cover_and_resist_shifts():
    text = prose(1, 3000)
    starts, sizes, digests, nth = s.chunks_of(text.encode())
    assert starts[0] == 0 and all(a + n == b for a, n, b in zip(starts, sizes, starts[1:], strict=False)) and starts[-1] + sizes[-1] == 3000
    assert max(sizes) <= s.MAX and len(digests) == len(nth) == len(starts)
    moved = s.chunks_of(("some new words here " + text).encode())[2]
    same = set(map(bytes, digests)) & set(map(bytes, moved))
    assert len(same) > 0.95 * len(digests)


def test_planted_passages_are_found_whole(spark):
    rows = s.repeated_spans(awkward(spark, planted())).collect()
    by = {r.doc_id: r for r in rows if r.doc_id is not None and r.doc_id >= 200}
    assert set(by) == {201, 202, 203, 204, 205, 206, 207}
    for r in by.values():
        assert 200 <= r.first_doc_id < r.doc_id and abs(r.start - 40) <= 6 and abs(r.end - 100) <= 6
    whole = [r for r in rows if r.doc_id == 5]  # an exact copy of document 4, which stays
    assert sum(r.n_words for r in whole) == 120 and not any(r.doc_id == 4 for r in rows)
    assert s.repeated_spans(empty(spark)).count() == 0


def test_removal(spark):
    df = awkward(spark, planted())
    out = s.remove_repeats(df)
    assert out.columns == df.columns
    rows = out.collect()
    text = {r.doc_id: r for r in rows}
    assert PASSAGE in text[200].text and not any("passage30word" in text[k].text for k in range(201, 208))
    assert 5 not in text and {1, 2, 3, 4, 6, 8, 9} <= set(text) and sum(r.doc_id == 4 for r in rows) == 2
    assert text[201].n_chars == len(text[201].text) and prose(300, 150) == text[300].text
    assert s.remove_repeats(empty(spark)).count() == 0


@pytest.mark.parametrize(("spans", "want"), [([(0, 1)], "b  c\nd"), ([(1, 3)], "a d"), ([(3, 4)], "a b  c\n"), ([(0, 4)], ""), ([(0, 2), (1, 3)], "d"), ([], "a b  c\nd")])
def test_cut_words(spans, want):
    assert s.cut_words("a b  c\nd", spans) == want


def test_passages_are_found_to_their_last_word(spark):
    """Passages of 51 to 60 words at many offsets: each that shares a chunk at all is given from its first word to its last."""
    rows, want = [], {}
    for k in range(60):
        size, at = 51 + k % 10, 30 + 3 * k % 41
        passage = " ".join(f"{w}{k}" for w in prose(7000 + k, size).split())
        own = lambda j: " ".join(f"{w}own{j}" for w in prose(8000 + j, 150).split())
        for j in (2 * k, 2 * k + 1):
            words = own(j).split()
            cut = at if j % 2 else 20 + k % 7
            rows.append((j, " ".join(words[:cut] + passage.split() + words[cut:])))
        want[2 * k + 1] = (at, at + size, 2 * k)
    got = s.repeated_spans(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {(r.start, r.end, r.first_doc_id) == want[r.doc_id] for r in got} == {True}
    assert len({r.doc_id for r in got}) >= 59  # one missed would hold no whole chunk


def test_rims_go_on_beyond_one_reading(spark, monkeypatch):
    monkeypatch.setattr(s, "REACH", 2)
    passage = " ".join(f"{w}z" for w in prose(7100, 57).split())
    rows = [(k, f"{prose(7200 + k, 31 + 5 * k)} {passage} {prose(7300 + k, 40)}") for k in range(4)]
    got = s.repeated_spans(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r.doc_id, r.start, r.end) for r in got) == [(k, 31 + 5 * k, 88 + 5 * k) for k in (1, 2, 3)]


def brute(rows, size):
    """For each document, the words in a run of ``size`` that a document of smaller id has too."""
    lowest = {}
    texts = [(i, (t or "").split()) for i, t in rows]
    for i, w in texts:
        for k in range(len(w) - size + 1):
            key = hash(tuple(w[k : k + size]))
            lowest[key] = min(lowest.get(key, i), i)
    out = {}
    for i, w in texts:
        held = set()
        for k in range(len(w) - size + 1):
            if lowest[hash(tuple(w[k : k + size]))] < i:
                held.update(range(k, k + size))
        out[i] = held
    return out


@pytest.mark.parametrize(("sf", "n"), [("0.001", 200), ("0.01", 1000)])
def test_spans_against_all_word_runs(spark, sf, n):
    """No span is absent from the document it names; of words in long repeats nearly all are found, of words in no repeat none."""
    docs = spark.read.parquet(f"/root/testdata/sf{sf}/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert len(rows) == n
    words = {i: (t or "").split() for i, t in rows}
    flat = {i: " " + " ".join(w) + " " for i, w in words.items()}
    found = {i: set() for i in words}
    for r in s.repeated_spans(docs).collect():
        assert r.first_doc_id < r.doc_id and r.n_words == r.end - r.start >= s.MIN_WORDS
        assert " " + " ".join(words[r.doc_id][r.start : r.end]) + " " in flat[r.first_doc_id]
        found[r.doc_id].update(range(r.start, r.end))
    true, long = brute(rows, s.MIN_WORDS), brute(rows, 51)
    assert all(found[i] <= true[i] for i in words)
    share = lambda want: sum(len(want[i] & found[i]) for i in words) / sum(map(len, want.values()))
    print(share(true), share(long))
    assert share(long) > 0.995 and share(true) > 0.97


def test_two_short_repeats_side_by_side_are_no_long_one(spark):
    """Passages of 14 words from two documents meet in a third: neither is a repeat of 20 words, nor are both together."""
    a, b = ([f"{w}{k}" for k, w in enumerate(prose(seed, 14).split())] for seed in (7400, 7401))
    rows = [(1, " ".join([*prose(7402, 40).split(), *a, *prose(7403, 40).split()])), (2, " ".join([*prose(7404, 40).split(), *b, *prose(7405, 40).split()]))]
    rows.append((3, " ".join([*prose(7406, 40).split(), *a, *b, *prose(7407, 40).split()])))
    assert s.repeated_spans(spark.createDataFrame(rows, "doc_id bigint, text string")).count() == 0


def test_repeated_lines_within_documents(spark):
    """One line over and over: the later document's copies are found although the first has fewer, and passages stay true."""
    line = " ".join(f"w{k}" for k in range(13))
    rows = [(1, prose(7500, 30) + "\n" + "\n".join([line] * 30)), (2, "\n".join([line] * 100) + "\n" + prose(7501, 30)), (3, "buy " * 3000), (4, "buy " * 5000)]
    got = s.repeated_spans(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    flat = {i: " " + " ".join(t.split()) + " " for i, t in rows}
    covered = {2: set(), 4: set()}
    for r in got:
        assert " " + " ".join(rows[r.doc_id - 1][1].split()[r.start : r.end]) + " " in flat[r.first_doc_id]
        covered[r.doc_id].update(range(r.start, r.end))
    assert len(covered[2]) > 1200 and len(covered[4]) > 4900
