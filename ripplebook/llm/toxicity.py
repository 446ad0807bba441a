"""Toxicity: a learned lexicon as a trie, walked with Levenshtein automata, scored by context windows.

Learning takes a bounded sample of labelled rows (``per_class`` a label, chosen by a hash of the id):
words and word beginnings that toxic documents share and clean ones lack become the lexicon. Scoring is
one pass over whole texts in Arrow batches: a word goes through the automaton of its length's edit
budget over the trie, so misspelled terms are caught; words that clean training texts use are never
taken for misspellings. Each hit weighs what its window says: quotation and reporting words lower it,
direct address raises it. A logistic curve, fitted on the sample, turns the sum into a score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORDS = re.compile(r"[^\W\d_]+")
#: Words that digits or symbols may stand within; what these are read as, and leave out (fixed values).
TOKENS = re.compile(r"[^\W\d_]+(?:[\d@$*!+]+[^\W\d_]+)*")
LOOKS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": None, "+": None, "2": None, "6": None, "8": None, "9": None})
#: Context cues, fixed values.
REPORTING = frozenset("said says wrote writes called calls quoted quote quotes term word words slur dit écrit mot sagte schrieb wort dijo escribió palabra".split())
ADDRESS = frozenset("you your you're youre u tu vous du ihr dich usted eres".split())
QUOTES = "\"'“”„«»‘’"
WINDOW = 6
#: Texts of more characters are no training examples.
SAMPLE_CHARS = 200_000
#: Words seen per task before the memory of them starts anew.
CACHE = 400_000


def edit_budget(n: int) -> int:
    """Edits that a word of ``n`` letters may differ by and still be a misspelling."""
    return 0 if n < 5 else 1 if n < 9 else 2


class Trie:
    """Terms as a trie, and the Levenshtein automaton of all of them, determinised as words need it.

    A state of the automaton is the set of (trie node, fewest edits) that a word's beginning can be at;
    transitions are remembered, so a word costs one dictionary look-up a letter and most words reach the
    empty state within a few letters.
    """

    def __init__(self, terms: dict[str, bool]):
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[tuple[str, bool] | None] = [None]
        self.budget = [0]  # of the terms below a node, the most edits that any allows
        for term, stem in terms.items():
            node, allowed = 0, 0 if stem else edit_budget(len(term))
            self.budget[0] = max(self.budget[0], allowed)
            for c in term:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.ends.append(None)
                    self.budget.append(0)
                node = self.children[node][c]
                self.budget[node] = max(self.budget[node], allowed)
            self.ends[node] = (term, stem)
        self.states: list[dict[int, int]] = []
        self.numbers: dict[frozenset, int] = {}
        self.moves: list[dict[str, int]] = []
        self.start = self._number(self._closed({0: 0}))

    def exact(self, word: str) -> str | None:
        """The term that is the word, or else the longest stem it begins with."""
        node, best = 0, None
        for k, c in enumerate(word):
            node = self.children[node].get(c)
            if node is None:
                return best
            if end := self.ends[node]:
                term, stem = end
                if stem or k + 1 == len(word):
                    best = term
        return best

    def _closed(self, at: dict[int, int]) -> dict[int, int]:
        """With the nodes that are reached by leaving out letters of terms."""
        todo = list(at)
        while todo:
            node = todo.pop()
            edits = at[node] + 1
            for child in self.children[node].values():
                if edits <= self.budget[child] and edits < at.get(child, 99):
                    at[child] = edits
                    todo.append(child)
        return at

    def _number(self, state: dict[int, int]) -> int:
        key = frozenset(state.items())
        if key not in self.numbers:
            self.numbers[key] = len(self.states)
            self.states.append(state)
            self.moves.append({})
        return self.numbers[key]

    def _move(self, number: int, c: str) -> int:
        out: dict[int, int] = {}

        def reach(node: int, edits: int) -> None:
            if edits <= self.budget[node] and edits < out.get(node, 99):
                out[node] = edits

        for node, edits in self.states[number].items():
            reach(node, edits + 1)  # a letter too many
            for letter, child in self.children[node].items():
                reach(child, edits + (letter != c))
        return self._number(self._closed(out))

    def fuzzy(self, word: str) -> tuple[str, int] | None:
        """(term, edits) of the nearest whole-word term within the budgets of word and term; ties: the smaller term."""
        budget = edit_budget(len(word))
        if not budget:
            return None
        number, moves = self.start, self.moves
        for c in word:
            after = moves[number].get(c)
            if after is None:
                after = moves[number][c] = self._move(number, c)
            number = after
            if not self.states[number]:
                return None
        found = [(e, self.ends[n][0]) for n, e in self.states[number].items() if self.ends[n] and not self.ends[n][1] and e <= min(budget, edit_budget(len(self.ends[n][0])))]
        if not found:
            return None
        edits, term = min(found)
        return term, edits


@dataclass
class Model:
    weights: dict[str, float] = field(default_factory=dict)  # of each term
    stems: dict[str, bool] = field(default_factory=dict)  # term -> whether words may go on after it
    clean: frozenset[str] = frozenset()  # near-terms that clean texts use
    unsafe: frozenset[str] = frozenset()  # terms that clean texts have many near-terms of: matched exactly only
    factors: tuple[float, float, float, float] = (0.3, 1.3, 0.7, 0.5)  # what a hit counts: reported or quoted, addressed, at one edit, at two
    curve: tuple[float, float, float] = (0.0, 0.0, -30.0)  # of log evidence, of log density, constant


#: What each factor may be; the model's own values are where fitting starts, and stay where the sample does not speak against them.
CHOICES = ((0.1, 0.3, 0.6, 1.0), (1.0, 1.3, 1.8), (0.4, 0.7, 1.0), (0.25, 0.5, 0.8))


#: A term met in a text: its weight, the edits, whether it is reported or quoted, whether someone is addressed.
Hit = tuple[float, int, bool, bool]


class Scorer:
    """Evidence of a text under a model; keeps a bounded memory of words seen."""

    def __init__(self, model: Model):
        self.model, self.trie = model, Trie(model.stems)
        self.none: set[str] = set()
        self.hits: dict[str, tuple[float, int]] = {}

    def weight(self, word: str) -> tuple[float, int]:
        """(weight, edits) of a term that the word is, goes on from or misspells; weight 0 for any other word.

        Digits and symbols within are read as the letters they look like, which is an edit at least; else the weightiest of the
        words between them counts.
        """
        if not word.isalpha():
            weight, edits = self.weight(word.translate(LOOKS))
            return (weight, max(1, edits)) if weight else max(map(self.weight, WORDS.findall(word)))
        m = self.model
        if term := self.trie.exact(word):
            return m.weights[term], 0
        if word not in m.clean and (near := self.trie.fuzzy(word)) and near[0] not in m.unsafe:
            return m.weights[near[0]], near[1]
        return 0.0, 0

    def evidence(self, text: str) -> tuple[float, float]:
        """(log evidence, log evidence a hundred words)."""
        hits, n_words = self.found(text)
        return evidence_of(hits, n_words, self.model.factors)

    def found(self, text: str) -> tuple[list[Hit], int]:
        """(hits in their context, number of words) of a text."""
        if not self.model.weights or not text:
            return [], 0
        low = text.lower()
        words = TOKENS.findall(low)
        found = False
        for w in set(words) - self.none:
            if w in self.hits:
                found = True
            elif (x := self.weight(w))[0] > 0:
                self.hits[w] = x
                found = True
            else:
                self.none.add(w)
        hits = self._in_context(low) if found else []
        if len(self.none) + len(self.hits) > CACHE:
            self.none.clear()
            self.hits.clear()
            self.trie = Trie(self.model.stems)
        return hits, len(words)

    def _in_context(self, low: str) -> list[Hit]:
        spans = [(m.group(), m.start(), m.end()) for m in TOKENS.finditer(low)]
        out: list[Hit] = []
        for k, (w, start, end) in enumerate(spans):
            if w not in self.hits:
                continue
            before = [s[0] for s in spans[max(0, k - WINDOW) : k]]
            after = [s[0] for s in spans[k + 1 : k + 1 + WINDOW]]
            quoted = low[start - 1 : start] in QUOTES and low[start - 1 : start] and low[end : end + 1] in QUOTES and low[end : end + 1]
            told = bool(quoted or REPORTING.intersection(before[-4:]))
            out.append((*self.hits[w], told, bool(ADDRESS.intersection(before[-3:] + after[:3]))))
        return out


def evidence_of(hits: list[Hit], n_words: int, factors: tuple[float, ...]) -> tuple[float, float]:
    """(log evidence, log evidence a hundred words) of hits under the factors of their contexts and edits."""
    told, addressed, *by_edits = factors
    total = sum(w * (told if t else 1) * (addressed if a else 1) * (by_edits[min(e, 2) - 1] if e else 1) for w, e, t, a in hits)
    return float(np.log1p(total)), float(np.log1p(100 * total / (n_words + 50)))


def _lexicon(texts: list[str], labels: list[int], min_docs: int, min_share: float, precision: float) -> Model:
    """Terms that toxic texts have and clean ones lack, weighed by log odds.

    A stem is taken if its words are several, none of which makes up most of it. Whole words are taken beside the stems they
    begin with, as only whole words are matched with edits.
    """
    n_toxic, n_clean = sum(labels), len(labels) - sum(labels)
    toxic: Counter[str] = Counter()
    clean: Counter[str] = Counter()
    for text, y in zip(texts, labels, strict=True):
        words = set(WORDS.findall(text.lower()))
        parts = {w + "$" for w in words} | {w[:k] for w in words for k in range(4, min(len(w), 9))}
        (toxic if y else clean).update(parts)
    least, rate = max(min_docs, min_share * n_toxic), n_toxic / max(1, n_clean)
    largest: Counter[str] = Counter()  # of each beginning, the documents of its most frequent word
    for p, t in toxic.items():
        if p.endswith("$"):
            for k in range(4, min(len(p) - 1, 8) + 1):
                largest[p[:k]] = max(largest[p[:k]], t)
    good = [p for p, t in toxic.items() if t >= least and t >= precision * (t + clean[p] * rate)]
    stems: dict[str, bool] = {}
    for p in sorted((p for p in good if not p.endswith("$") and largest[p] < 0.7 * toxic[p]), key=lambda p: (len(p), p)):
        if not any(p[:k] in stems for k in range(4, len(p))):
            stems[p] = True
    for p in sorted(p[:-1] for p in good if p.endswith("$")):
        stems.setdefault(p, False)
    odds = lambda p: float(np.log((toxic[p] + 0.5) / (n_toxic + 1)) - np.log((clean[p] + 0.5) / (n_clean + 1)))
    weights = {t: odds(t if stem else t + "$") for t, stem in stems.items()}
    trie, near, variants = Trie(stems), set(), Counter()
    for w in {p[:-1] for p in clean if p.endswith("$")}:
        if not trie.exact(w) and (got := trie.fuzzy(w)):
            near.add(w)
            variants[got[0]] += 1
    return Model(weights, stems, frozenset(near), frozenset(t for t, n in variants.items() if n >= 3))


def learn(
    texts: list[str],
    labels: list[int],
    *,
    toxic_share: float | None = None,
    min_docs: int = 5,
    min_share: float = 0.004,
    precision: float = 0.97,
) -> Model:
    """Lexicon and curve from labelled texts; without both labels, a model that scores all texts near 0.

    The curve is fitted on evidence under a lexicon from the other half of the texts, so that what the
    lexicon owes to chance does not count; ``toxic_share`` is the share of label 1 to fit for.
    """
    if len(set(labels)) < 2:
        return Model()
    args = (min_docs, min_share, precision)
    seen: list[tuple[list[Hit], int]] = [([], 0)] * len(texts)
    for half in (0, 1):
        rest = [i for i in range(len(texts)) if i % 2 != half]
        scorer = Scorer(_lexicon([texts[i] for i in rest], [labels[i] for i in rest], *args))
        for i in range(half, len(texts), 2):
            seen[i] = scorer.found(texts[i])
    model, y = _lexicon(texts, labels, *args), np.asarray(labels, float)
    share = toxic_share or float(y.mean())
    w = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    model.factors, model.curve = _fitted(seen, y, w, model.factors)
    return model


def _curve(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[tuple[float, float, float], float]:
    """(coefficients, weighted loss) of the ridge-penalised logistic curve."""
    X, c = np.column_stack([x, np.ones(len(y))]), np.array([1.0, 0.0, -1.0])
    ridge = np.diag([0.05, 0.05, 0.001])
    for _ in range(100):  # Newton steps on the ridge-penalised likelihood
        p = 1 / (1 + np.exp(-np.clip(X @ c, -30, 30)))
        g = X.T @ (w * (p - y)) + ridge @ c
        step = np.linalg.solve((X * (w * p * (1 - p) + 1e-9)[:, None]).T @ X + ridge, g)
        c = c - step * min(1.0, 2.0 / np.abs(step).max())
        if np.abs(step).max() < 1e-8:
            break
    z = np.clip(X @ c, -30, 30)
    loss = float((w * (np.logaddexp(0, z) - y * z)).sum() + c @ ridge @ c / 2)
    return (float(c[0]), float(c[1]), float(c[2])), loss


def _fitted(seen: list[tuple[list[Hit], int]], y: np.ndarray, w: np.ndarray, start: tuple[float, ...]) -> tuple[tuple[float, ...], tuple[float, float, float]]:
    """(factors, curve) by descent over one factor at a time. A factor leaves its starting value only for a loss less by one,
    which is what two in three chance improvements stay under."""
    def at(factors: tuple[float, ...]):
        return _curve(np.array([evidence_of(hits, n, factors) for hits, n in seen]).reshape(-1, 2), y, w)

    factors = start
    curve, least = at(factors)
    for _ in range(2):
        for k, choices in enumerate(CHOICES):
            for value in choices:
                tried = (*factors[:k], value, *factors[k + 1 :])
                if tried != factors and (got := at(tried))[1] < least - 1:
                    factors, (curve, least) = tried, got
    return factors, curve


def training_sample(docs: DataFrame, labels: DataFrame, per_class: int, *, doc_id: str, text: str, label: str) -> tuple[list[str], list[int], float]:
    """Texts and labels of at most ``per_class`` documents a label, those of the smallest id hashes; the
    share of label 1 among all labelled ids.

    An id that is labelled both 0 and 1 counts as 1; of several texts of one id the least counts. Texts of over SAMPLE_CHARS
    characters are no examples.
    """
    known = labels.select(F.col(doc_id).alias("__id"), F.col(label).cast("int").alias("__y")).filter("__id is not null and __y in (0, 1)")
    known = known.groupBy("__id").agg(F.max("__y").alias("__y"))
    ids = []
    for y in (0, 1):
        ids += [(r["__id"], y) for r in known.filter(F.col("__y") == y).orderBy(F.xxhash64("__id"), "__id").limit(per_class).collect()]
    if not ids:
        return [], [], 0.0
    share = known.agg(F.avg("__y")).first()[0]
    kind = dict(docs.dtypes)[doc_id]
    picked = docs.sparkSession.createDataFrame(ids, f"__id {kind}, __y int")  # at most 2 * per_class rows
    rows = docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("__t")).filter(F.length("__t") <= SAMPLE_CHARS).join(F.broadcast(picked), "__id")
    rows = rows.groupBy("__id", "__y").agg(F.min("__t").alias("__t"))
    got = sorted((str(r["__id"]), r["__y"], r["__t"]) for r in rows.collect())
    return [t for _, _, t in got], [y for _, y, _ in got], float(share)


def score(docs: DataFrame, model: Model, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``score`` (0 to 1). Null and empty texts have no evidence and the curve's lowest score.

    Rows are scored one by one from their text alone; other columns pass through (one named ``score``
    is replaced); ``keep`` names those that shall, so that texts need not come back.
    """
    docs = docs.drop("score")
    names = docs.columns
    kept = [c for c in names if keep is None or c in keep]

    def run(batches: Iterator[pa.RecordBatch]):
        scorer = Scorer(model)
        at = names.index(text)
        for batch in batches:
            e = np.array([scorer.evidence(t or "") for t in batch.column(at).to_pylist()], float).reshape(-1, 2)
            s = 1 / (1 + np.exp(-np.clip(e @ np.array(model.curve[:2]) + model.curve[2], -30, 30)))
            yield pa.RecordBatch.from_arrays([*[batch.column(names.index(c)) for c in kept], pa.array(s, pa.float64())], names=[*kept, "score"])

    kinds = dict(docs.dtypes)
    return docs.mapInArrow(run, ", ".join([f"`{n}` {kinds[n]}" for n in kept] + ["score double"]))
