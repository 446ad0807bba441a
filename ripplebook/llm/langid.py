"""Language identification: averaged hashed subword embeddings under a linear softmax.

A word gives its hashed character n-grams (with edge marks) and itself; a text's vector is the average
of the embeddings of all its subwords, and a linear softmax reads the languages off. Trained in numpy
by stochastic gradient descent on a bounded, hash-chosen sample of labelled rows; a part of the sample
is held back to fit the softmax temperature and the rejection threshold.

Scoring folds embeddings and softmax weights into one table of language scores per subword bucket, so
a word costs one short sum, remembered per task; whole texts are scored in one pass.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNDETERMINED = "und"
BUCKETS = 1 << 15
DIM = 16
#: Words that a task remembers, and the scores that these may take in all (32 MB).
CACHE, CACHED_SCORES = 300_000, 4_000_000
#: Bounds of the training sample: languages (the most frequent), and characters of a text (longer ones are no examples).
MOST_LANGUAGES, SAMPLE_CHARS = 500, 200_000
#: Subwords without evidence that every text is taken to have; short texts get less certain scores.
PRIOR = 8
LETTERS = re.compile(r"[^\W\d_]+")


#: Odd multiplier of the rolling and the final hash.
MIX = np.uint64(0x9E3779B97F4A7C15)


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, word numbers) of the words' 2- to 4-grams with edge marks and of the whole words."""
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 2
    codes = np.frombuffer("".join([f"<{w}>" for w in words]).encode("utf-32-le"), "<u4").astype(np.uint64)
    start = np.cumsum(size) - size
    word = np.repeat(np.arange(len(words)), size)
    place = np.arange(len(codes)) - start[word]
    grams, at = [], []
    for n in (2, 3, 4):
        fits = np.flatnonzero(place + n <= size[word])
        h = np.full(len(fits), n, np.uint64)
        for k in range(n):
            h = h * MIX + codes[fits + k]
        grams.append(h)
        at.append(word[fits])
    power = np.cumprod(np.r_[np.uint64(1), np.full(int(size.max()), MIX)])[: int(size.max())]
    grams.append(np.add.reduceat(codes * power[place], start))
    at.append(np.arange(len(words)))
    buckets = (np.concatenate(grams) * MIX) >> np.uint64(40)
    return (buckets % np.uint64(BUCKETS)).astype(np.int64), np.concatenate(at)


def words_of_text(text: str) -> Counter[str]:
    return Counter(LETTERS.findall(text.lower()))


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # (BUCKETS, languages): embeddings times softmax weights
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0  # below it a prediction is rejected


class Reader:
    """Language scores of texts; keeps a bounded memory of words: their summed scores and subword counts."""

    def __init__(self, model: Model):
        self.model = model
        self.known: dict[str, int] = {}
        self.room = min(CACHE, max(1024, CACHED_SCORES // max(1, len(model.languages))))
        self.sums = np.zeros((self.room, len(model.languages)))
        self.sizes = np.zeros(self.room)

    def _learn_words(self, words: list[str]) -> None:
        first = len(self.known)
        ids, at = subwords(words)
        for k in range(self.sums.shape[1]):
            self.sums[first : first + len(words), k] = np.bincount(at, weights=self.model.table[ids, k], minlength=len(words))
        self.sizes[first : first + len(words)] = np.bincount(at, minlength=len(words))
        self.known.update(zip(words, range(first, first + len(words)), strict=True))

    def logits(self, bag: Counter[str]) -> np.ndarray:
        """Averages over the bag's subwords; words are looked up in parts, so that any text fits the memory."""
        total, n = self.model.bias * 0, 0.0
        words = list(bag)
        for k in range(0, len(words), self.room // 4):
            part = words[k : k + self.room // 4]
            new = [w for w in part if w not in self.known]
            if len(self.known) + len(new) > self.room:
                self.known.clear()
                new = part
            if new:
                self._learn_words(new)
            rows = [self.known[w] for w in part]
            times = np.array([bag[w] for w in part], float)
            total = total + times @ self.sums[rows]
            n += float(times @ self.sizes[rows])
        return total / (n + PRIOR) + self.model.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, calibrated probability); ``und`` and 0 for a text that is null or has no letter."""
        if not self.model.languages or not has_letter(text):
            return UNDETERMINED, 0.0
        z = self.logits(words_of_text(text)) / self.model.temperature
        p = np.exp(z - z.max())
        p /= p.sum()
        best = int(np.argmax(p))
        return self.model.languages[best], float(p[best])

    def predict_many(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """As :meth:`predict`; new words of some texts at a time are scored together."""
        out = []
        for k in range(0, len(texts), 64):
            part = texts[k : k + 64]
            if self.model.languages:
                fresh: set[str] = set()
                for t in part:
                    if t and len(t) < 100_000:
                        fresh.update(LETTERS.findall(t.lower()))
                new = [w for w in fresh if w not in self.known]
                if len(self.known) + len(new) > self.room:
                    self.known.clear()
                    new = list(fresh) if len(fresh) <= self.room else []
                if new:
                    self._learn_words(new)
            out += [self.predict(t) for t in part]
        return out


def learn(texts: list[str], langs: list[str], *, epochs: int = 4, rate: float = 0.5, seed: int = 7, held_back: float = 0.15, reject_share: float = 0.01) -> Model:
    """Stochastic gradient descent on the average-embedding softmax, then calibration on held-back texts.

    The threshold is the confidence that ``reject_share`` of the held-back texts fall below.
    """
    names = sorted(set(langs))
    if not names:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros(0))
    rng = np.random.default_rng(seed)
    y = np.array([names.index(x) for x in langs])
    bags = []
    for t in texts:
        words = words_of_text(t)
        buckets, at = subwords(list(words))
        times = np.fromiter(words.values(), np.float64, len(words))
        ids, back = np.unique(buckets, return_inverse=True)
        share = np.bincount(back, weights=times[at], minlength=len(ids))
        bags.append((ids, share / max(share.sum(), 1)))
    order = rng.permutation(len(texts))
    back = set(order[: int(held_back * len(order))].tolist())
    E = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM))
    W, b = np.zeros((DIM, len(names))), np.zeros(len(names))
    share_of = np.bincount(y, minlength=len(names)) / len(y)
    steps, done = epochs * (len(order) - len(back)), 0
    for _ in range(epochs):
        for i in rng.permutation(len(order)):
            if i in back or not len(bags[i][0]):
                continue
            ids, share = bags[i]
            lr = rate * (1 - done / (steps + 1))
            done += 1
            h = share @ E[ids]
            z = h @ W + b
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1
            p *= min(4.0, 1 / (len(names) * share_of[y[i]]))  # rare languages count as much as frequent ones
            g = W @ p
            W -= lr * 4 * np.outer(h, p)
            b -= lr * 0.1 * p
            E[ids] -= (lr * 40) * np.outer(share, g)
    model = Model(names, E @ W, b)
    test = [i for i in back if len(bags[i][0])]
    if test:
        Z = np.array([bags[i][1] @ model.table[bags[i][0]] + b for i in test])
        t_y = y[test]
        best = (np.inf, 1.0)
        for T in np.geomspace(0.05, 20, 61):  # temperature of the smallest held-back loss
            q = Z / T
            q = q - q.max(axis=1, keepdims=True)
            logp = q - np.log(np.exp(q).sum(axis=1, keepdims=True))
            best = min(best, (-logp[np.arange(len(test)), t_y].mean(), T))
        q = Z / best[1]
        q = np.exp(q - q.max(axis=1, keepdims=True))
        conf = (q / q.sum(axis=1, keepdims=True)).max(axis=1)
        model.temperature, model.threshold = float(best[1]), float(np.quantile(conf, reject_share))
    return model


def training_sample(docs: DataFrame, per_language: int, *, text: str = "text", lang: str = "lang", key: str = "doc_id") -> tuple[list[str], list[str]]:
    """About ``per_language`` whole texts of each language, chosen by id hash; never over twice that, nor of over
    MOST_LANGUAGES languages, nor of over SAMPLE_CHARS characters.

    The share of each language's rows to take comes from its count over all rows, so a frequent
    language costs no more than a rare one. The same rows are picked however they are dealt out.
    """
    known = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull() & (F.length(text) <= SAMPLE_CHARS))
    counts = known.groupBy(lang).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), lang).limit(MOST_LANGUAGES).collect()
    if not counts:
        return [], []
    shares = docs.sparkSession.createDataFrame([(r[lang], min(1.0, per_language / r["n"])) for r in counts], "__lang string, __share double")
    place = F.xxhash64(F.lit("langid"), F.col(key), F.col(text))
    unit = F.pmod(F.xxhash64(F.lit("langid"), F.col(key)), F.lit(1 << 20)) / F.lit(float(1 << 20))
    near = known.join(F.broadcast(shares), F.col(lang) == F.col("__lang")).filter(unit < F.col("__share"))  # MOST_LANGUAGES rows at most
    picked = near.select(place.alias("p"), F.col(key).cast("string").alias("k"), F.col(lang).alias("l"), F.col(text).alias("t"))
    rows = sorted((str(r["k"]), r["l"], r["t"]) for r in picked.orderBy("p", "l").limit(2 * per_language * len(counts)).collect())
    return [t for _, _, t in rows], [x for _, x, _ in rows]


def identify(docs: DataFrame, model: Model, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with lang_pred, score and rejected (score below the calibrated threshold).

    Null texts and texts without a letter: ``und``, 0.0, rejected. Other columns pass through (columns
    of these names are replaced); ``keep`` names those that shall, so that texts need not come back.
    """
    docs = docs.drop("lang_pred", "score", "rejected")
    names = docs.columns
    kept = [c for c in names if keep is None or c in keep]

    def run(batches: Iterator[pa.RecordBatch]):
        reader, at = Reader(model), names.index(text)
        for batch in batches:
            got = reader.predict_many(batch.column(at).to_pylist())
            lang, score = [g[0] for g in got], [g[1] for g in got]
            rejected = [x == UNDETERMINED or s < model.threshold for x, s in got]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(names.index(c)) for c in kept], pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
                names=[*kept, "lang_pred", "score", "rejected"],
            )

    kinds = dict(docs.dtypes)
    schema = [f"`{n}` {kinds[n]}" for n in kept] + ["lang_pred string", "score double", "rejected boolean"]
    return docs.mapInArrow(run, ", ".join(schema))
