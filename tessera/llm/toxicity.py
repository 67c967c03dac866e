"""Toxicity: a convolutional text classifier trained in numpy.

Words are runs of letters, lower-cased. A word's embedding is the sum of the hashed vectors of the
word and of its beginnings and endings, so that inflected forms share most of it. Filters of
several widths slide over the words; each filter's largest response over the whole text is its
feature, and one linear layer scores the features. Training (Adam, mini-batches, fixed seed) uses a
bounded, documented sample of the labelled rows: up to ``SAMPLE`` of each label, those with the
smallest hash of their id. Batches hold as many toxic as other texts. Parts that fewer than
``LEAST`` of the texts hold have no vector, so words that training has not met say nothing. A
held-back fifth of the sample calibrates: for each language a threshold on the logit is chosen and
the score is the logistic function of the distance from it. Languages are those the sampled rows name:
for each the words that its texts hold much more often than the others' do are learned from the
sample, and a text counts as the language that most of its words vote for. So no column but the text
enters a score; a text without any such word uses the threshold of all languages together, as does
one of a language with few labels or none.

Cases: null and empty texts have no words, and score as a text whose features are all zero; ties
and repeated rows score equal, and of a repeated key one text is learned from, that of the smallest
hash; rows of unknown or null label are not learned from; without labels of both kinds every score is
the share of toxic labels (0 without any), and below one half; an empty table gives an empty result;
columns beyond those named are not read. Very long texts are scored whole, in stretches of words that
overlap by the widest filter; of those in the sample the first ``LEARN_CHARS`` characters are learned from.
"""

from __future__ import annotations

import re
import sys
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.arrow import map_tasks, texts

#: Most labelled rows of each label that training reads.
SAMPLE = 2500
BUCKETS, DIM, FILTERS, WIDTHS = 1 << 15, 16, 12, (1, 2, 3)
STEPS, BATCH, RATE, DROP, SEED, LEAST = 500, 32, 0.01, 0.4, 11, 4
PARTS = 10
#: Characters of a sampled text that reach the driver, so the sample's size is bounded in bytes too.
LEARN_CHARS = 40_000
#: Words whose parts a task remembers; it starts anew beyond them.
WORDS = 200_000
STRETCH = 1 << 14
#: Words that speak for one language, for each; texts of a label that a language's threshold takes at least.
MARKERS, ENOUGH = 60, 5

LETTERS = re.compile(r"[^\W\d_]+")

def words_of(text: str) -> list[str]:
    return LETTERS.findall(text.lower())


def parts_of(word: str) -> list[int]:
    """Buckets of a word: itself, beginnings of 3 to 6 letters, endings of 3 to 5."""
    pieces = ["=" + word]
    pieces += ["<" + word[:k] for k in (3, 4, 5, 6) if len(word) >= k]
    pieces += [word[-k:] + ">" for k in (3, 4, 5) if len(word) > k]
    return [1 + zlib.crc32(p.encode("utf-8")) % (BUCKETS - 1) for p in pieces]


def markers(texts_: list[list[str]], langs: list[str | None]) -> dict[str, int]:
    """Words that speak for one language, and the number of that language in the order of names.

    A word's share of texts in its language must be four times its share in any other, so shared
    words do not vote; the most frequent ones are taken, ties in the order of the words.
    """
    names = sorted({lang for lang in langs if lang})
    counts: dict[str, dict[str, int]] = {name: {} for name in names}
    for words, lang in zip(texts_, langs):
        if lang:
            count = counts[lang]
            for w in set(words):
                count[w] = count.get(w, 0) + 1
    sizes = {name: langs.count(name) for name in names}
    share = [{w: n / sizes[name] for w, n in counts[name].items()} for name in names]
    out = {}
    for k, own in enumerate(share):
        others = [s for j, s in enumerate(share) if j != k]
        best = sorted((-v, w) for w, v in own.items() if v >= 4 * max((s.get(w, 0.0) for s in others), default=0.0))
        out |= {w: k for _, w in best[:MARKERS]}
    return out


def language_of(words: list[str], marks: dict[str, int]) -> int:
    """Number of the language that most words of a text vote for, the first of equals; -1 for none."""
    votes: dict[int, int] = {}
    for w in words:
        k = marks.get(w)
        if k is not None:
            votes[k] = votes.get(k, 0) + 1
    return min(votes, key=lambda k: (-votes[k], k)) if votes else -1


@dataclass
class Network:
    """Weights; convolution matrices by width and place in the filter."""

    vectors: np.ndarray
    kernels: list[np.ndarray]  # (width, DIM, FILTERS)
    biases: list[np.ndarray]
    output: np.ndarray
    offset: float
    marks: dict[str, int] = field(default_factory=dict)
    thresholds: dict[int, float] = field(default_factory=dict)
    slope: float = 1.0

    def params(self) -> list[np.ndarray]:
        return [self.vectors, *self.kernels, *self.biases, self.output]


def fresh(seed: int = SEED) -> Network:
    rnd = np.random.default_rng(seed)
    vectors = rnd.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    vectors[0] = 0
    kernels = [rnd.normal(0, 1 / np.sqrt(w * DIM), (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
    return Network(vectors, kernels, [np.zeros(FILTERS, np.float32) for _ in WIDTHS], rnd.normal(0, 0.1, len(WIDTHS) * FILTERS).astype(np.float32), 0.0)


def embed(vectors: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """Sums of the vectors of words given as rows of buckets, 0 for none."""
    return vectors[parts].sum(1)


def convolve(net: Network, table: np.ndarray, ids: np.ndarray, bounds: np.ndarray, where: bool = False):
    """Largest response of each filter over each text (zero at least), and where it is.

    ``table`` holds the embeddings of distinct words, ``ids`` the texts' words one after another,
    cut at ``bounds``. A filter that is wider than what is left of a text sees nothing there.
    """
    n = len(bounds) - 1
    out = np.zeros((n, len(WIDTHS) * FILTERS), np.float32)
    at = np.full(out.shape, -1, np.int64)
    for k, (width, kernel, bias) in enumerate(zip(WIDTHS, net.kernels, net.biases)):
        shown = [table @ kernel[j] for j in range(width)]
        lengths = np.diff(bounds)
        here = np.flatnonzero(lengths >= width)
        if not len(here):
            continue
        m = len(ids) - width + 1
        response = shown[0][ids[:m]]
        for j in range(1, width):
            response = response + shown[j][ids[j : j + m]]
        response += bias
        if width > 1:  # places that reach into the next text
            for j in range(1, width):
                cross = bounds[1:-1] - j
                response[cross[(cross >= 0) & (cross < m)]] = -np.inf
        starts = bounds[here]
        # reduceat runs to the next start: what lies between is cut off or of shorter texts
        if len(here) < n:
            mask = np.ones(m, bool)
            for b in np.flatnonzero(lengths < width):
                mask[bounds[b] : min(m, bounds[b + 1])] = False
            response[~mask] = -np.inf
        best = np.maximum.reduceat(response, starts, axis=0)
        cols = slice(k * FILTERS, (k + 1) * FILTERS)
        out[here, cols] = np.maximum(best, 0)
        if where:
            for row, b in enumerate(here):
                stop = min(m, bounds[b + 1] - width + 1)
                at[b, cols] = bounds[b] + response[bounds[b] : stop].argmax(0)
    if where:
        at[out <= 0] = -1
        return out, at
    return out


def train(samples: list[tuple[list[str], int]], langs: list[str | None] | None = None, seed: int = SEED) -> Network | None:
    """Fit and calibrate on (words, label) in a given order, with their languages if known; None without both labels."""
    if len({y for _, y in samples}) < 2:
        return None
    held = [k % 5 == 4 for k in range(len(samples))]
    if len({y for (_, y), h in zip(samples, held) if not h}) < 2:
        held = [False] * len(samples)
    index: dict[str, int] = {}
    coded = [np.array([index.setdefault(w, len(index)) for w in words], np.int64) for words, _ in samples]
    parts = np.zeros((max(1, len(index)), PARTS), np.int64)
    for w, k in index.items():
        p = parts_of(w)
        parts[k, : len(p)] = p
    labels = np.array([y for _, y in samples], np.float32)
    net = fresh(seed)
    fit = np.array([k for k, h in enumerate(held) if not h])
    spread = np.zeros(BUCKETS, np.int64)
    for k in fit:
        spread[np.unique(parts[np.unique(coded[k])])] += 1
    parts[spread[parts] < LEAST] = 0
    net.vectors[spread < LEAST] = 0
    net.vectors[0] = 0
    sides = [fit[labels[fit] == y] for y in (0, 1)]
    decks: list[list[int]] = [[], []]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in net.params()]
    offset_moment = [0.0, 0.0]
    rnd = np.random.default_rng(seed)
    for step in range(1, STEPS + 1):
        some = []
        for deck, side in zip(decks, sides):
            while len(deck) < BATCH // 2:
                deck += rnd.permutation(side).tolist()
            some += [deck.pop() for _ in range(BATCH // 2)]
        some = np.array(some)
        shown = [coded[k][rnd.random(len(coded[k])) >= DROP] for k in some]  # no word alone decides
        words = np.concatenate(shown)
        bounds = np.concatenate([[0], np.cumsum([len(w) for w in shown])])
        if not len(words):
            continue
        distinct, ids = np.unique(words, return_inverse=True)
        rows = parts[distinct]
        table = embed(net.vectors, rows)
        features, at = convolve(net, table, ids, bounds, where=True)
        logit = features @ net.output + net.offset
        p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        delta = ((p - labels[some]) / len(some)).astype(np.float32)
        grad_out = features.T @ delta + 1e-4 * net.output
        back = delta[:, None] * net.output[None, :]
        grad_table = np.zeros_like(table)
        grads_k, grads_b = [], []
        for k, width in enumerate(WIDTHS):
            cols = slice(k * FILTERS, (k + 1) * FILTERS)
            b, f = np.nonzero(at[:, cols] >= 0)
            place, g = at[:, cols][b, f], back[:, cols][b, f]
            gk = np.zeros_like(net.kernels[k])
            for j in range(width):
                who = ids[place + j]
                np.add.at(gk[j].T, f, table[who] * g[:, None])
                np.add.at(grad_table, who, net.kernels[k][j].T[f] * g[:, None])
            grads_k.append(gk)
            grads_b.append(np.bincount(f, g, FILTERS).astype(np.float32))
        hit = np.flatnonzero(np.abs(grad_table).sum(1))
        each = grad_table[hit]
        buckets = rows[hit].ravel()
        spread = np.repeat(each, PARTS, axis=0)[buckets > 0]
        buckets, place = np.unique(buckets[buckets > 0], return_inverse=True)
        grad_v = np.zeros((len(buckets), DIM), np.float32)
        np.add.at(grad_v, place, spread)
        rate = RATE * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
        for param, (m, v), grad in zip(net.params()[1:], moments[1:], [*grads_k, *grads_b, grad_out]):
            m += 0.1 * (grad - m)
            v += 0.001 * (grad * grad - v)
            param -= rate * m / (np.sqrt(v) + 1e-8)
        m, v = moments[0]
        m[buckets] += 0.1 * (grad_v - m[buckets])
        v[buckets] += 0.001 * (grad_v * grad_v - v[buckets])
        net.vectors[buckets] -= rate * m[buckets] / (np.sqrt(v[buckets]) + 1e-8)
        g = float(delta.sum())
        offset_moment[0] += 0.1 * (g - offset_moment[0])
        offset_moment[1] += 0.001 * (g * g - offset_moment[1])
        net.offset -= rate * offset_moment[0] / (np.sqrt(offset_moment[1]) + 1e-8)
    net.marks = markers([words for words, _ in samples], langs or [])
    check = [k for k, h in enumerate(held) if h] or fit
    calibrate(net, Scorer(net).logits([samples[k][0] for k in check]), labels[check], [language_of(samples[k][0], net.marks) for k in check])
    return net


def cut(logits: np.ndarray, labels: np.ndarray) -> float:
    """The middle of the widest gap among thresholds with fewest errors."""
    order = np.argsort(logits, kind="stable")
    z, y = logits[order], labels[order] > 0
    below = np.concatenate([[0], np.cumsum(y)])  # toxic ones missed
    above = (~y).sum() - np.concatenate([[0], np.cumsum(~y)])
    errors = below + above
    edges = np.concatenate([[z[0] - 2], z, [z[-1] + 2]])
    gaps = edges[1:] - edges[:-1]
    best = np.flatnonzero(errors == errors.min())
    k = best[np.argmax(gaps[best])]
    return float((edges[k] + edges[k + 1]) / 2)


def calibrate(net: Network, logits: np.ndarray, labels: np.ndarray, languages: list[int]) -> None:
    """Thresholds for all texts (-1) and for each language with enough of both labels."""
    languages = np.array(languages)
    net.thresholds = {-1: cut(logits, labels) if len(set(labels.tolist())) == 2 else 0.0}
    for k in sorted(set(net.marks.values())):
        mine = languages == k
        if min((labels[mine] > 0).sum(), (labels[mine] == 0).sum()) >= ENOUGH:
            net.thresholds[k] = cut(logits[mine], labels[mine])
    net.slope = float(1 / max(0.5, np.std(logits)))


class Scorer:
    """Scores texts; remembers the parts of the words it meets."""

    def __init__(self, net: Network):
        self.net = net
        self.index: dict[str, int] = {}
        self.parts = np.zeros((1024, PARTS), np.int32)

    def row(self, word: str) -> int:
        k = self.index[word] = len(self.index)
        if k == len(self.parts):
            self.parts = np.concatenate([self.parts, np.zeros_like(self.parts)])
        p = parts_of(word)
        self.parts[k] = 0
        self.parts[k, : len(p)] = p
        return k

    def logits(self, batch: list[list[str]]) -> np.ndarray:
        """Logits of texts given as words, in stretches of bounded length."""
        if len(self.index) > WORDS:
            self.index.clear()
        get = self.index.get
        overlap = max(WIDTHS) - 1
        pieces, owner = [], []
        for k, words in enumerate(batch):
            ids = np.fromiter((self.row(w) if (i := get(w)) is None else i for w in words), np.int64, len(words))
            for a in range(0, max(1, len(ids)), STRETCH):
                pieces.append(ids[a : a + STRETCH + overlap])
                owner.append(k)
        features = np.zeros((len(batch), len(WIDTHS) * FILTERS), np.float32)
        a = 0
        while a < len(pieces):
            b, size = a, 0
            while b < len(pieces) and (b == a or size + len(pieces[b]) <= 4 * STRETCH):
                size += len(pieces[b])
                b += 1
            words = np.concatenate(pieces[a:b])
            if len(words):
                distinct, ids = np.unique(words, return_inverse=True)
                bounds = np.concatenate([[0], np.cumsum([len(p) for p in pieces[a:b]])])
                got = convolve(self.net, embed(self.net.vectors, self.parts[distinct]), ids, bounds)
                np.maximum.at(features, owner[a:b], got)
            a = b
        return features @ self.net.output + self.net.offset

    def scores(self, batch: list[str]) -> list[float]:
        net = self.net
        words = [words_of(t) for t in batch]
        out = []
        for z, w in zip(self.logits(words).tolist(), words):
            k = language_of(w, net.marks)
            d = (z - net.thresholds.get(k, net.thresholds[-1])) * net.slope * 4
            out.append(float(1 / (1 + np.exp(-max(-30.0, min(30.0, d))))))
        return out


def sample(docs: DataFrame, labels: DataFrame, allowed: Column, key: str = "doc_id", text: str = "text", label: str = "toxic", lang: str = "lang") -> list[tuple[list[str], int, str | None]]:
    """Up to ``SAMPLE`` labelled texts of each label where ``allowed`` holds, smallest hash of the key first.

    A key with labels of both kinds counts as toxic. The keys are chosen from the labels alone; only
    the chosen texts come to the driver. Languages are null where the documents do not name any.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(key).agg(F.max(label).cast("int").alias("y"))
    known = known.withColumn("h", F.md5(F.col(key).cast("string"))).where(allowed)
    pick = [known.where(F.col("y") == y).orderBy("h").limit(SAMPLE) for y in (0, 1)]
    chosen = F.broadcast(pick[0].unionByName(pick[1]).select(F.col(key).alias("_k"), "y", "h"))  # 2 x SAMPLE rows at most
    name = F.col(lang).cast("string") if lang in docs.columns else F.lit(None).cast("string")
    texts_ = docs.select(F.col(key).alias("k"), F.substring(F.coalesce(text, F.lit("")), 1, LEARN_CHARS).alias("text"), name.alias("lang"))
    one = F.min_by(F.struct("text", "lang"), F.struct(F.md5("text"), "lang"))
    found = texts_.join(chosen, F.col("k") == F.col("_k")).groupBy("k", "y", "h").agg(one.alias("t")).select("h", "y", "t.*").collect()
    # a word is one object, however often the sample has it
    return [(list(map(sys.intern, words_of(r.text))), r.y, r.lang) for r in sorted(found, key=lambda r: (r.h, r.text, r.y))]


def score(docs: DataFrame, net: Network | None, key: str = "doc_id", text: str = "text", carry: tuple[str, ...] = (), prior: float = 0.0) -> DataFrame:
    """(key, score) of every whole text, with the columns ``carry`` as they are."""
    spark: SparkSession = docs.sparkSession
    shared = spark.sparkContext.broadcast(net)
    names = [key, *carry]
    at = names.index(text) if text in names else len(names)

    def start():
        own = None if shared.value is None else Scorer(shared.value)  # its memory goes with the task

        def run(part: pa.RecordBatch) -> dict:
            batch = texts(part.column(at))
            got = [prior] * len(batch) if own is None else own.scores(batch)
            return {n: part.column(k) for k, n in enumerate(names)} | {"score": got}

        return run

    df = docs.select(*names) if text in names else docs.select(*names, text)
    schema = docs.select(*names).schema.add("score", "double")
    return map_tasks(df, start, schema, rows=256, size=1 << 20)


def crc_of_id(key: str = "doc_id") -> Column:
    return F.crc32(F.col(key).cast("string").cast("binary"))


def fit(docs: DataFrame, labels: DataFrame, allowed: Column, key: str = "doc_id", text: str = "text") -> tuple[Network | None, float]:
    """The trained network (None without both labels) and a prior below one half for that case."""
    rows = sample(docs, labels, allowed, key, text)
    share = sum(y for _, y, _ in rows) / len(rows) if rows else 0.0
    return train([(words, y) for words, y, _ in rows], [lang for _, _, lang in rows]), min(share, 0.49)
