"""Language ID by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary (its lower-case letter
pieces, with word starts). The probability of a word is the sum, over all ways of cutting it into
pieces, of the product of the pieces' probabilities; a forward algorithm sums them, for all words
and languages of a slice at once. A text's log-likelihood is the sum over its words; words are runs
of letters, lower-cased, and a long run is cut only where no piece spans the cut, so that the sums
over all segmentations factor there; what is long without such a place is summed letter by letter,
rescaled as it goes. The score is the posterior of the predicted language, all being equally likely
before. Piece probabilities are fitted by expectation-maximisation (forward and backward sums over
all segmentations) to a bounded sample of labelled texts: about ``SAMPLE`` a language, those with the
smallest hash of their id. Nothing but the text enters a prediction.

The sample needs no ranking of a whole language: hashes are even over (0, 1), so of ``n`` texts of a
language those below a cut-off a little above ``SAMPLE / n`` hold the smallest ``SAMPLE``, and only
these are ranked.

Cases: a text that is null or has no letter is ``und`` with score 0, as is every text if there is
nothing to learn from; letters that no piece covers count as one unknown piece in every language;
ties go to the language that sorts first; repeated rows are predicted alike (and of a repeated id and
language one text is learned from, that of the smallest hash); a null language is not learned from;
an empty table gives an empty result; columns beyond those named are not read. Very long texts are
predicted from all their words; training reads the first ``LEARN_CHARS`` characters of a sampled
text, with runs of more than ``LONGEST`` letters in stretches of so many.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.arrow import map_tasks, texts

#: Most labelled texts of each language that training reads, and the most characters of each.
SAMPLE, LEARN_CHARS = 300, 40_000
ROUNDS, PRIOR = 3, 2000.0
#: Languages up to which the sample's small tables are broadcast.
LANGUAGES = 1000
#: Letters of a word that is scored together with others of its length.
LONGEST = 40
#: Letters whose pieces are looked up at once in a long word.
STRETCH = 4096
#: Words whose scores a task remembers; it starts anew beyond them.
WORDS = 200_000
SCALE = 1000.0  # a letter's worth; keeps products of small numbers in range

LETTERS = regex.compile(r"\p{L}+")
_BASE = np.uint64(0x9E3779B97F4A7C15)
START = "▁"


def words_of(text: str) -> list[str]:
    """Word starts and letters, long runs in stretches: what training reads."""
    out = []
    for w in LETTERS.findall(text.lower()):
        if len(w) < LONGEST:
            out.append(START + w)
        else:
            w = START + w
            out += [w[k : k + LONGEST] for k in range(0, len(w), LONGEST)]
    return out


class Pieces:
    """Hashes of the vocabulary's pieces, sorted, for vectorised look-up; the last id is unknown."""

    def __init__(self, pieces: list[str]):
        self.pieces = pieces
        keys = np.zeros(len(pieces), np.uint64)
        for k in range(max(map(len, pieces))):
            some = [i for i, p in enumerate(pieces) if len(p) > k]
            keys[some] = keys[some] * _BASE + self.spread(np.array([ord(pieces[i][k]) for i in some], np.uint64))
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], order
        if (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("two pieces share a hash")
        self.unknown = len(pieces)
        self.widest = max(map(len, pieces))

    @staticmethod
    def spread(points: np.ndarray) -> np.ndarray:
        points = (points + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
        return points ^ points >> np.uint64(29)

    def lattice(self, words: list[str], width: int) -> np.ndarray:
        """Piece ids (words, start, letters - 1) of words of ``width`` letters; -1 for none."""
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), width).astype(np.uint64)
        each = self.spread(points)
        out = np.full((len(words), width, self.widest), -1, np.int32)
        h = np.zeros_like(each)
        for k in range(min(self.widest, width)):
            m = width - k
            h = h[:, :m] * _BASE + each[:, k:]
            at = np.searchsorted(self.keys, h)
            at[at == len(self.keys)] = 0
            out[:, :m, k] = np.where(self.keys[at] == h, self.ids[at], -1)
        single = out[:, :, 0]
        single[single < 0] = self.unknown
        return out

    def stretches(self, word: str):
        """Lattices (start, letters - 1) of a long word, some starts at a time."""
        for a in range(0, len(word), STRETCH):
            part = word[a : a + STRETCH + self.widest - 1]
            yield a, self.lattice([part], len(part))[0, : min(STRETCH, len(word) - a)]

    def segments(self, word: str) -> list[str]:
        """A long word cut wherever no piece spans the cut: no segmentation crosses such a place."""
        inside = np.zeros(len(word) + 1, np.int32)
        for a, ids in self.stretches(word):
            start, k = np.nonzero(ids[:, 1:] >= 0)
            np.add.at(inside, a + start + 1, 1)  # places after its first letter and before its last
            np.add.at(inside, np.minimum(a + start + k + 2, len(word)), -1)
        cuts = [0, *(np.flatnonzero(np.cumsum(inside[:-1])[1:] == 0) + 1).tolist(), len(word)]
        return [word[a:b] for a, b in zip(cuts, cuts[1:])]


@lru_cache(maxsize=2)
def pieces_of(path: str) -> Pieces:
    """The letter pieces of a vocabulary file that are their own lower case, and the bare word start."""
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    found = []
    for k in range(sp.get_piece_size()):
        p = sp.id_to_piece(k)
        body = p.removeprefix(START)
        if not (sp.is_control(k) or sp.is_unknown(k) or sp.is_byte(k)) and p == p.lower() and (p == START or (body and LETTERS.fullmatch(body))):
            found.append(p)
    return Pieces(sorted(set(found)))


def forward(ids: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Sums over all segmentations of each beginning: (letters + 1, words, languages), scaled by letter.

    ``p`` holds probabilities (piece, language), with zeros in one more last row for no piece.
    """
    n, width, widest = ids.shape
    alpha = np.zeros((width + 1, n, p.shape[1]))
    alpha[0] = 1
    for end in range(1, width + 1):
        for k in range(min(widest, end)):
            piece = ids[:, end - 1 - k, k]
            if (piece >= 0).any():
                alpha[end] += alpha[end - 1 - k] * p[piece] * SCALE ** (k + 1)
    return alpha


def backward(ids: np.ndarray, p: np.ndarray) -> np.ndarray:
    n, width, widest = ids.shape
    beta = np.zeros((width + 1, n, p.shape[1]))
    beta[width] = 1
    for start in range(width - 1, -1, -1):
        for k in range(min(widest, width - start)):
            piece = ids[:, start, k]
            if (piece >= 0).any():
                beta[start] += beta[start + k + 1] * p[piece] * SCALE ** (k + 1)
    return beta


@dataclass
class Model:
    """Languages in order and the probabilities (piece, language), unknown and none being the last rows."""

    path: str
    languages: list[str]
    p: np.ndarray

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Log-likelihoods (word, language)."""
        vocabulary = pieces_of(self.path)
        out = np.zeros((len(words), len(self.languages)))
        by: dict[int, list[int]] = {}
        for k, w in enumerate(words):
            by.setdefault(len(w), []).append(k)
        for width, some in by.items():
            for a in range(0, len(some), 4096):
                part = some[a : a + 4096]
                if width > 2 * LONGEST:
                    out[part] = [self.long_score(words[k]) for k in part]
                    continue
                total = forward(vocabulary.lattice([words[k] for k in part], width), self.p)[width]
                out[part] = np.log(total) - width * np.log(SCALE)
        return out

    def long_score(self, word: str) -> np.ndarray:
        """Log-likelihoods (language) of one long word: sums pushed ahead letter by letter, rescaled."""
        v = pieces_of(self.path)
        ahead, logs = np.zeros((v.widest + 1, len(self.languages))), np.zeros(len(self.languages))
        ahead[0] = 1
        for _, ids in v.stretches(word):
            for row in ids:
                k = np.flatnonzero(row >= 0)
                ahead[k + 1] += ahead[0] * self.p[row[k]]
                ahead[:-1] = ahead[1:]
                ahead[-1] = 0
                most = ahead.max(0)
                ahead /= most
                logs += np.log(most)
        return logs + np.log(ahead[0])


def fit(path: str, samples: dict[str, Counter]) -> Model | None:
    """Expectation-maximisation on counts of words by language; None without any language."""
    languages = sorted(k for k, c in samples.items() if c)
    if not languages:
        return None
    vocabulary = pieces_of(path)
    n = len(vocabulary.pieces)
    sizes = np.array([len(p) for p in vocabulary.pieces] + [1])
    # a start that favours no language: pieces by length
    start = 30.0 ** -sizes.astype(float)
    start[n] = 1e-9
    p = np.repeat((start / start.sum())[:, None], len(languages), 1)
    cut: list[list[tuple[np.ndarray, np.ndarray, int]]] = []
    for name in languages:
        by: dict[int, list[str]] = {}
        for w in sorted(samples[name]):
            by.setdefault(len(w), []).append(w)
        cut.append([(vocabulary.lattice(ws[a : a + 8192], width), np.array([samples[name][w] for w in ws[a : a + 8192]], float), width) for width, ws in sorted(by.items()) for a in range(0, len(ws), 8192)])
    for _ in range(ROUNDS):
        counts = np.zeros((n + 1, len(languages)))
        for l in range(len(languages)):
            own = np.concatenate([p[:, l : l + 1], [[0.0]]])
            for ids, weight, width in cut[l]:
                alpha, beta = forward(ids, own)[:, :, 0], backward(ids, own)[:, :, 0]
                share = weight / alpha[width]
                for begin in range(width):
                    for k in range(min(ids.shape[2], width - begin)):
                        piece = ids[:, begin, k]
                        here = piece >= 0
                        if here.any():
                            e = alpha[begin] * own[piece, 0] * SCALE ** (k + 1) * beta[begin + k + 1] * share
                            counts[:, l] += np.bincount(piece[here], e[here], n + 1)
        pooled = counts.sum(1) + 0.01
        pooled /= pooled.sum()
        p = (counts + PRIOR * pooled[:, None]) / (counts.sum(0) + PRIOR)
        p[n] = 1e-7  # an unknown letter says nothing about the language
        p /= p.sum(0)
    return Model(path, languages, np.concatenate([p, np.zeros((1, len(languages)))]))


class Predictor:
    """Predicts texts; remembers the words it meets."""

    def __init__(self, model: Model):
        self.model, self.vocabulary = model, pieces_of(model.path)
        self.index: dict[str, int] = {}
        self.table = np.zeros((0, len(model.languages)))

    def words(self, text: str) -> list[str]:
        """Word starts and letters; long runs in segments that no piece crosses."""
        out = []
        for w in LETTERS.findall(text.lower()):
            if len(w) < LONGEST:
                out.append(START + w)
            else:
                out += self.vocabulary.segments(START + w)
        return out

    def predict(self, batch: list[str]) -> list[tuple[str, float]]:
        cut = [self.words(t) for t in batch]
        if len(self.index) > WORDS:
            self.index.clear()
            self.table = self.table[:0]
        new = sorted({w for words in cut for w in words}.difference(self.index))
        if new:
            self.table = np.concatenate([self.table, self.model.word_scores(new)])
            self.index.update(zip(new, range(len(self.index), len(self.index) + len(new))))
        out = []
        for words in cut:
            if not words:
                out.append(("und", 0.0))
                continue
            total = self.table[list(map(self.index.__getitem__, words))].sum(0)
            share = np.exp(total - total.max())
            best = int(share.argmax())
            out.append((self.model.languages[best], float(share[best] / share.sum())))
        return out


def train(docs: DataFrame, allowed: Column, path: str, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Model | None:
    """Fit to the sample of labelled texts where ``allowed`` holds.

    Ids and languages alone choose the sample: about ``SAMPLE`` rows of each language reach the join
    with the texts and the driver.
    """
    known = docs.where(allowed & F.col(lang).isNotNull() & F.col(key).isNotNull()).select(F.col(key).alias("k"), F.col(lang).alias("l"))
    sizes = known.groupBy("l").agg(F.count("*").alias("n"))
    # a row a language, and SAMPLE of each at most: broadcast where there are few languages
    few = (lambda t: F.broadcast(t)) if sizes.count() <= LANGUAGES else (lambda t: t)
    h = F.md5(F.col("k").cast("string"))
    even = F.conv(F.substring(h, 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))
    # four standard deviations more than wanted, for repeats and chance
    below = known.join(few(sizes), "l").where(even * F.col("n") <= SAMPLE + 4 * SAMPLE**0.5 + 8).select("k", "l", h.alias("h")).distinct()
    order = Window.partitionBy("l").orderBy("h", "k")
    chosen = below.withColumn("place", F.row_number().over(order)).where(F.col("place") <= SAMPLE).select("k", "l")
    part = docs.select(F.col(key).alias("k"), F.col(lang).alias("l"), F.substring(F.coalesce(text, F.lit("")), 1, LEARN_CHARS).alias("t"))
    found = part.join(few(chosen), ["k", "l"]).groupBy("k", "l").agg(F.min_by("t", F.md5("t")).alias("t")).select("l", "t")
    samples: dict[str, Counter] = {}
    for name, value in found.collect():
        samples.setdefault(name, Counter()).update(words_of(value))
    return fit(path, samples)


def predict(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang_pred, score) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[key].dataType.simpleString()

    def start():
        own = None if shared.value is None else Predictor(shared.value)

        def run(part: pa.RecordBatch) -> dict:
            batch = texts(part.column(1))
            got = [("und", 0.0)] * len(batch) if own is None else own.predict(batch)
            return {key: part.column(0), "lang_pred": [g[0] for g in got], "score": [g[1] for g in got]}

        return run

    return map_tasks(docs.select(key, text), start, f"`{key}` {kind}, lang_pred string, score double", size=2 << 20)
