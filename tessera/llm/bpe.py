"""BPE encoding and decoding: speculate and verify.

Text is normalised and cut into words as the vocabulary file's own pipeline does (added tokens cut
out first, NFC, lower case by code point, the split pattern, which drops white space, bytes as
printable characters, ``</w>`` on a word's last character). For the words that a worker
has not met yet, greedy longest-match proposes tokens; each distinct pair of adjacent proposed
tokens is then checked for compatibility - whether merging exactly the two tokens' symbols gives
those two tokens back - for all words together; a word whose pairs are all compatible has its exact
encoding, by the merge order's locality, and only the failing words undergo exact merging.

Decoding joins the tokens' strings with one space, as a vocabulary file without a decoder asks.

Cases: null text counts as empty and has no tokens; an empty table gives an empty table; repeated
rows give equal rows; very long texts are encoded whole, a word of many characters by a heap of
merges; extra columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.arrow import map_slices, texts

#: Entries of a worker's memory of words and of pairs; it starts anew beyond them.
WORDS, PAIRS = 400_000, 2_000_000

#: The code points that the pattern's \s stands for.
SPACES = "\\x09-\\x0D\\x20\\x85\\xA0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000"


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, new = [""] * 256, 256
    for b in range(256):
        if b in plain:
            out[b] = chr(b)
        else:
            out[b] = chr(new)
            new += 1
    return out


class Vocabulary:
    """A word-level BPE vocabulary with word ends, from its JSON file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or not model["end_of_word_suffix"] or spec.get("decoder"):
            raise ValueError("a BPE vocabulary with word ends and without a decoder")
        self.suffix: str = model["end_of_word_suffix"]
        self.ids: dict[str, int] = model["vocab"]
        self.added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.strings = {i: s for s, i in (self.ids | self.added).items()}
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            self.merges[self.ids[a], self.ids[b]] = rank, self.ids[a + b]
        self.symbols = {i: (s.removesuffix(self.suffix), s.endswith(self.suffix) and s != self.suffix) for s, i in self.ids.items()}
        self.inner = {s: i for i, (s, last) in self.symbols.items() if not last}
        self.final = {s: i for i, (s, last) in self.symbols.items() if last}
        self.longest = max(len(s) for s, _ in self.symbols.values())
        self.pattern = regex.compile(
            rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{SPACES}\p{{L}}\p{{N}}]+", regex.V0
        )
        self.plain = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\x09-\x0D\x20a-z0-9]+")
        self.special = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self.chars = byte_characters()
        self.pairs: dict[int, bool] = {}
        self.sound: dict[int, bool] = {}
        #: Ids and ids joined of words, and of added tokens by their ids.
        self.fixed: dict[str | int, tuple[list[int], str]] = {i: ([i], str(i)) for i in self.added.values()}
        self.words = dict(self.fixed)

    # -- cutting

    def cut(self, text: str) -> list[str]:
        """The words of a stretch of text without added tokens; no word holds white space, so runs of it stay as they are."""
        if text.isascii():  # NFC already
            return self.plain.findall(text.lower())
        text = unicodedata.normalize("NFC", text)
        if "Σ" in text:  # lower case by code point knows no final sigma
            text = text.replace("Σ", "σ")
        return self.pattern.findall(text.lower())

    def stretches(self, text: str) -> list[tuple[str, int | None]]:
        """The text between added tokens, each followed by the added token's id or none."""
        if self.special is None:
            return [(text, None)]
        out, at = [], 0
        for m in self.special.finditer(text):
            out.append((text[at : m.start()], self.added[m[0]]))
            at = m.end()
        out.append((text[at:], None))
        return out

    # -- exact merging

    def base(self, symbols: str, last: bool) -> list[int]:
        """Ids of single characters."""
        out = [self.inner[c] for c in symbols]
        if last:
            out[-1] = self.final[symbols[-1]]
        return out

    def merge(self, ids: list[int]) -> list[int]:
        """Merge the best pair again and again, the leftmost of equals."""
        if len(ids) > 64:
            return self.merge_long(ids)
        seen, none = self.merges.get, (1 << 60, -1)
        found = [seen(p, none) for p in zip(ids, ids[1:])]
        while found and (best := min(found)) is not none:
            k = found.index(best)
            ids[k : k + 2] = [best[1]]
            del found[k]
            if k:
                found[k - 1] = seen((ids[k - 1], ids[k]), none)
            if k < len(found):
                found[k] = seen((ids[k], ids[k + 1]), none)
        return ids

    def merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap and links."""
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        live = [True] * n
        heap = [(m[0], k, ids[k], ids[k + 1]) for k in range(n - 1) if (m := self.merges.get((ids[k], ids[k + 1])))]
        heapq.heapify(heap)
        while heap:
            _, k, a, b = heapq.heappop(heap)
            j = after[k] if live[k] else n
            if j >= n or ids[k] != a or ids[j] != b:
                continue
            ids[k] = self.merges[a, b][1]
            live[j] = False
            after[k] = after[j]
            if after[k] < n:
                before[after[k]] = k
            for left, right in ((before[k], k), (k, after[k])):
                if left >= 0 and right < n and (m := self.merges.get((ids[left], ids[right]))):
                    heapq.heappush(heap, (m[0], left, ids[left], ids[right]))
        return [i for i, x in zip(ids, live) if x]

    # -- speculation

    def propose(self, word: str) -> list[int]:
        """Greedy longest match over a word's byte characters."""
        out, at, n = [], 0, len(word)
        inner, longest = self.inner, self.longest
        while at < n:
            if n - at <= longest and (i := self.final.get(word[at:])) is not None:
                out.append(i)
                break
            for end in range(min(n - 1, at + longest), at, -1):
                if (i := inner.get(word[at:end])) is not None:
                    out.append(i)
                    at = end
                    break
        return out

    def compatible(self, pair: int) -> bool:
        """Whether exact merging of two tokens' symbols gives the two tokens."""
        a, b = pair >> 32, pair & 0xFFFFFFFF
        (x, last_x), (y, last_y) = self.symbols[a], self.symbols[b]
        return not last_x and self.merge(self.base(x + y, last_y)) == [a, b]

    def whole(self, token: int) -> bool:
        """Whether a token's own symbols merge to it."""
        symbols, last = self.symbols[token]
        return self.merge(self.base(symbols, last)) == [token]

    def learn(self, words: list[str]) -> dict[str, int]:
        """Encode new words into the memory; counts of proposed and of exactly merged words."""
        if len(self.words) + len(words) > WORDS:
            self.words = dict(self.fixed)
        if len(self.pairs) > PAIRS:
            self.pairs.clear()
        chars = self.chars
        spelt = ["".join([chars[b] for b in w.encode("utf-8")]) for w in words]
        proposals = [self.propose(s) for s in spelt]
        lengths = np.fromiter(map(len, proposals), np.int64, len(proposals))
        flat = np.fromiter((i for p in proposals for i in p), np.int64, int(lengths.sum()))
        owner = np.repeat(np.arange(len(words)), lengths)
        bad = np.zeros(len(words), bool)
        inside = np.flatnonzero(owner[1:] == owner[:-1]) if len(flat) else np.zeros(0, np.int64)
        for keys, whose, known, test in (
            (flat[inside] << 32 | flat[inside + 1], owner[inside], self.pairs, self.compatible),
            (flat, owner, self.sound, self.whole),
        ):
            distinct, place = np.unique(keys, return_inverse=True)
            verdict = np.empty(len(distinct), bool)
            for k, key in enumerate(distinct.tolist()):
                if (v := known.get(key)) is None:
                    v = known[key] = test(key)
                verdict[k] = v
            bad[whose[~verdict[place]]] = True
        for k in np.flatnonzero(bad).tolist():
            proposals[k] = self.merge(self.base(spelt[k], True))
        for w, p in zip(words, proposals):
            self.words[w] = p, " ".join(map(str, p))
        return {"words": len(words), "merged": int(bad.sum())}

    # -- whole texts

    def encode_batch(self, batch: list[str]) -> list[list[tuple[list[int], str]]]:
        """For each text its words as (ids, ids joined)."""
        cut: list[list[str | int]] = []
        for text in batch:
            if self.special is not None and any(a in text for a in self.added):
                parts: list[str | int] = []
                for stretch, special in self.stretches(text):
                    parts += self.cut(stretch)
                    if special is not None:
                        parts.append(special)
            else:
                parts = self.cut(text)
            cut.append(parts)
        words = set().union(*cut)
        new = words.difference(self.words)
        if new:
            if len(self.words) + len(new) > WORDS:
                self.words = dict(self.fixed)
                new = words.difference(self.words)
            self.learn(list(new))
        known = self.words.__getitem__
        return [list(map(known, parts)) for parts in cut]

    def encode(self, text: str | None) -> list[int]:
        return [i for ids, _ in self.encode_batch([text or ""])[0] for i in ids]

    def decode(self, ids: list[int]) -> str:
        return " ".join(map(self.strings.__getitem__, ids))


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    """One vocabulary a worker and file."""
    return Vocabulary(path)


def encode(df: DataFrame, key: str, text: str, path: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """(key, *carry, ids array<int>): every whole text's token ids."""
    names = [key, *carry]

    def run(part: pa.RecordBatch) -> dict:
        got = vocabulary(path).encode_batch(texts(part.column(len(names))))
        ends = np.cumsum([0, *(sum(len(ids) for ids, _ in words) for words in got)])
        flat = np.fromiter((i for words in got for ids, _ in words for i in ids), np.int32, int(ends[-1]))
        ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
        return {n: part.column(k) for k, n in enumerate(names)} | {"ids": ids}

    schema = df.select(*names).schema.add("ids", T.ArrayType(T.IntegerType()))
    return map_slices(df.select(*names, F.col(text).alias("__text")), run, schema, size=2 << 20)


def decode(df: DataFrame, key: str, ids: str, path: str) -> DataFrame:
    """(key, text string): the text of each array of ids; null stays null."""
    kind = df.schema[key].dataType.simpleString()

    def run(part: pa.RecordBatch) -> dict:
        v = vocabulary(path)
        return {key: part.column(0), "text": [None if x is None else v.decode(x) for x in part.column(1).to_pylist()]}

    return map_slices(df.select(key, ids), run, f"`{key}` {kind}, text string", size=2 << 20)


def digests(df: DataFrame, key: str, text: str, path: str) -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256): an encoded and decoded table without its arrays.

    The ids in decimal are joined from each word's own; the text is decoded from the ids produced.
    """
    kind = df.schema[key].dataType.simpleString()

    def run(part: pa.RecordBatch) -> dict:
        v = vocabulary(path)
        n, ids, decoded = [], [], []
        for words in v.encode_batch(texts(part.column(1))):
            each, numbers = zip(*words) if words else ((), ())
            produced = list(chain.from_iterable(each))
            n.append(len(produced))
            ids.append(hashlib.sha256(" ".join(numbers).encode()).hexdigest())
            decoded.append(hashlib.sha256(v.decode(produced).encode("utf-8")).hexdigest())
        return {key: part.column(0), "n_tokens": n, "ids_sha256": ids, "decoded_sha256": decoded}

    return map_slices(df.select(key, text), run, f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string", size=2 << 20)
