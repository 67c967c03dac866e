import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tessera.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    return bpe.Vocabulary(PATH)


def cases() -> list[str]:
    rnd = random.Random(7)
    letters = "abcdefghijklmnopqrstuvwxyzéèßñöüçÀÉ'0123456789 .,!?-_\n\t"
    out = ["", " ", "it's we'LL they'RE", "a<|endoftext|>b <|startoftext|> c", "<|endoftext|", "ΣΑΣ ΟΔΟΣ", "İstanbul", "é café", "日本語 テキスト", "a b c\x85d", "\x00\x01 \x1c x", "🙂🙂 👩‍👩‍👧", "²³ ⅷ ½", "aaaa" * 50, "ab" * 400, "supercalifragilistic" * 9]
    for _ in range(300):
        out.append("".join(rnd.choice(letters) for _ in range(rnd.randrange(1, 120))))
    for _ in range(100):
        out.append("".join(rnd.choice("ab") for _ in range(rnd.randrange(1, 40))) + " " + "".join(rnd.choice("thein") for _ in range(rnd.randrange(1, 90))))
    return out


def test_encodes_and_decodes_as_the_library(library, own):
    for text in cases():
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == ids, text
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_whole_documents_and_the_share_that_is_merged(spark, sf, library, own):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    for r in rows:
        assert own.encode(r.text) == library.encode(r.text, add_special_tokens=False).ids
    words = sorted({w for r in rows for w in own.cut(r.text)})
    counts = bpe.Vocabulary(PATH).learn(words)
    assert 0 < counts["merged"] < counts["words"]


def test_heap_equals_scan(own):
    rnd = random.Random(3)
    for _ in range(50):
        ids = own.base("".join(rnd.choice("ethainr") for _ in range(60)), True)
        assert own.merge(list(ids)) == own.merge_long(list(ids))


def test_memory_starts_anew(monkeypatch, library):
    monkeypatch.setattr(bpe, "WORDS", 5)
    own = bpe.Vocabulary(PATH)
    for text in ("one two three four", "five six seven eight nine ten", "one ten two"):
        assert own.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_table(spark, library):
    df = spark.createDataFrame([(1, "Hello there", 5), (2, None, 6), (None, "", 7), (1, "Hello there", 8)], "doc_id long, text string, ids long")
    encoded = bpe.encode(df, "doc_id", "text", PATH)
    assert sorted((r.doc_id or 0, r.ids) for r in encoded.collect()) == sorted([(1, library.encode("hello there").ids)] * 2 + [(2, []), (0, [])])
    assert {r.text for r in bpe.decode(encoded, "doc_id", "ids", PATH).collect()} == {"hello</w> there</w>", ""}
    digests = bpe.digests(df, "doc_id", "text", PATH).collect()
    assert sorted(r.n_tokens for r in digests) == [0, 0, 2, 2]
    assert bpe.digests(df.limit(0), "doc_id", "text", PATH).count() == 0


def test_each_pair_is_looked_up_a_few_times(own):
    """Exact merging looks up a pair when it comes to be, not all pairs again for each merge."""
    class Counted(dict):
        n = 0

        def get(self, *a):
            Counted.n += 1
            return super().get(*a)

    ids = own.base("internationalisation" * 3, True)
    expected = own.merge_long(list(ids))
    merges, own.merges = own.merges, Counted(own.merges)
    try:
        assert own.merge(list(ids)) == expected
    finally:
        own.merges = merges
    assert Counted.n <= 3 * len(ids)


def test_white_space_of_any_kind_parts_words(library, own):
    for text in ("a\t\n b\x0b\x0cc\r\nd", "a\x1cb\x1d \x1ec\x1fd", "É 　x\x85y\xa0 z​w", "  it's\n\n'LL 'x ''s 'S ", "A1B22 c_d-e\x7f\x00"):
        assert own.encode(text) == library.encode(text, add_special_tokens=False).ids, text
