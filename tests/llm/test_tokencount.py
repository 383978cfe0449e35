import random

import pytest

from boxlake.llm import tokencount
from tests.llm.data import EDGE, docs, prose

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


def whole(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    return [len(e.ids) for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_counts_match_the_library(spark):
    r = random.Random(4)
    odd = ["<|endoftext|>", "a<|startoftext|>b", "é ́x", "it's they'LL ''s", " 　x\x1cy\x85z\xa0w", "ΣΑΣ ΣΑΣ", "\U0001f600" * 9, "12345 ½²", "한", "don't" * 3000, "," * 20_000]
    odd += ["".join(r.choice("abcXYZ 0'é\ń.,<|> ") for _ in range(300)) for _ in range(50)]
    rows = [*EDGE, *((100 + i, t, "en", "s") for i, t in enumerate(odd))]
    got = tokencount.counts(docs(spark, rows), PATH).collect()
    want = sorted(((i, len((t or "").encode()), n) for (i, t, *_), n in zip(rows, whole([t for _, t, *_ in rows]), strict=True)), key=str)
    assert sorted(((x.doc_id, x.n_bytes, x.n_tokens) for x in got), key=str) == want
    assert all(x.over_limit == (x.n_tokens > 2048) for x in got)
    assert tokencount.counts(docs(spark, []), PATH).count() == 0


@pytest.mark.parametrize("chunk, overlap", [(64, 8), (200, 16), (900, 64), (16_384, 256)])
def test_splicing(chunk, overlap):
    c = tokencount.Counter(PATH)
    r = random.Random(chunk)
    texts = ["x" * 5000, "ab" * 3000, "".join(r.choice("abcdefghij") for _ in range(6000)), ("unbelievable" * 9 + "!!") * 40, prose(7, 900), "a" * 63 + "," * 2000, "日本語。" * 700, "<|endoftext|>" * 300, "don't " * 900]
    texts += ["".join(r.choice("abcXYZ 0'é\u0301.,<|>\n") for _ in range(5000)) for _ in range(10)]
    for t in texts:
        assert tokencount.spliced(t, c.encode, c.ends, chunk, overlap) == len(c.encode(t)[0]), t[:30]


#: Letters of one to four bytes, characters of several tokens, marks that compose, jamo, ligatures, letters that grow when lower-cased.
MIXED = ["a", "b", "é", "\ufb01", "\u1e9e", "\u6f22", "\u3400", "\u0130", "\u0958", "\u0301", "\u0344", "\u1100", "\u1161", "\u11a8", "\U00020000", "\U0001f600", "7", "½", "'s", "!", " ", "\n", "<|endoftext|>"]


@pytest.mark.parametrize("chunk, overlap, n, size", [(64, 8, 300, 600), (200, 16, 100, 2000), (16_384, 256, 3, 60_000)])
def test_characters_of_several_tokens(chunk, overlap, n, size):
    c, r = tokencount.Counter(PATH), random.Random(overlap)
    for _ in range(n):
        some = r.sample(MIXED, r.randint(2, 9))
        t = "".join(r.choice(some) * r.choice([1, 1, 1, 5, 40]) for _ in range(size // 4))[:size]
        assert tokencount.spliced(t, c.encode, c.ends, chunk, overlap) == len(c.encode(t)[0]), t[:60]


def test_a_boundary_inside_a_character_of_several_tokens():
    c = tokencount.Counter(PATH)
    for x in ["\ufb01", "\u1e9e", "\u6f22", "\u3400"]:
        t = ("ab " * 4000).ljust(16_255, "q") + " " + x + "z" * 40_000
        assert c.count(t) == len(c.encode(t)[0])


def test_huge_documents(monkeypatch):
    c = tokencount.Counter(PATH)
    text = prose(8, 3000) + "\n\n" + "é" * 400 + prose(9, 3000)
    want = len(c.encode(text)[0])
    assert c.count(text) == want
    monkeypatch.setattr(tokencount, "HUGE", 100)
    assert c.count(text) == want and c.count(text.replace(" ", "\n")) == want


def test_other_tokenizers_are_encoded_whole(spark):
    import json

    from tokenizers import Tokenizer

    assert tokencount.Counter(PATH).by_pieces
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert not tokencount.Counter(path).by_pieces  # a byte-level splitter keeps blanks
    t = Tokenizer.from_file(path)
    rows = [(1, "a  b \n\n c" * 50, "en", "s"), (2, prose(1, 9000), "en", "s"), (3, None, None, None)]
    got = tokencount.counts(docs(spark, rows), path).collect()
    assert sorted((x.doc_id, x.n_tokens) for x in got) == [(i, len(t.encode(x or "", add_special_tokens=False))) for i, x, *_ in rows]
    with open(PATH, encoding="utf-8") as f:
        config = json.load(f)
    changes = [("normalizer", {"type": "NFC"}), ("post_processor", {"type": "ByteLevel"}), ("pre_tokenizer", None), ("added_tokens", [{"content": "a b", "lstrip": False, "rstrip": False, "single_word": False}])]
    for k, v in changes:
        assert not tokencount.drops_blanks(config | {k: v})
