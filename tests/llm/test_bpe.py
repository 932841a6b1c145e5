import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ebbtide.llm import bpe

from .plain import CLASHING, frame

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def odd_texts(n, seed=1):
    rng = random.Random(seed)
    pools = ["abcdefghij ", "THE quick 12.", "é ü ñ   \n\t", "'s 't 're'll d", "日本語テキスト🙂", "\x00\x01\x1c\x1f\x85​ ²½Ⅷ", "   \n\n "]
    whole = ["<|endoftext|>", "aaaaaaaaaaaaaaaa", " " * 9, "\n \n b", "the the the"]
    return [
        "".join(rng.choice(rng.choice(pools)) if rng.random() > 0.03 else rng.choice(whole) for _ in range(rng.randrange(90)))
        for _ in range(n)
    ]


def test_against_the_library(library):
    texts = odd_texts(1500) + ["", " ", "  ", "x" * 5000, "ab " * 3000, "the" * 2000, "<|endoftext|>", "a<|endoftext|> b"]
    ids, back = bpe.encoder(PATH).run(texts + [None])
    for text, own, decoded in zip(texts + [""], ids, back):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(own, "<i4").tolist() == want
        assert decoded == library.decode(want, skip_special_tokens=False)


def test_both_trees_agree():
    v = bpe.encoder(PATH).vocabulary
    rng = random.Random(2)
    pieces = [bytes(rng.choice(b"abcde the") for _ in range(rng.randrange(1, 33))) for _ in range(300)]
    for width in (1, 2, 4, 8, 16, 32):
        some = [p for p in pieces if len(p) <= width] or [b"a"]
        values, counts = v.encode_class(some, width)
        assert [x.tolist() for x in np.split(values, np.cumsum(counts)[:-1])] == [v.encode_one(p) for p in some]


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT", 20)
    coder = bpe.Encoder(PATH)
    for text in odd_texts(200, 3):
        own = coder.run([text, text])[0]
        assert np.frombuffer(own[0], "<i4").tolist() == library.encode(text, add_special_tokens=False).ids == np.frombuffer(own[1], "<i4").tolist()


def test_documents(spark, library):
    rows = [(k, t, "s") for k, t in enumerate(odd_texts(60, 4))] + [(90, None, "s"), (91, "", None), (1, "a b", "s"), (1, "a b", "s"), (None, "é", "s")]
    got = bpe.encode_documents(frame(spark, rows, CLASHING), PATH).collect()
    want = [(i, library.encode(t or "", add_special_tokens=False).ids, t or "") for i, t, _ in rows]
    assert sorted(((r["__row"]["doc_id"], r["ids"], r["decoded"]) for r in got), key=repr) == sorted(want, key=repr)
    assert bpe.encode_documents(frame(spark, []), PATH).count() == 0


def test_a_word_is_encoded_once_whatever_mark_follows(library, monkeypatch):
    coder = bpe.Encoder(PATH)
    encoded = []
    plain = coder.vocabulary.encode_pieces
    monkeypatch.setattr(coder.vocabulary, "encode_pieces", lambda pieces: encoded.extend(pieces) or plain(pieces))
    texts = ["a thonenth, b", "a thonenth. b", "a thonenth\nB thonenth", "a thonenth%%% b", "thonenth  thonenth"]
    for text in texts:
        own, decoded = (x[0] for x in coder.run([text]))
        assert np.frombuffer(own, "<i4").tolist() == library.encode(text, add_special_tokens=False).ids and decoded == text
    assert encoded.count(b" thonenth") == 1 and len(encoded) == len(set(encoded))


def test_gaps_seen_before_and_texts_one_by_one(library):
    """Gaps, marks and special tokens in texts of their own, each after its parts are remembered."""
    coder = bpe.Encoder(PATH)
    texts = ["a \n b", "a\n b", "\n", " \n", "a \x1cb \x1c c", "\x01 a \x00", "a ", " a", "  a", "\nb", "a\xa0 b", "a<|endoftext|> b  c", "", " "]
    for text in texts + texts[::-1]:
        own, decoded = (x[0] for x in coder.run([text]))
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(own, "<i4").tolist() == want and decoded == library.decode(want, skip_special_tokens=False)


def test_wide_trees_and_many_pieces(library):
    """Trees of 32 and of 64 bits give the library's ids."""
    v = bpe.encoder(PATH).vocabulary
    rng = random.Random(6)
    for width in (64, 1024, 1 << 16):
        pieces = ["".join(rng.choice("abcdethis") for _ in range(rng.randrange(1, 60))) for _ in range(40)]
        values, counts = v.encode_class([p.encode() for p in pieces], width)
        got = [x.tolist() for x in np.split(values, np.cumsum(counts)[:-1])]
        assert got == [library.encode(p, add_special_tokens=False).ids for p in pieces]
