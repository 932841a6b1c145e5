import base64
import random

import public_tokenizers
import pytest
import tiktoken

from ebbtide.llm import queries, rank_bpe

from .plain import CLASHING, frame, sha
from .test_bpe import odd_texts

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def lowest_pair(raw, ranks):
    """The merges of one piece, written out: the leftmost pair of lowest rank, again and again."""
    parts = [raw[i : i + 1] for i in range(len(raw))]
    while len(parts) > 1:
        rank, at = min((ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
        if rank == 1 << 60:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


def long_texts():
    rng = random.Random(5)
    gaps = [" ", "  ", "\n", "\n\n ", "\t ", "   ", " ", " ", "\x85", "\x1c", "", "'", "'s ", "!?", "12", "é", "語"]
    mixed = "".join(rng.choice(["word", "a", "Ünï", "日本語", "x1y2", "'ll"]) + rng.choice(gaps) for _ in range(4000))
    return [mixed, " " * 700 + "x" + " " * 700, "a" * 1500, "\n" * 900 + " end", "'s" * 900, "é" * 800 + " '" * 300]


def test_every_safe_place_is_safe(library):
    for text in odd_texts(150, 7) + [long_texts()[0][:3000]]:
        for place in range(1, len(text)):
            if rank_bpe.alone(text, place):
                apart = library.encode_ordinary(text[:place]) + library.encode_ordinary(text[place:])
                assert apart == library.encode_ordinary(text)


@pytest.mark.parametrize(("long", "solo"), [(50, 200), (50, 10), (7, 7), (400, 100_000)])
def test_long_texts_as_a_whole(library, monkeypatch, long, solo):
    monkeypatch.setattr(rank_bpe, "LONG", long)
    monkeypatch.setattr(rank_bpe, "SOLO", solo)
    monkeypatch.setattr(rank_bpe.safe_parts, "__defaults__", (long,))
    coder = rank_bpe.Encoder(PATH, PATTERN)
    for text in odd_texts(300, 8) + long_texts():
        ids = coder.encode(text)
        assert ids.tolist() == library.encode_ordinary(text)
        assert coder.decode(ids) == text.encode()


def test_a_run_that_the_library_gives_up_on(library):
    coder = rank_bpe.encoder(PATH, PATTERN)
    blanks = " " * 1_500_000
    ids = coder.encode("start" + blanks + "end")
    want = [*library.encode_ordinary("start"), *library._encode_single_piece(blanks[1:]), *library.encode_ordinary(" end")]
    assert ids.tolist() == want


def test_the_merges_written_out(library):
    ranks = {library.decode_single_token_bytes(i): i for i in range(library.n_vocab)}
    coder = rank_bpe.encoder(PATH, PATTERN)
    for text in odd_texts(200, 9):
        want = [i for piece in coder.pieces.finditer(text) for i in lowest_pair(piece[0].encode(), ranks)]
        assert coder.encode(text).tolist() == want


def test_documents(spark, library):
    rows = [(k, t, "s") for k, t in enumerate(odd_texts(60, 4))]
    rows += [(90, None, "s"), (91, "", None), (1, "a b", "s"), (1, "a b", "s"), (None, "é", "s"), (92, "<|endoftext|>", "s")]
    rows += [(93 + k, t, "s") for k, t in enumerate(long_texts())]
    got = rank_bpe.encode_documents(frame(spark, rows, CLASHING), PATH, PATTERN).collect()
    want = [(i, library.encode_ordinary(t or ""), (t or "").encode()) for i, t, _ in rows]
    assert sorted(((r["__row"]["doc_id"], r["ids"], bytes(r["decoded"])) for r in got), key=repr) == sorted(want, key=repr)
    assert rank_bpe.encode_documents(frame(spark, []), PATH, PATTERN).count() == 0


def test_query(spark, library):
    folder = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = queries.QUERIES["op13_rank_bpe"].build(spark, folder).collect()
    assert len(got) == len(docs)
    for row in got:
        ids = library.encode_ordinary(docs[row["doc_id"]])
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == sha(" ".join(map(str, ids)))
        assert row["decoded_sha256"] == sha(docs[row["doc_id"]])
