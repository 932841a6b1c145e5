import math
import random
from collections import Counter

import pytest

from ebbtide.llm import secrets

from .plain import CLASHING, frame


def test_entropy_by_increments():
    rng = random.Random(1)
    text = "".join(rng.choice("abcdef0123456789zZ") for _ in range(200))
    for window in (2, 20, 200, 201):
        plain = [
            -sum(n / window * math.log2(n / window) for n in Counter(text[i : i + window]).values())
            for i in range(len(text) - window + 1)
        ]
        assert secrets.entropy_windows(text, window) == pytest.approx(plain)


SCAN = secrets.Scanner(secrets.Entropy()).scan


def test_base_spans():
    found = lambda t: [(a, b) for a, k, b in SCAN(t) if k < 3]
    assert found("API_KEY = 'abcdef'") == [(0, 17)]
    assert found("my password:12345") == []  # too short, and taken by the match
    assert found("paſſword=abcdef") == []  # only ASCII letters in either case
    assert found("é token=\"abc.def=\"") == [(2, 17)]
    assert found("AKIA" + "A" * 15) == [] and found("xAKIA" + "A1" * 8) == [(1, 21)]
    assert found("a" * 23) == [] and found("g" + "0" * 24 + "G") == [(1, 25)]


def test_entropy_and_the_allow_list():
    kinds = lambda t: {secrets.KINDS[k] for _, k, _ in SCAN(t)}
    assert kinds("x 9fK2LmQ8vR4tZ7wXc1Bn5YdE0hGp z") == {"entropy_base64"}
    assert kinds("9fK2LmQ8vR4tZ7wXc1Bnexample5YdE0hGp") == set()
    assert kinds("123e4567-e89b-12d3-a456-426614174000") == set()
    assert kinds("internationalizationofthings") == set() and kinds("0" * 40 + "g") == {"hex"}
    assert {"hex", "entropy_hex"} <= kinds("531ccd051a92ebcb689f7b2a44de01c6")


def entropy(text):
    return [(a, b) for a, k, b in SCAN(text) if k >= 3]


def test_keys_with_slashes_are_found():
    rng = random.Random(4)
    signs = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    keys = ["".join(rng.choice(signs) for _ in range(40)) for _ in range(3000)]
    found = lambda some: sum(bool(entropy(k)) for k in some) / len(some)
    slashed = [k for k in keys if "/" in k and "+" not in k]
    assert len(slashed) > 500 and found(slashed) > found([k for k in keys if "/" not in k]) - 0.01 > 0.97
    assert entropy("Q7/wX2/a9Zk/Lm4R/t8VbN/3cYh/Gp6Ds")  # no piece of a window's length


def test_paths_of_words_and_tokens_in_them():
    for path in (
        "/usr/local/lib/python3/site-packages/numpy/core/include",
        "archive/2024/11/05/how-to-bake-bread-at-home-part2",
        "com/items/123e4567-e89b-12d3-a456-426614174000/edit",
        "src/main/java/org/apache/commonsLang3/StringUtilsTest1",
    ):
        assert entropy(path) == []
    token = "9fK2LmQ8vR4tZ7wXc1Bn5YdE0hGp"
    for text in (f"https://hooks.chat.test/services/T024BE7LD/B7XK29QZ1/{token}", f"/v1/{token}/items", f"docs/read/{token}"):
        (start, end), = entropy(text)
        assert start <= text.index(token) and end >= text.index(token) + len(token)


def test_a_placeholder_speaks_for_its_surroundings_only():
    assert entropy("wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY") == []
    rng = random.Random(5)
    run = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(600))
    spans = entropy(run[:300] + "dummy" + run[300:])
    assert spans[0][0] < 10 and spans[-1][1] > 595 and sum(b - a for a, b in spans) > 450


def test_documents(spark):
    key = "token=" + "Ab3" * 5
    rows = [(1, key, "s"), (1, key, "s"), (2, None, None), (3, "", "s"), (None, "word " * 30_000 + key, "s")]
    got = secrets.scan_documents(frame(spark, rows, CLASHING)).collect()
    spans = sorted((r["__row"]["doc_id"] or 0, [tuple(s) for s in r["spans"] if s["kind"] == "assign"]) for r in got)
    assert spans == [(0, [("assign", 150_000, 150_021)]), (1, [("assign", 0, 21)]), (1, [("assign", 0, 21)]), (2, []), (3, [])]
    assert secrets.scan_documents(frame(spark, [])).count() == 0
