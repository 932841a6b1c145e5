import random

import numpy as np

from ebbtide.llm import minhash, shingles

from .plain import CLASHING, bag, frame, groups, jaccard, prose


def edited(rng, text, n):
    ws = text.split()
    for _ in range(n):
        ws[rng.randrange(len(ws))] = f"e{rng.randrange(10**6)}"
    return " ".join(ws)


def test_signatures_agree_as_bags_do():
    rng = np.random.default_rng(1)
    texts = 4
    for weights in ([1, 1, 1, 1], [3, 5, 1, 8], [1, 7, 2, 2]):
        shingle = np.concatenate([rng.integers(0, 2**63, 40, dtype=np.uint64)] * texts)
        owner = np.repeat(np.arange(texts), 40)
        weight = np.maximum(1, np.repeat(weights, 40) - np.tile(np.arange(40) % 3, texts) * (owner > 1))
        times = shingles.bag_signatures(owner, shingle, weight, texts, 4000)
        bags = weight.reshape(texts, 40)
        for a in range(texts):
            for b in range(a):
                want = np.minimum(bags[a], bags[b]).sum() / np.maximum(bags[a], bags[b]).sum()
                assert abs((times[a] == times[b]).mean() - want) < 0.035


def test_shingles_of_short_and_odd_texts():
    texts = ["", None, "a", "a b c d", "a b c d e", "a  b\tc\nd e a b c d e", "é b c d"]
    hashes, counts = shingles.word_hashes(texts)
    assert counts.tolist() == [0, 0, 1, 4, 5, 10, 4]
    owner, shingle, weight = shingles.weighted_shingles(hashes, counts)
    want = [bag(t) or {} for t in texts]
    assert [int(weight[owner == k].sum()) for k in range(7)] == [sum(b.values()) for b in want]
    assert [int((owner == k).sum()) for k in range(7)] == [len(b) for b in want]
    assert sorted(weight[owner == 5]) == sorted(want[5].values())
    assert len(set(shingle[(owner == 4)]) & set(shingle[(owner == 5)])) == 1


def corpus():
    rng = random.Random(7)
    base = [prose(rng, rng.randrange(30, 120), 5000) for _ in range(40)]
    rows = [(i, t, "s") for i, t in enumerate(base)]
    for k in range(60):  # a loose group: copies of one base that are near it, and often not near each other
        rows.append((100 + k, edited(rng, base[0], rng.randrange(1, 4)), "s"))
    for k in range(30):
        rows.append((200 + k, edited(rng, base[k % 7 + 1], rng.randrange(1, 4)), "s"))
    rows += [(300 + k, base[9].upper() if k % 2 else base[9].replace(" ", "  "), "s") for k in range(12)]
    odd = [(400, None, "s"), (401, "", None), (402, " \n", "s"), (403, "one two", "s"), (404, "one two", "s"), (405, prose(rng, 20_000), "s")]
    return rows + odd + [rows[3], rows[3]]


def test_against_all_pairs(spark):
    rows = corpus()
    bags = {i: bag(t) for i, t, _ in rows}
    want = groups(bags, lambda a, b: bool(bags[a] and bags[b]) and jaccard(bags[a], bags[b]) >= 0.8 - 1e-9)
    got = minhash.near_duplicates(frame(spark, rows, CLASHING)).collect()
    assert len(got) == len(rows)
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert sorted(r["doc_id"] for r in got if r["kept"]) == sorted(set(want.values()))
    kept = minhash.without_near_duplicates(frame(spark, rows, CLASHING)).select("__row.doc_id").collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(set(want.values()))


def test_what_leaders_miss_is_settled_in_blocks(spark):
    rows = corpus()
    plain = minhash.near_duplicates(frame(spark, rows)).collect()
    blocks = minhash.near_duplicates(frame(spark, rows), minhash.Near(more_leaders=0, block=7)).collect()
    assert sorted(map(repr, plain)) == sorted(map(repr, blocks))


def test_no_rows_and_no_ids(spark):
    assert minhash.near_duplicates(frame(spark, [])).count() == 0
    got = minhash.near_duplicates(frame(spark, [(None, "a b c", "s"), (None, "a b c", "s"), (None, None, None)])).collect()
    assert [r["component_id"] for r in got] == [None] * 3 and sum(r["kept"] for r in got) == 2
