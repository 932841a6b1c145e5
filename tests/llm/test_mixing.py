import random
from collections import defaultdict

import pytest

from ebbtide.llm import mixing

from .plain import CLASHING, frame, prose, words


def documents():
    rng = random.Random(4)
    rows = [(i, prose(rng, rng.randrange(1, 300)), ["a", "b", "c", "d", None][min(4, rng.randrange(9))]) for i in range(300)]
    odd = [(900, None, "a"), (901, "", "b"), (902, " \t", "e"), (903, prose(rng, 20_000), "c")]
    return rows + odd + [rows[0], rows[0], (None, "x y", "a"), (None, "x y", "a")]


def filled(sizes, weights, most=3):
    """Shares by weight of all tokens, none above ``most`` times its size."""
    total, capped = sum(sizes.values()), {}
    while True:
        rest = [s for s in sizes if s not in capped]
        level = (total - sum(capped.values())) / max(1, sum(weights[s] for s in rest))
        over = [s for s in rest if level * weights[s] >= most * sizes[s]]
        if not over:
            return capped | {s: level * weights[s] for s in rest}
        capped |= {s: most * sizes[s] for s in over}


def test_targets_and_taken(spark):
    rows = documents()
    got = mixing.mixed_counts(frame(spark, rows, CLASHING)).collect()
    again = mixing.mixed_counts(frame(spark, rows[::-1]).repartition(7)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    size_of = defaultdict(int)
    for _, t, s in rows:
        size_of[s] += len(words(t))
    order = sorted((s for s in size_of if s is not None)) + [None]
    want = filled(size_of, {s: (1, 2, 3)[k % 3] for k, s in enumerate(order)})
    by_target = defaultdict(int)
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"]
        by_target[r["target"]] += r["taken"]
    assert sorted(by_target) == pytest.approx(sorted(set(want.values())))
    for target, taken in by_target.items():
        alike = sum(1 for v in want.values() if v == pytest.approx(target))
        assert abs(taken - alike * target) <= 0.01 * sum(size_of.values()) / len(size_of) + 5


@pytest.mark.parametrize("seats", [0, 1, 7, 50, 1000])
def test_apportionment_against_highest_quotients(spark, seats):
    rng = random.Random(seats)
    votes = [rng.choice([0, 1, 5, 5, 17, 300, 4000]) for _ in range(15)] + [9]
    parties = spark.createDataFrame([(k, v, seats) for k, v in enumerate(votes)], "name int, votes long, seats long")
    got = {r["name"]: r["quota"] for r in mixing.apportion(parties, parties["seats"], parties["votes"], [], "name").collect()}
    quotients = sorted(((-v / (2 * s - 1), k, s) for k, v in enumerate(votes) if v for s in range(1, seats + 1)))[:seats]
    want = {k: sum(1 for q in quotients if q[1] == k) for k in range(len(votes))}
    assert got == want


def test_documents_follow_the_plan(spark):
    rows = documents()
    counts = mixing.mixed_counts(frame(spark, rows)).collect()
    out = [r["__row"] for r in mixing.mixed_documents(frame(spark, rows)).collect()]
    assert sum(len(words(r["text"])) for r in out) == sum(r["taken"] for r in counts)
    whole = {(i, t) for i, t, _ in rows}
    by_id = defaultdict(list)
    for r in out:
        by_id[r["doc_id"]].append(r["text"])
    text_of = dict((i, t) for i, t, _ in rows)
    for i, texts in by_id.items():
        for t in texts:  # in order, from its document
            rest = iter(words(text_of[i]))
            assert all(w in rest for w in words(t))
    assert any((r["doc_id"], r["text"]) in whole for r in out)


def test_nothing_to_mix(spark):
    assert mixing.mixed_counts(frame(spark, [])).count() == 0
    row = mixing.mixed_counts(frame(spark, [(1, None, None), (2, "", "a")])).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in row] == [(0, 0.0, 0)] * 2
