import dataclasses
import random
import zlib

import numpy as np
import pytest

from ebbtide.llm import toxicity

from .plain import CLASHING, frame, prose

NET = toxicity.Network(window=12, stride=6, least_steps=150, max_toxic=200, max_clean=400)


def test_gradients():
    net = toxicity.Network(window=6, hidden=3, vector=2)
    weights = {k: v.astype(np.float64) for k, v in toxicity.start_weights(net).items()}
    rng = np.random.default_rng(0)
    x, mask = rng.standard_normal((6, 4, net.inputs)), np.ones((6, 4), dtype=bool)
    mask[4:, 1] = mask[2:, 2] = False
    y = np.array([1, 0, 1, 0.0])

    def run(keep=False):
        gates = np.stack([x @ weights["x"][k] + weights["b"][k] for k in (0, 1)])
        return toxicity.forward(gates, mask, weights, keep)

    def loss():
        p = toxicity.sigmoid(run()[0])
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    out, kept = run(True)
    grads, gates = toxicity.backward((toxicity.sigmoid(out) - y) / 4, mask, weights, kept)
    grads["x"] = np.stack([np.einsum("tri,trg->ig", x, gates[k]) for k in (0, 1)])
    grads["b"] = gates.sum(axis=(1, 2))
    for name, grad in grads.items():
        at = tuple(rng.integers(0, n) for n in weights[name].shape)
        was, step = weights[name][at], 1e-4
        weights[name][at] = was + step
        above = loss()
        weights[name][at] = was - step
        below = loss()
        weights[name][at] = was
        assert grad[at] == pytest.approx((above - below) / 2 / step, rel=0.02, abs=1e-4)


def labelled(n, seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        toxic = rng.random() < 0.3
        text = prose(rng, rng.randrange(20, 80), 3000).split()
        for _ in range(rng.randrange(1, 4) if toxic else 0):
            text[rng.randrange(len(text))] = rng.choice(["grobian", "nitwit,", "grobianly", "Nitwits"])
        rows.append((" ".join(text), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def model():
    rows = labelled(500, 1)
    return toxicity.fit([t for t, _ in rows], [y for _, y in rows], NET)


def test_held_out_accuracy(model):
    rows = labelled(300, 2)
    said = model.probability(toxicity.Scorer(model).logits([t for t, _ in rows])) >= 0.3
    assert np.mean(said == np.array([y for _, y in rows])) > 0.95


def test_every_window_counts(model):
    scorer = toxicity.Scorer(model)
    clean = prose(random.Random(3), 4000, 3000).split()
    base = scorer.logits([" ".join(clean)])[0]
    for at in (0, 1999, 3999):
        text = clean[:at] + ["nitwit", "grobian"] + clean[at:]
        assert scorer.logits([" ".join(text)])[0] > base + 1


def test_documents(spark, model):
    rows = [(1, "a nitwit", "s"), (1, "a nitwit", "s"), (2, None, "s"), (3, "", None), (None, "w1 w2", "s"), (4, "w1 " * 40_000, "s")]
    got = toxicity.score_documents(frame(spark, rows, CLASHING), model).collect()
    score = {(r["__row"]["doc_id"], r["__row"]["text"]): r["score"] for r in got}
    assert len(got) == 6 and score[2, None] == score[3, ""] == 0.0 and all(0 <= s <= 1 for s in score.values())
    assert toxicity.score_documents(frame(spark, []), model).count() == 0


def test_labels_that_are_held_out_are_never_read(spark):
    rows = labelled(200, 5)
    docs = frame(spark, [(i, t, "s") for i, (t, _) in enumerate(rows)])
    out = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    fits = []
    for flip in (False, True):
        labels = spark.createDataFrame([(i, y ^ int(flip and out(i))) for i, (_, y) in enumerate(rows)], "doc_id long, toxic int")
        fits.append(toxicity.fit_on(docs, labels, NET))
    assert all(np.array_equal(fits[0].weights[k], fits[1].weights[k]) for k in fits[0].weights)
    assert fits[0].scale == fits[1].scale


def test_one_label_or_none(spark):
    model = toxicity.fit(["a b", "c d"], [0, 0], NET)
    assert 0 < model.probability(toxicity.Scorer(model).logits(["a b"]))[0] < 0.5
    assert 0 <= toxicity.fit([], [], NET).probability(np.zeros(1))[0] <= 1


def test_texts_without_spaces_are_read_to_their_end(model):
    clean = prose(random.Random(6), 400, 3000).split()
    for joint in (",", "_", "</b><b>"):
        scorer = toxicity.Scorer(model)
        base, toxic = scorer.logits([joint.join(clean), joint.join(clean + ["nitwit", "grobian"])])
        assert toxic > base + 1
    for text in ("x" * 130 + "nitwit", "-" * 100, "é" * 49 + "z"):
        assert text.endswith(toxicity.text_tokens(text)[-1]) and set("".join(toxicity.text_tokens(text))) == set(text)
    assert toxicity.text_tokens("It's 好天气, ok") == ["it's", "好天", "天气", ",", "ok"]


def test_unspaced_script():
    rng = random.Random(7)

    def some(n):
        rows = []
        for _ in range(n):
            text, toxic = [chr(0x4E00 + rng.randrange(400)) for _ in range(rng.randrange(100, 200))], rng.random() < 0.4
            at = rng.randrange(80, len(text))
            text[at:at] = "鬱龘" if toxic else ""
            rows.append(("".join(text), int(toxic)))
        return rows

    rows, more = some(300), some(150)
    model = toxicity.fit([t for t, _ in rows], [y for _, y in rows], NET)
    said = model.probability(toxicity.Scorer(model).logits([t for t, _ in more])) >= 0.3
    assert np.mean(said == np.array([y for _, y in more])) > 0.9


def test_texts_with_one_header_are_all_learnt_from():
    header = "welcome to the forum of the old town please read on "
    rows, more = [[(header + t, y) for t, y in labelled(n, seed)] for n, seed in ((400, 8), (200, 9))]
    model = toxicity.fit([t for t, _ in rows], [y for _, y in rows], NET)
    said = model.probability(toxicity.Scorer(model).logits([t for t, _ in more])) >= 0.3
    assert np.mean(said == np.array([y for _, y in more])) > 0.95


def test_halves():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 5000, 300)
    near = [np.append(base, k) for k in range(10)]
    rows = near + [rng.integers(0, 5000, 200) for _ in range(40)]
    half = toxicity.deal_halves(rows, np.array([1] * 20 + [0] * 30), NET)
    assert len(set(half[:10])) == 1 and sorted(np.bincount(half[20:])) == [15, 15]
    assert sorted(np.bincount(toxicity.deal_halves(near, np.ones(10, dtype=int), NET))) == [5, 5]


def test_the_draw_counts_copies_once(spark, monkeypatch):
    texts = [(f"text {k % 20} of its kind", int(k % 20 < 10)) for k in range(400)] + [("text 3 of its kind", 0)]
    docs = frame(spark, [(i, t, "s") for i, (t, _) in enumerate(texts)] + [(0, texts[0][0], "s")])
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(texts)], "doc_id long, toxic int")
    monkeypatch.setattr(toxicity, "fit", lambda texts, labels, net: sorted(zip(texts, labels)))
    got = toxicity.fit_on(docs, labels, toxicity.Network(max_toxic=8, max_clean=20))
    assert len(got) == len(set(got)) and sum(y for _, y in got) == 8
    out = zlib.crc32(b"400") % 4 == 2
    assert len([t for t, y in got if not y]) == 11 - out


def test_where_a_passage_stands_changes_nothing(model):
    net = dataclasses.replace(NET, stride=toxicity.Network().stride)
    scorer = toxicity.Scorer(toxicity.Model(net, model.weights, model.word_odds, model.gram_odds, model.scale))
    rng = random.Random(10)
    clean, passage = prose(rng, 200, 3000).split(), prose(rng, net.window, 3000).split()
    passage[0], passage[-1] = "nitwit", "grobian"
    alone = scorer.logits([" ".join(passage)])[0]
    moved = scorer.logits([" ".join(clean[: 40 + k] + passage + clean[40 + k :]) for k in range(16)])
    assert (moved >= alone - 1e-4).all() and (model.probability(moved) >= 0.3).all()


@pytest.mark.parametrize("stride", [1, 2, 7])
def test_outputs_by_feature(model, stride):
    net = dataclasses.replace(NET, stride=stride)
    own = toxicity.Model(net, model.weights, model.word_odds, model.gram_odds, model.scale)
    texts = [prose(random.Random(k), n, 3000) for k, n in enumerate((1, 5, 11, 12, 13, 40, 700))] + ["", None]
    scorer = toxicity.Scorer(own)
    got = scorer.logits(texts)
    for text, value in zip(texts[:-2], got):
        ids = np.array([scorer.ids[w] for w in toxicity.text_tokens(text)])
        at, mask = toxicity.window_words(ids, toxicity.window_starts(len(ids), net), net)
        out, _ = toxicity.forward(np.moveaxis(scorer.gates[at], 2, 0), mask, own.weights)
        assert value == pytest.approx(out.max(), abs=1e-4)
    assert (got[-2:] == -np.inf).all()


def plain_score(model, text):
    """Every window of a text, word by word: both recurrences, the attention, the output, the scale."""
    net, w, words = model.net, model.weights, toxicity.text_tokens(text)
    if not words:
        return 0.0
    gates, h = model.gates(words), net.hidden
    logistic = lambda x: 1 / (1 + np.exp(-x))
    best = -np.inf
    for first in range(max(1, len(words) - net.window + 1)):
        places = list(range(first, min(first + net.window, len(words))))
        states = {}
        for d, order in ((0, places), (1, places[::-1])):
            state = np.zeros(h)
            for k in order:
                own = state @ w["h"][d]
                z, r = logistic(gates[k, d, :h] + own[:h]), logistic(gates[k, d, h : 2 * h] + own[h : 2 * h])
                state = (1 - z) * np.tanh(gates[k, d, 2 * h :] + r * own[2 * h :]) + z * state
                states.setdefault(k, []).append(state)
        both = [np.concatenate(states[k]) for k in places]
        level = np.array([np.tanh(s @ w["a"] + w["a_b"]) @ w["a_v"] for s in both])
        share = np.exp(level - level.max())
        best = max(best, sum(a * s for a, s in zip(share / share.sum(), both)) @ w["o"] + w["o_b"][0])
    return float(logistic(model.scale[0] * best + model.scale[1]))


def test_scores_equal_a_plain_scorer(spark):
    rng = random.Random(8)
    texts = [" ".join(f"w{rng.randrange(50)}" + rng.choice(["", ".", "!"]) for _ in range(rng.randrange(1, 70))) for _ in range(40)]
    bad = [t + " vile awful scum " + t for t in texts[:15]]
    model = toxicity.fit(texts + bad, [0] * 40 + [1] * 15, toxicity.Network(epochs=2, least_steps=60))
    rows = [(k, t, "s") for k, t in enumerate(texts[:12] + bad[:6] + ["", "one", "\u65e5\u672c\u8a9e\u306e\u6587", texts[3], texts[3]])] + [(99, None, "s")]
    got = toxicity.score_documents(frame(spark, rows, CLASHING).repartition(3), model).collect()
    assert len(got) == len(rows)
    text_of = {i: t for i, t, _ in rows}
    for row in got:
        assert row["score"] == pytest.approx(plain_score(model, text_of[row["__row"]["doc_id"]]), abs=2e-5)
