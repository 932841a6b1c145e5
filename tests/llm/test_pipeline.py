import importlib
import random

import public_tokenizers
from tokenizers import Tokenizer

from .plain import CLASHING, bag, frame, frequent, groups, jaccard, prose, quality, sha, without, words

pipeline = importlib.import_module("corpus_pipeline")


def documents():
    rng = random.Random(3)
    rows = []
    for i in range(150):
        text = "\n".join(prose(rng, rng.randrange(20, 60), 3000) for _ in range(rng.randrange(1, 5)))
        shared = "Menu of the site\n" * (i % 2) + "Share this page\n" * (i % 10 in (1, 2, 3))
        rows.append((i, shared + text, f"s{i % 3}" if i % 10 else None))
    notice = "Notice " + " ".join(f"part{k}" for k in range(90)) + "\n"
    rows += [(400 + i, notice + prose(rng, 30 + i, 3000), "s2") for i in range(24)]
    rows += [(450 + i, notice + prose(rng, 200, 3000), "s2") for i in range(3)]
    rows += [(200 + i, rows[i][1] + " more", "s0") for i in range(20)]
    return rows + [(300, None, "s1"), (301, "", "s1"), (302, "too short", "s2"), rows[7], rows[7], (None, rows[8][1] + "\nown end", "s1")]


def test_stages_against_plain_versions(spark, tmp_path):
    rows = documents()
    docs = frame(spark, rows, CLASHING)
    steps = {}
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, "")
        out.write.parquet(str(tmp_path / name))
        docs = steps[name] = spark.read.parquet(str(tmp_path / name))
        if name != "bpe_tokens":
            assert docs.columns == frame(spark, [], CLASHING).columns
            assert docs.filter("n_chars <> char_length(text)").count() == 0

    def content(name):
        return sorted(((r["doc_id"], r["text"], r["source"]) for r in steps[name].collect()), key=repr)

    menu = frequent(rows, lambda h: 2 * h**0.5, 20, host=2)
    first = [(i, without(t, s, menu), s) for i, t, s in rows if quality(t, s, menu)[1]]
    assert menu and content("quality_rules") == sorted(first, key=repr)
    assert any(not failed and not kept for failed, kept in (quality(t, s, menu) for _, t, s in rows))
    again = frequent(first, lambda h: 0.02 * h, 10, host=2)
    assert again and not again & menu
    second = [(i, without(t, s, again), s) for i, t, s in first]
    assert content("line_dedup") == sorted(second, key=repr)
    keyed = dict(enumerate(sorted(second, key=lambda r: (r[0] is None, r[0]))))
    bags = {k: bag(r[1]) for k, r in keyed.items()}
    group = groups(bags, lambda a, b: jaccard(bags[a], bags[b]) >= 0.8 - 1e-9)
    assert content("near_dedup") == sorted((keyed[k] for k in set(group.values())), key=repr)

    kept = {i: t for i, t, _ in content("near_dedup")}
    for i, t, _ in content("source_mix"):
        rest = iter(words(kept[i]))
        assert words(t) and all(w in rest for w in words(t))
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for i, t, _ in content("source_mix"):
        ids = library.encode(t, add_special_tokens=False).ids
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(t)))
    assert sorted((tuple(r) for r in docs.collect()), key=repr) == sorted(want, key=repr)


def test_empty_tables(spark):
    for _, stage in pipeline.STAGES:
        assert stage(spark, frame(spark, []), "").count() == 0
