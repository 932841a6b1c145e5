"""Plain versions of the operators, for small inputs."""

import hashlib
import random
import re
from collections import Counter, defaultdict

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORDS.findall(text or "")


def normal(line):
    return re.sub(r"[\x20\x09-\x0D]+", " ", line.lower()).strip(" ").translate(str.maketrans("123456789", "000000000"))


def frequent(docs, limit, least, host=2, text=1):
    """(host, line) in more than ``least`` texts and more than ``limit`` of the host's number of texts."""
    texts = {(d[host], d[text]) for d in docs}
    hosts = Counter(h for h, _ in texts)
    held = Counter()
    for h, t in texts:
        for line in {normal(x) for x in (t or "").split("\n") if words(x)}:
            held[h, line] += 1
    return {k for k, n in held.items() if n > least and n > limit(hosts[k[0]])}


def without(text, host, lines):
    if text is None:
        return None
    return "\n".join(x for x in text.split("\n") if not (words(x) and (host, normal(x)) in lines))


def repeat_words(ws):
    at = defaultdict(list)
    for i in range(len(ws) - 2):
        at[tuple(ws[i : i + 3])].append(i)
    return len({k for v in at.values() if len(v) > 1 for i in v for k in (i, i + 1, i + 2)})


def quality(text, host, lines):
    ws = words(text)
    failed = len(ws) < 50 or 100 * repeat_words(ws) > 50 * len(ws)
    left = words(without(text, host, lines))
    return failed, not failed and len(left) >= 0.5 * len(ws)


def bag(text):
    ws = words((text or "").lower())
    return Counter(tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))) if ws else None


def jaccard(a, b):
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both)


def groups(items, linked):
    """The smallest item that each can reach."""
    root = {i: i for i in items}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    ordered = sorted(items)
    for k, a in enumerate(ordered):
        for b in ordered[:k]:
            if linked(a, b):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {i: top(i) for i in items}


def repeats(docs, length):
    """{doc_id: (n_bytes, removed flags)} of (doc_id, text) with distinct ids."""
    seen, out = set(), {}
    for i, text in sorted(docs):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - length + 1):
            if raw[s : s + length] in seen:
                gone[s : s + length] = b"\1" * length
            seen.add(raw[s : s + length])
        out[i] = raw, gone
    return out


def spans(gone):
    return [(m.start(), m.end()) for m in re.finditer(b"\1+", bytes(gone))]


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def prose(rng: random.Random, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Documents with columns named as those that operators use inside.
CLASHING = SCHEMA + ", `key` string, node long, bucket long, copy int, kept boolean, host string, __text string, ids string"


def frame(spark, rows, schema=SCHEMA):
    """(doc_id, text, source) rows with the further columns filled in."""
    extra = schema.count(",") - 4
    return spark.createDataFrame(
        [(i, t, "en", s, None if t is None else len(t), *[None] * extra) for i, t, s in rows], schema
    )
