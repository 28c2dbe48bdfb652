"""Spelling variants against all pairs of a small vocabulary."""

import random
import re
import zlib
from collections import Counter

from llm_fixtures import awkward, empty

from siltworks.llm import spelling

SCHEMA = "doc_id long, text string, word string, n int, `a.b` string"


def plain_words(docs, least=7, misspelt=31):
    n = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if misspelt and h % misspelt == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least:
                n[run] += 1
    return {w: c for w, c in n.items() if c >= 2}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(a == b[:k] + b[k + 1 :] for k in range(len(b)))


def plain_variants(words):
    near = {w: [o for o in words if is_near(w, o)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best and words[best] >= 10 * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return out


def spelt(seed=2):
    """Documents over a few stems, their misspellings and chains of them."""
    draw = random.Random(seed)
    stems = ["sandbank", "Sandbänke", "meadows", "aabbaabb", "ÀÉÎõüÿß×", "rivermouth"]
    letters = "abdemnrswÀéÿ"
    texts = []
    for _ in range(400):
        words = []
        for _ in range(25):
            w = draw.choices(stems, [60, 20, 10, 5, 3, 2])[0]
            for _ in range(draw.choices([0, 1, 2], [90, 8, 2])[0]):
                at = draw.randrange(len(w))
                w = draw.choice([w[:at] + w[at + 1 :], w[:at] + draw.choice(letters) + w[at:], w[:at] + draw.choice(letters) + w[at + 1 :]])
            words.append(w)
        texts.append(draw.choice([" ", ", ", "-"]).join(words))
    return list(enumerate(texts))


def run(spark, docs, **how):
    table = spark.createDataFrame([(i, t, "clash", 3, "x") for i, t in docs], SCHEMA)
    return {tuple(r) for r in spelling.variants(table, **how).collect()}


def test_equals_all_pairs(spark):
    docs = spelt()
    wanted = plain_variants(plain_words(docs))
    assert sum(r[1] is not None for r in wanted) > 50 and any(r[1] != r[2] and r[1] for r in wanted)
    assert run(spark, docs) == wanted


def test_filters_in_rounds_give_the_same(spark):
    docs = spelt(3)
    words = plain_words(docs, misspelt=0)
    assert len(spelling.rounds_of(Counter(map(len, words)), 128)) > 3
    assert run(spark, docs, misspelt=0, filter_bytes=128) == plain_variants(words)


def test_awkward_texts(spark):
    long = "ab" * 20_000
    docs = [(None, None), (1, ""), (2, "   "), (None, "lantern lantern LANTERN"), (3, "lanterns lanterns"), (3, "lanterns lanterns")]
    docs += [(4, long), (5, long), (6, long[:-1]), (7, long[:-1]), (8, "日本語 lantern日本 ınterns"), (9, "short words only")]
    # the plain comparison of the long pair is the slow part
    assert run(spark, docs, misspelt=0) == plain_variants(plain_words(docs, misspelt=0))
    assert run(spark, docs) == plain_variants(plain_words(docs))


def test_very_long_words_are_edited_in_stretches(spark, monkeypatch):
    monkeypatch.setattr(spelling, "EDITED_LETTERS", 4)
    letters = spelling._letters(["aabcbba", "zzzzzzz"]).astype("uint64")
    everything = {k: (spelling.Span(k, 1, 0, 1), spelling.np.full((1, 8), 2**64 - 1, dtype="uint64")) for k in (6, 7)}
    found = [(int(w), int(p), int(c)) for ws, ps, cs in spelling._edited(letters, everything, spelling.LETTERS) for w, p, c in zip(ws, ps, cs)]
    deleted = {("aabcbba"[:p] + "aabcbba"[p + 1 :]) for w, p, c in found if w == 0 and not c}
    assert deleted == {"aabcbba"[:k] + "aabcbba"[k + 1 :] for k in range(7)}
    assert sum(w == 1 and not c for w, p, c in found) == 1
    assert sum(w == 1 and c > 0 for w, p, c in found) == 7 * 64


def test_hashes_of_edits_are_hashes_of_the_edited_words():
    words = ["sandbank", "sandbÿnk", "aaaabbbb"]
    letters = spelling._letters(words).astype("uint64")
    made = set()
    for length in (7, 8):
        every = {length: (spelling.Span(length, 1 << 20, 0, 1 << 20), None)}
        seen = []
        original, spelling._seen = spelling._seen, lambda h, span, filled: seen.append(h) or spelling.np.arange(len(h))
        try:
            for (ws, ps, cs), h in zip(spelling._edited(letters, every, spelling.LETTERS), seen):
                for w, p, c, x in zip(ws.tolist(), ps.tolist(), cs.tolist(), h.tolist()):
                    edited = words[w][:p] + (chr(c) if c else "") + words[w][p + 1 :]
                    assert x == int(spelling._hashes(spelling._letters([edited]))[0])
                    made.add(edited)
        finally:
            spelling._seen = original
    assert "sndbank" in made and "sandbÿnt" in made


def test_empty_and_awkward_tables(spark):
    assert spelling.variants(empty(spark)).count() == 0
    found = {r.word: r.n for r in spelling.variants(awkward(spark), misspelt=0).collect()}
    assert all(len(w) >= 7 and n >= 2 for w, n in found.items()) and "x" * 50_000 not in found
