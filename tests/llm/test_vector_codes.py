"""Product codes against a plain search over all entries."""

import hashlib
import math
import random
from fractions import Fraction

import numpy as np
import pytest

from siltworks.llm import vector_codes

SCHEMA = "vec_id long, embedding array<float>, label string, v int, `row` string, l int"


def plain(rows, parts=8, entries=16, rounds=6, scale=4096):
    """{place: (code, error)} and the digest, in Python integers."""
    kept = [(k, r) for k, r in enumerate(rows) if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    if not kept:
        return {}, None
    longest = max(len(r[1]) for _, r in kept)
    each = -(-longest // parts)

    def cut(v):
        whole = [math.floor(Fraction(float(x)) * scale) for x in v]
        whole = [max(-vector_codes.LARGEST, min(vector_codes.LARGEST, x)) for x in whole] + [0] * (parts * each - len(v))
        return [whole[p * each : (p + 1) * each] for p in range(parts)]

    cuts = {k: cut(r[1]) for k, r in kept}
    first = sorted(kept, key=lambda x: (x[1][0] is None, x[1][0] or 0, list(x[1][1])))[:entries]
    books = [[cuts[k][p] for k, _ in first] for p in range(parts)]

    def nearest(p, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, entry)), e) for e, entry in enumerate(books[p]))

    for _ in range(rounds):
        moved = []
        for p in range(parts):
            own = [[] for _ in books[p]]
            for k, _ in kept:
                own[nearest(p, cuts[k][p])[1]].append(cuts[k][p])
            moved.append([[sum(x) // len(m) for x in zip(*m)] if m else b for m, b in zip(own, books[p])])
        books = moved
    found = {}
    for k, _ in kept:
        near = [nearest(p, cuts[k][p]) for p in range(parts)]
        found[k] = ("".join(f"{e:02x}" for _, e in near), sum(d for d, _ in near))
    text = ",".join(str(x) for b in books for entry in b for x in entry)
    return found, hashlib.sha256(text.encode()).hexdigest()


def assert_same(spark, rows, **how):
    table = spark.createDataFrame([(r[0], r[1], r[2], 1, "x", 2) for r in rows], SCHEMA).repartition(3)
    got = vector_codes.encode(table, **how)[0].collect()
    expected, digest = plain([(r[0], None if r[1] is None else [None if x is None else np.float32(x) for x in r[1]], r[2]) for r in rows], **how)
    by_label = {}
    for k, (_, error) in expected.items():
        by_label[rows[k][2]] = by_label.get(rows[k][2], 0) + error
    fits = lambda x: x if x < 1 << 63 else None
    wanted = [(rows[k][0], c, fits(e), fits(by_label[rows[k][2]]), digest) for k, (c, e) in expected.items()]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, wanted))


def drawn(n, width, seed=1, ties=False):
    draw = random.Random(seed)
    value = (lambda: draw.choice([-0.5, 0.0, 0.25])) if ties else (lambda: draw.gauss(0, 1))
    return [(k, [value() for _ in range(width)], draw.choice(["a", "b", None])) for k in range(n)]


@pytest.mark.parametrize("rows", [drawn(120, 16), drawn(80, 8, ties=True), drawn(5, 24)], ids=["normal", "ties", "few"])
def test_equals_the_plain_search(spark, rows):
    assert_same(spark, rows)


def test_awkward_vectors(spark):
    rows = drawn(40, 16)
    rows += [rows[3], rows[3], (None, rows[4][1], "a"), (None, None, None), (70, [], "b"), (71, [1.0] * 5, None)]
    rows += [(72, [None] + [0.0] * 15, "a"), (73, [float("nan")] * 16, "a"), (74, [float("inf")] + [0.0] * 15, "a"), (-9, [0.1] * 19, "c")]
    assert_same(spark, rows)


def test_vectors_beyond_64_bit_distances(spark):
    assert_same(spark, drawn(30, 8) + [(50, [1e9] * 8, "far"), (51, [-3e30] * 8, "farther"), (-1, [70000.0] * 8, None)])


def test_nothing_usable(spark):
    none = spark.createDataFrame([(1, None, "a", 1, "x", 2), (2, [float("nan")], "a", 1, "x", 2)], SCHEMA)
    for table in (none, none.limit(0)):
        found, books = vector_codes.encode(table)
        assert found.count() == 0 and books is None
        assert dict(found.dtypes) == {"id": "bigint", "code": "string", "error": "bigint", "label_error": "bigint", "codebooks_sha256": "string"}


def test_many_labels_take_both_ways(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "HOT_SHARE", 3)
    rows = [(k, v, "hot" if k % 2 else (f"l{k}" if k % 4 else None)) for k, v, _ in drawn(60, 8)]
    assert_same(spark, rows)


def test_search_skips_entries_it_need_not_look_at():
    draw = np.random.default_rng(5)
    entries = draw.integers(-5000, 5000, (64, 4))
    points = draw.integers(-5000, 5000, (3000, 4))
    # some points lie right between entries, some entries are equal
    entries[40:44] = entries[0]
    points[:64] = (entries + entries[::-1]) // 2
    all_ = ((points[:, None, :] - entries[None]) ** 2).sum(axis=2)
    entry, distance = vector_codes.Orchard(entries).nearest(points)
    assert (entry == all_.argmin(axis=1)).all() and (distance == all_.min(axis=1)).all()


def test_search_stops_beyond_twice_the_distance(monkeypatch):
    entries = np.array([[1000 * k] for k in range(100)])
    seen = []
    squares = vector_codes._squares
    search = vector_codes.Orchard(entries)
    monkeypatch.setattr(vector_codes, "_squares", lambda a, b: seen.append(len(a)) or squares(a, b))
    search.nearest(np.array([[10], [20], [2990]]))
    assert sum(seen) < 20
