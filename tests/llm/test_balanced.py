"""Cost-balanced packing against the tokenizer and a plain assignment."""

import random
import zlib
from functools import cache

import numpy as np
import pytest
from llm_fixtures import SF_SMALL, awkward, awkward_rows, empty

from siltworks.llm import balanced
from siltworks.llm.queries import QUERIES, tokenizer_path


@cache
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def plain_ids(text):
    return tokenizer().encode(text or "", add_special_tokens=False).ids + [1]


def assert_whole(rows, texts, capacity):
    """Every id of every text (by id) in one piece, and sequences without gaps; tokens by sequence."""
    by_doc, places = {}, {}
    for r in rows:
        by_doc.setdefault(r.id, []).append(r)
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert by_doc.keys() == texts.keys()
    for i, text in texts.items():
        ids, at = plain_ids(text), 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            part = ids[at : at + r.length]
            assert (r.start, r.doc_tokens, len(part)) == (at, len(ids), r.length) and r.length > 0
            assert r.ids_crc32 == zlib.crc32(np.array(part, dtype="<u4").tobytes())
            assert r.cost == balanced.LINEAR_COST * r.length + balanced.QUADRATIC_COST * r.length**2
            at += r.length
        assert at == len(ids)
    used = []
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
        used.append(at)
    return used


def test_query_packs_all_documents_without_padding(spark):
    rows = QUERIES["op11_balanced_packing"](spark, SF_SMALL).withColumnRenamed("doc_id", "id").collect()
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    used = assert_whole(rows, {r.doc_id: r.text for r in docs}, balanced.SEQUENCE_TOKENS)
    assert all(n & (n - 1) == 0 for n in used)
    assert sum(n < balanced.SEQUENCE_TOKENS for n in used) <= 11


def test_awkward_rows(spark):
    texts = {k: r[1] for k, r in enumerate(awkward_rows())} | {100: "a <|endoftext|> b", 101: "a ! b !!\n!\n"}
    docs = spark.createDataFrame([(k, t, 0, "x") for k, t in texts.items()], "doc_id long, text string, `at` int, ids string")
    for each in (4096, 3):
        used = assert_whole(balanced.pack(docs, tokenizer_path(), docs_per_group=each).collect(), texts, balanced.SEQUENCE_TOKENS)
        assert all(n & (n - 1) == 0 for n in used)
    found = balanced.pack(awkward(spark), tokenizer_path()).collect()
    assert sum(r.start == 0 for r in found) == len(awkward_rows())
    assert balanced.pack(empty(spark), tokenizer_path()).count() == 0


def test_short_sequences(spark):
    texts = {k: "one two three four five six seven " * (k % 5) for k in range(40)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    used = assert_whole(balanced.pack(docs, tokenizer_path(), sequence_tokens=16).collect(), texts, 16)
    assert all(n & (n - 1) == 0 for n in used)


def plain_assign(lengths, capacity):
    """The same rule, one sequence at a time."""
    room = balanced.capacities(sum(lengths), capacity)
    free, spent, out = list(room), [0] * len(room), []
    left = sorted((-n, k, 0) for k, n in enumerate(lengths))
    while left:
        n, k, start = left.pop(0)
        n = -n
        fitting = [s for s in range(len(room)) if free[s] >= n] or [s for s in range(len(room)) if free[s] > 0]
        best = min(fitting, key=lambda s: (spent[s], s))
        taken = min(n, free[best])
        out.append((k, start, taken, best, room[best] - free[best]))
        free[best] -= taken
        spent[best] += balanced.cost(taken)
        if taken < n:
            left = sorted([*left, (taken - n, k, start + taken)])
    return out, spent


@pytest.mark.parametrize("seed", range(4))
def test_assignment_follows_its_rule(seed):
    draw = random.Random(seed)
    lengths = [draw.randint(1, 63) for _ in range(draw.randint(1, 150))]
    assert balanced.assign(lengths, 64) == plain_assign(lengths, 64)[0]


def test_costs_are_balanced():
    draw = random.Random(7)
    lengths = [1 + min(500, int(draw.lognormvariate(5, 1))) for _ in range(2000)]
    spent = {}
    for _, _, taken, sequence, _ in balanced.assign(lengths, 2048, linear=0, quadratic=1):
        spent[sequence] = spent.get(sequence, 0) + taken**2
    in_order, at = {}, 0
    for n in lengths:  # pieces one after the other, cut where a sequence ends
        while n:
            taken = min(n, 2048 - at % 2048)
            in_order[at // 2048] = in_order.get(at // 2048, 0) + taken**2
            at, n = at + taken, n - taken
    full = [spent[s] for s in range(sum(lengths) // 2048)]
    assert np.std(full) < np.std([in_order[s] for s in range(sum(lengths) // 2048)]) / 2


def test_capacities_are_exact():
    for tokens in (0, 1, 5, 2048, 2049, 5000):
        found = balanced.capacities(tokens, 2048)
        assert sum(found) == tokens and all(n & (n - 1) == 0 for n in found)
