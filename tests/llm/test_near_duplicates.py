"""SimHash links, components and repeated passages against plain versions."""

import random
import re

import pytest
import xxhash
from llm_fixtures import SF_SMALL, awkward, awkward_rows, empty, sentence
from pyspark.sql import functions as F

from siltworks.llm import simhash, substrings
from siltworks.llm.components import connected_components
from siltworks.llm.queries import QUERIES


def plain_fingerprint(text, n=3):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", lower) if w]
    if not words:
        return 0
    runs = [" ".join(words[k : k + n]) for k in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def plain_near_duplicates(rows, bits=2):
    """(id, fingerprint) -> smallest id that can be reached; compares all pairs."""
    prints = [(i, plain_fingerprint(t)) for i, t in rows]
    distinct = sorted({f for _, f in prints})
    linked = [(a, b) for k, a in enumerate(distinct) for b in distinct[:k] if (a ^ b).bit_count() <= bits]
    of = plain_components(distinct, linked)
    smallest = {}
    for i, f in prints:
        if i is not None:
            smallest[of[f]] = min(smallest.get(of[f], i), i)
    return sorted(((i, f"{f:016x}", smallest.get(of[f])) for i, f in prints), key=repr)


def test_query_equals_all_pairs(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    found = QUERIES["op5_simhash_near_duplicates"](spark, SF_SMALL).collect()
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in found), key=repr) == plain_near_duplicates([tuple(r) for r in rows])


def test_awkward_rows(spark):
    found = simhash.near_duplicates(awkward(spark)).collect()
    plain = plain_near_duplicates([r[:2] for r in awkward_rows()])
    assert sorted(((r.id, f"{r.fp & (1 << 64) - 1:016x}", r.component_id) for r in found), key=repr) == plain
    assert simhash.near_duplicates(empty(spark)).count() == 0


def test_first_of_each_group_stays_once(spark):
    kept = simhash.keep_first(awkward(spark))
    assert kept.columns == awkward(spark).columns
    ids = sorted(r.doc_id for r in kept.filter("doc_id IS NOT NULL").collect())
    assert ids == [-5, 1, 3, 6, 7, 8, 8, 9, 10]  # 3, 4, 5 and the null text have no words; 8 has two texts
    assert kept.filter("doc_id IS NULL").count() == 1
    assert simhash.keep_first(empty(spark)).count() == 0


@pytest.mark.parametrize("bits", [1, 2, 3])
def test_every_linked_pair_meets_at_an_anchor_once(spark, bits):
    draw = random.Random(bits)
    fps = {draw.getrandbits(64) for _ in range(60)} | {0, (1 << 64) - 1}
    for f in list(fps):
        for _ in range(4):
            g = f
            for b in draw.sample(range(64), draw.randint(1, 4)):
                g ^= 1 << b
            fps.add(g)
    fps = sorted(fps)
    frame = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long").repartition(3)
    found = [(r.a & (1 << 64) - 1, r.b & (1 << 64) - 1) for r in simhash.links(frame, bits).collect()]
    wanted = {frozenset((a, b)) for k, a in enumerate(fps) for b in fps[:k] if (a ^ b).bit_count() <= bits}
    assert len(found) == len(wanted) and {frozenset(p) for p in found} == wanted


def test_replicas_are_never_broadcast(spark, tmp_path):
    """Spark sizes a file of fingerprints under its threshold, but not the 150 replicas of each."""
    far, draw = 0xF << 40, random.Random(6)
    spark.createDataFrame([(f,) for f in [5, 7, far, far + 3] + [draw.getrandbits(63) for _ in range(300)]], "fp long").write.parquet(f"{tmp_path}/fps")
    found = simhash.links(spark.read.parquet(f"{tmp_path}/fps"))
    assert {(r.a, r.b) for r in found.collect()} == {(5, 7), (far, far + 3)}
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("block", [1_000_000, 7])
def test_components_of_chains_stars_and_random_edges(spark, block):
    draw = random.Random(4)
    edges = [(k, k + 1) for k in range(40)] + [(100, 101 + k) for k in range(30)]
    edges += [(draw.randrange(200, 260), draw.randrange(200, 260)) for _ in range(40)] + [(5, 5), (300, 300), (-1, -9), (-1, -9)]
    found = connected_components(spark.createDataFrame(edges, "a long, b long"), block_edges=block).collect()
    nodes = {n for e in edges for n in e}
    plain = {n: r for n, r in plain_components(nodes, edges).items() if n != r}
    assert sorted((r.node, r.root) for r in found) == sorted(plain.items())


def plain_hash(data: bytes, i: int) -> int:
    """The hash of the window that ends with byte ``i``, started anew."""
    h = 0
    for b in data[max(0, i - 15) : i + 1]:
        h = (2 * h + _GEAR[b]) & 0xFFFFFFFF
    return h


_GEAR = substrings.GEAR.tolist()


def plain_cuts(data: bytes):
    """Byte by byte."""
    n, hashes = len(data), [plain_hash(data, i) for i in range(len(data))]

    def apart(places):
        return [e for k, e in enumerate(places) if k == 0 or e - places[k - 1] >= substrings.LEAST_BYTES]

    ends = apart([i + 1 for i in range(n) if hashes[i] & int(substrings.CUT_BITS) == 0 and data[i] in b" \t\n\r\x0b\x0c"])
    if data and (not ends or ends[-1] != n):
        ends.append(n)
    borders = [i + 1 for i in range(n) if hashes[i] & int(substrings.INNER_BITS) == 0 and (i + 1 == n or data[i + 1] & 0xC0 != 0x80)]
    borders = apart(borders)
    cut = []
    for a, b in zip([0, *ends], ends):
        if b - a > substrings.MOST_BYTES:
            cut += [x for x in borders if a + substrings.LEAST_BYTES <= x <= b - substrings.LEAST_BYTES]
        cut.append(b)
    out, before = [], 0
    for e in cut:
        at = before + substrings.MOST_BYTES
        while at < e:
            back = at
            while data[back] & 0xC0 == 0x80:
                back -= 1
            out.append(back)
            at += substrings.MOST_BYTES
        out.append(e)
        before = e
    return out


def plain_words(data: bytes, a: int, b: int) -> int:
    begin = sum(data[k] not in b" \t\n\r\x0b\x0c" and (k == 0 or data[k - 1] in b" \t\n\r\x0b\x0c") for k in range(a, b))
    return max(begin, (b - a) // substrings.BYTES_PER_WORD)


def plain_passages(rows):
    """Repeated passages by comparing the chunk texts of all shortest stretches that are long enough."""
    held, texts, seen_without_id = {}, [], set()
    for i, t in rows:
        data = (t or "").encode()
        ends = plain_cuts(data)
        parts = list(zip([0, *ends], ends))
        words = [plain_words(data, a, b) for a, b in parts]
        found = {}
        for k in range(len(parts)):
            for step in (1, -1):
                z, total = k, 0
                while 0 <= z < len(parts):
                    total += words[z]
                    if total >= substrings.MIN_RUN_WORDS:
                        y, x = sorted((k, z))
                        found[y, x] = tuple(data[a:b] for a, b in parts[y : x + 1])
                        break
                    z += step
        rank = (i is None, i if i is not None else 0, substrings_hash(t) if i is None else 0)
        again = i is None and t in seen_without_id
        if i is None:
            seen_without_id.add(t)
        if not again:
            for stretch in found.values():
                held.setdefault(stretch, set()).add(rank)
        texts.append((i, parts, words, found, rank, again))
    out = []
    for i, parts, words, found, rank, again in texts:
        bad, seen = [again] * len(parts), set()
        for span in sorted(found):
            stretch = found[span]
            if stretch in seen or any(r < rank for r in held.get(stretch, ())):
                for k in range(span[0], span[1] + 1):
                    bad[k] = True
            seen.add(stretch)
        k = 0
        while k < len(parts):
            z = k
            while z < len(parts) and bad[z]:
                z += 1
            if z > k and sum(words[k:z]) >= substrings.MIN_RUN_WORDS:
                out.append((i, parts[k][0], parts[z - 1][1]))
            k = max(z, k + 1)
    return sorted(out, key=repr)


def substrings_hash(text):
    """The hash that orders texts without an id, by the same function of Spark."""
    from pyspark.sql import SparkSession

    from siltworks.llm.common import text_hash

    one = SparkSession.getActiveSession().createDataFrame([(text,)], "text string")
    return one.select(text_hash("text").alias("h")).first()["h"]


def test_cuts_equal_the_plain_ones():
    for _, t, *_ in awkward_rows():
        data = (t or "").encode()[:20_000]
        while data and data[-1] & 0x80:
            data = data[:-1]
        assert substrings.cuts(data).tolist() == plain_cuts(data)


def test_cuts_at_a_block_border(monkeypatch):
    data = sentence(9, 400).encode()
    whole = substrings.cuts(data).tolist()
    monkeypatch.setattr(substrings, "_BLOCK", 64)
    assert substrings.cuts(data).tolist() == whole


def test_passages_query_equals_the_plain_one(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    found = QUERIES["op8_substring_dedup"](spark, SF_SMALL).collect()
    assert sorted(((r.doc_id, r.start, r.end) for r in found), key=repr) == plain_passages(rows)


def test_old_and_new_rule_differ_on_mixed_phrases(spark):
    """Long runs of known chunks that no single document holds are no passages; the plain version agrees."""
    draw, phrases = random.Random(4), [sentence(600 + k, 9) for k in range(12)]
    rows = [(k, " ".join(draw.choices(phrases, k=12))) for k in range(40)]
    rows += [(None, rows[3][1]), (None, rows[3][1]), (None, sentence(9000, 60)), (None, sentence(9000, 60))]
    found = substrings.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted(((r.id, r.start, r.end) for r in found), key=repr) == plain_passages(rows)
    assert len({(r.id, r.start) for r in found}) > 10


def han(seed, n):
    draw = random.Random(seed)
    return "".join(chr(draw.randrange(0x4E00, 0x9F00)) for _ in range(n))


@pytest.mark.parametrize("make", [han, lambda s, n: sentence(s, n // 5).replace(" ", "")], ids=["han", "packed"])
def test_one_insertion_leaves_most_chunks_of_text_without_spaces(make):
    text = make(5, 3000)
    edited = text[:40] + ("中" if make is han else "z") + text[40:]
    parts = [{data[a:b] for a, b in zip([0, *ends], ends)} for data in (text.encode(), edited.encode()) for ends in [substrings.cuts(data).tolist()]]
    assert len(parts[0] & parts[1]) > 0.9 * len(parts[0]) > 20


def test_passages_without_spaces_are_found(spark):
    shared = han(1, 150)
    rows = [(k, han(10 + k, 300) + shared + han(50 + k, 300)) for k in range(8)] + [(100, han(99, 900))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = substrings.repeated_passages(docs)
    assert {r.id for r in found.collect()} == set(range(1, 8)) and {r.kept_id for r in found.collect()} == {0}
    left = {r.doc_id: r.text for r in substrings.remove_passages(docs, found).collect()}
    assert left[0] == rows[0][1] and left[100] == rows[8][1]
    assert all(200 < len(left[k]) - 400 < 290 for k in range(1, 8))


def test_rows_without_an_id_are_documents(spark, tmp_path):
    texts = [sentence(400 + k, 70) for k in range(7)]
    rows = [(None, texts[k % 7], k) for k in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string, k int").repartition(4).write.parquet(f"{tmp_path}/d")
    docs = spark.read.parquet(f"{tmp_path}/d")
    found = substrings.repeated_passages(docs)
    assert found.count() == 53
    assert sorted(r.text for r in substrings.remove_passages(docs, found).collect()) == sorted(texts)
    with_ids = docs.withColumn("doc_id", F.col("k").cast("long"))
    assert substrings.repeated_passages(with_ids).count() == 53


def test_planted_passages_are_found_and_clean_texts_are_not(spark):
    shared = sentence(77, 55)
    rows = [(k, f"{sentence(1000 + k, 80)} {shared} {sentence(2000 + k, 80)}") for k in range(30)]
    rows += [(100 + k, sentence(3000 + k, 200)) for k in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = substrings.repeated_passages(docs)
    assert {r.id for r in found.collect()} == set(range(1, 30))
    assert {r.kept_id for r in found.collect()} == {0}
    cut = {r.doc_id: r.text for r in substrings.remove_passages(docs, found).collect()}
    texts = dict(rows)
    assert cut[0] == texts[0] and all(cut[k] == texts[k] for k in range(100, 130))
    for k in range(1, 30):
        assert shared not in cut[k] and len(cut[k]) < len(texts[k]) - len(shared) // 2
        assert texts[k][:200] in cut[k]


def test_phrases_of_many_documents_are_no_passage(spark):
    """Chunks that all occur before, each in another document or in another order."""
    whole = sentence(31, 120)
    data = whole.encode()
    ends = substrings.cuts(data).tolist()
    parts = [data[a:b].decode() for a, b in zip([0, *ends], ends)]
    rows = [(k, part) for k, part in enumerate(parts)]
    rows += [(500, "".join(reversed(parts))), (900, whole), (901, "".join(parts[:10]) + sentence(32, 50))]
    found = substrings.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    # only what 901 shares with 900 stands in one document
    assert [(r.id, r.start, r.kept_id) for r in found] == [(901, 0, 900)]


def test_passages_of_awkward_rows(spark):
    docs = awkward(spark)
    found = substrings.repeated_passages(docs)
    plain = plain_passages([(i, None if t is None else t) for i, t, *_ in awkward_rows()])
    assert sorted(((r.id, r.start, r.end) for r in found.collect()), key=repr) == plain
    left = substrings.remove_passages(docs, found)
    assert left.columns == docs.columns
    kept = {(r.doc_id, r.text) for r in left.collect()}
    assert (3, None) in kept and (4, "") in kept and (5, " \n\t ") in kept  # blank before, so not removed
    assert not [t for i, t in kept if i == 2]  # all of it stands in document 1
    assert substrings.repeated_passages(empty(spark)).count() == 0
    assert substrings.remove_passages(empty(spark), found).count() == 0
