"""Language, quality, fingerprints, benchmark passages and packing against plain versions and held-out rows."""

import hashlib
import random
import zlib
from functools import cache

import numpy as np
import pytest
from llm_fixtures import SF_SMALL, awkward, awkward_rows, empty, sentence
from pyspark.sql import functions as F

from siltworks.llm import decontam, langid, merkle, packing, quality, tokens
from siltworks.llm.queries import GRADES, QUERIES, language_model, tokenizer_path

SF = "/root/testdata/sf0.01"


def documents(spark, folder=SF_SMALL):
    return spark.read.parquet(f"{folder}/documents.parquet")


# ---- language ------------------------------------------------------------------


def test_held_out_languages(spark):
    found = QUERIES["op3_language_id"](spark, SF).toPandas().merge(documents(spark, SF).select("doc_id", "lang").toPandas())
    assert len(found) == 1000 and found.score.between(0, 1).all()
    assert (found.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in found.doc_id]).all()
    held = found[found.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.97
    assert held.rejected.mean() < 0.03


def test_language_does_not_depend_on_other_columns(spark):
    docs = documents(spark)
    model = language_model(docs)
    plain = {r.doc_id: langid.identify(model, r.text)[:2] for r in docs.collect()}
    other = docs.withColumns({"lang": F.lit("xx"), "source": F.lit(None).cast("string"), "score": F.lit(1)})
    found = langid.predict(other, model).collect()
    assert {r.doc_id: (r.lang_pred, r.score) for r in found} == plain


def test_copies_of_a_text_take_one_excerpt(spark):
    texts = [sentence(k, 40) for k in range(150)]
    alone = langid.fit(spark.createDataFrame([(t, "x") for t in texts], "text string, lang string"))
    for copied in (texts[3], texts[60]):
        rows = [(t, "x") for t in texts] + [(copied, "x")] * 3000
        assert langid.fit(spark.createDataFrame(rows, "text string, lang string").repartition(5)) == alone


def test_language_of_awkward_rows(spark):
    model = language_model(documents(spark))
    found = langid.predict(awkward(spark), model)
    assert found.count() == len(awkward_rows()) and set(awkward(spark).columns) < set(found.columns)
    for r in found.collect():
        if not any(c.isalpha() for c in r.text or ""):
            assert r.lang_pred == "und" and r.rejected and r.score == 0
        else:
            assert r.lang_pred in model.languages
    assert langid.fit(empty(spark)).languages == ()
    assert {r.lang_pred for r in langid.predict(awkward(spark), langid.fit(empty(spark))).collect()} == {"und"}
    assert langid.predict(empty(spark), model).count() == 0


# ---- fingerprints ---------------------------------------------------------------


def plain_edits(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    for k, (i, t) in enumerate(order):
        text, following = t or "", order[(k + 1) % len(order)][1] or ""
        cut = len(text) // 3
        yield i, text, following, text[: len(text) - cut] + following[:cut]


def leaves(tree):
    return [leaf for s in tree.sections for p in s[2] for leaf in p[2]]


def test_fingerprints_equal_the_plain_ones(spark):
    rows = [tuple(r) for r in documents(spark).select("doc_id", "text").collect()]
    found = {r.doc_id: r for r in QUERIES["op4_merkle_fingerprints"](spark, SF_SMALL).collect()}
    assert len(found) == len(rows)
    for i, text, following, changed in plain_edits(rows):
        r = found[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        ours, theirs = merkle.build(text), merkle.build(changed)
        assert (r.fingerprint, r.edited_fingerprint) == (ours.root, theirs.root)
        assert (r.fingerprint == r.edited_fingerprint) == (text == changed)
        # leaves in common, each as often as both have it, bound what whole branches share
        left, same = [d for d, _ in leaves(theirs)], 0
        for d, n in leaves(ours):
            if d in left:
                left.remove(d)
                same += n
        total = len(text) + len(changed)
        assert r.near_edited == pytest.approx(1.0 if text == changed else 2 * same / total, abs=0.02)
        assert r.near_next == merkle.likeness(ours, merkle.build(following))
    near = [r.near_edited for r in found.values()]
    assert np.median(near) > 0.6 and np.mean([r.near_next < 0.1 for r in found.values()]) > 0.9


def test_tree_covers_the_text_and_locates_an_edit():
    for _, t, *_ in awkward_rows():
        tree = merkle.build(t)
        assert sum(n for _, n in leaves(tree)) == len(t or "") == tree.n_chars
    text = "\n".join(sentence(k, 30) for k in range(60))
    at = 900
    other = text[:at] + "XYZ" + text[at + 1 :]
    a, b = merkle.build(text), merkle.build(other)
    assert a.root != b.root and at - merkle.LEAF_CHARS - 2 <= merkle.first_difference(a, b) <= at
    assert merkle.likeness(a, b) > 0.95 and merkle.likeness(a, a) == 1.0


def test_fingerprints_of_awkward_rows(spark):
    found = merkle.compare_with_next(awkward(spark)).collect()
    rows = [r[:2] for r in awkward_rows()]
    wanted = sorted((i or 0, len(t), hashlib.sha256(c.encode()).hexdigest()) for i, t, _, c in plain_edits(rows))
    assert sorted((r.doc_id or 0, r.n_chars, r.edited_sha256) for r in found) == wanted
    assert all(0 <= x <= 1 for r in found for x in (r.near_edited, r.near_next))
    assert merkle.compare_with_next(empty(spark)).count() == 0
    one = merkle.compare_with_next(awkward(spark).filter("doc_id = 1")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_next_across_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(merkle, "RANGE_ROWS", 3)
    rows = [(k * 7 % 101, sentence(k, 12)) for k in range(101)]
    found = {r.doc_id: r.edited_sha256 for r in merkle.compare_with_next(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert found == {i: hashlib.sha256(c.encode()).hexdigest() for i, _, _, c in plain_edits(rows)}


# ---- quality --------------------------------------------------------------------


def rated(spark, folder):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    labels = labels.select("doc_id", quality.grade_of(F.col("quality"), F.col("toxic")).alias("grade"))
    return documents(spark, folder).select("doc_id", "text").join(labels, "doc_id")


def test_held_out_grades(spark):
    rows = rated(spark, "/root/testdata/sf0.1")
    model = quality.fit(rows.filter("doc_id % 4 != 0"), GRADES)
    assert list(model.thresholds) == sorted(model.thresholds)
    found = quality.score(rows.filter("doc_id % 4 = 0").withColumnRenamed("grade", "rating"), model, 2).toPandas()
    good, bad, toxic = (found[found.rating == g] for g in (2, 0, 1))
    assert good.selected.mean() > 0.9 and bad.selected.mean() < 0.15 and toxic.selected.mean() < 0.45
    assert good.expected_grade.mean() > toxic.expected_grade.mean() > bad.expected_grade.mean()


def test_score_equals_the_plain_sum(spark):
    model = quality.fit(rated(spark, SF), GRADES)
    for r in quality.score(documents(spark).limit(30), model, 2).collect():
        s = sum(model.weights.get(k, 0.0) * v for k, v in quality.features(r.text).items())
        tails = [1 / (1 + np.exp(t - s)) for t in model.thresholds]
        assert r.expected_grade == pytest.approx(sum(tails)) and r.tail_probability == pytest.approx(tails[1])
        assert r.selected == (tails[1] >= 0.5)


def test_gradient_leads_to_the_planted_order():
    draw = random.Random(1)
    rows, grades = [], []
    for _ in range(600):
        g = draw.choice([0, 1, 2, 2, 2, 2])
        words = [draw.randrange(100, 200) for _ in range(5)] + ([1] if g == 0 else [2] if g == 1 else [])
        rows.append((np.array(words), np.ones(len(words))))
        grades.append(g)
    model = quality.train(rows, np.array(grades), 3)
    assert model.weights[1] < model.weights[2] < 0 and set(model.weights) <= {1, 2, *range(100, 200)}


def test_quality_of_awkward_rows(spark):
    model = quality.fit(awkward(spark).withColumn("grade", F.col("row") % 3), GRADES)
    found = quality.score(awkward(spark).withColumn("grade", F.lit("clash")), model, 2)
    assert found.count() == len(awkward_rows()) and dict(found.dtypes)["grade"] == "int"
    none = quality.fit(empty(spark).withColumn("grade", F.lit(1)), GRADES)
    assert {r.grade for r in quality.score(awkward(spark), none, 2).collect()} == {2}
    assert quality.score(empty(spark), none, 2).count() == 0


# ---- benchmark passages -----------------------------------------------------------


def plain_matches(docs, items, max_edits=decontam.MAX_EDITS):
    """Every item against every stretch of every text by the full table of edit distances."""
    found = set()
    for i, text in docs:
        own = decontam.word_codes(text).tolist()
        for k, said in items:
            item = decontam.word_codes(said).tolist()
            if len(item) < decontam.LEAST_WORDS or not own:
                continue
            row = [0] * (len(own) + 1)
            for a, word in enumerate(item, 1):
                new = [a]
                for b, other in enumerate(own, 1):
                    new.append(min(row[b - 1] + (word != other), row[b] + 1, new[-1] + 1))
                row = new
            if min(row) <= decontam.allowed_edits(len(item), max_edits):
                found.add((i, k, min(row)))
    return found


def edited_words(text, edits, draw):
    words = text.split()
    for _ in range(edits):
        kind, at = draw.randrange(3), draw.randrange(len(words))
        if kind == 0:
            words[at] = "changed"
        elif kind == 1:
            words.insert(at, "added")
        else:
            del words[at]
    return " ".join(words)


def test_edited_passages_are_found_as_by_brute_force(spark):
    draw = random.Random(6)
    items = [(k, sentence(500 + k, draw.randint(8, 50))) for k in range(12)] + [(90, "too short"), (91, None), (92, "")]
    docs = []
    for k in range(120):
        item = items[k % 12][1]
        passage = edited_words(item, draw.randint(0, int(0.24 * len(item.split()))), draw)
        docs.append((k, f"{sentence(k, 30)} {passage.upper() if k % 5 == 0 else passage} {sentence(900 + k, 30)}"))
    docs += [(1000 + k, sentence(7000 + k, 60)) for k in range(20)]
    plain = plain_matches(docs, items)
    found = decontam.matches(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    found = {(r.id, r.item_id, r.edits) for r in found}
    near = {p[:2] for p in found}
    assert found <= plain or near <= {p[:2] for p in plain}
    assert len(near & {p[:2] for p in plain}) >= decontam.TARGET_RECALL * len(plain)
    assert all(i < 1000 for i, _ in near)
    clean = decontam.clean(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {r.doc_id for r in clean.collect()} == {i for i, _ in docs} - {i for i, _ in near}


def test_exact_passages_of_the_benchmark(spark):
    docs, items = documents(spark).collect(), spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()
    exact = {(d.doc_id, b.item_id) for d in docs for b in items if b.text in d.text}
    found = {(r.doc_id, r.item_id): r.edits for r in QUERIES["op10_benchmark_decontamination"](spark, SF_SMALL).collect()}
    assert exact <= set(found) and all(found[p] == 0 for p in exact)


def test_items_in_many_blocks_give_the_same_hits(spark, monkeypatch):
    docs, items = documents(spark), spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    one = {(r.id, r.item_id) for r in decontam.matches(docs, items).collect()}
    monkeypatch.setattr(decontam, "BLOCK_WORDS", 300)
    assert len(list(decontam.item_blocks(items))) > 2
    assert {(r.id, r.item_id) for r in decontam.matches(docs, items).collect()} == one


def test_distance_and_stretch_equal_the_plain_table():
    draw = random.Random(2)
    for _ in range(200):
        item = np.array([draw.randrange(4) for _ in range(draw.randint(1, 8))], dtype=np.uint64)
        text = np.array([draw.randrange(4) for _ in range(draw.randint(1, 14))], dtype=np.uint64)

        def distance(a, b):
            row = list(range(len(b) + 1))
            for x, w in enumerate(a, 1):
                new = [x]
                for y, v in enumerate(b, 1):
                    new.append(min(row[y - 1] + (w != v), row[y] + 1, new[-1] + 1))
                row = new
            return row[-1]

        best = min(distance(item, text[a:b]) for a in range(len(text) + 1) for b in range(a, len(text) + 1))
        found = decontam.edit_distance_within(item, text, 99)
        assert found[0] == best == distance(item, text[found[1] : found[2]])


@pytest.mark.parametrize("words", [12, 40, 59, 120, 300])
def test_edited_items_of_every_size_are_found(words):
    """Few long items among many short ones, edited as much as is allowed."""
    draw = np.random.default_rng(words)
    code = lambda n: draw.integers(1, 1 << 63, n, dtype=np.uint64) | np.uint64(1)
    items = [code(12) for _ in range(300)] + [code(words) for _ in range(4)]
    repetitions = decontam.repetitions_needed(decontam.ItemBlock(tuple(range(304)), tuple(items)), decontam.MAX_EDITS, decontam.TARGET_RECALL)
    index = decontam.Index(decontam.ItemBlock(tuple(range(304)), tuple(items)), decontam.MAX_EDITS, repetitions)
    found = 0
    for t in range(100):
        passage = decontam.edit(items[300 + t % 4], decontam.allowed_edits(words), draw)
        own = np.concatenate([code(50), passage, code(50)])
        found += 300 + t % 4 in {k for k, *_ in index.search_codes(own)}
    assert found >= (100 if words > decontam.WALKED_WORDS else 95)


def test_passages_in_awkward_rows(spark):
    items = spark.createDataFrame([(1, sentence(1, 60)), (None, sentence(3, 45)), (3, "another text of the same id")], "item_id long, text string")
    found = {(r.id, r.item_id) for r in decontam.matches(awkward(spark), items).collect()}
    assert found == {(1, 1), (2, 1), (-5, None), (8, 3)}
    kept = decontam.clean(awkward(spark), items)
    assert kept.columns == awkward(spark).columns and kept.count() == len(awkward_rows()) - 5
    none = items.limit(0)
    assert decontam.matches(awkward(spark), none).count() == 0
    assert decontam.clean(awkward(spark), none).count() == len(awkward_rows())
    assert decontam.matches(empty(spark), items).count() == 0


# ---- packing ------------------------------------------------------------------------


@cache
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def plain_ids(text):
    return tokenizer().encode(text or "", add_special_tokens=False).ids + [0]


def assert_packed(rows, texts, capacity):
    """``rows`` are pieces of ``texts`` (by id), whole and without gaps or overlaps."""
    for i, text in texts.items():
        own, ids = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.piece), plain_ids(text)
        assert [r.piece for r in own] == list(range(len(own))) and sum(r.length for r in own) == len(ids)
        for r in own:
            part = ids[r.start : r.start + r.length]
            assert r.start == r.piece * capacity and r.length == len(part)
            assert r.length == capacity or r is own[-1]
            assert r.ids_crc32 == zlib.crc32(np.array(part, dtype="<u4").tobytes())
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


def test_packing_query(spark):
    rows = QUERIES["op7_best_fit_packing"](spark, SF_SMALL).collect()
    used = assert_packed(rows, {r.doc_id: r.text for r in documents(spark).collect()}, packing.SEQUENCE_TOKENS)
    assert used <= -(-sum(r.length for r in rows) // packing.SEQUENCE_TOKENS) + 1


def test_packing_of_awkward_rows(spark):
    texts = {k: r[1] for k, r in enumerate(awkward_rows())}
    texts |= {110: "a b <|endoftext|> c", 111: "<|startoftext|>", 112: "x<|endoftext|>! <|ENDOFTEXT|> y", 113: "!<|endoftext|>!<| endoftext |>"}
    texts |= {100: "a ! b !! <|endoftext|> it's\n!\n", 101: "K ſ İ ǅ ﬁ é  x", 102: "\x1c\x1d!", 103: "日本 !"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = packing.pack(packing.pieces(docs, tokenizer_path())).withColumnRenamed("id", "doc_id").collect()
    assert_packed(rows, texts, packing.SEQUENCE_TOKENS)
    assert packing.pack(packing.pieces(awkward(spark), tokenizer_path())).count() > len(awkward_rows())
    assert packing.pack(packing.pieces(empty(spark), tokenizer_path())).count() == 0


def test_added_tokens_are_single_ids():
    assert plain_ids("a b <|endoftext|> c") == [320, 321, 49407, 322, 0]
    raw = tokens.Encoder(tokenizer_path()).encode(["a b <|endoftext|> c"])[0]
    assert list(np.frombuffer(raw, dtype="<u4")) == [320, 321, 49407, 322]


def test_words_are_remembered_as_the_tokenizer_has_them(spark):
    encode = tokens.Encoder(tokenizer_path(), cached_words=50)
    for r in documents(spark).limit(60).collect():
        assert list(np.frombuffer(encode.encode([r.text])[0], dtype="<u4")) + [0] == plain_ids(r.text)


def test_best_fit_takes_the_tightest_bin_and_closes_the_fullest():
    draw = random.Random(3)
    for most in (1, 3, 50):
        lengths = [draw.randint(1, 20) for _ in range(400)]
        free, made = [], 0  # what open bins have left; equally full ones are the same to best fit
        for n, (got, offset) in zip(lengths, packing.sequences_of(lengths, 20, most)):
            fitting = [f for f in free if f >= n]
            if fitting:
                free.remove(min(fitting))
                assert got < made and offset == 20 - min(fitting)
            else:
                assert (got, offset) == (made, 0)
                made += 1
            rest = (min(fitting) if fitting else 20) - n
            free += [rest] if rest else []
            if len(free) > most:
                free.remove(min(free))


def test_identification_is_plain_compression(spark):
    """Every block with every dictionary, by fresh compressors."""
    import zstandard

    model = language_model(documents(spark))
    params = langid._compressors(model) and zstandard.ZstdCompressionParameters.from_level(
        langid.LEVEL, source_size=len(langid.PRIMER) + langid.BLOCK_BYTES, dict_size=max(map(len, model.dictionaries)),
        min_match=langid.MIN_MATCH, write_checksum=False, write_content_size=False, write_dict_id=False,
    )
    for r in documents(spark).limit(12).collect():
        words, sizes = langid.letters(r.text or ""), []
        for data in model.dictionaries:
            total = 0
            for at in range(0, len(words), langid.BLOCK_BYTES):
                dictionary = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                one = zstandard.ZstdCompressor(dict_data=dictionary, compression_params=params)
                total += len(one.compress(langid.PRIMER + words[at : at + langid.BLOCK_BYTES]))
            sizes.append(total)
        best, second = sorted(sizes)[:2]
        assert langid.identify(model, r.text) == (model.languages[sizes.index(best)], (second - best) / second, second - best)


def test_number_signs_are_no_letters(spark):
    assert langid.letters("½ ² Ⅷ ③ 12 a²b 日本") == "a b 日本".encode()
    model = language_model(documents(spark))
    assert [langid.identify(model, t)[0] for t in ("½ ²", "", None, "12 _")] == [langid.UNKNOWN] * 4


def test_close_answers_are_rejected():
    assert langid.is_rejected(("de", 0.05, 1)) and langid.is_rejected(("de", 0.001, 9)) and langid.is_rejected((langid.UNKNOWN, 0.0, 0))
    assert not langid.is_rejected(("de", 0.05, 2))


def plain_features(text):
    """Words, marks and beginnings of words with 1 + log of their counts, hashed."""
    import math
    import re
    from collections import Counter

    import xxhash

    words = Counter(re.findall(r"[^\W\d_]+|[^\w\s]+", (text or "").lower()))
    beginnings = Counter(w[:n] + "~" for w in words for n in (4, 5) if len(w) >= n)
    out = Counter()
    for counts in (words, beginnings):
        for token, n in counts.items():
            out[xxhash.xxh3_64_intdigest(token.encode()) % (1 << 18)] += 1.0 + math.log(n)
    out[xxhash.xxh3_64_intdigest(f"length {sum(words.values()).bit_length()}".encode()) % (1 << 18)] = 1.0
    return out


def test_quality_query_scores_whole_table_by_the_model(spark, monkeypatch):
    fitted, fit = [], quality.fit
    monkeypatch.setattr(quality, "fit", lambda *a, **k: fitted.append(fit(*a, **k)) or fitted[-1])
    rows = {r.doc_id: r for r in QUERIES["op9_ordinal_quality"](spark, SF).collect()}
    [model], docs = fitted, documents(spark, SF).select("doc_id", "text").collect()
    assert rows.keys() == {r.doc_id for r in docs} and model.weights
    for r in docs[:150]:
        score = sum(model.weights.get(k, 0.0) * v for k, v in plain_features(r.text).items())
        tails = [1 / (1 + np.exp(t - score)) for t in model.thresholds]
        got = rows[r.doc_id]
        assert got.expected_grade == pytest.approx(sum(tails)) and got.tail_probability == pytest.approx(tails[-1])
        assert got.selected == (got.tail_probability >= 0.5) and got.grade == sum(t >= 0.5 for t in tails)


def test_copies_enter_the_quality_sample_once(spark, monkeypatch):
    taken = []
    monkeypatch.setattr(quality, "train", lambda rows, grades, n: taken.append(sorted((len(k), int(g)) for (k, _), g in zip(rows, grades))))
    rows = [(sentence(1, 30), 0)] * 500 + [(sentence(1, 30), 2)] * 300 + [(sentence(10 + k, 20), k % 3) for k in range(40)]
    rated = spark.createDataFrame(rows + [(None, 1), ("x", None), ("x", 7)], "text string, grade int").repartition(4)
    quality.fit(rated, 3)
    assert len(taken[-1]) == 42
    quality.fit(rated, 3, sample_rows=10)
    assert len(taken[-1]) == 10
    quality.fit(rated, 3, sample_features=200)
    assert 0 < sum(n for n, _ in taken[-1]) <= 200


def test_words_of_any_text_in_blocks(monkeypatch):
    texts = ["", "one two", "a" * 100 + " b", "x" * 37, " ".join(sentence(k, 9) for k in range(4)), "日本語 text สวัสดี", "é" * 30 + "-" * 9 + "z"]
    whole = [decontam.word_codes(t).tolist() for t in texts]
    assert len(whole[5]) == 3 + 1 + 4 and [len(w) for w in whole[:4]] == [0, 2, 2, 1]
    for block in (1, 2, 7, 16):
        monkeypatch.setattr(decontam, "_TEXT_BLOCK", block)
        assert [decontam.word_codes(t).tolist() for t in texts] == whole


def test_short_items_and_items_without_spaces_are_sought(spark):
    items = spark.createDataFrame([(1, "north wind"), (2, "日本の首都はどこですか、正しい答えを選びなさい"), (3, "?!"), (4, None)], "item_id long, text string")
    docs = [(1, "The North-Wind blew"), (2, "wind north"), (3, "前文。日本の首都はどこですか、正しい答えを選びなさい。後文"), (4, "日本の首都はどこてすか正しい答えを選びなさい"), (5, "日本の山はどこにありますか"), (6, None)]
    found = decontam.matches(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()
    assert {(r.id, r.item_id, r.edits) for r in found} == {(1, 1, 0), (3, 2, 0), (4, 2, 1)}
    kept = decontam.clean(spark.createDataFrame(docs, "doc_id long, text string"), items)
    assert sorted(r.doc_id for r in kept.collect()) == [2, 5, 6]
