"""Tables with the awkward cases that every operator has to take."""

import random

SF_SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, `row` int, `a.b` string, id string, t int"


def sentence(seed: int, words: int) -> str:
    draw = random.Random(seed)
    said = ["".join(draw.choice(["ba", "ko", "li", "mu", "ste", "ran"]) for _ in range(draw.randint(1, 4))) for _ in range(words)]
    return " ".join(said) + "."


def awkward_rows() -> list[tuple]:
    """Nulls, empty and blank texts, repeated rows, equal ids, a very long text, text without spaces, odd characters."""
    long = " ".join(sentence(50_000 + s, 40) for s in range(1500))
    texts = [
        (1, sentence(1, 60)),
        (2, sentence(1, 60)),
        (2, sentence(1, 60)),
        (3, None),
        (4, ""),
        (5, " \n\t "),
        (None, sentence(2, 30)),
        (None, None),
        (6, long),
        (7, "x" * 50_000),
        (8, "Ünï çødé — “quotes” 日本語     end\r\nnext line 😀!"),
        (8, "another text of the same id"),
        (9, "!!! ??? 123 456"),
        (10, "one"),
        (-5, sentence(3, 45) + "\n\n" + sentence(4, 45)),
    ]
    return [(i, t, "en" if k % 3 else None, f"s{k % 2}", None if t is None else len(t), k, "x", "clash", 1) for k, (i, t) in enumerate(texts)]


def awkward(spark):
    return spark.createDataFrame(awkward_rows(), DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def stored(spark, rows, schema, folder, name="documents"):
    """A table folder as queries expect it."""
    spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)
