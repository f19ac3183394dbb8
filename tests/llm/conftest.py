"""A small table with every awkward case: nulls, empty and long texts, copies, ties, clashing column names."""

from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, n_words string, labels string, kept string, ids string"
PASSAGE = "a passage of more than ten words that the benchmark has and documents repeat here"
LICENSES = ["Released under the MIT License.", "Licensed under the Apache License, Version 2.0.", "This work is licensed under the GNU General Public License, version 3.", "the GENERAL\npublic license"]


def make_rows() -> list[tuple]:
    rng = random.Random(3)
    words = ["the", "of", "And", "Éa", "ñu", "x1", "don't", "THE", "été", "zoo,", "Σας", "a|b", "50%"] + [
        "".join(rng.choice("abcdeiorst") for _ in range(rng.randint(2, 7))) for _ in range(300)
    ]
    texts: list[str | None] = [None, "", " \n\t ", "one", "two words", "b" * 3_000, PASSAGE, PASSAGE.upper() + "!"]
    for k in range(24):
        body = [rng.choice(words) for _ in range(rng.choice([5, 19, 20, 40, 90]))]
        if k % 4 == 0:
            body[3:3] = PASSAGE.split()
        if k % 5 == 0:
            body.insert(2, "\n" + rng.choice(LICENSES) + "\n")
        texts.append(" ".join(body))
    texts.append("same words again and again \n" * 12)
    texts.append(" ".join(rng.choice(words) for _ in range(9_000)))
    base = texts[10]
    texts += [base, base, texts[12], " ".join([*texts[13].split()[:-1], "changed"]), " ".join(["pre", *texts[14].split()])]
    rows = [(k, t, None if k % 7 == 0 else "en", None if k % 6 == 0 else f"s{k % 3}", len(t or "")) for k, t in enumerate(texts)]
    rows += [(None, base, "en", "s1", 5), (None, None, None, None, None), rows[9], rows[9], (-4, texts[11], "fr", "s0", 1)]
    return [(*r, "given", "given", "given", "given", "given") for r in rows]


@pytest.fixture(scope="session")
def rows() -> list[tuple]:
    return make_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def benchmark(spark):
    items = [(1, PASSAGE), (2, "two words"), (10, None), (11, ""), (12, "Zoo zoo zoo zoo zoo zoo zoo zoo zoo zoo zoo"), (None, PASSAGE)]
    return spark.createDataFrame(items, "item_id bigint, text string")
