"""Text functions against a plain restatement of their rules."""

from __future__ import annotations

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from moodlens import lexicons
from moodlens.functions import text
from moodlens.functions.stemming import porter

SAMPLES = [
    "I don't love it, won't buy", "CAN'T stop, ain't bad", "don'ts and shouldn'ts", "y'all gonna wanna", "shawon't do",
    "don’t expand curly", "a<b>bold</b>\nc<br/>d", "line<one\ntwo>three", "Café crème 3 brûlée ²³ ٣٤", "under_score it's",
    "tab\tand nbsp em\x1cfs", "", "   ", "a I 1 ?", "never doeſn't ſhouldn't DOESN'T", "x<<y>>z > < q", None,
    "é combining", "wasn't couldn'té", "Ⅷ roman ½ half", "emoji 😀 and 中文 text",
]


def py_normalise(s: str) -> str:
    s = s.lower()
    for pattern, replacement in lexicons.CONTRACTIONS:
        s = re.sub(pattern, replacement, s, flags=re.IGNORECASE)
    s = re.sub(r"<.*?>", " ", s)
    s = re.sub(r"[^\w\s']", " ", s)
    s = re.sub(r"\d+", " ", s)
    return re.sub(r"\s+", " ", s).strip()


def py_clean(s: str) -> str:
    stop = set(lexicons.STOPWORDS) - set(lexicons.SENTIMENT_WORDS) - set(lexicons.NEGATORS)
    return " ".join(t for t in py_normalise(s).split() if len(t) > 1 and t not in stop)


def run(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r["o"] for r in df.select("i", expr(F.col("s")).alias("o")).orderBy("i").collect()]


def test_clean_text_matches_rules(spark):
    values = [s for s in SAMPLES if s is not None]
    assert run(spark, values, text.clean_text) == [py_clean(s) for s in values]


def test_fused_steps_equal_single_steps(spark):
    values = [s for s in SAMPLES if s is not None]

    def stepwise(c):
        c = text.strip_tags(text.expand_contractions(text.lowercase(c)))
        return text.collapse_space(text.strip_digits(text.strip_punctuation(c)))

    assert run(spark, values, text.normalise) == run(spark, values, stepwise) == [py_normalise(s) for s in values]


def test_every_contraction_rule(spark):
    cases = {
        "WON'T": "will not", "can't": "cannot", "ain't": "is not", "hasn't": "has not", "y'all": "you all",
        "gonna": "going to", "wanna": "want to", "don'ts": "do nots", "didn'ts": "did nots", "doesn'ts": "does nots",
        "wouldn'ts": "would nots", "shouldn'ts": "should nots", "couldn'ts": "could nots", "don’t": "don’t",
    }
    assert run(spark, list(cases), text.expand_contractions) == list(cases.values())


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=st.characters(blacklist_categories=("Cs", "Cn", "Co"), max_codepoint=0x2FFF), max_size=40), min_size=1, max_size=20))
def test_clean_text_on_random_text(spark, values):
    values = [v.replace("\x00", "") for v in values]
    assert run(spark, values, text.clean_text) == [py_clean(v) for v in values]


def test_toggles(spark):
    raw = "The <b>BEST</b> 5 stars!"
    keep = text.CleanOptions(lower=False, strip_tags=False, strip_punctuation=False, strip_digits=False, stopwords=())
    assert run(spark, [raw], lambda c: text.clean_text(c, keep)) == ["The <b>BEST</b> stars!"]
    assert run(spark, [raw], text.scoring_clean) == ["best stars"]


def test_tokenisers_differ_on_apostrophes(spark):
    assert run(spark, ["it's fine"], text.tokenise) == [["it's", "fine"]]
    assert run(spark, ["it's fine"], text.scikit_tokens) == [["it", "s", "fine"]]


def test_keyword_predicate(spark):
    words = ["ok", "nice", "taste", "café", "extraordinarilyx", "extraordinarily", "it's", "x1y"]
    assert run(spark, words, text.keyword_token_ok) == [False, True, False, False, False, True, False, False]


def test_aspects_and_substring_indicators(spark):
    assert run(spark, ["Nice Taste here. Bad box.  The price"], lambda c: text.aspect_sentences(c, ["taste", "price"])) == ["Nice Taste here The price"]
    assert run(spark, ["pure goodness"], lambda c: text.found_words(c, ["good", "bad"])) == [["good"]]


@pytest.mark.parametrize("word,stem", [
    ("caresses", "caress"), ("ponies", "poni"), ("ties", "tie"), ("cats", "cat"), ("agreed", "agre"), ("plastered", "plaster"),
    ("motoring", "motor"), ("conflated", "conflat"), ("hopping", "hop"), ("falling", "fall"), ("filing", "file"), ("happy", "happi"),
    ("relational", "relat"), ("conditional", "condit"), ("electrical", "electr"), ("hopefulness", "hope"), ("adjustment", "adjust"),
    ("probate", "probat"), ("controlling", "control"), ("skies", "sky"), ("dying", "die"), ("enjoy", "enjoy"), ("say", "say"),
    ("generalizations", "gener"), ("oscillators", "oscil"),
])
def test_stems(word, stem):
    assert porter(word) == stem


def test_fixed_list_sizes():
    assert len(set(lexicons.STOPWORDS)) == 93
    assert len(set(lexicons.SENTIMENT_WORDS)) == 20
    assert len(set(lexicons.NEGATORS)) == 11
    assert len(set(lexicons.DOMAIN_STOP)) == 35
    assert len(lexicons.effective_stopwords()) == 93
