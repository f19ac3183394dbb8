"""Fixed word lists and rewrite rules.

All values in this module are fixed values: results depend on them being exactly these.
"""

from __future__ import annotations

# Default stopwords.
STOPWORDS = (
    "a an the and or but if while with without within into onto from to for of on in out by up down over under "
    "again further is are was were be been being do does did doing have has had having this that these those it "
    "its i me my we our you your he him his she her they them their what which who whom where when why how all any "
    "both each few more most other some such only own same so than too very can will just should now"
).split()

# Sentiment words that no cleaning step may drop or rewrite.
SENTIMENT_WORDS = (
    "good bad great terrible excellent awful amazing horrible wonderful disappointing fantastic poor best worst "
    "love hate delicious disgusting perfect awesome"
).split()

# Negators that no cleaning step may drop or rewrite.
NEGATORS = "not no never nor cannot can_not dont doesn didn won wouldn".split()

PROTECTED_WORDS = SENTIMENT_WORDS + NEGATORS

# Contraction rules, applied in this order and ignoring case.
CONTRACTIONS = (
    ("won't", "will not"),
    ("can't", "cannot"),
    ("ain't", "is not"),
    (r"n't\b", " not"),
    ("y'all", "you all"),
    ("gonna", "going to"),
    ("wanna", "want to"),
    ("don't", "do not"),
    ("didn't", "did not"),
    ("doesn't", "does not"),
    ("wouldn't", "would not"),
    ("shouldn't", "should not"),
    ("couldn't", "could not"),
)

# Domain stop list for keyword extraction.
DOMAIN_STOP = (
    "like taste product one would good great get make really time much also food coffee tea amazon buy use used got "
    "well bit little thing things even back order will way first come new still"
).split()

# Words hidden from cloud weights only.
HIDDEN_WORDS = (
    "amazon, starbucks, folgers, keurig, nespresso, kitkat, trader, joes, walmart, costco, coffee, food"
)

# Product aspects.
ASPECTS = ("taste", "price", "packaging", "delivery", "quality", "service", "texture", "aroma")

# Sentiment indicators by category.
POSITIVE_INDICATORS = {
    "strong": ("excellent", "amazing", "wonderful", "fantastic", "incredible", "outstanding", "superb"),
    "moderate": ("good", "great", "nice", "pleasant", "satisfying", "decent", "fine"),
    "emotional": ("love", "adore", "enjoy", "appreciate", "perfect", "awesome", "delicious"),
}
NEGATIVE_INDICATORS = {
    "strong": ("terrible", "awful", "horrible", "disgusting", "appalling", "dreadful", "atrocious"),
    "moderate": ("bad", "poor", "disappointing", "unsatisfactory", "mediocre", "subpar"),
    "emotional": ("hate", "despise", "worst", "horrible", "regret", "waste", "useless"),
}

# Words looked up when probing a vocabulary.
PROBE_WORDS = ("good", "bad", "excellent", "terrible", "amazing", "awful", "love", "hate")

# Texts with a known emotion.
KNOWN_EXAMPLES = (
    ("This is absolutely amazing and delicious!", "Positive"),
    ("This tastes terrible and awful!", "Negative"),
    ("Product arrived on time, standard quality.", "Neutral"),
)

# Emotions that get keywords, in report order.
EMOTIONS = ("Negative", "Neutral", "Positive")

# Column-name hints for finding the text column of a table.
TEXT_COLUMN_HINTS = ("text", "review", "comment", "content", "description")


def effective_stopwords(words: list[str] | None = None) -> list[str]:
    """Stop list minus sentiment words and negators (``words`` replaces the default list)."""
    keep = set(PROTECTED_WORDS)
    return sorted({w for w in (STOPWORDS if words is None else words)} - keep)


def hidden_words(spec: str = HIDDEN_WORDS) -> list[str]:
    return sorted({w.strip().lower() for w in spec.split(",") if w.strip()})
