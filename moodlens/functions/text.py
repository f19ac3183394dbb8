"""Text cleaning as column expressions; everything stays inside code generation.

Regular expressions follow Python's Unicode rules, not Java's ASCII defaults: word characters
are letters, numbers and underscore, and white space includes the information separators.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from moodlens import lexicons
from moodlens.functions.stemming import stem_words

SPACE = r"[\s\x1c-\x1f]"
NOT_WORD_SPACE_APOS = r"(?U)[^\p{L}\p{N}_\s\x1c-\x1f']"
NOT_WORD_SPACE = r"(?U)[^\p{L}\p{N}_\s\x1c-\x1f]"
TAG = r"<[^\n]*?>"


@dataclass(frozen=True)
class CleanOptions:
    """Toggles of :func:`clean_tokens`; defaults are the standard preprocessing.

    ``stem`` adds the only step that runs in Python. Lemmas come from a user's table and are a step on rows
    (``vocabulary.reduce_words``), which stems after them.
    """

    lower: bool = True
    strip_tags: bool = True
    strip_punctuation: bool = True
    strip_digits: bool = True
    collapse_space: bool = True
    stopwords: tuple[str, ...] | None = None
    stem: bool = False


def is_blank(c: Column) -> Column:
    """Null, empty or white space only."""
    return c.isNull() | c.rlike(rf"(?U)^{SPACE}*\z")


def lowercase(c: Column) -> Column:
    return F.lower(c)


def _rewrite(c: Column, rules) -> Column:
    return reduce(lambda acc, r: F.regexp_replace(acc, "(?iU)" + r[0], r[1]), rules, c)


def expand_contractions(c: Column) -> Column:
    """The ordered contraction rules, in any case."""
    return _rewrite(c, lexicons.CONTRACTIONS)


def _expand_lowered(c: Column) -> Column:
    """The same rules for text that is already lowercase.

    Ignoring case then only matters for the long s, so a rule without s or word boundary is a plain
    byte search, which is far cheaper than a regular expression. Texts without an apostrophe skip the
    rules that need one; the two others may run last, as no rule makes or breaks their matches.
    """

    def apply(out: Column, rules) -> Column:
        for pattern, replacement in rules:
            if "s" not in pattern and "\\" not in pattern:
                out = F.replace(out, F.lit(pattern), F.lit(replacement))
            else:
                out = F.regexp_replace(out, "(?U)" + pattern.replace("s", "[sſ]"), replacement)
        return out

    with_apostrophe = [r for r in lexicons.CONTRACTIONS if "'" in r[0]]
    others = [r for r in lexicons.CONTRACTIONS if "'" not in r[0]]
    return apply(F.when(F.contains(c, F.lit("'")), apply(c, with_apostrophe)).otherwise(c), others)


def strip_tags(c: Column) -> Column:
    """``<...>`` within one line becomes a space."""
    return F.regexp_replace(c, TAG, " ")


def strip_punctuation(c: Column, keep_apostrophe: bool = True) -> Column:
    return F.regexp_replace(c, NOT_WORD_SPACE_APOS if keep_apostrophe else NOT_WORD_SPACE, " ")


def strip_digits(c: Column) -> Column:
    return F.regexp_replace(c, r"\p{Nd}+", " ")


def collapse_space(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, rf"(?U){SPACE}+", " "))


def tokenise(c: Column) -> Column:
    """Split on white space, without empty tokens."""
    return F.filter(F.split(c, rf"(?U){SPACE}+"), lambda t: t != "")


def filter_tokens(tokens: Column, stopwords: tuple[str, ...] | list[str] | None = None) -> Column:
    """Drop one-letter tokens and stopwords; protected words always stay."""
    stop = lexicons.effective_stopwords(None if stopwords is None else list(stopwords))
    protected = lexicons.PROTECTED_WORDS
    stop = [w for w in stop if w not in protected]
    if not stop:
        return F.filter(tokens, lambda t: F.length(t) > 1)
    return F.filter(tokens, lambda t: (F.length(t) > 1) & ~t.isin(*stop))


def normalise(c: Column, options: CleanOptions = CleanOptions()) -> Column:
    """Every cleaning step before tokens are filtered. Contractions come before punctuation."""
    expanded = _expand_lowered(lowercase(c)) if options.lower else expand_contractions(c)
    out = strip_tags(expanded) if options.strip_tags else expanded
    if options.strip_punctuation and options.strip_digits and options.collapse_space:
        # one pass for the three steps: all they remove becomes white space, whose runs collapse;
        # plain ASCII texts without a tag need no Unicode classes
        plain = (F.octet_length(c) == F.char_length(c)) & ~F.contains(c, F.lit("<"))
        return F.trim(
            F.when(plain, F.regexp_replace(expanded, r"[^A-Za-z_']+", " ")).otherwise(F.regexp_replace(out, r"[^\p{L}\p{Nl}\p{No}_']+", " "))
        )
    if options.strip_punctuation:
        out = strip_punctuation(out)
    if options.strip_digits:
        out = strip_digits(out)
    if options.collapse_space:
        out = collapse_space(out)
    return out


def clean_tokens(c: Column, options: CleanOptions = CleanOptions()) -> Column:
    out = normalise(c, options)
    collapsed = options.strip_punctuation and options.strip_digits and options.collapse_space
    # after collapsing, only single spaces are left, and the length test drops empty tokens
    kept = filter_tokens(F.split(out, " ") if collapsed else tokenise(out), options.stopwords)
    return stem_words(kept) if options.stem else kept


def clean_text(c: Column, options: CleanOptions = CleanOptions()) -> Column:
    return F.array_join(clean_tokens(c, options), " ")


def scoring_clean(c: Column, stopwords: tuple[str, ...] | None = None) -> Column:
    """The simpler cleaner used when no fitted cleaner is at hand: apostrophes go, nothing expands."""
    out = strip_tags(F.lower(c))
    out = strip_digits(strip_punctuation(out, keep_apostrophe=False))
    stop = lexicons.effective_stopwords(None if stopwords is None else list(stopwords))
    toks = tokenise(collapse_space(out))
    return F.array_join(F.filter(toks, lambda t: (F.length(t) > 1) & ~t.isin(*stop)), " ")


def content_hash(c: Column) -> Column:
    return F.md5(F.coalesce(c, F.lit("")))


def keyword_token_ok(token: Column, domain_stop: bool = True) -> Column:
    """Three to fifteen plain letters and, unless switched off, not a domain word."""
    ok = token.rlike(r"^[a-z]{3,15}\z")
    return ok & ~token.isin(*lexicons.DOMAIN_STOP) if domain_stop else ok


def aspect_sentences(text: Column, keywords: list[str] | tuple[str, ...]) -> Column:
    """The sentences (split on full stops) that mention a keyword, trimmed and joined."""

    def mentions(sentence: Column) -> Column:
        low = F.lower(sentence)
        return reduce(lambda a, b: a | b, [F.contains(low, F.lit(k)) for k in keywords])

    kept = F.filter(F.split(text, r"\."), mentions)
    strip = lambda s: F.regexp_replace(s, rf"(?U)^{SPACE}+|{SPACE}+\z", "")
    return F.array_join(F.transform(kept, strip), " ")


def found_words(text: Column, words: tuple[str, ...] | list[str]) -> Column:
    """The listed words that occur in the text as substrings, in list order."""
    return F.array_compact(F.array(*[F.when(F.contains(text, F.lit(w)), F.lit(w)) for w in words]))


def scikit_tokens(c: Column) -> Column:
    r"""Lowercased ``\b\w+\b`` tokens, the tokeniser of the TF-IDF diagnostic."""
    return F.filter(F.split(F.lower(c), r"[^\p{L}\p{N}_]+"), lambda t: t != "")


def preview(c: Column, n: int) -> Column:
    """First n characters and an ellipsis, for display columns."""
    return F.concat(F.substring(c, 1, n), F.lit("..."))


def row_key(*columns: str | Column) -> Column:
    """A 256-bit key that is equal for rows equal in all ``columns``, so that whole texts need no shuffle.

    Every value is written with its length, and nulls have a mark of their own.
    """
    parts = []
    for c in columns:
        value = F.to_json(F.struct((F.col(c) if isinstance(c, str) else c).alias("v")))
        parts.append(F.concat(F.length(value).cast("string"), F.lit(":"), value))
    return F.sha2(F.concat(*parts), 256)
