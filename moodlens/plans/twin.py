"""SQL twins: shared common table expressions for the checking engine.

They restate the semantics step by step and share no code with the Spark operators.
"""

from __future__ import annotations

import re

from moodlens import lexicons
from moodlens.sources import derived

SPACE = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\p{Z}]"


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def in_list(words) -> str:
    return "(" + ", ".join(lit(w) for w in words) + ")"


def r(expr: str) -> str:
    """Six decimal places, never negative zero."""
    return f"(round(CAST({expr} AS DOUBLE), 6) + CAST(0 AS DOUBLE))"


def rx(expr: str, pattern: str, replacement: str, flags: str = "g") -> str:
    return f"regexp_replace({expr}, {lit(pattern)}, {lit(replacement)}, '{flags}')"


def expand(expr: str) -> str:
    for pattern, replacement in lexicons.CONTRACTIONS:
        expr = rx(expr, pattern, replacement, "gi")
    return expr


def strip_tags(expr: str) -> str:
    return rx(expr, r"<[^\n]*?>", " ")


def strip_punct(expr: str, keep: str = "'") -> str:
    return rx(expr, r"[^\p{L}\p{N}_\s\x0b\x1c-\x1f\x{85}\x{a0}\p{Z}" + keep + "]", " ")


def strip_digits(expr: str) -> str:
    return rx(expr, r"\p{Nd}+", " ")


def collapse(expr: str) -> str:
    return f"trim({rx(expr, SPACE + '+', ' ')})"


def split_words(expr: str) -> str:
    return f"list_filter(string_split_regex({expr}, {lit(SPACE + '+')}), lambda t: t <> '')"


def keep_tokens(expr: str, stop=None) -> str:
    stop = lexicons.effective_stopwords() if stop is None else stop
    return f"list_filter({expr}, lambda t: length(t) > 1 AND t NOT IN {in_list(stop)})"


def blank(expr: str) -> str:
    return f"({expr} IS NULL OR regexp_full_match({expr}, {lit(SPACE + '*')}))"


def strip_ends(expr: str) -> str:
    return rx(expr, f"^{SPACE}+|{SPACE}+$", "")


def emotion(score: str, neg: int = 2, neu: int = 3, pos: int = 4) -> str:
    return (
        f"CASE WHEN {score} <= {neg} THEN 'Negative' WHEN {score} = {neu} THEN 'Neutral' "
        f"WHEN {score} >= {pos} THEN 'Positive' ELSE 'Unknown' END"
    )


def token_ok(t: str) -> str:
    return f"(regexp_full_match({t}, '[a-z]{{3,15}}') AND {t} NOT IN {in_list(lexicons.DOMAIN_STOP)})"


def _phrases() -> str:
    rows = [f"({lit(c)}, {k}, {lit(p)})" for c, ps in derived.PHRASES.items() for k, p in enumerate(ps)]
    return "SELECT * FROM (VALUES " + ", ".join(rows) + ") AS p(cls, k, phrase)"


def _probs(m, off) -> str:
    r_ = [
        f"1 + (doc_id * {m[c]} + {off[c]}) % 97 + CASE WHEN label = {c} AND doc_id % 3 <> 0 THEN 60 ELSE 0 END AS r{c}"
        for c in range(3)
    ]
    p_ = [f"CAST(r{c} AS DOUBLE) / (r0 + r1 + r2) AS p{c}" for c in range(3)]
    return (
        "SELECT doc_id AS review_id, label, " + ", ".join(p_) + " FROM (SELECT doc_id, label, " + ", ".join(r_)
        + " FROM (SELECT d.doc_id, CASE WHEN l.toxic = 1 THEN 0 WHEN l.quality = 0 THEN 1 ELSE 2 END AS label"
        " FROM documents d JOIN labels l ON d.doc_id = l.doc_id))"
    )


def _scored(table: str) -> str:
    return f"""SELECT *, greatest(p0, p1, p2) AS conf,
 CASE WHEN p0 >= p1 AND p0 >= p2 THEN 0 WHEN p1 >= p2 THEN 1 ELSE 2 END AS pred FROM {table}"""


_CLEAN = keep_tokens(split_words(collapse(strip_digits(strip_punct(strip_tags(expand("lower(coalesce(source_text, ''))")))))))


TABLES: dict[str, str] = {
    "phrases": _phrases(),
    "marked": """SELECT d.doc_id, d.text,
 CASE WHEN l.toxic = 1 THEN 1 + d.doc_id % 2 WHEN l.quality = 0 THEN 3 WHEN l.quality = 1 THEN 4 + d.doc_id % 2 END AS sc,
 CASE WHEN l.toxic = 1 THEN 'Negative' WHEN l.quality = 0 THEN 'Neutral' WHEN l.quality = 1 THEN 'Positive' ELSE 'None' END AS cls
 FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "reviews": """SELECT b.doc_id AS review_id, CAST(b.sc AS BIGINT) AS Score,
 CASE WHEN b.doc_id % 50 = 0 THEN NULL WHEN b.doc_id % 50 = 1 THEN '   ' WHEN b.doc_id % 50 = 2 THEN 'a I 1 ?'
  WHEN b.doc_id % 50 = 3 THEN 'Good tea!' ELSE concat(b.text, ' ', p.phrase) END AS Summary,
 concat(p.phrase, ' ', b.text) AS Text,
 CAST(1199145600 + ((b.doc_id * 7919) % 1826) * 86400 AS BIGINT) AS epoch
 FROM marked b JOIN phrases p ON b.cls = p.cls AND p.k = CAST(floor(b.doc_id / 2.0) AS BIGINT) % 4""",
    "sourced": f"SELECT *, CASE WHEN {blank('Summary')} THEN Text ELSE Summary END AS source_text FROM reviews",
    "cleaned_all": f"""SELECT *, len(tokens) AS n_tokens, array_to_string(tokens, ' ') AS clean_text,
 {emotion('Score')} AS Emotion FROM (SELECT *, {_CLEAN} AS tokens FROM sourced)""",
    "cleaned": "SELECT * FROM cleaned_all WHERE n_tokens > 0",
    "toks": "SELECT review_id, Emotion, unnest(tokens) AS token FROM cleaned",
    "token_freq": "SELECT token, count(*) AS n FROM toks GROUP BY token",
    "etf": "SELECT Emotion, token, count(*) AS n FROM toks GROUP BY Emotion, token",
    "vectors": """SELECT token, list_transform(range(8), lambda i:
 CAST(('0x' || substr(md5(token || ':' || CAST(i AS VARCHAR)), 1, 6)) AS BIGINT) / CAST(16777215.0 AS DOUBLE) * 2 - 1) AS vector
 FROM token_freq WHERE n >= 2""",
    "split": """SELECT *, CASE WHEN rk <= round(nc * CAST(0.2 AS DOUBLE)) THEN 'test' ELSE 'train' END AS split FROM (
 SELECT review_id, Emotion, tokens, clean_text, n_tokens,
  row_number() OVER (PARTITION BY Emotion ORDER BY md5(CAST(review_id AS VARCHAR) || ':42')) AS rk,
  count(*) OVER (PARTITION BY Emotion) AS nc FROM cleaned)""",
    "probs": _probs((37, 53, 71), (11, 29, 5)),
    "probs2": _probs((41, 59, 83), (7, 17, 31)),
    "scored": _scored("probs"),
    "scored2": _scored("probs2"),
    "history": f"""SELECT s.review_id, CASE WHEN length(v.Text) > 50 THEN concat(substr(v.Text, 1, 50), '...') ELSE v.Text END AS text,
 CASE s.pred WHEN 0 THEN 'Negative' WHEN 1 THEN 'Neutral' ELSE 'Positive' END AS prediction, s.conf AS confidence,
 CASE WHEN s.review_id % 2 = 0 THEN 'Random Forest' ELSE 'Boosting' END AS model,
 1704067200 + s.review_id * 60 AS ts,
 (s.review_id % 11) / CAST(10.0 AS DOUBLE) AS vocab_coverage FROM scored s JOIN reviews v ON s.review_id = v.review_id""",
}


def with_tables(sql: str) -> str:
    """Prefix the statement with the shared tables it names, in dependency order."""
    own = re.findall(r"(\w+) AS \(", sql)
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in TABLES:
            if name not in needed and name not in own and re.search(rf"(?:FROM|JOIN|,)\s+{name}\b", text):
                visit(TABLES[name])
                needed.append(name)

    visit(sql)
    if not needed:
        return sql
    # cleaned texts and token tables are read several times: computed once
    kept = {"cleaned_all", "toks", "token_freq"}
    head = ",\n".join(f"{n} AS {'MATERIALIZED ' if n in kept else ''}(\n{TABLES[n]}\n)" for n in needed)
    body = sql.strip()
    return f"WITH {head},\n{body[5:]}" if body.upper().startswith("WITH ") else f"WITH {head}\n{body}"
