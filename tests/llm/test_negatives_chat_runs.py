"""Hard negatives, chat formatting and periodic runs against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from moodlens.llm import catalog, chat, hard_negatives, runs
from moodlens.llm.common import table
from moodlens.llm.suffix_tree import SuffixTree

WIDE = 1 << 60


# hard negatives


def mined(rows, every=100, low=80, scale=256):
    """Plain version: all scores of an anchor, sorted."""
    kept = {}
    for i, label, v in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            kept[i] = min(kept.get(i, (label, v)), (label, v))
    kept = {i: (label, [math.floor(scale * x) for x in v]) for i, (label, v) in kept.items()}
    out = []
    for a, (label, v) in kept.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, k) for i, (k, w) in kept.items() if i != a and len(w) == len(v))
        for s, p, _ in [x for x in scored if x[2] == label][:5]:
            found = [(i, -n) for n, i, k in scored if k != label and low * -s <= 100 * -n <= 100 * -s]
            out += [(a, p, r, i, -s, n) for r, (i, n) in enumerate(found[:5], 1)]
    return sorted(out)


def vectors():
    rng = np.random.default_rng(5)
    rows = [(int(i), int(rng.integers(0, 3)), [float(np.float32(x)) for x in rng.normal(0.2, 0.3, 4)]) for i in range(-50, 260)]
    same = [0.5, 0.25, 0.0, 0.5]
    rows += [(300 + k, k % 2, same) for k in range(40)]
    rows += [(500 + k, k % 2, [0.0] * 4) for k in range(8)] + [(600, 0, [0.0] * 4), (700, 1, [-1.0, -1.0, -1.0, -1.0])]
    rows += [(800, 0, same), (800, 0, same), (900, 1, same), (900, 0, [1.0, 1.0, 1.0, 1.0])]
    rows += [(WIDE - WIDE % 100, 0, same), (WIDE - WIDE % 100 + 1, 0, same), (WIDE - WIDE % 100 + 3, 1, same)]
    rows += [(1000, 0, [1.0, 2.0]), (1001, 0, [1.0, 2.0]), (1002, 1, [1.0, 1.9]), (1100, 0, []), (1101, 0, []), (1102, 1, [])]
    rows += [(1200, None, same), (1201, 0, None), (1202, 0, [None, 1.0, 1.0, 1.0]), (1203, 1, [float("nan")] * 4), (1204, 1, [float("inf")] * 4), (None, 0, same)]
    return rows


SCHEMA = "vec_id bigint, label int, embedding array<float>, score string, anchor_id string, block string, limits string"


@pytest.mark.parametrize("block_bytes", [1 << 10, 8 << 20])
def test_negatives(spark, block_bytes):
    rows = vectors()
    df = spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA).repartition(3)
    assert sorted(map(tuple, hard_negatives.mine(df, block_bytes=block_bytes).collect())) == mined(rows)


def test_negatives_edges(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    assert hard_negatives.mine(nothing).count() == 0
    lonely = spark.createDataFrame([(1, 1, [1.0]), (2, 1, [1.0])], "vec_id bigint, label int, embedding array<float>")
    assert hard_negatives.mine(lonely).count() == 0
    rows = [(0, 0, [3e6, 1.0]), (1, 0, [3e6, 2.0]), (2, 1, [3e6, 1.5]), (3, 1, [2.9e6, 0.0])]
    wide = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<double>")
    assert sorted(map(tuple, hard_negatives.mine(wide).collect())) == mined(rows)


def test_negatives_block_pairs_are_bounded():
    rng = np.random.default_rng(1)
    scores = rng.integers(-5, 5, (7, 400)).astype(float)
    allowed = rng.random(scores.shape) < 0.7
    a, r = hard_negatives._best(scores, allowed, 5)
    want = [(i, j) for i in range(7) for j in sorted(np.flatnonzero(allowed[i]), key=lambda j: (-scores[i, j], j))[:5]]
    assert list(zip(a, r)) == want


# chat


FRAGMENTS = [*chat.CONTROL, "<\\|im_end|>", "<\\\\s>", "[\\/INST]", "<", "[", "\\", "s>", "/INST]", " ", "é", "日", "\n", "a"]


def turns():
    rng = random.Random(2)
    rows = []
    for c in range(40):
        for t in range(rng.randint(1, 6)):
            role = rng.choice(["user", "assistant", "assistant", None, "", "a\nb", "<s>", "\\n", "x\\"])
            rows.append((c + (WIDE if c % 9 == 0 else 0), t, role, None if rng.random() < 0.1 else "".join(rng.choices(FRAGMENTS, k=rng.randint(0, 9)))))
    rows += [(50, 1, "user", "tie b"), (50, 1, "user", "tie a"), (50, None, "user", "no turn"), rows[0], rows[0], (51, 0, "assistant", "z" * 300_000)]
    rows += [(None, 0, "assistant", "no id"), (None, 1, None, None)]
    rows += [(99, k, ("user", "assistant")[k % 2], f"turn {k} </s>") for k in range(400)]
    return rows


TURNS = "conv_id bigint, turn bigint, role string, text string, piece string, size string, _id string"


def by_conversation(rows):
    out = {}
    for r in sorted(rows, key=lambda r: tuple((x is not None, x) for x in r)):
        out.setdefault(r[0], []).append((r[2], r[3] or ""))
    return out


def digest(found):
    text = "".join(f"{r or ''}\n{t}\n" for r, t in found)
    loss = "".join(t for r, t in found if r == "assistant")
    size = sum(len(f"{chat.START}{chat.role_mark(r)}\n{chat.escape(t)}{chat.END}\n") for r, t in found)
    return len(found), hashlib.sha256(text.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), size


@pytest.fixture(scope="module")
def talk(spark):
    return spark.createDataFrame([(*r, "x", "x", "x") for r in turns()], TURNS).repartition(5).cache()


@pytest.fixture
def small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize(("whole_bytes", "block_bytes"), [(chat.WHOLE_BYTES, chat.BLOCK_BYTES), (chat.WHOLE_BYTES, 100), (2_000, 100), (1, 100)])
def test_chat(talk, small_batches, whole_bytes, block_bytes):
    """Whole conversations, one split, and all split."""
    want = {c: digest(t) for c, t in by_conversation(turns()).items()}
    formatted = chat.format(talk, whole_bytes, block_bytes)
    assert {r[0]: tuple(r)[1:] for r in chat.digests(formatted).collect()} == want
    pieces = {}
    for r in formatted.rows().orderBy("piece").collect():
        pieces.setdefault(r["conv_id"], []).append(r)
        for control in chat.CONTROL[2:]:
            assert control not in r["text"]
    for c, found in by_conversation(turns()).items():
        assert [t for p in pieces[c] for t in chat.turns_of(p["text"])] == found
        assert [t for p in pieces[c] for t in chat.under_mask(p["text"], p["loss_starts"], p["loss_lengths"])] == [t for r, t in found if r == "assistant"]
    assert all((len(p) > 1) == (c == 99 and whole_bytes < chat.WHOLE_BYTES) or whole_bytes == 1 for c, p in pieces.items())
    assert len(pieces[99]) > 1 or whole_bytes == chat.WHOLE_BYTES


def test_chat_escapes():
    rng = random.Random(4)
    for _ in range(3000):
        text = "".join(rng.choices(FRAGMENTS, k=rng.randint(0, 8)))
        hidden = chat.escape(text)
        assert chat.unescape(hidden) == text and not any(c in hidden for c in chat.CONTROL)
        assert chat.role_of(chat.role_mark(text)) == text and "\n" not in chat.role_mark(text)
    assert chat.role_of(chat.role_mark(None)) is None
    # no control string holds the first character of one behind its own
    assert not any(d[0] in c[1:] for c in chat.CONTROL for d in chat.CONTROL)


def test_chat_of_nothing(spark):
    assert chat.digests(chat.format(spark.createDataFrame([], TURNS))).count() == 0


# runs


def plain_runs(words, shortest=runs.SHORTEST, repeats=runs.REPEATS):
    """Every stretch with period q that no neighbour extends and no smaller period explains."""
    out, n = [], len(words)
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(shortest, repeats * q):
                part = words[i : j + q]
                if not any(part[d:] == part[: size - d] for d in range(1, q)):
                    out.append((i, size, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def periodic(rng, letters, size):
    words = [rng.choice("abcdefgh"[:letters]) for _ in range(size)]
    if size and rng.random() < 0.6:
        a = rng.randrange(size)
        p = 1 + (size - a) // rng.randint(3, 10)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(size)]
    return words


@pytest.mark.parametrize(("shortest", "repeats"), [(6, 4), (2, 2), (5, 3)])
def test_runs_against_plain_version(shortest, repeats):
    rng = random.Random(7)
    texts = [periodic(rng, rng.choice([1, 2, 2, 3, 5, 8]), rng.randint(0, 70)) for _ in range(400)]
    found = runs.runs_of_texts([[w.encode() for w in t] for t in texts], shortest, repeats)
    assert {k: v for k, t in enumerate(texts) if (v := plain_runs(t, shortest, repeats))} == found


def test_suffix_tree():
    rng = np.random.default_rng(3)
    for _ in range(40):
        text = [*rng.integers(1, 4, rng.integers(1, 60)).tolist(), 0]
        tree = SuffixTree(text)
        order = sorted(range(len(text)), key=lambda i: text[i:])
        assert np.argsort(tree.rank).tolist() == order
        flipped = [[0, 3, 2, 1][s] for s in text]
        assert np.argsort(tree.ranks(np.array([0, 3, 2, 1])[: tree.width] if tree.width == 4 else np.array([0, *range(tree.width - 1, 0, -1)]))).tolist() == sorted(
            range(len(text)), key=lambda i: flipped[i:] if tree.width == 4 else [0 if s == 0 else tree.width - s for s in text[i:]]
        )
        i, j = (rng.integers(0, len(text), 50) for _ in range(2))
        keep = i != j
        want = [next(k for k in range(len(text)) if text[a + k] != text[b + k]) for a, b in zip(i[keep], j[keep])]
        assert tree.common(i[keep], j[keep]).tolist() == want


def test_runs_of_awkward_rows(spark, docs, rows, nothing):
    extra = [(WIDE + 1, "a b " * 20), (None, "x " * 30), (WIDE + 3, None), (5, "p q r " * 5_000), (5, "p q r " * 5_000)]
    both = docs.select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id bigint, text string")).withColumns({"runs": F.lit("x"), "collapsed": F.lit("x")})
    found = sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in runs.find(both).collect()), key=str)
    want = []
    for d, text in [*[r[:2] for r in rows], *extra]:
        words = (text or "").split()
        mine = plain_runs(words) if len(words) < 2_000 else [(0, len(words), 3)] * (words[:4] == ["p", "q", "r", "p"])
        gone = {i for s, n, q in mine for i in range(s + q, s + n)}
        want.append((d, len(words), mine, " ".join(w for i, w in enumerate(words) if i not in gone)))
    assert found == sorted(want, key=str)
    assert runs.find(nothing).count() == 0


def test_run_query(spark, sf_dir):
    texts = {r["doc_id"]: (r["text"] or "").encode().split() for r in table(spark, sf_dir, "documents").collect()}
    some = 0
    for r in catalog.QUERIES["op13_runs"](spark, sf_dir).collect():
        words, h = texts[r["doc_id"]], zlib.crc32(str(r["doc_id"]).encode())
        if h % 10 == 0 and words:
            a = h // 10 % len(words)
            p = 1 + (len(words) - a) // (3 + h // 10 % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(len(words))]
        mine = plain_runs(words)
        some += len(mine)
        s, n, q = min(mine, key=lambda x: (-x[1], x[0], x[2])) if mine else (None, None, None)
        gone = {i for a, m, p in mine for i in range(a + p, a + m)}
        assert (r["n_runs"], r["start"], r["length"], r["period"], r["exponent_milli"]) == (len(mine), s, n, q, 1000 * n // q if mine else None)
        assert r["runs_sha256"] == hashlib.sha256("".join("%d,%d,%d\n" % x for x in mine).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest()
    assert some
