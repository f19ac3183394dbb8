"""Each operator against its plain version on the awkward table, and on an empty one."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from moodlens.llm import bpe, byte_cnn, components, decontaminate, licenses, quality_rules, shards, simhash, substring, token_files, warc
from moodlens.session import scratch_path
from tests.llm import brute
from tests.llm.conftest import PASSAGE

PATH = public_tokenizers.path("word_bpe_49k.json")


def bag(df) -> Counter:
    return Counter(tuple(tuple(x) if isinstance(x, list) else x for x in r) for r in df.collect())


def test_licenses(docs, rows, nothing):
    found = bag(licenses.scan(docs).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"))
    assert found == Counter((r[0], len(brute.low_words(r[1])), *brute.places(r[1], licenses.BASE)) for r in rows)
    assert licenses.scan(nothing).count() == 0


def test_license_containment(spark):
    texts = ["rights all\nreserved", "x all RIGHTS y reserved", "under the mit licence released by", "this work is licensed under the gnu general public version 3"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: (r["labels"], round(r["score"], 3)) for r in licenses.scan(docs).collect()}
    assert got == {0: ("rights-reserved", 1.0), 1: ("rights-reserved", 1.0), 2: ("mit", 0.8), 3: ("gpl", 0.917)}


def test_license_blocks_span_lines_and_cut_long_ones(spark):
    bsd = "Redistribution and use in source and binary forms, with or without\n * modification, are permitted provided that"
    gpl = "This program is free software; you can redistribute it and/or modify\n# it under the terms of the GNU General Public\n# License as published"
    filler = "word " * 400
    back = " ".join(reversed(bsd.split()))
    texts = [
        bsd, filler + "\n" + bsd + "\n" + filler, gpl, f"all {filler} rights {filler} reserved", f"{filler} All rights reserved {filler}",
        "All rights\nreserved", "reserved\nrights all", "reserved rights all", filler + bsd.replace("\n", " "), back, back.replace(" and ", "\nand\n"),
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = [(r["labels"], r["score"]) for r in licenses.scan(docs, base=(("never seen here", "x"),)).orderBy("doc_id").collect()]
    notice = ("rights-reserved", 1.0)
    assert got == [("bsd", 1.0), ("bsd", 1.0), ("gpl", 1.0), ("", 0.0), notice, notice, notice, notice, ("bsd", 1.0), ("bsd", 1.0), ("bsd", 1.0)]


@pytest.mark.parametrize("containment", [0.5, 0.8, 1.0])
def test_license_join_loses_no_pair(spark, containment):
    """Texts of template words and others, with line feeds, up to several blocks long."""
    vocabulary = sorted({w for t, _ in licenses.TEMPLATES for w in t.split()})
    rng = np.random.default_rng(1)
    texts = []
    for _ in range(160):
        words = list(rng.choice(vocabulary + ["other"] * rng.integers(0, 60), rng.integers(1, 120)))
        if rng.random() < 0.5:
            notice = licenses.TEMPLATES[rng.integers(len(licenses.TEMPLATES))][0].split()
            at = rng.integers(0, len(words) + 1)
            words[at:at] = [w for w in notice if rng.random() < 0.9]
        texts.append("".join(w + str(rng.choice([" ", "\n", ", "])) for w in words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: (r["labels"], r["score"]) for r in licenses.scan(docs, base=(("never seen here", "x"),), containment=containment).collect()}
    assert got == {k: brute.blocks(t, licenses.TEMPLATES, containment) for k, t in enumerate(texts)}
    assert 20 < sum(label != "" for label, _ in got.values())


def test_bpe(docs, rows, nothing):
    tokenizer = Tokenizer.from_file(PATH)
    found = bpe.decode(bpe.encode(docs, PATH), PATH)
    assert set(found.columns) == {*docs.columns, "decoded"}
    want = Counter()
    for r in rows:
        ids = tokenizer.encode(r[1] or "", add_special_tokens=False).ids
        want[r[0], tuple(ids), tokenizer.decode(ids, skip_special_tokens=False)] += 1
    assert bag(found.select("doc_id", "ids", "decoded")) == want
    once = bpe.encode(docs, PATH, decoded="decoded", keep_text=False)
    assert set(once.columns) == {*docs.columns, "decoded"} - {"text"}
    assert bag(once.select("doc_id", "ids", "decoded")) == want
    assert bpe.decode(bpe.encode(nothing, PATH), PATH).count() == 0


@pytest.mark.parametrize("text", ["Σ ΑΣ ß İ", "a\tb\x1cc d　e", "x<|endoftext|>y <|startoftext|>", "é Å don't WE'LL 4€!!!", "日本語 한국어 😀", "a" * 500, "\x00\x7f\x80 't", "<|endoftext|" + "|>" * 3])
def test_bpe_hard_texts(text):
    memory = bpe.load(PATH).memory
    offsets, ids = memory.encode([text, "", text])
    want = Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [want, [], want]


def test_bpe_memory_starts_anew(monkeypatch):
    from moodlens.llm import cuts

    monkeypatch.setattr(cuts, "CACHE", 5)
    tokenizer, own = Tokenizer.from_file(PATH), bpe.Bpe(PATH).memory
    for text in ("one two three four", "five six seven eight nine ten", "one ten eleven"):
        assert own.encode([text])[1].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_memory_keeps_frequent_texts():
    from moodlens.llm.cuts import IdMemory

    learned = Counter()

    def learn(texts):
        learned.update(texts)
        return np.array([len(t) for t in texts]), np.array([ord(c) for t in texts for c in t], np.int32)

    memory = IdMemory(learn)
    for k in range(40):
        texts = ["often", f"once {k}", "often too", "", "often"]
        length, ids = memory.gather(memory.slots_of(texts, 8))
        assert "".join(map(chr, ids)) == "".join(texts) and length.tolist() == [len(t) for t in texts]
        assert len(memory.slots) <= 8
    assert learned["often"] == learned["often too"] == learned[""] == 1
    # more texts than are remembered
    assert memory.gather(memory.slots_of([*"abcdefghijkl", "often"], 8))[0].tolist() == [1] * 12 + [5]


def test_bpe_words_in_trie_order():
    rng = np.random.default_rng(3)
    syllables = ["in", "tion", "the", "a", "sh", "ß", "é", "ner", "x", "日"]
    words = list({"".join(rng.choice(syllables, n)) for n in rng.integers(1, 30, 600)})
    words += [w + "s" for w in words[:200] if w + "s" not in words]
    own, tokenizer = bpe.Bpe(PATH), Tokenizer.from_file(PATH)
    symbols = ["".join(own.symbols[b] for b in w.encode()) for w in words]
    sizes, ids = own.encode_words(symbols)
    ends = np.cumsum(sizes)
    for w, a, b in zip(words, ends - sizes, ends):
        assert ids[a:b].tolist() == tokenizer.encode(w, add_special_tokens=False).ids


def test_bpe_keeps_frequent_words(monkeypatch):
    own, tokenizer, seen = bpe.Bpe(PATH), Tokenizer.from_file(PATH), Counter()
    plain = own.encode_words
    monkeypatch.setattr(own, "encode_words", lambda words: seen.update(words) or plain(words))
    monkeypatch.setattr(bpe, "CACHE", 12)
    own.memory.limit = 12
    for k in range(30):
        text = f"the word of the{'abcdefghij'[k % 10]}{'klm'[k // 10]}, <|endoftext|> x{k}"
        assert own.memory.encode([text])[1].tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert seen["the"] == seen["word"] == seen["of"] == 1


def test_bpe_decode_of_odd_ids(spark):
    df = spark.createDataFrame([([0, 1],), (None,), ([],), ([None, 2, -5, 10**6],)], "ids array<int>")
    assert [r[0] for r in bpe.decode(df, PATH).select("decoded").collect()] == ["! \"", "", "", "#"]


def test_substring(docs, rows, nothing):
    found = substring.remove_repeats(docs)
    assert set(found.columns) == {*docs.columns, "n_words", "n_removed", "kept_text"}
    assert bag(found.select("doc_id", "n_words", "n_removed", "kept_text")) == Counter(brute.removed([r[:2] for r in rows]))
    assert substring.remove_repeats(nothing).count() == 0


def test_substring_many_chunks(docs, rows, monkeypatch):
    monkeypatch.setattr(substring, "CHUNK_BYTES", 400)
    monkeypatch.setattr(substring, "BUCKET_BYTES", 3_000)
    found = substring.remove_repeats(docs.select("doc_id", "text"), window=6)
    assert bag(found.select("doc_id", "n_words", "n_removed", "kept_text")) == Counter(brute.removed([r[:2] for r in rows], 6))


def test_token_files(docs, rows, nothing, spark, monkeypatch):
    monkeypatch.setattr(token_files, "RANGE_BYTES", 20_000)
    folder = scratch_path(spark, "tokens")
    manifest = token_files.write(docs, folder, PATH, end=1)
    found = token_files.read(manifest, folder).orderBy("start").collect()
    tokenizer, start, want = Tokenizer.from_file(PATH), 0, Counter()
    assert [r["doc_id"] for r in found] == sorted([r[0] for r in rows], key=lambda x: -math.inf if x is None else x)
    for r in found:
        assert r["start"] == start and r["n_tokens"] == len(r["ids"]) and r["ids"][-1] == 1
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        start += len(r["ids"])
        want[r["doc_id"], tuple(r["ids"])] += 1
    assert want == Counter((r[0], (*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 1)) for r in rows)
    empty = scratch_path(spark, "tokens")
    assert token_files.read(token_files.write(nothing, empty, PATH), empty).count() == 0


def test_decontamination(docs, rows, nothing, benchmark):
    found = decontaminate.mark(docs, benchmark)
    assert set(found.columns) == {*docs.columns, "n_words", "n_hit", "items", "contaminated"}
    got = bag(found.select("doc_id", "n_words", "n_hit", F.array_join("items", ",").alias("items"), "contaminated"))
    assert got == Counter(brute.contaminated([r[:2] for r in rows], [tuple(r) for r in benchmark.collect()]))
    assert decontaminate.mark(nothing, benchmark).count() == 0
    assert decontaminate.mark(docs, benchmark.where("false")).where("contaminated").count() == 0


def test_decontamination_counts_words_by_cutting(spark, benchmark):
    """Looking for each word by a pattern took six times as long as cutting the text at separators."""
    texts = [f"{a}w{chr(c)}v{b}" for c in [*range(0xD800), 0x1F600] for a, b in [("", ""), (chr(c), chr(c) + "-"), (".. ", "\n")] if c < 384 or c % 97 == 0]
    docs = spark.createDataFrame(list(enumerate([*texts, "", None, "...", " "])), "doc_id bigint, text string")
    found = decontaminate.mark(docs, benchmark)
    assert {r["doc_id"]: r["n_words"] for r in found.collect()} == {k: len(brute.low_words(t)) for k, t in enumerate([*texts, "", None, "...", " "])}
    assert "regexp_" not in found._jdf.queryExecution().optimizedPlan().toString().lower()


def test_proximity_matches(spark):
    phrases = decontaminate.windows(spark.createDataFrame([(1, "rare common other seldom")], "item_id bigint, text string")).select("phrase", "length")
    texts = ["rare common other seldom", "rare common seldom", "rare common other big seldom", "seldom common other rare", "common other"]
    docs = spark.createDataFrame(list(enumerate([*texts, "common other " * 5])), "doc_id bigint, text string")
    search = decontaminate.search_terms(docs, phrases)
    index = decontaminate.build_index(docs, search)
    near = bag(decontaminate.matches(index, search, slop=1).select("doc_id", "exact").distinct())
    assert near == Counter({(0, True): 1, (1, False): 1, (2, False): 1})
    assert bag(decontaminate.matches(index, search).where("exact").select("doc_id")) == Counter({(0,): 1})


def test_shards(docs, rows, nothing):
    found = shards.assign(docs, shards=5).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    slots = defaultdict(list)
    for r in found:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert shards.assign(nothing, shards=5).count() == 0


def test_shards_share_out_a_hot_group(spark):
    docs = spark.range(2_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "copy of one text").otherwise(F.concat(F.lit("text "), F.repeat(F.lit("x"), (F.col("id") % 40).cast("int")), "id")).alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"))
    sizes = Counter()
    for r in shards.assign(docs, shards=8).collect():
        sizes[r["shard"]] += r["size"]
    mean = sum(sizes.values()) / 8
    assert len(sizes) == 8 and all(abs(v - mean) <= 0.03 * mean for v in sizes.values())


def test_byte_cnn(docs, rows, nothing, spark):
    rng = np.random.default_rng(2)
    texts = ["".join(rng.choice(list("abcdef ")) for _ in range(300)) for _ in range(200)]
    texts = [t if k % 3 else t.replace(" ", " $$$ ") for k, t in enumerate(texts)]
    table = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, int(k % 3 > 0)) for k in range(200)] + [(None, 1), (3, None)], "doc_id bigint, quality int")
    network = byte_cnn.train(table, labels)
    scored = byte_cnn.score(table, network).withColumn("out", byte_cnn.held_out(F.col("doc_id"))).collect()
    held = [r for r in scored if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert sorted(r["doc_id"] for r in held) == sorted(r["doc_id"] for r in scored if r["out"])
    assert np.mean([(r["score"] >= 0.5) == (r["doc_id"] % 3 > 0) for r in held]) > 0.95
    got = byte_cnn.score(docs, network)
    assert set(got.columns) == set(docs.columns) and all(0 <= r["score"] <= 1 for r in got.collect())
    assert Counter(r["doc_id"] for r in got.collect()) == Counter(r[0] for r in rows)
    assert byte_cnn.score(nothing, network).count() == 0
    even = byte_cnn.train(nothing, labels.where("false"))
    assert abs(even.score("any", even.pairs()) - 0.5) < 1e-9


def test_byte_cnn_reads_the_whole_text():
    network = byte_cnn.fit([("ok " * 400) if k % 2 else ("ok " * 300 + "$$$$" * 60) for k in range(40)], [k % 2 for k in range(40)])
    pairs = network.pairs()
    long = "ok " * 60_000
    assert network.score(long + "$$$$" * 2_000, pairs) < network.score(long, pairs)
    codes = np.concatenate([network.pooled("ok " * 40_000, pairs)])
    assert np.allclose(codes[5], codes[300], atol=1e-5)


def test_quality_rules(docs, rows, nothing, spark):
    labels = spark.createDataFrame([(k, int(k % 2)) for k in range(20)] + [(None, 1)], "doc_id bigint, quality int")
    ratios = quality_rules.log_ratios(docs, quality_rules.trusted_ids(labels))
    found = quality_rules.judge(docs, ratios)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    assert bag(found.select("doc_id", *names)) == Counter((r[0], *brute.counts(r[1])) for r in rows)
    for r in found.collect():
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert r["kept"] == (not r["base_failed"] and r["score"] >= quality_rules.THRESHOLD)
    assert quality_rules.judge(nothing, ratios).count() == 0


def test_quality_score(spark):
    """The score is the mean log ratio of the buckets of unigrams and bigrams."""
    texts = ["good words here", "good text", "bad %% words", "", "good"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    trusted = spark.createDataFrame([(0,), (1,)], "doc_id bigint")
    ratios = quality_rules.log_ratios(docs, trusted, buckets=64)
    got = {r["doc_id"]: r["score"] for r in quality_rules.judge(docs, ratios, buckets=64).collect()}

    def xx(values: list) -> list[int]:
        return [spark.range(1).select(F.xxhash64(*[F.lit(x) for x in v])).first()[0] for v in values]

    grams = []
    for t in texts:
        h = xx([(w,) for w in t.split()])
        grams.append([x % 64 for x in h + xx(list(zip(h, h[1:])))])
    raw, target = Counter(x for g in grams for x in g), Counter(x for g in grams[:2] for x in g)
    n_raw, n_target = sum(raw.values()), sum(target.values())
    for k, g in enumerate(grams):
        want = [math.log((target[x] + 1) / (n_target + 64)) - math.log((raw[x] + 1) / (n_raw + 64)) for x in g]
        assert abs(got[k] - (sum(want) / len(want) if want else 0.0)) < 1e-9


def test_quality_counts_every_good_label(spark):
    """A good document beyond the 20,000th label adds to the target as the others do."""
    labels = spark.range(50_000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    trusted = quality_rules.trusted_ids(labels.union(labels).union(spark.createDataFrame([(None, 1), (50_001, 0)], "doc_id bigint, quality int")))
    assert trusted.count() == 50_000
    docs = labels.select("doc_id", F.concat(F.lit("w"), F.col("doc_id") % 7).alias("text"))
    docs = docs.union(spark.createDataFrame([(None, "w1"), (50_001, "w2")], "doc_id bigint, text string"))
    ratios = quality_rules.log_ratios(docs, trusted, buckets=64)
    assert "ShuffledHashJoin" in ratios._jdf.queryExecution().executedPlan().toString()
    empty = math.log(quality_rules.PRIOR / (quality_rules.PRIOR + 50_000))
    assert all(abs(x) < 0.01 or abs(x - empty) < 1e-6 for x in ratios.first()["ratios"])


def pages_of(rows: list[tuple]) -> list[tuple]:
    big = "<html>" + "payload " * 200
    extra = [(500, "http://a b\r\nX: y", big), (501, None, big), (502, "u", big), (502, "u", big), (None, "v", big), (503, "w", big + "é"), (504, "w", "<p>"), (505, "w", "<p>")]
    return [(None if r[0] is None else r[0], f"http://x/{r[0]}", r[1]) for r in rows] + extra


def test_warc(spark, rows):
    pages = pages_of(rows)
    table = spark.createDataFrame([(*p, 1) for p in pages], "page_id bigint, url string, html string, payload int").repartition(3)
    folder = scratch_path(spark, "warc")
    found = warc.read(warc.write(table, folder, limit=5_000), folder)
    last: dict[bytes, int] = {}
    for page, _, html in pages:
        data = (html or "").encode()
        if page is not None and len(data) >= 1000:
            last[data] = max(last.get(data, page), page)
    want = Counter()
    for page, _, html in pages:
        data = (html or "").encode()
        target = last.get(data)
        revisit = len(data) >= 1000 and target is not None and (page is None or page < target)
        want[page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", target if revisit else None] += 1
    assert bag(found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) == want
    empty = scratch_path(spark, "warc")
    assert warc.read(warc.write(table.where("false"), empty), empty).count() == 0


def test_warc_is_deterministic(spark, rows):
    from moodlens.llm import files

    def bytes_of(parts: int) -> list[bytes]:
        folder = scratch_path(spark, "warc")
        table = spark.createDataFrame(pages_of(rows), "page_id bigint, url string, html string").repartition(parts)
        names = [r["name"] for r in warc.write(table, folder).orderBy("part", "number").collect()]
        out = []
        for name in names:
            with files.open_input(folder, name) as f:
                out.append(f.read())
        return out

    assert bytes_of(1) == bytes_of(4)


def test_simhash(docs, rows, nothing):
    found = simhash.near_duplicates(docs)
    prints = [brute.fingerprint(r[1]) for r in rows]
    root = brute.groups(prints)
    least: dict[int, int | None] = {}
    for k, r in zip(root, rows, strict=True):
        if r[0] is not None:
            least[k] = min(least.get(k, r[0]), r[0])
    got = bag(found.select("doc_id", simhash.hex_digits(F.col("fp")), "component_id"))
    assert got == Counter((r[0], f"{p:016x}", least.get(k)) for r, p, k in zip(rows, prints, root, strict=True))
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(root))
    assert simhash.near_duplicates(nothing).count() == 0 and simhash.deduplicate(nothing).count() == 0


@pytest.mark.parametrize("small", [2, 32])
def test_links_find_every_pair(spark, monkeypatch, small):
    monkeypatch.setattr(simhash, "SMALL_BUCKET", small)
    rng = np.random.default_rng(5)
    values = set()
    for base in rng.integers(0, 1 << 63, 12, dtype=np.uint64):
        for _ in range(25):
            values.add(int(base) ^ sum(1 << int(b) for b in rng.integers(0, 64, rng.integers(0, 5))))
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    edges = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp bigint"))
    for a, b in edges.collect():
        assert ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 2
    root = {r["node"]: r["root"] for r in components.components(edges).collect()}
    want = brute.groups(values)
    got = [root.get(v, v) for v in signed]
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_masks_cover_every_pair_of_bits():
    masks = [m & ((1 << 64) - 1) for m in simhash.covering_masks()]
    for i in range(64):
        for j in range(i, 64):
            assert any(not m >> i & 1 and not m >> j & 1 for m in masks)


def test_components(spark):
    edges = [(i, i + 1) for i in range(20)] + [(50, 40), (40, 60), (60, 50), (7, 7)] + [(100, 100 + i) for i in range(1, 30)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(21)}, 40: 40, 50: 40, 60: 40, **{100 + i: 100 for i in range(30)}}


def test_passage_is_long_enough():
    assert len(PASSAGE.split()) > 13


def test_ngram_buckets_are_taken_in_generated_code(spark):
    """Functions on array elements run interpreted, an element at a time, and were most of the work."""
    docs = spark.createDataFrame([(1, "a b c a b"), (2, None)], "doc_id long, text string")
    ratios = quality_rules.log_ratios(docs, docs.select("doc_id").limit(1), buckets=16)
    plan = ratios._jdf.queryExecution().optimizedPlan().toString()
    assert "pmod(gram" in plan and "pmod(lambda" not in plan
    assert len(ratios.first()["ratios"]) == 16
