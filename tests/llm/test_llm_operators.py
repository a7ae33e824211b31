"""Operators on small tables: nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

import collections
import functools
import hashlib
import json
import math
import random
import sys
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from ratelab.llm import (
    bpe,
    chat,
    chunk_dedup,
    components,
    embedding_dedup,
    files,
    hash_tree,
    language,
    mixing,
    ordered,
    simhash,
    token_files,
    warc,
)

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
LONG = " ".join(f"word{i % 977} ends here." for i in range(20_000))
TEXTS = [None, "", " \n\t", "one", "One two", "a b c d", "a b c d", "¿Qué? ñandú — 漢字 🙂", LONG, LONG, LONG + "x", "  two  blanks\n"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(TEXTS)]
    rows += [(None, "no id", None, None, None), (5, "a b c d", "en", "s", 0)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def clash(df, *names):
    """With extra columns of the names an operator uses inside."""
    for name in names:
        df = df.withColumn(name, F.lit("extra"))
    return df


INSIDE = ("id", "keep_id", "kept", "recipe", "fp", "taken", "size", "at", "slot", "shard", "ids", "score", "_mix_id", "dropped_id")


# Shared parts.


def test_ordered_totals(spark):
    rows = [(i % 7, i, (i * 37) % 11) for i in range(500)]
    df = spark.createDataFrame(rows, "a int, b int, n int")
    got = ordered.ordered_totals(df.repartition(5), ["a", "b"], {"before": "n"}).collect()
    total = 0
    for row in sorted(got, key=lambda r: (r["a"], r["b"])):
        assert row["before"] == total
        total += row["n"]
    assert ordered.ordered_totals(df.limit(0), ["a"], {"before": "n"}).count() == 0


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)]
    edges += [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(70)]
    rng.shuffle(edges)
    df = spark.createDataFrame([*edges, *edges[:5], (3, None)], "x bigint, y bigint")
    got = {r["node"]: r["component"] for r in components.connected_components(df, "x", "y").collect()}
    parent = {n: n for e in edges for n in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    linked = {n for e in edges if e[0] != e[1] for n in e}
    assert got == {n: root(n) for n in linked}
    assert components.connected_components(df.limit(0), "x", "y").count() == 0


# 1. Exact dedup.


def test_exact_dedup(docs, none):
    got = {r["doc_id"]: r for r in chunk_dedup.exact_dedup(clash(docs, *INSIDE)).collect()}
    assert (got[0]["keep_id"], got[0]["group_size"], got[0]["kept"], got[1]["kept"]) == (1, 2, False, True)
    assert (got[5]["keep_id"], got[6]["keep_id"], got[5]["group_size"]) == (6, 6, 3)
    assert (got[8]["keep_id"], got[9]["keep_id"], got[10]["keep_id"]) == (9, 9, 10)
    assert got[8]["n_chunks"] > 50 and got[1]["n_chunks"] == 0
    assert got[None]["kept"] and got[None]["keep_id"] is None
    assert got[7]["text_sha256"] == hashlib.sha256(TEXTS[7].encode()).hexdigest()
    assert chunk_dedup.exact_dedup(none).count() == 0


def test_exact_dedup_with_colliding_identifiers(docs):
    weak = lambda c: F.length(c) % 3
    want = chunk_dedup.exact_dedup(docs).collect()
    for ladder in ((weak, chunk_dedup.short_hash, chunk_dedup.content), (weak, chunk_dedup.content)):
        got = chunk_dedup.exact_dedup(docs, identifiers=ladder).collect()
        assert sorted(map(str, got)) == sorted(map(str, want))


def test_chunks_join_to_the_text_and_follow_content(spark):
    rule = chunk_dedup.ChunkRule(least=16, most=64)
    body = "".join(f"Sentence {i * 7919 % 1000} of it. " for i in range(60))
    df = spark.createDataFrame([(body,), ("Something new in front. " + body,), ("x" * 300,)], "text string")
    lists = [r["c"] for r in df.select(rule.chunks(F.col("text")).alias("c")).collect()]
    assert ["".join(x) for x in lists] == [body, "Something new in front. " + body, "x" * 300]
    assert len(set(lists[0]) & set(lists[1])) > len(lists[0]) * 0.8
    assert max(map(len, lists[2])) == 64


def test_keep_first_copies(docs):
    left = chunk_dedup.keep_first_copies(clash(docs, "dropped_id", "kept"))
    assert left.columns == [*docs.columns, "dropped_id", "kept"]
    assert sorted(r["doc_id"] for r in left.where("doc_id IS NOT NULL").collect()) == [1, 2, 3, 4, 6, 7, 9, 10, 11]


def test_kept_rows_keep_columns_of_any_name(docs, none):
    names = ("_row_key", "_row_count", "_row_key_", "keep_id", "a.b", "a`b")
    df = clash(docs, *names)
    for keep in (chunk_dedup.keep_first_copies, simhash.keep_representatives):
        got = keep(df)
        assert got.columns == df.columns
        assert {r[n] for r in got.collect() for n in names} == {"extra"}
        assert keep(clash(none, *names)).count() == 0


def test_dedup_decides_rows_not_ids(spark):
    copies = [(None, "same text here", "en", "s", 0), (1, "same text here", "en", "s", 0)]
    alone = [(None, "only once without id", "en", "s", 0), (2, "first text of two", "en", "s", 0)]
    two = [(2, "text with a larger id elsewhere", "en", "s", 0), (3, "text with a larger id elsewhere", "en", "s", 0)]
    unnamed = [(None, "copies without ids", "en", "s", 0)] * 3
    df = spark.createDataFrame([*copies, *alone, *two, *unnamed, *[(7, "the same row", "en", "s", 0)] * 2], DOCS)
    got = chunk_dedup.keep_first_copies(df.repartition(3))
    assert got.columns == df.columns
    want = {(1, "same text here"), (None, alone[0][1]), (2, alone[1][1]), (3, two[0][1]), (None, unnamed[0][1]), (7, "the same row")}
    rows = [(r["doc_id"], r["text"]) for r in got.collect()]
    assert len(rows) == len(want) and set(rows) == want
    # The smallest id is kept here; rows that repeat its id and text stay with it.
    left = [(r["doc_id"], r["text"]) for r in simhash.keep_representatives(df).collect()]
    want = (want - {(3, two[0][1])}) | {(2, two[0][1])}
    assert set(left) == want and len(left) == len(want) + 2 + 1


# 2. Embedding near-dedup.


def brute_links(rows, cosine=0.98):
    links = set()
    for i, (a, x, p) in enumerate(rows):
        for b, y, q in rows[i + 1 :]:
            usable = all(v and None not in v and np.isfinite(v).all() and any(v) for v in (x, y))
            if usable and p is not None and p == q and len(x) == len(y):
                x_, y_ = np.array(x), np.array(y)
                if x_ @ y_ / (np.linalg.norm(x_) * np.linalg.norm(y_)) >= cosine:
                    links.add((a, b))
    return links


@pytest.mark.parametrize("dims", [2, 8, 20, 64])
def test_embedding_links(spark, dims):
    rng = np.random.default_rng(dims)
    rows = []
    for i in range(60):
        base = rng.standard_normal(dims)
        for _ in range(4):
            step = rng.standard_normal(dims)
            step *= np.linalg.norm(base) / np.linalg.norm(step) * rng.choice([0.05, 0.19, 0.2, 0.21])
            rows.append((len(rows), (base + step).tolist(), i % 3))
    rows += [(900, rows[0][1], 0), (901, rows[0][1], 0), (902, [2 * x for x in rows[0][1]], 0), (903, rows[0][1], None)]
    rows += [(904, None, 0), (905, [], 0), (906, [0.0] * dims, 0), (907, [float("nan")] * dims, 0)]
    rows += [(908, [None, *rows[0][1][1:]], 0), (909, [*rows[0][1], 0.0], 0), (910, [float("inf")] * dims, 0)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    got = {r["vec_id"]: r for r in embedding_dedup.embedding_dedup(clash(df, "cls", "grp", "low", "kept")).collect()}
    links = brute_links(rows)
    assert len(links) > 50
    parent = {r[0]: r[0] for r in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    for i in parent:
        assert got[i]["n_links"] == sum(i in pair for pair in links), i
        assert got[i]["component_id"] == root(i)
    assert embedding_dedup.embedding_dedup(df.limit(0)).count() == 0


# 3. Language identification.


def test_language(spark, docs, none):
    english = ["the cat and the dog are here", "this is the house of the king", "where the river and the road meet"]
    german = ["der Hund und die Katze sind da", "das ist das Haus des Königs", "wo der Fluss und die Straße sind"]
    rows = [(i, t, lang, "s", 0) for i, (t, lang) in enumerate([*((t, "en") for t in english), *((t, "de") for t in german)])]
    learned = spark.createDataFrame([*rows, (90, None, "en", "s", 0), (91, "quoi", None, "s", 0)], DOCS)
    model = language.fit_language_model(learned)
    assert model.languages == ("de", "en")
    asked = spark.createDataFrame(
        [(1, "the dog", "x", "s", 0), (2, "Hunde und Katzen", None, "s", 0), (3, None, "en", "s", 0), (4, "", "en", "s", 0), (5, "12 !?", "en", "s", 0), (6, "the dog. " * 200_000, "x", "s", 0)],
        DOCS,
    )
    got = {r["doc_id"]: r for r in language.predict_languages(clash(asked, "id", "score", "lang_pred"), model).collect()}
    assert [got[i]["lang_pred"] for i in range(1, 7)] == ["en", "de", "und", "und", "und", "en"]
    assert got[3]["score"] == 0 and 0.5 < got[1]["score"] <= 1
    assert abs(got[6]["score"] - got[1]["score"]) < 1e-9
    kept = language.keep_known_languages(asked, model, 0.3)
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 6]
    nothing = language.fit_language_model(none)
    assert {r["lang_pred"] for r in language.predict_languages(docs, nothing).collect()} == {"und"}
    assert language.predict_languages(none, model).count() == 0


def test_backoff_uses_the_longest_known_grams(spark):
    rows = [(i, t, lang, "s", 0) for i, (t, lang) in enumerate([("abcde", "x"), ("vwxyz", "y")])]
    scorer = language.Scorer(language.fit_language_model(spark.createDataFrame(rows, DOCS)))
    four = scorer.model.grams[4]
    assert np.allclose(scorer.backoff("abcdq"), np.mean([four.logs(g) for g in (" abc", "abcd")], axis=0))
    assert np.allclose(scorer.backoff("qqq"), scorer.model.grams[1].logs(" "))


def test_words_with_marks_are_learned_and_predicted_alike(spark, monkeypatch):
    hindi, marathi = "किताब हिन्दी में", "पुस्तक मराठीत आहे"
    rows = [(1, hindi, "hi", "s", 0), (2, marathi, "mr", "s", 0), (3, "ภาษาไทย", "th", "s", 0), (4, "cafe\u0301", "fr", "s", 0)]
    learned = spark.createDataFrame(rows, DOCS)
    model = language.fit_language_model(learned)
    words = [*hindi.split(), *marathi.split(), "ภาษาไทย", "cafe\u0301"]
    assert sorted(model.words.find(words)) == list(range(len(model.words.keys)))
    scorer = language.Scorer(model)
    for _, text, lang, _, _ in rows:
        assert scorer.predict(text)[0] == lang
        assert min(model.words.find(list(language.word_counts(text)))) >= 0
    for text in ("½ ¾ ²³ ①② Ⅳ", "\u0301\u093f", "१२३"):
        assert scorer.predict(text) == ("und", 0.0)
    monkeypatch.setattr(language, "PIECE_CHARS", 3)
    assert language.word_counts(hindi) == dict.fromkeys(hindi.split(), 1)


@pytest.mark.parametrize("n", [2, 4, 20])
def test_kept_texts_do_not_depend_on_the_number_of_languages(spark, n):
    shared = "all of these close variants write the very same words"
    rows = [(i, f"{shared} {'abcdefghijklmnopqrst'[i]}word", f"l{i}", "s", 0) for i in range(n)]
    model = language.fit_language_model(spark.createDataFrame(rows, DOCS))
    texts = [shared, "these words alike", "Кириллица здесь совсем новая", "漢字 한국", "these Кириллица здесь новая", "12 !?"]
    asked = spark.createDataFrame([(i, t, None, "s", 0) for i, t in enumerate(texts)], DOCS)
    assert language.Scorer(model).predict(shared)[1] < 1 / n + 1e-6
    kept = language.keep_known_languages(asked, model, corpus_pipeline.LEAST_KNOWN)
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 1]


def brute_languages(learned, texts, smoothing=0.5):
    """Predictions and scores straight from the definition, every entry in every language."""
    names = sorted({lang for _, lang in learned})
    words = {lang: collections.Counter() for lang in names}
    grams = {lang: collections.Counter() for lang in names}

    def split(word, size):
        padded = f" {word} "
        return [padded[i : i + size] for i in range(len(padded) - size + 1)]

    for text, lang in learned:
        for word in regex.findall(r"\p{L}[\p{L}\p{M}]*", text.lower()):
            words[lang][word] += 1
            for size in (1, 2, 3, 4):
                grams[lang].update(split(word, size))

    def log(table, entry, size=None):
        same = {e for c in table.values() for e in c if size is None or len(e) == size}
        whole = {lang: sum(table[lang][e] for e in same) + smoothing * (len(same) + 1) for lang in names}
        return [math.log((table[lang][entry] + smoothing) / whole[lang]) for lang in names]

    @functools.cache
    def word_log(word):
        if any(word in words[lang] for lang in names):
            return log(words, word)
        for size in (4, 3, 2, 1):
            listed = [g for g in split(word, size) if any(g in grams[lang] for lang in names)]
            if listed:
                return list(np.mean([log(grams, g, size) for g in listed], axis=0))
        return [0.0] * len(names)

    out = []
    for text in texts:
        found = regex.findall(r"\p{L}[\p{L}\p{M}]*", (text or "").lower())
        if not found:
            out.append(("und", 0.0))
            continue
        mean = [sum(word_log(w)[i] for w in found) / len(found) for i in range(len(names))]
        top = max(mean)
        out.append((names[mean.index(top)], 1 / sum(math.exp(m - top) for m in mean)))
    return out


def test_language_against_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    syllables = {"en": ["th", "ea", "ing", "o"], "de": ["sch", "ei", "ung", "ä"], "hi": ["कि", "ता", "ब", "में"], "und": ["ö", "lu", "ng"]}

    def text(lang, n):
        return " ".join("".join(rng.choices(syllables[lang], k=rng.randint(1, 3))) for _ in range(n))

    learned = [(text(lang, rng.randint(1, 30)), lang) for lang in syllables for _ in range(6)]
    rows = [(i, t, lang, "s", 0) for i, (t, lang) in enumerate(learned)]
    model = language.fit_language_model(spark.createDataFrame(rows, DOCS))
    asked = [text(rng.choice(list(syllables)), rng.randint(1, 60)) + rng.choice(["", " xyzzy", " 漢字", " 12."]) for _ in range(80)]
    asked += [None, "", "!?", "漢", asked[0], asked[0] * 40, "the\u0301a"]
    want = brute_languages(learned, asked)
    spread = spark.createDataFrame([(i, t, None, "s", 0) for i, t in enumerate(asked)], DOCS).repartition(3)
    got = {r["doc_id"]: r for r in language.predict_languages(spread, model).collect()}
    for i, (lang, score) in enumerate(want):
        assert got[i]["lang_pred"] == lang and got[i]["score"] == pytest.approx(score, rel=1e-9), asked[i]
    together = language.Scorer(model).judge(asked)
    monkeypatch.setattr(language, "TOGETHER_CHARS", 10)
    monkeypatch.setattr(language, "TOGETHER_WORDS", 3)
    apart = language.Scorer(model).judge(asked)
    assert [j[0] for j in together] == [j[0] for j in apart]
    assert np.allclose([j[1:] for j in together], [j[1:] for j in apart])


def test_the_model_grows_with_the_counts_that_exist(spark):
    """50 languages without a common word: no table of entries by languages, and small languages keep all they have."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [(i, " ".join(f"{letters[i % 26]}{letters[i // 26]}{a}{b}" for a in letters for b in letters), f"l{i:02}", "s", 0) for i in range(50)]
    rows.append((99, "tiny qqqq", "t", "s", 0))
    model = language.fit_language_model(spark.createDataFrame(rows, DOCS))
    assert len(model.languages) == 51
    assert len(model.words.langs) == 50 * 26 * 26 + 2
    assert sum(len(t.langs) for t in model.grams.values()) < 51 * 3_500
    scorer = language.Scorer(model)
    for _, text, lang, _, _ in rows:
        assert scorer.predict(text)[0] == lang
    assert scorer.predict("qqqq")[0] == "t"


# 4. Mixing.


def brute_targets(sizes, weights=(1, 2, 3), epochs=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(epochs * sizes[s] for s in full)
        share = sum(weight[s] for s in names if s not in full)
        over = {s for s in names if s not in full and rest * weight[s] / share > epochs * sizes[s]}
        if not over:
            return {s: epochs * sizes[s] if s in full else rest * weight[s] / share for s in names}
        full |= over


@pytest.mark.parametrize("rule", [mixing.MixRule(), mixing.MixRule(fewest_slots=50), mixing.MixRule(weights=(5, 1), epochs=2)])
def test_mix(spark, rule):
    rng = random.Random(5)
    rows = []
    for source, n, most in (("a", 300, 40), ("b", 3, 5), (None, 40, 30), ("c", 5, 1000), ("empty", 2, 0), ("ß", 20, 9)):
        rows += [(len(rows) + i, " ".join(["w"] * rng.randint(0, most)), "en", source, 0) for i in range(n)]
    rows += [(7000, None, None, "a", None), (None, "no id", None, "a", 0), (1, rows[1][1], "en", "a", 0)]
    df = clash(spark.createDataFrame(rows, DOCS), *INSIDE)
    mix = mixing.mix_sources(df, rule=rule)
    got = mixing.words_taken(mix).collect()
    assert len(got) == len(rows)
    sizes: dict = {}
    for _, text, _, source, _ in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    targets = brute_targets(sizes, rule.weights, rule.epochs)
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        assert r["taken"] <= rule.epochs * r["size"]
        assert r["source_size"] == sizes[r["source"]]
        assert abs(r["target"] - targets[r["source"]]) < 1e-6
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - targets[s]) <= 1 for s in sizes)
    again = mixing.words_taken(mixing.mix_sources(df.repartition(7), rule=rule)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    # The mix itself: every slot's words, no word of an epoch twice, sources interleaved.
    parts = mix.parts.collect()
    seen = set()
    for p in parts:
        for w in range(p["start"], p["start"] + p["words"]):
            assert (key := (p["no"], p["at"], p["epoch"], w)) not in seen
            seen.add(key)
    assert len(seen) == sum(taken.values())


def test_schedule_is_even(spark):
    rows = [(0, 30.0, 1000, 3000), (1, 30.0, 1000, 1000), (2, 30.0, 1000, 6000)]
    targets = spark.createDataFrame(rows, "source bigint, target double, source_size bigint, words bigint")
    slots = sorted(mixing.schedule(targets, 10).collect(), key=lambda r: r["slot"])
    counts = {0: 0, 1: 0, 2: 0}
    for i, r in enumerate(slots, 1):
        assert r["first"] == counts[r["source"]] * 10
        counts[r["source"]] += 1
        if i < 990:
            assert all(abs(counts[s] - i * share) < 6 for s, share in ((0, 0.3), (1, 0.1), (2, 0.6)))
    assert {s: 10 * n for s, n in counts.items()} == {0: 3000, 1: 1000, 2: 6000}


def test_mix_of_nothing(none, docs):
    assert mixing.words_taken(mixing.mix_sources(none)).count() == 0
    blank = docs.withColumn("text", F.lit(" "))
    assert {r["taken"] for r in mixing.words_taken(mixing.mix_sources(blank)).collect()} == {0}


def test_repeat_documents(spark):
    rows = [(i, "w " * 10, "en", "b", 0) for i in range(5)] + [(9, "w " * 200, "en", "a", 0)]
    df = clash(spark.createDataFrame(rows, DOCS), "n", "id", "taken")
    got = mixing.repeat_documents(df)
    assert got.columns == df.columns
    counts = {r["doc_id"]: r["count"] for r in got.groupBy("doc_id").count().collect()}
    assert counts == {**dict.fromkeys(range(5), 3), 9: 1}


def test_documents_come_in_slot_order_and_by_row(spark):
    rule = mixing.MixRule(block_words=20, fewest_slots=1)
    rows = [(i, f"w{i} " * 10, "en", "b", 0) for i in range(60)] + [(100 + i, f"x{i} " * 10, "en", "a", 0) for i in range(60)]
    got = [r["source"] for r in mixing.repeat_documents(spark.createDataFrame(rows, DOCS), rule=rule).collect()]
    # Weights 1 and 2: any stretch of the mix holds them in about that ratio.
    for i in range(30, len(got), 30):
        assert abs(got[i - 30 : i].count("b") - 20) <= 5


def test_copies_go_by_row(spark):
    rows = [(None, f"w{i} " * 10, "en", "a", 0) for i in range(40)] + [(7, f"x{i} " * 10, "en", "a", 0) for i in range(40)]
    rows += [(8, "one row " * 5, "en", "a", 0)] * 20 + [(200 + i, f"y{i} " * 10, "en", "b", 0) for i in range(50)]
    names = ("_row_key", "_mix_id", "_mix_copies", "_mix_again", "_mix_slot", "row", "copies", "a.b")
    df = clash(spark.createDataFrame(rows, DOCS), *names).repartition(3)
    got = mixing.repeat_documents(df)
    assert got.columns == df.columns
    kept = got.collect()
    assert all(r[n] == "extra" for r in kept for n in names)
    # 1,000 words of a and 500 of b; b takes 2/3 of 1,500.
    words = {s: sum(len(r["text"].split()) for r in kept if r["source"] == s) for s in "ab"}
    assert words == {"a": 500, "b": 1000}
    again = sorted(map(tuple, mixing.repeat_documents(df.repartition(5)).collect()), key=repr)
    assert sorted(map(tuple, kept), key=repr) == again
    assert mixing.repeat_documents(df.limit(0)).count() == 0


# 5. WARC.


def test_warc_round_trip(spark):
    rows = [(1, "http://a/", "same"), (2, "http://b/\r\nX: y%0A", "same"), (3, None, None), (4, "http://d/", ""), (None, "http://n/", "same")]
    rows += [(5, "http://e/", "é漢🙂\r\n\r\nWARC/1.1\r\n" * 3), (6, "http://f/", "x" * 9_000_000), (1, "http://a/", "same"), (None, None, "alone")]
    pages = clash(spark.createDataFrame(rows, "page_id bigint, url string, html string"), "key", "first", "size")
    folder = files.shared_folder(spark, "warc-test")
    index = warc.write_warc(pages.repartition(2), folder)
    assert index.count() == len(rows)
    got = warc.read_warc(index, folder).collect()
    facts = {(r["page_id"], r["url"]): r for r in got}
    assert sorted(str(k) for k in facts) == sorted({str((i, u)) for i, u, _ in rows})
    assert facts[1, "http://a/"]["record_type"] == "response"
    assert (facts[2, rows[1][1]]["record_type"], facts[2, rows[1][1]]["refers_to"]) == ("revisit", 1)
    assert (facts[2, rows[1][1]]["payload_bytes"], facts[2, rows[1][1]]["payload"]) == (4, None)
    assert (facts[4, "http://d/"]["refers_to"], facts[None, "http://n/"]["refers_to"]) == (3, 1)
    assert facts[None, None]["record_type"] == "response"
    assert bytes(facts[5, "http://e/"]["payload"]).decode() == rows[5][2]
    assert facts[6, "http://f/"]["payload_bytes"] == 9_000_000
    few = warc.read_warc(index.where("page_id IN (2, 5)"), folder)
    assert sorted(r["page_id"] for r in few.collect()) == [2, 5]
    all_kept = warc.write_warc(pages, files.shared_folder(spark, "warc-test"), warc.WarcRule(revisit_bytes=5))
    assert all_kept.count() == len(rows)


def test_warc_of_nothing(spark):
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    folder = files.shared_folder(spark, "warc-test")
    assert warc.read_warc(warc.write_warc(pages, folder), folder).count() == 0


def test_byte_ranges():
    offsets, lengths = [0, 10, 20, 500, 510, 5000], [10, 10, 10, 10, 2000, 10]
    assert list(files.byte_ranges(offsets, lengths, 100, 1000)) == [(0, 3), (3, 4), (4, 5), (5, 6)]
    assert list(files.byte_ranges([], [], 1, 1)) == []


# 6. BPE.


@pytest.fixture(scope="module")
def tokenizers():
    return bpe.load(WORD_BPE), Tokenizer.from_file(WORD_BPE)


def ids_of(tokenizer, text):
    return np.frombuffer(b"".join(tokenizer.encode(text)), dtype="<u4").tolist()


KNOWN = st.characters(max_codepoint=0x2FF, exclude_categories=["Cs", "Cn"])
PARTS = st.sampled_from(["<|endoftext|>", "<|startoftext|>", "'s", "'ll", "<|", "ing", "thth", "Σ", "İ", "é", "é", "\x1c", "\x85", "　", "漢字", "🙂", "한국", " \n"])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(PARTS, st.text(KNOWN, max_size=12)), max_size=12).map("".join))
def test_bpe_equals_library(text):
    mine, library = bpe.load(WORD_BPE), _library()
    ids = library.encode(text, add_special_tokens=False).ids
    assert ids_of(mine, text) == ids
    decoder = mine.decoder()
    assert decoder.feed(ids) + decoder.finish() == library.decode(ids, skip_special_tokens=False)


_LIBRARY = []


def _library():
    if not _LIBRARY:
        _LIBRARY.append(Tokenizer.from_file(WORD_BPE))
    return _LIBRARY[0]


def test_long_words_stream_in_bounded_state(tokenizers):
    mine, library = tokenizers
    rng = random.Random(2)
    bound = mine.merges.lookahead + mine.merges.longest + 2 * bpe.STEP
    for parts in (["th", "an", "ing", "in", "er", "a", "b", "e", "haha", "zz"], ["a"], ["ha"], ["ther", "e"]):
        word = "".join(rng.choice(parts) for _ in range(6_000))
        transducer, got = bpe.WordTransducer(mine.merges), []
        for at in range(0, len(word), 100):
            got += transducer.feed(word[at : at + 100])
            assert len(transducer.held) <= bound
        got += transducer.finish()
        assert got == library.encode(word, add_special_tokens=False).ids


def test_decoder_takes_ids_one_by_one(tokenizers):
    mine, library = tokenizers
    ids = library.encode("déjà vu 漢字 🙂 <|endoftext|> x", add_special_tokens=False).ids
    decoder = mine.decoder()
    assert "".join(decoder.feed([i]) for i in ids) + decoder.finish() == library.decode(ids, skip_special_tokens=False)
    halves = bpe.ByteToText({0: b"\xe6", 1: b"\xbc\xa2", 2: b"\xff"})
    assert [halves.feed([0]), halves.feed([1]), halves.feed([2]), halves.finish()] == ["", "漢", "�", ""]


def test_bpe_over_documents(docs, none, tokenizers):
    _, library = tokenizers
    encoded = bpe.encode_documents(clash(docs, "ids"), WORD_BPE, carry=("lang",))
    assert encoded.columns == ["doc_id", "lang", "ids"]
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in encoded.collect():
        assert r["ids"] == library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
    decoded = {r["doc_id"]: r["text"] for r in bpe.decode_documents(encoded, WORD_BPE).collect()}
    assert decoded[4] == library.decode(library.encode("One two").ids, skip_special_tokens=False)
    empty = hashlib.sha256(b"").hexdigest()
    got = {r["doc_id"]: r for r in bpe.round_trip(docs, WORD_BPE).collect()}
    assert (got[0]["n_tokens"], got[0]["ids_sha256"], got[0]["decoded_sha256"]) == (0, empty, empty)
    assert bpe.round_trip(none, WORD_BPE).count() == 0 == bpe.encode_documents(none, WORD_BPE).count()


def test_tokenize_stage_decodes(spark, docs, tokenizers):
    _, library = tokenizers
    got = corpus_pipeline.tokenize(spark, docs, "")
    assert got.columns == ["doc_id", "lang", "source", "ids", "n_tokens", "decoded_sha256"]
    rows = got.collect()
    assert len(rows) == docs.count()
    for r in rows:
        text = library.decode(r["ids"], skip_special_tokens=False)
        assert r["n_tokens"] == len(r["ids"])
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


# 7. Chat formatting.


def test_chat_round_trip(spark):
    odd = ["", "<|end|>\n", "\\", "\\l", "<", "|", "<|and|>x<", r"\### Assistant: </turn> ok", "漢\n🙂", "<|turn|>user\nhi<|end|>\n"]
    roles = ["user", "assistant", "assistant", "us\ner", "<|", "\\n", "assistant", None]
    rng = random.Random(4)
    rows = []
    for conv in (1, 2, 3, None):
        rows += [(conv, turn, rng.choice(roles), rng.choice([*odd, None])) for turn in range(25)]
    rows += [(4, None, "user", "first"), (4, 0, "assistant", "b"), (4, 0, "assistant", "a"), (4, 0, "assistant", "a")]
    rng.shuffle(rows)
    df = clash(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"), "conv", "t", "turns", "formatted")
    got = chat.format_conversations(df).select(
        "conv_id", "formatted", "loss_spans",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_loss_texts(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    assert got.count() == 5
    for r in got.collect():
        mine = [(t, role or "", text or "") for c, t, role, text in rows if c == r["conv_id"]]
        mine.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        assert [(t["role"], t["text"]) for t in r["turns"]] == [x[1:] for x in mine]
        assert r["loss"] == [text for _, role, text in mine if role == "assistant"]
        runs = sum(i == 0 or mine[i][1] != mine[i - 1][1] for i in range(len(mine)))
        assert r["formatted"].count(chat.TURN) == runs == r["formatted"].count(chat.END)
    assert chat.format_conversations(df.limit(0)).count() == 0


# 8. Sharding.


def test_tree_moves_only_what_it_must(spark):
    keys = spark.range(20_000).withColumnRenamed("id", "k")
    shards = [hash_tree.Shard(r, 10 * r + k, 100 * r + 10 * k + s, 1.0 + s) for r in range(2) for k in range(2) for s in range(3)]
    old = hash_tree.Topology(tuple(shards))
    heavier = hash_tree.Topology(tuple(s if s.shard != 2 else hash_tree.Shard(0, 0, 2, 6.0) for s in shards))
    df = hash_tree.assign(keys, "k", old, "a")
    df = hash_tree.assign(df, "k", old.grown(2.0), "b")
    df = hash_tree.assign(df, "k", heavier, "c").cache()
    counts = {r["a"]: r["count"] for r in df.groupBy("a").count().collect()}
    whole = sum(s.weight for s in shards)
    assert all(abs(counts[s.shard] - 20_000 * s.weight / whole) < 250 for s in shards)
    new = max(s.shard for s in shards) + 1
    assert df.where(F.col("b") != F.col("a")).where(F.col("b") != new).count() == 0
    assert abs(df.where(F.col("b") == new).count() - 20_000 * 2 / (whole + 2)) < 250
    # Weight added in region 0: nobody leaves it, and nothing moves between shards of region 1.
    assert df.where("a < 100 AND c >= 100").count() == 0
    assert df.where("a >= 100 AND c >= 100 AND a <> c").count() == 0
    df.unpersist()


def test_shard_documents(docs, none, spark):
    tree = hash_tree.even_topology(24)
    got = hash_tree.shard_documents(clash(docs, *INSIDE), tree, tree.grown()).collect()
    assert len(got) == docs.count()
    by_shard: dict = {}
    for r in got:
        by_shard.setdefault(r["shard"], []).append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 24)
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())
    of = {r["doc_id"]: r for r in got}
    assert (of[0]["size"], of[0]["text_crc32"]) == (8, 0)
    assert of[7]["size"] == len(TEXTS[7].encode()) + 8 and of[7]["text_crc32"] == zlib.crc32(TEXTS[7].encode())
    assert len({r["shard"] for r in got if r["doc_id"] == 5}) == 1
    assert hash_tree.shard_documents(none, tree).count() == 0
    path = files.shared_folder(spark, "shards-test")
    hash_tree.write_shards(docs, hash_tree.shard_documents(docs, tree), path)
    back = spark.read.parquet(path)
    assert back.count() == docs.count()


def test_topology_is_checked():
    one = hash_tree.Shard(0, 0, 0)
    for shards in ((), (one, one), (one, hash_tree.Shard(1, 0, 1)), (hash_tree.Shard(0, 0, 0, 0.0),)):
        with pytest.raises(ValueError):
            hash_tree.Topology(shards)


# 9. Token files.


def test_token_files(docs, none, spark):
    library = Tokenizer.from_file(BYTE_BPE)
    folder = files.shared_folder(spark, "tokens-test")
    index = token_files.write_tokens(clash(docs, "id", "part", "start"), folder, BYTE_BPE)
    rows = token_files.read_tokens(token_files.with_starts(index), folder).collect()
    rows.sort(key=lambda r: r["start"])
    ids = [r["id"] for r in rows]
    assert ids == [None, *sorted(i for i in ids if i is not None)]
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    start = 0
    for r in rows:
        want = [*library.encode(texts[r["id"]], add_special_tokens=False).ids, 2]
        assert (r["start"], r["n_tokens"]) == (start, len(want))
        assert np.frombuffer(r["ids"], dtype="<u4").tolist() == want
        alone = token_files.read_document(folder, r["file"], r["offset"], r["length"])
        assert alone.tolist() == want
        start += len(want)
    folder = files.shared_folder(spark, "tokens-test")
    empty = token_files.write_tokens(none, folder, BYTE_BPE)
    assert token_files.read_tokens(token_files.with_starts(empty), folder).count() == 0


ODD = st.sampled_from(["<|endoftext|>", "  ", "\n", "\r\n", "\t", "'s", " 's", "\x1c", "\x85", "\xa0", "　", "12", "²", "漢字", "🙂", "é", "é"])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.one_of(ODD, st.text(KNOWN, max_size=8), st.just(" ")), max_size=12).map("".join), max_size=4))
def test_word_by_word_equals_library(texts):
    encoder = token_files.load(BYTE_BPE)
    want = [e.ids for e in encoder.library.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, dtype="<u4").tolist() for x in encoder.encode_batch(texts)] == want


def test_words_of_letters_are_not_cut_again():
    encoder = token_files.Encoder(BYTE_BPE)
    cut = []

    class Library:
        def encode_batch_fast(self, texts, **options):
            cut.extend(texts)
            return encoder.plain.encode_batch_fast(texts, **options)

        def __getattr__(self, name):
            return getattr(encoder.plain, name)

    encoder.plain, encoder.library = encoder.library, Library()
    texts = ["Größe words,\n\nother çà&&& it's ƵĠĊ\nend.\n\n\n", "\n", ""]
    want = [e.ids for e in encoder.plain.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, dtype="<u4").tolist() for x in encoder.encode_batch(texts)] == want
    assert cut == [" it's"]


def test_pieces_that_repeat_are_looked_up_once():
    encoder = token_files.Encoder(BYTE_BPE)
    asked = []

    class Known(dict):
        def get(self, piece, *default):
            asked.append(piece)
            return super().get(piece, *default)

    encoder.known = Known()
    texts = ["the words, the words\nand the words\n\n\nand, the\n", "<|endoftext|>", "", "\n", "the\n\n", "\nwords the words", "tab\tthe"] * 20
    want = [e.ids for e in encoder.library.encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):
        asked.clear()
        assert [np.frombuffer(x, dtype="<u4").tolist() for x in encoder.encode_batch(texts)] == want
        assert asked.count("the") == asked.count("words") == 1


def test_new_words_take_no_call_each():
    encoder = token_files.Encoder(BYTE_BPE)
    rng = random.Random(9)
    words = sorted({"".join(rng.choices("abcdeéöüß", k=rng.randint(3, 12))) for _ in range(6_000)})
    texts = [" ".join(words[i::7]) + "." for i in range(7)]
    texts[0] += "\n".join(words[:40]) + "\n\n"
    calls = []
    sys.setprofile(lambda frame, event, arg: calls.append(event) if event in ("call", "c_call") else None)
    try:
        got = encoder.encode_batch(texts)
    finally:
        sys.setprofile(None)
    assert len(calls) < len(words) / 4
    want = [e.ids for e in encoder.library.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, dtype="<u4").tolist() for x in got] == want


def test_words_of_all_kinds_equal_library(monkeypatch):
    monkeypatch.setattr(token_files, "MODEL_WORDS", 3)
    monkeypatch.setattr(token_files, "CACHE_CHUNKS", 40)
    encoder = token_files.Encoder(BYTE_BPE)
    rng = random.Random(10)
    kinds = ["the", "été", "Ġx", "ǅ", "ªº", "&&&", "'", "'s", "it's", "a_", "_a", "x1", "12", "½", "a.b", "ß's'", "\x7f", "º'", "-", "÷×"]
    for _ in range(300):
        texts = ["".join(rng.choice(kinds) + rng.choice([" ", " ", "\n", "\n\n\n", ""]) for _ in range(rng.randint(0, 30))) for _ in range(3)]
        want = [e.ids for e in encoder.library.encode_batch(texts, add_special_tokens=False)]
        assert [np.frombuffer(x, dtype="<u4").tolist() for x in encoder.encode_batch(texts)] == want
    assert encoder.encode_batch([]) == [] and encoder.encode_batch([""]) == [b""]
    plain = [c for c in map(chr, range(0x250)) if token_files._PLAIN.fullmatch(c)]
    assert pc.utf8_is_alpha(pa.array(plain)).to_pylist() == list(map(str.isalpha, plain))


@pytest.mark.parametrize("change", ["every letter has a merge", "ignore_merges"])
def test_tokenizers_without_a_letter_between_words(tmp_path, change):
    with open(BYTE_BPE, encoding="utf-8") as file:
        spec = json.load(file)
    vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
    if change == "ignore_merges":
        spec["model"]["ignore_merges"] = True
    else:
        for letter in [c for c in vocab if len(c) == 1 and c != "a"]:
            if f"a{letter}" not in vocab:
                vocab[f"a{letter}"] = len(vocab) + 1
                merges.append(["a", letter])
    path = tmp_path / "tokenizer.json"
    path.write_text(json.dumps(spec), encoding="utf-8")
    encoder = token_files.Encoder(str(path))
    texts = ["some words, other words\nand more.\n", "été 12", ""]
    want = [e.ids for e in encoder.library.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, dtype="<u4").tolist() for x in encoder.encode_batch(texts)] == want


def test_texts_are_encoded_a_stretch_at_a_time(monkeypatch):
    monkeypatch.setattr(token_files, "TOGETHER_CHARS", 5)
    assert list(token_files._stretches(["ab", "", "cde", "fghijkl", "", "m"])) == [["ab", "", "cde"], ["fghijkl"], ["", "m"]]
    assert list(token_files._stretches([])) == []


def test_long_texts_in_parts_equal_library():
    encoder = token_files.load(BYTE_BPE)
    text = "\t".join(["some words 12 go", "on  and on\r\n", "漢字 here"] * 30_000)
    assert len(text) > 3 * token_files.PART_CHARS
    want = encoder.library.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encoder.encode_batch([text])[0], dtype="<u4").tolist() == want


# 10. SimHash.


def test_fingerprint_in_pieces(monkeypatch):
    text = " ".join(f"w{i * i % 1009}" for i in range(3_000))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "PIECE_BYTES", 100)
    monkeypatch.setattr(simhash, "BLOCK", 7)
    assert simhash.fingerprint(text) == whole
    assert simhash.fingerprint(None) == simhash.fingerprint(" \t") == 0
    assert simhash.fingerprint("A b") == simhash.fingerprint("a B")


def test_close_pairs_are_all_found(spark):
    rng = random.Random(6)
    prints = set()
    for _ in range(200):
        x = rng.getrandbits(64)
        prints.add(x)
        for bits in (1, 1, 2, 2, 2, 3):
            y = x
            for b in rng.sample(range(64), bits):
                y ^= 1 << b
            prints.add(y)
    prints |= {0, 1, 1 << 63, (1 << 64) - 1, 3 << 31}
    signed = [x - (1 << 64) if x >> 63 else x for x in prints]
    df = spark.createDataFrame([(x,) for x in signed], "fp bigint")
    for most in (0, 1, 2):
        got = {(r["a"], r["b"]) for r in simhash.close_pairs(df, most).collect()}
        want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= most}
        assert got == want
    with pytest.raises(ValueError):
        simhash.close_pairs(df, 3)


def test_simhash_dedup(docs, none):
    got = {r["doc_id"]: r for r in simhash.simhash_dedup(clash(docs, *INSIDE)).collect()}
    assert {got[i]["component_id"] for i in (0, 1, 2)} == {0}
    assert got[0]["fingerprint"] == "0" * 16
    assert got[5]["component_id"] == got[6]["component_id"] == 5
    assert {got[i]["component_id"] for i in (8, 9, 10)} == {8}
    assert got[None]["component_id"] is None and got[None]["kept"]
    assert simhash.simhash_dedup(none).count() == 0
    left = simhash.keep_representatives(clash(docs, "dropped_id", "fp"))
    assert left.columns == [*docs.columns, "dropped_id", "fp"]
    assert sorted(r["doc_id"] for r in left.where("doc_id IS NOT NULL").collect()) == [0, 3, 4, 5, 5, 7, 8, 11]
