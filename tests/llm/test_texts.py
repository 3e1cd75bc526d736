"""License scans, quality rules, languages and BPE against plain versions."""

import hashlib
import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.conftest import odd_rows, sentence
from topup_analytics.llm import bpe, language, licenses, quality
from topup_analytics.llm.common import read_table


def plain_licenses(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    places = []
    for phrase, label in licenses.PHRASES.items():
        parts = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(parts)] == parts]
    share, labels = 0, {label for _, label in places}
    step = licenses.BLOCK_WORDS - licenses.OVERLAP
    for at in range(0, max(1, len(words) - licenses.OVERLAP), step):
        block = set(words[at : at + licenses.BLOCK_WORDS])
        for label, template in licenses.TEMPLATES:
            own = set(template.split())
            if 10 * len(own & block) >= 9 * len(own):
                labels.add(label)
                share = max(share, len(own & block) / len(own))
    starts = [i for i, _ in places]
    return (
        len(words),
        len(places),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(sorted({label for _, label in places})),
        ",".join(sorted(labels)),
        1.0 if places else share,
    )


def lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen = Counter(windows)
    covered = {k for i, w in enumerate(windows) if seen[w] > 1 for k in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


LICENSED = [
    "Released under the MIT License.",
    "x\nThis work is LICENSED under the GNU General Public License, version 3.\ny CC BY, cc by",
    "under the gnu license this work is general public version 3 of it",
    "licensed under the apache license\nversion 2 0",
    " ".join(f"w{i}" for i in range(150)) + " licensed under the apache license version 2 0 " + "z " * 90,
    "CC  BY all rights\nreserved, All Rights. Reserved École général",
    "cc by cc by cc",
]


def test_licenses(spark, odd):
    rows = [(i, t) for i, t in enumerate(LICENSED)]
    found = licenses.license_matches(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id", "text"]).collect()
    found += licenses.license_matches(odd, ["doc_id", "text"]).collect()
    assert len(found) == len(rows) + len(odd_rows())
    for r in found:
        assert tuple(r)[1:] == pytest.approx(plain_licenses(r["row"]["text"])), r["row"]["text"][:200]


MIT = """Copyright (c) 2020 Somebody

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice,
   this list of conditions and the following disclaimer."""
APACHE = """                                 Apache License
                           Version 2.0, January 2004"""
GPL = """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or"""


def test_notices_that_are_wrapped_over_lines(spark):
    notices = {"mit": MIT, "bsd": BSD, "apache": APACHE}
    filler = " ".join(f"w{i}" for i in range(77)) + "\n"
    rows = [(label, filler[:cut] + text + "\n" + filler) for label, text in notices.items() for cut in range(0, 300, 23)]
    rows.append(("gpl", GPL))
    found = licenses.license_matches(spark.createDataFrame(rows, "label string, text string")).collect()
    assert all(r["labels"] == r["row"]["label"] and r["score"] >= 0.9 for r in found)
    for _, text in licenses.TEMPLATES:
        assert len(text.split()) <= licenses.OVERLAP + 1


def test_licenses_in_very_many_lines(spark):
    """Time and memory grow with the text: half a million lines with a phrase, and as many with template words only."""
    n = 500_000
    rows = [(1, "copyright acme all rights reserved\n" * n), (2, "copyright of the license\n" * n), (3, "released by the mit under a license\n" * n)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r["row"]["doc_id"]: tuple(r)[1:] for r in licenses.license_matches(frame, ["doc_id"]).collect()}
    assert found[1] == (5 * n, n, 2, 5 * n - 3, "reserved", "reserved", 1.0)
    assert found[2] == (4 * n, 0, None, None, "", "", 0.0)
    assert found[3] == (7 * n, 0, None, None, "", "mit", 1.0)


def test_licenses_of_nothing(none):
    assert licenses.license_matches(none).count() == 0


def test_quality_counts(spark, odd):
    repeated = "a b c d e f g h i j k l " * 3 + "x y z\nx y z\n\n \nx y z\n# * $ | <é>"
    extra = spark.createDataFrame([(50, repeated, "en")], "doc_id long, text string, lang string")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    for docs in (odd, extra):
        rows = quality.judged(docs, ["text"]).collect()
        assert len(rows) == docs.count()
        for r in rows:
            assert tuple(r[n] for n in names) == plain_counts(r["row"]["text"])
            assert not (r["kept"] and r["base_failed"])


def test_quality_keeps_clean_texts(spark):
    sf = "/root/testdata/sf0.01"
    labels = pd.read_parquet(f"{sf}/labels.parquet").set_index("doc_id")["quality"]
    rows = quality.judged(read_table(spark, sf, "documents"), ["doc_id"]).select("row.doc_id", "base_failed", "kept").collect()
    passed = [r for r in rows if r["doc_id"] in labels.index and not r["base_failed"]]
    assert all(r["kept"] for r in passed if labels[r["doc_id"]] == 1)
    junk = [r["kept"] for r in passed if labels[r["doc_id"]] == 0]
    assert sum(junk) < 0.3 * len(junk)


def test_quality_without_references(none, odd):
    assert quality.judged(none).count() == 0
    rows = quality.judged(odd.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert all(r["kept"] != r["base_failed"] and r["distance"] is None for r in rows)


def test_quality_of_further_languages(spark):
    rng = random.Random(5)
    frequent = "и в не на я что он с как это по но".split()
    rare = ["".join(rng.choice("абвгдежзиклмнопрстуфхцчшыя") for _ in range(rng.randint(4, 9))) for _ in range(400)]
    clean = lambda: " ".join(rng.choice(frequent if rng.random() < 0.4 else rare) for _ in range(300))
    junk = lambda: " ".join(f"{rng.randrange(10**9)}=={rng.randrange(10**6)}" for _ in range(60))
    rows = [(i, clean(), "ru", True) for i in range(120)] + [(200 + i, junk(), "ru", False) for i in range(4)]
    rows += [(300, clean(), None, True), (301, junk(), None, False), (302, clean(), "en", True)]
    # A single text is a reference too; a language without a text that passes the base has none.
    rows += [(400, sentence(rng, 60, "אבגדהוזח"), "he", True), (401, "le la " * 40, "fr", None)]
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string")
    docs = docs.union(read_table(spark, "/root/testdata/sf0.001", "documents").where("lang <> 'fr'").selectExpr("doc_id + 1000", "text", "lang"))
    assert set(quality.common_words(docs)["ru"]) == set(frequent)
    found = {r["row"]["doc_id"]: r for r in quality.judged(docs, ["doc_id"]).where("row.doc_id < 1000").collect()}
    for doc, _, _, kept in rows:
        if kept is None:
            assert found[doc]["kept"] != found[doc]["base_failed"] and found[doc]["distance"] is None
        else:
            assert found[doc]["kept"] == kept and found[doc]["distance"] is not None


def test_quality_of_a_fifth_language_is_that_of_the_sql(spark, tmp_path):
    rng = random.Random(11)
    text = lambda n: " ".join(rng.choice("и в не на я что он слово мир дом день ночь рука 12 !".split()) for _ in range(n))
    more = [(10_000 + i, text(rng.randint(10, 90)), "ru") for i in range(9)] + [(20_000, "qq ww " * 30, "xx"), (20_001, sentence(rng, 50), "yy")]
    docs = read_table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text", "lang")
    docs.union(spark.createDataFrame(more, docs.schema)).write.parquet(f"{tmp_path}/documents.parquet")
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    ours = quality.op9_quality_rules(spark, str(tmp_path)).toPandas()
    theirs = connection.sql(quality.OP9_SQL).df()[list(ours.columns)]
    key = ["doc_id", "n_words"]
    pd.testing.assert_frame_equal(
        ours.sort_values(key).reset_index(drop=True), theirs.sort_values(key).reset_index(drop=True), check_dtype=False, atol=2e-6
    )
    assert ours[ours.doc_id.between(10_000, 10_008)].distance.notna().any()


def test_divergence_is_symmetric_and_bounded(spark):
    frame = spark.createDataFrame([([1.0, 0.0],), ([0.5, 0.5],), ([0.0, 1.0],)], "p array<double>")
    got = [r[0] for r in frame.select(quality._divergence(F.col("p"), F.array(F.lit(0.0), F.lit(1.0)))).collect()]
    assert got == pytest.approx([1.0, 0.31127812445913283, 0.0])


def test_languages(spark, odd, none):
    docs = read_table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text", "lang")
    names, model = language.learn(docs.where(~language.held_out()))
    assert names == ["de", "en", "es", "fr"] and np.allclose(model.sum(axis=0), 1)
    rows = language.with_languages(docs.where(language.held_out()), names, model).collect()
    assert sum(r["row"]["lang"] == r["lang_pred"] for r in rows) > 0.97 * len(rows)
    strange = language.with_languages(odd, names, model).select("row.text", "lang_pred", "score", "languages", "shares").collect()
    assert len(strange) == len(odd_rows())
    for r in strange:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters) and 0 <= r["score"] <= 1
        assert r["shares"] == sorted(r["shares"], reverse=True) and len(r["shares"]) == len(r["languages"])
    assert language.with_languages(none, names, model).count() == 0
    unknown, empty = language.learn(none)
    assert {r[0] for r in language.with_languages(odd, unknown, empty).select("lang_pred").collect()} == {"und"}


def test_mixture_of_two_languages(spark):
    docs = read_table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text", "lang")
    names, model = language.learn(docs)
    texts = {}
    for r in docs.where("length(text) between 1500 and 4000").collect():
        texts.setdefault(r["lang"], []).append(r["text"])
    mixed = [a + " " + b for a, b in zip(texts["de"], texts["fr"])][:10]
    frame = spark.createDataFrame([(t,) for t in mixed], "text string")
    for r in language.with_languages(frame, names, model).collect():
        assert {"de", "fr"} <= set(r["languages"]) and sum(r["shares"]) == pytest.approx(1, abs=1e-4)


def test_shares_raise_the_likelihood():
    rng = np.random.default_rng(1)
    model = rng.dirichlet(np.full(50, 0.2), 3).T
    counts = rng.multinomial(4000, model @ [0.7, 0.0, 0.3], 5).astype(float)
    shares = language.infer(counts, np.maximum(model, 1e-9))
    assert np.allclose(shares.sum(axis=1), 1) and np.abs(shares - [0.7, 0, 0.3]).max() < 0.06


def plain_trigrams(text):
    """Buckets of the trigrams inside words, with a space at the ends of words."""
    letters = re.sub(" +", " ", "".join(c if c.isalpha() else " " for c in f" {text.lower()} "))
    found = Counter()
    for a, b, c in zip(letters, letters[1:], letters[2:]):
        if b != " ":
            x = (ord(a) * 0x9E3779B1 ^ ord(b) * 0x85EBCA6B ^ ord(c) * 0xC2B2AE35) & 0xFFFFFFFF
            found[((x ^ x >> 15) * 0x2C1B3C6D & 0xFFFFFFFF) >> 20] += 1
    return found


def plain_learned(rows):
    """Each language's probabilities of the buckets, from its different texts."""
    counts = {}
    for text, lang in {(t, l) for t, l in rows if t and l is not None}:
        counts.setdefault(lang, Counter()).update(plain_trigrams(text))
    return {
        lang: [(own[k] + language.SMOOTHING) / (sum(own.values()) + language.SMOOTHING * language.BUCKETS) for k in range(language.BUCKETS)]
        for lang, own in counts.items()
    }


def plain_languages(text, model):
    """The set of languages by penalised likelihood, and their shares, with a fixed, large number of steps."""
    found = plain_trigrams(text or "")
    if not found:
        return {}
    buckets, n = list(found), np.array(list(found.values()), dtype=float)
    parts = {lang: np.array([p[k] for k in buckets]) for lang, p in model.items()}

    def fitted(langs):
        shares = np.full(len(langs), 1 / len(langs))
        table = np.stack([parts[x] for x in langs])
        for _ in range(500):
            shares = shares * (table @ (n / (shares @ table))) / n.sum()
        return float(n @ np.log(shares @ table)), dict(zip(langs, shares))

    best = max((fitted([x]) for x in sorted(model)), key=lambda f: f[0])
    while len(best[1]) < len(model):
        wider = max((fitted([*best[1], x]) for x in sorted(model) if x not in best[1]), key=lambda f: f[0])
        if wider[0] <= best[0] + language.PENALTY * math.log(n.sum()):
            break
        best = wider
    return best[1]


def test_languages_row_by_row(spark, small, odd):
    table = read_table(spark, small, "documents").select("doc_id", "text", "lang").collect()
    texts = {}
    for r in table:
        texts.setdefault(r["lang"], []).append(r["text"])
    docs = spark.createDataFrame(table + table[:20], "doc_id long, text string, lang string").repartition(3)
    names, model = language.learn(docs)
    plain = plain_learned([(r["text"], r["lang"]) for r in table])
    assert names == sorted(plain) and np.allclose(model, np.array([plain[x] for x in names]).T)
    rows = [r["text"] for r in table[:70]] + [a[:600] + " " + b[:900] for a, b in zip(texts["en"], texts["es"])][:15]
    rows += [t for t in (r[1] for r in odd_rows()) if len(t or "") < 2000]
    got = language.with_languages(spark.createDataFrame([(t,) for t in rows], "text string"), names, model).collect()
    assert len(got) == len(rows)
    for r in got:
        want = plain_languages(r["row"]["text"], plain)
        assert set(r["languages"]) == set(want), r["row"]["text"][:80]
        assert r["lang_pred"] == (max(want, key=want.get) if want else "und")
        assert dict(zip(r["languages"], r["shares"])) == pytest.approx(want, abs=0.03)


def test_every_labelled_language_is_learned(spark):
    rng = random.Random(6)
    letters = [chr(c) for c in range(0x4E00, 0x4E00 + 2600)]
    texts = [(f"l{k:03}", sentence(rng, 40, letters[10 * k : 10 * k + 10])) for k in range(260)]
    docs = spark.createDataFrame([t for t in texts for _ in range(1 + (t[0] > "l003"))], "lang string, text string")
    names, model = language.learn(docs)
    assert names == [name for name, _ in texts]
    rows = language.with_languages(docs, names, model).collect()
    assert all(r["languages"] == [r["row"]["lang"]] for r in rows)


def test_copies_are_learned_once(spark, monkeypatch):
    monkeypatch.setattr(language, "FIT_TEXTS", 50)
    rng = random.Random(9)
    # Most rows of each language are copies of one text.
    hot = {"de": sentence(rng, 30, "abcd"), "en": sentence(rng, 30, "efgh")}
    others = [(lang, sentence(rng, 30, "ijkl")) for lang in hot for _ in range(60)]
    docs = spark.createDataFrame([t for t in hot.items() for _ in range(2000)] + others, "lang string, text string")
    assert language.learn(docs)[0] == ["de", "en"]
    monkeypatch.setattr(language, "FIT_TEXTS", 1000)
    once = spark.createDataFrame([*hot.items(), *others], "lang string, text string")
    assert np.allclose(language.learn(docs)[1], language.learn(once)[1])


def test_the_likelihood_alone_limits_the_languages():
    rng = np.random.default_rng(3)
    model = np.maximum(rng.dirichlet(np.full(200, 0.2), 7).T, 1e-9)
    model /= model.sum(axis=0)
    for want in ([0.3, 0.2, 0.2, 0.15, 0.15, 0, 0], [0, 0.96, 0, 0, 0, 0, 0.04], [0, 0, 1, 0, 0, 0, 0]):
        counts = rng.multinomial(60_000, model @ want, 3).astype(np.float32)
        shares = language.infer(counts, model.astype(np.float32))
        assert ((shares > 0) == (np.array(want) > 0)).all() and np.abs(shares - want).max() < 0.02


def test_bpe_of_odd_rows(odd, none):
    tokenizer = bpe.encoding()
    rows = bpe.encode(odd, data="bytes", ids="ids").select("text", "ids", "bytes", "held").collect()
    assert len(rows) == len(odd_rows())
    for r in rows:
        assert r["ids"] == tokenizer.encode_ordinary(r["text"] or "")
        assert bytes(r["bytes"]) == (r["text"] or "").encode()
    again = bpe.decode(bpe.encode(odd, ids="ids")).select("text", "data").collect()
    assert all(bytes(r["data"]) == (r["text"] or "").encode() for r in again)
    assert bpe.encode(none, data="data").count() == 0


def test_decoding_parts_of_characters(spark):
    ids = bpe.encoding().encode_ordinary("é漢")
    frame = spark.createDataFrame([(ids[:1],), (None,), ([],)], "ids array<int>")
    got = [bytes(r["data"]) for r in bpe.decode(frame).collect()]
    assert got == [bpe.encoding().decode_bytes(ids[:1]), b"", b""]


PARTS = st.sampled_from(["a", "b'", "'s", "  ", " ", "\n", "　", "é", "1", "!!", "\x1c", "\x85", "ß漢", "\t\t", "'ll", "x" * 9])


@settings(max_examples=300, deadline=None)
@given(st.lists(PARTS, max_size=60).map("".join), st.integers(1, 12))
def test_split_texts_encode_like_whole_ones(text, chunk):
    tokenizer = bpe.encoding()
    assert bpe.encode_text(text, tokenizer, chunk).tolist() == tokenizer.encode_ordinary(text)
    assert "".join(part for part, _ in bpe.split_safely(text, chunk)) == text


def test_very_long_runs():
    tokenizer = bpe.encoding()
    for text in (" " * 1_500_000 + "x", "a" + "\n" * 300_000, "y" * 400_000, "　" * 100_000 + " b c"):
        ids = bpe.encode_text(text, tokenizer)
        assert hashlib.sha256(tokenizer.decode_bytes(ids.tolist())).digest() == hashlib.sha256(text.encode()).digest()
