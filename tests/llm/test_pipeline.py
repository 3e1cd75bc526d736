"""Each stage of the pipeline against a plain version, over what the stage before has kept."""

import math
import re
from collections import Counter

import pytest

import corpus_pipeline
from tests.llm.conftest import odd_rows
from tests.llm.test_jaccard import plain_components
from tests.llm.test_texts import plain_counts
from topup_analytics.llm import bpe, quality
from topup_analytics.llm.common import read_table, stored

CLASSES = {"upper": "[A-Z]", "lower": "[a-z]", "digit": "[0-9]", "space": r"[\x20\x09-\x0D]", "mark": r"[.,;:'\"()!?-]"}


def plain_common(rows):
    """The words found in most texts of each language."""
    found = {}
    for text, lang in rows:
        if lang is not None:
            found.setdefault(lang, Counter()).update(set(re.findall(r"[^\x20\x09-\x0D]+", text or "")))
    ranked = {lang: sorted(seen, key=lambda w: (-seen[w], w.encode())) for lang, seen in found.items()}
    return {lang: [*ws[: quality.N_COMMON], *[""] * (quality.N_COMMON - len(ws))] for lang, ws in ranked.items()}


def plain_histograms(text, groups):
    counts = [len(re.findall(p, text)) for p in CLASSES.values()] + [sum(ord(c) > 127 for c in text)]
    words = Counter(re.findall(r"[^\x20\x09-\x0D]+", text))
    common = {k: [words[w] for w in group] for k, group in groups.items()}
    n = sum(words.values())
    return [*counts, len(text) - sum(counts)], {k: [*c, n - sum(c)] for k, c in common.items()}


def shares(counts):
    return [c / sum(counts) for c in counts]


def divergence(p, q):
    part = lambda a, b: a * math.log2(2 * a / (a + b)) if a else 0.0
    return sum(part(a, b) + part(b, a) for a, b in zip(p, q)) / 2


def plain_verdicts(rows):
    """(kept, distance) of rows (text, lang)."""
    groups = plain_common(rows)
    found = [(plain_histograms(t or "", groups), plain_counts(t), lang) for t, lang in rows]

    def references(use):
        sums = {}
        for lang in groups:
            own = [h for (h, _, l), u in zip(found, use) if u and l == lang]
            if own:
                sums[lang] = [[sum(x) for x in zip(*part)] for part in ([h[0] for h in own], [h[1][lang] for h in own])]
        out = {lang: [] for lang in sums}
        for kind, amount in ((0, quality.SMOOTH_CHARS), (1, quality.SMOOTH_WORDS)):
            mean = shares([sum(x) for x in zip(*(parts[kind] for parts in sums.values()))]) if sums else []
            for lang, parts in sums.items():
                out[lang].append(shares([n + amount * m for n, m in zip(parts[kind], mean)]))
        return out

    def distance(h, counts, lang, refs):
        if counts[0] < quality.JUDGED_WORDS or not refs or not (lang is None or lang in refs):
            return None
        return min(
            math.sqrt((divergence(shares(h[0]), c) + divergence(shares(h[1][name]), w)) / 2) for name, (c, w) in refs.items()
        )

    far = lambda d: d is not None and d > quality.MOST_DISTANCE
    passed = [not counts[5] for _, counts, _ in found]
    first = references(passed)
    refs = references([p and not far(distance(h, c, lang, first)) for (h, c, lang), p in zip(found, passed)])
    distances = [distance(h, c, lang, refs) for h, c, lang in found]
    return [(p and not far(d), d) for p, d in zip(passed, distances)]


@pytest.mark.parametrize("which", ["small", "odd"])
def test_quality_stage(spark, small, odd, which):
    docs = odd if which == "odd" else read_table(spark, small, "documents")
    rows = quality.judged(docs).select("row.text", "row.lang", "kept", "distance").collect()
    want = plain_verdicts([(r["text"], r["lang"]) for r in rows])
    assert [r["kept"] for r in rows] == [kept for kept, _ in want]
    for r, (_, distance) in zip(rows, want):
        assert (r["distance"] is None) == (distance is None) and (r["distance"] or 0) == pytest.approx(distance or 0)
    kept = corpus_pipeline.quality_rules(spark, docs, small)
    assert kept.columns == docs.columns
    assert Counter(r["text"] for r in kept.collect()) == Counter(r["text"] for r in rows if r["kept"])


@pytest.mark.parametrize("which", ["small", "odd", "none"])
def test_stages_on_what_is_kept(spark, small, odd, none, which):
    docs = {"odd": odd, "none": none}.get(which) or read_table(spark, small, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = stored(stage(spark, docs, small))
        after = docs.collect()
        if name != "byte_bpe":
            assert docs.columns == columns
        if name == "language_id":
            gone = Counter(r["text"] for r in before) - Counter(r["text"] for r in after)
            assert all(not any(c.isalpha() for c in t or "") for t in gone) or which == "odd"
            assert all(r["lang"] is not None for r in after)
        if name == "near_duplicates":
            numbered = [(i, r["text"]) for i, r in enumerate(before)]
            groups = {c for _, n, c in plain_components(numbered, 5, 80) if n}
            assert len(after) == len(groups) + sum(not (r["text"] or "").split() for r in before)
            assert {r["text"] for r in after} <= {r["text"] for r in before}
        if name == "source_mixture":
            size = sum(len((r["text"] or "").split()) for r in before)
            assert abs(sum(len(r["text"].split()) for r in after) - size) <= 0.02 * size
        if name == "byte_bpe":
            texts = Counter(tuple(bpe.encoding().encode_ordinary(r["text"] or "")) for r in before)
            assert Counter(tuple(r["ids"]) for r in after) == texts
            assert all(r["exact"] and r["n_tokens"] == len(r["ids"]) for r in after)


def test_odd_rows_are_odd_enough():
    assert any(r[1] is None for r in odd_rows()) and any(r[0] is None for r in odd_rows())


def test_run(spark, small):
    rows = corpus_pipeline.run(spark, small)
    assert rows.columns == ["doc_id", "lang", "source", "n_tokens", "ids", "exact"]
    assert rows.where("exact").count() == rows.count() > 0
    assert corpus_pipeline.ORACLE_SQL is None and 4 <= len(corpus_pipeline.STAGES) <= 5
