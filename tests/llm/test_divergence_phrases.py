"""Divergence of sources and collocations against plain Python on a small table with awkward rows."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from assaymill.llm import divergence, phrases
from tests.llm.test_corpus import CLASHING, SCHEMA, texts

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def table() -> list[tuple]:
    rows = [(i, t, lang, [None, "", "a", "b", "é"][k % 5]) for k, (i, t, lang) in enumerate(texts())]
    rows += [(900 + k, "One two, one two. THREE four five; one two three four five\vsix " * (k % 4 + 1), "en", f"s{k % 7}") for k in range(40)]
    rows += [(950, "lone words of a single source", "xx", "only"), (951, None, "yy", "a"), (952, "", "yy", "b")]
    return rows


@pytest.fixture(scope="module")
def rows():
    return table()


@pytest.fixture(scope="module")
def docs(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "d")
    full = [(i, t, lang, source, len(t or ""), *["x"] * len(CLASHING)) for i, t, lang, source in rows]
    spark.createDataFrame(full, SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def slow_divergence(rows, least):
    counts, docs_with, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        found = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(LOWER))
        counts[lang, source].update(found)
        docs_with[lang].update(set(found))
    out = set()
    for lang in {g[0] for g in groups}:
        kept = [t for t, d in docs_with[lang].items() if d >= least]
        sources = [s for g, s in groups if g == lang]
        whole = Counter()
        for s in sources:
            whole.update({t: counts[lang, s][t] for t in kept})

        def p(count, t):
            return 1 + 1000000000 * (count[t] + 2) // (sum(count[u] for u in kept) + 2 * len(kept))

        shares = {s: {t: p(counts[lang, s], t) for t in kept} for s in sources}
        all_ = {t: p(whole, t) for t in kept}
        gap = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(-sum(gap(shares[s][t], shares[o][t]) for t in kept), o.encode(), o) for o in sources if o != s]
            out |= {(lang, s, "pair", o, -v, k + 1) for k, (v, _, o) in enumerate(sorted(pairs))}
            terms = [(-gap(shares[s][t], all_[t]), t.encode(), t) for t in kept if counts[lang, s][t] and shares[s][t] > all_[t]]
            out |= {(lang, s, "term", t, -v, k + 1) for k, (v, _, t) in enumerate(sorted(terms)[:10])}
    return out


@pytest.mark.parametrize("block, tile", [(8192, 32), (7, 2)])
def test_divergence(docs, rows, monkeypatch, block, tile):
    monkeypatch.setattr(divergence, "LEAST_DOCS", 3)
    monkeypatch.setattr(divergence, "BLOCK", block)
    monkeypatch.setattr(divergence, "TILE", tile)
    got = [tuple(r) for r in divergence.divergence(docs).collect()]
    assert len(got) == len(set(got))
    assert set(got) == slow_divergence(rows, 3)


def test_divergence_of_nothing(spark):
    assert divergence.divergence(spark.createDataFrame([], SCHEMA)).collect() == []


def test_terms_in_slices(monkeypatch):
    text = "Éa1b  c-D " * 50 + "x" * 100
    whole = [t for part in divergence.terms(text) for t in part]
    monkeypatch.setattr(divergence, "SLICE", 16)
    assert [t for part in divergence.terms(text) for t in part] == whole
    assert [t.decode() for t in whole] == re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", text.translate(LOWER))


def test_counts_beyond_64_bits(spark):
    df = spark.createDataFrame([(5 * 10**11, 10**14, 10**9), (0, 0, 0)], "n bigint, whole bigint, v bigint")
    got = [r["p"] for r in df.select(divergence.probability("n", "whole", "v").alias("p")).collect()]
    assert got == [1 + 10**9 * (5 * 10**11 + 2) // (10**14 + 2 * 10**9), None]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=40), st.data())
def test_columns_of_runs(a, data):
    b = data.draw(st.lists(st.integers(0, 3), min_size=len(a), max_size=len(a)))
    p = lambda count: np.array([1 + 1000 * c for c in count], dtype=np.int64)

    def runs(values):
        found = [(k, 1, v) for k, v in enumerate(p(values)) if v > 1]
        starts, lengths, v = (np.array([f[i] for f in found], dtype=np.int64) for i in range(3))
        return divergence.column_of(starts, lengths, v, len(values), 1)

    assert divergence.compare(runs(a), runs(b), len(a)) == sum((x - y) ** 2 // (x + y) for x, y in zip(p(a).tolist(), p(b).tolist()))


def slow_phrases(rows, least, top):
    counts, words = defaultdict(Counter), Counter()
    for _, text, lang, _ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\v\f\r]", (text or "").translate(LOWER)):
            w = re.findall("[^ \t]+", piece)
            words[lang] += len(w)
            for k in range(1, 5):
                counts[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = set()
    for lang, f in counts.items():
        common = {c: a for c, a in f.items() if len(c) > 1 and a >= least}
        gone = set()
        for c, a in common.items():
            for k in range(2, len(c)):
                gone |= {c[i : i + k] for i in range(len(c) - k + 1) if 100 * a >= 80 * common[c[i : i + k]]}
        found = []
        for c, a in common.items():
            score, k = min((2000000 * a // (f[c[:k]] + f[c[k:]]), k) for k in range(1, len(c)))
            if c not in gone:
                found.append((-score, -a, " ".join(c).encode(), f[c[:k]], f[c[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, words[lang], -score))
    return out


@pytest.mark.parametrize("least, top", [(2, 2000), (3, 5), (30, 2000)])
def test_collocations(docs, rows, least, top):
    got = [tuple(r) for r in phrases.collocations(docs, least, top).collect()]
    assert len(got) == len(set(got))
    assert set(got) == slow_phrases(rows, least, top)


def test_collocations_with_small_tries(spark, docs, rows, monkeypatch):
    """Bursting, spilling, renumbering and a filter in which nearly every pair hits change nothing."""
    for name, small in (("BURST", 4), ("ENTRIES", 50), ("NUMBERED", 300), ("TOKENS", 200), ("PAIRS", 500), ("ROWS", 2), ("BUCKET", 1 << 12)):
        monkeypatch.setattr(phrases, name, small)
    monkeypatch.setattr(phrases.HatTrie.__init__, "__defaults__", (4,))
    monkeypatch.setattr(phrases.frequent_filter, "__defaults__", (1 << 7,))
    assert {tuple(r) for r in phrases.collocations(docs, 2).collect()} == slow_phrases(rows, 2, 2000)


def test_collocations_of_nothing(spark):
    assert phrases.collocations(spark.createDataFrame([], SCHEMA)).collect() == []


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("ab"), *[st.integers(0, 3)] * 3), max_size=60), st.integers(1, 5), st.integers(0, 20))
def test_trie_counts_paths(given_, burst, keep):
    trie, out = phrases.HatTrie(burst), Counter()
    for k, path in enumerate(given_):
        trie.add(path, k + 1)
        if trie.size > keep:
            for run in trie.spill(keep // 2):
                out.update(dict(run))
    for run in trie.spill(0):
        out.update(dict(run))
    assert trie.size == 0
    expected = Counter()
    for k, path in enumerate(given_):
        expected[path] += k + 1
    assert out == expected
