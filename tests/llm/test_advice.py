"""Work that earlier rounds left out: each test fails on the shortened form."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest

import corpus_pipeline
from assaymill.llm import counts, language, mixing, repeats
from assaymill.llm.pieces import read_pieces
from assaymill.llm.queries import VOCABULARIES


def documents(shift: float, sharp: float = 3.0):
    draw = np.random.default_rng(2)
    z = draw.normal(size=(4000, 3)) * sharp + np.array([2.0, 0.0, shift])
    p = np.exp(z - z.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True), draw.integers(10, 2000, 4000).astype(float)


def descended(p, n, goal):
    """Domain tokens after the steps, worked out with numpy."""

    def look(steps):
        before = now = np.ones(len(n))
        for step in steps:
            before, now = now, np.maximum(0.0, now + p @ np.array(step))
        open_ = p[now > 0]
        return (n * now) @ p, (open_ * n[now > 0, None]).T @ open_, float((n * (now - before) ** 2).sum())

    return look(mixing.descend(look, goal))[0]


@pytest.mark.parametrize("shift", [-2.0, -15.0])
def test_each_domain_meets_its_own_target(shift):
    """Also one that holds a tiny part of all tokens."""
    p, n = documents(shift)
    goal = (n @ p) * np.array([1.0, 0.5, 0.2])
    assert np.allclose(descended(p, n, goal), goal, rtol=2e-6, atol=0)


def test_targets_out_of_reach_end_near_the_least_misses():
    """A document of each domain is partly in the others, so zero of one and all of another cannot be."""
    p, n = documents(-2.0, 1.0)
    goal = (n @ p) * np.array([1.0, 0.5, 0.0])
    metric = np.linalg.inv((p * n[:, None]).T @ p)
    first, last = goal - n @ p, goal - descended(p, n, goal)
    assert last @ metric @ last < 1e-2 * (first @ metric @ first)


def test_rates_of_a_table_meet_each_target(spark):
    p, n = documents(-8.0)
    members = spark.createDataFrame([(int(a), [float(x) for x in b]) for a, b in zip(n, p)], "n_tokens bigint, p array<double>")
    goal = (n @ p) * np.array([1.0, 0.5, 0.1])
    steps = mixing.fit_rates(members, dict(zip(mixing.DOMAINS, goal)))
    rates = np.array([r[0] for r in members.select(mixing.rate(steps)).collect()])
    weight = np.array([r[0] for r in members.select("n_tokens").collect()])
    shares = np.array([r[0] for r in members.select("p").collect()])
    assert np.allclose((weight * rates) @ shares, goal, rtol=2e-6, atol=0)


def test_the_pipeline_keeps_the_toxic_target():
    assert corpus_pipeline.KEEP == {"good": 1.0, "poor": 0.5, "toxic": 0.02}


@pytest.mark.parametrize("name", ["byte_bpe_50k", "byte_bpe_multi_50k"])
def test_all_pieces_are_read(name):
    path = f"{VOCABULARIES}/{name}.tiktoken"
    with open(path, "rb") as lines:
        assert len(read_pieces(path)) == sum(1 for line in lines if line.strip())


def test_a_long_piece_is_one_token():
    vocabulary = read_pieces(f"{VOCABULARIES}/byte_bpe_50k.tiktoken")
    trie = counts.Trie(vocabulary)
    assert trie.count("responsibilities") == trie.count("telecommunications") == 1
    assert trie.count("responsibilitiesresponsibilities") > 1


def test_long_words_are_learned_from(monkeypatch):
    """In logarithms as by plain sums, in several batches, and without underflow."""
    pieces = language.Pieces([b" ", b"a", b"b", b" a", b"ab", b" ab", b"ababababababababababab"])
    probability = np.array([[0.2, 0.1], [0.1, 0.3], [0.3, 0.1], [0.1, 0.2], [0.2, 0.2], [0.05, 0.05], [0.05, 0.05]])
    found, weight = ["ab" * 11, "abab", "ba" * 9, "a"], np.array([[1.0, 2.0], [3.0, 0.0], [0.0, 1.0], [2.0, 2.0]])
    plain = language.expected(found, weight, pieces, probability)
    monkeypatch.setattr(language, "SHORT", 3)
    monkeypatch.setattr(language, "CELLS", 30)
    assert np.allclose(language.expected(found, weight, pieces, probability), plain)
    n = language.expected(["ab" * 3000], np.array([[1.0, 0.0]]), pieces, probability * 1e-3)
    sizes = np.array([len(p) for p in pieces.number])
    assert n[:, 0] @ sizes == pytest.approx(6001) and not n[:, 1].any()


def test_windows_of_one_anchor_spread():
    """Different windows under a common anchor go to many buckets, equal ones to one."""
    draw = np.random.default_rng(3)
    line = b"a line that very many documents have"
    texts = [draw.bytes(60).hex().encode() + line + draw.bytes(60).hex().encode() for _ in range(300)]
    _, _, _, h, _ = repeats.runs(texts)
    assert np.unique(h, return_counts=True)[1].max() > 100
    found = [repeats.window_hash(repeats.eights(np.frombuffer(t, dtype=np.uint8)), np.array([100]), 3) for t in texts]
    to = repeats.window_bucket(np.concatenate(found), 64)
    assert np.bincount(to, minlength=64).max() < 20
    assert (repeats.window_bucket(np.concatenate(found), 64) == to).all()


def test_the_last_stage_decodes(spark):
    texts = ["a plain text", "né 😀  two\nlines "]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: r["decoded_sha256"] for r in corpus_pipeline.encode(spark, docs, "").collect()}
    assert got == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in enumerate(texts)}


def test_numbers_are_no_letters():
    """One half and squares are numbers: a text of them alone has no letter."""
    assert language.words("½ ² 12 Ⅳ") == []
    assert language.words("Éa½b x²y") == ["éa", "b", "x", "y"]
