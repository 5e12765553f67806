"""Attention over passages: against plain loops, on held-out rows, and on awkward tables."""

from __future__ import annotations

import random
import re
import zlib

import numpy as np
import pytest

from assaymill.llm import passages
from tests.llm.test_corpus import CLASHING, SCHEMA, texts


def junk(draw: random.Random, words: list[str]) -> str:
    kind = draw.randrange(3)
    if kind == 0:
        return " ".join(draw.choice(words) + "&&&" for _ in range(150))
    if kind == 1:
        return " ".join(draw.choice(words).upper() + "!!" for _ in range(90))
    return " ".join([draw.choice(words)] * 120)


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(8)
    words = ["".join(draw.choice("abcdefghiklmnorstuvé") for _ in range(draw.randint(2, 9))) for _ in range(300)]
    found = [(i, t, lang) for i, t, lang in texts()]
    found += [(1000 + k, junk(draw, words), "en") for k in range(150)]
    found += [(2000 + k, " ".join(draw.choice(words) for _ in range(draw.randint(40, 300))), "fr") for k in range(450)]
    return found


@pytest.fixture(scope="module")
def docs(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "d")
    spark.createDataFrame([(i, t, lang, "s", 0, *["x"] * len(CLASHING)) for i, t, lang in rows], SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def labels(spark, rows):
    marks = [(i, 0 if i < 2000 else 1, 0) for i, _, _ in rows if i is not None and i >= 1000]
    return spark.createDataFrame([*marks, marks[0], (None, 1, 0), (3, None, None), (2001, 1, None)], "doc_id bigint, quality int, toxic int")


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 3 == 1


def test_scores(docs, labels, rows):
    found = passages.quality_scores(docs, labels).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in found) == sorted((i is None, i or 0) for i, _, _ in rows)
    right = []
    sizes = {}
    for i, t, _ in rows:
        sizes.setdefault(i, set()).add(max(1, -(-len(re.findall("[^ \t\n\v\f\r]+", t or "")) // passages.WORDS)))
    for r in found:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) and r["held_out"] == held(r["doc_id"])
        assert r["n_passages"] in sizes[r["doc_id"]] and 0 < r["top_weight"] <= 1 + 1e-9
        if r["held_out"] and r["doc_id"] >= 1000:
            right.append(r["predicted"] == int(r["doc_id"] >= 2000))
    assert len(right) > 100 and np.mean(right) > 0.97


def test_labels_of_held_out_rows_teach_nothing(spark, docs, labels, rows):
    other = labels.collect()
    turned = spark.createDataFrame([(i, 1 - q if held(i) and q is not None else q, x) for i, q, x in other], labels.schema)
    one = passages.learn(passages.plain(docs), labels)
    two = passages.learn(passages.plain(docs), turned)
    assert all(np.array_equal(one.p[k], two.p[k]) for k in one.p)


def test_bounds_of_the_sample(docs, labels):
    x, begins, y = passages.labelled_sample(passages.plain(docs), labels, 50, 10_000)
    assert 40 < len(y) == len(begins) <= 50
    x, begins, y = passages.labelled_sample(passages.plain(docs), labels, 500, 60)
    assert len(x) <= 60 and len(y) > 5


def test_without_labels_of_both_kinds(spark, docs, labels):
    nothing = labels.limit(0)
    assert {r["score"] for r in passages.quality_scores(docs, nothing).collect()} == {0.5}
    good = labels.filter("quality = 1")
    scores = {r["score"] for r in passages.quality_scores(docs, good).collect()}
    assert all(s > 0.5 for s in scores)
    assert passages.quality_scores(spark.createDataFrame([], SCHEMA), labels).collect() == []


def plain_passage(words: list[bytes], earlier: set) -> list[float]:
    """The plain numbers of one passage, word by word."""
    decoded = [w.decode() for w in words]
    n, chars = len(decoded), sum(map(len, decoded))
    symbol = lambda c: c in "#*$%&|<>"
    letter = lambda c: c.isascii() and c.isalpha() or c > "\x7f"
    shares = [sum(map(f, c)) for f, c in (
        (letter, "".join(decoded)), (lambda c: "A" <= c <= "Z", "".join(decoded)), (lambda c: "0" <= c <= "9", "".join(decoded)),
        (symbol, "".join(decoded)), (lambda c: c <= "\x7f" and not c.isalnum() and not symbol(c), "".join(decoded)), (lambda c: c > "\x7f", "".join(decoded)),
    )]
    return [np.log1p(n), np.log1p(max(map(len, decoded))), np.log1p(chars / n), *(s / chars for s in shares), len(set(words)) / n]


@pytest.mark.parametrize("gathered, slice_", [(4096, 1 << 20), (2, 64)])
def test_passages_against_loops(monkeypatch, gathered, slice_):
    monkeypatch.setattr(passages, "GATHERED", gathered)
    monkeypatch.setattr(passages, "SLICE", slice_)
    for text in [t for _, t, _ in texts() if t][:60]:
        words = text.encode().split()
        got = passages.encode_passages(text, passages.Lexicon())
        assert got.shape == (max(1, -(-len(words) // passages.WORDS)), passages.WIDTH)
        if not words:
            assert not got.any()
            continue
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 3 else []
        again = [w in set(windows[:i]) for i, w in enumerate(windows)] if len(windows) < 3000 else None
        for k in range(len(got)):
            part = words[k * passages.WORDS : (k + 1) * passages.WORDS]
            assert np.allclose(got[k, : passages.PLAIN - 1], plain_passage(part, set()), atol=1e-5)
            if again is not None:
                expected = sum(again[k * passages.WORDS : (k + 1) * passages.WORDS]) / len(part)
                assert abs(got[k, passages.PLAIN - 1] - expected) < 1e-5
            assert abs(got[k, passages.PLAIN : passages.PLAIN + passages.SHAPES].sum() - 1) < 1e-4


def model(seed=1):
    rng = np.random.default_rng(seed)
    found = passages.Attention(rng.normal(size=passages.WIDTH), 1 + rng.random(passages.WIDTH), 0.7)
    return found, rng


def test_gradient():
    m, rng = model()
    x, begins, y = rng.normal(size=(20, passages.WIDTH)), np.array([0, 1, 9, 12]), np.array([1.0, 0, 1, 0])
    _, g = m.gradient(x, begins, y)
    for name, a in m.p.items():
        for at in [np.unravel_index(k, a.shape) for k in rng.choice(a.size, min(3, a.size), replace=False)]:
            old = a[at]
            a[at] = old + 1e-5
            high, _ = m.gradient(x, begins, y)
            a[at] = old - 1e-5
            low, _ = m.gradient(x, begins, y)
            a[at] = old
            assert abs((high - low) / 2e-5 - g[name][at]) < 1e-6


def test_attention_against_loops():
    m, rng = model(2)
    bags = [rng.normal(size=(n, passages.WIDTH)) for n in (1, 5, 3)]
    p = m.p
    expected = []
    for bag in bags:
        h = [np.tanh(row @ p["w"] + p["b"]) for row in m.standard(bag)]
        s = [float((np.tanh(c @ p["v"] + p["vb"]) / (1 + np.exp(-(c @ p["u"] + p["ub"])))) @ p["a"]) for c in h]
        w = np.exp(s) / np.exp(s).sum()
        z = sum(a * c for a, c in zip(w, h))
        expected.append(1 / (1 + np.exp(-(z @ p["c"] + p["cb"][0]))))
    assert np.allclose(m.score(bags), expected)
    assert np.allclose(m.score([b[::-1] for b in bags]), expected)
