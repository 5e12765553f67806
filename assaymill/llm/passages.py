"""Quality scores by attention-based multiple-instance learning.

A text is a bag of passages and only the bag has a label. Every passage is encoded from
what its words look like and how they repeat; gated attention, learned with the encoder
from the labels of a bounded sample, weighs the passages, and the weighted mean of their
codes is scored. All passages of a text take part, however many there are.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from assaymill.llm.common import plain, written

#: Words of a passage; labelled documents and passages of them that the fit sees at most.
WORDS, LABELLED, PASSAGES = 64, 6000, 80_000
#: Buckets of word shapes, signed buckets of words.
SHAPES, LEXICAL = 64, 32
CODE, GATE = 32, 16
#: Weight decay, documents of a step, first step size; a fit ends when this many epochs in a row lower the best loss by less than ``TOLERANCE`` of itself.
DECAY, STEP, RATE, PATIENCE, TOLERANCE = 1e-4, 128, 3e-3, 6, 0.005
#: Rows worked on at once, words remembered, passages whose words are gathered at once, bytes split at once.
ROWS, KNOWN, GATHERED, SLICE = 64, 200_000, 4096, 1 << 20

_SYMBOLS = b"#*$%&|<>"
#: Bytes by class: capitals, letters, digits, first bytes of characters beyond ASCII; marks stay and later bytes are left out.
_CLASS = bytes(88 if 65 <= b <= 90 else 120 if 97 <= b <= 122 else 57 if 48 <= b <= 57 else 104 if b >= 192 else b for b in range(256))
_LATER = bytes(range(128, 192))
_RUN = re.compile(rb"(.)\1+", re.DOTALL)
#: Per word: characters, letters, capitals, digits, symbols, other ASCII marks, characters beyond ASCII.
LOOKS = 7
#: Per passage: words, longest and mean word, shares of the looks, distinct words, windows seen before in the text.
PLAIN = LOOKS + 4
WIDTH = PLAIN + SHAPES + LEXICAL


class Lexicon(dict):
    """Word -> number; ``table`` has the looks, the bucket of the shape, and bucket and sign of each word by number.

    A shape is the word with runs of capitals, letters, digits and equal marks as one character each.
    """

    def __init__(self):
        self._new: list[tuple] = []
        self._table = np.empty((1024, LOOKS + 3), dtype=np.float32)
        self._filled = 0

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        seen = word.translate(_CLASS, _LATER)
        capitals, digits, beyond = seen.count(b"X"), seen.count(b"9"), seen.count(b"h")
        letters = capitals + seen.count(b"x") + beyond
        symbols = len(seen) - len(seen.translate(None, _SYMBOLS))
        h = xxhash.xxh64_intdigest(word.lower())
        shape = xxhash.xxh64_intdigest(_RUN.sub(rb"\1", seen.replace(b"h", b"x"))) % SHAPES
        marks = len(seen) - letters - digits - symbols
        self._new.append((len(seen), letters, capitals, digits, symbols, marks, beyond, shape, h % LEXICAL, 1 if h >> 32 & 1 else -1))
        return number

    def table(self) -> np.ndarray:
        if self._new:
            need = self._filled + len(self._new)
            if need > len(self._table):
                larger = np.empty((2 * need, LOOKS + 3), dtype=np.float32)
                larger[: self._filled] = self._table[: self._filled]
                self._table = larger
            self._table[self._filled : need] = self._new
            self._filled, self._new = need, []
        return self._table


def numbers(text: str, lexicon: Lexicon) -> np.ndarray:
    """Numbers of the words of ``text``, which is split at ASCII white space, a slice at a time."""
    data = text.encode()
    parts, start = [], 0
    while start < len(data):
        end = data.find(b" ", start + SLICE) if len(data) - start > SLICE else -1
        end = len(data) if end < 0 else end
        parts.append(np.fromiter(map(lexicon.__getitem__, data[start:end].split()), dtype=np.int64))
        start = end
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)


def seen_before(codes: np.ndarray) -> np.ndarray:
    """For each word of a text: does the three-word window that begins there occur earlier?"""
    out = np.zeros(len(codes))
    if len(codes) > 3:
        c = codes.astype(np.uint64)
        window = c[:-2]
        for by in (1, 2):
            window = window * np.uint64(0x9E3779B97F4A7C15) + c[by : len(c) - 2 + by]
            window ^= window >> np.uint64(29)
        first = np.unique(window, return_index=True)[1]
        out[: len(window)] = 1
        out[first] = 0
    return out


def encode_passages(text: str, lexicon: Lexicon) -> np.ndarray:
    """One row of ``WIDTH`` numbers for each passage of ``text``; a text without words has one row of zeros."""
    codes = numbers(text, lexicon)
    if not len(codes):
        return np.zeros((1, WIDTH), dtype=np.float32)
    begins = np.arange(0, len(codes), WORDS)
    size = np.diff(np.append(begins, len(codes)))
    again = np.add.reduceat(seen_before(codes), begins) / size
    place = np.repeat(np.arange(len(begins)), size)
    pairs = np.unique((place << 32) + codes)
    distinct = np.bincount(pairs >> 32, minlength=len(begins)) / size
    out, table = np.empty((len(begins), WIDTH), dtype=np.float32), lexicon.table()
    for low in range(0, len(begins), GATHERED):
        high = min(low + GATHERED, len(begins))
        part = codes[begins[low] : begins[high - 1] + size[high - 1]]
        known = table[part]
        looks, buckets = known[:, :LOOKS], known[:, LOOKS:].astype(np.int64)
        heads, n = begins[low:high] - begins[low], size[low:high]
        sums = np.add.reduceat(looks, heads, axis=0)
        rows = place[: len(part)]
        block = out[low:high]
        block[:, 0] = np.log1p(n)
        block[:, 1] = np.log1p(np.maximum.reduceat(looks[:, 0], heads))
        block[:, 2] = np.log1p(sums[:, 0] / n)
        block[:, 3 : LOOKS + 2] = sums[:, 1:] / sums[:, :1]
        block[:, LOOKS + 2] = distinct[low:high]
        block[:, LOOKS + 3] = again[low:high]
        block[:, PLAIN : PLAIN + SHAPES] = np.bincount(rows * SHAPES + buckets[:, 0], minlength=(high - low) * SHAPES).reshape(-1, SHAPES) / n[:, None]
        signed = np.bincount(rows * LEXICAL + buckets[:, 1], weights=buckets[:, 2], minlength=(high - low) * LEXICAL)
        block[:, PLAIN + SHAPES :] = signed.reshape(-1, LEXICAL) / np.sqrt(n)[:, None]
    return out


def squash(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


class Attention:
    """Encoder, gated attention and scorer; ``fit`` learns all of them together from labels of whole bags."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, prior: float = 0.5, seed: int = 11):
        rng = np.random.default_rng(seed)
        draw = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape)
        self.mean, self.scale = mean, scale
        bias = float(np.log(prior / (1 - prior)))
        self.p = {
            "w": draw(WIDTH, CODE), "b": np.zeros(CODE), "v": draw(CODE, GATE), "vb": np.zeros(GATE), "u": draw(CODE, GATE), "ub": np.zeros(GATE),
            "a": draw(GATE), "c": 0.1 * draw(CODE), "cb": np.array([bias]),
        }

    def forward(self, x: np.ndarray, begins: np.ndarray) -> dict:
        """``x``: standardised passages, bag after bag; ``begins``: where bags begin."""
        p = self.p
        h = np.tanh(x @ p["w"] + p["b"])
        v, u = np.tanh(h @ p["v"] + p["vb"]), squash(h @ p["u"] + p["ub"])
        s = (v * u) @ p["a"]
        bag = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, len(x))))
        e = np.exp(s - np.maximum.reduceat(s, begins)[bag])
        weight = e / np.add.reduceat(e, begins)[bag]
        z = np.add.reduceat(weight[:, None] * h, begins, axis=0)
        return {"h": h, "v": v, "u": u, "weight": weight, "bag": bag, "z": z, "score": squash(z @ p["c"] + p["cb"])}

    def gradient(self, x: np.ndarray, begins: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
        """Mean log loss of the bags and its gradient."""
        p, f = self.p, self.forward(x, begins)
        h, v, u, weight, bag = f["h"], f["v"], f["u"], f["weight"], f["bag"]
        score = np.clip(f["score"], 1e-12, 1 - 1e-12)
        loss = float(-np.mean(y * np.log(score) + (1 - y) * np.log(1 - score)))
        d = (f["score"] - y) / len(y)
        dz = d[:, None] * p["c"]
        back = (dz[bag] * h).sum(axis=1)
        ds = weight * (back - np.add.reduceat(weight * back, begins)[bag])
        dv, du = ds[:, None] * p["a"] * u * (1 - v * v), ds[:, None] * p["a"] * v * u * (1 - u)
        dh = (weight[:, None] * dz[bag] + dv @ p["v"].T + du @ p["u"].T) * (1 - h * h)
        g = {
            "w": x.T @ dh, "b": dh.sum(axis=0), "v": h.T @ dv, "vb": dv.sum(axis=0), "u": h.T @ du, "ub": du.sum(axis=0),
            "a": (v * u).T @ ds, "c": f["z"].T @ d, "cb": np.array([d.sum()]),
        }
        return loss, g

    def standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def fit(self, x: np.ndarray, begins: np.ndarray, y: np.ndarray, seed: int = 12) -> None:
        """Adam steps over shuffled bags until epochs no longer lower the loss."""
        rng, x = np.random.default_rng(seed), self.standard(x)
        ends = np.append(begins[1:], len(x))
        first = {k: np.zeros_like(a) for k, a in self.p.items()}
        second = {k: np.zeros_like(a) for k, a in self.p.items()}
        best, idle, t = np.inf, 0, 0
        while idle < PATIENCE:
            losses = []
            order = rng.permutation(len(begins))
            for low in range(0, len(order), STEP):
                chosen = order[low : low + STEP]
                rows = np.concatenate([np.arange(begins[i], ends[i]) for i in chosen])
                sizes = ends[chosen] - begins[chosen]
                loss, g = self.gradient(x[rows], np.concatenate([[0], np.cumsum(sizes)[:-1]]), y[chosen])
                losses.append(loss * len(chosen))
                t += 1
                for k in self.p:
                    step = g[k] + (DECAY * self.p[k] if self.p[k].ndim > 1 or k == "c" else 0.0)
                    first[k] = 0.9 * first[k] + 0.1 * step
                    second[k] = 0.999 * second[k] + 0.001 * step * step
                    self.p[k] = self.p[k] - RATE * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)
            now = sum(losses) / len(order)
            idle = 0 if now < best * (1 - TOLERANCE) else idle + 1
            best = min(best, now)

    def score(self, bags: list[np.ndarray]) -> np.ndarray:
        begins = np.concatenate([[0], np.cumsum([len(b) for b in bags])[:-1]]).astype(np.int64)
        return self.forward(self.standard(np.concatenate(bags)), begins)["score"]


def held_out(doc_id):
    """Rows never learned from: crc32 of doc_id as text is 1 modulo 3. A null doc_id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, labelled: int, passages: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Passages, bag beginnings and labels of the labelled documents with the smallest hash of doc_id.

    Rows whose hash lies beyond the share that is wanted are left out where they are read,
    so what is sorted does not grow with the labels. Whole documents are taken as long as
    they hold at most ``passages`` passages together.
    """
    spark = docs.sparkSession
    marks = labels.filter("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("bigint").alias("_id"))
    marks = marks.agg((F.min("quality") == 1).cast("int").alias("label")).filter(~held_out(F.col("_id")))
    marks = marks.withColumn("lot", F.xxhash64("_id", F.lit(11)))
    share = min(1.0, (labelled + 6 * labelled**0.5) / max(marks.count(), 1))
    bound = int(-(1 << 63) + share * ((1 << 64) - 1)) if share < 1 else (1 << 63) - 1
    chosen = marks.filter(F.col("lot") <= bound).orderBy("lot", "_id").limit(labelled)
    known = docs.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("text", "label", "lot")

    def bags(batches):
        lexicon = Lexicon()
        for batch in batches:
            found = [encode_passages(t, lexicon) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("lot"), batch.column("label"), pa.array([len(x) for x in found], pa.int64()), pa.array([x.tobytes() for x in found], pa.binary())],
                ["lot", "label", "passages", "bag"],
            )

    sample = written(known.mapInArrow(bags, "lot bigint, label int, passages bigint, bag binary"), "bags")
    sizes = sample.groupBy("lot").agg(F.sum("passages").alias("passages")).orderBy("lot").toPandas()
    fits = sizes["lot"][sizes["passages"].cumsum() <= passages]
    found = sample.filter(F.col("lot") <= int(fits.iloc[-1])).orderBy("lot", F.xxhash64("bag")).toPandas() if len(fits) else sample.limit(0).toPandas()
    x = np.concatenate([np.zeros((0, WIDTH), dtype=np.float32), *[np.frombuffer(b, dtype=np.float32).reshape(-1, WIDTH) for b in found["bag"]]]).astype(np.float64)
    begins = np.concatenate([[0], found["passages"].cumsum().to_numpy()[:-1]]).astype(np.int64) if len(found) else np.zeros(0, dtype=np.int64)
    return x, begins, found["label"].to_numpy(dtype=np.float64)


def learn(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, passages: int = PASSAGES) -> Attention:
    """The model. Where the sample lacks one of the labels, every text gets the share of label 1, or 0.5 without any."""
    x, begins, y = labelled_sample(docs, labels, labelled, passages)
    prior = float((y.sum() + 0.5) / (len(y) + 1))
    if not 0 < y.sum() < len(y):
        model = Attention(np.zeros(WIDTH), np.ones(WIDTH), prior)
        model.p["c"][:] = 0.0
        return model
    model = Attention(x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3), prior)
    model.fit(x, begins, y)
    return model


def quality_scores(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, passages: int = PASSAGES) -> DataFrame:
    """doc_id, held_out, score, predicted, n_passages and top_weight for each row of ``docs``.

    ``labels``: doc_id and quality, 1 for good documents; a document marked both ways is
    poor, rows without a mark or a doc_id teach nothing. score is the probability of label
    1, predicted 1 from 0.5 on; top_weight is the largest attention weight of a passage.
    A null or empty text has one empty passage. Rows that repeat a doc_id are scored one
    by one, and texts whole, whatever their length. An empty table gives no rows.
    """
    docs = plain(docs)
    model = learn(docs, labels, labelled, passages)

    def judge(batches):
        lexicon = Lexicon()
        for batch in (b.slice(k, ROWS) for b in batches for k in range(0, b.num_rows, ROWS)):
            if len(lexicon) > KNOWN:
                lexicon = Lexicon()
            bags = [encode_passages(t, lexicon) for t in batch.column("text").to_pylist()]
            begins = np.concatenate([[0], np.cumsum([len(b) for b in bags])[:-1]]).astype(np.int64)
            found = model.forward(model.standard(np.concatenate(bags)), begins)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found["score"]), pa.array([len(b) for b in bags], pa.int64()), pa.array(np.maximum.reduceat(found["weight"], begins))],
                ["doc_id", "score", "n_passages", "top_weight"],
            )

    scored = docs.mapInArrow(judge, "doc_id bigint, score double, n_passages bigint, top_weight double")
    predicted = (F.col("score") >= 0.5).cast("int")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"), "n_passages", "top_weight")
