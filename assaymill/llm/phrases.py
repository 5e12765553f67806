"""Collocations: frequent phrases whose parts seldom occur apart, counted by tries of word ids.

A task counts paths of words in a trie whose upper levels are keyed by word id and whose
lower ends are hash containers of the remaining ids; a container that grows too large
bursts into a level of smaller ones. When the trie is full its largest subtrees leave it
whole, as sorted runs for each partition of prefixes, and the runs of all tasks are merged
there. A phrase counts as the prefix of all paths that begin with it.

A path begins with a word and goes on along pairs of words that may be frequent, as all
words and pairs within a frequent phrase are. A first pass counts hashes of words and pairs
to find these; tasks look them up in a filter of a fixed number of bits. A false hit costs
a row, no frequent phrase is missed, and what is counted are words, never hashes.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from assaymill.llm.common import written
from assaymill.operators.ordering import numbered

#: Separators of pieces become line feeds, capital letters small ones.
_BYTES = bytes(10 if b in b".,;:!?\n\x0b\x0c\r" else b + 32 if 65 <= b <= 90 else b for b in range(256))
LEAST, LONGEST, TOP = 30, 4, 2000
#: Entries of a container before it bursts, of a trie before subtrees leave it, words numbered before the numbers start anew.
BURST, ENTRIES, NUMBERED = 4096, 400_000, 200_000
#: Bits of the filter of frequent pairs, a power of two: 8 MB at any size of the input.
BITS = 1 << 26
#: Rows read at once, words worked on at once, hashes of pairs held before they are handed on.
ROWS, TOKENS, PAIRS = 128, 200_000, 3_000_000
#: Bytes of text to a bucket of hashes or of paths.
BUCKET = 1 << 24
END = -1


class Container(dict):
    """Remaining ids of a path -> count."""


class HatTrie:
    """Counts of paths of one length: levels keyed by id above, hash containers below."""

    def __init__(self, burst: int = BURST):
        self.root: dict = {}
        self.size = 0
        self.burst = burst

    def add(self, path: tuple, n: int) -> None:
        node, depth = self.root, 0
        while True:
            head = path[depth]
            child = node.get(head)
            depth += 1
            if child is None:
                child = node[head] = Container()
            if type(child) is Container:
                break
            node = child
        rest = path[depth:]
        if rest in child:
            child[rest] += n
            return
        child[rest] = n
        self.size += 1
        if len(child) > self.burst and len(rest) > 1:
            level: dict = {}
            for (first, *others), count in child.items():
                level.setdefault(first, Container())[tuple(others)] = count
            node[head] = level

    def subtrees(self):
        """(owner, key, prefix, subtree) of each first word, or of each language whose container has not burst."""
        for lang, child in self.root.items():
            if type(child) is Container:
                yield self.root, lang, (lang,), child
            else:
                for head, below in child.items():
                    yield child, head, (lang, head), below

    def spill(self, keep: int):
        """Take out the largest subtrees until at most ``keep`` entries are left: lists of (path, count)."""
        trees = sorted(((entries(t), owner, key, prefix, t) for owner, key, prefix, t in self.subtrees()), key=lambda t: -t[0])
        for size, owner, key, prefix, tree in trees:
            if self.size <= keep:
                return
            del owner[key]
            self.size -= size
            yield list(paths(tree, prefix))


def entries(tree: dict) -> int:
    return len(tree) if type(tree) is Container else sum(map(entries, tree.values()))


def paths(tree: dict, prefix: tuple):
    if type(tree) is Container:
        for rest, n in tree.items():
            yield prefix + rest, n
    else:
        for head, below in tree.items():
            yield from paths(below, (*prefix, head))


class Ids(dict):
    """Word -> id, with the words and their hashes by id."""

    def __init__(self):
        self.start()

    def start(self) -> None:
        """Begin anew without any word."""
        self.clear()
        self.words: list[bytes] = []
        self._new: list[int] = []
        self._hashes = np.empty(0, dtype=np.uint64)

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.words)
        self.words.append(word)
        self._new.append(xxhash.xxh64_intdigest(word))
        return number

    def hashes(self) -> np.ndarray:
        if self._new:
            self._hashes = np.concatenate([self._hashes, np.array(self._new, dtype=np.uint64)])
            self._new = []
        return self._hashes


def numbers(text: str, ids: Ids) -> list[int]:
    """Ids of the words of ``text``, with ``END`` behind each piece."""
    found: list[int] = []
    for piece in text.encode().translate(_BYTES).split(b"\n"):
        if piece:
            found.extend(map(ids.__getitem__, piece.split()))
            found.append(END)
    return found


def blocks(batches, ids: Ids):
    """(language, ids of the words) of about ``TOKENS`` words at once; texts stay whole.

    (None, None) says that no word waits and that ``ids`` hold many: they may start anew.
    """
    held: dict[str, list] = {}
    size: dict[str, int] = {}
    for batch in (b.slice(k, ROWS) for b in batches for k in range(0, b.num_rows, ROWS)):
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            codes = np.array(numbers(text, ids), dtype=np.int64)
            held.setdefault(lang, []).append(codes)
            size[lang] = size.get(lang, 0) + len(codes)
            if size[lang] > TOKENS:
                size[lang] = 0
                yield lang, np.concatenate(held.pop(lang))
        if len(ids) > NUMBERED:
            yield from ((lang, np.concatenate(parts)) for lang, parts in held.items())
            held, size = {}, {}
            yield None, None
    yield from ((lang, np.concatenate(parts)) for lang, parts in held.items())


def pair_hash(lang: str, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """64-bit hash of pairs of words, given by their hashes."""
    x = first * np.uint64(0x9E3779B97F4A7C15) + second * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(xxhash.xxh64_intdigest(lang.encode(), 1))
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def pairs_of(lang: str, codes: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of ``codes`` where a pair begins, and the hashes of the pairs."""
    here = np.flatnonzero((codes[:-1] >= 0) & (codes[1:] >= 0))
    return here, pair_hash(lang, hashes[codes[here]], hashes[codes[here + 1]])


def word_hash(lang: str, hashes: np.ndarray) -> np.ndarray:
    """64-bit hash of words, given by their hashes, apart from that of any pair."""
    return pair_hash(lang, hashes ^ np.uint64(0x5851F42D4C957F2D), np.zeros(1, dtype=np.uint64))


def slots(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two bits of a filter for each hash."""
    x = hashes * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0x9E3779B97F4A7C15)
    mask = np.uint64(bits - 1)
    return (x >> np.uint64(3)) & mask, (x >> np.uint64(37)) & mask


class Filter:
    """A set of hashes, shortened by ``shift`` bits, in a fixed number of bits, two for each."""

    def __init__(self, words: np.ndarray, shift: int):
        self.words, self.shift = words, shift

    def has(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), dtype=bool)
        for slot in slots(hashes >> np.uint64(self.shift), 64 * len(self.words)):
            found &= (self.words[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1
        return found


def packed_run(low: np.ndarray) -> bytes:
    """Rising numbers as their differences, byte planes one after the other, so that high bytes compress away."""
    return np.ascontiguousarray(np.diff(low, prepend=np.uint32(0)).view(np.uint8).reshape(-1, 4).T).tobytes()


def unpacked_run(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, dtype=np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint32).ravel(), dtype=np.uint32)


def frequent_filter(docs: DataFrame, size: int, least: int, bits: int = BITS) -> Filter:
    """Filter of the words and pairs whose hash occurs ``least`` times. The driver sees at most bits / 64 numbers.

    Hashes travel as sorted runs, one row per task and bucket of leading bits; buckets
    rise with the ``size`` of the text, so that one fits a task. Shortened hashes that
    coincide count together, which only lets more pairs through.
    """
    shift = 32 - max(8, (size // BUCKET).bit_length())

    def count(batches):
        ids, held, size = Ids(), [], 0

        def out():
            found, times = np.unique(np.concatenate(held) >> np.uint64(shift), return_counts=True)
            bucket, low, times = (found >> np.uint64(32)).astype(np.int64), found.astype(np.uint32), times.astype(np.uint32)
            edges = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(0, dtype=np.int64)
            spans = list(zip(edges, np.append(edges[1:], len(bucket))))
            return pa.RecordBatch.from_arrays(
                [pa.array(bucket[edges]), pa.array([packed_run(low[a:b]) for a, b in spans], pa.binary()), pa.array([times[a:b].tobytes() for a, b in spans], pa.binary())],
                ["bucket", "run", "times"],
            )

        for lang, codes in blocks(batches, ids):
            if lang is None:
                ids.start()
                continue
            hashes = ids.hashes()
            held += [pairs_of(lang, codes, hashes)[1], word_hash(lang, hashes[codes[codes >= 0]])]
            size += 2 * len(codes)
            if size > PAIRS:
                yield out()
                held, size = [], 0
        if held:
            yield out()

    def merge(key, frame):
        low = np.concatenate([unpacked_run(r) for r in frame["run"]])
        times = np.concatenate([np.frombuffer(t, dtype=np.uint32) for t in frame["times"]]).astype(np.int64)
        found, where = np.unique(low, return_inverse=True)
        often = found[np.bincount(where, weights=times, minlength=len(found)) >= least].astype(np.uint64)
        slot = np.concatenate(slots(often | np.uint64(int(key[0]) << 32), bits))
        return pd.DataFrame({"slot": (slot >> np.uint64(6)).astype(np.int64), "bit": (np.uint64(1) << (slot & np.uint64(63))).view(np.int64)})

    runs = docs.mapInArrow(count, "bucket bigint, run binary, times binary")
    marks = runs.groupBy("bucket").applyInPandas(merge, "slot bigint, bit bigint")
    found = marks.groupBy("slot").agg(F.bit_or("bit").alias("bit")).toPandas()
    words = np.zeros(bits // 64, dtype=np.uint64)
    words[found["slot"].to_numpy(dtype=np.int64)] = found["bit"].to_numpy(dtype=np.int64).view(np.uint64)
    return Filter(words, shift)


def chains(lang: str, codes: np.ndarray, hashes: np.ndarray, known: Filter) -> tuple[np.ndarray, ...]:
    """A path of ``LONGEST`` ids from each word that ``known`` has, along pairs that it has; ``END`` from where it stops."""
    here, pairs = pairs_of(lang, codes, hashes)
    good = np.zeros(len(codes) + LONGEST, dtype=bool)
    good[here[known.has(pairs)]] = True
    at = np.flatnonzero(codes >= 0)
    at = at[known.has(word_hash(lang, hashes[codes[at]]))]
    goes, columns = np.ones(len(at), dtype=bool), [codes[at]]
    for k in range(1, LONGEST):
        goes = goes & good[at + k - 1]
        column = np.full(len(at), END, dtype=np.int64)
        column[goes] = codes[at[goes] + k]
        columns.append(column)
    return tuple(columns)


def distinct_paths(columns: tuple[np.ndarray, ...]) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct rows and how often each occurs."""
    # Ids are below 2^31: two fit one number.
    packed = [(columns[k] << 32) + columns[k + 1] + 1 for k in range(0, LONGEST, 2)]
    order = np.lexsort(packed[::-1])
    new = np.ones(len(order), dtype=bool)
    new[1:] = np.any([p[order][1:] != p[order][:-1] for p in packed], axis=0)
    begin = np.flatnonzero(new)
    return [c[order[begin]] for c in columns], np.diff(np.append(begin, len(order)))


PACKED = "bucket bigint, lang string, words binary, codes binary, n binary"


def packed_paths(run: list[tuple], ids: Ids, buckets: int) -> pa.RecordBatch:
    """The paths of ``run`` as one sorted run for each language and prefix partition: its words, their places by path, counts.

    The partition goes by the first two words, so that all phrases that begin with a pair meet.
    """
    out = []
    place = {lang: [] for lang in dict.fromkeys(path[0] for path, _ in run)}
    for path, n in run:
        place[path[0]].append((*path[1:], n))
    rank = np.empty(len(ids.words) + 1, dtype=np.int64)
    order = sorted(range(len(ids.words)), key=ids.words.__getitem__)
    rank[order], rank[-1] = np.arange(1, len(order) + 1), 0
    for lang, paths_ in place.items():
        table = np.array(paths_, dtype=np.int64)
        codes, n = rank[table[:, :-1]], table[:, -1]
        hashes = np.append(ids.hashes(), np.uint64(0))
        bucket = (pair_hash(lang, hashes[table[:, 0]], hashes[table[:, 1]]) % np.uint64(buckets)).astype(np.int64)
        sort = np.lexsort((*codes.T[::-1], bucket))
        codes, n, bucket = codes[sort], n[sort], bucket[sort]
        edges = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        for a, b in zip(edges, np.append(edges[1:], len(bucket))):
            used, where = np.unique(codes[a:b], return_inverse=True)
            words = b"\n".join(ids.words[order[r - 1]] if r else b"" for r in used.tolist())
            column = np.ascontiguousarray(where.reshape(codes[a:b].shape).T, dtype=np.uint32).ravel()
            planes = np.ascontiguousarray(column.view(np.uint8).reshape(-1, 4).T)
            out.append((int(bucket[a]), lang, words, planes.tobytes(), n[a:b].tobytes()))
    columns = list(zip(*out)) or [()] * 5
    types = [pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["bucket", "lang", "words", "codes", "n"])


def counted_paths(docs: DataFrame, known, buckets: int) -> DataFrame:
    """Sorted runs of the paths of all tasks, see ``packed_paths``; ``known``: a broadcast filter.

    Rows of a bucket below zero have the number of all words of a language.
    """

    def count(batches):
        trie, ids, filtered = HatTrie(), Ids(), known.value
        # Words of paths keep their ids when the ids of all words start anew.
        kept, words = Ids(), {}

        def out(keep: int):
            run = [entry for subtree in trie.spill(keep) for entry in subtree]
            if run:
                yield packed_paths(run, kept, buckets)

        for lang, codes in blocks(batches, ids):
            if lang is None:
                ids.start()
                if len(kept) > NUMBERED:
                    yield from out(0)
                    kept.start()
                continue
            words[lang] = words.get(lang, 0) + int((codes >= 0).sum())
            if not len(codes):
                continue
            found, times = distinct_paths(chains(lang, codes, ids.hashes(), filtered))
            own = {END: END}
            for code in np.unique(np.concatenate(found)).tolist():
                if code >= 0:
                    own[code] = kept[ids.words[code]]
            for path, n in zip(zip(*(map(own.__getitem__, c.tolist()) for c in found)), times.tolist()):
                trie.add((lang, *path), n)
            if trie.size > ENTRIES:
                yield from out(ENTRIES // 2)
        yield from out(0)
        part = -1 - TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays(
            [pa.array([part] * len(words), pa.int64()), pa.array([*words], pa.string()), *[pa.array([b""] * len(words), pa.binary())] * 2,
             pa.array([np.array([n], dtype=np.int64).tobytes() for n in words.values()], pa.binary())],
            ["bucket", "lang", "words", "codes", "n"],
        )

    return docs.mapInArrow(count, PACKED)


def merged_paths(runs: DataFrame, least: int) -> DataFrame:
    """(lang, phrase, size, f) of the runs of each prefix partition: phrases of two words and more that reach ``least``.

    Size 1 has the part of each first word that lies in the partition, and size 0 the words of the language.
    """

    def merge(key, frame):
        names = ["lang", "phrase", "size", "f"]
        if key[0] < 0:
            counts = [int(np.frombuffer(n, dtype=np.int64)[0]) for n in frame["n"]]
            return pd.DataFrame({"lang": frame["lang"], "phrase": "", "size": 0, "f": counts})[names]
        found = []
        for lang, part in frame.groupby("lang", sort=False):
            ids, words, tables, counts = {b"": 0}, [b""], [], []
            for blob, codes, n in zip(part["words"], part["codes"], part["n"]):
                own = np.array([ids.setdefault(w, len(ids)) for w in blob.split(b"\n")], dtype=np.int64)
                planes = np.frombuffer(codes, dtype=np.uint8).reshape(4, -1)
                tables.append(own[np.ascontiguousarray(planes.T).view(np.uint32).reshape(LONGEST, -1)])
                counts.append(np.frombuffer(n, dtype=np.int64))
            words = [w.decode() for w in ids]
            table, n = np.concatenate(tables, axis=1), np.concatenate(counts)
            order = np.lexsort(table[::-1])
            table, n = table[:, order], n[order]
            change = np.zeros(table.shape[1], dtype=bool)
            change[:1] = True
            for size in range(1, LONGEST + 1):
                change[1:] |= table[size - 1, 1:] != table[size - 1, :-1]
                begin = np.flatnonzero(change)
                sums = np.add.reduceat(n, begin)
                use = (table[size - 1, begin] != 0) & ((sums >= least) | (size == 1))
                phrases_ = [" ".join(words[w] for w in column) for column in table[:size, begin[use]].T.tolist()]
                found.append(pd.DataFrame({"lang": lang, "phrase": phrases_, "size": size, "f": sums[use]}))
        return pd.concat(found)[names]

    return runs.groupBy("bucket").applyInPandas(merge, "lang string, phrase string, size int, f bigint")


def phrase_counts(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, f) of the phrases of 1 to ``LONGEST`` words found ``least`` times or more, and (lang, n)."""
    size = docs.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // BUCKET + 1)
    known = docs.sparkSession.sparkContext.broadcast(frequent_filter(docs, size, least))
    found = written(merged_paths(counted_paths(docs, known, buckets), least), "paths")
    known.unpersist()
    # A first word lies in a partition for each of its followers.
    single = found.filter("size = 1").groupBy("lang", "phrase", "size").agg(F.sum("f").alias("f")).filter(F.col("f") >= least)
    every = written(found.filter("size > 1").unionByName(single), "phrases")
    return every, found.filter("size = 0").groupBy("lang").agg(F.sum("f").alias("n"))


def inside(phrase: str) -> Column:
    """Phrases of two words or more that lie inside ``phrase``, itself left out."""
    w = F.split(phrase, " ")
    size = F.size(w)

    def parts(k: int) -> Column:
        every = F.transform(F.sequence(F.lit(1), size - k + 1), lambda i: F.array_join(F.slice(w, i, F.lit(k)), " "))
        return F.when(size > k, every).otherwise(F.array().cast("array<string>"))

    return F.concat(*[parts(k) for k in range(2, LONGEST)])


def scored(found: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score) of phrases of two words or more, by the cut of the lowest score."""
    w = F.split("phrase", " ")
    cuts = found.filter("size > 1").select("lang", "phrase", F.col("f").alias("a"), w.alias("w"), F.explode(F.expr("sequence(1, size - 1)")).alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice("w", F.col("k") + 1, F.size("w")), " ").alias("rest"),
    )
    first = found.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    rest = found.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    score = F.expr("(cast(2000000 as decimal(10, 0)) * cast(a as decimal(20, 0))) div cast(l + r as decimal(20, 0))")
    rated = cuts.join(first, ["lang", "first"]).join(rest, ["lang", "rest"]).withColumn("score", score)
    best = rated.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("_b"))
    return best.select("lang", "phrase", "_b.a", "_b.l", "_b.r", "_b.score")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of each language.

    A phrase has two to four words and occurs a >= ``least`` times; its score is
    floor(2000000 a / (l + r)) at the cut where that is lowest, l and r being how often
    the parts occur. A phrase inside a longer one that has at least 80 % of its
    occurrences is dropped. A null language is ``und``, a null text empty; rows that
    repeat a doc_id, or have none, count like any other; ties go by a, then by the bytes
    of the phrase. A piece between separators is held whole, whatever its length. An
    empty table gives no rows.
    """
    docs = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    found, words = phrase_counts(docs, least)
    longer = found.filter("size > 2").select("lang", F.explode(inside("phrase")).alias("phrase"), "f")
    longer = longer.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    kept = scored(found).join(longer, ["lang", "phrase"], "left").filter("longer is null or 100 * longer < 80 * a")
    ranked = numbered(kept.drop("longer"), ["lang"], [F.desc("score"), F.desc("a"), F.col("phrase")], "rank", "_all").filter(F.col("rank") <= top)
    return ranked.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
