"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingle containment."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHINGLE_WORDS = 5
CONTAINMENT = 0.8
#: Hash functions. A window has twice the length of its items' size class or less than four times theirs, so an item with containment 0.8 agrees with it in
#: each minimum with a chance of 0.2 or more; all 32 miss with a chance below 0.001.
FUNCTIONS = 32
#: Characters of items that are indexed at a time. More items take more passes over the documents, not more memory.
BLOCK_CHARS = 50_000_000
#: Words a worker remembers.
MEMORY = 400_000
_WORD = re.compile(r"\w+")
_FACTORS = np.random.default_rng(20240101).integers(1, 1 << 63, FUNCTIONS, np.uint64) * np.uint64(2) + np.uint64(1)
_SALTS = np.random.default_rng(20240102).integers(0, 1 << 63, FUNCTIONS, np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_FILTER_BITS = 22


def words_of(text: str | None) -> list[str]:
    """Lower-case words; punctuation and white space do not matter."""
    return _WORD.findall((text or "").lower())


def shingles(words: list[str], width: int) -> set[tuple[str, ...]]:
    return set(zip(*(words[i:] for i in range(width))))


class _Hashes(dict):
    """64-bit hashes of words, remembered; bounded."""

    def __missing__(self, word: str) -> int:
        import xxhash

        if len(self) >= MEMORY:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


def shingle_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    n = len(hashes) - width + 1
    if n <= 0:
        return np.array([], np.uint64)
    h = np.zeros(n, np.uint64)
    for i in range(width):
        h = h * _BASE + hashes[i : i + n]
    h = (h ^ (h >> np.uint64(32))) * _BASE
    return h ^ (h >> np.uint64(29))


def _halved(minima: np.ndarray) -> np.ndarray:
    if minima.shape[1] % 2:
        minima = np.concatenate([minima, np.full((minima.shape[0], 1), np.iinfo(np.uint64).max)], axis=1)
    return np.minimum(minima[:, ::2], minima[:, 1::2])


def signatures(hashes: np.ndarray, sizes: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    """(size, minima) for each size class: a column per window of two blocks of ``size`` shingles, half overlapping the next.

    Any ``size`` shingles in a row lie within one window.
    """
    minima, size = (hashes ^ _SALTS[:, None]) * _FACTORS[:, None], 1
    while True:
        if size in sizes:
            yield size, np.minimum(minima[:, :-1], minima[:, 1:]) if minima.shape[1] > 1 else minima
        if size >= max(sizes):
            return
        minima, size = _halved(minima), size * 2


@dataclass
class Index:
    """MinHash signatures of a block of items by shingle width and size class; bounded by the block."""

    ids: list
    words: list[list[str]]
    widths: list[int]
    keys: dict[tuple[int, int], tuple[np.ndarray, np.ndarray, np.ndarray]]  # (width, size): presence by low bits, sorted keys, their items

    @classmethod
    def of(cls, items: list[tuple[object, str | None]]) -> Index:
        rows = [(i, words_of(t)) for i, t in items]
        rows = [(i, w) for i, w in rows if w]
        hashes, gathered = _Hashes(), {}
        widths = [min(SHINGLE_WORDS, len(w)) for _, w in rows]
        for place, ((_, words), width) in enumerate(zip(rows, widths)):
            h = shingle_hashes(np.array([hashes[w] for w in words], np.uint64), width)
            size = 1 << (len(h) - 1).bit_length()
            minima = ((h ^ _SALTS[:, None]) * _FACTORS[:, None]).min(axis=1)
            gathered.setdefault((width, size), []).append((cls.mixed(minima), np.full(FUNCTIONS, place)))
        keys = {}
        for at, parts in gathered.items():
            key, place = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            order = np.argsort(key, kind="stable")
            present = np.zeros(1 << _FILTER_BITS, bool)
            present[key & np.uint64((1 << _FILTER_BITS) - 1)] = True
            keys[at] = (present, key[order], place[order])
        return cls([i for i, _ in rows], [w for _, w in rows], widths, keys)

    @staticmethod
    def mixed(minima: np.ndarray) -> np.ndarray:
        """Minima told apart by their function."""
        salt = np.arange(1, FUNCTIONS + 1, dtype=np.uint64) * _BASE
        return minima ^ (salt if minima.ndim == 1 else salt[:, None])

    def candidates(self, hashes: np.ndarray) -> list[int]:
        """Items that agree with some window of a document in at least one minimum; ``hashes`` are the document's word hashes."""
        found: set[int] = set()
        for width in {w for w, _ in self.keys}:
            h = shingle_hashes(hashes, width)
            if not len(h):
                continue
            for size, minima in signatures(h, [s for w, s in self.keys if w == width]):
                present, keys, places = self.keys[width, size]
                looked = self.mixed(minima).ravel()
                looked = np.unique(looked[present[looked & np.uint64((1 << _FILTER_BITS) - 1)]])
                first, last = np.searchsorted(keys, looked), np.searchsorted(keys, looked, side="right")
                for a, b in zip(first[first < last], last[first < last]):
                    found.update(places[a:b].tolist())
        return sorted(found)

    def matches(self, text: str | None, hashes: _Hashes, threshold: float) -> list[tuple[object, int, int]]:
        """(item, shared shingles, its shingles) of the items that the text contains, by exact comparison of shingles."""
        words = words_of(text)
        if not words:
            return []
        found, own = [], {}
        for place in self.candidates(np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))):
            width = self.widths[place]
            if width not in own:
                own[width] = shingles(words, width)
            item = shingles(self.words[place], width)
            shared = len(item & own[width])
            if shared >= threshold * len(item):
                found.append((self.ids[place], shared, len(item)))
        return found


def _blocks(items: DataFrame) -> Iterator[Index]:
    """The items in blocks of bounded text, each small enough for every task to hold."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    chars = rows.agg(F.sum(F.length("text"))).head()[0] or 0
    blocks = 1 + chars // BLOCK_CHARS
    for block in range(blocks):
        yield Index.of([(r[0], r[1]) for r in rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).distinct().collect()])


def contained_items(docs: DataFrame, items: DataFrame, threshold: float = CONTAINMENT) -> DataFrame:
    """(doc_id, item_id, shared, item_shingles, containment): the items whose shingles a document holds to ``threshold`` or more.

    Shingles are five words; an item with fewer words is one shingle. Containment is exact, over the whole document; what the search may
    miss, with a chance below 0.001, is an item spread over stretches far apart or one at the threshold. Null and empty texts contain nothing, an item without words
    is contained in nothing; each row of ``docs`` gives rows of its own, equal items count once; empty tables give no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("shared", pa.int64()), ("item_shingles", pa.int64()), ("containment", pa.float64())])

    def search(index: Index):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hashes = _Hashes()
            for batch in batches:
                out = [(d, i, s, n, s / n) for d, t in zip(*(c.to_pylist() for c in batch.columns)) for i, s, n in index.matches(t, hashes, threshold)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)] if out else [pa.array([], f.type) for f in schema], schema=schema)

        return rows.mapInArrow(run, "doc_id long, item_id long, shared long, item_shingles long, containment double")

    found = [search(index) for index in _blocks(items)]
    result = found[0]
    for more in found[1:]:
        result = result.unionByName(more)
    return result


def without_contaminated(docs: DataFrame, items: DataFrame, threshold: float = CONTAINMENT) -> DataFrame:
    """The rows of ``docs``, all columns kept, that contain no item; see ``contained_items``."""
    schema = docs.schema

    def keep(index: Index):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hashes = _Hashes()
            for batch in batches:
                texts = batch.column(batch.schema.get_field_index("text")).cast(pa.string()).to_pylist()
                yield batch.filter(pa.array([not index.matches(t, hashes, threshold) for t in texts], pa.bool_()))

        return run

    for index in _blocks(items):
        docs = docs.mapInArrow(keep(index), schema)
    return docs
