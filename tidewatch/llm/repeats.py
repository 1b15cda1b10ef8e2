"""Repeated byte strings: shard Burrows-Wheeler transforms merged by interleave refinement, inside content buckets.

Every window of ``length`` bytes has an anchor, the least of its grams by hash; equal windows have equal anchors at equal places. Windows that share an
anchor in a row form a segment. Only segments whose anchor occurs in several documents travel, dealt by anchor, so all copies
of a window meet in one bucket. There the distinct segments that share an anchor with another one are indexed: shards of them are suffix-sorted into
Burrows-Wheeler transforms, which interleave refinement merges to a depth of ``length``; its blocks are the repeated intervals.

Work is dealt by batches of documents, and a batch sends an anchor or a segment once however often it holds it, so
a passage that a third of all documents share costs a bucket one entry a batch. At the passage's edges each document has a segment with a context
of its own. An anchor with more than ``HOT`` different segments is cut up: its windows travel one by one, dealt by their content, so
that no bucket gets all of them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import shuffle_partitions, staged

LENGTH = 50
GRAM = 24
#: Positions hashed at a time, so that the arrays stay in a core's cache.
STRETCH = 1 << 15
#: Suffixes that are sorted together into one shard's transform.
SHARD = 1 << 18
#: Segments of an anchor beyond which its windows are dealt by their own content.
HOT = 1 << 15
#: Strings of a bucket that are looked at together, and window hashes of a large group that are sorted at a time.
CHUNK, SORTED = 1 << 15, 1 << 20
#: Strings made at a time, and how often a batch has an anchor before its different segments are counted.
ROWS, OFTEN = 1 << 13, 8
NO_ID = np.iinfo(np.int64).max
_HIGH = np.uint64(0xFFFFFFFF00000000)
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


# --- transforms ---------------------------------------------------------------------------------------------


@dataclass
class Transform:
    """Transform of sorted, distinct strings: the symbol before each suffix in suffix order, 0 at a string's start.

    Symbols are bytes plus one (UTF-8 has no byte 255); 0 also ends each string. ``string`` and ``at`` name the suffixes.
    """

    symbols: np.ndarray
    string: np.ndarray
    at: np.ndarray


def transform(strings: np.ndarray, first: int = 0) -> Transform:
    """Suffix-sort one shard of sorted distinct strings (an 'S' array of symbols, numbered from ``first``).

    Equal suffixes keep the order of their strings, which is that of whole strings, as merging needs it.
    """
    width = strings.dtype.itemsize
    lengths = np.char.str_len(strings)
    padded = np.zeros((len(strings), 2 * width + 2), np.uint8)
    padded[:, 1 : width + 1] = strings.view(np.uint8).reshape(-1, width)
    string = np.repeat(np.arange(len(strings)), lengths + 1)
    at = np.arange(len(string)) - np.repeat(np.cumsum(lengths + 1) - lengths - 1, lengths + 1)
    rows = np.lib.stride_tricks.sliding_window_view(padded, width + 1, axis=1)[string, at + 1]
    order = np.argsort(np.ascontiguousarray(rows).view(f"S{width + 1}").ravel(), kind="stable")
    return Transform(padded[string, at][order], string[order] + first, at[order])


def merge(shards: list[Transform], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merge transforms by interleave refinement to ``depth`` symbols: (row, block, common) in merged order.

    The interleave says for every merged place which shard the next suffix comes from. One round reads the shards' symbols through it and sorts it
    stably by them: an interleave by one symbol more. Blocks are runs of suffixes that agree so far;
    ``common`` holds, where a block begins, the length of its prefix in common with the suffix before (``depth`` inside a block: at least that).
    ``row`` indexes the shards' suffixes laid end to end. No suffix is compared with another one.
    """
    symbols = np.concatenate([s.symbols for s in shards])
    source = np.repeat(np.arange(len(shards), dtype=np.uint8 if len(shards) < 256 else np.uint16 if len(shards) < 65536 else np.uint32), [len(s.symbols) for s in shards])
    starts = np.zeros(len(source), bool)
    common = np.full(len(source), depth, np.int32)
    if len(source):
        starts[0], common[0] = True, 0
    block = np.zeros(len(source), np.int32)
    for done in range(depth):
        read = np.empty_like(symbols)
        read[np.argsort(source, kind="stable")] = symbols
        turn = np.argsort(read, kind="stable")
        read, source, block = read[turn], source[turn], block[turn]
        new = np.empty(len(source), bool)
        new[:1] = True
        new[1:] = (read[1:] != read[:-1]) | (block[1:] != block[:-1])
        common[new & ~starts] = done
        starts = new
        block = np.cumsum(new, dtype=np.int32)
    return np.argsort(np.argsort(source, kind="stable"), kind="stable"), block, common


def _window_counts(strings: np.ndarray, length: int) -> np.ndarray:
    return np.maximum(0, np.char.str_len(strings) - length + 1)


def _by_string(values: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    return np.split(values, np.cumsum(counts)[:-1])


def interval_minima(strings: np.ndarray, values: np.ndarray, length: int) -> list[np.ndarray]:
    """For every window of ``length`` symbols of the sorted distinct strings: the least value of a string that has it."""
    return _by_string(_interval_minima(strings, values, length), _window_counts(strings, length))


def _interval_minima(strings: np.ndarray, values: np.ndarray, length: int) -> np.ndarray:
    """``interval_minima`` of all strings in a row."""
    lengths = np.char.str_len(strings)
    cuts = np.flatnonzero(np.diff((np.cumsum(lengths + 1) - 1) // SHARD)) + 1
    bounds = [0, *cuts.tolist(), len(strings)]
    shards = [transform(strings[a:b], a) for a, b in zip(bounds, bounds[1:]) if b > a]
    row, block, _ = merge(shards, length)
    string, at = (np.concatenate([getattr(s, name) for s in shards])[row] for name in ("string", "at"))
    whole = at + length <= lengths[string]
    string, at, block = string[whole], at[whole], block[whole]
    begins = np.flatnonzero(np.diff(block, prepend=-1))
    least = np.repeat(np.minimum.reduceat(values[string], begins), np.diff([*begins, len(block)])) if len(block) else np.array([], np.int64)
    return least[np.lexsort((at, string))]


def _window_hashes(strings: np.ndarray, length: int) -> np.ndarray:
    """The hashes of all windows of ``length`` symbols, string by string."""
    width = strings.dtype.itemsize
    symbols, counts, found = strings.view(np.uint8).reshape(-1, width), _window_counts(strings, length), []
    for a in range(0, len(strings), ROWS):
        some = symbols[a : a + ROWS]
        h = np.zeros((len(some), width - length + 1), np.uint64)
        for i in range(length):
            h *= _MULTIPLIER
            h += some[:, i : i + width - length + 1]
        found.append(_mixed(h[np.arange(width - length + 1) < counts[a : a + ROWS, None]]))
    return np.concatenate(found) if found else np.array([], np.uint64)


def _in_several(string: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which windows have a hash that windows of several strings have; ``SORTED`` of them or so are sorted at a time."""
    several, passes = np.zeros(len(hashes), bool), -(-len(hashes) // SORTED)
    for p in range(passes):
        where = np.flatnonzero(hashes % np.uint64(passes) == p) if passes > 1 else np.arange(len(hashes))
        if not len(where):
            continue
        order = where[np.argsort(hashes[where], kind="stable")]
        ranked, owner = hashes[order], string[order]
        begins = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
        mixed = np.minimum.reduceat(owner, begins) != np.maximum.reduceat(owner, begins)
        several[order] = np.repeat(mixed, np.diff([*begins, len(order)]))
    return several


def window_minima(strings: np.ndarray, values: np.ndarray, length: int, rounds: int = 2) -> list[np.ndarray]:
    """As ``interval_minima``, after cutting down the strings to the stretch that may repeat in another one.

    A window whose hash no other string has keeps its string's value. What is left of the strings may coincide; it is
    folded and looked at once more. Only then the transforms decide, by symbols.
    """
    return _by_string(_window_minima(strings, values, length, rounds), _window_counts(strings, length))


def _window_minima(strings: np.ndarray, values: np.ndarray, length: int, rounds: int = 2) -> np.ndarray:
    """``window_minima`` of all strings in a row."""
    counts = _window_counts(strings, length)
    offset = np.cumsum(counts) - counts
    string = np.repeat(np.arange(len(strings), dtype=np.uint32), counts)
    where = np.flatnonzero(_in_several(string, _window_hashes(strings, length)))
    low = np.repeat(values, counts)
    if len(where):
        owners, first = np.unique(string[where], return_index=True)
        last = where[np.append(first[1:], len(where)) - 1]
        begin, end = where[first] - offset[owners], last - offset[owners] + length
        width = strings.dtype.itemsize
        symbols, cut = strings.view(np.uint8).reshape(-1, width), np.zeros((len(owners), width), np.uint8)
        for a in range(0, len(owners), ROWS):
            some = slice(a, a + ROWS)
            places = np.minimum(begin[some, None] + np.arange(width), width - 1)
            cut[some] = np.where(np.arange(width) < (end - begin)[some, None], np.take_along_axis(symbols[owners[some]], places, axis=1), np.uint8(0))
        folded, inverse = np.unique(cut.view(f"S{width}").ravel(), return_inverse=True)
        least = np.full(len(folded), NO_ID)
        np.minimum.at(least, inverse, values[owners])
        again = rounds > 1 and len(folded) < len(strings)
        found = _window_minima(folded, least, length, rounds - 1) if again else _interval_minima(folded, least, length)
        many = end - begin - length + 1
        starts = np.cumsum(_window_counts(folded, length)) - _window_counts(folded, length)
        step = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        low[np.repeat(offset[owners] + begin, many) + step] = found[np.repeat(starts[inverse], many) + step]
    return low


# --- anchors and segments -----------------------------------------------------------------------------------


def _slide(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values."""
    out, have = values, 1
    while 2 * have <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return np.minimum(out[: len(out) - (width - have)], out[width - have :]) if width > have else out


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MULTIPLIER
    return h ^ (h >> np.uint64(29))


def _power(exponent: int) -> np.uint64:
    return np.uint64(pow(int(_MULTIPLIER), exponent, 1 << 64))


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Polynomial hashes of all runs of GRAM bytes, put together from those of runs whose lengths are powers of two."""
    level, size, out, have = data.astype(np.uint64) + np.uint64(1), 1, None, 0
    while size <= GRAM:
        if GRAM & size:
            # The run so far follows this one.
            n = len(data) - have - size + 1
            out = level[:n] if out is None else level[:n] * _power(have) + out[size : size + n]
            have += size
        level = level[:-size] * _power(size) + level[size:]
        size *= 2
    return _mixed(out)


def _anchors(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, anchor, its hash) wherever the anchor changes from one window to the next."""
    windows, span = len(data) - length + 1, length - GRAM + 1
    found, before = [], -1
    for at in range(0, windows, STRETCH):
        hashes = _gram_hashes(data[at : at + STRETCH + length - 1])
        packed = (hashes & _HIGH) | np.arange(len(hashes), dtype=np.uint64)
        anchor = (_slide(packed, span) & ~_HIGH).astype(np.int64)
        change = np.flatnonzero(np.diff(anchor, prepend=before))
        found.append((change + at, anchor[change] + at, hashes[anchor[change]]))
        before = int(anchor[-1]) - len(anchor)
    return tuple(np.concatenate(x) for x in zip(*found))


@dataclass
class Batch:
    """Documents of one batch laid end to end, and the segments of their windows."""

    ids: np.ndarray
    data: np.ndarray
    bounds: np.ndarray
    doc: np.ndarray  # of each segment
    first: np.ndarray  # start of its first window
    last: np.ndarray  # start of its last one
    bucket: np.ndarray
    key: np.ndarray

    @classmethod
    def of(cls, table: pa.Table, buckets: int, length: int) -> Batch:
        rows = sorted(zip(table.column("doc_id").to_pylist(), table.column("body").to_pylist()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        ids = np.array([NO_ID if i is None else i for i, _ in rows], np.int64)
        sizes = np.array([len(b) for _, b in rows], np.int64)
        bounds = np.concatenate(([0], np.cumsum(sizes)))
        data = np.frombuffer(b"".join(b for _, b in rows), np.uint8)
        none = np.array([], np.int64)
        if len(data) < length:
            return cls(ids, data, bounds, none, none, none, none, none.astype(np.uint32))
        begin, anchor, hashes = _anchors(data, length)
        end = np.append(begin[1:], len(data) - length + 1) - 1
        # All windows of a document that have this anchor lie in the document that holds it.
        doc = np.searchsorted(bounds, anchor, side="right") - 1
        first, last = np.maximum(begin, bounds[doc]), np.minimum(end, bounds[doc + 1] - length)
        whole = np.flatnonzero(first <= last)
        key = hashes[whole]
        return cls(ids, data, bounds, doc[whole], first[whole], last[whole], (key % np.uint64(buckets)).astype(np.int64), (key // np.uint64(buckets)).astype(np.uint32))

    def shared(self, known: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
        """Segments by bucket whose key is among the bucket's known ones."""
        order = np.argsort(self.bucket, kind="stable")
        edges = np.flatnonzero(np.diff(self.bucket[order], prepend=-1))
        out = {}
        for part in np.split(order, edges[1:]) if len(order) else []:
            keys = known.get(int(self.bucket[part[0]]))
            if keys is not None:
                part = part[np.isin(self.key[part], keys)]
                if len(part):
                    out[int(self.bucket[part[0]])] = part
        return out

    def travelling(self, replies: pa.Table, buckets: int, length: int) -> tuple[Batch, dict[int, np.ndarray]]:
        """Segments by bucket that other documents may share windows of, those with a hot key as single windows."""
        known, hot = self.shared(_known(replies, SHARED)), self.shared(_known(replies, CUT))
        if not hot:
            return self, known
        whole = np.concatenate(list(hot.values()))
        many = self.last[whole] - self.first[whole] + 1
        at = np.repeat(self.first[whole], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        # Equal windows of a batch travel once; each keeps a hash of its own content as its key.
        hashes = np.zeros(len(at), np.uint64)
        for i in range(length):
            hashes *= _MULTIPLIER
            hashes += self.data[at + i]
        hashes = _mixed(hashes)
        bucket, key = (hashes % np.uint64(buckets)).astype(np.int64), (hashes // np.uint64(buckets)).astype(np.uint32)
        number = len(self.doc) + np.argsort(bucket, kind="stable")
        batch = Batch(self.ids, self.data, self.bounds, *(np.concatenate(x) for x in ((self.doc, np.repeat(self.doc[whole], many)), (self.first, at), (self.last, at), (self.bucket, bucket), (self.key, key))))
        for part in np.split(number, np.flatnonzero(np.diff(batch.bucket[number])) + 1):
            b = int(batch.bucket[part[0]])
            known[b] = np.concatenate((known[b], part)) if b in known else part
        return batch, known

    def strings(self, part: np.ndarray, length: int) -> np.ndarray:
        """The segments' bytes plus one, as an 'S' array."""
        width = 2 * length - GRAM
        symbols = np.zeros((len(part), width), np.uint8)
        for a in range(0, len(part), ROWS):
            some = part[a : a + ROWS]
            at = self.first[some][:, None] + np.arange(width)
            inside = np.arange(width) < (self.last[some] - self.first[some] + length)[:, None]
            symbols[a : a + ROWS] = np.where(inside, self.data[np.minimum(at, len(self.data) - 1)] + np.uint8(1), np.uint8(0))
        return symbols.view(f"S{width}").ravel()


# --- exchanges: a message is (batch, bucket, kind, payload) ----------------------------------------------------

MESSAGE = "batch long, bucket long, kind int, payload binary"
_SCHEMA = pa.schema([("batch", pa.int64()), ("bucket", pa.int64()), ("kind", pa.int32()), ("payload", pa.binary())])
SHARED, MINIMA, CUT = 1, 2, 3


def _pack(*arrays: np.ndarray) -> bytes:
    head = np.array([len(arrays), *(a.nbytes for a in arrays)], np.int64).tobytes()
    return head + b"".join(a.tobytes() for a in arrays)


def _unpack(payload: bytes, *dtypes: str) -> list[np.ndarray]:
    sizes = np.frombuffer(payload, np.int64, len(dtypes), 8)
    at, out = 8 * (len(dtypes) + 1), []
    for dtype, size in zip(dtypes, sizes.tolist()):
        out.append(np.frombuffer(payload, dtype, size // np.dtype(dtype).itemsize, at) if size else np.array([], dtype))
        at += size
    return out


def _messages(rows: list[tuple[int, int, int, bytes]]) -> pa.Table:
    return pa.Table.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), _SCHEMA)] if rows else [pa.array([], t.type) for t in _SCHEMA], schema=_SCHEMA)


def _announce(buckets: int, length: int) -> Callable[[pa.Table], pa.Table]:
    """A batch's anchors: by bucket the different keys, each with a byte: its highest bit says that several documents have it, the others how many segments do (``_counted``)."""

    def run(table: pa.Table) -> pa.Table:
        batch, number = Batch.of(table, buckets, length), table.column("batch")[0].as_py()
        order = np.lexsort((batch.doc, batch.key, batch.bucket))
        bucket, key, ids = batch.bucket[order], batch.key[order], batch.ids[batch.doc[order]] if len(order) else np.array([], np.int64)
        new = np.ones(len(order), bool)
        new[1:] = (bucket[1:] != bucket[:-1]) | (key[1:] != key[:-1])
        begins = np.flatnonzero(new)
        several = np.minimum.reduceat(ids, begins) != np.maximum.reduceat(ids, begins) if len(begins) else np.array([], bool)
        many = np.diff([*begins, len(order)])
        often = np.flatnonzero(np.repeat(many >= OFTEN, many))
        if len(often):
            # A segment's bytes say its key.
            _, index = np.unique(batch.strings(order[often], length), return_index=True)
            different = np.bincount(np.repeat(np.arange(len(many)), many)[often[index]], minlength=len(many))
            many = np.where(different, different, many)
        marks = (np.minimum(np.ceil(8 * np.log2(many)), 127).astype(np.uint8) | several.astype(np.uint8) << 7) if len(begins) else np.array([], np.uint8)
        edges = np.flatnonzero(np.diff(bucket[begins], prepend=-1))
        return _messages([
            (number, int(bucket[begins[a]]), 0, _pack(key[begins[a:b]], marks[a:b])) for a, b in zip(edges, [*edges[1:], len(begins)])
        ])

    return run


def _counted(marks: np.ndarray) -> np.ndarray:
    """How many segments the marks of ``_announce`` stand for: powers of two in steps of an eighth, rounded up."""
    return np.exp2((marks & np.uint8(127)) / 8)


def _find_shared(hot: int) -> Callable[[pa.Table], pa.Table]:
    """A bucket's keys that several documents have, to every batch that announced them; those with more than ``hot`` segments are to be cut up."""

    def find_shared(table: pa.Table) -> pa.Table:
        got = [(b, *_unpack(p, "u4", "u1")) for b, p in zip(table.column("batch").to_pylist(), table.column("payload").to_pylist())]
        keys = np.concatenate([k for _, k, _ in got])
        order = np.argsort(keys, kind="stable")
        ranked, marks = keys[order], np.concatenate([m for _, _, m in got])[order]
        begins = np.flatnonzero(np.diff(ranked.astype(np.int64), prepend=-1))
        several = (np.diff([*begins, len(ranked)]) > 1) | np.logical_or.reduceat(marks >= 128, begins)
        cut = np.add.reduceat(_counted(marks), begins) > hot
        bucket, rows = table.column("bucket")[0].as_py(), []
        for kind, wanted in ((SHARED, ranked[begins[several & ~cut]]), (CUT, ranked[begins[several & cut]])):
            replies = ((b, k[np.isin(k, wanted, assume_unique=True)]) for b, k, _ in got if len(wanted))
            rows += [(b, bucket, kind, _pack(k)) for b, k in replies if len(k)]
        return _messages(rows)

    return find_shared


def _known(table: pa.Table, kind: int) -> dict[int, np.ndarray]:
    return {b: _unpack(p, "u4")[0] for b, k, p in zip(*(table.column(c).to_pylist() for c in ("bucket", "kind", "payload"))) if k == kind}


def _send_segments(buckets: int, length: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """A batch's different segments, or single windows of them, with a shared anchor: strings, their keys, least ids, and whether several documents have them."""

    def run(docs: pa.Table, replies: pa.Table) -> pa.Table:
        if not docs.num_rows or not replies.num_rows:
            return _messages([])
        (batch, parts), rows = Batch.of(docs, buckets, length).travelling(replies, buckets, length), []
        for bucket, part in parts.items():
            strings, index, inverse = np.unique(batch.strings(part, length), return_index=True, return_inverse=True)
            ids = batch.ids[batch.doc[part]]
            least, most = np.full(len(strings), NO_ID), np.full(len(strings), np.iinfo(np.int64).min)
            np.minimum.at(least, inverse, ids)
            np.maximum.at(most, inverse, ids)
            sizes = np.char.str_len(strings).astype("<u4")
            text = np.frombuffer(b"".join(strings.tolist()), np.uint8)
            rows.append((docs.column("batch")[0].as_py(), bucket, 0, _pack(sizes, text, batch.key[part][index], least, most != least)))
        return _messages(rows)

    return run


def _runs(strings: np.ndarray, value: np.ndarray, keys: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(string, begin, end, least): runs of windows of the sorted distinct strings whose least value is the same, ordered by string.

    A string that is the only one with its key has none; it is its own repeated interval, and its value holds throughout. The others go through the
    transforms, keys whole and about ``CHUNK`` strings at a time.
    """
    order = np.argsort(keys, kind="stable")
    begins = np.flatnonzero(np.diff(keys[order].astype(np.int64), prepend=-1))
    members = np.diff([*begins, len(order)])
    mixed, members = order[np.repeat(members > 1, members)], members[members > 1]
    ends, runs, done = np.cumsum(members), [], 0
    while done < len(mixed):
        until = int(ends[max(np.searchsorted(ends, done + CHUNK, side="right") - 1, np.searchsorted(ends, done, side="right"))])
        some = np.sort(mixed[done:until])
        done = until
        low = _window_minima(strings[some], value[some], length)
        counts = _window_counts(strings[some], length)
        offset, owner = np.cumsum(counts) - counts, np.repeat(np.arange(len(some)), counts)
        new = np.diff(low, prepend=-1) != 0
        new[offset] = True
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], len(low))
        runs.append((some[owner[begin]], begin - offset[owner[begin]], end - offset[owner[begin]], low[begin]))
    if not runs:
        return (np.array([], np.int64),) * 4
    joined = [np.concatenate(r) for r in zip(*runs)]
    by_string = np.argsort(joined[0], kind="stable")
    return tuple(r[by_string] for r in joined)


def _find_minima(length: int) -> Callable[[pa.Table], pa.Table]:
    """A bucket's answer: for runs of windows of each sent segment, the least id of a document that has the window."""

    def find_minima(table: pa.Table) -> pa.Table:
        width = 2 * length - GRAM
        sent = [_unpack(p, "<u4", "u1", "u4", "i8", "?") for p in table.column("payload").to_pylist()]
        sizes, text, key, least, several = (np.concatenate([s[i] for s in sent]) for i in range(5))
        symbols = np.zeros((len(sizes), width), np.uint8)
        symbols[np.arange(width) < sizes[:, None]] = text
        strings, index, inverse = np.unique(symbols.view(f"S{width}").ravel(), return_index=True, return_inverse=True)
        value = np.full(len(strings), NO_ID)
        np.minimum.at(value, inverse, least)
        windows = np.char.str_len(strings) - length + 1
        run_of, begin, end, low = _runs(strings, value, key[index], length)
        starts = np.searchsorted(run_of, np.arange(len(strings) + 1))
        bucket, rows, at = table.column("bucket")[0].as_py(), [], 0
        for number, part in zip(table.column("batch").to_pylist(), sent):
            n = len(part[0])
            mine, own, many = inverse[at : at + n], part[3], part[4]
            at += n
            runs = starts[mine + 1] - starts[mine]
            string = np.repeat(np.arange(n), runs)
            run = np.arange(len(string)) - np.repeat(np.cumsum(runs) - runs, runs) + np.repeat(starts[mine], runs)
            useful = many[string] | (low[run] < own[string])
            string, run = string[useful], run[useful]
            plain = np.flatnonzero((runs == 0) & (many | (value[mine] < own)))
            joined = [
                np.concatenate(x)
                for x in ((plain, string), (np.zeros(len(plain), np.int64), begin[run]), (windows[mine[plain]], end[run]), (value[mine[plain]], low[run]))
            ]
            if len(joined[0]):
                rows.append((number, bucket, MINIMA, _pack(joined[0].astype("<u4"), joined[1].astype("<u4"), joined[2].astype("<u4"), joined[3].astype("<i8"))))
        return _messages(rows)

    return find_minima


KEPT = "doc_id long, kept binary, removed array<struct<start: long, end: long>>"
_KEPT = pa.schema([("doc_id", pa.int64()), ("kept", pa.binary()), ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])


def _cut(buckets: int, length: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Apply the answers: cover the windows that a document with a smaller id has too."""

    def run(docs: pa.Table, replies: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return _KEPT.empty_table()
        batch = Batch.of(docs, buckets, length)
        depth = np.zeros(len(batch.data) + 1, np.int32)
        if replies.num_rows:
            answers = {
                b: _unpack(p, "<u4", "<u4", "<u4", "<i8") for b, k, p in zip(*(replies.column(c).to_pylist() for c in ("bucket", "kind", "payload"))) if k == MINIMA
            }
            batch, parts = batch.travelling(replies, buckets, length)
            for bucket, part in parts.items():
                if bucket not in answers:
                    continue
                string, begin, end, least = answers[bucket]
                _, inverse = np.unique(batch.strings(part, length), return_inverse=True)
                order = np.argsort(inverse, kind="stable")
                holders = np.searchsorted(inverse[order], [string, string.astype(np.int64) + 1])
                many = holders[1] - holders[0]
                run_of = np.repeat(np.arange(len(string)), many)
                member = order[np.arange(len(run_of)) - np.repeat(np.cumsum(many) - many, many) + holders[0][run_of]]
                later = batch.ids[batch.doc[part[member]]] > least[run_of]
                base, run_of = batch.first[part[member[later]]], run_of[later]
                np.add.at(depth, base + begin[run_of], 1)
                np.add.at(depth, base + end[run_of] - 1 + length, -1)
        gone = np.cumsum(depth[:-1], dtype=np.int32) > 0
        out = []
        for i, (a, b) in enumerate(zip(batch.bounds, batch.bounds[1:])):
            mask = gone[a:b]
            edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
            doc_id = int(batch.ids[i])
            out.append({
                "doc_id": None if doc_id == NO_ID else doc_id,
                "kept": batch.data[a:b][~mask].tobytes(),
                "removed": [{"start": s, "end": e} for s, e in edges.reshape(-1, 2).tolist()],
            })
        return pa.Table.from_pylist(out, schema=_KEPT)

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, kept, removed): the bytes of each whole text that stay, and the byte spans that go.

    A byte goes if some string of ``length`` bytes that covers it also starts in a document with a smaller id. Strings are judged
    on the input and do not cross documents. Null text is empty; rows without id count as larger than all and equal
    among themselves; rows that share an id do not remove each other. Texts shorter than ``length`` stay whole; an empty table gives no rows.
    """
    if length < 2 * GRAM:
        raise ValueError(f"length must be at least {2 * GRAM}")
    spark = docs.sparkSession
    buckets = shuffle_partitions(spark)
    body = F.encode(F.coalesce(F.col("text").cast("string"), F.lit("")), "UTF-8")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), body.alias("body"))
    dealt = rows.select(F.pmod(F.xxhash64("doc_id", "body"), F.lit(4 * buckets)).alias("batch"), "doc_id", "body")

    announced = dealt.groupBy("batch").applyInArrow(_announce(buckets, length), MESSAGE)
    shared = staged(announced.groupBy("bucket").applyInArrow(_find_shared(HOT), MESSAGE), "repeats-shared")
    sent = dealt.groupBy("batch").cogroup(shared.groupBy("batch")).applyInArrow(_send_segments(buckets, length), MESSAGE)
    minima = staged(sent.groupBy("bucket").applyInArrow(_find_minima(length), MESSAGE), "repeats-minima")
    answers = shared.unionByName(minima)
    return dealt.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(_cut(buckets, length), KEPT)
