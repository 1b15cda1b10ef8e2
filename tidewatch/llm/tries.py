"""Prefix trie of conversations by truncation peeling: which first turns conversations share, and what sharing them saves."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import discard, staged

#: So many neighbouring partitions are merged in one step of closing the nodes that several of them hold.
FAN = 64
#: The hash of no ids at all.
NO_ENDS = hashlib.sha256(b"").hexdigest()
NOTHING = np.iinfo(np.int64).max

NODE = (
    "key_a long, key_b long, parent_a long, parent_b long, conv_id long, depth long, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long, ends string, was_open boolean"
)
OPEN = (
    "path array<long>, sizes array<long>, open_n array<long>, open_conv array<long>, open_children array<long>, "
    "open_leaves array<long>, open_saved array<long>, open_ends array<string>"
)
#: A row is a finished node, the open nodes along one path (side: 0 first path, 1 last path), or ids of an end that reach over a batch (side: batch).
ROW = f"kind string, part long, side long, {NODE}, {OPEN}"
_ARROW = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
_SCHEMA = pa.schema([(c.split()[0], _ARROW[c.split()[1]]) for c in ROW.split(", ")])
NODE_NAMES = [c.split()[0] for c in NODE.split(", ")]
SUMMED = ("n", "children", "leaves", "saved")


def _rows(kind: str, part: int, **columns) -> pa.RecordBatch:
    """Rows of one kind; the columns that are not given are null."""
    n = len(next(iter(columns.values())))
    columns |= {"kind": [kind] * n, "part": [part] * n}
    arrays = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in _SCHEMA]
    return pa.RecordBatch.from_arrays(arrays, schema=_SCHEMA)


def _mixed(x: np.ndarray) -> np.ndarray:
    """The finishing steps of a public 64-bit generator: every bit of the input reaches every bit of the output."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Paths:
    """Paths in lexicographic order: per path the digests of its turns (two numbers a turn) and the sizes of their texts."""

    def __init__(self, digests: np.ndarray, sizes: np.ndarray, depths: np.ndarray):
        self.digests, self.sizes, self.depths = digests.reshape(-1, 2), sizes, depths
        self.starts = np.concatenate([[0], np.cumsum(depths)])
        # The key of a node adds up hashes of (place, turn) over its path, so it is a difference of running sums.
        place = np.arange(len(sizes), dtype=np.int64) - np.repeat(self.starts[:-1], depths) + 1
        turns = self.digests.astype(np.uint64)
        salt = _mixed(place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        self.keys = []
        for lane in (0, 1):
            h = _mixed(_mixed(turns[:, lane] + salt) ^ (turns[:, 1 - lane] + np.uint64(lane + 1)))
            total = np.concatenate([[np.uint64(0)], np.cumsum(h, dtype=np.uint64)])
            self.keys.append((total[1:] - np.repeat(total[self.starts[:-1]], depths)).astype(np.int64))

    def key(self, path: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the nodes at ``depth`` on the given paths; the root's is (0, 0)."""
        if depth == 0:
            return np.zeros(len(path), np.int64), np.zeros(len(path), np.int64)
        at = self.starts[path] + depth - 1
        return self.keys[0][at], self.keys[1][at]

    def size(self, path: np.ndarray, depth: int) -> np.ndarray:
        return self.sizes[self.starts[path] + depth - 1] if depth else np.zeros(len(path), np.int64)

    def of(self, path: int) -> tuple[np.ndarray, np.ndarray]:
        span = slice(self.starts[path], self.starts[path + 1])
        return self.digests[span].reshape(-1), self.sizes[span]


class Open:
    """The nodes along one path that other batches or partitions may hold too, with what is known of them so far."""

    def __init__(self, path: np.ndarray, sizes: np.ndarray):
        self.path, self.sizes = path, sizes
        depth = len(sizes) + 1
        self.sums = {name: np.zeros(depth, np.int64) for name in SUMMED}
        self.conv, self.ends = np.full(depth, NOTHING, np.int64), [None] * depth

    def row(self, part: int, side: int) -> pa.RecordBatch:
        sums = {f"open_{name}": [values] for name, values in self.sums.items()}
        return _rows("open", part, side=[side], path=[self.path], sizes=[self.sizes], open_conv=[self.conv], open_ends=[self.ends], **sums)

    @classmethod
    def read(cls, row: dict) -> Open:
        self = cls(np.array(row["path"], np.int64), np.array(row["sizes"], np.int64))
        self.sums = {name: np.array(row[f"open_{name}"], np.int64) for name in SUMMED}
        self.conv, self.ends = np.array(row["open_conv"], np.int64), row["open_ends"]
        return self


def peel(paths: Paths, entries: dict[str, np.ndarray], ends: list[str], closing: bool) -> tuple[dict[str, np.ndarray], list[Open]]:
    """Finished nodes and open paths of a run of neighbouring paths.

    Starts at the greatest depth. At each depth what ends there (``entries``: path, depth, sums, smallest id, number in ``ends``
    or -1, was_open) joins the survivors of the depth below, equal prefixes are grouped, each group is a node, and
    without its last turn it survives to the next depth. Nodes on the first and the last path may go on in
    the neighbouring runs: unless ``closing``, they stay open and survive nowhere yet.
    """
    count, last = len(paths.depths), len(paths.depths) - 1
    edges = [] if closing else [Open(*paths.of(i)) for i in dict.fromkeys((0, last))]
    names = ("path", "conv", "ends", "was_open", *SUMMED)
    order = np.argsort(entries["depth"], kind="stable")
    cuts = np.searchsorted(entries["depth"][order], np.arange(entries["depth"].max() + 2))
    survivors = {name: np.zeros(0, np.int64) for name in names}
    waiting: dict[str, np.ndarray] | None = None
    done: list[dict[str, np.ndarray]] = []
    for depth in range(int(entries["depth"].max()), -1, -1):
        ended = order[cuts[depth] : cuts[depth + 1]]
        met = {name: np.concatenate([entries[name][ended], survivors[name]]) for name in names}
        if not len(met["path"]):
            continue
        by_path = np.argsort(met["path"], kind="stable")
        met = {name: values[by_path] for name, values in met.items()}
        a, b = paths.key(met["path"], depth)
        new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        first = np.flatnonzero(new)
        node = {name: np.add.reduceat(met[name], first) for name in SUMMED}
        node |= {"path": met["path"][first], "conv": np.minimum.reduceat(met["conv"], first), "a": a[first], "b": b[first]}
        node |= {name: np.maximum.reduceat(met[name], first) for name in ("ends", "was_open")}
        is_open = np.zeros(len(first), bool)
        for edge, side, at in zip(edges, (0, last), (0, len(first) - 1)):
            own = paths.key(np.array([side]), depth) if paths.depths[side] >= depth else None
            if own and not is_open[at] and (node["a"][at], node["b"][at]) == (own[0][0], own[1][0]):
                is_open[at] = True
                for name in SUMMED:
                    edge.sums[name][depth] = node[name][at]
                edge.conv[depth] = node["conv"][at]
                edge.ends[depth] = ends[node["ends"][at]] if node["ends"][at] >= 0 else None
        if waiting is not None:
            # The survivors came last before sorting; their groups are their parents.
            parent = np.empty(len(by_path), np.int64)
            parent[by_path] = np.cumsum(new) - 1
            parent = parent[len(ended) :]
            known = ~is_open[parent]
            done.append(waiting | {"parent_conv": np.where(known, node["conv"][parent], NOTHING), "parent_a": node["a"][parent], "parent_b": node["b"][parent]})
        kept = np.flatnonzero(~is_open)
        node = {name: values[kept] for name, values in node.items()}
        node["leaves"] = np.where(node["children"] == 0, 1, node["leaves"])
        node["saved"] = node["saved"] + (node["n"] - 1) * paths.size(node["path"], depth)
        waiting = node | {"depth": np.full(len(kept), depth, np.int64)}
        survivors = {name: node[name] for name in ("path", "conv", "n", "leaves", "saved")}
        survivors |= {"children": np.ones(len(kept), np.int64), "ends": np.full(len(kept), -1, np.int64), "was_open": np.zeros(len(kept), np.int64)}
        if not len(kept):
            waiting = None
    if waiting is not None:
        none = np.full(len(waiting["n"]), NOTHING, np.int64)
        done.append(waiting | {"parent_conv": none, "parent_a": none, "parent_b": none})
    finished = {name: np.concatenate([d[name] for d in done]) for name in done[0]} if done else {}
    return finished, edges if count else []


def _node_rows(part: int, finished: dict[str, np.ndarray], ends: list[str]) -> pa.RecordBatch:
    def nullable(values: np.ndarray) -> pa.Array:
        return pa.array(values, pa.int64(), mask=values == NOTHING)

    return _rows(
        "node", part, key_a=finished["a"], key_b=finished["b"], parent_a=nullable(finished["parent_a"]), parent_b=nullable(finished["parent_b"]),
        conv_id=finished["conv"], depth=finished["depth"], parent_conv_id=nullable(finished["parent_conv"]), n_convs=finished["n"],
        n_children=finished["children"], n_leaves=finished["leaves"], saved_tokens=finished["saved"],
        ends=[ends[i] if i >= 0 else None for i in finished["ends"].tolist()], was_open=finished["was_open"] > 0,
    )


def _opened(edges: list[Open], offset: int = 0) -> tuple[dict[str, np.ndarray], list[str]]:
    """Entries for every open node of the paths ``offset``, ``offset`` + 1, ..."""
    depths = [len(e.conv) for e in edges]
    entries = {name: np.concatenate([e.sums[name] for e in edges]) for name in SUMMED}
    entries["conv"] = np.concatenate([e.conv for e in edges])
    entries["path"] = np.repeat(np.arange(len(edges)) + offset, depths)
    entries["depth"] = np.concatenate([np.arange(d) for d in depths])
    entries["was_open"] = np.ones(len(entries["conv"]), np.int64)
    ends = [text for e in edges for text in e.ends if text is not None]
    has = np.array([text is not None for e in edges for text in e.ends])
    entries["ends"] = np.where(has, np.cumsum(has) - 1, -1)
    return entries, ends


def _peeled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Peel a partition of sorted conversations batch by batch; what stays open goes on into the next batch, at last into the result."""
    part, edges = TaskContext.get().partitionId(), []
    for number, batch in enumerate(batches):
        if not batch.num_rows:
            continue
        ids, path, sizes = (batch.column(name) for name in ("conv_id", "path", "sizes"))
        conv, depths = ids.to_numpy(), np.diff(sizes.offsets.to_numpy()).astype(np.int64)
        digests, lengths = path.flatten().to_numpy(), sizes.flatten().to_numpy()
        paths = Paths(
            np.concatenate([*(e.path for e in edges), digests]), np.concatenate([*(e.sizes for e in edges), lengths]),
            np.concatenate([np.array([len(e.sizes) for e in edges], np.int64), depths]),
        )
        rows = np.arange(len(conv)) + len(edges)
        # Conversations with the same turns are neighbours, smallest id first.
        key_a, key_b = (np.zeros(len(conv), np.int64) for _ in range(2))
        some = depths > 0
        key_a[some], key_b[some] = (lane[paths.starts[rows[some] + 1] - 1] for lane in paths.keys)
        same = (depths[1:] == depths[:-1]) & (key_a[1:] == key_a[:-1]) & (key_b[1:] == key_b[:-1])
        firsts = np.concatenate([[0], np.flatnonzero(~same) + 1, [len(conv)]])
        texts = [",".join(map(str, conv[i:j].tolist())) for i, j in zip(firsts[:-1].tolist(), firsts[1:].tolist())]
        # Only the first and the last of these groups can go on in another batch.
        for run in dict.fromkeys((0, len(texts) - 1)):
            yield _rows("ids", part, side=[number], key_a=[key_a[firsts[run]]], key_b=[key_b[firsts[run]]], ends=[texts[run]])
        inner = [hashlib.sha256(text.encode()).hexdigest() for text in texts[1:-1]]
        number_of = np.full(len(texts), -1, np.int64)
        number_of[1:-1] = np.arange(len(inner))
        one = np.ones(len(conv), np.int64)
        entries = {"path": rows, "depth": depths, "conv": conv, "n": one, "ends": np.repeat(number_of, np.diff(firsts))}
        entries |= {name: 0 * one for name in ("children", "leaves", "saved", "was_open")}
        if edges:
            carried, known = _opened(edges)
            entries["ends"] = np.where(entries["ends"] >= 0, entries["ends"] + len(known), -1)
            entries = {name: np.concatenate([carried[name], values]) for name, values in entries.items()}
            inner = known + inner
        finished, edges = peel(paths, entries, inner, closing=False)
        if finished:
            yield _node_rows(part, finished, inner)
    for side, edge in enumerate(edges):
        yield edge.row(part, side)


def _merging(closing: bool) -> Callable[[pa.Table], pa.Table]:
    def merge(table: pa.Table) -> pa.Table:
        return _merged(table, closing)

    return merge


def _merged(table: pa.Table, closing: bool) -> pa.Table:
    """Peel the open paths of neighbouring partitions."""
    rows = sorted(table.to_pylist(), key=lambda r: (r["part"], r["side"]))
    part, edges = rows[0]["part"] // FAN, [Open.read(r) for r in rows]
    paths = Paths(*(np.concatenate([getattr(e, name) for e in edges]) for name in ("path", "sizes")), np.array([len(e.sizes) for e in edges], np.int64))
    entries, ends = _opened(edges)
    held = entries["n"] > 0
    finished, edges = peel(paths, {name: values[held] for name, values in entries.items()}, ends, closing)
    out = [_node_rows(part, finished, ends)] if finished else []
    return pa.Table.from_batches(out + [edge.row(part, side) for side, edge in enumerate(edges)], _SCHEMA)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One hash a node over its ids, which arrive in order, a part at a time."""
    key, running = None, None
    names = ["key_a", "key_b", "hash"]

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([dict(zip(names, [*key, running.hexdigest()]))], pa.schema([("key_a", pa.int64()), ("key_b", pa.int64()), ("hash", pa.string())]))

    for batch in batches:
        for a, b, text in zip(*(batch.column(c).to_pylist() for c in ("key_a", "key_b", "ends"))):
            if key == (a, b):
                running.update(f",{text}".encode())
                continue
            if key is not None:
                yield out()
            key, running = (a, b), hashlib.sha256(text.encode())
    if key is not None:
        yield out()


def turn_lists(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): per conversation its turns in order, each as its number, the two halves of its digest and its length in code points.

    Texts stay where they are read; 28 bytes a turn are gathered. Null turns come first, equal turns in the order of their digest
    (MD5 of the role's length, a colon, role and text). Null roles and texts are empty. Rows without conversation are left out.
    """
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("role", "text"))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    # Eight hex digits give a number below 2^32; two of them make a signed 64-bit half.
    parts = [F.conv(F.substring(digest, at, 8), 16, 10).cast("long") for at in (1, 9, 17, 25)]
    a, b = (F.shiftleft(parts[i] - F.lit(1 << 31), 32).bitwiseOR(parts[i + 1]) for i in (0, 2))
    turn = F.struct(F.col("turn").cast("long").alias("turn"), a.alias("a"), b.alias("b"), F.length(text).cast("long").alias("size"))
    rows = turns.filter(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def grafted(conversations: DataFrame, base: Column, heads: Column, longest: int) -> DataFrame:
    """Conversations whose first ``heads`` turns are replaced by as many of the conversation ``base``, or by none if there is no such one.

    ``longest`` bounds ``heads``. A base is read once, with its first turns only.
    """
    own = conversations.select("conv_id", "turns", base.alias("base"), heads.cast("int").alias("head"))
    wanted = own.select(F.col("base").alias("conv_id")).distinct()
    first = conversations.join(wanted, "conv_id", "left_semi").select(F.col("conv_id").alias("base"), F.slice("turns", 1, longest).alias("first"))
    met = own.join(first, "base", "left")
    grown = F.concat(
        F.slice(F.coalesce("first", F.slice("turns", 1, 0)), F.lit(1), F.col("head")),
        F.slice("turns", F.col("head") + 1, F.greatest(F.size("turns") - F.col("head"), F.lit(0))),
    )
    return met.select("conv_id", grown.alias("turns"))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of ``conversations(conv_id, turns)`` (see ``turn_lists``).

    Columns: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256. Conversations are
    sorted by their turns and dealt by ranges, equal ones by their id, so a first turn or a conversation that many share is spread. Each partition peels its
    own range; the nodes at its two ends, one path each, are merged with those of its neighbours, ``FAN`` at a time. The ids that
    end at one node are hashed where they lie; only those that reach over a batch are brought together, a batch's as one text.
    A conversation without turns ends at the root. No conversation gives no node, not even a root.
    """
    flat = F.flatten(F.transform("turns", lambda t: F.array(t["a"], t["b"])))
    rows = staged(conversations.select("conv_id", flat.alias("path"), F.transform("turns", lambda t: t["size"]).alias("sizes")), "trie-paths")
    dealt = rows.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    found = staged(dealt.mapInArrow(_peeled, ROW), "trie-peeled")
    discard(rows)
    nodes, open_paths = [found.filter("kind = 'node'").select(*NODE_NAMES)], found.filter("kind = 'open'")
    parts = found.agg(F.max("part")).first()[0]
    while parts is not None:
        closing = parts < FAN
        # A partition number is the place of its range, so neighbours share a quotient.
        scoped = open_paths.groupBy(F.expr(f"part div {FAN}").alias("scope"))
        merged = staged(scoped.applyInArrow(_merging(closing), ROW), "trie-merged")
        nodes.append(merged.filter("kind = 'node'").select(*NODE_NAMES))
        open_paths, parts = merged.filter("kind = 'open'"), None if closing else parts // FAN
    every = nodes[0]
    for more in nodes[1:]:
        every = every.unionByName(more)
    # A node whose parent was still open lacks the parent's id; open nodes are a path per batch, so these are few.
    lacking = (F.col("depth") > 0) & F.col("parent_conv_id").isNull()
    opened = every.filter("was_open").select(F.col("key_a").alias("parent_a"), F.col("key_b").alias("parent_b"), F.col("conv_id").alias("parent"))
    opened = staged(opened, "trie-opened")
    adopted = every.filter(lacking).join(opened, ["parent_a", "parent_b"], "left").withColumn("parent_conv_id", F.col("parent")).drop("parent")
    whole = every.filter(~lacking).unionByName(adopted)
    ids = found.filter("kind = 'ids'").select("key_a", "key_b", "part", "side", "ends")
    order = ids.repartition("key_a", "key_b").sortWithinPartitions("key_a", "key_b", "part", "side")
    hashes = staged(order.mapInArrow(_hashed, "key_a long, key_b long, hash string"), "trie-hashes")
    named = whole.join(hashes, ["key_a", "key_b"], "left")
    ends = F.coalesce("ends", "hash", F.lit(NO_ENDS)).alias("ends_sha256")
    return named.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", ends)
