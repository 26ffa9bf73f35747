"""Trie of conversation prefixes over a minimal perfect hash of prefix digests.

A conversation is a path of turns; every distinct sequence of first turns is a
node. Paths are sorted by their turn digests and dealt into shards of about
``SHARD_TURNS`` turns by a range exchange on (path, conversation id), so a first turn
or a whole conversation that very many share is spread over as many shards as
it fills. In a shard, in numpy:

1. The digests of all prefixes of its paths are chained turn by turn, and the
   distinct ones enumerated.
2. A minimal perfect hash gives each distinct digest a slot: level by level,
   digests alone in their bin of a bit table keep it, the others go on to the
   next level; the slot is the rank of the bit. Every look-up compares digest,
   parent's slot and turn digest with what the slot holds and fails on a difference.
3. Members, smallest ids, weights are scattered into flat arrays by slot;
   children, leaves and saved tokens are accumulated through the array of parents' slots,
   deepest nodes first.

Nodes off the shard's first and last path have all their members in it and
are done. Those on the two paths may go on in a neighbouring shard: they go, with
what is known of them, as two paths into a further round of the same work. A round
leaves two paths a shard, so a few rounds end in one shard, whose nodes are
all done. Each round's output is a table in the shared folder. Ids of
conversations that end in a node of a boundary path are brought together by
an exchange on (node, shard) and hashed as a stream.

Turn digests are 128 bits of SHA-256. A task holds its shard's paths, 16 bytes a turn;
one conversation is never split. Defined cases: turns are
ordered by turn number, NULL first, equal numbers by digest; NULL role and
text count as empty; rows without a conversation id belong to no conversation;
repeated rows are repeated turns; extra columns are ignored; without
conversations there are no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import WORD, cut

SHARD_TURNS = 20_000
SHARD_PATHS = 8
EMPTY = hashlib.sha256(b"").hexdigest()
ROOT = np.array([0x243F6A8885A308D3, 0x13198A2E03707344], np.uint64)  # digest of the empty prefix
M1, M2, M3 = (np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15))

#: A path and what is known of its nodes, root first (words: one a turn).
PATH = ("path binary, tie long, conv array<long>, members array<long>, children array<long>, leaves array<long>, saved array<long>, "
        "words array<long>, nodes array<binary>")
NODE = ("node binary, parent binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
        "saved_tokens long, ends_sha256 string")
OUT = f"kind int, shard int, {NODE}, ends array<long>, {PATH}"
FINAL = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def turn_digest(role: Column, text: Column) -> Column:
    """128 bits of SHA-256, in hexadecimal; the role's length keeps role and text apart."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    return F.substring(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), 1, 32)


def conversation_turns(rows: DataFrame) -> DataFrame:
    """One row per conversation: conv_id and turns, an ordered array of (turn, digest, words)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    turns = rows.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn").cast("long").alias("turn"), turn_digest(F.col("role").cast("string"), text).alias("digest"),
                 F.regexp_count(text, F.lit(WORD)).cast("long").alias("words")).alias("t"))
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (a ^ (b * M3)) + M3
        x = (x ^ (x >> np.uint64(30))) * M1
        x = (x ^ (x >> np.uint64(27))) * M2
        return x ^ (x >> np.uint64(31))


def chain(parent: np.ndarray, turn: np.ndarray) -> np.ndarray:
    """Digests (rows of two numbers) of prefixes one turn longer."""
    lo = _mix(parent[:, 0] ^ turn[:, 0], _mix(parent[:, 1], turn[:, 1]))
    return np.stack([lo, _mix(parent[:, 1] ^ turn[:, 1], _mix(lo, turn[:, 0]))], axis=1)


class SlotTable:
    """Minimal perfect hash of distinct digests (n x 2), numbers 0 to n-1."""

    def __init__(self, keys: np.ndarray):
        self.levels: list[tuple[np.uint64, np.ndarray, int]] = []
        left, offset = keys, 0
        while len(left):
            seed, size = np.uint64(len(self.levels) + 1), 2 * len(left)
            bins = _mix(left[:, 0] ^ seed, left[:, 1]) % np.uint64(size)
            alone = np.bincount(bins.astype(np.int64), minlength=size) == 1
            self.levels.append((seed, np.where(alone, np.cumsum(alone) - 1 + offset, -1), size))
            offset += int(alone.sum())
            left = left[~alone[bins.astype(np.int64)]]
        self.held = np.zeros_like(keys)
        self.held[self._find(keys)] = keys

    def _find(self, keys: np.ndarray) -> np.ndarray:
        slot = np.full(len(keys), -1, np.int64)
        todo = np.arange(len(keys))
        for seed, ranks, size in self.levels:
            got = ranks[(_mix(keys[todo, 0] ^ seed, keys[todo, 1]) % np.uint64(size)).astype(np.int64)]
            slot[todo[got >= 0]] = got[got >= 0]
            todo = todo[got < 0]
        return slot

    def slots(self, keys: np.ndarray) -> np.ndarray:
        slot = self._find(keys)
        if (slot < 0).any() or (self.held[slot] != keys).any():
            raise ValueError("a digest without a slot of its own")
        return slot


def _long_lists(values: np.ndarray, lens: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lens)]).astype(np.int32)), pa.array(values.astype(np.int64)))


class Shard:
    """The nodes of one shard's paths, which come in sorted order."""

    def __init__(self, table: pa.Table, whole: bool):
        paths = [p.as_py() for p in table.column("path")]
        self.paths, n = paths, len(paths)
        self.lens = np.array([len(p) // 16 for p in paths], np.int64)
        turns = np.frombuffer(b"".join(paths), ">u8").astype(np.uint64).reshape(-1, 2)
        base = np.cumsum(self.lens) - self.lens
        # Entry of (path, depth): row base + number of the path + depth.
        self.entry = base + np.arange(n)
        total = int(self.lens.sum()) + n
        digests = np.empty((total, 2), np.uint64)
        digests[self.entry] = ROOT
        longest = np.argsort(-self.lens, kind="stable")
        for d in range(1, int(self.lens.max()) + 1):
            on = longest[: int((self.lens >= d).sum())]
            digests[self.entry[on] + d] = chain(digests[self.entry[on] + d - 1], turns[base[on] + d - 1])
        distinct = np.unique(digests.view([("a", "u8"), ("b", "u8")]).ravel()).view("u8").reshape(-1, 2)
        self.table = SlotTable(distinct)
        self.slot = self.table.slots(digests)
        m = len(distinct)
        owner = np.repeat(np.arange(n), self.lens + 1)
        depth = np.arange(total) - np.repeat(self.entry, self.lens + 1)
        inner = np.flatnonzero(depth > 0)  # entries below the root
        turn_at = inner - owner[inner] - 1
        self.depth = np.zeros(m, np.int64)
        self.depth[self.slot] = depth
        self.parent = np.full(m, -1, np.int64)
        self.parent[self.slot[inner]] = self.slot[inner - 1]
        turn = np.zeros((m, 2), np.uint64)
        turn[self.slot[inner]] = turns[turn_at]
        if (self.parent[self.slot[inner]] != self.slot[inner - 1]).any() or (turn[self.slot[inner]] != turns[turn_at]).any() or (self.depth[self.slot] != depth).any():
            raise ValueError("two prefixes have one digest")

        def flat(name: str) -> np.ndarray:
            return table.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)

        self.words = np.zeros(m, np.int64)
        self.words[self.slot[inner]] = flat("words")
        self.first = np.full(m, np.iinfo(np.int64).max)
        np.minimum.at(self.first, self.slot, flat("conv"))
        self.members, self.children, self.leaves, self.saved = (np.zeros(m, np.int64) for _ in range(4))
        for name in ("members", "children", "leaves", "saved"):
            np.add.at(getattr(self, name), self.slot, flat(name))
        self.open = np.zeros(m, bool)
        self.edge = [] if whole else sorted({0, n - 1})
        for k in self.edge:
            self.open[self.path_slots(k)] = True
        self._accumulate()

    def path_slots(self, k: int) -> np.ndarray:
        return self.slot[self.entry[k] : self.entry[k] + self.lens[k] + 1]

    def _accumulate(self) -> None:
        order = np.argsort(-self.depth, kind="stable")
        order = order[~self.open[order]]
        for level in np.split(order, np.flatnonzero(np.diff(self.depth[order])) + 1):
            self.leaves[level] += self.children[level] == 0
            self.saved[level] += (self.members[level] - 1) * self.words[level]
            below = level[self.parent[level] >= 0]
            up = self.parent[below]
            np.add.at(self.children, up, 1)
            np.add.at(self.leaves, up, self.leaves[below])
            np.add.at(self.saved, up, self.saved[below])

    def names(self, slots: np.ndarray) -> list[bytes]:
        raw = self.table.held[slots].astype(">u8").tobytes()
        return [raw[16 * i : 16 * i + 16] for i in range(len(slots))]


def _rows(schema: pa.Schema, n: int, **columns) -> pa.RecordBatch:
    return pa.record_batch([columns[f.name].cast(f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)


def _worker(schema: pa.Schema, whole: bool, with_ends: bool):
    """Rows of kind 0: done nodes. 1: boundary paths. 2: ids that end in a node of a boundary path."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        number = TaskContext.get().partitionId()
        shard = Shard(pa.Table.from_batches(parts), whole)

        def fixed(n: int, kind: int) -> dict:
            return {"kind": pa.array(np.full(n, kind, np.int32)), "shard": pa.array(np.full(n, number, np.int32))}

        ends: dict[int, list[int]] = {}
        if with_ends:
            last = shard.slot[shard.entry + shard.lens].tolist()
            for s, tie in zip(last, pa.Table.from_batches(parts).column("tie").to_pylist()):
                ends.setdefault(s, []).append(tie)
        done = np.flatnonzero(~shard.open)
        if len(done):
            parent = shard.parent[done]
            has = parent >= 0
            known = has & ~shard.open[parent]  # the parent's smallest member is final too
            yield _rows(schema, len(done), **fixed(len(done), 0), node=pa.array(shard.names(done), pa.binary()),
                        parent=pa.array([p if h else None for p, h in zip(shard.names(np.maximum(parent, 0)), has)], pa.binary()),
                        conv_id=pa.array(shard.first[done]), depth=pa.array(shard.depth[done]),
                        parent_conv_id=pa.array(shard.first[parent], mask=~known), n_convs=pa.array(shard.members[done]),
                        n_children=pa.array(shard.children[done]), n_leaves=pa.array(shard.leaves[done]), saved_tokens=pa.array(shard.saved[done]),
                        ends_sha256=pa.array([hashlib.sha256(",".join(map(str, sorted(ends.get(s, ())))).encode()).hexdigest() for s in done.tolist()])
                        if with_ends else pa.nulls(len(done), pa.string()))
        open_ends = [s for s in ends if shard.open[s]]
        if open_ends:
            yield _rows(schema, len(open_ends), **fixed(len(open_ends), 2), node=pa.array(shard.names(np.array(open_ends)), pa.binary()),
                        ends=_long_lists(np.array(sum((sorted(ends[s]) for s in open_ends), [])), np.array([len(ends[s]) for s in open_ends])))
        told = np.zeros(len(shard.depth), bool)
        for k in shard.edge:
            slots = shard.path_slots(k)
            new = ~told[slots]  # what both paths share is told once
            told[slots] = True
            size = np.array([len(slots)])
            yield _rows(schema, 1, **fixed(1, 1), path=pa.array([shard.paths[k]], pa.binary()), tie=pa.array([2 * number + (k > 0)]),
                        conv=_long_lists(shard.first[slots], size), words=_long_lists(shard.words[slots[1:]], size - 1),
                        members=_long_lists(shard.members[slots] * new, size), children=_long_lists(shard.children[slots] * new, size),
                        leaves=_long_lists(shard.leaves[slots] * new, size), saved=_long_lists(shard.saved[slots] * new, size),
                        nodes=pa.ListArray.from_arrays(pa.array([0, len(slots)], pa.int32()), pa.array(shard.names(slots), pa.binary())))

    return run


def _end_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node and the digest of all its ids; rows come by node, shard and position."""
    node, state, some = None, None, False
    for batch in batches:
        names, digests = [], []
        for name, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if name != node:
                if node is not None:
                    names.append(node)
                    digests.append(state.hexdigest())
                node, state, some = name, hashlib.sha256(), False
            state.update(("," if some else "").encode() + ",".join(map(str, ids)).encode())
            some = True
        if names:
            yield pa.record_batch([pa.array(names, pa.binary()), pa.array(digests)], names=["node", "ends_sha256"])
    if node is not None:
        yield pa.record_batch([pa.array([node], pa.binary()), pa.array([state.hexdigest()])], names=["node", "ends_sha256"])


def _round(paths: DataFrame, shards: int, with_ends: bool) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = to_arrow_schema(_parse_datatype_string(OUT), prefers_large_types=False)
    if shards == 1:
        dealt = paths.repartition(1).sortWithinPartitions("path", "tie")
    else:
        dealt = paths.repartitionByRange(shards, "path", "tie").sortWithinPartitions("path", "tie")
    return cut(dealt.mapInArrow(_worker(schema, shards == 1, with_ends), OUT), "trie")


def trie_nodes(conversations: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per node of the trie of ``conversations`` (conv_id, turns: array
    of structs with a hexadecimal ``digest`` of 32 characters and ``words``): conv_id (smallest member),
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens (over
    the subtree, (members - 1) x words of the last turn), ends_sha256 (of the
    ids of the conversations that end there)."""
    turns = F.col("turns")
    ones = F.array_repeat(F.lit(0).cast("long"), F.size(turns) + 1)
    paths = cut(conversations.select(
        F.unhex(F.array_join(F.transform(turns, lambda t: t["digest"]), "")).alias("path"), F.col("conv_id").alias("tie"),
        F.array_repeat(F.col("conv_id"), F.size(turns) + 1).alias("conv"),
        F.array_repeat(F.lit(1).cast("long"), F.size(turns) + 1).alias("members"), ones.alias("children"), ones.alias("leaves"), ones.alias("saved"),
        F.transform(turns, lambda t: t["words"]).alias("words")), "paths")
    rounds, with_ends = [], True
    while True:
        size, count = paths.agg(F.coalesce(F.sum(F.size("conv")), F.lit(0)), F.count(F.lit(1))).first()
        # A shard has some paths at least, as two of them go on: every round has far fewer.
        shards = max(1, min(-(-size // shard_turns), count // SHARD_PATHS))
        rounds.append(_round(paths.drop("nodes"), shards, with_ends))
        if shards == 1:
            break
        with_ends = False
        paths = rounds[-1].filter("kind = 1").select(*[c.split()[0] for c in PATH.split(", ")])
    done = rounds[-1].filter("kind = 0").select("shard", *_names(NODE))
    for this in reversed(rounds[:-1]):
        # Smallest members of the boundary nodes of each shard, for the nodes that hang from them.
        edges = this.filter("kind = 1").select("shard", F.explode("nodes").alias("parent")).distinct()
        final = edges.join(done.select(F.col("node").alias("parent"), F.col("conv_id").alias("found")), "parent")
        here = this.filter("kind = 0").select("shard", *_names(NODE))
        tops = here.filter("parent_conv_id IS NULL").join(final, ["shard", "parent"], "left").withColumn("parent_conv_id", F.col("found"))
        done = done.unionByName(here.filter("parent_conv_id IS NOT NULL")).unionByName(tops.select("shard", *_names(NODE)))
    ended = rounds[0].filter("kind = 2").select("node", "ends", "shard")
    hashed = ended.repartition("node").sortWithinPartitions("node", "shard").select("node", "ends").mapInArrow(
        _end_digests, "node binary, ends_sha256 string").withColumnRenamed("ends_sha256", "found")
    late = done.filter("ends_sha256 IS NULL").join(hashed, "node", "left").withColumn("ends_sha256", F.coalesce("found", F.lit(EMPTY)))
    return done.filter("ends_sha256 IS NOT NULL").select(*FINAL).unionByName(late.select(*FINAL))


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def rebuild(conversations: DataFrame, every: int, most: int, heads: Callable[[str], Column]) -> DataFrame:
    """Every conversation c with its first h turns taken from conversation
    c - c % ``every`` (all it has, if fewer; none if it is absent), then its own turns
    after its first h. ``heads`` gives h, ``most`` at most, from the name of the id column."""
    base = conversations.filter(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("base_id"), F.slice("turns", 1, most).alias("opening"))
    h = heads("conv_id").cast("int")
    joined = conversations.withColumn("base_id", F.col("conv_id") - F.col("conv_id") % every).join(base, "base_id", "left")
    own = F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))
    opening = F.coalesce(F.slice("opening", F.lit(1), h), F.slice("turns", 1, 0))
    return joined.select("conv_id", F.concat(opening, own).alias("turns"))
