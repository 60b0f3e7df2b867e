"""The prefix trie of rebuilt conversations, by composable fingerprints.

A sequence of turns is fingerprinted by the product of its turns in the monoid of maps ``x -> B x + t`` modulo
a prime of 127 bits. Products compose: a rebuilt conversation is a head of its base conversation and its
own turns after the head, so with ``V`` the product of its own first turns, the fingerprint of a rebuilt prefix is
``V + (head - own head) B**(turns - h)``. Only that one correction is kept for each conversation; rebuilt texts, and
even the lists of rebuilt turns, are never made. The products of own turns are a scan over turns in order:
each task scans its range of the sorted turns, and the products of ranges are composed for conversations that
span tasks.

Rows of one depth and fingerprint are a node. Its members are verified by the turns they refer to: a turn is
known by the SHA-256 of its role and text, and if all groups agree on their last turn, then (the fingerprint
and the last turn give that of the parent) all groups agree on all turns. Otherwise another ``B`` is taken.

What a node says of its subtree comes from sums over its members, without a walk through the trie. Each
node is represented by its smallest member. Along a conversation's path the nodes it represents are the last
ones, so sums over the distinct nodes of a subtree are sums of what its members represent.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabularium.llm.common import join_sized, stage

PRIME = (1 << 127) - 1
#: Conversations whose id differs only by the remainder of this share a base; heads have fewer than ``HEADS`` turns.
SHARED = 20
HEADS = 4
#: Ids that are joined to one piece of a node's list before it is hashed.
_PIECE = 512
_WORDS = r"[^\x20\x09-\x0D]+"
_NODE = ["depth", "f1", "f2"]


def multiplier(attempt: int) -> int:
    """The ``B`` of an attempt."""
    return int.from_bytes(hashlib.sha256(f"prefix trie {attempt}".encode()).digest(), "big") % (PRIME - 2) + 2


def turn_value(ref: bytes) -> int:
    """The number of a turn."""
    return int.from_bytes(ref, "big") % PRIME


def _binary(x: int) -> bytes:
    return x.to_bytes(16, "big")


def _halves(x: int) -> tuple[int, int]:
    """A fingerprint as two numbers of 64 bits with sign."""
    low = x & (1 << 64) - 1
    return x >> 64, low - (low >> 63 << 64)


class _Powers:
    """Powers of a number; the first of them are remembered."""

    def __init__(self, base: int):
        self.base, self.held = base, [1]

    def __call__(self, n: int) -> int:
        if n >= 1 << 16:
            return pow(self.base, n, PRIME)
        held = self.held
        while len(held) <= n:
            held.append(held[-1] * self.base % PRIME)
        return held[n]


# Own turns -------------------------------------------------------------------------------------------


def _turns(conversations: DataFrame) -> DataFrame:
    """The turns without their texts."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    named = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), F.unhex(F.sha2(named, 256)).alias("ref"),
        F.regexp_count(text, F.lit(_WORDS)).cast("long").alias("words"), F.monotonically_increasing_id().alias("read"),
    )


def _scan(turns: DataFrame, base: int) -> DataFrame:
    """Turns with their place in the task's part of the conversation, and the product and words of that part so far.

    ``kind`` is 0 for turns; 1 and 2 are the sums of the first and the last conversation of a task.
    """
    schema = pa.schema([
        ("kind", pa.int32()), ("part", pa.int32()), ("conv_id", pa.int64()), ("at", pa.int64()), ("value", pa.binary()),
        ("ref", pa.binary()), ("words", pa.int64()), ("total", pa.int64()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        conv, n, v, w, first = None, 0, 0, 0, None
        for batch in batches:
            out = []
            for c, ref, words in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if c != conv:
                    first = first or (conv is not None and (1, part, conv, n, _binary(v), None, None, w)) or None
                    conv, n, v, w = c, 0, 0, 0
                v = (v * base + turn_value(ref)) % PRIME
                w += words
                out.append((0, part, c, n, _binary(v), ref, words, w))
                n += 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
        if conv is not None:
            last = (2, part, conv, n, _binary(v), None, None, w)
            out = [first or (1, *last[1:]), last]
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    keys = ["conv_id", "turn", "role", "ref", "read"]
    ordered = turns.repartitionByRange(*keys).sortWithinPartitions(*keys).select("conv_id", "ref", "words")
    return ordered.mapInArrow(run, "kind int, part int, conv_id long, at long, value binary, ref binary, words long, total long")


def _carried(scan: DataFrame, base: int) -> DataFrame:
    """``part, conv_id, n0, v0, w0``: what earlier tasks know of the first conversation of a task. Two rows of each task are gathered."""
    power = _Powers(base)
    edges: dict[int, dict] = {}
    for r in scan.where("kind > 0").select("kind", "part", "conv_id", "at", "value", "total").collect():
        edges.setdefault(r["part"], {})[r["kind"]] = (r["conv_id"], r["at"], int.from_bytes(r["value"], "big"), r["total"])
    out, held = [], None
    for part in sorted(edges):
        first, last = edges[part][1], edges[part][2]
        if held and held[0] == first[0]:
            out.append((part, held[0], held[1], _binary(held[2]), held[3]))
            first = (first[0], held[1] + first[1], (held[2] * power(first[1]) + first[2]) % PRIME, held[3] + first[3])
        held = first if first[0] == last[0] else last
    return scan.sparkSession.createDataFrame(out, "part int, conv_id long, n0 long, v0 binary, w0 long")


def _placed(scan: DataFrame, carried: DataFrame) -> DataFrame:
    rows = scan.where("kind = 0").join(F.broadcast(carried), ["part", "conv_id"], "left")
    place = (F.col("at") + F.coalesce("n0", F.lit(0))).alias("place")
    return rows.select("conv_id", place, "at", "value", "v0", "ref", "words", (F.col("total") + F.coalesce("w0", F.lit(0))).alias("total"))


# Conversations ---------------------------------------------------------------------------------------


def _head_length(conv_id: str) -> Column:
    return (F.crc32(F.col(conv_id).cast("string").cast("binary")) % HEADS).cast("int")


def _conversations(placed: DataFrame, base: int) -> DataFrame:
    """A row of each conversation: its turns and words when rebuilt, its correction, and the turns of its head."""
    first = [F.max(F.when(F.col("place") == k, F.struct("ref", "words"))).alias(f"t{k}") for k in range(HEADS - 1)]
    kept = F.sum(F.when(F.col("place") >= _head_length("conv_id"), F.col("words")).otherwise(0)).alias("own_words")
    convs = stage(placed.groupBy("conv_id").agg((F.max("place") + 1).alias("n_own"), kept, *first), "conversations")
    heads = convs.where(F.col("conv_id") % SHARED == 0).select(
        F.col("conv_id").alias("base"), F.col("n_own").alias("n_base"), F.array("t0", "t1", "t2").alias("base_turns"),
    )
    rows = convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % SHARED).withColumn("h", _head_length("conv_id"))
    rows = rows.join(heads, "base", "left").withColumn("b", F.least("h", F.coalesce("n_base", F.lit(0))).cast("int"))
    none = F.array().cast("array<struct<ref:binary,words:bigint>>")
    head = F.coalesce(F.slice("base_turns", F.lit(1), F.col("b")), none)
    own = F.slice(F.array("t0", "t1", "t2"), F.lit(1), F.least("h", "n_own").cast("int"))
    words = lambda turns: F.aggregate(turns, F.lit(0).cast("long"), lambda a, t: a + t["words"])
    rows = rows.select(
        "conv_id", "n_own", "h", "b", (F.col("b") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))).alias("n_turns"),
        (words(head) + F.col("own_words")).alias("tokens"), (words(head) - words(own)).alias("moved"),
        head["ref"].alias("head"), head["words"].alias("head_words"), own["ref"].alias("own"),
    )
    target = pa.schema([("conv_id", pa.int64()), ("n_own", pa.int64()), ("h", pa.int32()), ("b", pa.int32()), ("n_turns", pa.int64()), ("tokens", pa.int64()),
                        ("moved", pa.int64()), ("head", pa.list_(pa.binary())), ("head_words", pa.list_(pa.int64())),
                        ("head_values", pa.list_(pa.binary())), ("shift", pa.binary())])
    back = pow(base, -1, PRIME)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, shifts = [], []
            for head_refs, own_refs in zip(batch.column("head").to_pylist(), batch.column("own").to_pylist(), strict=True):
                v, line, mine = 0, [], 0
                for ref in head_refs:
                    v = (v * base + turn_value(ref)) % PRIME
                    line.append(_binary(v))
                for ref in own_refs:
                    mine = (mine * base + turn_value(ref)) % PRIME
                values.append(line)
                shifts.append(_binary((v - mine) * pow(back, len(own_refs), PRIME) % PRIME))
            columns = {c: batch.column(c) for c in batch.schema.names} | {"head_values": values, "shift": shifts}
            yield pa.RecordBatch.from_arrays([c if isinstance(c := columns[f.name], pa.Array) and c.type == f.type else _cast(c, f.type) for f in target], schema=target)

    schema = (
        "conv_id long, n_own long, h int, b int, n_turns long, tokens long, moved long, head array<binary>, "
        "head_words array<long>, head_values array<binary>, shift binary"
    )
    return stage(rows.mapInArrow(run, schema), "rebuilt")


def _cast(values, kind: pa.DataType) -> pa.Array:
    return values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, kind)


# Rebuilt turns and nodes -----------------------------------------------------------------------------


def _members(placed: DataFrame, convs: DataFrame, base: int) -> DataFrame:
    """``conv_id, depth, f1, f2, p1, p2, r1 to r4, words, before, ends``: each rebuilt prefix with its fingerprint and that of
    its parent, its last turn, the words of that and of all turns before, and whether the conversation ends here."""
    sizes = convs.select("conv_id", "shift", "h", "b", "n_turns", "moved", "n_own")
    total = sizes.agg(F.sum("n_own")).first()[0] or 0
    own = join_sized(placed.where(F.col("place") >= _head_length("conv_id")), sizes, "conv_id", "n_own", total)
    own = own.withColumn("depth", F.col("place") - F.col("h") + F.col("b") + 1).select(
        "conv_id", "depth", "place", "at", "value", "v0", "shift", "ref", "words", (F.col("total") - F.col("words") + F.col("moved")).alias("before"),
        (F.col("depth") == F.col("n_turns")).alias("ends"),
    )
    spot = F.posexplode(F.arrays_zip("head_values", "head", "head_words")).alias("k", "t")
    heads = convs.select("conv_id", "n_turns", "head_words", spot).select(
        "conv_id", (F.col("k") + 1).cast("long").alias("depth"), F.lit(None).cast("long").alias("place"), F.lit(None).cast("long").alias("at"),
        F.col("t.head_values").alias("value"), F.lit(None).cast("binary").alias("v0"), F.lit(None).cast("binary").alias("shift"),
        F.col("t.head").alias("ref"), F.col("t.head_words").alias("words"),
        F.aggregate(F.slice("head_words", F.lit(1), F.col("k")), F.lit(0).cast("long"), lambda a, x: a + x).alias("before"),
        (F.col("k") + 1 == F.col("n_turns")).alias("ends"),
    )
    zero = F.lit(0).cast("long")
    root = convs.select(
        "conv_id", zero.alias("depth"), *(F.lit(0 if c in ("f1", "f2") or c[0] == "r" else None).cast("long").alias(c) for c in _KEYS),
        zero.alias("words"), zero.alias("before"), (F.col("n_turns") == 0).alias("ends"),
    )
    back = pow(base, -1, PRIME)
    target = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), *((c, pa.int64()) for c in _KEYS), ("words", pa.int64()), ("before", pa.int64()), ("ends", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        power = _Powers(base)
        for batch in batches:
            out = []
            for place, at, value, v0, shift, ref in zip(*(batch.column(c).to_pylist() for c in ("place", "at", "value", "v0", "shift", "ref")), strict=True):
                v = int.from_bytes(value, "big")
                if v0 is not None:
                    v += int.from_bytes(v0, "big") * power(at + 1)
                if shift is not None:
                    v += int.from_bytes(shift, "big") * power(place + 1)
                v %= PRIME
                parent = (v - turn_value(ref)) * back % PRIME
                out.append((*_halves(v), *_halves(parent), *(int.from_bytes(ref[i : i + 8], "big", signed=True) for i in range(0, 32, 8))))
            keys = [pa.array(x, pa.int64()) for x in zip(*out, strict=True)] or [pa.array([], pa.int64())] * len(_KEYS)
            rest = [_cast(batch.column(c), target.field(c).type) for c in ("words", "before", "ends")]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), _cast(batch.column("depth"), pa.int64()), *keys, *rest], schema=target)

    schema = "conv_id long, depth long, " + ", ".join(f"{c} long" for c in _KEYS) + ", words long, before long, ends boolean"
    return stage(own.unionByName(heads).mapInArrow(run, schema).unionByName(root), "members")


_KEYS = ["f1", "f2", "p1", "p2", "r1", "r2", "r3", "r4"]


def _hashed_ends(members: DataFrame) -> DataFrame:
    """``depth, f1, f2, ends_sha256`` of the nodes where conversations end.

    Ids are sorted in ranges and joined to pieces there; the pieces of a node are then hashed one by one, in order.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids, out = None, [], []

        def row() -> tuple:
            return (*node, ids[0], ",".join(map(str, ids)))

        for batch in batches:
            for *key, conv in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if key != node or len(ids) == _PIECE:
                    if ids:
                        out.append(row())
                    node, ids = key, []
                ids.append(conv)
                if len(out) == _PIECE:
                    yield batch_of(out, piece)
                    out = []
        if ids:
            yield batch_of([*out, row()], piece)

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state, out = None, None, []
        for batch in batches:
            for *key, ids in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if key == node:
                    state.update(b",")
                else:
                    if state:
                        out.append((*node, state.hexdigest()))
                    node, state = key, hashlib.sha256()
                state.update(ids.encode())
            if out:
                yield batch_of(out, done)
                out = []
        if state:
            yield batch_of([(*node, state.hexdigest())], done)

    def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    key = [(c, pa.int64()) for c in _NODE]
    piece, done = pa.schema([*key, ("least", pa.int64()), ("ids", pa.string())]), pa.schema([*key, ("ends_sha256", pa.string())])
    ends = members.where("ends").select(*_NODE, "conv_id").repartitionByRange(*_NODE, "conv_id").sortWithinPartitions(*_NODE, "conv_id")
    joined = ends.mapInArrow(pieces, "depth long, f1 long, f2 long, least long, ids string")
    joined = joined.repartition(*_NODE).sortWithinPartitions(*_NODE, "least").select(*_NODE, "ids")
    return joined.mapInArrow(hashes, "depth long, f1 long, f2 long, ends_sha256 string")


def nodes(conversations: DataFrame) -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256`` of every node.

    Turns are ordered by ``turn``, nulls first; equal turns by role and the SHA-256 of role and text. Null role and
    text are empty. Rows with a null ``conv_id`` belong to no conversation and are left out. Repeated rows are
    turns of their own. Other columns are not read. An empty table gives an empty result.
    """
    turns = stage(_turns(conversations), "turns")
    for attempt in range(8):
        base = multiplier(attempt)
        scan = stage(_scan(turns, base), "products")
        placed = _placed(scan, _carried(scan, base))
        convs = _conversations(placed, base)
        members = _members(placed, convs, base)
        found, agree = _nodes(members)
        if agree:
            return _described(found, members, convs)
    raise RuntimeError("fingerprints of different conversations were equal in every attempt")


def _nodes(members: DataFrame) -> tuple[DataFrame, bool]:
    """A row of each node, and whether in every group all members have the same last turn."""
    refs = [c for c in _KEYS if c[0] == "r"]
    same = F.lit(True)
    for c in refs:
        same = same & (F.min(c) == F.max(c))
    kept = [F.min(c).alias(c) for c in ("conv_id", "p1", "p2", "words", "before")]
    found = stage(members.groupBy(*_NODE).agg(*kept, F.count("*").alias("n_convs"), same.alias("same")), "nodes")
    return found.drop("same"), found.where("not same").limit(1).count() == 0


def _described(found: DataFrame, members: DataFrame, convs: DataFrame) -> DataFrame:
    children = found.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("f1"), F.col("p2").alias("f2"))
    children = children.agg(F.count("*").alias("n_children"))
    found = stage(found.join(children, _NODE, "left").fillna(0, ["n_children"]), "nodes")
    # What each conversation represents: nodes from a depth on, their words, and a leaf or none.
    own = found.groupBy("conv_id").agg(
        F.min("depth").alias("since"), F.sum("words").alias("own_tokens"), F.sum((F.col("n_children") == 0).cast("long")).alias("own_leaves"),
    )
    facts = convs.select("conv_id", "tokens", (F.col("n_turns") + 1).alias("rows")).join(own, "conv_id", "left").fillna(0, ["own_tokens", "own_leaves"])
    facts = stage(facts, "facts")
    n = facts.agg(F.sum("rows")).first()[0] or 0
    rows = join_sized(members.select(*_NODE, "conv_id", "before"), facts, "conv_id", "rows", n)
    below = F.when(F.col("depth") >= F.col("since"), F.col("tokens") - F.col("before")).otherwise(F.col("own_tokens"))
    sums = rows.groupBy(*_NODE).agg(F.sum("tokens").alias("tokens"), F.sum("own_leaves").alias("n_leaves"), F.sum(below).alias("distinct"))
    whole = found.join(sums, _NODE).join(_hashed_ends(members), _NODE, "left")
    above = found.select((F.col("depth") + 1).alias("depth"), F.col("f1").alias("p1"), F.col("f2").alias("p2"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    n = found.agg(F.count("*")).first()[0]
    named = join_sized(found.where("depth > 0").select(*_NODE, "p1", "p2"), above.where("n_children > 0"), ["depth", "p1", "p2"], "n_children", n)
    return whole.join(named.select(*_NODE, "parent_conv_id"), _NODE, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        (F.col("tokens") - F.col("n_convs") * F.col("before") - F.col("distinct")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )
