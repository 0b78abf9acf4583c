"""Near-duplicate embeddings by NN-descent: a neighbour graph refined by joins of neighbours' neighbours.

Every distinct vector of a label is a node with a list of its best neighbours. Lists begin with what
meets in windows of several random orders (by signs of random projections). In each round a node
sends its vector to pivots, the nodes of its list, and those that meet at a pivot, neighbours of one
neighbour, are compared; better neighbours go into the lists. A list that is full of links is
saturated and gets longer, so no link that was found is given up. A pivot at which many meet is
split into tiles of its members. Rounds go on until no more links come and an audit, a sample of
nodes held against all vectors of their label, finds the recall that was asked for.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from .common import U64, batch, mixed, staged
from .simhash import connected_components

THRESHOLD = 0.93
#: Neighbours in a list that is not saturated, and how much longer a saturated one gets at once.
NEIGHBOURS, LONGER = 10, 4
#: Random orders to begin with, and rows of a window, half of which the next window has too.
ORDERS, WINDOW = 6, 64
#: Pivots of a node with a longer list, besides itself; members that meet at a pivot before it is split.
PIVOTS, TILE = 3, 256
#: Nodes that are audited, and the share of their links that must have been found.
AUDITED, RECALL = 1024, 0.97
#: Rounds at most before an audit, if they go on finding links, and audits at most.
ROUNDS, AUDITS = 12, 4
#: Entries of lists that a task merges, and updates that a task holds.
MERGED, HELD = 1 << 20, 1 << 20

log = logging.getLogger(__name__)


@dataclass
class Audit:
    """Recall of links of `sampled` nodes, which have `links`; rounds made until then."""

    sampled: int
    links: int
    recall: float
    rounds: int


def units(vectors: list[bytes], kind: str) -> np.ndarray:
    """Vectors of one length as rows of length 1, in double precision."""
    x = np.frombuffer(b"".join(vectors), kind).reshape(len(vectors), -1).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column, and how many each row has."""
    return column.flatten().to_numpy(zero_copy_only=False), pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)


_NODE = "id long, label string, dim int, size long, low_id long, vector binary"
_UPDATE = pa.schema([("bucket", pa.int32()), ("owner", pa.list_(pa.int64())), ("other", pa.list_(pa.int64())), ("sim", pa.list_(pa.float64())), ("size", pa.list_(pa.int64()))])
_UPDATE_DDL = "bucket int, owner array<long>, other array<long>, sim array<double>, size array<long>"
_STATE = pa.schema([("id", pa.int64()), ("label", pa.string()), ("dim", pa.int32()), ("size", pa.int64()), ("low_id", pa.int64()), ("vector", pa.binary()), ("cap", pa.int64()), ("worst", pa.float64()), ("links", pa.int64()), ("new", pa.int64()), ("new_links", pa.int64()), ("ids", pa.list_(pa.int64())), ("sims", pa.list_(pa.float64())), ("sizes", pa.list_(pa.int64())), ("since", pa.list_(pa.int32()))])
_STATE_DDL = f"{_NODE}, cap long, worst double, links long, new long, new_links long, ids array<long>, sims array<double>, sizes array<long>, since array<int>"


class Updates:
    """Entries for lists, gathered and given out by buckets of their owners."""

    def __init__(self, buckets: int):
        self.buckets, self.held, self.n = buckets, [], 0

    def add(self, owner: np.ndarray, other: np.ndarray, sim: np.ndarray, size: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(owner):
            self.held.append((owner, other, sim, size))
            self.n += len(owner)
        if self.n >= HELD:
            yield from self.rows()

    def meet(self, x: np.ndarray, ids: np.ndarray, sizes: np.ndarray, worst: np.ndarray, threshold: float, neighbours: int, fresh: np.ndarray | None = None, sides: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
        """Compare vectors with each other: each gets those that are better than its worst neighbour, or links; of the first the best `neighbours`, as no list takes more. fresh: a pair has one of these at least; sides: a pair has one of either."""
        sim = x @ x.T
        wanted = (sim > worst[:, None]) | (sim >= threshold)
        np.fill_diagonal(wanted, False)
        if fresh is not None:
            wanted &= fresh[:, None] | fresh
        if sides is not None:
            wanted &= sides[:, None] != sides
        if len(x) > neighbours:
            best = np.where(wanted, sim, -np.inf)
            wanted &= (sim >= np.partition(best, len(x) - neighbours, axis=1)[:, len(x) - neighbours, None]) | (sim >= threshold)
        a, b = np.nonzero(wanted)
        yield from self.add(ids[a], ids[b], sim[a, b], sizes[b])

    def rows(self) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        owner, other, sim, size = (np.concatenate([h[k] for h in self.held]) for k in range(4))
        self.held, self.n = [], 0
        bucket = mixed(owner.view(U64)) % U64(self.buckets)
        order = np.lexsort((other, owner, bucket))
        again = np.r_[False, (owner[order][1:] == owner[order][:-1]) & (other[order][1:] == other[order][:-1])]
        order = order[~again]
        edge = np.r_[np.flatnonzero(np.r_[True, np.diff(bucket[order]) != 0]), len(order)]
        for a, b in zip(edge[:-1], edge[1:], strict=True):
            at = order[a:b]
            yield batch(_UPDATE, [int(bucket[at[0]])], *([c[at]] for c in (owner, other, sim, size)))


def nodes(vectors: DataFrame, vec_id: str, embedding: str, label: str) -> DataFrame:
    """The distinct usable vectors of each label, staged: id, label, dim, size (rows), low_id (smallest vec_id), vector as bytes and key, the array."""
    kind = "<f4" if isinstance(vectors.schema[embedding].dataType.elementType, FloatType) else "<f8"
    rows = vectors.where(usable(embedding, label)).groupBy(F.col(label).cast("string").alias("label"), F.col(embedding).alias("key")).agg(F.count("*").alias("size"), F.min(vec_id).alias("low_id"))
    element = "float" if kind == "<f4" else "double"
    rows = rows.select("label", F.col("key").cast(f"array<{element}>").alias("key"), "size", F.col("low_id").cast("long").alias("low_id"), F.monotonically_increasing_id().alias("id"))
    schema = pa.schema([("id", pa.int64()), ("label", pa.string()), ("dim", pa.int32()), ("size", pa.int64()), ("low_id", pa.int64()), ("vector", pa.binary()), ("key", pa.list_(pa.float32() if kind == "<f4" else pa.float64()))])

    def work(batches):
        for b in batches:
            values, n = _flat(b.column("key"))
            raw, to = values.astype(kind).tobytes(), np.cumsum(n) * np.dtype(kind).itemsize
            cut = [raw[e - s * np.dtype(kind).itemsize : e] for e, s in zip(to.tolist(), n.tolist(), strict=True)]
            yield batch(schema, b.column("id"), b.column("label"), n.astype(np.int32), b.column("size"), b.column("low_id"), cut, b.column("key").cast(schema.field("key").type))

    return staged(staged(rows, "distinct").mapInArrow(work, f"{_NODE}, key array<{element}>"), "nodes")


def usable(embedding: str, label: str):
    """Whether a vector may have links: label and vector are there, all components are finite, and not all are zero."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return F.coalesce(F.col(label).isNotNull() & F.forall(embedding, finite) & F.exists(embedding, lambda x: x != 0), F.lit(False))


def windows(found: DataFrame, kind: str, threshold: float, neighbours: int, orders: int, seed: int, buckets: int) -> DataFrame:
    """Updates of what meets in windows of random orders: by label, then the signs of 60 random projections."""
    row = pa.schema([("turn", pa.int32()), ("label", pa.string()), ("dim", pa.int32()), ("code", pa.int64()), ("id", pa.int64()), ("size", pa.int64()), ("vector", pa.binary())])

    def codes(batches):
        for b in batches:
            dims = b.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                part = b.filter(pa.array(dims == dim))
                x = units(part.column("vector").to_pylist(), kind)
                for turn in range(orders):
                    bits = x @ np.random.default_rng([seed, turn, dim]).standard_normal((dim, 60)) > 0
                    code = (bits.astype(np.int64) << np.arange(59, -1, -1)).sum(axis=1)
                    yield batch(row, np.full(len(x), turn, np.int32), part.column("label"), part.column("dim"), code, part.column("id"), part.column("size"), part.column("vector"))

    def meet(batches):
        out, held, now = Updates(buckets), [], None

        def window():
            yield from out.meet(units([h[2] for h in held], kind), np.array([h[0] for h in held]), np.array([h[1] for h in held]), np.full(len(held), -2.0), threshold, neighbours)

        for b in batches:
            for turn, label, dim, own, size, vector in zip(*(b.column(c).to_pylist() for c in ("turn", "label", "dim", "id", "size", "vector")), strict=True):
                if (turn, label, dim) != now or len(held) == WINDOW:
                    if len(held) > 1:
                        yield from window()
                    held, now = held[WINDOW // 2 :] if (turn, label, dim) == now else [], (turn, label, dim)
                held.append((own, size, vector))
        if len(held) > 1:
            yield from window()
        yield from out.rows()

    rows = found.select("id", "label", "dim", "size", "vector").mapInArrow(codes, "turn int, label string, dim int, code long, id long, size long, vector binary")
    order = ["turn", "label", "dim", "code", "id"]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(meet, _UPDATE_DDL)


def merged(state: DataFrame, updates: DataFrame, turn: int, buckets: int, threshold: float, neighbours: int) -> DataFrame:
    """Lists with their updates: the best `neighbours` and all links of a node, for which a saturated list gets longer."""

    def merge(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.combine_chunks().sort_by("id")
        if not left.num_rows:
            return _STATE.empty_table()
        own = left.to_batches()[0]
        ids, n = own.column("id").to_numpy(), pc.list_value_length(own.column("ids")).to_numpy(zero_copy_only=False).astype(np.int64)
        old = [own.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("ids", "sims", "sizes", "since")]
        new = [np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in right.column(k).chunks] or [np.empty(0, t)]) for k, t in (("owner", np.int64), ("other", np.int64), ("sim", np.float64), ("size", np.int64))]
        owner = np.concatenate([np.repeat(np.arange(len(ids)), n), np.searchsorted(ids, new[0])])
        other, sim, size = (np.concatenate([a, b]) for a, b in zip(old[:3], new[1:], strict=True))
        since = np.concatenate([old[3], np.full(len(new[0]), turn, np.int32)])
        order = np.lexsort((since, other, owner))
        order = order[np.r_[True, (owner[order][1:] != owner[order][:-1]) | (other[order][1:] != other[order][:-1])]] if len(order) else order
        order = order[np.lexsort((other[order], -sim[order], owner[order]))]
        owner, other, sim, size, since = (c[order] for c in (owner, other, sim, size, since))
        link = sim >= threshold
        links = np.bincount(owner[link], minlength=len(ids))
        cap = own.column("cap").to_numpy().copy()
        while (full := links >= np.maximum(cap, 1)).any():
            cap[full] = np.maximum(cap[full], 1) * LONGER
        rank = np.arange(len(owner)) - np.searchsorted(owner, owner)
        keep = link | (rank < neighbours)
        owner, other, sim, size, since, link = (c[keep] for c in (owner, other, sim, size, since, link))
        n = np.bincount(owner, minlength=len(ids))
        edge = np.r_[0, np.cumsum(n)]
        worst = np.full(len(ids), -2.0)
        some = n >= neighbours
        worst[some] = sim[edge[:-1][some] + neighbours - 1] if neighbours else threshold
        fresh = since == turn
        lists = [pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(c, t)) for c, t in zip((other, sim, size, since), (pa.int64(), pa.float64(), pa.int64(), pa.int32()), strict=True)]
        counts = [np.bincount(owner[m], minlength=len(ids)) for m in (fresh, fresh & link)]
        return pa.Table.from_batches([batch(_STATE, *(own.column(c) for c in _STATE.names[:6]), cap, worst, links, *counts, *lists)])

    hashed = state.mapInArrow(_bucketed(buckets), f"{_STATE_DDL}, bucket int")
    return hashed.groupBy("bucket").cogroup(updates.groupBy("bucket")).applyInArrow(merge, _STATE_DDL)


def _bucketed(buckets: int):
    def work(batches):
        for b in batches:
            bucket = (mixed(b.column("id").to_numpy().view(U64)) % U64(buckets)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(bucket)], names=[*b.schema.names, "bucket"])

    return work


def joined(state: DataFrame, kind: str, turn: int, buckets: int, threshold: float, neighbours: int) -> DataFrame:
    """Updates of the neighbours of each pivot, compared with each other."""
    push = pa.schema([("pivot", pa.int64()), ("id", pa.int64()), ("size", pa.int64()), ("worst", pa.float64()), ("fresh", pa.bool_()), ("vector", pa.binary())])

    def pivots(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, pivot and whether the row is new there: all neighbours; of a list with more than these links, those with the least hashes, which nodes with like lists share."""
        ids, links = b.column("id").to_numpy(), b.column("links").to_numpy()
        (other, n), since = _flat(b.column("ids")), b.column("since").flatten().to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(ids)), n)
        many = links > neighbours
        stirred = b.column("new_links").to_numpy() > 0
        rows, at = np.r_[row, np.arange(len(ids))], np.r_[other, ids]
        h = mixed(at.view(U64) ^ U64(turn * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        is_link = np.r_[np.arange(len(row)) - (np.cumsum(n) - n)[row] < links[row], np.ones(len(ids), bool)]
        order = np.lexsort((h, ~is_link, rows))
        rank = np.empty(len(rows), np.int64)
        rank[order] = np.arange(len(rows)) - np.searchsorted(rows[order], rows[order])
        own = np.arange(len(rows)) >= len(row)
        chosen = np.where(many[rows], rank < PIVOTS, True) | own
        fresh = np.where(many[rows], stirred[rows], np.r_[since == turn - 1, np.zeros(len(ids), bool)])
        return rows[chosen], at[chosen], fresh[chosen]

    def places(batches):
        for b in batches:
            yield batch(pa.schema([("pivot", pa.int64())]), pivots(b)[1])

    def sent(batches):
        for b in batches:
            for k in range(0, b.num_rows, 1024):
                part = b.slice(k, 1024)
                row, at, fresh = pivots(part)
                take = pa.array(row)
                yield batch(push, at, *(part.column(c).take(take) for c in ("id", "size", "worst")), fresh, part.column("vector").take(take))

    def meet(batches):
        out, held = Updates(buckets), None
        for b in batches:
            b = pa.Table.from_batches([*held, b]).combine_chunks().to_batches()[0] if held else b
            key = np.stack([b.column(c).to_numpy() for c in ("pivot", "i", "j")])
            edge = np.r_[np.flatnonzero(np.r_[True, (key[:, 1:] != key[:, :-1]).any(axis=0)]), b.num_rows]
            for s, e in zip(edge[:-2], edge[1:-1], strict=True):
                yield from group(out, b.slice(s, e - s))
            held = [b.slice(edge[-2])]
        if held:
            yield from group(out, held[0])
        yield from out.rows()

    def group(out: Updates, b: pa.RecordBatch):
        fresh = b.column("fresh").to_numpy(zero_copy_only=False)
        if b.num_rows < 2 or not fresh.any():
            return
        i, j = b.column("i")[0].as_py(), b.column("j")[0].as_py()
        sides = b.column("side").to_numpy(zero_copy_only=False) if i != j else None
        yield from out.meet(units(b.column("vector").to_pylist(), kind), *(b.column(c).to_numpy() for c in ("id", "size", "worst")), threshold, neighbours, fresh, sides)

    slim = state.select("id", "links", "new_links", "ids", "since")
    heavy = slim.mapInArrow(places, "pivot long").groupBy("pivot").agg(F.count("*").alias("n")).where(F.col("n") > TILE).select("pivot", F.ceil(F.col("n") / TILE).cast("int").alias("tiles"))
    rows = state.select("id", "size", "worst", "links", "new_links", "vector", "ids", "since").mapInArrow(sent, "pivot long, id long, size long, worst double, fresh boolean, vector binary")
    rows = rows.join(heavy, "pivot", "left").withColumn("c", F.coalesce(F.pmod(F.xxhash64("id"), "tiles").cast("int"), F.lit(0)))
    rows = rows.withColumn("o", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("tiles") - 1, F.lit(0)))))
    rows = rows.select("pivot", F.least("c", "o").alias("i"), F.greatest("c", "o").alias("j"), (F.col("c") < F.col("o")).alias("side"), "id", "size", "worst", "fresh", "vector")
    return rows.repartition("pivot", "i", "j").sortWithinPartitions("pivot", "i", "j").mapInArrow(meet, _UPDATE_DDL)


def audited(state: DataFrame, kind: str, threshold: float, sample: int, rounds: int) -> Audit:
    """Links of a sample of nodes, by the least hashes, against all vectors of their label. At most `sample` vectors come to the driver."""
    picked = state.orderBy(F.xxhash64("id"), "id").limit(sample).select("id", "label", "dim", "vector", "links").collect()
    groups: dict = {}
    for r in picked:
        groups.setdefault((r.label, r.dim), []).append((r.id, bytes(r.vector)))
    schema = pa.schema([("n", pa.int64())])

    def work(batches):
        total = 0
        for b in batches:
            of, ids = np.array(list(zip(b.column("label").to_pylist(), b.column("dim").to_pylist(), strict=True)), dtype=object), b.column("id").to_numpy()
            for (label, dim), asked in groups.items():
                mine = np.flatnonzero((of[:, 0] == label) & (of[:, 1] == dim)) if len(of) else []
                if len(mine):
                    x, y = units(b.column("vector").take(pa.array(mine)).to_pylist(), kind), units([v for _, v in asked], kind)
                    total += int(((x @ y.T >= threshold) & (ids[mine][:, None] != np.array([i for i, _ in asked]))).sum())
        yield batch(schema, [total])

    true = state.select("id", "label", "dim", "vector").mapInArrow(work, "n long").agg(F.sum("n")).first()[0] or 0
    found = sum(r.links for r in picked)
    return Audit(len(picked), true, found / true if true else 1.0, rounds)


def graph(found: DataFrame, kind: str, threshold: float = THRESHOLD, neighbours: int = NEIGHBOURS, orders: int = ORDERS, sample: int = AUDITED, recall: float = RECALL, seed: int = 42) -> tuple[DataFrame, Audit]:
    """The neighbour lists of `nodes`, and the audit that ended the work; raises if recall is still below 0.9 after `AUDITS` audits."""
    n = found.count()
    empty = [F.lit(neighbours).cast("long").alias("cap"), F.lit(-2.0).alias("worst"), *(F.lit(0).cast("long").alias(c) for c in ("links", "new", "new_links")), *(F.array().cast(f"array<{t}>").alias(c) for c, t in (("ids", "long"), ("sims", "double"), ("sizes", "long"), ("since", "int")))]
    state = found.select("id", "label", "dim", "size", "low_id", "vector", *empty)
    links, turn, made = 0, 0, None
    for audit in range(AUDITS):
        for k in range(ROUNDS):
            # a node meets others in two windows of each order, or at its pivots
            buckets = max(8, -(-(n * neighbours * (2 * orders if k == 0 else neighbours + 1) + links * (PIVOTS + 1)) // MERGED))
            updates = windows(found, kind, threshold, neighbours, orders, seed + audit, buckets) if k == 0 else joined(state, kind, turn, buckets, threshold, neighbours)
            state = staged(merged(state, updates, turn, buckets, threshold, neighbours), "neighbours")
            turn += 1
            links, new, new_links = state.agg(F.sum("links"), F.sum("new"), F.sum("new_links")).first()
            links = links or 0
            log.info("round %s: %s links, %s of them and %s neighbours new", turn, links, new_links, new)
            if k and not new_links or not n:
                break
        made = audited(state, kind, threshold, sample, turn)
        log.info("audit: %s", made)
        if made.recall >= recall:
            break
    if made.recall < 0.9:
        raise ValueError(f"NN-descent found {made.recall:.3f} of the links of {made.sampled} nodes; more orders or neighbours are needed")
    return state, made


def near_groups(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", threshold: float = THRESHOLD, **how) -> DataFrame:
    """vec_id, n_links, component_id, kept: every row, with links of cosine `threshold` or more within its label; `how` as in `graph`.

    component_id is the smallest vec_id reachable, null only if none of the component's has one; kept: the
    row has that vec_id (null for null). Vectors that are null, zero or hold null or non-finite
    components, and those without label, have no links and are kept. Vectors of different lengths have no links.
    Rows alike in label and vector are links of each other; they are one node, and never listed as pairs.
    Repeated vec_ids are rows of their own. No rows give no rows. A node's links are held by one task.
    """
    vectors = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("embedding"), F.col(label).cast("string").alias("label"))
    kind = "<f4" if isinstance(vectors.schema["embedding"].dataType.elementType, FloatType) else "<f8"
    found = nodes(vectors, "vec_id", "embedding", "label")
    state, _ = graph(found, kind, threshold, **how)
    n, links = state.agg(F.count("*"), F.sum("links")).first()
    buckets = max(8, -(-((links or 0) * 2 + n) // MERGED))

    def turned(batches):
        out = Updates(buckets)
        for b in batches:
            (other, n), sim = _flat(b.column("ids")), b.column("sims").flatten().to_numpy(zero_copy_only=False)
            row, link = np.repeat(np.arange(b.num_rows), n), sim >= threshold
            yield from out.add(other[link], b.column("id").to_numpy()[row[link]], sim[link], b.column("size").to_numpy()[row[link]])
        yield from out.rows()

    both = staged(merged(state, state.select("id", "size", "ids", "sims").mapInArrow(turned, _UPDATE_DDL), 0, buckets, threshold, 0), "links")
    edge = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def forest(batches):
        """Each node of these lists with the least node that they connect it with."""
        for b in batches:
            other, n = _flat(b.column("ids"))
            if len(other):
                ids, place = np.unique(np.r_[np.repeat(b.column("id").to_numpy(), n), other], return_inverse=True)
                u, w, low = place[: len(other)], place[len(other) :], np.arange(len(ids))
                while True:
                    before = low.copy()
                    np.minimum.at(low, u, low[w])
                    np.minimum.at(low, w, low[u])
                    low = low[low]
                    if (low == before).all():
                        break
                mine = np.flatnonzero(low != np.arange(len(ids)))
                yield batch(edge, ids[mine], ids[low[mine]])

    roots = connected_components(both.select("id", "ids").mapInArrow(forest, "a long, b long"))
    linked = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x) + F.col("size") - 1
    named = both.select("id", "low_id", linked.alias("n_links")).join(roots, F.col("id") == F.col("node"), "left").withColumn("root", F.coalesce("root", "id"))
    least = named.groupBy("root").agg(F.min("low_id").alias("component_id"))
    groups = named.join(least, "root").select("id", "n_links", "component_id")
    classes = staged(found.select("id", F.col("label").alias("l"), "key").join(groups, "id"), "classes")
    good = vectors.where(usable("embedding", "label"))
    same = (F.col("label") == F.col("l")) & (F.col("embedding") == F.col("key"))
    out = good.join(classes, same).select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))
    alone = vectors.where(~usable("embedding", "label")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), (F.col("vec_id") == F.col("vec_id")).alias("kept"))
    return out.unionByName(alone)
