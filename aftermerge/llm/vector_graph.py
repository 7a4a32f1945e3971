"""Near-duplicate vectors over a robust-pruned flat graph.

Vectors of a label are dealt into overlapping cluster shards: each goes to the two nearest of the
label's centres, which k-means finds on a bounded sample. A shard's task builds a flat graph over
its members (their nearest members, pruned by the robust rule, edges in both directions); the
graph of a label is the union of the lists that its shards give to a vector. Every vector searches
it: greedily from the medoids of a shard, by a beam, and then, from whatever lies in reach of the
threshold, on along the edges until nothing new does. A search that reaches a vector whose home is
another shard goes on there with that vector's list, in a next round. Cosines are taken in double
precision of the whole vectors, so no link below the threshold is given.

In every task a twentieth of the searches is audited against a scan of the task's vectors; if the
recall is below ``AUDITED``, all are searched anew with twice the beam, in the end by the scan.
``audit`` measures the recall of whole results against brute force.

Equal vectors are one node with a weight. Shards of more than ``BLOCK`` members are dealt into
blocks, and pairs of blocks are tasks, so a task holds two blocks at most. What is sent to the
driver and broadcast are centres only, at most ``SAMPLED_VALUES / SAMPLE_PER_CENTRE`` numbers.

Defined cases: a vector that is null, zero, or holds null or non-finite components, or whose label
is null, links with nothing; vectors of different lengths don't link; repeated rows link with each
other; a null id comes last in the choice of a component's id, and is its own where alone; an
empty table gives an empty result; other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aftermerge.llm.common import by_group, stage
from aftermerge.llm.near_duplicates import _roots, components

THRESHOLD = 0.93
#: How far below the threshold a search still goes on along the edges.
SLACK = 0.05

#: Vectors that have their home in a shard, on the whole; members of a task's block at most.
SHARD = 2048
BLOCK = 8192
#: Numbers in the sample that centres are found on (32,768 vectors of 64), and sampled vectors for
#: each centre: so there are at most 4,096 centres of 64 numbers.
SAMPLED_VALUES = 1 << 21
SAMPLE_PER_CENTRE = 8

#: Nearest members that a list is pruned from, the edges it keeps, and the pruning factor.
NEAREST, EDGES, ALPHA = 32, 16, 1.2
#: Vectors held open by a search; hits from which a search scans the task's vectors instead.
BEAM, CROWDED = 16, 64
#: Recall that the searches of a task must show.
AUDITED = 0.99

_FOUND = "kind int, node long, links long, root long, shard int, wanted long, beam int"


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length one, in double precision."""
    wide = vectors.astype(np.float64)
    wide /= np.abs(wide).max(1, keepdims=True)  # so that no square overflows
    return wide / np.sqrt(np.einsum("ij,ij->i", wide, wide))[:, None]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    return unit(flat.flatten().to_numpy().reshape(len(flat), -1))


class Graph:
    """A flat graph over unit vectors."""

    def __init__(self, vectors: np.ndarray) -> None:
        self.vectors = vectors
        n = len(vectors)
        source, target = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for low in range(0, n, 256):
            i, j = self._list(np.arange(low, min(n, low + 256)))
            source += [i, j]
            target += [j, i]
        code = np.unique(np.concatenate(source) * n + np.concatenate(target))
        self.target = code % n
        self.first = np.searchsorted(code // n, np.arange(n + 1))
        self.entries = self._medoids(code // n)

    def _list(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The robust-pruned edges of some vectors: nearest first, a member is left out if a kept
        one is nearer to it, by the factor ``ALPHA``, than the vector itself."""
        n, k = len(self.vectors), min(NEAREST, len(self.vectors) - 1)
        if k < 1:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        near = self.vectors[rows] @ self.vectors.T
        near[np.arange(len(rows)), rows] = -np.inf
        at = np.argpartition(near, n - k, axis=1)[:, n - k :]
        own = np.take_along_axis(near, at, 1)
        order = np.argsort(-own, axis=1, kind="stable")
        at, own = np.take_along_axis(at, order, 1), 1 - np.take_along_axis(own, order, 1)
        some = self.vectors[at]
        apart = 1 - some @ some.transpose(0, 2, 1)
        alive, kept = np.ones(at.shape, bool), np.zeros(at.shape, bool)
        for c in range(k):
            take = alive[:, c] & (kept.sum(1) < EDGES)
            kept[:, c] = take
            alive &= ~(take[:, None] & (ALPHA**2 * apart[:, c, :] <= own))
        row, column = np.nonzero(kept)
        return rows[row], at[row, column]

    def _medoids(self, source: np.ndarray) -> np.ndarray:
        """The members nearest to the means of some clusters, and one in every part of the graph."""
        n = len(self.vectors)
        seeds = self.vectors[:: max(1, int(n**0.5))]
        cluster = np.concatenate([(self.vectors[k : k + 512] @ seeds.T).argmax(1) for k in range(0, n, 512)])
        means = np.zeros_like(seeds)
        np.add.at(means, cluster, self.vectors)
        fit = np.einsum("ij,ij->i", self.vectors, means[cluster])
        best = np.lexsort((-fit, cluster))
        medoids = best[np.unique(cluster[best], return_index=True)[1]]
        part = _roots(n, source, self.target) if len(source) else np.arange(n)
        return np.union1d(medoids, np.setdiff1d(part, part[medoids]))

    def edges(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places in ``nodes`` and the targets of all edges of these nodes."""
        count = self.first[nodes + 1] - self.first[nodes]
        at = np.repeat(np.arange(len(nodes)), count)
        step = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
        return at, self.target[self.first[nodes][at] + step]

    def scan(self, queries: np.ndarray, threshold: float) -> np.ndarray:
        return queries @ self.vectors.T >= threshold

    def search(self, queries: np.ndarray, threshold: float, beam: int) -> np.ndarray:
        """For some queries, whether each vector was found with at least this cosine."""
        n = len(self.vectors)
        if beam >= n:
            return self.scan(queries, threshold)
        reach = threshold - SLACK
        hit = np.zeros((len(queries), n), bool)
        seen = np.zeros((len(queries), n), bool)
        ring: list[tuple[np.ndarray, np.ndarray]] = []  # what lies in reach

        def look(row: np.ndarray, node: np.ndarray) -> np.ndarray:
            value = np.empty(len(row))
            for low in range(0, len(row), 1 << 16):
                part = slice(low, low + (1 << 16))
                value[part] = np.einsum("ij,ij->i", queries[row[part]], self.vectors[node[part]])
            seen[row, node] = True
            hit[row, node] = value >= threshold
            near = value >= reach
            if near.any():
                ring.append((row[near], node[near]))
            return value

        # Greedy: of every query's beam the nearest vector whose edges weren't followed yet.
        row = np.repeat(np.arange(len(queries)), len(self.entries))
        node = np.tile(self.entries, len(queries))
        first = look(row, node).reshape(len(queries), -1)
        ids = np.full((len(queries), beam), -1)
        value = np.full((len(queries), beam), -np.inf)
        top = np.argsort(-first, axis=1)[:, :beam]
        ids[:, : top.shape[1]] = self.entries[top]
        value[:, : top.shape[1]] = np.take_along_axis(first, top, 1)
        is_open = np.isfinite(value)
        while len(going := np.flatnonzero(is_open.any(1))):
            best = np.where(is_open[going], value[going], -np.inf).argmax(1)
            is_open[going, best] = False
            at, node = self.edges(ids[going, best])
            new = ~seen[going[at], node]
            at, node = at[new], node[new]
            found = look(going[at], node)
            count = np.bincount(at, minlength=len(going))
            place = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
            width = int(count.max(initial=0))
            more = np.full((len(going), width), -np.inf)
            names = np.full((len(going), width), -1)
            more[at, place], names[at, place] = found, node
            all_value = np.concatenate([value[going], more], 1)
            all_ids = np.concatenate([ids[going], names], 1)
            all_open = np.concatenate([is_open[going], np.isfinite(more)], 1)
            top = np.argpartition(-all_value, beam - 1, axis=1)[:, :beam]
            ids[going] = np.take_along_axis(all_ids, top, 1)
            value[going] = np.take_along_axis(all_value, top, 1)
            is_open[going] = np.take_along_axis(all_open, top, 1)
        # Range: on along the edges of everything in reach; where much is, the scan is shorter.
        scanned = np.zeros(len(queries), bool)
        while ring:
            row, node = (np.concatenate(x) for x in zip(*ring, strict=True))
            ring.clear()
            crowded = np.flatnonzero((hit.sum(1) > CROWDED) & ~scanned)
            if len(crowded):
                hit[crowded] = self.scan(queries[crowded], threshold)
                scanned[crowded] = True
            left = ~scanned[row]
            row, node = row[left], node[left]
            at, node = self.edges(node)
            code = np.unique(row[at] * n + node)
            row, node = code // n, code % n
            new = ~seen[row, node]
            if new.any():
                look(row[new], node[new])
        return hit


class _Task:
    """A block of a shard's vectors and a block of queries."""

    def __init__(self, table: pa.Table, threshold: float) -> None:
        self.threshold = threshold
        self.shard = table["shard"][0].as_py()
        role = table["role"].to_numpy()
        # The order of rows after a shuffle isn't fixed; that of the nodes is.
        order = np.lexsort((table["node"].to_numpy(), (role & 2) == 0))
        table = table.take(pa.array(order))
        role = role[order]
        self.queries, self.members = np.flatnonzero(role & 2), np.flatnonzero(role & 1)
        self.node, self.weight = table["node"].to_numpy(), table["weight"].to_numpy()
        self.home = table["home"].to_numpy()
        self.other = table["other"].to_numpy()
        if len(self.queries) and len(self.members):
            self.vectors = _matrix(table["vector"])

    def found(self) -> Iterator[pa.RecordBatch]:
        if not len(self.queries) or not len(self.members):
            return
        graph = Graph(self.vectors[self.members])
        audited = self.queries[self.node[self.queries] % 20 == 0]
        truth = graph.scan(self.vectors[audited], self.threshold)
        beam = BEAM
        while True:
            hit = np.concatenate(
                [
                    graph.search(self.vectors[self.queries[k : k + 512]], self.threshold, beam)
                    for k in range(0, len(self.queries), 512)
                ]
            )
            caught = hit[np.searchsorted(self.queries, audited)]
            if (caught & truth).sum() >= AUDITED * truth.sum() or beam >= len(self.members):
                break
            beam *= 2
        # A link found from one side holds for both; a vector isn't its own link.
        same, at_q, at_m = np.intersect1d(self.queries, self.members, True, True)
        both = hit[np.ix_(at_q, at_m)]
        both |= both.T.copy()
        both[np.arange(len(same)), np.arange(len(same))] = False
        hit[np.ix_(at_q, at_m)] = both
        at_home = self.home[self.members] == self.shard
        links = hit[:, at_home] @ self.weight[self.members][at_home]
        root = self._parts(hit)
        linked = np.flatnonzero(hit.any(1))
        # Members that aren't queries here only take their place in a component.
        others = np.setdiff1d(self.members[hit.any(0)], self.queries)
        at = np.concatenate([self.queries[linked], others])
        yield _rows(
            kind=np.zeros(len(at), np.int32),
            node=self.node[at],
            links=np.concatenate([links[linked], np.zeros(len(others))]).astype(np.int64),
            root=self.node[root[at]],
        )
        # On with the lists of vectors that have another home, where the query isn't itself.
        for k in range(0, len(linked), 512):
            some = self.queries[linked[k : k + 512]]
            row, column = np.nonzero(hit[linked[k : k + 512]][:, ~at_home])
            target = self.home[self.members][~at_home][column]
            new = (target != self.home[some][row]) & (target != self.other[some][row])
            pairs = np.unique(np.stack([row[new], target[new]], 1), axis=0)
            yield _rows(
                kind=np.ones(len(pairs), np.int32),
                node=self.node[some[pairs[:, 0]]],
                shard=pairs[:, 1].astype(np.int32),
            )
        yield _rows(
            kind=np.full(1, 2, np.int32),
            shard=np.full(1, self.shard, np.int32),
            wanted=np.full(1, truth.sum()),
            links=np.full(1, (caught & truth).sum()),
            beam=np.full(1, beam, np.int32),
        )

    def _parts(self, hit: np.ndarray) -> np.ndarray:
        """For every row of the task the first row of its component."""
        root = np.arange(len(self.node))
        for k in range(0, len(hit), 256):  # a few rows' hits at a time, as they can be many
            row, column = np.nonzero(hit[k : k + 256])
            i, j = root[self.queries[k + row]], root[self.members[column]]
            root = _roots(len(root), i, j)[root]
        return root


def _rows(**columns: np.ndarray) -> pa.RecordBatch:
    n = len(columns["kind"])
    types = {"int": pa.int32(), "long": pa.int64()}
    fields = [pa.field(f.split()[0], types[f.split()[1]]) for f in _FOUND.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in fields],
        schema=pa.schema(fields),
    )


def _valid(vector: Column, label: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(label.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def nodes_of(rows: DataFrame) -> DataFrame:
    """A row per different vector of a label: ``node``, ``part``, ``vector``, its ``weight`` in rows."""
    return rows.groupBy("node").agg(
        F.first("part").alias("part"), F.first("vector").alias("vector"), F.count(F.lit(1)).alias("weight")
    )


def _centres(nodes: DataFrame, shard: int) -> dict[int, tuple[int, np.ndarray]]:
    """Per label that is larger than a shard its first shard's number and its centres."""
    parts = nodes.groupBy("part").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("dim")
    )
    large = parts.where(F.col("n") > shard)
    total, dim = large.agg(F.sum("n"), F.max("dim")).first()
    if not total:
        return {}
    sampled = max(SAMPLE_PER_CENTRE, SAMPLED_VALUES // dim)
    size = max(shard, -(-total * SAMPLE_PER_CENTRE // sampled))
    chosen = F.pmod(F.xxhash64("node", F.lit(5)), F.lit(1 << 40)) < int(min(1, sampled / total) * (1 << 40))
    sample = nodes.where(chosen).join(large.where(F.col("n") > size).select("part", "n"), "part")

    def fit(table: pa.Table) -> pa.Table:
        order = pa.array(np.argsort(table["node"].to_numpy()))
        vectors = _matrix(table.take(order)["vector"])
        k = min(len(vectors), -(-table["n"][0].as_py() // size))
        centres = vectors[np.arange(k) * len(vectors) // k]
        for _ in range(5):
            nearest = np.concatenate(
                [(vectors[i : i + 1024] @ centres.T).argmax(1) for i in range(0, len(vectors), 1024)]
            )
            sums = np.zeros_like(centres)
            np.add.at(sums, nearest, vectors)
            length = np.sqrt(np.einsum("ij,ij->i", sums, sums))[:, None]
            centres = np.where(length > 1e-9, sums / np.maximum(length, 1e-9), centres)
        return pa.table(
            {"part": pa.array(np.full(k, table["part"][0].as_py())), "centre": pa.array(list(centres))}
        )

    table = sample.groupBy("part").applyInArrow(fit, "part long, centre array<double>").toArrow()
    found: dict[int, list[list[float]]] = {}
    for part, centre in zip(table["part"].to_pylist(), table["centre"].to_pylist(), strict=True):
        found.setdefault(part, []).append(centre)
    out, number = {}, 0
    for part in sorted(found):
        out[part] = (number, np.array(found[part]))
        number += len(found[part])
    return out


def _members(nodes: DataFrame, shard: int) -> DataFrame:
    """A row per node and shard it is a member of; ``home`` and ``other`` name both shards.

    Labels of one shard at most keep it for themselves: their ``shard`` is -1.
    """
    shared = nodes.sparkSession.sparkContext.broadcast(_centres(nodes, shard))

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = batch.column("part").to_numpy()
            home, other = np.full(len(part), -1, np.int32), np.full(len(part), -1, np.int32)
            for value in np.unique(part):
                if value not in shared.value:
                    continue
                number, centres = shared.value[value]
                rows = np.flatnonzero(part == value)
                for k in range(0, len(rows), 1024):
                    some = rows[k : k + 1024]
                    near = _matrix(pa.chunked_array([batch.column("vector").take(pa.array(some))])) @ centres.T
                    top = np.argsort(-near, axis=1, kind="stable")[:, :2]
                    home[some] = number + top[:, 0]
                    other[some] = number + top[:, -1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(home), pa.array(other)], names=[*batch.schema.names, "home", "other"]
            )

    kind = dict(nodes.dtypes)["vector"]
    assigned = nodes.select("node", "part", "vector", "weight").mapInArrow(
        assign, f"node long, part long, vector {kind}, weight long, home int, other int"
    )
    return assigned.withColumn("shard", F.explode(F.array_distinct(F.array("home", "other"))))


_MEMBER = ("part", "shard", "node", "vector", "weight", "home", "other")


def _tasks(members: DataFrame, visits: DataFrame | None, block: int) -> DataFrame:
    """Members and queries of every task. Without ``visits`` all members are queries themselves."""

    def dealt(df: DataFrame, blocks: str) -> Column:
        return F.pmod(F.xxhash64("node", F.lit(9)), F.col(blocks).cast("long")).cast("int")

    def sizes(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("part", "shard").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias(name))

    if visits is None:
        sized = members.join(sizes(members, "blocks"), ["part", "shard"]).withColumn("mine", dealt(members, "blocks"))
        # As a member: with every block of queries; as a query: with every other block of members.
        step = F.explode(F.expr("sequence(0, 2 * blocks - 2)"))
        laid = sized.withColumn("step", step).withColumn("role", F.expr("IF(step = mine, 3, IF(step < blocks, 1, 2))"))
        across = F.expr("IF(step < blocks, step, step - blocks + IF(step - blocks >= mine, 1, 0))")
        laid = laid.withColumn("across", across)
        task = F.when(F.col("role") == 2, F.xxhash64("part", "shard", "across", "mine")).otherwise(
            F.xxhash64("part", "shard", "mine", "across")
        )
        return laid.select(task.alias("task"), F.col("role").cast("int").alias("role"), *_MEMBER)
    asked = sizes(visits, "asked")
    both = sizes(members, "blocks").join(asked, ["part", "shard"])
    hosts = members.join(both, ["part", "shard"]).withColumn("mine", dealt(members, "blocks"))
    hosts = hosts.withColumn("across", F.explode(F.expr("sequence(0, asked - 1)"))).select(
        F.xxhash64("part", "shard", "mine", "across").alias("task"), F.lit(1).alias("role"), *_MEMBER
    )
    guests = visits.join(both, ["part", "shard"]).withColumn("mine", dealt(visits, "asked"))
    guests = guests.withColumn("across", F.explode(F.expr("sequence(0, blocks - 1)"))).select(
        F.xxhash64("part", "shard", "across", "mine").alias("task"), F.lit(2).alias("role"), *_MEMBER
    )
    return hosts.unionByName(guests)


def _searched(tasks: DataFrame, threshold: float, label: str) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in by_group(batches, "task"):
            task = table["task"].to_numpy()
            cuts = np.flatnonzero(np.concatenate([[True], task[1:] != task[:-1], [True]]))
            for low, high in zip(cuts[:-1], cuts[1:], strict=True):
                yield from _Task(table.slice(low, high - low), threshold).found()

    return stage(tasks.repartition("task").sortWithinPartitions("task").mapInArrow(run, _FOUND), label)


def searched(
    nodes: DataFrame, threshold: float = THRESHOLD, shard: int = SHARD, block: int = BLOCK
) -> DataFrame:
    """What the searches of all nodes found, round by round.

    Rows of ``kind`` 0: a node, the weight of its ``links`` in a task and the ``root`` of its
    component there; of ``kind`` 2: a task's audit, with the links ``wanted``, found and the
    ``beam`` it took.
    """
    members = stage(_members(nodes, shard), "members")
    rounds = [_searched(_tasks(members, None, block), threshold, "searched")]
    gone: DataFrame | None = None
    own = members.where("shard = home").drop("shard")
    while True:
        visits = rounds[-1].where("kind = 1").select("node", "shard").distinct()
        if gone is not None:
            visits = visits.join(gone, ["node", "shard"], "left_anti")
        visits = stage(visits, "visits")
        if visits.isEmpty():
            break
        gone = visits if gone is None else gone.unionByName(visits)
        guests = visits.join(own, "node")
        rounds.append(_searched(_tasks(members, guests, block), threshold, "searched"))
    out = rounds[0]
    for more in rounds[1:]:
        out = out.unionByName(more)
    return out


def _vectors(df: DataFrame, vec_id: str, vector: str, label: str) -> tuple[DataFrame, DataFrame]:
    """Rows that can link (``vec_id``, ``node``, ``part``, ``vector``), and the ids of the others."""
    v, g = F.col("v"), F.col("g")
    narrow = df.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("v"), F.col(label).alias("g"))
    part = F.xxhash64(g, F.size(v))
    good = narrow.where(_valid(v, g)).select(
        "vec_id", F.xxhash64(part, v).alias("node"), part.alias("part"), v.alias("vector")
    )
    return good, narrow.where(~_valid(v, g)).select("vec_id")


def link_vectors(
    df: DataFrame,
    threshold: float = THRESHOLD,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    shard: int = SHARD,
    block: int = BLOCK,
) -> DataFrame:
    """One row per vector: how many others it links with, its component's least id, and whether
    that is its own (``kept``)."""
    rows, alone = _vectors(df, vec_id, vector, label)
    nodes = stage(nodes_of(rows), "nodes")
    found = searched(nodes, threshold, shard, block).where("kind = 0")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    least = components(found, "node", "root")
    per_node = (
        nodes.select("node", "weight")
        .join(links, "node", "left")
        .join(least.withColumnRenamed("vertex", "node"), "node", "left")
        .select(
            "node",
            (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).cast("long").alias("n_links"),
            F.coalesce("least", "node").alias("component"),
        )
    )
    per_node = stage(per_node, "per-node")
    ids = rows.groupBy("node").agg(F.min("vec_id").alias("vec_id")).join(per_node, "node")
    heads = ids.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    judged = per_node.join(heads, "component").select("node", "n_links", "component_id")
    out = rows.select("vec_id", "node").join(judged, "node").select("vec_id", "n_links", "component_id")
    single = alone.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(single).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def audit(df: DataFrame, linked: DataFrame, threshold: float = THRESHOLD, every: int = 20) -> DataFrame:
    """Recall of a result on the vectors whose id is divisible by ``every``: one row, by brute force.

    Every such vector is compared with all rows of its label, in blocks of rows; it is a check to
    be run beside a job, not a part of it. ``links``, ``found``, ``recall``.
    """
    rows, _ = _vectors(df, "vec_id", "embedding", "label")
    asked = rows.where(F.col("vec_id") % every == 0)
    block = F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(16))
    left = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(15)))).withColumn("asked", F.lit(True))
    right = rows.withColumn("block", block.cast("int")).withColumn("asked", F.lit(False))

    def count(table: pa.Table) -> pa.Table:
        ask = table["asked"].to_numpy()
        vectors, ids = _matrix(table["vector"]), table["vec_id"].to_numpy()
        n = [
            int((vectors[~ask] @ vectors[i] >= threshold).sum()) for i in np.flatnonzero(ask)
        ] if (~ask).any() else [0] * int(ask.sum())
        return pa.table({"vec_id": pa.array(ids[ask]), "links": pa.array(n, pa.int64())})

    truth = (
        left.unionByName(right)
        .groupBy("part", "block")
        .applyInArrow(count, "vec_id long, links long")
        .groupBy("vec_id")
        .agg((F.sum("links") - 1).alias("links"))
    )
    both = truth.join(linked.select("vec_id", "n_links"), "vec_id")
    return both.agg(F.sum("links").alias("links"), F.sum(F.least("links", "n_links")).alias("found")).select(
        "links", "found", F.coalesce(F.col("found") / F.col("links"), F.lit(1.0)).alias("recall")
    )
