"""Near-duplicate vectors against brute force, and the audit of the searches."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import SparkSession

from aftermerge.llm import vector_graph
from aftermerge.llm.queries import ORACLE, QUERIES
from workload.check import connect, rows_of

SCHEMA = "vec_id long, embedding array<float>, label int, node string, shard int"


def families(seed: int, many: int, dim: int, sizes: list[int], labels: int) -> list[tuple]:
    """Random vectors, and families of near ones around some of them."""
    rng = np.random.default_rng(seed)
    rows = []
    for size in [*sizes, *[1] * many]:
        centre = rng.normal(size=dim)
        label = int(rng.integers(labels))
        for _ in range(size):
            made = centre + (size > 1) * rng.normal(size=dim) * rng.uniform(0.05, 0.3)
            rows.append((made * rng.uniform(0.1, 9)).astype(np.float32).tolist() + [label])
    order = rng.permutation(len(rows))
    return [(int(i), rows[k][:-1], rows[k][-1], "x", 7) for i, k in enumerate(order)]


def expected(rows: list[tuple], threshold: float = 0.93) -> dict[int, tuple[int, int]]:
    good = [r for r in rows if r[1] and r[2] is not None and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])]
    links: dict[int, set[int]] = {k: set() for k in range(len(good))}
    for label in {(r[2], len(r[1])) for r in good}:
        at = [k for k, r in enumerate(good) if (r[2], len(r[1])) == label]
        wide = np.array([good[k][1] for k in at], float)
        wide /= np.linalg.norm(wide, axis=1)[:, None]
        for x, y in zip(*np.nonzero(wide @ wide.T >= threshold), strict=True):
            if x != y:
                links[at[x]].add(at[y])
    out = {r[0]: (0, r[0]) for r in rows}
    seen: set[int] = set()
    for k in links:
        if k in seen:
            continue
        part, todo = {k}, [k]
        while todo:
            new = links[todo.pop()] - part
            part |= new
            todo += new
        seen |= part
        least = min(good[x][0] for x in part)
        for x in part:
            out[good[x][0]] = (len(links[x]), least)
    return out


def result(df) -> dict[int, tuple[int, int]]:
    rows = df.collect()
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in rows)
    found = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.mark.parametrize(("shard", "block"), [(2048, 8192), (100, 8192), (100, 70)])
def test_links_match_brute_force(spark: SparkSession, shard: int, block: int) -> None:
    """One shard a label; many overlapping shards and rounds; shards in blocks, and a hot family."""
    rows = families(5, 900, 24, [300, 40, 9, *[2] * 60], 2)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    want = expected(rows)
    got = result(vector_graph.link_vectors(df, shard=shard, block=block))
    found = sum(min(got[k][0], want[k][0]) for k in want)
    assert set(got) == set(want)
    assert all(got[k][0] <= want[k][0] for k in want)  # none below the threshold
    assert found >= 0.99 * sum(n for n, _ in want.values())
    if shard > 1000:
        assert got == want


def test_odd_vectors(spark: SparkSession) -> None:
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1, "x", 1),
        (2, [2.0, 0.0], 1, "x", 1),  # longer, but alike
        (3, [1.0, 0.1], 2, "x", 1),  # another label
        (4, [1.0, 0.0], None, "x", 1),
        (5, None, 1, "x", 1),
        (6, [0.0, 0.0], 1, "x", 1),
        (7, [1.0, None], 1, "x", 1),
        (8, [nan, 1.0], 1, "x", 1),
        (9, [inf, 1.0], 1, "x", 1),
        (10, [], 1, "x", 1),
        (11, [1.0, 0.0, 0.0], 1, "x", 1),  # another length
        (12, [-1.0, 0.0], 1, "x", 1),
        (13, [3e38, 1e30], 1, "x", 1),
    ]
    got = result(vector_graph.link_vectors(spark.createDataFrame(rows, SCHEMA)))
    linked = {1: (2, 1), 2: (2, 1), 13: (2, 1)}
    assert got == {r[0]: linked.get(r[0], (0, r[0])) for r in rows}


def test_repeated_rows_link_with_each_other(spark: SparkSession) -> None:
    rows = [(5, [1.0, 2.0], 1), (5, [1.0, 2.0], 1), (3, [1.0, 2.0], 1), (None, [1.0, 2.1], 1), (None, [-1.0, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = vector_graph.link_vectors(df).collect()
    assert sorted((r["n_links"], r["vec_id"] or 0, r["component_id"] or 0, r["kept"]) for r in got) == [
        (0, 0, 0, True),
        (3, 0, 3, False),
        (3, 3, 3, True),
        (3, 5, 3, False),
        (3, 5, 3, False),
    ]
    assert vector_graph.link_vectors(df.limit(0)).count() == 0


def test_audits_and_a_hot_family_of_copies(spark: SparkSession) -> None:
    rows = families(9, 600, 16, [60, *[3] * 30], 1)
    copies = [(10_000 + i, rows[0][1], rows[0][2], "x", 1) for i in range(500)]
    df = spark.createDataFrame(rows + copies, SCHEMA)
    good, _ = vector_graph._vectors(df, "vec_id", "embedding", "label")
    nodes = vector_graph.stage(vector_graph.nodes_of(good), "nodes")
    assert nodes.count() == len(rows)  # copies are one node
    audits = vector_graph.searched(nodes, shard=100).where("kind = 2").collect()
    wanted, found = (sum(r[c] for r in audits) for c in ("wanted", "links"))
    assert wanted > 0 and found >= 0.99 * wanted
    linked = vector_graph.link_vectors(df, shard=100)
    report = vector_graph.audit(df, linked).first()
    assert report["links"] > 0 and report["recall"] >= 0.99
    assert result(linked)[10_000][0] >= 500


def test_robust_pruning_keeps_the_nearest(spark: SparkSession) -> None:
    rng = np.random.default_rng(1)
    vectors = vector_graph.unit(rng.normal(size=(400, 12)))
    graph = vector_graph.Graph(vectors)
    near = vectors @ vectors.T
    np.fill_diagonal(near, -1)
    for k in range(400):
        _, targets = graph.edges(np.array([k]))
        assert near[k].argmax() in targets
    hit = graph.search(vectors, 0.6, 32)
    truth = vectors @ vectors.T >= 0.6
    assert not (hit & ~truth).any()
    assert (hit & truth).sum() >= 0.97 * truth.sum()


def test_query_matches_its_sql(spark: SparkSession) -> None:
    sf = "/root/testdata/sf0.01"
    frame, found = QUERIES["op13_vector_dedup"](spark, sf), connect(sf).execute(ORACLE["op13_vector_dedup"])
    columns = [d[0] for d in found.description]
    assert rows_of(frame.columns, frame.collect()) == rows_of(columns, found.fetchall())
