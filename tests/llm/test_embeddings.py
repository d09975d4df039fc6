"""HNSW links and components against brute force."""

import random

import numpy as np
import pytest

from dimforge.llm import embedding_dedup, hnsw

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def clustered(n, dim, seed, tight=0.05):
    rng = np.random.default_rng(seed)
    out = []
    while len(out) < n:
        centre = rng.normal(size=dim)
        for _ in range(int(rng.integers(1, 9))):
            out.append(centre + tight * rng.normal(size=dim))
    return np.array(out[:n], dtype=np.float32)


def truth(rows, threshold=0.98):
    usable = []
    for vec_id, v, label in rows:
        ok = vec_id is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        usable.append(np.asarray(v, dtype=np.float64) / np.linalg.norm(np.asarray(v, dtype=np.float64)) if ok else None)
    n = len(rows)
    links = [[j for j in range(n) if j != i and usable[i] is not None and usable[j] is not None
              and rows[i][2] == rows[j][2] and len(usable[i]) == len(usable[j])
              and usable[i] @ usable[j] >= threshold] for i in range(n)]
    out = {}
    for i in range(n):
        seen, stack = {i}, [i]
        while stack:
            for j in links[stack.pop()]:
                if j not in seen:
                    seen.add(j)
                    stack.append(j)
        least = min(rows[j][0] for j in seen) if rows[i][0] is not None else None
        out.setdefault(rows[i][0], set()).add((len(links[i]), least, rows[i][0] is not None and rows[i][0] == least))
    return out


def test_graph_recall():
    v = clustered(3000, 24, 1)
    v = (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32)
    graph = hnsw.build(v)
    ids, sims = graph.search(v, 64)
    best = np.argsort(-(v @ v.T), axis=1)[:, :10]
    recall = np.mean([len(set(a) & set(b[:10].tolist())) / 10 for a, b in zip(best.tolist(), ids)])
    assert recall > 0.97
    again = hnsw.Graph.loads(graph.dumps())
    assert (again.search(v[:50], 64)[0] == ids[:50]).all()
    for n in (1, 2, 3, 17):
        small = hnsw.build(v[:n])
        assert {x for row in small.search(v[:n], n)[0].tolist() for x in row} == set(range(n))


def test_large_groups_widen_the_beam():
    rng = np.random.default_rng(3)
    exact = np.concatenate([rng.normal(size=16) + 0.02 * rng.normal(size=(600, 16)), rng.normal(size=(400, 16))])
    exact /= np.linalg.norm(exact, axis=1, keepdims=True)
    graph = hnsw.build(exact.astype(np.float32))
    links = embedding_dedup.found_links(graph, exact, exact, 0.98, np.arange(8), beam=16)
    want = exact @ exact.T >= 0.98
    assert sum(map(len, links)) >= 0.99 * want.sum()
    assert all(want[i, j] for i, found in enumerate(links) for j in found)


def test_audit_without_links_still_measures_recall():
    rng = np.random.default_rng(5)
    exact = rng.normal(size=(1500, 24))
    exact /= np.linalg.norm(exact, axis=1, keepdims=True)
    whole = hnsw.build(exact.astype(np.float32))
    # a graph that lost its edges: its searches find next to nothing
    poor = hnsw.Graph(whole.vectors, [np.where(np.arange(x.shape[1]) < 1, x, -1) for x in whole.layers], whole.tops, whole.start)
    queries = np.concatenate([rng.normal(size=(40, 24)), exact[:200] + 0.005 * rng.normal(size=(200, 24))])
    queries /= np.linalg.norm(queries, axis=1, keepdims=True)
    want = queries @ exact.T >= 0.98
    assert not want[:32].any() and want[40:].any(axis=1).all()
    # the audited queries have no link in this shard, as is usual in a foreign one
    links = embedding_dedup.found_links(poor, exact, queries, 0.98, np.arange(32))
    assert [x.tolist() for x in links] == [np.flatnonzero(w).tolist() for w in want]
    # the match of a query with itself is no evidence
    audit = np.arange(32)
    links = embedding_dedup.found_links(poor, exact, np.concatenate([exact[500:532], queries]), 0.98, audit,
                                        own=np.r_[np.arange(500, 532), np.full(len(queries), -1)])
    assert [x.tolist() for x in links[32:]] == [np.flatnonzero(w).tolist() for w in want]
    # too few audited queries are no evidence
    few = embedding_dedup.found_links(poor, exact, queries, 0.98, audit[:3])
    assert [x.tolist() for x in few] == [np.flatnonzero(w).tolist() for w in want]


@pytest.mark.parametrize("shard,block", [(50_000, 2048), (60, 40)])
def test_links_and_components_equal_brute_force(spark, shard, block):
    v, rng = clustered(420, 12, 7), random.Random(7)
    rows = [(i, [float(x) for x in e], rng.randint(0, 2)) for i, e in enumerate(v)]
    rows += [(1000 + i, rows[i][1], rows[i][2]) for i in range(40)]  # copies
    rows += [(2000 + i, rows[0][1], rows[0][2]) for i in range(60)]  # a hot vector
    rows += [(3000 + i, [2 * x for x in rows[i][1]], rows[i][2]) for i in range(10)]  # the same direction
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = {r.vec_id: {(r.n_links, r.component_id, r.kept)} for r in embedding_dedup.near_duplicates(df, 0.98, shard, block).collect()}
    want = truth([(a, np.asarray(b, dtype=np.float32).astype(float).tolist(), c) for a, b, c in rows])
    assert set(got) == set(want)
    differ = [k for k in want if got[k] != want[k]]
    assert len(differ) <= 0.01 * len(want)


def test_edge_cases(spark, with_clashes):
    rows = [(1, [1.0, 0.0], 1), (2, [1.0, 0.001], 1), (3, [1.0, 0.0], 2), (4, None, 1), (5, [0.0, 0.0], 1), (6, [1.0, None], 1),
            (7, [float("nan"), 1.0], 1), (8, [float("inf"), 1.0], 1), (9, [1.0, 0.0], None), (10, [], 1), (11, [1.0, 0.0, 0.0], 1),
            (12, [1.0], 1), (None, [1.0, 0.0], 1), (13, [1.0, 0.0], 1), (13, [1.0, 0.0], 1), (14, [1e-30, 0.0], 1), (15, [3e38, 3e38], 3),
            (16, [3e38, 2.99e38], 3), (17, [-1.0, 0.0], 1)]
    df = with_clashes(spark.createDataFrame(rows, SCHEMA), "gid", "least", "n_links", "component", "digest", "v", "shard", "path", "copies")
    got = {}
    for r in embedding_dedup.near_duplicates(df).collect():
        got.setdefault(r.vec_id, set()).add((r.n_links, r.component_id, r.kept))
    assert got == truth([(a, b, c) for a, b, c in rows])
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_table_of_large_labels_goes_through_the_graphs(spark):
    """2,500 vectors a label in one shard: more than a beam, so graphs are searched (see ``found_links``)."""
    rng = np.random.default_rng(21)
    rows = []
    for label in (0, 1):
        base = rng.normal(size=(1700, 24))
        near = base[rng.integers(0, 1700, 800)] + rng.normal(scale=0.02, size=(800, 24))
        for v in np.concatenate([base, near]):
            rows.append((len(rows), [float(np.float32(x)) for x in v], label))
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(df, threshold=0.98).collect()}
    links, parent = [0] * len(rows), list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for label in (0, 1):
        ids = np.array([i for i, _, x in rows if x == label])
        unit = np.array([rows[i][1] for i in ids])
        unit /= np.linalg.norm(unit, axis=1, keepdims=True)
        for a, b in zip(*np.nonzero(np.triu(unit @ unit.T >= 0.98, 1))):
            i, j = int(ids[a]), int(ids[b])
            links[i] += 1
            links[j] += 1
            parent[max(root(i), root(j))] = min(root(i), root(j))
    assert sum(links) > 1000
    found = sum(n for n, _ in got.values())
    assert found >= 0.99 * sum(links) and all(got[i][0] <= links[i] for i in got)
    if found == sum(links):
        assert all(got[i] == (links[i], root(i)) for i in got)
