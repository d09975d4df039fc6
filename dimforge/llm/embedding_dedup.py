"""Near-duplicate embeddings by sharded HNSW search.

Vectors of one label and dimension are dealt to shards of at most about
``SHARD``; each shard gets a graph (``hnsw``), written to the shared folder.
Every vector then queries every shard of its label, in blocks of queries.
What a beam finds at the threshold is verified by cosine in double precision.

Recall: in each block of a shard, ``AUDIT`` queries are also compared with the
whole shard.  A block passes if the search found ``RECALL`` of their
``NEAREST`` nearest vectors, and of their links, the query itself left out of
both; nearest vectors are there also where no query has a link.  A block that
falls short is searched again with a beam four times as wide, and past
``WIDEST``, or with fewer than ``EVIDENCE`` true neighbours to judge by, it is
compared with the whole shard.  A query whose beam holds nothing but links is
searched again with a wider beam in the same steps, so large groups are not
cut off.

Equal vectors are one row from the start, with their number.  A block returns
a count of links for each query and a spanning forest of the links it found,
never the pairs; components are unioned over all shards.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components, and rows with a null label or vec_id, link with nothing; vectors
of different lengths are never compared; an empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimforge.llm import files, hnsw
from dimforge.llm.common import SMALL, materialize, new_folder, require
from dimforge.llm.components import connected, forest
from dimforge.operators.joins import lookup_join

SHARD = 50_000
BLOCK = 2048
BEAM = 64
AUDIT = 32
RECALL = 0.99
NEAREST = 10
EVIDENCE = 200
WIDEST = 256  # wider beams cost more than comparing with the whole shard
_SLACK = 1e-5  # float32 similarities may be off by less


def unit(rows: pd.Series) -> np.ndarray:
    """Unit vectors in double precision (scaled first, so no square overflows)."""
    v = np.stack([np.asarray(x, dtype=np.float64) for x in rows])
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def found_links(graph: hnsw.Graph, exact: np.ndarray, queries: np.ndarray, threshold: float, audit: np.ndarray,
                recall: float = RECALL, beam: int = BEAM, own: np.ndarray | None = None) -> list[np.ndarray]:
    """Positions in the shard whose verified cosine with each query reaches the threshold.

    ``own`` are the queries' own positions in the shard, -1 for those of other shards.
    """
    n, coarse = len(exact), queries.astype(np.float32)
    own = np.full(len(queries), -1) if own is None else own

    def verified(rows: np.ndarray, beam: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        ids, sims = graph.search(coarse[rows], beam)
        near = sims >= threshold - _SLACK
        out = []
        for r, row in enumerate(rows):
            at = ids[r][near[r]]
            out.append(at[exact[at] @ queries[row] >= threshold])
        return out, near.all(axis=1), ids

    def compared(rows: np.ndarray) -> list[np.ndarray]:
        """Links by comparing with the whole shard."""
        return [np.flatnonzero(sims >= threshold) for at in range(0, len(rows), 64)
                for sims in queries[rows[at:at + 64]] @ exact.T]

    truth = [_neighbours(exact @ queries[a], own[a], threshold) for a in audit]
    evidence = sum(k for k, *_ in truth)
    every = np.arange(len(queries))
    while beam <= WIDEST and beam < n and evidence >= EVIDENCE:
        links, full, ids = verified(every, beam)
        wide = beam
        while full.any():
            wide, rows = 4 * wide, np.flatnonzero(full)
            if wide <= WIDEST and wide < n:
                again, full[rows], _ = verified(rows, wide)
            else:
                again, full[rows] = compared(rows), False
            for row, found in zip(rows, again):
                links[row] = found
        near = hits = total = 0
        for a, (k, least, linked) in zip(audit, truth):
            found = np.setdiff1d(np.concatenate([ids[a], links[a]]), [-1, own[a]])
            near += min(k, int((exact[found] @ queries[a] >= least - _SLACK).sum()))
            hits += int(np.isin(linked, links[a]).sum())
            total += len(linked)
        if near >= recall * evidence and hits >= recall * total:
            return links
        beam *= 4
    return compared(every)


def _neighbours(sims: np.ndarray, own: int, threshold: float) -> tuple[int, float, np.ndarray]:
    """(how many nearest vectors there are to find, the least cosine of those,
    the links), without the query itself."""
    sims = sims.copy()
    if own >= 0:
        sims[own] = -np.inf
    k = min(NEAREST, len(sims) - (own >= 0))
    least = np.partition(sims, len(sims) - k)[len(sims) - k] if k else np.inf
    return k, least, np.flatnonzero(sims >= threshold)


def _distinct(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with the digest of their vector, one row per distinct usable vector)."""
    value = F.col("embedding").cast("array<double>")
    finite = F.size(value) > 0
    finite &= ~F.exists(value, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    finite &= F.exists(value, lambda x: x != 0)
    usable = F.coalesce(finite, F.lit(False)) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    digest = F.sha2(F.concat_ws(",", F.transform(value, lambda x: x.cast("string"))), 256)
    rows = require(vectors, ["vec_id", "embedding", "label"]).withColumn("digest", F.when(usable, digest))
    one = (rows.where("digest IS NOT NULL").groupBy("label", "digest")
           .agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.first(value).alias("v")))
    distinct = one.withColumn("gid", F.monotonically_increasing_id()).withColumn("dim", F.size("v"))
    return rows, materialize(distinct, "vectors")


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of (vec_id, embedding, label)."""
    spark = vectors.sparkSession
    rows, distinct = _distinct(vectors)
    groups = materialize(distinct.groupBy("label", "dim").agg(F.count("*").alias("n")).where("n > 1"), "vector-groups")
    # few labels: broadcast if counted small, else a join whose hot labels AQE splits
    sized = lookup_join(distinct, groups, ["label", "dim"], settings=SMALL).withColumn("shards", F.ceil(F.col("n") / shard))
    dealt = sized.withColumn("shard", F.pmod(F.xxhash64("gid"), F.col("shards")))
    folder = new_folder(spark, "hnsw")

    def index(part: pd.DataFrame) -> pd.DataFrame:
        exact = unit(part["v"])
        graph = hnsw.build(exact.astype(np.float32))
        path = files.own_name(folder, "shard", ".npz")
        body = graph.dumps()
        files.put(path, len(body).to_bytes(8, "little") + body + part["gid"].to_numpy(np.int64).tobytes()
                  + part["copies"].to_numpy(np.int64).tobytes() + exact.tobytes())
        first = part.iloc[0]
        return pd.DataFrame({"label": [first["label"]], "dim": [first["dim"]], "shard": [first["shard"]], "path": [path]})

    key = ["label", "dim", "shard"]
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in dealt.select(*key).schema.fields)
    shards = materialize(dealt.groupBy(*key).applyInPandas(index, f"{fields}, path string"), "shards")
    # each vector meets every shard of its label; blocks bound what a task holds
    blocks = dealt.withColumn("block", F.pmod(F.xxhash64("gid", F.lit(9)), F.ceil(F.col("n") / block)))
    asked = lookup_join(blocks.select("label", "dim", "block", "gid", "v"), shards.select("label", "dim", "path"),
                        ["label", "dim"], settings=SMALL)

    def query(part: pd.DataFrame) -> pd.DataFrame:
        graph, gids, copies, exact = _load(part["path"].iloc[0])
        part = part.sort_values("gid")
        own, queries = part["gid"].to_numpy(np.int64), unit(part["v"])
        audit = np.random.default_rng(len(own)).permutation(len(own))[:AUDIT]
        order = np.argsort(gids)
        place = order[np.minimum(np.searchsorted(gids, own, sorter=order), len(gids) - 1)]
        links = found_links(graph, exact, queries, threshold, audit, own=np.where(gids[place] == own, place, -1))
        a = np.repeat(own, [len(x) for x in links])
        at = np.concatenate(links).astype(int) if links else np.zeros(0, dtype=int)
        b = gids[at]
        other = a != b
        counts = pd.Series(np.where(other, copies[at], 0)).groupby(a).sum() if len(a) else pd.Series(dtype=np.int64)
        low, high = forest(a[other], b[other])
        return pd.DataFrame({"kind": np.r_[np.zeros(len(counts), dtype=np.int32), np.ones(len(low), dtype=np.int32)],
                             "a": np.r_[counts.index.to_numpy(np.int64), low.astype(np.int64)],
                             "b": np.r_[counts.to_numpy(np.int64), high.astype(np.int64)]})

    found = materialize(asked.groupBy("path", "block").applyInPandas(query, "kind int, a long, b long"), "vector-links")
    linked = found.where("kind = 0").groupBy("a").agg(F.sum("b").alias("links"))
    components = connected(found.where("kind = 1").select("a", "b"))
    known = (distinct.join(linked, distinct.gid == linked.a, "left").join(components, distinct.gid == components.node, "left")
             .select("label", "digest", "least", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                     F.coalesce("component", "gid").alias("component")))
    known = materialize(known, "vector-components")
    least = materialize(known.groupBy("component").agg(F.min("least").alias("component_id")), "vector-ids")
    named = known.join(least, "component").select("label", "digest", "n_links", "component_id")
    named = named.select(F.col("label").alias("of_label"), F.col("digest").alias("of_digest"), "n_links", "component_id")
    out = rows.join(named, (rows["label"] == F.col("of_label")) & (rows["digest"] == F.col("of_digest")), "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.cast("long").alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


_loaded: dict[str, tuple[hnsw.Graph, np.ndarray, np.ndarray, np.ndarray]] = {}


def _load(path: str) -> tuple[hnsw.Graph, np.ndarray, np.ndarray, np.ndarray]:
    """(graph, gids, copies, unit vectors) of a shard; the worker keeps the last one."""
    if path not in _loaded:
        _loaded.clear()
        data = files.get(path)
        size = int.from_bytes(data[:8], "little")
        graph = hnsw.Graph.loads(data[8:8 + size])
        n, at = len(graph.vectors), 8 + size
        gids = np.frombuffer(data, dtype=np.int64, count=n, offset=at)
        copies = np.frombuffer(data, dtype=np.int64, count=n, offset=at + 8 * n)
        exact = np.frombuffer(data, dtype=np.float64, offset=at + 16 * n).reshape(n, -1)
        _loaded[path] = graph, gids, copies, exact
    return _loaded[path]
