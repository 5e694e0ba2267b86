"""Approximate nearest neighbours: a navigable small-world graph per shard, merged over shards."""

import io
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cropmosaic.llm.common import bucket_count, stored

SHARD_ROWS, BLOCK_QUERIES, BLOCKS_PER_GROUP = 8192, 2048, 4
#: Neighbours kept per node above the ground layer and on it; candidates each is chosen from; beam widths.
LINKS, GROUND_LINKS, CANDIDATES = 16, 40, 64
BEAM_ABOVE, BEAM, OPEN_AT_ONCE = 16, 160, 4


def valid_vectors(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v): v as doubles. Left out: NULL ids, and vectors that are NULL, empty, zero, of another length than most, or hold a NULL or non-finite number."""
    v = F.transform(F.col(vector), lambda x: x.cast("double") + F.lit(0.0))
    rows = rows.select(F.col(key).cast("long").alias("id"), v.alias("v"))
    finite = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(math.inf)), F.lit(False)))
    rows = rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0))
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).first()
    return rows.filter(F.size("v") == F.lit(sizes["n"] if sizes else 0))


def _pack(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _unpack(blob: bytes) -> dict[str, np.ndarray]:
    return dict(np.load(io.BytesIO(blob)))


def raised(v: np.ndarray) -> np.ndarray:
    """One more coordinate brings all vectors to one length; the nearest by angle is then the one of largest product."""
    square = (v * v).sum(axis=1)
    return np.concatenate((v, np.sqrt(np.maximum(square.max() - square, 0))[:, None]), axis=1).astype(np.float32)


def layer_links(x: np.ndarray, links: int) -> np.ndarray:
    """Flat neighbour array (n x links, -1 where none) of the nodes x of one layer.

    A node's candidates are its nearest nodes. One is linked if it is nearer to the node than to
    those linked before, so links go out in all directions; links are then made mutual, the
    nearest first, up to the bound.
    """
    n = len(x)
    if n < 2:
        return np.full((n, links), -1, np.int32)
    width = min(CANDIDATES, n - 1)
    out_from, out_to, out_near, out_rank = [], [], [], []
    for lo in range(0, n, 512):
        near = x[lo : lo + 512] @ x.T
        rows = np.arange(len(near))
        near[rows, lo + rows] = -np.inf
        best = np.argpartition(-near, width - 1, axis=1)[:, :width]
        order = np.argsort(-np.take_along_axis(near, best, 1), axis=1, kind="stable")
        best = np.take_along_axis(best, order, 1)
        near = np.take_along_axis(near, best, 1)
        mutual = np.einsum("bid,bjd->bij", x[best], x[best], optimize=True)
        kept = np.zeros(best.shape, bool)
        for j in range(width):
            closer = (kept[:, :j] & (mutual[:, j, :j] > near[:, j, None])).any(axis=1)
            kept[:, j] = ~closer & (kept[:, :j].sum(axis=1) < links)
        # free places go to the nearest of the rest
        rank = np.where(kept, 0, 1)
        fill = np.argsort(rank * width + np.arange(width), axis=1)[:, : min(links // 2 + 1, width)]
        chosen = kept.copy()
        np.put_along_axis(chosen, fill, True, 1)
        r, c = np.nonzero(chosen)
        out_from.append(lo + r)
        out_to.append(best[r, c])
        out_near.append(near[r, c])
        out_rank.append(rank[r, c])
    a, b, s, k = (np.concatenate(v) for v in (out_from, out_to, out_near, out_rank))
    a, b, s, k = np.r_[a, b], np.r_[b, a], np.r_[s, s], np.r_[k, k + 2]
    order = np.lexsort((-s, k, a))
    a, b = a[order], b[order]
    first = np.unique(a.astype(np.int64) * n + b, return_index=True)[1]
    first.sort()
    a, b = a[first], b[first]
    place = np.arange(len(a)) - np.searchsorted(a, a)
    ok = place < links
    flat = np.full((n, links), -1, np.int32)
    flat[a[ok], place[ok]] = b[ok]
    return flat


def build_shard(vids: np.ndarray, vectors: np.ndarray, copies: list[np.ndarray]) -> bytes:
    """The shard's graph as flat arrays: nodes and neighbours of each layer, vectors, ids and copies of each vector."""
    x = raised(vectors)
    u = np.array([(xxhash.xxh64_intdigest(int(i).to_bytes(8, "little", signed=True)) + 1) / 2.0**64 for i in vids])
    level = np.floor(-np.log(np.minimum(u, 1.0)) / math.log(LINKS)).astype(int)
    arrays: dict[str, np.ndarray] = {"vectors": vectors, "x": x}
    arrays["copies"] = np.concatenate(copies).astype(np.int64)
    arrays["copy_at"] = np.r_[0, np.cumsum([len(c) for c in copies])]
    nodes, depth = np.arange(len(vids)), 0
    while len(nodes):
        arrays[f"nodes{depth}"] = nodes.astype(np.int32)
        arrays[f"links{depth}"] = layer_links(x[nodes], LINKS if depth else GROUND_LINKS)
        depth += 1
        above = np.flatnonzero(level >= depth)
        if len(nodes) <= LINKS or not len(above) or len(above) == len(nodes):
            break
        nodes = above
    arrays["depth"] = np.array(depth)
    return _pack(**arrays)


def _beam(x: np.ndarray, links: np.ndarray, q: np.ndarray, start: np.ndarray, width: int) -> np.ndarray:
    """The best `width` nodes of a layer for each query (-1 where fewer), all queries walking together."""
    n, rows = len(x), np.arange(len(q))[:, None]
    seen = np.zeros((len(q), n + 1), bool)
    seen[:, n] = True
    node = np.where(start < 0, n, start)
    near = np.where(start < 0, -np.inf, np.einsum("qed,qd->qe", x[np.minimum(node, n - 1)], q)).astype(np.float32)
    seen[rows, node] = True
    done = start < 0
    while True:
        waiting = np.where(done, -np.inf, near)
        live = np.flatnonzero(waiting.max(axis=1) > -np.inf)
        if not len(live):
            return np.where(near > -np.inf, node, -1)
        pick = np.argsort(-waiting[live], axis=1)[:, :OPEN_AT_ONCE]
        opened = np.where(np.take_along_axis(waiting[live], pick, 1) > -np.inf, np.take_along_axis(node[live], pick, 1), n)
        mark = done[live]
        np.put_along_axis(mark, pick, True, 1)
        done[live] = mark
        found = np.where(opened[:, :, None] < n, links[np.minimum(opened, n - 1)], -1).reshape(len(live), -1)
        found = np.sort(np.where(found < 0, n, found), axis=1)
        found[:, 1:][found[:, 1:] == found[:, :-1]] = n
        found[seen[live[:, None], found]] = n
        seen[live[:, None], found] = True
        got = np.einsum("qed,qd->qe", x[np.minimum(found, n - 1)], q[live])
        got[found == n] = -np.inf
        all_near = np.concatenate((near[live], got), axis=1)
        keep = min(width, all_near.shape[1])
        best = np.argsort(-all_near, axis=1)[:, :keep]
        all_node = np.take_along_axis(np.concatenate((node[live], found), axis=1), best, 1)
        all_done = np.take_along_axis(np.concatenate((done[live], found == n), axis=1), best, 1)
        all_near = np.take_along_axis(all_near, best, 1)
        if keep > node.shape[1]:
            add = ((0, 0), (0, keep - node.shape[1]))
            node, near, done = np.pad(node, add, constant_values=n), np.pad(near, add, constant_values=-np.inf), np.pad(done, add, constant_values=True)
        node[live], near[live], done[live] = all_node, all_near, all_done


def search_shard(shard: dict[str, np.ndarray], q: np.ndarray, wanted: int) -> np.ndarray:
    """The shard's nodes nearest to each query, best first, -1 where fewer."""
    x, depth = shard["x"], int(shard["depth"])
    high = np.concatenate((q, np.zeros((len(q), 1))), axis=1).astype(np.float32)
    found = np.empty((len(q), 0), np.int64)
    for layer in range(depth - 1, -1, -1):
        nodes, links = shard[f"nodes{layer}"], shard[f"links{layer}"]
        if layer == depth - 1:  # the top layer is small: start from its nodes nearest to the query
            start = np.argsort(-(high @ x[nodes].T), axis=1)[:, :BEAM_ABOVE]
        else:
            start = np.where(found < 0, -1, np.searchsorted(nodes, found))
        local = _beam(x[nodes], links, high, start, BEAM_ABOVE if layer else max(BEAM, 2 * wanted))
        found = np.where(local < 0, -1, nodes[np.maximum(local, 0)])
    return found[:, : max(wanted, BEAM)]


def build_index(vectors: DataFrame, keep_copies: int) -> tuple[DataFrame, int]:
    """(shard, graph), stored, and the number of shards. vectors: (id, v) of valid vectors.

    Equal vectors are one node, which remembers its keep_copies smallest ids: a node found
    gives all the rows that can be among the first keep_copies.
    """
    nth = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    small = vectors.distinct().withColumn("n", nth).filter(F.col("n") <= keep_copies)
    distinct = stored(small.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")))
    shards = bucket_count(distinct.count(), SHARD_ROWS)
    placed = distinct.withColumn("shard", F.pmod(F.xxhash64(F.col("ids")[0]), F.lit(shards)).cast("int"))

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.assign(first=[i[0] for i in rows["ids"]]).sort_values("first")
        ids = [np.asarray(i, np.int64) for i in rows["ids"]]
        graph = build_shard(rows["first"].to_numpy(), np.array(rows["v"].tolist(), np.float64), ids)
        return pd.DataFrame({"shard": [int(rows["shard"].iloc[0])], "graph": [graph]})

    return stored(placed.groupBy("shard").applyInPandas(build, "shard int, graph binary")), shards


def nearest(rows: DataFrame, queries: Column, k: int, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that `queries` selects its k rows of largest inner product found.

    All valid rows but the query's own id are candidates; score is the product of the original
    vectors in double precision; equal scores go to the smaller id. Fewer candidates give fewer
    rows, none gives none. Rows that repeat id and vector are one; an id with several vectors
    is several candidates and queries, of which the best rows count.
    """
    valid = stored(valid_vectors(rows, key, vector))
    index, shards = build_index(valid, k + 1)
    asked = valid.filter(queries).distinct()
    blocks = bucket_count(asked.count(), BLOCK_QUERIES)
    asked = asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("id")
        blob = _pack(ids=part["id"].to_numpy(np.int64), q=np.array(part["v"].tolist(), np.float64))
        return pd.DataFrame({"block": [int(part["block"].iloc[0])], "asked": [blob]})

    packed = stored(asked.groupBy("block").applyInPandas(pack, "block int, asked binary"))
    groups = bucket_count(blocks, BLOCKS_PER_GROUP)
    # a shard meets the query blocks in groups of bounded number, each group a task of its own
    work = packed.withColumn("group", (F.col("block") / BLOCKS_PER_GROUP).cast("int"))
    work = work.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).repartition(shards * groups, "shard", "group")
    copies = index.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).repartition(shards * groups, "shard", "group")
    tasks = work.join(copies, ["shard", "group"]).select("graph", "asked")

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for graph, blob in zip(batch["graph"], batch["asked"]):
                shard, block = _unpack(graph), _unpack(blob)
                for lo in range(0, len(block["ids"]), 256):
                    yield _rows(shard, block["ids"][lo : lo + 256], block["q"][lo : lo + 256], k)

    found = tasks.mapInPandas(search, "query_id long, vec_id long, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _rows(shard: dict[str, np.ndarray], ids: np.ndarray, q: np.ndarray, k: int) -> pd.DataFrame:
    nodes = search_shard(shard, q, k + 1)
    at, copies = shard["copy_at"], shard["copies"]
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for i, own in enumerate(ids):
        got = nodes[i][nodes[i] >= 0]
        score = (shard["vectors"][got] * q[i]).sum(axis=1)
        top = got[np.argsort(-score, kind="stable")[: k + 1]]
        # nodes as good as the last one count too: ties are decided by id
        if len(score) > k + 1:
            top = got[score >= np.sort(score)[-(k + 1)]]
        score = (shard["vectors"][top] * q[i]).sum(axis=1)
        each = at[top + 1] - at[top]
        vec = np.concatenate([copies[at[t] : at[t + 1]] for t in top]) if len(top) else np.empty(0, np.int64)
        score = np.repeat(score, each)
        other = vec != own
        vec, score = vec[other], score[other]
        best = np.lexsort((vec, -score))[:k]
        out.append((np.full(len(best), own), vec[best], score[best]))
    a, b, c = (np.concatenate(v) for v in zip(*out))
    return pd.DataFrame({"query_id": a, "vec_id": b, "score": c})
