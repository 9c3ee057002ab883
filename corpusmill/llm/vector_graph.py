"""Near-duplicate vectors by a pruned neighbour graph over overlapping cluster shards.

1. Equal vectors of a label are one node with a multiplicity.
2. Each label gets centroids from a bounded sample; every node joins the shards of its nearest ones, the
   nearest being its home. A search goes through its home, so a link is found where one end joins the
   other's home: that is what the overlap is for. Shards beyond a size are cut into chunks by a hash, so no
   task holds more.
3. Every chunk builds a graph: the nearest candidates and some far ones, pruned so that a neighbour is
   dropped when a kept one is much closer to it than the node is (robust pruning).
4. A node's adjacency lists from all its chunks are united.
5. Each node is searched in the chunks of its home: a greedy search over the united lists starts from
   medoids and the node's own place, and goes on past its beam while nodes lie within the range.
6. Hits are verified by cosine in double precision. Links inside a home are counted where they are
   found, and only links that leave it are sent on as pairs; classes come from spanning links.
7. Recall is audited by brute force for a bounded sample of vectors, over all links and as the mean per
   vector; below the goal, everything is done again with more overlap and a wider beam.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.columns import whole_numbers
from corpusmill.llm.components import components
from corpusmill.session import spill


@dataclass(frozen=True)
class Graph:
    """Sizes of the index. ``clusters`` bounds the centroids of a label; larger shards get more chunks."""

    shard: int = 1024  # nodes a shard is meant to hold before overlap
    clusters: int = 1024
    overlap: int = 6  # shards a node joins, where so many are about as near as the nearest
    chunk: int = 3072  # nodes, and queries, that meet in one task
    sample: int = 32  # sampled nodes per centroid
    near: int = 48  # nearest candidates before pruning
    far: int = 12  # random candidates before pruning
    degree: int = 24
    slack: float = 1.2  # how much closer a kept neighbour must be to drop a candidate
    beam: int = 24
    entries: int = 12  # medoids a search starts from
    range_slack: float = 0.08  # nodes this far below the threshold are still expanded
    audited: int = 2048  # vectors whose links are also counted by brute force
    recall: float = 0.9


_KEY = "label long, dim int"
_ASSIGNED = f"{_KEY}, vec_id long, copies long, v binary, shard int, home boolean"
_LISTS = "vec_id long, near array<long>"
_FOUND = "kind int, a long, b long, n long"
COUNT, PAIR, SPAN = 0, 1, 2


def near_vectors(
    vectors: DataFrame,
    threshold: float = 0.93,
    graph: Graph = Graph(),
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per row of ``vectors``.

    Vectors are compared when their labels are equal and not null and their lengths are equal. Defined
    cases: null, empty and zero vectors and those with null or non-finite components link with nothing and are
    their own component; a null id links with nothing, has a null component and is kept; of rows
    that repeat an id the smallest (label, vector) is looked at and all get its result; equal vectors
    link with each other; no row, no row; further columns are not read.
    """
    rows = vectors.select(
        whole_numbers(vectors, id_col).alias("vec_id"),
        whole_numbers(vectors, label_col).alias("label"),
        F.col(vector_col).cast("array<double>").alias("v"),
    )
    fit = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    usable = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("v") > 0) & fit)
    usable = usable.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("x")).select("vec_id", "x.label", "x.v")
    same = spill(usable.groupBy("label", "v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")))
    members = spill(usable.join(same, ["label", "v"]).select("vec_id", "rep", "copies"))
    nodes = same.select("label", F.size("v").alias("dim"), F.col("rep").alias("vec_id"), "copies", "v")

    for _ in range(4):
        counts, spans = _linked(nodes, threshold, graph)
        counts = spill(counts)
        if _recall(nodes, counts, threshold, graph.audited) >= graph.recall:
            break
        graph = replace(graph, overlap=2 * graph.overlap, beam=2 * graph.beam, near=2 * graph.near)
    else:
        raise RuntimeError(f"recall stays below {graph.recall}")

    links = spans.union(members.filter("vec_id <> rep").select(F.col("vec_id").alias("a"), F.col("rep").alias("b")))
    classes = components(links).withColumnRenamed("node", "vec_id")
    counted = members.join(counts.withColumnRenamed("vec_id", "rep"), "rep", "left")
    n_links = F.coalesce("n", F.lit(0)) + F.col("copies") - 1
    result = rows.select("vec_id").join(counted.select("vec_id", n_links.alias("n_links")), "vec_id", "left")
    result = result.join(classes, "vec_id", "left")
    component = F.coalesce("component", "vec_id")
    return result.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )


def _linked(nodes: DataFrame, threshold: float, graph: Graph) -> tuple[DataFrame, DataFrame]:
    """``(vec_id, n)``: linked copies per node; ``(a, b)``: links that span the classes."""
    members = spill(_assigned(nodes, graph, threshold))
    sizes = members.groupBy("label", "dim", "shard").agg(
        F.count("*").alias("held"), F.count(F.when(F.col("home"), True)).alias("asked")
    )
    limit = float(graph.chunk)
    sizes = sizes.select(
        "label", "dim", "shard", F.ceil(F.col("held") / limit).alias("chunks"), F.ceil(F.col("asked") / limit).alias("asks")
    )
    members = members.join(sizes, ["label", "dim", "shard"]).withColumn(
        "chunk", F.pmod(F.xxhash64("vec_id"), "chunks").cast("int")
    )
    tile = ["label", "dim", "shard", "chunk"]
    lists = members.select(*tile, "vec_id", "v").groupBy(*tile).applyInArrow(_build(graph), _LISTS)
    lists = lists.groupBy("vec_id").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    listed = spill(members.join(lists, "vec_id"))

    held = listed.withColumn("ask", F.explode(F.sequence(F.lit(0), (F.col("asks") - 1).cast("int")))).filter("asks > 0")
    homes = listed.filter("home")
    asked = homes.withColumn("ask", F.pmod(F.xxhash64(F.lit(1), F.col("vec_id")), "asks").cast("int"))
    asked = asked.withColumn("chunk", F.explode(F.sequence(F.lit(0), (F.col("chunks") - 1).cast("int"))))
    key = [*tile, "ask"]
    found = held.select(*key, "vec_id", "copies", "v", "home", "near").groupBy(*key).cogroup(
        _anew(asked, *key, "vec_id", "v").groupBy(*key)
    ).applyInArrow(_search(graph, threshold), _FOUND)
    found = spill(found)
    pairs = found.filter(F.col("kind") == PAIR)
    pairs = pairs.select("a", "b").union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    copies = nodes.select(F.col("vec_id").alias("b"), "copies")
    across = pairs.join(copies, "b").select(F.col("a").alias("vec_id"), F.col("copies").alias("n"))
    inside = found.filter(F.col("kind") == COUNT).select(F.col("a").alias("vec_id"), "n")
    counts = across.union(inside).groupBy("vec_id").agg(F.sum("n").alias("n"))
    return counts, found.filter(F.col("kind") == SPAN).select("a", "b")


def _anew(df: DataFrame, *columns: str) -> DataFrame:
    """The columns as attributes of their own, so that two frames of one origin can be grouped together."""
    return df.select(*[F.col(c).alias(c) for c in columns])


# --- shards ----------------------------------------------------------------------------------


def _assigned(nodes: DataFrame, graph: Graph, threshold: float) -> DataFrame:
    """Every node once per shard it joins. Work is dealt by (label, salt), centroids go to every salt."""
    sizes = nodes.groupBy("label", "dim").agg(F.count("*").alias("held"))
    k = F.least(F.lit(graph.clusters), F.ceil(F.col("held") / graph.shard)).cast("int")
    sizes = sizes.select("label", "dim", k.alias("k"), F.ceil(F.col("held") / 20_000).cast("int").alias("salts"), "held")
    sized = nodes.join(sizes, ["label", "dim"])
    share = F.col("k") * graph.sample / F.col("held")
    drawn = sized.filter(F.pmod(F.xxhash64("vec_id"), F.lit(1_000_003)) < share * 1_000_003)
    centroids = drawn.select("label", "dim", "vec_id", "k", "v").groupBy("label", "dim").applyInArrow(_train, f"{_KEY}, c binary")
    centroids = sizes.join(centroids, ["label", "dim"], "left").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))
    )
    salted = sized.withColumn("salt", F.pmod(F.xxhash64(F.lit(2), F.col("vec_id")), "salts").cast("int"))
    key = ["label", "dim", "salt"]
    return (
        salted.select(*key, "vec_id", "copies", "v")
        .groupBy(*key)
        .cogroup(_anew(centroids, *key, "c").groupBy(*key))
        .applyInArrow(_assign(graph, threshold), _ASSIGNED)
    )


def _unit(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    """Rows of a list column, in double precision, at length one."""
    flat = pa.chunked_array(column).combine_chunks().flatten().to_numpy(zero_copy_only=False)
    x = flat.reshape(-1, dim)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _packed(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, dim)


def _train(key: tuple, table: pa.Table) -> pa.Table:
    """Centroids by a few rounds of k-means on the sphere; the first rows by hash order are the seeds."""
    label, dim = (k.as_py() for k in key)
    order = np.argsort((table.column("vec_id").to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    x = _unit(table.column("v"), dim)[order]
    k = min(table.column("k")[0].as_py(), len(x))
    c = x[:k].copy()
    for _ in range(8 if k > 1 else 1):
        near = (x @ c.T).argmax(axis=1)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        length = np.sqrt((total * total).sum(axis=1, keepdims=True))
        c = np.where(length > 1e-9, total / np.maximum(length, 1e-9), c)
    return pa.table({"label": pa.array([label], pa.int64()), "dim": pa.array([dim], pa.int32()), "c": [c.tobytes()]})


def _assign(graph: Graph, threshold: float):
    margin = np.arccos(threshold)  # no shard farther than the nearest by more than a link's angle

    def rows(key: tuple, held: pa.Table, centroids: pa.Table) -> pa.Table:
        label, dim, _ = (k.as_py() for k in key)
        x = _unit(held.column("v"), dim)
        raw = centroids.column("c")[0].as_py() if len(centroids) else None
        c = np.frombuffer(raw, np.float64).reshape(-1, dim) if raw else np.ones((1, dim))
        joins = min(graph.overlap, len(c))
        sims = x @ c.T
        order = np.argsort(-sims, axis=1, kind="stable")[:, :joins]
        angle = np.arccos(np.clip(np.take_along_axis(sims, order, axis=1), -1, 1))
        row, place = np.nonzero(angle <= angle[:, :1] + margin)
        ids, copies = held.column("vec_id").to_numpy(), held.column("copies").to_numpy()
        blobs = [row.tobytes() for row in x]
        return pa.table(
            {
                "label": pa.array([label] * len(row), pa.int64()),
                "dim": pa.array([dim] * len(row), pa.int32()),
                "vec_id": ids[row],
                "copies": copies[row],
                "v": pa.array([blobs[i] for i in row], pa.binary()),
                "shard": order[row, place].astype(np.int32),
                "home": place == 0,
            }
        )

    return rows


# --- graph -----------------------------------------------------------------------------------


def pruned_graph(x: np.ndarray, graph: Graph, seed: int = 0) -> np.ndarray:
    """Neighbour numbers per row of unit vectors, -1 where there are fewer than ``degree``.

    All rows are pruned together: in each step every row keeps its nearest open candidate and closes
    those for which ``slack * distance(kept, candidate) <= distance(row, candidate)``.
    """
    n = len(x)
    if n < 2:
        return np.full((n, 1), -1, np.int64)
    x = x.astype(np.float32)
    sims = x @ x.T
    np.fill_diagonal(sims, -2)
    near = min(graph.near, n - 1)
    candidates = np.argpartition(-sims, near - 1, axis=1)[:, :near]
    far = np.random.default_rng(seed).integers(0, n, (n, graph.far))
    candidates = np.concatenate([candidates, far], axis=1)
    away = 2 - 2 * np.take_along_axis(sims, candidates, axis=1)
    away[candidates == np.arange(n)[:, None]] = np.inf
    kept = np.full((n, min(graph.degree, candidates.shape[1])), -1, np.int64)
    rows = np.arange(n)
    for step in range(kept.shape[1]):
        best = away.argmin(axis=1)
        open_rows = np.isfinite(away[rows, best])
        if not open_rows.any():
            break
        pick = candidates[rows, best]
        kept[open_rows, step] = pick[open_rows]
        between = 2 - 2 * sims[pick[:, None], candidates]
        between[candidates == pick[:, None]] = 0
        away[open_rows[:, None] & (graph.slack * between <= away)] = np.inf
    return kept


def _build(graph: Graph):
    def rows(key: tuple, table: pa.Table) -> pa.Table:
        dim = key[1].as_py()
        order = np.argsort(table.column("vec_id").to_numpy())
        ids = table.column("vec_id").to_numpy()[order]
        kept = pruned_graph(_packed(table.column("v"), dim)[order], graph)
        source, place = np.nonzero(kept >= 0)
        target = kept[source, place]
        both = np.unique(np.stack([np.concatenate([source, target]), np.concatenate([target, source])], axis=1), axis=0)
        lengths = np.bincount(both[:, 0], minlength=len(ids)) if len(both) else np.zeros(len(ids), int)
        offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
        near = ids[both[:, 1]] if len(both) else ids[:0]
        return pa.table({"vec_id": ids, "near": pa.ListArray.from_arrays(offsets, pa.array(near, pa.int64()))})

    return rows


def range_search(
    x: np.ndarray, near: np.ndarray, entries: np.ndarray, queries: np.ndarray, own: np.ndarray, low: float, beam: int
) -> np.ndarray:
    """Similarities (queries by rows of ``x``) of all rows visited, -2 elsewhere.

    All queries walk in step. A query expands its best rows that are within its beam or above ``low``,
    until none is left. ``own`` is the query's own row, or -1.
    """
    at_once = 8
    sims = np.full((len(queries), len(x)), -2, np.float32)
    done = np.zeros(sims.shape, bool)
    sims[:, entries] = queries @ x[entries].T
    has = np.flatnonzero(own >= 0)
    sims[has, own[has]] = 1.0
    active = np.arange(len(queries))
    beam, at_once = min(beam, len(x)), min(at_once, len(x))
    while len(active):
        mine = sims[active]
        worst = -np.partition(-mine, beam - 1, axis=1)[:, beam - 1]
        bar = np.minimum(np.maximum(worst, -1.5), low)
        open_sims = np.where(done[active], -2, mine)
        pick = np.argpartition(-open_sims, at_once - 1, axis=1)[:, :at_once]
        good = np.take_along_axis(open_sims, pick, axis=1) >= bar[:, None]
        row, place = np.nonzero(good)
        if not len(row):
            break
        node, query = pick[row, place], active[row]
        done[query, node] = True
        target = near[node]
        row, place = np.nonzero(target >= 0)
        pair = np.unique(query[row] * len(x) + target[row, place])
        query, node = np.divmod(pair, len(x))
        fresh = sims[query, node] < -1.5
        query, node = query[fresh], node[fresh]
        for i in range(0, len(query), 100_000):
            part = slice(i, i + 100_000)
            sims[query[part], node[part]] = np.einsum("ij,ij->i", queries[query[part]], x[node[part]])
        active = active[good.any(axis=1)]
    return sims


def _search(graph: Graph, threshold: float):
    def rows(key: tuple, held: pa.Table, asked: pa.Table) -> pa.Table:
        if len(held) == 0 or len(asked) == 0:
            return _FOUND_NONE
        dim = key[1].as_py()
        order = np.argsort(held.column("vec_id").to_numpy())
        ids = held.column("vec_id").to_numpy()[order]
        x = _packed(held.column("v"), dim)[order]
        copies, home = (held.column(c).to_numpy()[order] for c in ("copies", "home"))
        near = _local_lists(held.column("near"), order, ids)
        q_order = np.argsort(asked.column("vec_id").to_numpy())
        q_ids, q = asked.column("vec_id").to_numpy()[q_order], _packed(asked.column("v"), dim)[q_order]
        own = np.searchsorted(ids, q_ids)
        own = np.where((own < len(ids)) & (ids[np.minimum(own, len(ids) - 1)] == q_ids), own, -1)
        single = x.astype(np.float32)
        entries = _medoids(single, graph.entries)
        a, b = [], []
        for i in range(0, len(q), 512):
            part = slice(i, i + 512)
            sims = range_search(single, near, entries, q[part].astype(np.float32), own[part], threshold - graph.range_slack, graph.beam)
            row, node = np.nonzero(sims >= threshold - 1e-3)
            row += i
            keep = ids[node] != q_ids[row]
            row, node = row[keep], node[keep]
            for j in range(0, len(row), 100_000):
                r, m = row[j : j + 100_000], node[j : j + 100_000]
                exact = np.einsum("ij,ij->i", q[r], x[m]) >= threshold
                a.append(r[exact])
                b.append(m[exact])
        a, b = np.concatenate([*a, [0][:0]]).astype(np.int64), np.concatenate([*b, [0][:0]]).astype(np.int64)
        if own.min() >= 0 and len(q) == home.sum():  # the whole home in one task: what one end found holds for both
            back = home[b]
            to_query = np.full(len(ids), -1)
            to_query[own] = np.arange(len(q))
            code = np.unique(np.concatenate([a * len(ids) + b, to_query[b[back]] * len(ids) + own[a[back]]]))
            a, b = np.divmod(code, len(ids))
        inside = home[b]
        count = np.bincount(a[inside], weights=copies[b[inside]], minlength=len(q)).astype(np.int64)
        root = _roots(np.concatenate([q_ids, ids]), a, len(q) + b)
        spans = np.unique(np.stack([np.concatenate([q_ids[a], ids[b]]), root[np.concatenate([a, len(q) + b])]], axis=1), axis=0)
        spans = spans[spans[:, 0] != spans[:, 1]]
        some = np.flatnonzero(count)
        kinds = np.repeat([COUNT, PAIR, SPAN], [len(some), int((~inside).sum()), len(spans)]).astype(np.int32)
        return pa.table(
            {
                "kind": kinds,
                "a": np.concatenate([q_ids[some], q_ids[a[~inside]], spans[:, 0]]).astype(np.int64),
                "b": np.concatenate([q_ids[some], ids[b[~inside]], spans[:, 1]]).astype(np.int64),
                "n": np.concatenate([count[some], np.zeros(len(kinds) - len(some), np.int64)]),
            }
        )

    return rows


_FOUND_NONE = pa.table(
    {"kind": pa.array([], pa.int32()), "a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "n": pa.array([], pa.int64())}
)


def _local_lists(column: pa.ChunkedArray, order: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """United adjacency lists as row numbers of this chunk, -1 for none; nodes of other chunks are left out."""
    lists = column.combine_chunks().take(pa.array(order))
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    row = np.repeat(np.arange(len(ids)), lists.value_lengths().to_numpy())
    target = lists.flatten().to_numpy()
    at = np.minimum(np.searchsorted(ids, target), len(ids) - 1)
    here = ids[at] == target
    row, at = row[here], at[here]
    counts = np.bincount(row, minlength=len(ids))
    near = np.full((len(ids), max(1, counts.max(initial=0))), -1, np.int64)
    near[row, np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)] = at
    return near


def _medoids(x: np.ndarray, k: int) -> np.ndarray:
    """The row nearest the mean, then rows far from those chosen, each moved to the medoid of its cell."""
    first = int((x @ x.mean(axis=0)).argmax())
    chosen, closest = [first], x @ x[first]
    while len(chosen) < min(k, len(x)):
        chosen.append(int(closest.argmin()))
        closest = np.maximum(closest, x @ x[chosen[-1]])
    cell = (x @ x[chosen].T).argmax(axis=1)
    return np.unique([c[(x[c] @ x[c].mean(axis=0)).argmax()] for c in (np.flatnonzero(cell == i) for i in range(len(chosen))) if len(c)])


def _roots(names: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each place the smallest name that the links ``(a, b)`` lead to; equal names are one."""
    unique, number = np.unique(names, return_inverse=True)
    root = np.arange(len(unique))
    a, b = number[a], number[b]
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        root = root[root]
        if (root == before).all():
            break
    return unique[root[number]]


# --- audit -----------------------------------------------------------------------------------


def _recall(nodes: DataFrame, counts: DataFrame, threshold: float, audited: int) -> float:
    """The lower of found links over all links and of the mean of that share per vector.

    A bounded sample of all nodes is compared with all rows by brute force; those of it that have a link
    count. It is drawn without regard to what was found, so vectors that lost all links show.
    """
    drawn = nodes.orderBy(F.xxhash64(F.lit(3), F.col("vec_id"))).limit(audited).select("vec_id")
    sample = nodes.join(F.broadcast(drawn), "vec_id").select("vec_id", "label", "dim", "v").collect()
    if not sample:
        return 1.0
    groups: dict[tuple, tuple[list[int], list]] = {}
    for r in sample:
        ids, rows = groups.setdefault((r.label, r.dim), ([], []))
        ids.append(r.vec_id)
        rows.append(r.v)
    packed = {k: (np.array(i, np.int64), _unit(pa.chunked_array([pa.array(v)]), k[1])) for k, (i, v) in groups.items()}

    def count(batches):
        for batch in batches:
            labels, dims = batch.column("label").to_numpy(), batch.column("dim").to_numpy()
            for (label, dim), (ids, q) in packed.items():
                at = np.flatnonzero((labels == label) & (dims == dim))
                if len(at):
                    part = batch.take(pa.array(at))
                    x = _unit(pa.chunked_array([part.column("v")]), dim)
                    hit = (q @ x.T >= threshold) & (ids[:, None] != part.column("vec_id").to_numpy()[None, :])
                    yield pa.record_batch({"vec_id": ids, "want": hit.astype(np.int64) @ part.column("copies").to_numpy()})

    want = nodes.mapInArrow(count, "vec_id long, want long").groupBy("vec_id").agg(F.sum("want").alias("want"))
    both = want.filter("want > 0").join(counts, "vec_id", "left")
    found = F.least("want", F.coalesce("n", F.lit(0)))
    got = both.agg(F.sum("want").alias("want"), F.sum(found).alias("found"), F.avg(found / F.col("want")).alias("mean")).first()
    return min(got.found / got.want, got.mean) if got.want else 1.0
