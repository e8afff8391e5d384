"""Near-duplicate embeddings by hierarchical navigable small-world graphs, one for each shard.

Vectors are compared inside a label only. Equal vectors are one node with a count. The nodes of a label are dealt into
shards of about ``SHARD`` nodes, and each shard builds its graph: layers of fewer and fewer nodes, whose links are chosen
so that they lead in different directions. Each pair of shards of a label is then one task that searches all nodes of one
shard in the graph of the other: from the top layer down, and in the lowest layer by a beam. A query whose beam is
full of links is searched again with twice the beam. A hundredth of the queries, or more until 32 of them have links, is also compared by
brute force; if a query with links found less than ``RECALL`` of them on average, so that a large group cannot hide sparse queries, all
queries of the task get twice the beam, until the audit passes (a beam as wide as the shard is exact). The nodes of the other shard are
audited against the links found; only if that fails they are searched too. Cosines are computed in double precision, so every
link reported is one.

A task holds two shards whatever the label's size, returns its links as spanning trees and as counts for each node, and the trees are
joined by `components`.

Defined cases: vectors that are null, empty or zero, hold null or non-finite components, or have a null label or null id
link with nothing and are their own component; vectors of different lengths are not compared; rows that repeat an id are vectors of
their own; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderweave.llm.components import components, flatten, join_trees
from orderweave.session import materialize

THRESHOLD = 0.93
SHARD = 16_384
#: Links of a node in the lowest layer and in the others, and the beams for building and searching.
LINKS, UPPER_LINKS = 32, 16
BUILD_BEAM, SEARCH_BEAM = 64, 48
RECALL = 0.98
#: A hundredth of the queries is audited, and more of them until so many of the audited have links.
AUDIT_EVERY, AUDIT_LINKED = 100, 32
#: Nodes inserted, and queries searched, together; nodes of a beam expanded at a time.
BATCH, STEP = 256, 4
#: Cells of the matrix of links that are unpacked at a time.
CELLS = 1 << 20


def unit_rows(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _beam(x: np.ndarray, links: np.ndarray, queries: np.ndarray, entry: np.ndarray, width: int,
          note=None) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, cosines), best first, of a beam search for all queries at once; -1 where a beam is not full.

    ``note(rows, nodes, cosines)`` sees everything that is computed on the way.
    """
    n = len(queries)
    rows = np.arange(n)
    # for each query and node, in one row
    seen, claim = np.zeros(n * len(x), bool), np.empty(n * len(x), np.int32)
    nodes = np.full((n, width), -1)
    cosine = np.full((n, width), -np.inf)
    done = np.ones((n, width), bool)
    nodes[:, 0], cosine[:, 0], done[:, 0] = entry, (x[entry] * queries).sum(axis=1), False
    seen[rows * len(x) + entry] = True
    if note:
        note(rows, entry[:, None], cosine[:, :1])
    active = rows
    while active.size:
        open_ = ~done[active]
        active, open_ = active[open_.any(axis=1)], open_[open_.any(axis=1)]
        if not active.size:
            break
        # the first open nodes of each beam, which is in order
        turn = np.cumsum(open_, axis=1)
        pick = open_ & (turn <= STEP)
        done[active] |= pick
        at, place = np.nonzero(pick)
        listed = links[nodes[active[at], place]]
        of, c = np.nonzero(listed >= 0)
        local, node = at[of], listed[of, c]
        cell = active[local] * len(x) + node
        fresh = ~seen[cell]
        local, node, cell = local[fresh], node[fresh], cell[fresh]
        # a node may be a link of several that are expanded together: the last to claim it has it
        turn = np.arange(len(cell), dtype=np.int32)
        claim[cell] = turn
        mine = claim[cell] == turn
        local, node, cell = local[mine], node[mine], cell[mine]
        seen[cell] = True
        many = np.bincount(local, minlength=len(active))
        c = np.arange(len(local)) - np.repeat(np.cumsum(many) - many, many)
        near = np.full((len(active), int(many.max())), -1)
        near[local, c] = node
        found = np.full(near.shape, -np.inf)
        found[local, c] = np.einsum("ij,ij->i", x[node], queries[active[local]])
        if note:
            note(active, near, found)
        all_nodes = np.concatenate([nodes[active], near], axis=1)
        all_cosine = np.concatenate([cosine[active], found], axis=1)
        all_done = np.concatenate([done[active], near < 0], axis=1)
        best = np.argpartition(-all_cosine, width - 1, axis=1)[:, :width]
        best = np.take_along_axis(best, np.argsort(-np.take_along_axis(all_cosine, best, axis=1), axis=1), axis=1)
        nodes[active] = np.take_along_axis(all_nodes, best, axis=1)
        cosine[active] = np.take_along_axis(all_cosine, best, axis=1)
        done[active] = np.take_along_axis(all_done, best, axis=1)
    return nodes, cosine


def _spread(x: np.ndarray, nodes: np.ndarray, cosine: np.ndarray, m: int) -> np.ndarray:
    """m links of each row's candidates (best first): those nearer to the row than to any link taken, then the best rest."""
    n, k = nodes.shape
    known = nodes >= 0
    vectors = np.where(known[:, :, None], x[nodes], 0)
    between = vectors @ vectors.transpose(0, 2, 1)
    taken = np.zeros((n, k), bool)
    for j in range(k):
        nearest = np.where(taken, between[:, j], -np.inf).max(axis=1)
        taken[:, j] = known[:, j] & (cosine[:, j] > nearest) & (taken.sum(axis=1) < m)
    order = np.argsort(np.where(taken, 0, np.where(known, 1, 2)), axis=1, kind="stable")[:, :m]
    out = np.take_along_axis(nodes, order, axis=1)
    return np.pad(out, ((0, 0), (0, m - out.shape[1])), constant_values=-1) if out.shape[1] < m else out


def _layer(x: np.ndarray, order: np.ndarray, m: int, entries) -> np.ndarray:
    """Links (-1: none) of all nodes in ``order``; entries(queries) names nodes among those inserted first.

    While the layer grows a node may hold half as many links again, so it chooses anew only after ``m / 2`` links back.
    """
    room = m + m // 2
    links = np.full((len(x) + 1, room), -1)
    degree = np.zeros(len(x), np.int64)
    for begin in range(0, len(order), BATCH):
        new = order[begin:begin + BATCH]
        inside = x[new] @ x[new].T
        np.fill_diagonal(inside, -np.inf)
        k = min(m, len(new) - 1)
        top = np.argsort(-inside, axis=1, kind="stable")[:, :k]
        nodes, cosine = new[top], np.take_along_axis(inside, top, axis=1)
        if begin:
            start = entries(x[new]) if entries else np.full(len(new), order[0])
            older, older_cosine = _beam(x, links, x[new], start, BUILD_BEAM)
            nodes, cosine = np.concatenate([nodes, older], axis=1), np.concatenate([cosine, older_cosine], axis=1)
            best = np.argsort(-cosine, axis=1, kind="stable")
            nodes, cosine = np.take_along_axis(nodes, best, axis=1), np.take_along_axis(cosine, best, axis=1)
        if not nodes.shape[1]:
            continue
        links[new, :m] = _spread(x, nodes, cosine, m)
        # links back, into free places; a list may hold a node of the same batch already
        degree[new] = (links[new, :m] >= 0).sum(axis=1)
        source, target = np.repeat(new, m), links[new, :m].ravel()
        source, target = source[target >= 0], target[target >= 0]
        fresh = ~(links[target] == source[:, None]).any(axis=1)
        by = np.argsort(target[fresh], kind="stable")
        source, target = source[fresh][by], target[fresh][by]
        touched, first, many = np.unique(target, return_index=True, return_counts=True)
        place = degree[target] + np.arange(len(target)) - np.repeat(first, many)
        fits = np.repeat(degree[touched] + many <= room, many)
        links[target[fits], place[fits]] = source[fits]
        over = degree[touched] + many > room
        degree[touched[~over]] += many[~over]
        # nodes with too many choose again
        touched, first, many = touched[over], first[over], many[over]
        for part in range(0, len(touched), BATCH):
            at, begins, counts = (v[part:part + BATCH] for v in (touched, first, many))
            wide = np.full((len(at), int(counts.max())), -1)
            column = np.arange(wide.shape[1])
            r, c = np.nonzero(column < counts[:, None])
            wide[r, c] = source[begins[r] + c]
            links[at, :m], links[at, m:] = _chosen(x, at, np.concatenate([links[at], wide], axis=1), m), -1
            degree[at] = (links[at, :m] >= 0).sum(axis=1)
    over = np.flatnonzero(links[:-1, m] >= 0)
    for part in range(0, len(over), BATCH):
        at = over[part:part + BATCH]
        links[at, :m] = _chosen(x, at, links[at], m)
    return links[:-1, :m]


def _chosen(x: np.ndarray, rows: np.ndarray, near: np.ndarray, m: int) -> np.ndarray:
    """m links of each row out of lists in any order (-1: none); of a longer list the best 2 * m are looked at."""
    cosine = np.where(near >= 0, np.einsum("ij,ikj->ik", x[rows], x[near]), -np.inf)
    best = np.argsort(-cosine, axis=1, kind="stable")[:, :2 * m]
    return _spread(x, np.take_along_axis(near, best, axis=1), np.take_along_axis(cosine, best, axis=1), m)


class Graph:
    """The graph of one shard. Which layers a node is in follows from its place, so a shard's graph is always the same."""

    def __init__(self, x: np.ndarray):
        self.x = x
        n = len(x)
        chance = np.random.default_rng(n).random(n)
        level = np.floor(-np.log(1 - chance) / math.log(UPPER_LINKS)).astype(int)
        order = np.lexsort((chance, -level))
        self.top = int(order[0])
        self.layers: list[np.ndarray] = []  # from the top
        for height in range(int(level.max()), -1, -1):
            members = order[level[order] >= height]
            links = _layer(x, members, LINKS if height == 0 else UPPER_LINKS, self._enter if self.layers else None)
            self.layers.append(links)

    def _enter(self, queries: np.ndarray) -> np.ndarray:
        at = np.full(len(queries), self.top)
        for links in self.layers[:max(1, len(self.layers))]:
            at = _beam(self.x, links, queries, at, 1)[0][:, 0]
        return at

    def links_of(self, queries: np.ndarray, threshold: float, beam: int) -> np.ndarray:
        """Found links, as a matrix of queries by nodes."""
        return np.unpackbits(self.packed_links_of(queries, threshold, beam), axis=1, count=len(self.x)).view(bool)

    def packed_links_of(self, queries: np.ndarray, threshold: float, beam: int, own: bool = False) -> np.ndarray:
        """Found links, as a matrix of queries by nodes with eight nodes a byte.

        If the queries are the nodes, in order (``own``), the lowest layer is entered at the query itself.
        """
        packed = np.zeros((len(queries), (len(self.x) + 7) // 8), np.uint8)
        upper = self.layers[:-1]
        for begin in range(0, len(queries), BATCH):
            block = queries[begin:begin + BATCH]
            hits = np.zeros((len(block), len(self.x)), bool)
            rows = np.arange(len(block))
            at = begin + rows if own else np.full(len(rows), self.top)
            for links in () if own else upper:
                at = _beam(self.x, links, block, at, 1)[0][:, 0]
            width = beam
            while rows.size:
                def note(r: np.ndarray, nodes: np.ndarray, cosine: np.ndarray, rows: np.ndarray = rows,
                         hits: np.ndarray = hits) -> None:
                    i, j = np.nonzero(cosine >= threshold)
                    hits[rows[r[i]], nodes[i, j]] = True

                if width >= len(self.x) or width > beam and width * LINKS >= len(self.x):
                    # such a beam would meet nearly every node by its links; one product meets all
                    hits[rows] |= block[rows] @ self.x.T >= threshold
                    break
                _, cosine = _beam(self.x, self.layers[-1], block[rows], at, width, note)
                full = cosine[:, -1] >= threshold
                rows, at, width = rows[full], at[full], 2 * width
            packed[begin:begin + len(block)] = np.packbits(hits, axis=1)
        return packed


def share_found(hits: np.ndarray, exact: np.ndarray) -> float:
    """The mean share of its links that a query with links found; 1 if none has any. Both matrices are packed."""
    wanted = np.bitwise_count(exact).sum(axis=1, dtype=np.int64)
    got = np.bitwise_count(hits & exact).sum(axis=1, dtype=np.int64)
    return float((got[wanted > 0] / wanted[wanted > 0]).mean()) if wanted.any() else 1.0


def _exact(graph: Graph, queries: np.ndarray, threshold: float) -> np.ndarray:
    """All links of the queries, packed."""
    return np.concatenate([
        np.packbits(queries[b:b + BATCH] @ graph.x.T >= threshold, axis=1) for b in range(0, max(1, len(queries)), BATCH)])


def audit(graph: Graph, queries: np.ndarray, order: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(audited queries, their links, packed): the first of ``order``, and more of it until enough of them have links."""
    end = min(len(order), max(8, -(-len(order) // AUDIT_EVERY)))
    exact = _exact(graph, queries[order[:end]], threshold)
    while end < len(order) and np.count_nonzero(exact.any(axis=1)) < AUDIT_LINKED:
        more = min(len(order), 2 * end)
        exact = np.concatenate([exact, _exact(graph, queries[order[end:more]], threshold)])
        end = more
    return order[:end], exact


def search(graph: Graph, queries: np.ndarray, ids: np.ndarray, threshold: float, own: bool = False) -> np.ndarray:
    """Links of all queries, packed; the beam is widened until the audited queries have enough of theirs."""
    beam = SEARCH_BEAM
    audited, exact = audit(graph, queries, _audit_order(ids), threshold)
    while True:
        hits = graph.packed_links_of(queries, threshold, beam, own)
        if share_found(hits[audited], exact) >= RECALL or beam >= len(graph.x):
            return hits
        beam *= 2


def met_from(there: np.ndarray, graph: Graph, queries: np.ndarray, ids: np.ndarray, threshold: float) -> bool:
    """Whether the links found from the graph's nodes (packed: nodes by queries) hold enough of those the queries have."""
    audited, exact = audit(graph, queries, _audit_order(ids), threshold)
    turned = (there[:, audited >> 3] >> (7 - (audited & 7)).astype(np.uint8) & 1).T
    return share_found(np.packbits(turned, axis=1), exact) >= RECALL


def _audit_order(ids: np.ndarray) -> np.ndarray:
    """Queries in an order that only their ids decide and that says nothing about their vectors."""
    mixed = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return np.lexsort((ids, mixed ^ mixed >> np.uint64(29)))


def _vectors(table: pa.Table) -> np.ndarray:
    flat = table.column("vector").combine_chunks()
    return unit_rows(flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(table), -1))


def _build(table: pa.Table) -> pa.Table:
    """One row for a shard: its ids, counts and graph."""
    order = np.argsort(table.column("rep").to_numpy())
    ids, counts = table.column("rep").to_numpy()[order], table.column("n").to_numpy()[order]
    graph = Graph(_vectors(table)[order])
    packed = pickle.dumps((ids, counts, graph.x, graph.top, [layer.astype(np.int32) for layer in graph.layers]))
    return pa.table({
        **{c: table.column(c).slice(0, 1) for c in ("label", "width", "shard", "shards")},
        "graph": pa.array([packed], pa.binary())})


def _unpack(packed: bytes) -> tuple[np.ndarray, np.ndarray, Graph]:
    ids, counts, x, top, layers = pickle.loads(packed)  # written by `_build` of this job
    graph = Graph.__new__(Graph)
    graph.x, graph.top, graph.layers = x, top, [layer.astype(np.int64) for layer in layers]
    return ids, counts, graph


def _either_way(there: np.ndarray, back: np.ndarray | None, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """Blocks of rows of the links found from either side, with the first row's place; the matrices are packed."""
    step = max(8, CELLS // width // 8 * 8)
    for begin in range(0, len(there), step):
        hits = np.unpackbits(there[begin:begin + step], axis=1, count=width).view(bool)
        if back is None:
            yield begin, hits
            continue
        turned = np.unpackbits(back[:, begin // 8:(begin + step) // 8], axis=1)[:, :len(hits)].view(bool)
        yield begin, hits | turned.T


def _pair(threshold: float):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("shard")
        sides = [_unpack(g.as_py()) for g in table.column("graph")]
        ids_a, counts_a, a = sides[0]
        ids_b, counts_b, b = sides[-1]
        single = len(sides) == 1
        there = search(b, a.x, ids_a, threshold, own=single)
        back = there if single else None if met_from(there, a, b.x, ids_b, threshold) else search(a, b.x, ids_b, threshold)
        ids, shift = (ids_a, 0) if single else (np.r_[ids_a, ids_b], len(ids_a))
        linked_a, linked_b = np.zeros(len(ids_a)), np.zeros(len(ids_b))  # whole numbers, exact up to 2 ** 53
        label = np.arange(len(ids))
        for begin, hits in _either_way(there, back, len(ids_b)):
            if single:
                np.fill_diagonal(hits[:, begin:], False)
            i, j = np.nonzero(hits)
            linked_a[begin:begin + len(hits)] = np.bincount(i, counts_b[j], len(hits))
            linked_b += np.bincount(j, counts_a[begin + i], len(ids_b))
            join_trees(label, i + begin, j + shift)
        found = [(ids_a, linked_a)] if single else [(ids_a, linked_a), (ids_b, linked_b)]
        flatten(label)
        hung = np.flatnonzero(label != np.arange(len(ids)))
        u, n = (np.concatenate(c) for c in zip(*found))
        some = n > 0
        return pa.table({
            "u": pa.array(np.r_[ids[hung], u[some]], pa.int64()),
            "v": pa.array([*ids[label[hung]].tolist(), *[None] * int(some.sum())], pa.int64()),
            "n": pa.array([*[None] * len(hung), *n[some].astype(np.int64).tolist()], pa.int64())})

    return run


def nodes(vectors: DataFrame) -> DataFrame:
    """label, vector, rep (smallest id of the equal vectors) and n, for everything that can link."""
    sound = ~F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))) & F.exists(
        "embedding", lambda v: v != 0)
    return (
        vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("embedding") > 0))
        .where(sound).groupBy("label", F.col("embedding").alias("vector"))
        .agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"))
    )


def links(found: DataFrame, threshold: float = THRESHOLD, shard: int = SHARD) -> DataFrame:
    """(u, v) of spanning trees, and (u, n): how many vectors u is linked to outside its equal ones."""
    sizes = materialize(
        found.groupBy(F.col("label").alias("of"), F.size("vector").alias("width")).agg(
            F.ceil(F.count("*") / shard).cast("int").alias("shards")), "label-sizes")
    dealt = found.join(sizes, (F.col("label") == F.col("of")) & (F.size("vector") == F.col("width"))).select(
        "label", "width", "shards", F.pmod(F.xxhash64("rep"), F.col("shards")).cast("int").alias("shard"),
        "vector", "rep", "n")
    kind = dict(found.dtypes)["label"]
    graphs = materialize(dealt.groupBy("label", "width", "shard").applyInArrow(
        _build, f"label {kind}, width int, shard int, shards int, graph binary"), "graphs")
    other = F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("other")
    paired = graphs.select("*", other).withColumns({
        "lo": F.least("shard", "other"), "hi": F.greatest("shard", "other")})
    return materialize(paired.groupBy("label", "width", "lo", "hi").applyInArrow(
        lambda t: _pair(threshold)(t), "u long, v long, n long"), "embedding-links")


def embedding_classes(vectors: DataFrame, threshold: float = THRESHOLD, shard: int = SHARD) -> DataFrame:
    """vec_id, n_links, component_id and kept of every vector."""
    vectors = vectors.select("vec_id", "embedding", "label")
    known = materialize(nodes(vectors), "vectors")
    found = links(known, threshold, shard)
    joined = components(found.where("v IS NOT NULL").select("u", "v"))
    counts = found.where("n IS NOT NULL").groupBy(F.col("u").alias("counted")).agg(F.sum("n").alias("outside"))
    classes = (
        known.join(joined, F.col("rep") == F.col("node"), "left").join(counts, F.col("rep") == F.col("counted"), "left")
        .select(F.col("label").alias("l"), F.col("vector").alias("e"), F.coalesce("component", "rep").alias("component"),
                (F.col("n") - 1 + F.coalesce("outside", F.lit(0))).alias("links"))
    )
    classes = materialize(classes, "vector-classes")
    # a null id is no node, whatever its vector equals
    same = F.col("vec_id").isNotNull() & (F.col("label") == F.col("l")) & (F.col("embedding") == F.col("e"))
    return vectors.join(classes, same, "left").select(
        "vec_id", F.coalesce("links", F.lit(0)).alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
