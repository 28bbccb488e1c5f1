"""Near-duplicate vectors by hierarchical navigable small-world graphs, one per shard.

Equal vectors are one node. Nodes are dealt to shards by hash, as many as there are cores or as memory asks
for: each query walks every graph it is sent to, so more shards mean more work. A task builds the graph of
its shard and then takes its own nodes and those of half of the other shards as queries, in batches: of two
shards one asks the other, and what it finds counts for both. Queries of a batch walk the graph together in
numpy. A beam starts at a width at which the shard's audit passes: sampled nodes, and copies of them moved to the
edge of a link as queries from outside the shard, against brute force, the beam doubled until enough of
the links are found; a node is not its own link. The beam of a query is doubled again for as long as all
it holds are links, so that large groups are found whole. Every link is verified by its
cosine in double precision.

A task gives the numbers of links and a spanning forest of all links it saw, at most
(queries + shard) edges, so groups of near copies are not expanded into pairs. Components are joined from
the forests.

Defined results: vectors that are null, zero, empty or hold null or non-finite values have no links and
are their own component; vectors of unequal length are never linked; rows with a null id keep it, and
count as copies but name no component; repeated rows are copies of each other. An empty table gives no
rows. Other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import partitions, settled
from tillstream.llm.components import components

LEAST_COSINE = 0.95
NEIGHBOURS = 12  # links of a node on upper levels; twice as many at the bottom
BUILD_BEAM = 48
FIRST_BEAM = 24
AUDIT, AUDIT_RECALL = 256, 0.99
# Most nodes of a shard; more nodes make more shards than there are cores.
SHARD = 200_000
_EXPANDED = 4


def _top(scores: np.ndarray, count: int) -> np.ndarray:
    """Places of the `count` largest of each row, best first."""
    if scores.shape[1] > count:
        part = np.argpartition(-scores, count - 1, axis=1)[:, :count]
        order = np.argsort(-np.take_along_axis(scores, part, 1), axis=1, kind="stable")
        return np.take_along_axis(part, order, 1)
    return np.argsort(-scores, axis=1, kind="stable")


class Graph:
    """A graph over unit vectors (float32); similarity is the inner product."""

    def __init__(self, vectors: np.ndarray, seed: int = 5):
        self.vectors = vectors
        n = len(vectors)
        rng = np.random.default_rng(seed)
        drawn = np.floor(-np.log(1 - rng.random(n)) / np.log(NEIGHBOURS)).astype(int)
        self.levels = np.minimum(drawn, 6)
        top = int(self.levels.max()) if n else 0
        self.links = [
            np.full((n, NEIGHBOURS * (1 if k else 2)), -1, np.int32) for k in range(top + 1)
        ]
        # The highest nodes come first, so that a level is complete before lower nodes look for it.
        self.order = np.lexsort((rng.random(n), -self.levels))
        self.entry = self.order[:1]
        done = min(n, 1)
        while done < n:
            size = min(max(32, done), 512, n - done)
            self._insert(self.order[done : done + size])
            done += size

    def _walk(self, queries: np.ndarray, start: np.ndarray, beam: int, level: int):
        """Best `beam` nodes of each query on a level: places and similarities, best first."""
        count = len(queries)
        ids = np.full((count, beam), -1, np.int64)
        scores = np.full((count, beam), -np.inf, np.float32)
        open_ = np.zeros((count, beam), bool)
        seen = np.zeros((count, len(self.vectors)), bool)
        rows = np.arange(count)
        given = min(start.shape[1], beam)
        ids[:, :given] = start[:, :given]
        valid = ids >= 0
        scores[valid] = np.einsum(
            "nd,nd->n", self.vectors[ids[valid]], queries[np.nonzero(valid)[0]]
        )
        # A start given twice would fill the beam with itself.
        order = np.argsort(ids, axis=1, kind="stable")
        sorted_ids = np.take_along_axis(ids, order, 1)
        twice = np.zeros_like(valid)
        np.put_along_axis(
            twice, order[:, 1:], (sorted_ids[:, 1:] == sorted_ids[:, :-1]), axis=1
        )
        ids[twice], scores[twice] = -1, -np.inf
        open_ = ids >= 0
        seen[np.nonzero(open_)[0], ids[open_]] = True
        links = self.links[level]
        width = min(_EXPANDED, beam)
        live = rows
        while len(live):
            waiting = np.where(open_[live], scores[live], -np.inf)
            place = _top(waiting, width)
            usable = np.take_along_axis(waiting, place, 1) > -np.inf
            keep = usable[:, 0]
            live, place, usable = live[keep], place[keep], usable[keep]
            if not len(live):
                break
            at = np.where(usable, ids[live[:, None], place], -1)
            open_[live[:, None], place] = False
            near = np.where(at[:, :, None] >= 0, links[at], -1).reshape(len(live), -1)
            fresh = (near >= 0) & ~seen[live[:, None], np.maximum(near, 0)]
            r, c = np.nonzero(fresh)
            node = near[r, c]
            # The same node may come from several neighbours at once: the first counts.
            _, first = np.unique(live[r] * np.int64(len(self.vectors)) + node, return_index=True)
            r, c, node = r[first], c[first], node[first]
            seen[live[r], node] = True
            value = np.full(near.shape, -np.inf, np.float32)
            value[r, c] = np.einsum("nd,nd->n", self.vectors[node], queries[live[r]])
            all_scores = np.concatenate([scores[live], value], axis=1)
            all_ids = np.concatenate([ids[live], near], axis=1)
            all_open = np.concatenate([open_[live], value > -np.inf], axis=1)
            best = _top(all_scores, beam)
            scores[live] = np.take_along_axis(all_scores, best, 1)
            ids[live] = np.where(scores[live] > -np.inf, np.take_along_axis(all_ids, best, 1), -1)
            open_[live] = np.take_along_axis(all_open, best, 1)
        return ids, scores

    def search(self, queries: np.ndarray, beam: int, level: int = 0):
        """Best `beam` nodes of each query: (ids, similarities), -1 and -inf where there are fewer."""
        start = np.broadcast_to(self.entry, (len(queries), len(self.entry)))
        for upper in range(len(self.links) - 1, level, -1):
            start, _ = self._walk(queries, start, 4, upper)
        return self._walk(queries, start, beam, level)

    def _spread(self, base: np.ndarray, ids: np.ndarray, scores: np.ndarray, most: int):
        """Of candidates, best first, those closer to the base than to any chosen before them; then
        the best of the rest."""
        held = self.vectors[np.maximum(ids, 0)]
        among = held @ held.transpose(0, 2, 1)
        good = (ids >= 0) & (ids != base[:, None])
        chosen = np.zeros_like(good)
        nearest = np.full(scores.shape, -np.inf, np.float32)
        for k in range(ids.shape[1]):
            take = good[:, k] & (scores[:, k] > nearest[:, k]) & (chosen.sum(axis=1) < most)
            chosen[take, k] = True
            nearest[take] = np.maximum(nearest[take], among[take, k])
        rank = np.where(good, scores + np.where(chosen, np.float32(4), 0), -np.inf)
        place = _top(rank, most)
        found = np.where(
            np.take_along_axis(rank, place, 1) > -np.inf, np.take_along_axis(ids, place, 1), -1
        )
        out = np.full((len(ids), most), -1, np.int64)
        out[:, : found.shape[1]] = found
        return out

    def _insert(self, nodes: np.ndarray) -> None:
        for level in range(min(int(self.levels[nodes].max()), len(self.links) - 1), -1, -1):
            part = nodes[self.levels[nodes] >= level]
            queries = self.vectors[part]
            ids, scores = self.search(queries, BUILD_BEAM, level)
            # Nodes of one batch don't find each other in the graph.
            mutual = queries @ queries.T
            np.fill_diagonal(mutual, -np.inf)
            near = _top(mutual, 16)
            ids = np.concatenate([ids, part[near]], axis=1)
            scores = np.concatenate([scores, np.take_along_axis(mutual, near, 1)], axis=1)
            scores[ids == part[:, None]] = -np.inf
            best = _top(scores, BUILD_BEAM)
            ids, scores = np.take_along_axis(ids, best, 1), np.take_along_axis(scores, best, 1)
            ids = np.where(scores > -np.inf, ids, -1)
            chosen = self._spread(part, ids, scores, NEIGHBOURS)
            links = self.links[level]
            links[part, :NEIGHBOURS] = chosen
            self._link_back(part, chosen, links)

    def _link_back(self, part: np.ndarray, chosen: np.ndarray, links: np.ndarray) -> None:
        source = np.repeat(part, chosen.shape[1])[chosen.ravel() >= 0]
        target = chosen.ravel()[chosen.ravel() >= 0]
        value = np.einsum("nd,nd->n", self.vectors[source], self.vectors[target])
        order = np.lexsort((-value, target))
        source, target = source[order], target[order]
        starts = np.flatnonzero(np.r_[True, target[1:] != target[:-1]])
        nth = np.arange(len(target)) - np.repeat(starts, np.diff(np.r_[starts, len(target)]))
        keep = nth < 32
        source, target, nth = source[keep], target[keep], nth[keep]
        nodes, row = np.unique(target, return_inverse=True)
        added = np.full((len(nodes), 32), -1, np.int64)
        added[row, nth] = source
        ids = np.concatenate([links[nodes].astype(np.int64), added], axis=1)
        held = self.vectors[np.maximum(ids, 0)]
        scores = np.where(ids >= 0, np.einsum("nkd,nd->nk", held, self.vectors[nodes]), -np.inf)
        order = np.argsort(-scores, axis=1, kind="stable")
        ids, scores = np.take_along_axis(ids, order, 1), np.take_along_axis(scores, order, 1)
        ids[:, 1:][(ids[:, 1:] == ids[:, :-1])] = -1
        links[nodes] = self._spread(nodes, ids, scores.astype(np.float32), links.shape[1])

    def _audit_queries(self, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Queries and, of each, the place of itself (-1: none): copies of sampled nodes moved to a
        cosine just above `least`, as queries from outside the graph, and the sampled nodes."""
        n = len(self.vectors)
        picked = np.unique(np.linspace(0, n - 1, AUDIT).astype(int))
        nodes = self.vectors[picked]
        aside = np.random.default_rng(7).normal(size=nodes.shape)
        aside -= np.einsum("nd,nd->n", aside, nodes)[:, None] * nodes
        aside /= np.maximum(np.linalg.norm(aside, axis=1), 1e-12)[:, None]
        cosine = least + 0.1 * (1 - least)
        moved = cosine * nodes + np.sqrt(1 - cosine**2) * aside
        moved /= np.linalg.norm(moved, axis=1)[:, None]
        yield moved.astype(np.float32), np.full(len(picked), -1)
        yield nodes, picked

    def audited_beam(self, least: float) -> int:
        """The beam at which the links of queries from outside and of sampled nodes are found, by brute
        force: enough of all links, and of each query's on average. No node counts as its own link."""
        n = len(self.vectors)
        beam = FIRST_BEAM
        for queries, own in self._audit_queries(least):
            wanted = np.zeros((len(queries), n), bool)
            for a in range(0, len(queries), 32):
                wanted[a : a + 32] = queries[a : a + 32] @ self.vectors.T >= least
            itself = np.flatnonzero(own >= 0)
            wanted[itself, own[itself]] = False
            links = wanted.sum(axis=1)
            some = links > 0
            while beam < n and some.any():
                found = np.zeros_like(wanted)
                for rows, nodes in self.within(queries, least - 1e-5, beam):
                    found[rows, nodes] = True
                hits = (found & wanted).sum(axis=1)
                each = (hits[some] / links[some]).mean()
                if min(hits.sum() / links.sum(), each) >= AUDIT_RECALL:
                    break
                beam *= 2
        return min(beam, n)

    def within(self, queries: np.ndarray, least: float, beam: int):
        """All found (query, node) pairs with a similarity of about `least` or more."""
        size = max(8, min(256, (64 << 20) // max(1, len(self.vectors))))
        for begin in range(0, len(queries), size):
            waiting, width = np.arange(begin, min(begin + size, len(queries))), beam
            while len(waiting):
                ids, scores = self.search(queries[waiting], width)
                full = scores[:, -1] >= least
                if width >= len(self.vectors):
                    full[:] = False
                rows, places = np.nonzero((scores >= least) & ~full[:, None])
                yield waiting[rows], ids[rows, places]
                waiting = waiting[full]
                width = min(2 * width, len(self.vectors))


class _Shard:
    """A shard's nodes of one length, its graph, and the forest of the links seen so far."""

    def __init__(self, ids: np.ndarray, copies: np.ndarray, vectors: np.ndarray, least: float):
        self.ids, self.copies = ids, copies
        self.exact = vectors.astype(np.float64)
        self.norms = np.sqrt((self.exact**2).sum(axis=1))
        self.graph = Graph((self.exact / self.norms[:, None]).astype(np.float32))
        self.beam = self.graph.audited_beam(least)
        self.trees = np.arange(len(ids))

    def answer(
        self, ids: np.ndarray, vectors: np.ndarray, least: float, copies: np.ndarray | None = None
    ):
        """(ids with links, their numbers of links), and new forest edges. With the queries' `copies` the
        shard's nodes have the links as well: they are not asked about these queries."""
        exact = vectors.astype(np.float64)
        norms = np.sqrt((exact**2).sum(axis=1))
        unit = (exact / norms[:, None]).astype(np.float32)
        counts, back = np.zeros(len(ids), np.int64), np.zeros(len(self.ids), np.int64)
        edges: list[tuple[int, int]] = []
        for query, node in self.graph.within(unit, least - 1e-5, self.beam):
            cosine = np.einsum("nd,nd->n", exact[query], self.exact[node])
            cosine /= norms[query] * self.norms[node]
            good = (cosine >= least) & (ids[query] != self.ids[node])
            query, node = query[good], node[good]
            np.add.at(counts, query, self.copies[node])
            if copies is not None:
                np.add.at(back, node, copies[query])
            order = np.argsort(query, kind="stable")
            query, node = query[order], node[order]
            starts = np.flatnonzero(np.r_[True, query[1:] != query[:-1]])[: len(query)]
            for a, b in zip(starts, np.r_[starts[1:], len(query)]):
                trees, first = np.unique(self.trees[node[a:b]], return_index=True)
                edges += [(ids[query[a]], self.ids[node[a + k]]) for k in first]
                if len(trees) > 1:
                    self.trees[np.isin(self.trees, trees)] = trees[0]
        found, held = np.flatnonzero(counts), np.flatnonzero(back)
        return np.r_[ids[found], self.ids[held]], np.r_[counts[found], back[held]], edges


def _usable() -> str:
    finite = "x is not null and not isnan(x) and abs(x) < double('infinity')"
    return f"size(embedding) > 0 and forall(embedding, x -> {finite}) and exists(embedding, x -> x <> 0)"


def shard_count(nodes: int, cores: int) -> int:
    """One shard for each core, more where a shard would be too large for a task."""
    return max(1, cores, -(-nodes // SHARD))


def asked_shards(own: Column, shards: int) -> Column:
    """The other shards that nodes of shard `own` are sent to: the next ones round the circle up to the
    opposite one, so that of any two shards exactly one asks the other."""
    ahead = F.when(own < shards // 2, shards // 2).otherwise((shards - 1) // 2)
    steps = F.filter(F.sequence(F.lit(0), F.lit(shards // 2)), lambda k: (k > 0) & (k <= ahead))
    return F.transform(steps, lambda k: F.pmod(own + k, F.lit(shards)))


def near_duplicates(vectors: DataFrame, least: float = LEAST_COSINE) -> DataFrame:
    """`vec_id`, `n_links`, `component_id`, `kept` of each row of (vec_id, embedding)."""
    spark = vectors.sparkSession
    source = vectors.select("vec_id", F.col("embedding"), F.expr(_usable()).alias("usable"))
    usable = source.filter("usable")
    classes = settled(
        usable.groupBy("embedding").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies")),
        "nodes",
    )
    nodes = classes.filter("node is not null")
    shards = shard_count(nodes.count(), min(partitions(spark), spark.sparkContext.defaultParallelism))
    own = F.pmod(F.xxhash64("node"), F.lit(shards)).cast("int")
    # 0: the nodes of a shard, 1: the same as queries, 2: queries of other shards.
    asked = F.array(
        F.struct(own.alias("shard"), F.lit(0).alias("order")),
        F.struct(own.alias("shard"), F.lit(1).alias("order")),
    )
    others = F.transform(
        asked_shards(own, shards), lambda s: F.struct(s.cast("int").alias("shard"), F.lit(2).alias("order"))
    )
    dealt = (
        nodes.select(F.explode(F.concat(asked, others)).alias("to"), "node", "copies", "embedding")
        .select("to.shard", "to.order", "node", "copies", "embedding")
        .repartitionById(shards, F.col("shard"))
        .sortWithinPartitions("shard", "order", "node")
    )

    def matrix(batch: pa.RecordBatch, rows: np.ndarray) -> Iterator[tuple]:
        """Rows of a batch by the length of their vectors: ids, copies, vectors."""
        lists = batch.column(4).take(pa.array(rows))
        lengths = np.diff(lists.offsets.to_numpy())
        ids, copies = batch.column(2).to_numpy()[rows], batch.column(3).to_numpy()[rows]
        for length in np.unique(lengths):
            some = np.flatnonzero(lengths == length)
            flat = lists.take(pa.array(some)).flatten().to_numpy()
            yield int(length), ids[some], copies[some], flat.reshape(len(some), length)

    def answers(batch, rows: np.ndarray, both: bool, parts: dict, ready: dict) -> Iterator[pa.RecordBatch]:
        """What a shard, built with the first query of each length, tells of queries."""
        for length, ids, copies, values in matrix(batch, rows):
            if length in parts:
                gathered = [np.concatenate(x) for x in zip(*parts.pop(length))]
                ready[length] = _Shard(*gathered, least)
            if length not in ready:
                continue
            found, counts, edges = ready[length].answer(ids, values, least, copies if both else None)
            u = np.r_[found, [a for a, _ in edges]].astype(np.int64)
            v = [None] * len(found) + [int(b) for _, b in edges]
            n = np.r_[counts, np.zeros(len(edges), np.int64)].astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(u), pa.array(v, pa.int64()), pa.array(n)], ["u", "v", "links"]
            )

    def made(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, parts, ready = None, {}, {}
        for batch in batches:
            number, order = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for value in np.unique(number):
                if value != shard:
                    shard, parts, ready = value, {}, {}
                for length, *rest in matrix(batch, np.flatnonzero((number == value) & (order == 0))):
                    parts.setdefault(length, []).append(rest)
                for kind in (1, 2):
                    asked = np.flatnonzero((number == value) & (order == kind))
                    yield from answers(batch, asked, kind == 2, parts, ready)

    # Rows with v are forest edges, the others numbers of links.
    seen = settled(dealt.mapInArrow(made, "u long, v long, links long"), "links")
    joined = components(seen.select("u", "v"))
    counts = seen.groupBy(F.col("u").alias("node")).agg(F.sum("links").alias("links"))
    told = (
        classes.join(counts, "node", "left")
        .join(joined, "node", "left")
        .select(
            "embedding",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "node").alias("component_id"),
        )
    )
    linked = usable.join(told, "embedding").select("vec_id", "n_links", "component_id")
    alone = source.filter("not coalesce(usable, false)").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))
