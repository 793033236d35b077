"""Near-duplicate embeddings by a robust-pruned flat graph.

Equal directions of one label are folded into one node. The nodes of a label are
dealt to cluster shards by their likeness to pivots, whose number grows with the nodes, up to
twice the square root of all; a node within ``MARGIN`` of its best pivot belongs to the
other shard, too, so shards overlap. Shards are cut in chunks of bounded size. For each chunk
a flat graph is built: of a node's nearest candidates those are kept that no nearer kept one
leads to (robust pruning), and in the same way a few of its nearest hubs. Hubs are a
sixteenth of the nodes and the medoids, both of clusters and of the parts that nothing
else reaches (groups of near copies, whose lists hold each other only). Links run both
ways, and a node's adjacency lists of all its shards are united.

Every node is a query in its own shard, against all that overlap into it, so each link counts
once at either end. A query meets the medoids of a chunk's clusters, about the square
root of its nodes, and walks on greedily: it expands the best of a list of ``LIST`` candidates until
all of the list are expanded, then all that lies about its range, until nothing new
does. So it compares itself with a part of a chunk that hardly grows with the chunk, besides
its hits. Cosines are computed in double precision. Of the links a group of
hits sends a count per query and a spanning forest, never the pairs.

Recall is audited against brute force over all nodes: the mean over sampled nodes that have
a partner, whatever the size of their groups; nodes are drawn until ``AUDITED`` of these are
found, ``DRAWN`` were looked at or none is left. If none was found, nodes that the
search has linked are audited. If recall is too low, the search is repeated with a wider overlap.

Blocks of queries meet chunks of a shard, so a hot shard is many tasks of bounded
memory; their number grows with the square of its blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import components, stage, unstage

#: Nodes of a shard, about, and at most of a chunk or block of queries (about).
SHARD, BLOCK = 1024, 2048
#: Least bound of the pivots, taken from the nodes by hash; overlap of shards in cosine.
PIVOTS, MARGIN = 128, 0.12
#: Candidates of a node, links it keeps, slack of the pruning.
POOL, DEGREE, ALPHA = 24, 12, 1.2
#: One node in so many is a hub; hubs that a node looks at, and that it keeps.
HUB, HUBS_SEEN, HUBS = 16, 12, 4
#: Candidates on a query's list, of which so many are expanded at once.
LIST, AT_ONCE = 24, 4
#: How far below its range, in cosine, a search still expands.
SLACK = 0.1
#: Nodes with a partner whose recall is audited, nodes drawn for them at most (about), and the recall wanted.
AUDITED, DRAWN, RECALL = 256, 4096, 0.95
PAIRS_AT_ONCE = 1 << 16
QUERIES_AT_ONCE = 512
LIKENESS_AT_ONCE = 1 << 22


def directions(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """``(key, label, dim, vec)``: packed unit vectors; null where a row links with nothing."""
    kind = vectors.schema[label].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, packed = [], []
            for value, name in zip(batch.column(2), batch.column(1), strict=True):
                unit = None
                if value.is_valid and name.is_valid and not value.values.null_count and len(value):
                    x = np.asarray(value.values.to_numpy(zero_copy_only=False), np.float64)
                    most = np.abs(x).max()
                    if np.isfinite(most) and most > 0:
                        x = x / most
                        unit = (x / np.sqrt(x @ x) + 0.0).astype("<f8").tobytes()
                dims.append(len(value) if unit else None)
                packed.append(unit)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(dims, pa.int32()), pa.array(packed, pa.binary())],
                names=["key", "label", "dim", "vec"],
            )

    source = vectors.select(F.col(key).cast("long").alias("key"), F.col(label).alias("label"), F.col(vector).alias("value"))
    return source.mapInArrow(run, f"key long, label {kind}, dim int, vec binary")


# --- one chunk --------------------------------------------------------------------


def _prune(vecs: np.ndarray, among: np.ndarray, pool: int, degree: int, alpha: float) -> np.ndarray:
    """The kept links ``[node, degree]`` of each node to nodes of ``among``, -1 where there are fewer."""
    n, others = len(vecs), vecs[among]
    pool = min(pool, len(among) - 1)
    kept = np.full((n, degree), -1, np.int64)
    if pool < 1:
        return kept
    place = np.full(n, -1)
    place[among] = np.arange(len(among))
    for start in range(0, n, 256):
        rows = np.arange(start, min(n, start + 256))
        each = np.arange(len(rows))
        likeness = vecs[rows] @ others.T
        self_ = np.flatnonzero(place[rows] >= 0)
        likeness[self_, place[rows][self_]] = -2
        near = np.argpartition(-likeness, pool - 1, axis=1)[:, :pool]
        order = np.argsort(-np.take_along_axis(likeness, near, 1), axis=1, kind="stable")
        near = np.take_along_axis(near, order, 1)
        apart = np.sqrt(np.maximum(2 - 2 * np.take_along_axis(likeness, near, 1), 0))
        between = alpha * np.sqrt(np.maximum(2 - 2 * others[near] @ others[near].transpose(0, 2, 1), 0))
        open_ = np.ones(near.shape, bool)
        for k in range(degree):
            first = open_.argmax(axis=1)
            any_ = open_[each, first]
            if not any_.any():
                break
            kept[rows[any_], k] = among[near[each, first][any_]]
            open_ &= between[each, first] > apart
            open_[each, first] = False
    return kept


def _links(kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    source, slot = np.nonzero(kept >= 0)
    return source, kept[source, slot]


def _medoids(vecs: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Of each group the node most like its mean."""
    _, group = np.unique(group, return_inverse=True)
    sums = np.zeros((group.max() + 1, vecs.shape[1]))
    np.add.at(sums, group, vecs)
    order = np.lexsort((-np.einsum("nd,nd->n", vecs, sums[group]), group))
    return order[np.searchsorted(group[order], np.arange(len(sums)))]


def build(vecs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(from, to, entries) of the flat graph of a chunk; links run both ways."""
    n = len(vecs)
    source, target = _links(_prune(vecs, np.arange(n), POOL, DEGREE, ALPHA))
    root = np.arange(n)
    while True:  # least node of each part, by halving
        low = root.copy()
        np.minimum.at(low, source, root[target])
        np.minimum.at(low, target, root[source])
        low = low[low]
        if (low == root).all():
            break
        root = low
    seeds = vecs[np.linspace(0, n - 1, int(np.ceil(np.sqrt(n)))).astype(int)]
    entries = _medoids(vecs, (vecs @ seeds.T).argmax(axis=1))
    islands = _medoids(vecs, root)
    hubs = np.unique(np.concatenate([np.arange(0, n, HUB), entries, islands]))
    parts = [(source, target), _links(_prune(vecs, hubs, HUBS_SEEN, HUBS, 1.0))]
    # the entries reach every part: medoids of parts are tied to their nearest entries
    likeness = vecs[islands] @ vecs[entries].T
    nearest = np.argsort(-likeness, axis=1, kind="stable")[:, :HUBS]
    parts.append((np.repeat(islands, nearest.shape[1]), entries[nearest].ravel()))
    parts.append((np.full(len(entries), entries[0]), entries))
    source, target = (np.concatenate(ends) for ends in zip(*parts, strict=True))
    return np.append(source, target), np.append(target, source), entries


def search(queries: np.ndarray, vecs: np.ndarray, starts: np.ndarray, links: np.ndarray, entries: np.ndarray, least: float) -> np.ndarray:
    """``hits[query, node]``: nodes found with a cosine of at least ``least``.

    ``links[starts[v] : starts[v + 1]]`` are those of node v.
    """
    walks = [
        _walk(queries[k : k + QUERIES_AT_ONCE], vecs, starts, links, entries, least)[0] for k in range(0, len(queries), QUERIES_AT_ONCE)
    ]
    return np.concatenate(walks)


def _walk(
    queries: np.ndarray, vecs: np.ndarray, starts: np.ndarray, links: np.ndarray, entries: np.ndarray, least: float
) -> tuple[np.ndarray, int]:
    """The hits, and how many cosines were computed."""
    m, n = len(queries), len(vecs)
    hits, seen, expanded = (np.zeros((m, n), bool) for _ in range(3))
    wide = max(LIST, AT_ONCE)
    compared = m * len(entries)

    def expand(query: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What is new beside these nodes: (query, node, cosine)."""
        nonlocal compared
        expanded[query, node] = True
        news = []
        step = max(1, PAIRS_AT_ONCE * 4 // max(1, int(np.diff(starts).max(initial=1))))
        for k in range(0, len(query), step):
            q, v = query[k : k + step], node[k : k + step]
            many = starts[v + 1] - starts[v]
            q = np.repeat(q, many)
            w = links[np.arange(len(q)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(starts[v], many)]
            new = ~seen[q, w]
            pair = np.unique(q[new] * n + w[new])
            seen[pair // n, pair % n] = True
            news.append(pair)
        pair = np.concatenate(news) if news else np.zeros(0, np.int64)
        q, w = pair // n, pair % n
        cosine = np.empty(len(pair))
        for k in range(0, len(pair), PAIRS_AT_ONCE):
            of = slice(k, k + PAIRS_AT_ONCE)
            cosine[of] = np.einsum("id,id->i", queries[q[of]], vecs[w[of]])
        compared += len(pair)
        hit = cosine >= least
        hits[q[hit], w[hit]] = True
        order = np.argsort(q, kind="stable")
        return q[order], w[order], cosine[order]

    cosine = queries @ vecs[entries].T
    seen[:, entries] = True
    q, e = np.nonzero(cosine >= least)
    hits[q, entries[e]] = True
    q, e = np.nonzero(cosine >= least - SLACK)
    about = [(q, entries[e])]
    first = np.argsort(-cosine, axis=1, kind="stable")[:, :wide]
    fill = ((0, 0), (0, wide - first.shape[1]))
    best = np.pad(np.take_along_axis(cosine, first, 1), fill, constant_values=-3.0)
    listed = np.pad(entries[first], fill, constant_values=-1)
    done = best < -2
    while not done.all():
        of = np.argpartition(np.where(done, 3.0, -best), AT_ONCE - 1, axis=1)[:, :AT_ONCE]
        row, slot = np.nonzero(~np.take_along_axis(done, of, 1))
        slot = of[row, slot]
        done[row, slot] = True
        q, v, cosine = expand(row, listed[row, slot])
        near = cosine >= least - SLACK
        about.append((q[near], v[near]))
        better = cosine > best.min(axis=1)[q]
        q, v, cosine = q[better], v[better], cosine[better]
        if not len(q):
            continue
        many = np.bincount(q, minlength=m)
        at = np.arange(len(q)) - (np.cumsum(many) - many)[q]
        more, value = np.full((m, many.max()), -1), np.full((m, many.max()), -3.0)
        more[q, at], value[q, at] = v, cosine
        listed, best, done = np.append(listed, more, 1), np.append(best, value, 1), np.append(done, value < -2, 1)
        top = np.argpartition(-best, wide - 1, axis=1)[:, :wide]
        listed, best, done = (np.take_along_axis(x, top, 1) for x in (listed, best, done))
    q, v = (np.concatenate(ends) for ends in zip(*about, strict=True))
    while len(q):
        left = ~expanded[q, v]
        q, v, cosine = expand(q[left], v[left])
        near = cosine >= least - SLACK
        q, v = q[near], v[near]
    return hits, compared


# --- shards -------------------------------------------------------------------------


_GROUP = ["label", "dim", "shard"]


def members(nodes: DataFrame, margin: float) -> DataFrame:
    """``(label, dim, shard, node, vec, n, own, block, blocks, asks)`` for each shard of each node.

    A shard is ``blocks`` chunks of nodes and ``asks`` blocks of queries.
    """
    spark = nodes.sparkSession
    sizes = nodes.groupBy("label", "dim").agg(F.ceil(F.count("*") / SHARD).alias("shards"))
    many = max(PIVOTS, 2 * int(np.ceil(np.sqrt(nodes.count()))))
    chosen = nodes.select("dim", "vec").orderBy(F.xxhash64("vec"), "vec").limit(many).collect()
    pivots: dict[int, np.ndarray] = {}
    for dim in {row["dim"] for row in chosen}:
        pivots[dim] = np.stack([np.frombuffer(row["vec"], "<f8") for row in chosen if row["dim"] == dim])
    shared = spark.sparkContext.broadcast(pivots)  # as many vectors as the square root of all, twice

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for frame in frames:
            for (dim, shards), group in frame.groupby(["dim", "shards"]):
                use = known.get(dim, np.zeros((0, dim)))[: int(shards)]
                if len(use) < 2:
                    yield group.assign(shard=0, own=True).drop(columns="shards")
                    continue
                step = max(1, LIKENESS_AT_ONCE // len(use))
                for start in range(0, len(group), step):
                    part = group.iloc[start : start + step]
                    likeness = np.stack([np.frombuffer(v, "<f8") for v in part["vec"]]) @ use.T
                    best = likeness.argmax(axis=1)
                    row, shard = np.nonzero(likeness >= likeness.max(axis=1, keepdims=True) - margin)
                    yield part.iloc[row].assign(shard=shard, own=shard == best[row]).drop(columns="shards")

    label = nodes.schema["label"].dataType.simpleString()
    dealt = stage(
        nodes.join(sizes, ["label", "dim"])
        .select("label", "dim", "node", "vec", "n", "shards")
        .mapInPandas(run, f"label {label}, dim int, node long, vec binary, n long, shard int, own boolean"),
        "graph-shards",
    )
    blocks = dealt.groupBy(*_GROUP).agg(
        F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"), F.greatest(F.lit(1), F.ceil(F.count_if("own") / BLOCK)).cast("int").alias("asks")
    )
    return dealt.join(blocks, _GROUP).withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))


def index(dealt: DataFrame) -> tuple[DataFrame, DataFrame]:
    """United adjacency lists ``(node, near)``, and the entries ``(label, dim, shard, block, node)``."""
    label = dealt.schema["label"].dataType.simpleString()

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("node")
        nodes = frame["node"].to_numpy()
        source, target, entries = build(np.stack([np.frombuffer(v, "<f8") for v in frame["vec"]]))
        order = np.lexsort((target, source))
        ends = np.searchsorted(source[order], np.arange(len(nodes) + 1))
        near = [np.unique(nodes[target[order[a:b]]]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        entry = np.isin(np.arange(len(nodes)), entries)
        return frame[[*_GROUP, "block", "node"]].assign(near=near, entry=entry)

    built = stage(
        dealt.groupBy(*_GROUP, "block").applyInPandas(
            run, f"label {label}, dim int, shard int, block int, node long, near array<long>, entry boolean"
        ),
        "graph-index",
    )
    united = built.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    return united, built.where("entry").select(*_GROUP, "block", "node", "entry")


def found(dealt: DataFrame, least: float) -> DataFrame:
    """``(a, b, links)``: with b null the number of links of node a in a chunk, else a link of a forest."""
    united, entries = index(dealt)
    both = dealt.join(united, "node").join(entries, [*_GROUP, "block", "node"], "left")
    asks = F.pmod(F.xxhash64(F.lit("asked"), "node"), "asks").cast("int").alias("asked")
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    asked = dealt.where("own").select(
        *_GROUP, asks, every, "node", "vec", F.lit(None).cast("long").alias("n"), F.lit(None).cast("array<long>").alias("near"), F.lit(None).cast("boolean").alias("entry")
    )
    meets = F.explode(F.sequence(F.lit(0), F.col("asks") - 1)).alias("asked")
    there = both.select(*_GROUP, meets, "block", "node", "vec", "n", "near", F.coalesce("entry", F.lit(False)).alias("entry"))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        asks = frame["entry"].isna().to_numpy()
        queries, nodes = frame[asks], frame[~asks].sort_values("node")
        if not len(queries) or not len(nodes):
            return pd.DataFrame({"a": [], "b": [], "links": []})
        left = np.stack([np.frombuffer(v, "<f8") for v in queries["vec"]])
        right = np.stack([np.frombuffer(v, "<f8") for v in nodes["vec"]])
        ids = nodes["node"].to_numpy(np.int64)
        lists = [np.asarray(x, np.int64) for x in nodes["near"]]
        flat = np.concatenate(lists)
        at = np.searchsorted(ids, flat)
        here = (at < len(ids)) & (ids[np.minimum(at, len(ids) - 1)] == flat)  # the others are searched in their shards
        source = np.repeat(np.arange(len(ids)), [len(x) for x in lists])[here]
        starts = np.searchsorted(source, np.arange(len(ids) + 1))
        hits = search(left, right, starts, at[here], np.flatnonzero(nodes["entry"].to_numpy(bool)), least)
        asked_ids = queries["node"].to_numpy(np.int64)
        hits &= asked_ids[:, None] != ids[None, :]
        links = hits.astype(np.int64) @ nodes["n"].to_numpy(np.int64)
        some = np.flatnonzero(links)
        tied = _forest(hits, asked_ids, ids)
        return pd.concat(
            [pd.DataFrame({"a": asked_ids[some], "b": pd.NA, "links": links[some]}), pd.DataFrame({"a": tied[:, 0], "b": tied[:, 1], "links": pd.NA})]
        ).astype("Int64")

    grouped = there.unionByName(asked).groupBy(*_GROUP, "asked", "block")
    return grouped.applyInPandas(run, "a long, b long, links long")


def _forest(hits: np.ndarray, asked: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Links that span what the hits tie together, as pairs of nodes."""
    root: dict[int, int] = {}

    def top(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    kept = []
    for k in np.flatnonzero(hits.any(axis=1)):
        a = int(asked[k])
        for b in ids[hits[k]].tolist():
            x, y = top(a), top(b)
            if x != y:
                root[max(x, y)] = min(x, y)
                kept.append((a, b))
    return np.array(kept, np.int64).reshape(-1, 2)


def partnered(nodes: DataFrame, least: float) -> list[tuple[int, int]]:
    """(node, links to others) of sampled nodes that brute force over all nodes shows to have a partner."""
    count, known, drawn, many = nodes.count(), [], 0.0, AUDITED
    while count and drawn < 1 and len(known) < AUDITED and many <= DRAWN:
        upto = min(1.0, many / count)
        part = F.pmod(F.xxhash64(F.lit("audit"), "node"), F.lit(1 << 40))
        known += _brute(nodes, nodes.where((part >= int(drawn * (1 << 40))) & (part < int(upto * (1 << 40)))), least)
        drawn, many = upto, many * 4
    return known


def _brute(nodes: DataFrame, sample: DataFrame, least: float) -> list[tuple[int, int]]:
    by: dict = {}
    for r in sample.select("node", "label", "dim", "vec").collect():
        of = by.setdefault((r["label"], r["dim"]), ([], []))
        of[0].append(r["node"])
        of[1].append(r["vec"])
    shared = nodes.sparkSession.sparkContext.broadcast(by)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        asked = {of: (np.array(ids), np.stack([np.frombuffer(v, "<f8") for v in vecs])) for of, (ids, vecs) in shared.value.items()}
        real = {of: np.zeros(len(ids), np.int64) for of, (ids, _) in asked.items()}
        for frame in frames:
            for of, group in frame.groupby(["label", "dim"]):
                if of not in asked:
                    continue
                ids, vecs = asked[of]
                for start in range(0, len(group), 1024):
                    part = group.iloc[start : start + 1024]
                    near = np.stack([np.frombuffer(v, "<f8") for v in part["vec"]]) @ vecs.T >= least
                    near &= part["node"].to_numpy()[:, None] != ids[None, :]
                    real[of] += part["n"].to_numpy() @ near
        for of, found_ in real.items():
            some = found_ > 0
            yield pd.DataFrame({"node": asked[of][0][some], "real": found_[some]})

    real = nodes.select("label", "dim", "node", "vec", "n").mapInPandas(run, "node long, real long")
    return [tuple(r) for r in real.groupBy("node").agg(F.sum("real")).collect()]


def audit(asked: DataFrame, totals: DataFrame, many: int) -> float | None:
    """Mean share of the links found of the ``many`` nodes of ``asked (node, real)``; none where there are none."""
    share = F.least(F.lit(1.0), F.coalesce("links", F.lit(0)) / F.col("real"))
    return asked.join(totals, "node", "left").agg(F.sum(share) / many).first()[0] if many else None


def near_duplicates(
    vectors: DataFrame, least: float = 0.98, key: str = "vec_id", vector: str = "embedding", label: str = "label", recall: float = RECALL
) -> DataFrame:
    """``(key, n_links, component_id, kept)`` for each row of ``vectors``.

    Rows link if their labels are equal and not null and their cosine is at least
    ``least``. Vectors that are null, empty, zero or hold null or non-finite
    components link with nothing, nor do vectors of different lengths. Repeated rows
    link with each other and keep their number. A row with a null key gets the least
    key of the others it reaches, else null, and is kept only in the latter case.
    Each row has the ``audited_recall`` of the run and the number of nodes it is the
    mean of, ``audited_nodes``; it is null where no node drawn has a partner and the
    search found no link.
    """
    rows = stage(directions(vectors, key, vector, label), "graph-rows")
    nodes = stage(
        rows.where("vec IS NOT NULL")
        .groupBy("label", "dim", "vec")
        .agg(F.count("*").alias("n"), F.min("key").alias("low"))
        .withColumn("node", F.monotonically_increasing_id()),
        "graph-nodes",
    )
    sampled = partnered(nodes, least)
    asked = vectors.sparkSession.createDataFrame(sampled, "node long, real long")
    margin = MARGIN
    while True:
        dealt = stage(members(nodes, margin), "graph-members")
        hits = stage(found(dealt, least), "graph-hits")
        totals = hits.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
        if not sampled:  # none was drawn that has a partner: some that the search found
            linked = nodes.join(totals.select("node").orderBy(F.xxhash64("node"), "node").limit(AUDITED), "node")
            sampled = _brute(nodes, linked, least)
            asked = vectors.sparkSession.createDataFrame(sampled, "node long, real long")
        reached = audit(asked, totals, len(sampled))
        if reached is None or reached >= recall or margin >= 0.4:
            break
        unstage(dealt)
        margin *= 2
    if reached is not None and reached < min(recall, 0.9):
        raise RuntimeError(f"the search found only {reached:.3f} of the links of a node, over {len(sampled)} audited")
    groups = components(hits.where("b IS NOT NULL").select("a", "b"))
    rooted = nodes.join(groups, "node", "left").withColumn("root", F.coalesce("component", "node"))
    lows = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    known = rooted.join(lows, "root").join(totals, "node", "left")
    per_node = known.select("label", "dim", "vec", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    linked = rows.where("vec IS NOT NULL").join(per_node, ["label", "dim", "vec"]).select("key", "n_links", "component_id")
    alone = rows.where("vec IS NULL").select("key", F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component_id"))
    return linked.unionByName(alone).select(
        F.col("key").alias(key), "n_links", "component_id", F.col("key").eqNullSafe(F.col("component_id")).alias("kept"),
        F.lit(reached).cast("double").alias("audited_recall"), F.lit(len(sampled)).cast("long").alias("audited_nodes"),
    )
