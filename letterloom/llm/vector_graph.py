"""Near duplicates among embeddings by a robust-pruned flat graph over overlapping shards."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from letterloom.llm.common import cut, join_groups
from letterloom.llm.components import components


@dataclass(frozen=True)
class GraphOptions:
    """How the graph is built and searched. Links are exact whatever these are; recall is not.

    ``shard_rows`` vectors per centroid on average, of which there are ``most_centroids`` at most, fitted
    on ``sample`` vectors at most; each vector goes to ``overlap`` shards. A shard with more than
    ``largest`` vectors is split into chunks and each two chunks make a shard, so all its pairs stay.
    ``near``, ``degree``, ``far``, ``width`` and ``stretch``: candidates, kept edges, random edges, the most
    edges after reverse ones and other shards' are added, and the factor of the pruning rule. ``beam``: of the greedy search. ``slack``: range expansion passes through vectors
    that are this much less similar than a link. ``audited``: vectors of each stratum that the audit asks for.
    """

    similarity: float = 0.9
    shard_rows: int = 1_000
    most_centroids: int = 1_024
    sample: int = 30_000
    overlap: int = 3
    largest: int = 4_000
    near: int = 40
    degree: int = 20
    far: int = 4
    width: int = 48
    stretch: float = 1.2
    beam: int = 16
    slack: float = 0.05
    audited: int = 64
    least_recall: float = 0.97


def unit_vectors(rows: DataFrame, width: int, column: str = "v") -> DataFrame:
    """``column`` as a unit vector of doubles, or null where it links with nothing.

    Null and zero vectors and those with null or non-finite parts become null; shorter ones end in zeros.
    """

    @F.pandas_udf("array<double>")
    def unit(values: pd.Series) -> pd.Series:
        out = []
        for value in values:
            whole = None
            if value is not None and len(value):
                whole = np.zeros(width)
                whole[: len(value)] = np.array(value, dtype=float)
                peak = np.abs(whole).max()
                whole = whole / peak if np.isfinite(peak) and peak > 0 else None
            out.append(None if whole is None else whole / np.linalg.norm(whole))
        return pd.Series(out, dtype=object)

    return rows.withColumn(column, unit(F.col(column).cast("array<double>")))


def fit_centroids(sample: np.ndarray, count: int, rounds: int = 8) -> np.ndarray:
    """Directions of clusters; those closer than a cosine of 0.8 to an earlier one are left out.

    Groups of near copies thus lie around one centroid and not between several.
    """
    centres = sample[:count].copy()
    for _ in range(rounds):
        nearest = (sample @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 1e-9, sums / np.maximum(norms, 1e-9), centres)
    kept: list[int] = []
    for k in range(len(centres)):
        if not kept or (centres[kept] @ centres[k]).max() < 0.8:
            kept.append(k)
    return centres[kept]


def assign_shards(rows: DataFrame, centroids: np.ndarray, overlap: int) -> DataFrame:
    """The rows with ``clusters``: the numbers of the nearest centroids, nearest first."""
    held = rows.sparkSession.sparkContext.broadcast(centroids)
    count = min(overlap, len(centroids))

    @F.pandas_udf("array<int>")
    def nearest(values: pd.Series) -> pd.Series:
        if not len(values):
            return pd.Series([], dtype=object)
        order = np.argsort(-(np.stack(values.to_list()) @ held.value.T), axis=1, kind="stable")
        return pd.Series(list(order[:, :count].astype(np.int32)), dtype=object)

    return rows.withColumn("clusters", nearest("v"))


def build_graph(x: np.ndarray, options: GraphOptions, block: int = 512) -> list[tuple[np.ndarray, np.ndarray]]:
    """Edges (from, to) of one shard: pruned candidates, their reverses, and a few random edges."""
    count = len(x)
    width = min(options.near, count - 1)
    if width < 1:
        return []
    out = []
    rng = np.random.default_rng(count)
    for at in range(0, count, block):
        part = np.arange(at, min(at + block, count))
        like = x[part] @ x.T
        like[np.arange(len(part)), part] = -2
        near = np.argpartition(-like, width - 1, axis=1)[:, :width]
        edges = prune(x, part, near, options)
        start, _ = np.nonzero(edges >= 0)
        end = edges[edges >= 0]
        far = rng.integers(0, count, (len(part), options.far))
        out += [(part[start], end), (end, part[start]), (np.repeat(part, options.far), far.ravel())]
    return out


def prune(x: np.ndarray, part: np.ndarray, near: np.ndarray, options: GraphOptions) -> np.ndarray:
    """Robust pruning of the candidates of some nodes, a step at a time; -1 where no more are left.

    The nearest candidate left becomes an edge; candidates that are closer to it, by the stretch, than to
    the node are dropped.
    """
    names, flat = np.unique(np.concatenate([part, near.ravel()]), return_inverse=True)
    own, cand = flat[: len(part)], flat[len(part) :].reshape(near.shape)
    inner = x[names]
    count, width = cand.shape
    vectors = inner[cand]
    to_node = np.sqrt(np.maximum(0, 2 - 2 * np.einsum("nd,ncd->nc", inner[own], vectors)))
    alive = np.ones(cand.shape, bool)
    edges = np.full((count, options.degree), -1)
    row = np.arange(count)
    for step in range(min(options.degree, width)):
        dist = np.where(alive, to_node, np.inf)
        pick = dist.argmin(axis=1)
        has = np.isfinite(dist[row, pick])
        if not has.any():
            break
        chosen = cand[row, pick]
        edges[has, step] = names[chosen[has]]
        between = np.sqrt(np.maximum(0, 2 - 2 * np.einsum("nd,ncd->nc", inner[chosen], vectors)))
        alive &= options.stretch * between > to_node
        alive[row, pick] = False
    return edges


def _table(edges: list[tuple[np.ndarray, np.ndarray]], count: int, width: int) -> np.ndarray:
    """Adjacency lists as rows of equal length; a node's own number where its list has ended.

    Of more than ``width`` edges of a node, a random choice stays: those of hubs lead back to it anyway.
    """
    if not edges:
        return np.arange(count)[:, None]
    pairs = np.unique(np.concatenate([a * count + b for a, b in edges]))
    pairs = np.random.default_rng(count).permutation(pairs)
    pairs = pairs[np.argsort(pairs // count, kind="stable")]
    a, b = pairs // count, pairs % count
    a, b = a[a != b], b[a != b]
    sizes = np.bincount(a, minlength=count)
    place = np.arange(len(a)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    table = np.repeat(np.arange(count)[:, None], min(width, max(1, sizes.max(initial=1))), axis=1)
    kept = place < table.shape[1]
    table[a[kept], place[kept]] = b[kept]
    return table


def range_search(x: np.ndarray, table: np.ndarray, entries: np.ndarray, options: GraphOptions) -> np.ndarray:
    """found[i, j]: the search of node i from the entries has come to j, and j is in range of i.

    All nodes search in step. The greedy part keeps a beam and expands its best until all of it is
    expanded; then everything within the widened range is expanded until nothing new is in it.
    """
    count = len(x)
    seen = np.zeros((count, count), bool)
    wide = options.similarity - options.slack
    beam = np.repeat(entries[None, :], count, axis=0)
    like = x @ x[entries].T
    seen[:, entries] = True
    done = np.zeros(beam.shape, bool)
    close = np.zeros((count, count), bool)
    close[:, entries] = like >= wide
    while True:
        score = np.where(done, -np.inf, like)
        best = score.argmax(axis=1)
        act = np.nonzero(np.isfinite(score[np.arange(count), best]))[0]
        if not len(act):
            break
        done[act, best[act]] = True
        near = table[beam[act, best[act]]]
        fresh = ~seen[act[:, None], near]
        seen[act[:, None], near] = True
        new = np.where(fresh, np.einsum("ad,ard->ar", x[act], x[near]), -np.inf)
        i, j = np.nonzero(new >= wide)
        close[act[i], near[i, j]] = True
        both = np.concatenate([like, np.full((count, near.shape[1]), -np.inf)], axis=1)
        both[act, like.shape[1] :] = new
        names = np.concatenate([beam, np.zeros((count, near.shape[1]), beam.dtype)], axis=1)
        names[act, like.shape[1] :] = near
        flags = np.concatenate([done, ~np.isfinite(both[:, like.shape[1] :])], axis=1)
        size = min(options.beam, both.shape[1])
        top = np.argpartition(-both, size - 1, axis=1)[:, :size]
        like, beam, done = (np.take_along_axis(t, top, axis=1) for t in (both, names, flags))
    ask, at = np.nonzero(close)
    while len(ask):
        new_ask, new_at = [], []
        for k in range(0, len(ask), 8192):
            q, near = ask[k : k + 8192], table[at[k : k + 8192]]
            keys = (q[:, None] * count + near).ravel()
            keys = np.unique(keys[~seen.ravel()[keys]])
            i, j = keys // count, keys % count
            seen[i, j] = True
            near_enough = np.einsum("nd,nd->n", x[i], x[j]) >= wide
            new_ask.append(i[near_enough])
            new_at.append(j[near_enough])
        ask, at = np.concatenate(new_ask), np.concatenate(new_at)
        close[ask, at] = True
    return close | close.T


def medoids(x: np.ndarray, cluster: np.ndarray) -> np.ndarray:
    """The member nearest to the mean, of all and of each first cluster that the shard's members have."""
    out = [int((x @ x.mean(axis=0)).argmax())]
    for name in np.unique(cluster):
        held = np.nonzero(cluster == name)[0]
        out.append(int(held[(x[held] @ x[held].mean(axis=0)).argmax()]))
    return np.unique(out)


def _spans(a: np.ndarray, b: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Links from each node to the smallest one it reaches, in place of all links."""
    label = np.arange(count)
    while len(a):
        before = label.copy()
        np.minimum.at(label, a, label[b])
        np.minimum.at(label, b, label[a])
        label = label[label]
        if np.array_equal(before, label):
            break
    moved = np.nonzero(label != np.arange(count))[0]
    return moved, label[moved]


def _members(assigned: DataFrame, options: GraphOptions) -> DataFrame:
    """A row per vector and shard: (shard, chunk, own, ...); large clusters as pairs of chunks."""
    rows = assigned.select("id", "v", "copies", "clusters", F.explode("clusters").alias("cluster"))
    sizes = rows.groupBy("cluster").count()
    parts = F.when(F.col("count") > options.largest, F.ceil(F.col("count") / (options.largest / 2))).otherwise(1)
    rows = rows.join(F.broadcast(sizes.select("cluster", parts.cast("int").alias("parts"))), "cluster")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    # whole clusters, or for each other chunk the pair of the two
    other = F.explode(F.when(F.col("parts") == 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.withColumn("other", other)
    pair = [F.least("own", "other"), F.greatest("own", "other")]
    shard = F.concat_ws(":", *[c.cast("string") for c in (F.col("cluster"), *pair)])
    # a chunk beside itself is part of its pair with the next one
    return rows.where("parts = 1 or own <> other").withColumn("shard", shard).drop("other")


def graph_links(assigned: DataFrame, options: GraphOptions) -> DataFrame:
    """(a, b, n): links that join what is linked (b given), and counts of links per vector (b null).

    A pair that meets in several shards counts in one only: that of the smallest cluster both have, and
    for the pairs inside a chunk that of the chunk and the next.
    """
    members = _members(assigned, options)

    def lists(group: pd.DataFrame) -> pd.DataFrame:
        ids = group["id"].to_numpy()
        x = np.stack(group["v"].to_list()).astype(np.float32)
        table = _table(build_graph(x, options), len(x), options.width)
        own = table == np.arange(len(x))[:, None]
        return pd.DataFrame({"id": ids, "near": [ids[row[~mine]] for row, mine in zip(table, own)]})

    graph = members.groupBy("shard").applyInPandas(lists, "id long, near array<long>")
    union = graph.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))

    def search(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("id", ignore_index=True)
        ids, count = group["id"].to_numpy(), len(group)
        whole = np.stack(group["v"].to_list())
        x = whole.astype(np.float32)
        clusters = np.stack(group["clusters"].to_list())
        near = [n for n in group["near"].to_list()]
        flat = np.concatenate(near) if near else np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(ids, flat), count - 1)
        inside = ids[at] == flat  # lists of other shards name vectors that are not here
        start = np.repeat(np.arange(count), [len(n) for n in near])
        table = _table([(start[inside], at[inside])], count, options.width)
        close = range_search(x, table, medoids(x, clusters[:, 0]), options)
        name, parts = int(group["cluster"].iloc[0]), int(group["parts"].iloc[0])
        own = group["own"].to_numpy()
        # of the pairs inside a chunk those count where it meets the next chunk; the last meets the one before it
        home = np.where(own + 1 < parts, own == own.min(), True) & (abs(own.max() - own.min()) == 1)
        pairs = []
        for at in range(0, count, 256):
            i, j = np.nonzero(np.triu(close[at : at + 256], at + 1))
            i = i + at
            kept = np.einsum("nd,nd->n", whole[i], whole[j]) >= options.similarity
            i, j = i[kept], j[kept]
            # the smallest cluster that both have
            shared = (clusters[i][:, :, None] == clusters[j][:, None, :]).any(axis=2)
            here = np.where(shared, clusters[i], np.iinfo(np.int32).max).min(axis=1, initial=np.iinfo(np.int32).max) == name
            if parts > 1:
                here &= (own[i] != own[j]) | home[i]
            pairs.append(np.stack([i[here], j[here]]).astype(np.int32))
        i, j = np.concatenate(pairs, axis=1)
        copies = group["copies"].to_numpy()
        counts = np.bincount(i, copies[j], count) + np.bincount(j, copies[i], count)
        one, two = _spans(i, j, count)
        linked = np.nonzero(counts)[0]
        return pd.DataFrame({
            "a": np.concatenate([ids[one], ids[linked]]),
            "b": pd.array([*ids[two], *[None] * len(linked)], dtype="Int64"),
            "n": np.concatenate([np.zeros(len(one)), counts[linked]]).astype(np.int64),
        })

    met = members.join(union, "id", "left").withColumn("near", F.coalesce("near", F.array().cast("array<long>")))
    return met.groupBy("shard").applyInPandas(search, "a long, b long, n long")


def _audit_sample(assigned: DataFrame, counted: DataFrame, options: GraphOptions, each: int) -> pd.DataFrame:
    """(id, v, n, large, weight): of each stratum ``each`` vectors picked by hashes.

    The strata: vectors without found links, with one or two, with more; each in large clusters and outside.
    ``weight`` is the number of the stratum's vectors that a sampled one stands for.
    """
    first = F.get("clusters", F.lit(0))
    sizes = assigned.groupBy(first.alias("cluster")).agg((F.count(F.lit(1)) > options.largest).alias("large"))
    rows = assigned.select("id", first.alias("cluster")).join(F.broadcast(sizes), "cluster").join(counted, "id", "left")
    links = F.when(F.col("n").isNull(), 0).when(F.col("n") <= 2, 1).otherwise(2)
    rows = rows.select("id", F.coalesce("n", F.lit(0)).alias("n"), "large", links.alias("links"))
    stratum = ["large", "links"]
    sized = rows.join(F.broadcast(rows.groupBy(*stratum).count()), stratum)
    # few rows pass this test, so that no stratum meets in one task; twice as many as asked for, on average
    chance = F.least(F.lit(1.0), 2 * each / F.col("count"))
    sized = sized.where(F.pmod(F.xxhash64("id"), F.lit(1 << 40)) < chance * (1 << 40))
    window = Window.partitionBy(*stratum)
    place = F.row_number().over(window.orderBy(F.xxhash64("id"), "id"))
    passed = F.count(F.lit(1)).over(window)
    picked = sized.withColumn("place", place).withColumn("weight", F.col("count") / F.least(passed, F.lit(each)))
    picked = picked.where(F.col("place") <= each).select("id", "n", "large", "weight")
    return assigned.select("id", "v").join(F.broadcast(picked), "id").toPandas()


def audit_recall(assigned: DataFrame, counted: DataFrame, options: GraphOptions, each: int) -> float | None:
    """The mean recall of a vector's links, the lower of those in large clusters and outside; None if unmeasured.

    ``assigned`` (id, v, copies, clusters), ``counted`` (id, n). Each linked vector weighs the same, whatever
    its number of links. The sampled vectors, 6 ``each`` at most, are broadcast; all rows pass by in blocks.
    A sample without a true link measures nothing.
    """
    asked = _audit_sample(assigned, counted, options, each)
    if asked.empty:
        return None
    names = asked["id"].to_numpy()
    held = assigned.sparkSession.sparkContext.broadcast(np.stack(asked["v"].to_list()))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(len(names), np.int64)
        for batch in batches:
            if len(batch):
                x, ids, copies = np.stack(batch["v"].to_list()), batch["id"].to_numpy(), batch["copies"].to_numpy()
                for at in range(0, len(names), 256):
                    part = slice(at, at + 256)
                    linked = x @ held.value[part].T >= options.similarity
                    linked &= ids[:, None] != names[None, part]
                    total[part] += copies @ linked
        yield pd.DataFrame({"id": names, "true": total})

    true = assigned.select("id", "v", "copies").mapInPandas(count, "id long, true long")
    both = asked.drop(columns="v").merge(true.groupBy("id").agg(F.sum("true").alias("true")).toPandas(), on="id")
    both = both[both["true"] > 0]
    both["found"] = both["weight"] * np.minimum(both["n"], both["true"]) / both["true"]
    sums = both.groupby("large")[["found", "weight"]].sum()
    return float((sums["found"] / sums["weight"]).min()) if len(sums) else None


def linked_vectors(
    vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding", options: GraphOptions = GraphOptions()
) -> DataFrame:
    """(key, n_links, component_id, kept): one row per vector, each compared with all by graph search.

    Vectors are linked from the given cosine on, computed in double precision. Null and zero vectors and
    those with null or non-finite parts link with nothing; shorter vectors count as ending in zeros.
    Equal vectors are searched once and count once each. A key that repeats with other vectors names each
    of them: every row has the links of its own vector. Rows with a null key link like others where
    another row has their vector and alone link with nothing. An empty table gives no rows; further
    columns are not read.

    The recall is audited against brute force on a bounded sample drawn by strata, a wider one where the
    first holds no link; below ``least_recall`` the graph is built again with a vector in more shards, and
    in the end a recall below 0.9 is an error.
    """
    named = vectors.select(F.col(key).cast("long").alias("id"), F.col(embedding).alias("v"))
    print_ = F.concat_ws(":", F.xxhash64("v").cast("string"), F.hash("v").cast("string"))
    prints = named.withColumn("h", F.when(F.col("v").isNotNull(), print_))
    total, width = named.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    distinct = prints.where("h is not null").groupBy("h").agg(
        F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"), F.first("v").alias("v")
    )
    # a node for each distinct vector, numbered alike when a task is repeated
    nodes = distinct.sortWithinPartitions("h").withColumn("node", F.monotonically_increasing_id())
    units = cut(unit_vectors(nodes, max(1, width or 1)).where("v is not null"))
    searched = units.where("id is not null").select(F.col("node").alias("id"), "h", "v", "copies")
    count = searched.count()
    centroid_count = min(options.most_centroids, math.ceil(count / options.shard_rows))
    if count:
        sample = searched.orderBy("h").limit(options.sample).select("v").toPandas()["v"].to_list()
        centroids = fit_centroids(np.stack(sample), centroid_count)
        for widened in (0, 2, 5):
            assigned = cut(assign_shards(searched, centroids, options.overlap + widened))
            links = cut(graph_links(assigned, options))
            counted = links.where("b is null").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("n"))
            for each in (options.audited, 8 * options.audited):
                recall = audit_recall(assigned, counted, options, each)
                if recall is not None:
                    break
            if recall is None or recall >= options.least_recall or options.overlap + widened >= len(centroids):
                break
        if recall is not None and recall < 0.9:
            raise ValueError(f"the search finds {recall:.3f} of the links")
        reached = components(links.where("b is not null").select("a", "b"))
        groups = units.select("h", "id", "copies", "node").join(counted.withColumnRenamed("id", "node"), "node", "left")
        groups = cut(groups.join(reached.withColumnRenamed("component", "root"), "node", "left"))
        roots = groups.where("root is not null").groupBy("root").agg(
            F.min("id").alias("component"), F.count(F.lit(1)).alias("members")
        )
        groups = join_groups(groups, roots, "root", "members", "node", count)
    else:
        groups = units.select("h", "id", "copies", F.lit(None).cast("long").alias("n"), F.lit(None).cast("long").alias("component"))
    groups = groups.select(
        "h", "copies", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n"), F.coalesce("component", "id").alias("component")
    )
    joined = join_groups(prints.select("id", "h"), cut(groups), "h", "copies", "id", total)
    return joined.select(
        F.col("id").alias(key),
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "id").alias("component_id"),
        F.col("id").eqNullSafe(F.coalesce("component", "id")).alias("kept"),
    )
