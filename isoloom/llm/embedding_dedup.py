"""Embedding near-dedup by a forest of random-projection trees.

Every tree splits recursively along random directions at medians; vectors within ``spill`` of a split go to both sides.
Vectors are compared only inside leaves, only with equal labels, by cosine in double precision; links are verified
there and united to components.

The medians are fit on about ``SAMPLE`` vectors (fewer than twice as many), every vector is routed. The depth follows the number of vectors of a
label. A leaf that stays large (a family of near copies can't be split) is dealt out in blocks of ``BLOCK`` and block
pairs, so no task holds more than two blocks; a block pair returns per vector its number of links and one edge to the
smallest of its component there, never the pairs. A link found in several leaves counts in the first common one.

Equal vectors are collapsed first. Vectors that are null, zero, or hold null or non-finite components, or whose label or
id is null, link with nothing; vectors of different lengths neither. Rows that share an id are vectors of their own in
the same component. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isoloom.llm.common import connected_components, settle
from isoloom.session import broadcast_if_small, by_sorting

SAMPLE = 20_000
TREES = 5
LEAF = 128
BLOCK = 768
NODES_WITH_MEDIANS = 14
SHIFT = 40  # a leaf's number: tree << SHIFT | depth << 34 | path


def _unit(rows) -> np.ndarray:
    x = np.array([np.asarray(r, dtype=np.float64) for r in rows])
    return x / np.linalg.norm(x, axis=1)[:, None]


class Forest:
    """Directions per tree and level, and per node the median of the sample; deeper nodes use the level's median."""

    def __init__(self, sample: np.ndarray, dim: int, trees: int, depth: int, spill: float, seed: int = 20) -> None:
        rng = np.random.default_rng(seed)
        directions = rng.normal(size=(trees, depth, dim))
        self.directions = directions / np.linalg.norm(directions, axis=2)[:, :, None]
        self.spill, self.medians, self.fallback = spill, [], np.zeros((trees, depth))
        for tree in range(trees):
            p, node, levels = sample @ self.directions[tree].T, np.zeros(len(sample), dtype=np.int64), []
            for level in range(depth):
                if len(sample):
                    self.fallback[tree, level] = np.median(p[:, level])
                if level < NODES_WITH_MEDIANS:
                    cut = np.full(1 << level, self.fallback[tree, level])
                    order = np.argsort(node, kind="stable")
                    used, first = np.unique(node[order], return_index=True)
                    for v, members in zip(used, np.split(order, first[1:])):
                        cut[v] = np.median(p[members, level])
                    levels.append(cut)
                    node = 2 * node + (p[:, level] > cut[node])
            self.medians.append(levels)

    def route(self, x: np.ndarray, depth: np.ndarray):
        """(row, leaf) pairs of all trees."""
        rows, leaves = [], []
        for tree in range(len(self.directions)):
            p = x @ self.directions[tree].T
            row, node = np.arange(len(x)), np.zeros(len(x), dtype=np.int64)
            for level in range(p.shape[1]):
                ends = depth[row] <= level
                if ends.any():
                    rows.append(row[ends])
                    leaves.append((tree << SHIFT) | (level << 34) | node[ends])
                    row, node = row[~ends], node[~ends]
                if not len(row):
                    break
                cuts = self.medians[tree]
                cut = cuts[level][node] if level < len(cuts) else self.fallback[tree, level]
                gap = p[row, level] - cut
                low, high = gap <= self.spill, gap >= -self.spill
                row, node = np.concatenate([row[low], row[high]]), np.concatenate([2 * node[low], 2 * node[high] + 1])
            rows.append(row)
            leaves.append((tree << SHIFT) | (p.shape[1] << 34) | node)
        return np.concatenate(rows), np.concatenate(leaves)


def _compare(frame, threshold: float):
    """Links inside one block, or across its two blocks."""
    import pandas as pd

    n = len(frame)
    first, second, leaf = frame["b1"].iloc[0], frame["b2"].iloc[0], frame["leaf"].iloc[0]
    block = frame["block"].to_numpy()
    x = _unit(frame["vector"])
    linked = x @ x.T >= threshold
    if first != second:
        linked &= block[:, None] != block[None, :]
    np.fill_diagonal(linked, False)
    some = np.flatnonzero(linked.any(1))
    if not len(some):
        return pd.DataFrame({"gid": [], "links": [], "a": [], "b": []})
    linked = linked[np.ix_(some, some)]
    label = np.arange(len(some))
    while True:
        least = np.minimum(label, np.where(linked, label[None, :], n).min(1))
        least = least[least]
        if (least == label).all():
            break
        label = least
    mine = frame["leaves"].iloc[some]
    earlier = sorted({v for leaves in mine for v in leaves if v < leaf})
    counted = linked
    if earlier:
        at = {v: i for i, v in enumerate(earlier)}
        member = np.zeros((len(some), len(earlier)), dtype=np.float32)
        for i, leaves in enumerate(mine):
            member[i, [at[v] for v in leaves if v < leaf]] = 1
        counted = linked & (member @ member.T == 0)
    copies = frame["copies"].to_numpy()[some]
    ids = frame["rep"].to_numpy()[some]
    return pd.DataFrame({"gid": frame["gid"].to_numpy()[some], "links": counted @ copies, "a": ids, "b": ids[label]})


def link(vectors: DataFrame, threshold: float = 0.98, trees: int = TREES, seed: int = 20) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors`` (vec_id, embedding, label)."""
    usable = (
        "vec_id is not null and label is not null and embedding is not null and size(embedding) > 0 and "
        "forall(embedding, v -> v is not null and not isnan(v) and abs(v) < double('infinity')) and exists(embedding, v -> v <> 0)"
    )
    rows = vectors.select("vec_id", "label", "embedding").withColumn(
        "gid", F.when(F.expr(usable), F.xxhash64("label", "embedding"))
    )
    groups = rows.where("gid is not null").groupBy("gid", "label").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.any_value("embedding").alias("vector")
    )
    groups = settle(groups.withColumn("label", F.xxhash64("label", F.size("vector"))), "vectors")
    sizes = groups.groupBy("label").agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("dim"))
    sizes = sizes.withColumn("depth", F.expr(f"cast(greatest(0, ceil(log2(n / {LEAF}))) as int)"))
    top = sizes.agg(F.max("depth").alias("depth")).first()["depth"]
    if top is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    one_in = max(1, groups.count() // SAMPLE)  # about SAMPLE vectors come back, however many there are
    sample = groups.where(F.pmod(F.xxhash64("gid"), F.lit(one_in)) == 0).select("vector").collect()
    forests = {}
    for dim in {len(r[0]) for r in sample}:
        spill = 0.8 * math.sqrt(2 * (1 - threshold)) / math.sqrt(dim)
        forests[dim] = Forest(_unit([r[0] for r in sample if len(r[0]) == dim]), dim, trees, max(int(top), 1), spill, seed)

    def route(frames):
        import pandas as pd

        for frame in frames:
            sizes = frame["vector"].map(len).to_numpy()
            for dim in np.unique(sizes):
                part = frame[sizes == dim].reset_index(drop=True)
                if dim in forests:
                    row, leaf = forests[dim].route(_unit(part["vector"]), part["depth"].to_numpy())
                else:  # too rare for the sample: one leaf, dealt out in blocks
                    row, leaf = np.arange(len(part)), np.zeros(len(part), dtype=np.int64)
                order = np.lexsort((leaf, row))
                row, leaf = row[order], leaf[order]
                lists = np.split(leaf, np.searchsorted(row, np.arange(1, len(part))))
                part["leaves"] = [v.tolist() for v in lists]
                yield part[["gid", "label", "rep", "copies", "vector", "leaves"]]

    kind = groups.schema["rep"].dataType.simpleString()
    vector = groups.schema["vector"].dataType.simpleString()
    shape = f"gid long, label long, rep {kind}, copies long, vector {vector}, leaves array<long>"
    routed = settle(groups.join(broadcast_if_small(sizes.select("label", "depth")), "label").mapInPandas(route, shape), "routed")
    places = routed.select("label", F.explode("leaves").alias("leaf")).groupBy("label", "leaf").agg(F.count("*").alias("n"))
    places = places.where("n > 1").withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")).drop("n")
    members = routed.withColumn("leaf", F.explode("leaves")).join(by_sorting(places), ["label", "leaf"])
    members = members.withColumn("block", F.expr("cast(pmod(xxhash64(gid, leaf), blocks) as int)"))
    members = members.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    members = members.withColumns({"b1": F.least("block", "other"), "b2": F.greatest("block", "other")}).drop("other", "blocks")
    found = settle(
        members.groupBy("label", "leaf", "b1", "b2").applyInPandas(
            lambda frame: _compare(frame, threshold), f"gid long, links long, a {kind}, b {kind}"
        ),
        "links",
    )
    links = found.groupBy("gid").agg(F.sum("links").alias("links"))
    components = connected_components(found.select("a", "b"), "components")
    known = groups.select("gid", "rep", "copies").join(by_sorting(links), "gid", "left")
    known = known.join(by_sorting(components), F.col("rep") == F.col("node"), "left").select(
        F.col("gid").alias("g"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n"),
        F.coalesce("component", "rep").alias("root"),
    )
    known = settle(known, "classes")
    return rows.select("vec_id", "gid").join(by_sorting(known), F.col("gid") == F.col("g"), "left").select(
        "vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("root", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("root", "vec_id"), F.lit(True)).alias("kept"),
    )
