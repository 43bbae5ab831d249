"""N-gram Jaccard join by a token-group matrix.

A document is the set of its distinct word shingles. Documents with equal sets form one class at once. Then:

1. The hash values are cut into slices, a few more than the shingles in which a set may differ from a partner. A slice
   whose content no other class has holds one of these shingles; a class with more such slices has no partner and is
   done. Sizes are cut into bands, which fix the number of slices, and a set enters all bands in reach of its size.
2. The same is asked once more of single shingles among the classes left. Shingles are then ordered from rare to common,
   so that what many share comes last. The classes left are partitioned into groups of similar ones (equal least hashes), ``GROUP`` classes at most.
3. Members of a group are compared first. Then, in a few rounds, each class meets the group it shares most with among
   those of the least components that hold its shingles: a family of near copies becomes one component or few. A component
   is here what is known to be connected.
4. The matrix holds, as rows (shingle, component) and (shingle, group), the union of the prefixes of their sets in that
   order. A set and its partner share at least ``PREFIX_HITS`` shingles of their prefixes, so the overlap of a query's
   prefix with a union bounds what the query can have in common with any member. How long a prefix must be depends on the
   partner's size, so each of its shingles has a ``reach``: the largest partner it is needed for. Only entries within
   reach of each other meet. Components that reach the bound and whose sizes suit are opened, and of these the groups
   that do; members of one component need not meet any more.
5. Opened groups are compared exactly, in chunks of queries; each chunk returns one edge per member of a component.

No pair is lost: every step drops only what can't reach the threshold. Hash values have 64 bits; sets are told apart by
128. Null and empty texts have an empty set and are linked with nothing. Rows that share an id are one node. Null ids
take the component of their class, or null. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isoloom.llm.common import LOWER, connected_components, encoded, mixed, prefix_hashes, runs, settle, slices, span_hashes
from isoloom.session import broadcast_if_small, by_sorting

GROUP = 64
QUERY_CHUNK = 256
PREFIX_HITS = 4
STAR_ROUNDS, LABEL_ROUNDS = 1, 2  # they save work; the links left are found by the bounds
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True


def shingle_sets(blobs: list[bytes], words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    out = []
    for a, b in slices([len(x) for x in blobs]):
        data = np.frombuffer(b"\n".join(blobs[a:b]) + b"\n", dtype=np.uint8)
        ends = np.cumsum([len(x) + 1 for x in blobs[a:b]])
        start, end = runs(~SPACE[data])
        hashes = span_hashes(prefix_hashes(LOWER[data]), start, end)
        cuts = np.searchsorted(start, ends)
        first = 0
        for last in cuts:
            own = hashes[first:last]
            first = last
            if len(own) == 0:
                out.append(own)
                continue
            n = max(len(own) - words + 1, 1)
            total = np.zeros(n, dtype=np.uint64)
            for k in range(min(words, len(own))):
                total = mixed(total + own[k : k + n] + np.uint64(k + 1))
            out.append(np.unique(total))
    return out


EDGES = [1]
while EDGES[-1] < 1 << 40:
    EDGES.append(max(EDGES[-1] + 1, EDGES[-1] * 3 // 2))
EDGES = np.array(EDGES)


def slice_keys(own: np.ndarray, percent: int) -> tuple[list, list]:
    """Keys of the slices of a sorted set in its own band and in the others in reach of its size."""
    n = len(own)
    home = int(np.searchsorted(EDGES, n, side="right")) - 1
    low, high = -(-percent * n // 100), 100 * n // percent
    keys = ([], [])
    for band in range(int(np.searchsorted(EDGES, low, side="right")) - 1, int(np.searchsorted(EDGES, high, side="right"))):
        most = int(EDGES[band + 1] - 1)
        count = np.uint64(most * (100 - percent) * 115 // (100 * percent) + 3)
        number = ((own >> np.uint64(32)) * count) >> np.uint64(32)
        first = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1]]))
        content = np.add.reduceat(mixed(own), first)
        keys[band != home].append(mixed(content ^ mixed(number[first] + (np.uint64(band) << np.uint64(48)))))
    return keys


def _sets(docs: DataFrame, words: int, percent: int, keyed: bool) -> DataFrame:
    """doc_id, n, s1, s2 (name of the set), own and others: keys of the slices of sets that may have a partner; without
    ``keyed`` none."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            sets = shingle_sets(encoded(batch.column("text").to_pylist()), words)
            n = np.array([len(s) for s in sets], dtype=np.int64)
            lists = ([], [])
            for s in sets:
                keys = slice_keys(s, percent) if keyed and len(s) * (100 - percent) >= percent else ([], [])
                for out, some in zip(lists, keys):
                    out.append(np.concatenate(some) if some else s[:0])
            columns = [batch.column("doc_id"), pa.array(n), *_names(sets), *map(_arrow_lists, lists)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "s1", "s2", "own", "others"])

    shape = f"doc_id {kind}, n long, s1 long, s2 long, own array<long>, others array<long>"
    return docs.select("doc_id", "text").mapInArrow(run, shape)


def _names(sets: list[np.ndarray]) -> list:
    import pyarrow as pa

    s1 = np.array([np.sum(mixed(s), dtype=np.uint64) for s in sets], dtype=np.uint64)
    s2 = np.array([np.sum(mixed(~s), dtype=np.uint64) for s in sets], dtype=np.uint64)
    return [pa.array(s.view(np.int64)) for s in (s1, s2)]


def _arrow_lists(lists: list[np.ndarray]):
    import pyarrow as pa

    offsets = np.zeros(len(lists) + 1, dtype=np.int32)
    np.cumsum([len(s) for s in lists], out=offsets[1:])
    values = np.concatenate(lists).view(np.int64) if lists else np.zeros(0, dtype=np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _open_sets(texts: DataFrame, words: int) -> DataFrame:
    """cid, rep, n, shingles (in the order of unsigned hashes) and key, the least hashes under two orders, of the rows
    whose set has the name ``name1``, ``name2``. A row that is there twice comes twice, which does no harm."""
    kind = texts.schema["doc_id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            sets = shingle_sets(encoded(batch.column("text").to_pylist()), words)
            right = np.ones(len(sets), dtype=bool)
            for name, found in zip(("name1", "name2"), _names(sets)):
                right &= found.to_numpy() == batch.column(name).to_numpy()
            sets = [s for s, ok in zip(sets, right) if ok]
            key = np.array([mixed(s[:1])[0] ^ mixed(~s).min() for s in sets], dtype=np.uint64).view(np.int64)
            columns = [
                batch.column("name1").filter(pa.array(right)), batch.column("doc_id").filter(pa.array(right)),
                pa.array([len(s) for s in sets], pa.int64()), _arrow_lists(sets), pa.array(key),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["cid", "rep", "n", "shingles", "key"])

    return texts.mapInArrow(run, f"cid long, rep {kind}, n long, shingles array<long>, key long")


def _open(frame, percent: int):
    """Compare the queries of one chunk with the members of one group, or the members among themselves."""
    import pandas as pd

    sets = [np.asarray(s, dtype=np.int64) for s in frame["shingles"]]
    member = frame["member"].to_numpy()
    if member.all() and len(member) < 2:
        return pd.DataFrame({"a": [], "b": []})
    union = np.unique(np.concatenate([s for s, m in zip(sets, member) if m]))
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    flat = np.concatenate(sets)
    at = np.minimum(np.searchsorted(union, flat), len(union) - 1)
    hit = union[at] == flat
    matrix = np.zeros((len(sets), len(union)), dtype=np.float32)
    matrix[owner[hit], at[hit]] = 1
    sizes = np.array([len(s) for s in sets])
    both = (matrix @ matrix[member].T).astype(np.int64)
    linked = 100 * both >= percent * (sizes[:, None] + sizes[member][None, :] - both)
    ids = frame["rep"].to_numpy()
    q, m = np.nonzero(linked)
    m = np.flatnonzero(member)[m]
    label = np.arange(len(sets))
    while True:
        least = label.copy()
        np.minimum.at(least, q, label[m])
        np.minimum.at(least, m, label[q])
        least = least[least]
        if (least == label).all():
            break
        label = least
    moved = label != np.arange(len(sets))
    return pd.DataFrame({"a": ids[moved], "b": ids[label[moved]]})


def _labels(edges: DataFrame) -> DataFrame:
    """``rep, root``: equal roots are connected, connected ones need not have equal roots yet. Least labels of neighbours
    are passed on a few times, which costs far less than components and serves the star rounds as well."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = settle(both.where("a <> b").distinct(), "both-ways")
    label = settle(both.groupBy(F.col("a").alias("rep")).agg(F.min(F.least("a", "b")).alias("root")), "labels")
    for _ in range(LABEL_ROUNDS):
        near = both.join(by_sorting(label), F.col("b") == F.col("rep")).groupBy("a").agg(F.min("root").alias("near"))
        here = label.join(by_sorting(near), F.col("rep") == F.col("a")).select("rep", F.least("root", "near").alias("root"))
        label = settle(here, "labels")
    return label


def _rooted(prefixes: DataFrame, members: DataFrame, edges: DataFrame) -> DataFrame:
    """The prefixes with the component of each class as far as it is known (``root``) and the component's size."""
    ids = members.select("cid", "rep").distinct()
    roots = settle(ids.join(by_sorting(_labels(edges)), "rep", "left").select("cid", F.coalesce("root", "rep").alias("root")), "roots")
    sizes = settle(roots.groupBy("root").agg(F.count("*").alias("size")), "sizes")
    return prefixes.join(by_sorting(settle(roots.join(by_sorting(sizes), "root"), "sized-roots")), "cid")


def _stars(rooted: DataFrame) -> DataFrame:
    """For each class the group it shares most shingles with, when each shingle counts for the least component that holds
    it alone: as many rows as prefixes, however many classes hold a shingle. What is found here need not be met again."""
    hubs = rooted.groupBy("shingle").agg(F.min(F.struct("root", "grp")).alias("hub"), F.max("root").alias("other"))
    hubs = settle(hubs.where("hub.root <> other").select("shingle", F.col("hub.root").alias("hub"), F.col("hub.grp").alias("at")), "hubs")
    meet = rooted.join(by_sorting(hubs), "shingle").where("root <> hub").groupBy("cid", "at").agg(F.count("*").alias("hits"))
    best = meet.groupBy("cid").agg(F.max(F.struct("hits", "at")).alias("best"))
    return best.where(f"best.hits >= {PREFIX_HITS}").select("cid", F.col("best.at").alias("grp"))


def _reach(percent: int) -> Column:
    """The size of the largest set for which the shingle at the place ``at`` is in the prefix of its set.

    Sets of n and m shingles link when they share at least a = ceil(percent * (n + m) / (100 + percent)); then their first
    n - a + PREFIX_HITS and m - a + PREFIX_HITS have ``PREFIX_HITS`` in common. The shingles that no other set holds are
    ``alone``: they come first and aren't counted by ``at``. As many hits as are asked for have to be there, so the first
    shingles reach no farther than the last of those."""
    place = f"(alone + greatest(at, least({PREFIX_HITS}, cast(ceil({percent} * n / 100) as long)) - 1))"
    return F.expr(f"{100 + percent} * (n + {PREFIX_HITS - 1} - {place}) div {percent} - n")


def _bounded(rooted: DataFrame, percent: int) -> DataFrame:
    """Every class and group of another component that may hold a partner of it: cid, grp.

    The matrix is asked twice, by components and then by the groups of those that qualify, so a family that is one
    component by now is one entry. Of two components the smaller one asks: what a pair shares, both sides share. A query
    and an entry meet when the query reaches the entry's smallest set and one of the entry's sets reaches the query."""
    def qualify(met: DataFrame, by: str) -> DataFrame:
        bounds = met.groupBy("cid", "n", by).agg(F.count("*").alias("hits"), F.min("least").alias("least"), F.max("most").alias("most"))
        return bounds.where(
            f"hits >= least({PREFIX_HITS}, cast(ceil({percent} * n / 100) as long)) and {percent} * n <= 100 * most and {percent} * least <= 100 * n"
        ).select("cid", by)

    range_of_sizes = F.min("n").alias("least"), F.max("n").alias("most"), F.max("reach").alias("farthest")
    in_reach = "least <= reach and n <= farthest"
    matrix = rooted.groupBy("shingle", F.col("root").alias("other"), F.col("size").alias("other_size")).agg(*range_of_sizes)
    seen = rooted.groupBy("shingle").agg(F.min("root").alias("g1"), F.max("root").alias("g2")).where("g1 <> g2").select("shingle")
    asking = rooted.join(by_sorting(seen), "shingle", "leftsemi")
    smaller = (F.col("size") < F.col("other_size")) | ((F.col("size") == F.col("other_size")) & (F.col("root") < F.col("other")))
    near = settle(qualify(asking.join(by_sorting(matrix), "shingle").where(smaller).where(in_reach), "other"), "near")
    groups = settle(rooted.groupBy("shingle", F.col("root").alias("other"), "grp").agg(*range_of_sizes), "groups")
    shared = near.join(by_sorting(rooted.select("cid", "n", "shingle", "reach")), "cid")
    return qualify(shared.join(by_sorting(groups), ["other", "shingle"]).where(in_reach), "grp")


def _compared(members: DataFrame, opened: DataFrame | None, percent: int) -> DataFrame:
    """Edges (a, b) between the classes ``cid`` and the members of the groups ``grp`` opened for them, or, with none,
    between the members of each group."""
    kind = members.schema["rep"].dataType.simpleString()
    if opened is None:
        several = settle(members.groupBy("grp").agg(F.count("*").alias("held")).where("held > 1").select("grp"), "several")
        rows = members.join(by_sorting(several), "grp").select("grp", F.lit(0).alias("chunk"), "rep", "shingles", F.lit(True).alias("member"))
    else:
        chunks = settle(opened.groupBy("grp").agg(F.expr(f"cast(ceil(count(*) / {QUERY_CHUNK}) as int)").alias("chunks")), "chunks")
        asked = opened.join(by_sorting(chunks), "grp").select("cid", "grp", F.expr("cast(pmod(cid, chunks) as int)").alias("chunk"))
        asked = asked.join(by_sorting(members.drop("grp")), "cid").select("grp", "chunk", "rep", "shingles", F.lit(False).alias("member"))
        own = members.join(by_sorting(chunks), "grp").select("grp", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), "rep", "shingles", F.lit(True).alias("member"))
        rows = own.unionByName(asked)
    return rows.groupBy("grp", "chunk").applyInPandas(lambda f: _open(f, percent), f"a {kind}, b {kind}")


def link(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id of every row; documents link when their Jaccard similarity is at least
    ``percent`` per cent (of shingles of ``words`` words)."""
    counted = settle(_sets(docs, words, percent, keyed=False).drop("own", "others"), "sets")
    # Keys are made anew from the texts: they are many, and would take more room on disk than the texts. The lowest bit of a name gives way to a mark of the own band, so a key travels with one number.
    marked = _sets(docs, words, percent, keyed=True).where("doc_id is not null").select(
        F.col("s1").bitwiseAND(-2).alias("name"), F.size("own").alias("mine"), F.posexplode(F.concat("own", "others")).alias("at", "key")
    ).select("key", F.col("name").bitwiseOR((F.col("at") < F.col("mine")).cast("long")).alias("name"))
    lonely = marked.groupBy("key").agg(F.min("name").alias("name"), F.max("name").alias("other"))
    lonely = lonely.where("name = other and name & 1 = 1").groupBy("name").agg(F.count("*").alias("alone"))
    classes = counted.where("n > 0").groupBy("s1", "s2", "n").agg(F.min("doc_id").alias("rep")).where("rep is not null")
    classes = settle(classes, "classes")
    may_differ = F.expr(f"n * {100 - percent} div {percent}")
    open_classes = classes.join(by_sorting(lonely), classes["s1"].bitwiseOR(1) == lonely["name"], "left")
    open_classes = open_classes.where((may_differ > 0) & (F.coalesce("alone", F.lit(0)) <= may_differ))
    open_classes = settle(open_classes.select(F.col("rep").alias("id"), F.col("s1").alias("name1"), F.col("s2").alias("name2")), "open")
    texts = docs.select("doc_id", "text").join(broadcast_if_small(open_classes), F.col("doc_id") == F.col("id"))
    sets = settle(_open_sets(texts.select("doc_id", "text", "name1", "name2"), words), "open-sets")
    lonely = sets.select("cid", F.explode("shingles").alias("shingle")).groupBy("shingle").agg(F.min("cid").alias("cid"), F.max("cid").alias("other"))
    lonely = lonely.where("cid = other").groupBy("cid").agg(F.count("*").alias("alone"))
    may_lack = F.expr(f"n - cast(ceil({percent} * n / 100) as long)")
    likely = sets.select("cid", "n").distinct().join(by_sorting(lonely), "cid", "left").where(F.coalesce("alone", F.lit(0)) <= may_lack)
    sets = settle(sets.join(broadcast_if_small(settle(likely.select("cid"), "likely")), "cid"), "likely-sets")
    sizes = sets.groupBy("key").agg(F.count("*").alias("n")).where(f"n > {GROUP}")
    sizes = sizes.select("key", F.expr(f"cast(ceil(n / {GROUP}) as int)").alias("parts"))
    grouped = sets.join(broadcast_if_small(sizes), "key", "left")
    grouped = grouped.withColumn("grp", F.expr("xxhash64(key, pmod(cid, coalesce(parts, 1)))")).drop("key", "parts")
    # Prefixes from rare to common. Shingles of one set alone come first and meet nothing, so they only take up room.
    shingles = grouped.select("cid", "n", "grp", F.explode("shingles").alias("shingle"))
    common = shingles.groupBy("shingle").agg(F.count("*").alias("held")).where("held > 1")
    ordered = shingles.join(by_sorting(common), "shingle").groupBy("cid", "n", "grp").agg(
        F.array_sort(F.collect_set(F.struct("held", "shingle"))).alias("ordered")
    )
    prefixes = ordered.select("cid", "n", "grp", F.expr("n - size(ordered)").alias("alone"), F.posexplode("ordered").alias("at", "held"))
    prefixes = prefixes.select("cid", "n", "grp", "held.shingle", _reach(percent).alias("reach"))
    prefixes = settle(prefixes.where(f"100 * reach >= {percent} * n"), "prefixes")
    members = settle(grouped.select("cid", "rep", "grp", "shingles"), "members")
    edges = settle(_compared(members, None, percent), "inner-edges")
    for _ in range(STAR_ROUNDS):
        rooted = _rooted(prefixes, members, edges)
        found = settle(_compared(members, settle(_stars(rooted), "stars"), percent), "star-edges")
        if found.isEmpty():
            break
        edges = edges.unionByName(found)
    rooted = settle(_rooted(prefixes, members, edges), "rooted")
    opened = settle(_bounded(rooted, percent), "opened")
    components = connected_components(edges.unionByName(_compared(members, opened, percent)), "components")
    classes = classes.join(by_sorting(components), F.col("rep") == F.col("node"), "left")
    classes = settle(classes.select("s1", "s2", F.coalesce("component", "rep").alias("root")), "roots")
    return counted.select("doc_id", "n", "s1", "s2").join(by_sorting(classes), ["s1", "s2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("root", "doc_id").alias("component_id")
    )
