"""Mixing sources to target weights by hierarchical budgeting.

The tree has the levels of ``path`` (domain, language, source). A budget of tokens runs down from the root: each node
splits its own among its children by weight, no child gets more than its subtree can give (its tokens times
``max_epochs``), and what one can't take goes to its siblings by weight. As a node never gets more than its subtree
holds, a shortage leaves the siblings only when all of them are full, and then their ancestors' siblings take it.

A leaf with more budget than tokens repeats whole epochs; of the last epoch it takes a token-prefix in an order given by
the md5 of seed, epoch and id. The order is cut into buckets by the leading digits of the md5: buckets before the cut
are taken whole, those after it not, and only the one bucket that holds the cut is sorted, so no leaf is one task.

All amounts are whole numbers, so results don't depend on the order of sums. Null path values form leaves of their own
(``''``; others are written with a leading ``=``). Null or empty texts have no tokens: they go with whole epochs and,
in the last one, when their place lies before the cut. Repeated rows are ordered by their tokens. An empty table gives
an empty result. Result columns replace input columns of the same name.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isoloom.session import broadcast_if_small

TOKEN = r"[^\x20\x09-\x0D]+"
WIDE = "decimal(38,0)"
DIGITS = 3
RESULT = ("n_tokens", "epoch", "taken_tokens")


@dataclass(frozen=True)
class Mix:
    """``weights``: whole-number weight by path prefix; a node that isn't listed weighs ``default_weight``.
    The budget is ``share_percent`` of all tokens."""

    weights: dict[tuple[str, ...], int] = field(default_factory=dict)
    default_weight: int = 100
    share_percent: int = 100
    max_epochs: int = 4
    seed: int = 20


def _wide(c) -> Column:
    return F.col(c).cast(WIDE) if isinstance(c, str) else c.cast(WIDE)


def _key(value: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit(""))


def _split(children: DataFrame, parents: DataFrame, keys: list[str]) -> DataFrame:
    """Budget of each child: ``keys`` name it, all but the last its parent; children have weight and capacity."""
    up = keys[:-1]
    siblings = Window.partitionBy(*up)
    nodes = children.join(parents.withColumnRenamed("budget", "pool"), up)
    fill = siblings.orderBy((F.col("capacity").cast("double") / F.col("weight").cast("double")), keys[-1])
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast(WIDE)
    nodes = nodes.withColumns({
        "rest": _wide("pool") - F.coalesce(F.sum(_wide("capacity")).over(before), zero),
        "heavy": F.sum(_wide("weight")).over(siblings) - F.coalesce(F.sum(_wide("weight")).over(before), zero),
    })
    nodes = nodes.withColumn("full", F.expr("rest * weight >= capacity * heavy"))
    taken, still = F.when(F.col("full"), _wide("capacity")), F.when(~F.col("full"), _wide("weight"))
    nodes = nodes.withColumns({
        "rest": _wide("pool") - F.coalesce(F.sum(taken).over(siblings), zero),
        "heavy": F.coalesce(F.sum(still).over(siblings), zero),
    })
    nodes = nodes.withColumns({
        "grant": F.expr(f"case when full then cast(capacity as {WIDE}) else cast((rest * weight) div heavy as {WIDE}) end"),
        "odd": F.expr(f"case when full then cast(-1 as {WIDE}) else cast((rest * weight) % heavy as {WIDE}) end"),
    })
    spare = _wide("pool") - F.sum("grant").over(siblings)
    nodes = nodes.withColumns({
        "spare": spare, "turn": F.row_number().over(siblings.orderBy(F.col("odd").desc(), keys[-1])),
    })
    extra = (~F.col("full")) & (F.col("turn") <= F.col("spare"))
    return nodes.select(*keys, (F.col("grant") + F.when(extra, 1).otherwise(0)).cast("long").alias("budget"))


def budgets(leaves: DataFrame, path: list[str], mix: Mix) -> DataFrame:
    """Budget per leaf from ``leaves`` (path keys, supply). The tree is as large as the number of distinct sources."""
    spark = leaves.sparkSession
    leaves = leaves.withColumn("__root", F.lit("")).withColumn("capacity", F.col("supply") * mix.max_epochs)
    total = leaves.groupBy("__root").agg(
        F.least(F.floor(F.sum("supply") * mix.share_percent / 100), F.sum("capacity")).cast("long").alias("budget")
    )
    parents = total
    for depth in range(1, len(path) + 1):
        keys = ["__root", *path[:depth]]
        nodes = leaves.groupBy(*keys).agg(F.sum("capacity").alias("capacity"))
        listed = [(*("=" + v for v in k), int(w)) for k, w in mix.weights.items() if len(k) == depth]
        if listed:
            shape = ", ".join(f"{c} string" for c in path[:depth]) + ", listed int"
            nodes = nodes.join(F.broadcast(spark.createDataFrame(listed, shape)), path[:depth], "left")
        else:
            nodes = nodes.withColumn("listed", F.lit(None).cast("int"))
        nodes = nodes.withColumn("weight", F.coalesce("listed", F.lit(mix.default_weight))).drop("listed")
        parents = _split(nodes, parents, keys)
    return parents.drop("__root")


def mixed(docs: DataFrame, path: dict[str, Column], mix: Mix, text: str = "text") -> DataFrame:
    """One row per document and epoch it is used in: the columns of ``docs`` plus the path keys, n_tokens, epoch and
    taken_tokens (fewer than n_tokens only where the cut of its leaf falls into the document)."""
    names = [f"__{name}" for name in path]
    new = {*RESULT, *(f"{name}_key".lower() for name in path)}
    docs = docs.drop(*[c for c in docs.columns if c.lower() in new])
    docs = docs.withColumns(dict(zip(names, (_key(v) for v in path.values()))))
    docs = docs.withColumn("n_tokens", F.coalesce(F.regexp_count(F.col(text), F.lit(TOKEN)), F.lit(0)).cast("long"))
    leaves = docs.groupBy(*names).agg(F.sum("n_tokens").alias("supply"))
    granted = budgets(leaves, names, mix).join(leaves, names).selectExpr(
        *names, "if(supply > 0, budget div supply, 0) as __whole", "if(supply > 0, budget % supply, 0) as __rest",
    )
    granted = broadcast_if_small(granted, names)
    place = F.md5(F.concat_ws(":", F.lit(str(mix.seed)), F.col("__whole"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    rows = docs.join(granted, names).withColumn("__place", place).withColumn("__bucket", F.substring("__place", 1, DIGITS))
    # Where the prefix ends: the bucket of each leaf in which the tokens before it reach the rest.
    sums = rows.groupBy(*names, "__rest", "__bucket").agg(F.sum("n_tokens").alias("held"))
    so_far = Window.partitionBy(*names).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("__before", F.coalesce(F.sum("held").over(so_far), F.lit(0)))
    cut = sums.where("__before < __rest and __rest <= __before + held").select(
        *names, F.col("__bucket").alias("__cut"), "__before"
    )
    cut = broadcast_if_small(cut, [*names, "__cut"])
    rows = rows.join(cut, names, "left")
    inside = Window.partitionBy(*names).orderBy("__place", "doc_id", "n_tokens")
    at_cut = rows.where("__bucket = __cut").withColumn(
        "__ahead", F.sum("n_tokens").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    )
    at_cut = at_cut.withColumn("__left", F.expr("__rest - __before - coalesce(__ahead, 0)"))
    at_cut = at_cut.withColumn("__part", F.expr("case when __left > 0 then least(n_tokens, __left) end")).drop("__ahead", "__left")
    others = rows.where("__cut is null or __bucket <> __cut").withColumn(
        "__part", F.expr("case when __bucket < __cut then n_tokens end")
    )
    used = at_cut.unionByName(others)
    epochs = F.expr(
        "concat(if(__whole > 0, transform(sequence(0, cast(__whole as int) - 1), e -> struct(e as epoch, n_tokens as "
        "taken_tokens)), array()), if(__part is not null, array(struct(cast(__whole as int) as epoch, __part as taken_tokens)), array()))"
    )
    used = used.withColumn("__use", F.explode(epochs)).select("*", "__use.epoch", "__use.taken_tokens")
    used = used.drop("__use", "__part", "__whole", "__rest", "__cut", "__before", "__bucket", "__place")
    for given, name in zip(path, names):
        used = used.withColumnRenamed(name, f"{given}_key")
    return used


def cut_texts(used: DataFrame, text: str = "text") -> DataFrame:
    """Shorten the texts of partly taken documents to their first ``taken_tokens`` tokens (joined by single blanks)."""
    words = F.slice(F.regexp_extract_all(F.col(text), F.lit(f"({TOKEN})"), 1), 1, F.col("taken_tokens").cast("int"))
    part = F.col("taken_tokens") < F.col("n_tokens")
    return used.withColumn(text, F.when(part, F.array_join(words, " ")).otherwise(F.col(text)))
