"""SimHash fingerprints in DataFrame functions alone.

A term is a word with the word after it; its weight is the length of the word, at most ``HEAVIEST``. The bits of two
64-bit hashes of the term vote with that weight; a bit of the 128-bit fingerprint is set when more than half of all
weight votes for it. Two bits are counted in one long (32 bits apart), which holds texts of any size.

Fingerprints within ``radius`` bits are found by block tables: the fingerprints keyed by one block each, and equal keys
are verified bit by bit. Up to ``MOST_BLOCKS`` bits, there is a block more than the radius, so one of them is equal. For a
wider radius a query also asks with up to one or two bits of the block flipped: as the flips of all blocks and the blocks
themselves add up to radius + 1, one block always has no more than its flips. A pair counts at its first such block alone.
Equal fingerprints are one entry.

Null texts count as empty; texts without words have the fingerprint of zeros. Rows that share an id are ordered by
their text (null ids stand first); repeated rows have equal results. An empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isoloom.llm.common import settle
from isoloom.session import by_sorting

HEAVIEST = 15
BITS = 128
MOST_BLOCKS = 9
DOCS_PER_RANGE = 2048
MOST_RANGES = 4096
SPACE = r"[\x20\x09-\x0D]+"


def _range_no(value: Column, cuts: list) -> Column:
    """How many of the sorted ``cuts`` are at most ``value``: first among every 64th, then among the 64 there."""
    if not cuts:
        return F.lit(0)
    step = 64
    tops = F.array(*[F.lit(c) for c in cuts[step - 1 :: step]]).cast("array<long>")
    rows = F.array(*[F.array(*map(F.lit, cuts[i : i + step])).cast("array<long>") for i in range(0, len(cuts), step)])
    top = F.size(F.filter(tops, lambda c: c <= value))
    inner = F.coalesce(F.get(rows, top), F.array().cast("array<long>"))
    return F.coalesce(top * step + F.size(F.filter(inner, lambda c: c <= value)), F.lit(0))


def with_next(docs: DataFrame) -> DataFrame:
    """range_no, row_no (they name a row), doc_id, text, next_id, next_text: the document after each in ascending order, the first one after the last.

    Ids are cut into ranges at their quantiles; texts are sorted once inside the ranges, and only the first row of each
    range crosses a border."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    total = docs.select("doc_id").count()
    ranges = min(MOST_RANGES, -(-total // DOCS_PER_RANGE))
    cuts: list = []
    if ranges > 1:
        shares = [i / ranges for i in range(1, ranges)]
        found = rows.agg(F.percentile_approx("doc_id", shares, 100_000).alias("q")).first()["q"]
        cuts = sorted(set(found or []))
    rows = rows.withColumn("range_no", _range_no(F.col("doc_id").cast("long"), cuts))
    order = Window.partitionBy("range_no").orderBy("doc_id", "text")
    # The first row of each range follows the last one of the range before: ids first, then the texts of those alone.
    heads = rows.groupBy("range_no").agg(F.min(F.struct("doc_id")).alias("head")).collect()
    numbers = sorted(r["range_no"] for r in heads)
    follows = {n: numbers[i - 1] for i, n in enumerate(numbers)}  # the first range follows the last
    kind = docs.schema["doc_id"].dataType.simpleString()
    borders = [(follows[r["range_no"]], r["head"]["doc_id"]) for r in heads]
    borders = docs.sparkSession.createDataFrame(borders, f"before int, head_id {kind}")
    texts = rows.drop("range_no").join(F.broadcast(borders), F.expr("doc_id <=> head_id"))  # one row per range
    texts = texts.groupBy("before", "head_id").agg(F.min("text").alias("head_text"))
    order = Window.partitionBy("range_no").orderBy("doc_id", "text")
    rows = rows.withColumns({
        "row_no": F.row_number().over(order), "next_id": F.lead("doc_id").over(order), "next_text": F.lead("text").over(order),
    }).join(by_sorting(texts), F.col("range_no") == F.col("before"))
    last = F.col("next_text").isNull()  # every text is there by now
    return rows.select(
        "range_no", "row_no", "doc_id", "text", F.when(last, F.col("head_id")).otherwise(F.col("next_id")).alias("next_id"),
        F.when(last, F.col("head_text")).otherwise(F.col("next_text")).alias("next_text"),
    )


def fingerprints(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys`` (they must tell texts apart) and ``f1``, ``f2``, the halves of the fingerprint of ``text``."""
    words = texts.select(*keys, F.filter(F.split(text, SPACE), lambda w: w != "").alias("words"))
    terms = words.select(*keys, "words", F.posexplode_outer("words").alias("pos", "word"))
    terms = terms.select(
        *keys, F.when(F.col("word").isNull(), 0).otherwise(F.least(F.char_length("word"), F.lit(HEAVIEST))).cast("long").alias("weight"),
        F.xxhash64("word", F.get("words", F.col("pos") + 1)).alias("a"),
    ).withColumn("b", F.xxhash64("a", F.lit(1)))
    pair = F.lit(0x0000000100000001).cast("long")
    sums = [F.sum("weight").alias("total")]
    for half in "ab":
        for k in range(32):
            votes = F.shiftrightunsigned(half, k).bitwiseAND(pair) * F.col("weight")
            sums.append(F.sum(votes).alias(f"{half}{k}"))
    sums = terms.groupBy(*keys).agg(*sums)

    def word(half: str) -> Column:
        out = F.lit(0).cast("long")
        for k in range(32):
            low = F.col(f"{half}{k}").bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))
            high = F.shiftrightunsigned(f"{half}{k}", 32)
            out = out.bitwiseOR(F.when(low * 2 > F.col("total"), F.lit(1 << k).cast("long")).otherwise(F.lit(0).cast("long")))
            bit = 1 << (k + 32)
            bit = bit - (1 << 64) if k == 31 else bit
            out = out.bitwiseOR(F.when(high * 2 > F.col("total"), F.lit(bit).cast("long")).otherwise(F.lit(0).cast("long")))
        return out

    return sums.select(*keys, word("a").alias("f1"), word("b").alias("f2"))


def as_text(f1: str, f2: str) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(f1), 16, "0"), F.lpad(F.hex(f2), 16, "0")))


def distance(f1, f2, g1, g2) -> Column:
    return F.bit_count(F.col(f1).bitwiseXOR(F.col(g1))) + F.bit_count(F.col(f2).bitwiseXOR(F.col(g2)))


def _signed(bits: int) -> tuple[int, int]:
    """The two halves of 128 bits as longs."""
    return tuple(h - (1 << 64) if h >> 63 else h for h in (bits >> 64, bits & (1 << 64) - 1))


def _blocks(radius: int) -> list[tuple[int, list[int], int]]:
    """The bits, their positions and the most flips of each block. Flips and blocks add up to radius + 1."""
    n = min(radius + 1, MOST_BLOCKS)
    spare, out, start = radius + 1 - n, [], 0
    for i in range(n):
        width = BITS // n + (i < BITS % n)
        at = list(range(start, start + width))
        out.append((sum(1 << k for k in at), at, spare // n + (i < spare % n)))
        start += width
    return out


def within_radius(queries: DataFrame, prints: DataFrame, radius: int = 3) -> DataFrame:
    """``queries`` and ``prints`` hold distinct fingerprints f1, f2. Returns f1, f2 (query), g1, g2 and distance of all
    pairs of different fingerprints within ``radius`` bits, each once."""
    blocks = _blocks(radius)
    covers = [[F.lit(h).cast("long") for h in _signed(cover)] for cover, _, _ in blocks]
    flips = [
        "struct({}, bigint('{}'), bigint('{}'))".format(i, *_signed(sum(1 << b for b in chosen)))
        for i, (_, at, most) in enumerate(blocks) for n in range(most + 1) for chosen in combinations(at, n)
    ]

    def key(at: Column, first: Column, second: Column) -> Column:
        c1, c2 = (F.array(*[c[k] for c in covers]) for k in (0, 1))
        return F.xxhash64(at, first.bitwiseAND(F.get(c1, at)), second.bitwiseAND(F.get(c2, at)))

    asked = queries.select("f1", "f2", F.expr(f"inline(array({', '.join(flips)}))").alias("at", "x1", "x2"))  # one text: many calls are slow
    asked = asked.select("f1", "f2", key(F.col("at"), F.col("f1").bitwiseXOR(F.col("x1")), F.col("f2").bitwiseXOR(F.col("x2"))).alias("block"))
    table = prints.select(F.col("f1").alias("g1"), F.col("f2").alias("g2"), F.explode(F.array(*map(F.lit, range(len(blocks))))).alias("at"))
    table = table.select("g1", "g2", "at", key(F.col("at"), F.col("g1"), F.col("g2")).alias("holds"))
    first = F.lit(None).cast("int")  # the first block that differs by no more than its flips
    for i, (_, _, most) in reversed(list(enumerate(blocks))):
        apart = [F.bit_count(F.col(f"f{k}").bitwiseXOR(F.col(f"g{k}")).bitwiseAND(covers[i][k - 1])) for k in (1, 2)]
        first = F.when(apart[0] + apart[1] <= most, i).otherwise(first)
    bits = distance("f1", "f2", "g1", "g2")
    near = asked.join(by_sorting(table), (F.col("block") == F.col("holds")) & bits.between(1, radius) & (first == F.col("at")))
    return near.select("f1", "f2", "g1", "g2", bits.alias("distance"))


def edited_pairs(docs: DataFrame) -> DataFrame:
    """For each document: n_chars, the hash of its edited text (its last half replaced by the start of the next one),
    the fingerprints f1, f2 (own), e1, e2 (edited), g1, g2 (next document's)."""
    half = F.expr("char_length(text) div 2").cast("int")
    rows = with_next(docs).withColumn("n_chars", F.char_length("text").cast("long"))
    edited = F.concat(F.expr("substring(text, 1, char_length(text) - cast(char_length(text) div 2 as int))"), F.substring("next_text", F.lit(1), half))
    keys = ["range_no", "row_no", "doc_id", "own", "next_id", "next_own", "n_chars", "edited_sha256", "kind"]
    rows = rows.select(
        "range_no", "row_no", "doc_id", F.xxhash64("text").alias("own"), "next_id", F.xxhash64("next_text").alias("next_own"), "n_chars",
        "text", edited.alias("edited"),
    ).withColumn("edited_sha256", F.sha2("edited", 256))
    both = rows.select(
        *keys[:-1], F.inline(F.array(
            F.struct(F.lit(0).alias("kind"), F.col("text").alias("written")),
            F.struct(F.lit(1).alias("kind"), F.col("edited").alias("written")),
        )),
    )
    prints = settle(fingerprints(both, keys, "written"), "prints")
    own = prints.where("kind = 0").drop("kind")
    changed = prints.where("kind = 1").select("range_no", "row_no", F.col("f1").alias("e1"), F.col("f2").alias("e2"))
    joined = own.join(by_sorting(changed), ["range_no", "row_no"])
    following = own.select(F.col("doc_id").alias("n_id"), F.col("own").alias("n_own"), F.col("f1").alias("g1"), F.col("f2").alias("g2"))
    following = following.dropDuplicates(["n_id", "n_own"])
    joined = joined.join(by_sorting(following), F.expr("next_own = n_own and next_id <=> n_id"))
    return joined.drop("n_id", "n_own", "next_id", "next_own", "range_no", "row_no")
