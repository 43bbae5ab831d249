"""Line dedup by a deletion-neighbourhood join, in DataFrame functions alone.

Each non-blank line of any document is kept only where it stands first: a later equal line goes, and so does a line of
at least ``min_chars`` characters that is one edit (a character inserted, deleted or changed) away from an earlier line
of at least ``min_chars``. Earlier means the order of (doc_id, line number); lines end at ``\\n``.

Equal lines are first collapsed to their earliest place. Two lines one edit apart share their first or their last half
(of length k, the same for lengths that differ by one), so only lines whose half occurs twice emit the neighbourhood:
for each character the line without it, hashed. Lines that share (left part, right part) of a deletion differ in that
character alone, and a line that equals a deletion of another is one insertion away; in both cases every member is
compared with the earliest of its group only, so a group costs as many comparisons as it has members. The edit
distance of each comparison is verified.

Null texts have no lines and stay null. Blank lines always stay. Rows with equal id and text count as one document and
all get its result; rows that share an id (null is an id too, before all others) with other texts are ordered by the
hash of their text. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isoloom.llm.common import settle
from isoloom.session import by_sorting

MIN_CHARS = 20
HALVES = """
    filter(array(
        xxhash64('first', substring(line, 1, n div 2), n div 2),
        xxhash64('last', substring(line, n - n div 2 + 1), n div 2),
        if(n % 2 = 1, xxhash64('first', substring(line, 1, (n + 1) div 2), (n + 1) div 2), null),
        if(n % 2 = 1, xxhash64('last', substring(line, n - (n + 1) div 2 + 1), (n + 1) div 2), null)
    ), h -> n >= {least} and h is not null)
"""
# Keys of a line: 0 itself, 1 without one character, 2 the parts around one character.
VARIANTS = """
    concat(
        array(struct(0 as kind, xxhash64('text', line) as variant)),
        flatten(transform(sequence(low, high), i -> array(
            struct(1 as kind, xxhash64('text', concat(substring(line, 1, i - 1), substring(line, i + 1))) as variant),
            struct(2 as kind, xxhash64('parts', substring(line, 1, i - 1), i, substring(line, i + 1)) as variant)
        )))
    )
"""


def _lines(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, line_no, line."""
    return docs.select(
        "doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(F.split("text", "\n")).alias("line_no", "line")
    )


def _within_one_edit(near: DataFrame) -> DataFrame:
    """Places of the lines of ``near`` (id, place, line, and low to high, where an edit may be) that are one edit away from an earlier one."""
    keys = near.select("id", F.inline(F.expr(VARIANTS)))
    # Only keys that bring two lines together go on, so places and texts never travel with the neighbourhoods.
    shared = keys.groupBy("variant").agg(F.count("*").alias("n"), F.min("kind").alias("least"))
    shared = shared.where("n > 1 and least <> 1").select("variant")
    met = keys.join(by_sorting(shared), "variant", "leftsemi").join(by_sorting(near.select("id", "place")), "id")
    met = settle(met, "met")
    parts = met.where("kind = 2")
    first = parts.groupBy("variant").agg(F.min(F.struct("place", "id")).alias("first"))
    pairs = parts.join(by_sorting(first), "variant").select("id", F.col("first.id").alias("other"))
    whole = met.where("kind = 0").select("variant", F.col("id").alias("base"), F.col("place").alias("base_place"))
    both = met.where("kind = 1").join(by_sorting(whole), "variant")
    later = both.where("base_place < place").select("id", F.col("base").alias("other"))
    shorter = both.where("place < base_place").groupBy("base").agg(F.min(F.struct("place", "id")).alias("first"))
    shorter = shorter.select(F.col("base").alias("id"), F.col("first.id").alias("other"))
    pairs = pairs.unionByName(later).unionByName(shorter).where("id <> other").distinct()
    texts = near.select(F.col("id").alias("other"), F.col("line").alias("other_line"))
    pairs = pairs.join(by_sorting(near.select("id", "place", "line")), "id").join(by_sorting(texts), "other")
    return pairs.where("levenshtein(line, other_line, 1) between 0 and 1").select("place").distinct()


def kept_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Places (doc_id, text_hash, line_no) of all lines that stay."""
    lines = _lines(docs)
    place = F.struct("doc_id", "text_hash", "line_no")
    words = lines.where(F.trim("line") != "").withColumn("n", F.char_length("line"))
    words = words.withColumn("halves", F.expr(HALVES.format(least=min_chars)))
    # 128 bits name a line; the halves depend on the line alone, so any of a group will do.
    distinct = words.groupBy(F.xxhash64("line").alias("h1"), F.xxhash64(F.reverse("line")).alias("h2")).agg(
        F.min(place).alias("place"), *[F.min(F.get("halves", i)).alias(f"k{i}") for i in range(4)]
    )
    distinct = settle(distinct.drop("h1", "h2"), "lines")
    halves = distinct.select("place", F.posexplode(F.array("k0", "k1", "k2", "k3")).alias("at", "half")).where("half is not null")
    shared = halves.groupBy("half").agg(F.count("*").alias("n"), F.min("place").alias("one")).where("n > 1").select("half")
    # A shared first half leaves the edit to the rest of the line, a shared last half to its start.
    near = halves.join(by_sorting(shared), "half", "leftsemi").groupBy("place").agg(
        F.max((F.col("at") % 2).cast("int")).alias("last"), F.max((1 - F.col("at") % 2).cast("int")).alias("first")
    )
    # The texts of those lines: each is read at its place.
    wanted = near.groupBy("place.doc_id", "place.text_hash").agg(
        F.collect_list(F.struct(F.col("place.line_no").alias("line_no"), "first", "last")).alias("numbers")
    )
    texts = docs.select(F.col("doc_id").alias("d"), F.xxhash64("text").alias("h"), "text")
    found = texts.join(by_sorting(wanted), F.expr("d <=> doc_id and h = text_hash")).dropDuplicates(["doc_id", "text_hash"])
    found = found.select("doc_id", "text_hash", F.split("text", "\n").alias("all"), F.inline("numbers"))
    found = found.select(place.alias("place"), "first", "last", F.expr("all[line_no]").alias("line"), F.char_length(F.expr("all[line_no]")).alias("n"))
    found = settle(found.select(
        F.xxhash64("line").alias("id"), "place", "line", F.expr("if(last = 1, 1, n div 2 + 1)").cast("int").alias("low"),
        F.expr("if(first = 1, n, n - n div 2)").cast("int").alias("high"),
    ), "near-lines")
    dropped = _within_one_edit(found)
    first = distinct.select("place").join(by_sorting(dropped), "place", "leftanti").select("place.*")
    return first.unionByName(lines.where(F.trim("line") == "").select("doc_id", "text_hash", "line_no"))


def dedup(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """The rows of ``docs`` with the text that is left, and n_lines and n_removed (they replace columns so named)."""
    kept = kept_lines(docs.select("doc_id", "text"), min_chars).distinct()
    kept = kept.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_list("line_no")).alias("__kept"))
    kept = kept.select(F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__hash"), "__kept")
    rows = docs.drop("n_lines", "n_removed").join(
        by_sorting(kept), F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.xxhash64("text") == F.col("__hash")), "left"
    )
    rows = rows.withColumn("__lines", F.split("text", "\n"))
    rows = rows.withColumn("n_lines", F.coalesce(F.size("__lines"), F.lit(0)).cast("long"))
    stays = F.expr("array_join(transform(coalesce(__kept, array()), i -> __lines[i]), '\n')")
    rows = rows.withColumn("n_removed", F.col("n_lines") - F.coalesce(F.size("__kept"), F.lit(0)))
    rows = rows.withColumn("n_removed", F.when(F.col("text").isNull(), 0).otherwise(F.col("n_removed")).cast("long"))
    rows = rows.withColumn("text", F.when(F.col("text").isNotNull(), F.when(F.col("n_removed") == 0, F.col("text")).otherwise(stays)))
    return rows.drop("__kept", "__lines", "__doc", "__hash")
