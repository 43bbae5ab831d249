"""Substring dedup by recompression: words that stand in a window of ``window`` words said before are found and removed.

Naming. A word's name is a hash of its bytes. A phase of recompression splits the names at random, but everywhere alike,
into left and right ones, and each left one with a right one behind it becomes one symbol, named after the two. The names
follow from what they stand for alone, so all texts agree on them without being told. A window loses at most one symbol
at each end per phase (one that may pair with what stands outside); all others, its interior symbols, are the same
wherever the window stands. As 20 words become 18, 9, 7, 4, 2 and 1, each window of 20 keeps one through three phases.
Runs of one word longer than two windows are named by their first two windows: of what lies between, each word is a repeat
of the run's own beginning.

1. Each window names an interior symbol of the third level as its anchor: the one of most words, then the least by hash. A
   round of Spark counts the anchors of all texts; windows whose anchor stands in one place alone repeat nowhere and are
   dropped.
2. The windows of one place with one anchor are a stretch. A second round names stretches by all their words (128 bits of two
   hashes): of equal stretches all but the first are repeats as a whole.
3. Where an anchor has several different stretches, the first of each kind names its windows, again by 128 bits; a third
   round finds the first place of each.

Order is by doc_id (null last), then by a hash of the text for rows that share an id, then by place. Rows equal in id and
text are one document said twice: they get the same result. Null and empty texts have no words. Texts shorter than a window
lose nothing. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isoloom.llm.common import BASE, encoded, mixed, powers, prefix_hashes, runs, settle, slices, span_hashes
from isoloom.llm.shards import Places, in_parts
from isoloom.session import BROADCAST_MAX_BYTES, by_sorting

PHASES = 3  # after these every window of at least 20 words still has an interior symbol
LEAST_WINDOW = 20
BROADCAST_NAMES = 1_500_000  # of eight bytes each; more are joined by sorting
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
OTHER_CODES = np.random.default_rng(11).permutation(256).astype(np.uint8)  # bytes renamed, for a second hash
SIDE, LEFT, RIGHT = (np.uint64(x) for x in (0x632BE59BD9B4E019, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F))


@dataclass
class Words:
    """The words of several texts, long runs cut short: hashes, text of each, number of each in its whole text, and the
    first word of each text (one more: the end)."""

    name: np.ndarray
    other: np.ndarray
    doc: np.ndarray
    number: np.ndarray
    first: np.ndarray
    total: np.ndarray  # words of the whole texts


def run_interiors(name: np.ndarray, doc: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and end of each run of more than two windows of one word."""
    if not len(name):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    new = np.flatnonzero(np.concatenate([[True], (name[1:] != name[:-1]) | (doc[1:] != doc[:-1])]))
    end = np.append(new[1:], len(name))
    long = end - new > 2 * window
    return new[long], end[long]


def words_of(blobs: list[bytes], window: int) -> Words:
    data = np.frombuffer(b"\n".join(blobs) + b"\n", dtype=np.uint8)
    ends = np.cumsum([len(b) + 1 for b in blobs])
    begin, end = runs(~SPACE[data])
    name = span_hashes(prefix_hashes(data), begin, end)
    other = span_hashes(prefix_hashes(OTHER_CODES[data]), begin, end)
    first = np.concatenate([[0], np.searchsorted(begin, ends)])
    total = np.diff(first)
    doc = np.repeat(np.arange(len(blobs)), total)
    number = np.arange(len(name)) - first[doc]
    keep = np.ones(len(name), dtype=bool)
    for low, high in zip(*run_interiors(name, doc, window)):
        keep[low + window + 1 : high - window + 1] = False
    if not keep.all():
        name, other, doc, number = name[keep], other[keep], doc[keep], number[keep]
        first = np.searchsorted(doc, np.arange(len(blobs) + 1))
    return Words(name, other, doc, number, first, total)


def word_sums(hashes: np.ndarray) -> np.ndarray:
    """Rolling sums over word hashes, for ``span_hashes``."""
    up, _ = powers(len(hashes) + 1)
    out = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(mixed(hashes ^ np.uint64(BASE)) * up[: len(hashes)], out=out[1:])
    return out


def span_names(words: Words, low: np.ndarray, high: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit names of the words from ``low`` to before ``high``."""
    return [span_hashes(word_sums(h), low, high).view(np.int64) for h in (words.name, words.other)]


def _least(keys: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Place of the least key from ``low`` to ``high`` (included), the first of equals; spans are short."""
    table, reach = [np.arange(len(keys))], 1
    while reach * 2 <= int((high - low).max(initial=0)) + 1:
        a, b = table[-1][: len(keys) - 2 * reach + 1], table[-1][reach : len(keys) - reach + 1]
        table.append(np.where(keys[a] <= keys[b], a, b))
        reach *= 2
    depth = np.floor(np.log2(high - low + 1)).astype(np.int64)
    out = np.empty(len(low), dtype=np.int64)
    for d, places in enumerate(table):
        own = np.flatnonzero(depth == d)
        a, b = places[low[own]], places[high[own] - (1 << d) + 1]
        out[own] = np.where(keys[a] <= keys[b], a, b)
    return out


def stretches(words: Words, window: int) -> tuple[np.ndarray, ...]:
    """First window, last window (both by their first word) and anchor of each stretch: neighbouring windows of one text
    that name the same symbol in the same place."""
    none = np.zeros(0, dtype=np.int64)
    start = np.arange(len(words.name))
    start = start[start + window <= words.first[words.doc + 1]]
    if not len(start):
        return none, none, none
    name, doc, at = words.name, words.doc, np.arange(len(words.name))
    low, high = start.copy(), start + window - 1  # first and last interior symbol of each window
    for phase in range(PHASES):
        right = (mixed(name * SIDE + np.uint64(phase)) & np.uint64(1)).astype(bool)
        low = low + right[low]  # may be the second half of a pair that begins before the window
        high = high - ~right[high]  # may be the first half of a pair that ends behind it
        pair = np.zeros(len(name), dtype=bool)  # symbols that take in the one behind them
        pair[:-1] = ~right[:-1] & right[1:] & (doc[1:] == doc[:-1])
        stay = np.ones(len(name), dtype=bool)
        stay[1:] = ~pair[:-1]
        both = np.flatnonzero(pair)
        name = name.copy()
        name[both] = mixed(name[both] * LEFT + mixed(name[both + 1] * RIGHT + np.uint64(phase)))
        name, doc, at = name[stay], doc[stay], at[stay]
        number = np.cumsum(stay) - 1
        low, high = number[low], number[high]
    size = np.minimum(np.diff(np.append(at, len(words.name))), 63).astype(np.uint64)
    keys = ((np.uint64(63) - size) << np.uint64(58)) | (mixed(name) >> np.uint64(6))
    found = _least(keys, low, high)
    anchor, place = keys[found], at[found]
    new = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)]))
    return start[new], start[np.append(new[1:], len(start)) - 1], anchor[new].view(np.int64)


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, doc_key (hash of the text), text: rows are told apart by both."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows.select("doc_id", F.xxhash64("text").alias("doc_key"), "text")


def _per_text(rows: DataFrame, keep: list[str], fields: str, window: int, find) -> DataFrame:
    """For each slice of texts ``find(words, lists)`` gives the text of each result and its columns ``fields``."""
    from pyspark.sql.types import StructType

    schema = StructType([rows.schema[c] for c in keep] + list(StructType.fromDDL(fields)))

    def run(batches):
        import pyarrow as pa

        for batch in in_parts(batches):
            blobs = encoded(batch.column("text").to_pylist())
            lists = batch.column("runs").to_pylist() if "runs" in batch.schema.names else [None] * len(blobs)
            for a, b in slices([len(x) for x in blobs]):
                owner, *columns = find(words_of(blobs[a:b], window), lists[a:b])
                kept = [batch.column(c).slice(a, b - a).take(pa.array(owner)) for c in keep]
                yield pa.RecordBatch.from_arrays([*kept, *map(pa.array, columns)], names=schema.names)

    return rows.mapInArrow(run, schema)


def anchors(rows: DataFrame, window: int) -> DataFrame:
    """The anchors of all stretches, one row each."""

    def find(words: Words, _):
        low, _, anchor = stretches(words, window)
        return words.doc[low], anchor

    return _per_text(rows.select("text"), [], "anchor long", window, find)


def named_anchors(rows: DataFrame, window: int) -> DataFrame:
    """The anchors that stand in several places."""
    return anchors(rows, window).groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")


def stretch_rows(rows: DataFrame, window: int) -> DataFrame:
    """doc_id, doc_key, low, high (first and last window by the number of its first word, long runs cut short), anchor and
    c1, c2 (the names of all words) of every stretch."""

    def find(words: Words, _):
        low, high, anchor = stretches(words, window)
        doc = words.doc[low]
        base = words.first[doc]
        return doc, (low - base).astype(np.int32), (high - base).astype(np.int32), anchor, *span_names(words, low, high + window)

    return _per_text(rows, ["doc_id", "doc_key"], "low int, high int, anchor long, c1 long, c2 long", window, find)


def _with_runs(rows: DataFrame, found: DataFrame, how: str = "inner") -> DataFrame:
    """The texts with their low and high as one list per text; lists of a counted size are broadcast."""
    lists = found.groupBy("doc_id", "doc_key").agg(F.collect_list(F.struct("low", "high")).alias("runs"))
    lists = settle(lists.withColumnsRenamed({"doc_id": "id", "doc_key": "key"}), "runs")
    size = lists.agg(F.sum(64 + 32 * F.size("runs"))).first()[0] or 0
    lists = F.broadcast(lists) if size <= BROADCAST_MAX_BYTES else by_sorting(lists)
    return rows.join(lists, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("doc_key") == F.col("key")), how).drop("id", "key")


def window_names(rows: DataFrame, found: DataFrame, window: int) -> DataFrame:
    """doc_id, doc_key, low and the names c1, c2 of every window of the stretches."""

    def find(words: Words, lists):
        low, high, doc = _flat(lists, ("low", "high"))
        n = high - low + 1
        at = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
        doc = np.repeat(doc, n)
        start = at + words.first[doc]
        return (doc, at.astype(np.int32), *span_names(words, start, start + window))

    return _per_text(_with_runs(rows, found), ["doc_id", "doc_key"], "low int, c1 long, c2 long", window, find)


def _flat(lists: list, names: tuple[str, ...]) -> list[np.ndarray]:
    """The lists of all texts one after another, a column per name, and the text of each entry."""
    doc = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    return [*[np.array([r[n] for x in lists for r in x], dtype=np.int64) for n in names], doc]


def _later(found: DataFrame, keys: list[str], firsts: DataFrame) -> DataFrame:
    """The rows that don't stand in the first place of their kind. ``firsts`` is settled, so the join can split a kind that
    has very many rows."""
    return found.join(by_sorting(firsts), keys).where(~_place().eqNullSafe(F.col("place")))


def _place() -> F.Column:
    return F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "doc_key", "low")


def repeats(docs: DataFrame, window: int = LEAST_WINDOW) -> DataFrame:
    """doc_id, doc_key, low, high: windows from ``low`` to ``high`` (numbers of first words, long runs cut short) were said
    before."""
    if window < LEAST_WINDOW:
        raise ValueError(f"windows of under {LEAST_WINDOW} words may lose all symbols")
    rows = _keyed(docs)
    several = settle(named_anchors(rows, window), "anchors")
    several = F.broadcast(several) if several.count() <= BROADCAST_NAMES else by_sorting(several)
    named = settle(stretch_rows(rows, window).join(several, "anchor"), "stretches")
    kinds = named.groupBy("anchor", "c1", "c2").agg(F.count("*").alias("n"), F.min(F.struct(_place().alias("place"), "high")).alias("one"))
    kinds = settle(kinds.select("anchor", "c1", "c2", "n", "one.place", "one.high"), "kinds")
    whole = _later(named.drop("anchor"), ["c1", "c2"], kinds.where("n > 1").select("c1", "c2", "place"))
    open_anchors = kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1").select("anchor")
    open_kinds = kinds.join(by_sorting(settle(open_anchors, "open")), "anchor").select("place.doc_id", "place.doc_key", "place.low", "high")
    windows = settle(window_names(rows, open_kinds, window), "windows")
    firsts = windows.groupBy("c1", "c2").agg(F.count("*").alias("n"), F.min(_place()).alias("place")).where("n > 1")
    single = _later(windows, ["c1", "c2"], settle(firsts.select("c1", "c2", "place"), "firsts"))
    columns = ["doc_id", "doc_key", "low"]
    return whole.select(*columns, "high").unionByName(single.select(*columns, F.col("low").alias("high")))


def united(found: DataFrame) -> DataFrame:
    """Ranges of windows that touch become one."""
    order = Window.partitionBy("doc_id", "doc_key").orderBy("low", "high")
    reach = F.max("high").over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = found.withColumn("new", F.coalesce((F.col("low") > reach + 1).cast("int"), F.lit(0)))
    rows = rows.withColumn("range", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy("doc_id", "doc_key", "range").agg(F.min("low").alias("low"), F.max("high").alias("high"))


def without_repeats(docs: DataFrame, found: DataFrame, window: int = LEAST_WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words left, joined by a space) and kept_sha256 for every row of ``docs``."""
    rows = _keyed(docs)
    texts = _with_runs(rows, united(found), "left")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        for batch in in_parts(batches):
            blobs = encoded(batch.column("text").to_pylist())
            lists = [x or [] for x in batch.column("runs").to_pylist()]
            total, gone, kept = [], [], []
            for a, b in slices([len(x) for x in blobs]):
                words = words_of(blobs[a:b], window)
                cut_short = set(np.flatnonzero(np.bincount(words.doc, minlength=b - a) < words.total).tolist())
                for i, blob in enumerate(blobs[a:b]):
                    own = blob.split()
                    marks = np.zeros(len(own) + 1, dtype=np.int64)
                    number = words.number[words.first[i] : words.first[i + 1]]
                    for r in lists[a + i]:
                        marks[number[r["low"]]] += 1
                        marks[number[r["high"] + window - 1] + 1] -= 1
                    drop = np.cumsum(marks[:-1]) > 0
                    if i in cut_short:
                        same = np.array(list(map(Places().__getitem__, own)))
                        for low, high in zip(*run_interiors(same, np.zeros(len(own), dtype=np.int64), window)):
                            drop[low + 1 : high] = True
                    total.append(len(own))
                    gone.append(int(drop.sum()))
                    kept.append(b" ".join([own[k] for k in np.flatnonzero(~drop)] if gone[-1] else own))
            columns = [
                batch.column("doc_id"), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()),
                pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_removed", "kept", "kept_sha256"])

    return texts.mapInArrow(run, f"doc_id {kind}, n_words long, n_removed long, kept binary, kept_sha256 string")


def dedup(docs: DataFrame, window: int = LEAST_WINDOW) -> DataFrame:
    return without_repeats(docs, repeats(docs, window), window)
