"""Suffix-array dedup: find every byte covered by a string of ``length`` bytes that also starts somewhere else.

Two equal strings of ``length`` bytes hold the same grams (of 16/25 of the length), so both name the same one, the gram
with the least hash, as their anchor. All starts with one anchor form a run, and a run's *context* is all bytes its strings cover.

1. Each text gives its anchors with the hash of the gram and of the context; texts themselves aren't moved. An anchor
   whose gram occurs once covers nothing that repeats. Where all contexts of a gram are equal, every start of the run
   repeats. Both are settled by counting; no start is lost, as equal strings share the gram.
2. The starts of the contexts left, one context of each kind, are the suffixes to be sorted. A suffix is held by its
   leading eight bytes and a 64-bit digest of the ``length`` bytes that count. Sampled splitters range-partition
   the suffixes; each bucket sorts its own by multikey quicksort, word by word, and compares neighbours. A run of equal
   suffixes may cross a border: the splitter is itself a suffix, the first one of the bucket after it, so each side
   compares its outermost run with it.
3. The starts found are united to spans per document, and the bytes outside are kept.

Null texts count as empty. Each row is a document, repeated rows too. An empty table gives an empty result. Matches
are judged on the input; overlaps count; nothing crosses documents. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isoloom.llm.common import encoded, joined, mixed, prefix_hashes, settle, slices, span_hashes
from isoloom.session import by_sorting

SAMPLED_CONTEXTS = 400  # of at most as many suffixes each as a string has grams
BROADCAST_RUNS = 600_000  # of 96 bytes at most: under 64 MB
BUCKET_ROWS = 250_000
WORDS = ("lead", "digest", "doc_key", "start")


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, from running minima forwards and backwards in blocks."""
    n = len(values) - width + 1
    rows = -(-len(values) // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def gram_bytes(length: int) -> int:
    """Longer grams repeat less by chance, shorter ones give fewer anchors."""
    return max(length * 16 // 25, 1)


def anchors(blobs: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """(document, first start, last start, gram hash, context hash) of each anchor; starts count from the document's
    first byte."""
    empty = np.zeros(0, dtype=np.int64)
    if not blobs or max(map(len, blobs)) < length:
        return empty, empty, empty, empty, empty
    gram = gram_bytes(length)
    data, starts = joined(blobs)
    sums = prefix_hashes(data)
    at = np.arange(len(data) - gram + 1)
    grams = span_hashes(sums, at, at + gram)
    bits = np.uint64(int(len(data)).bit_length())
    place = (np.uint64(1) << bits) - np.uint64(1)
    least = _sliding_least((grams & ~place) | at.astype(np.uint64), length - gram + 1)
    anchor = (least & place).astype(np.int64)
    doc = np.repeat(np.arange(len(blobs)), np.diff(starts))
    start = np.arange(len(anchor))
    start = start[start + length <= starts[doc[: len(anchor)] + 1] - 1]
    if not len(start):
        return empty, empty, empty, empty, empty
    anchor = anchor[start]
    new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)]))
    low, high = start[new], start[np.append(new[1:], len(start)) - 1]
    mid, owner = anchor[new], doc[start[new]]
    context = span_hashes(sums, low, high + length)
    context = mixed(context ^ mixed((mid - low).astype(np.uint64) << np.uint64(20) | (high - low).astype(np.uint64)))
    return owner, low - starts[owner], high - starts[owner], grams[mid].view(np.int64), context.view(np.int64)


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, doc_key (the hash of id and text: equal for repeated rows alone), text."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows.select("doc_id", F.xxhash64("doc_id", "text").alias("doc_key"), "text")


def _anchor_rows(rows: DataFrame, length: int) -> DataFrame:
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            blobs = encoded(batch.column("text").to_pylist())
            keys = batch.column("doc_key").to_numpy()
            for a, b in slices([len(x) for x in blobs]):
                owner, low, high, gram, context = anchors(blobs[a:b], length)
                columns = [keys[a:b][owner], low, high, gram, context]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["doc_key", "low", "high", "gram", "context"])

    return rows.select("doc_key", "text").mapInArrow(run, "doc_key long, low long, high long, gram long, context long")


def _by_document(rows: DataFrame, runs: DataFrame, count: int, how: str) -> DataFrame:
    """Join the texts with their runs (doc_key, low, high); counted runs of a bounded number are broadcast, so the
    texts stay where they are."""
    per_doc = runs.groupBy("doc_key").agg(F.collect_list(F.struct("low", "high")).alias("runs"))
    return rows.join(F.broadcast(per_doc) if count <= BROADCAST_RUNS else by_sorting(per_doc), "doc_key", how)


def _suffix_rows(rows: DataFrame, wanted: DataFrame, count: int, length: int) -> DataFrame:
    """The suffixes of the wanted contexts: lead, digest, doc_key, start."""
    rows = _by_document(rows.select("doc_key", "text"), wanted, count, "inner")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            keys, texts, lists = (batch.column(c).to_pylist() for c in ("doc_key", "text", "runs"))
            for key, blob, found in zip(keys, encoded(texts), lists):
                data = np.frombuffer(blob, dtype=np.uint8)
                sums = prefix_hashes(data)
                start = np.unique(np.concatenate([np.arange(r["low"], r["high"] + 1) for r in found]))
                digest = span_hashes(sums, start, start + length).view(np.int64)
                lead = np.zeros(len(start), dtype=np.uint64)
                for k in range(8):
                    lead = lead << np.uint64(8) | data[start + k].astype(np.uint64)
                lead = (lead ^ np.uint64(1 << 63)).view(np.int64)  # signed order is the order of the bytes
                columns = [lead, digest, np.full(len(start), key, dtype=np.int64), start.astype(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=list(WORDS))

    return rows.mapInArrow(run, ", ".join(f"{w} long" for w in WORDS))


def multikey_sort(words: list[np.ndarray]) -> np.ndarray:
    """Order of rows by their words: sort by the first, and each run of equals by the words after it, to the end."""
    order = np.argsort(words[0], kind="quicksort")
    tied = np.arange(len(order))  # places whose rows aren't told apart yet
    group = np.zeros(len(order), dtype=np.int64)
    for depth, word in enumerate(words):
        if depth:
            inner = np.lexsort((word[order[tied]], group[tied]))
            order[tied] = order[tied][inner]
        same = np.zeros(len(order), dtype=bool)
        value = word[order]
        same[1:] = (value[1:] == value[:-1]) & (group[1:] == group[:-1])
        group = np.cumsum(~same)
        more = same.copy()
        more[:-1] |= same[1:]
        tied = np.flatnonzero(more)
        if not len(tied):
            break
    return order


def repeated(rows: DataFrame, contexts: DataFrame, length: int) -> DataFrame:
    """doc_key and start of every suffix of the ``contexts`` (doc_key, low, high) whose content another one has too."""
    count, total = contexts.agg(F.count("*"), F.coalesce(F.sum(F.expr("high - low + 1")), F.lit(0))).first()
    buckets = max(1, -(-total // BUCKET_ROWS))
    sample = []
    if buckets > 1:
        some = contexts.orderBy(F.xxhash64("doc_key", "low"), "doc_key", "low").limit(SAMPLED_CONTEXTS)
        picked = _suffix_rows(rows, some, SAMPLED_CONTEXTS, length)
        sample = sorted(tuple(r) for r in picked.collect())
    suffixes = _suffix_rows(rows, contexts, count, length)
    borders = sorted({sample[len(sample) * i // buckets] for i in range(1, buckets)}) if sample else []
    buckets = len(borders) + 1
    leads = np.array([b[0] for b in borders], dtype=np.int64)

    def deal(batches):
        import pyarrow as pa

        for batch in batches:
            lead = batch.column("lead").to_numpy()
            number = np.searchsorted(leads, lead, side="left")
            last = np.searchsorted(leads, lead, side="right")
            close = np.flatnonzero(number != last)  # the lead of a splitter: compare the words after it
            if len(close):
                rows = zip(*(batch.column(w).to_numpy()[close].tolist() for w in WORDS))
                number[close] = [bisect_right(borders, r) for r in rows]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(number)], names=[*WORDS, "bucket"])

    def sort(batches):
        import pyarrow as pa

        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        words = [np.concatenate([p.column(w).to_numpy() for p in parts]) for w in WORDS]
        bucket = int(parts[0].column("bucket")[0].as_py())
        order = multikey_sort(words)
        lead, digest, key, start = (w[order] for w in words)
        same = (lead[1:] == lead[:-1]) & (digest[1:] == digest[:-1])
        found = np.zeros(len(order), dtype=bool)
        found[1:] |= same
        found[:-1] |= same
        also = []
        if bucket < len(borders):  # equal to the first suffix of the next bucket: both repeat
            edge = borders[bucket]
            equal = (lead == edge[0]) & (digest == edge[1])
            found |= equal
            if equal.any():
                also.append(edge[2:])
        if bucket:  # the bucket's own first suffix is its left splitter; the bucket before tells if it repeats there
            edge = borders[bucket - 1]
            equal = (lead == edge[0]) & (digest == edge[1]) & ~((key == edge[2]) & (start == edge[3]))
            found |= equal
        key, start = key[found], start[found]
        if also:
            key, start = np.append(key, also[0][0]), np.append(start, also[0][1])
        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(start)], names=["doc_key", "start"])

    dealt = suffixes.mapInArrow(deal, ", ".join(f"{w} long" for w in (*WORDS, "bucket")))
    return dealt.repartitionById(buckets, F.col("bucket").cast("int")).mapInArrow(sort, "doc_key long, start long")


def spans(docs: DataFrame, length: int = 400) -> DataFrame:
    """doc_key, low, high: every byte from low to before high repeats. Spans of one document may overlap."""
    rows = _keyed(docs)
    found = settle(_anchor_rows(rows, length), "anchors")
    grams = found.groupBy("gram").agg(F.count("*").alias("n"), F.min("context").alias("c1"), F.max("context").alias("c2"))
    grams = settle(grams.where("n > 1").select("gram", (F.col("c1") != F.col("c2")).alias("open")), "grams")
    # Settled sides: a gram in very many places is dealt to several tasks.
    shared = settle(found.join(by_sorting(grams), "gram"), "shared")
    kinds = shared.where("open").groupBy("gram", "context").agg(
        F.count("*").alias("n"), F.min(F.struct("doc_key", "low", "high")).alias("one")
    )
    kinds = settle(kinds, "contexts")
    starts = repeated(rows, kinds.select("one.*").distinct(), length)
    several = kinds.where("n > 1").select("gram", "context")
    whole = shared.where("not open").unionByName(shared.where("open").join(by_sorting(several), ["gram", "context"], "leftsemi"))
    whole = whole.select("doc_key", "low", (F.col("high") + length).alias("high"))
    return whole.unionByName(starts.select("doc_key", F.col("start").alias("low"), (F.col("start") + length).alias("high")))


def united(found: DataFrame) -> DataFrame:
    """The spans of each document without overlaps, in order."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            keys, lows, highs = [], [], []
            for key, runs in zip(batch.column("doc_key").to_pylist(), batch.column("runs").to_pylist()):
                last = -1
                for low, high in sorted((r["low"], r["high"]) for r in runs):
                    if low > last:
                        keys.append(key)
                        lows.append(low)
                        highs.append(high)
                    else:
                        highs[-1] = max(last, high)
                    last = highs[-1]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (keys, lows, highs)], names=["doc_key", "low", "high"])

    per_doc = found.groupBy("doc_key").agg(F.collect_list(F.struct("low", "high")).alias("runs"))
    return per_doc.mapInArrow(run, "doc_key long, low long, high long")


def without_spans(docs: DataFrame, found: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the bytes left) and kept_sha256 for every row of ``docs``."""
    found = settle(united(found), "spans")
    rows = _by_document(_keyed(docs), found, found.count(), "left").select("doc_id", "text", "runs")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            blobs = encoded(batch.column("text").to_pylist())
            removed, number, kept = [], [], []
            for blob, runs in zip(blobs, batch.column("runs").to_pylist()):
                parts, last, count, gone = [], 0, 0, 0
                for low, high in sorted((r["low"], r["high"]) for r in runs or ()):
                    if low > last or not count:
                        parts.append(blob[last:low])
                        count += 1
                        last = low
                    gone += max(high - last, 0)
                    last = max(last, high)
                parts.append(blob[last:])
                removed.append(gone)
                number.append(count)
                kept.append(b"".join(parts))
            columns = [
                batch.column("doc_id"), pa.array([len(b) for b in blobs], pa.int64()), pa.array(removed, pa.int64()),
                pa.array(number, pa.int64()), pa.array(kept, pa.binary()),
                pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
            ]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")


def dedup(docs: DataFrame, length: int = 400) -> DataFrame:
    return without_spans(docs, spans(docs, length))
