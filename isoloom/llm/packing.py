"""Best-fit packing of tokenised documents into sequences with several capacities.

A piece takes ``length`` tokens, one document place and ``length ** 2`` of attention cost. Pieces are placed from long
to short; a bin qualifies when every residual capacity holds the piece, and among the qualifying bins the one with the
least weighted norm of what would be left (rule ``norm``) or the largest weighted dot product of demand and residual
(rule ``dot``) is taken.

All demands follow from the length, so equal lengths are interchangeable: the plan is made from a histogram with one
count per length (at most ``tokens`` counts, whatever the number of rows), and bins in the same state are planned
together. The plan is a list of runs: places ``a .. a + n`` of one length go to these bins at that offset. Each piece
finds its run by its place among its equals, which comes from counts per (task, length) added up. Texts are read once
and never shuffled.

Null texts count as empty: one piece that holds the end id alone. Repeated rows are packed each; their places are
interchangeable. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import os
import zlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from isoloom.llm.common import settle
from isoloom.session import by_sorting

CACHED_WORDS = 1_000_000
PIECE = "piece int, start long, length long, ids_crc32 long, part int, place long"


class _Unsafe(LookupError):
    pass


class WordCache(dict):
    """Token ids of texts, word by word, as unsigned little-endian 32-bit numbers.

    A space between two characters that aren't white space always starts a new unit of the byte-level scheme, so words
    are encoded apart and remembered; a text with any other space is encoded whole. ``ranks_path`` holds the same
    vocabulary as the tokenizer file in a form whose encoder is quicker for single words; ids are equal (tested). A text
    that holds an added token of the tokenizer file is encoded by that tokenizer itself."""

    def __init__(self, tokenizer_path: str, ranks_path: str, pattern: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
        coder = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.coder = coder.encode_ordinary

    def whole(self, text: str) -> bytes:
        return np.array(self.coder(text), dtype="<u4").tobytes()

    def __missing__(self, word: str) -> bytes:
        if not word or word[0].isspace() or word[-1].isspace():
            raise _Unsafe
        ids = self.whole(word[1:] if word[0] == "\0" else " " + word)
        if len(self) < CACHED_WORDS:  # frequent words come early and stay
            self[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if any(token in text for token in self.added):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        head, *rest = text.split(" ")
        if not head or head[-1].isspace() or "\0" in text:
            return self.whole(text)
        try:
            return self["\0" + head] + b"".join(map(self.__getitem__, rest))
        except _Unsafe:
            return self.whole(text)


@lru_cache(maxsize=1)
def word_cache(tokenizer_path: str, ranks_path: str, pattern: str) -> WordCache:
    """One per Python worker; it lives as long as the worker."""
    return WordCache(tokenizer_path, ranks_path, pattern)


def pieces(docs: DataFrame, tokenizer_path: str, ranks_path: str, pattern: str, tokens: int = 1024, end_id: int = 2) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32; part and place tell it from others of its length.

    Only documents longer than ``tokens`` are cut; of theirs, the first piece takes what doesn't fill a sequence."""
    schema = StructType([docs.schema["doc_id"], *StructType.fromDDL(PIECE)])
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches):
        import pyarrow as pa

        cache, part = word_cache(tokenizer_path, ranks_path, pattern), TaskContext.get().partitionId()
        seen = [0] * (tokens + 1)
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            texts = [t or "" for t in batch.column("text").to_pylist()]
            rows = []
            for doc, text in zip(ids, texts):
                blob = cache.encode(text) + end
                size = len(blob) // 4
                start, number, step = 0, 0, (size - 1) % tokens + 1
                while start < size:
                    check = zlib.crc32(blob[4 * start : 4 * (start + step)])
                    rows.append((doc, number, start, step, check, part, seen[step]))
                    seen[step] += 1
                    start, number, step = start + step, number + 1, tokens
            columns = list(zip(*rows)) or [()] * len(schema)
            arrays = [pa.array(c, type=f.type) for c, f in zip(columns, arrow_schema)]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow_schema)

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow_schema = to_arrow_schema(schema)
    return docs.select("doc_id", "text").mapInArrow(run, schema)


@dataclass(frozen=True)
class Capacity:
    tokens: int = 1024
    documents: int = 1024
    attention: int = 1024 * 1024

    def demand(self, length: int) -> np.ndarray:
        return np.array([length, 1, length * length], dtype=np.float64)

    @property
    def limits(self) -> np.ndarray:
        return np.array([self.tokens, self.documents, self.attention], dtype=np.float64)


def plan(counts: dict[int, int], capacity: Capacity, rule: str = "norm", weights=(1.0, 0.01, 0.01)) -> np.ndarray:
    """Runs (length, first place, places, first bin, pieces per bin, offset) of a best-fit packing of ``counts``."""
    limits, weigh = capacity.limits, np.array(weights)
    left = np.zeros((0, 3))  # residuals of a set of bins in the same state
    held = np.zeros((0, 2), dtype=np.int64)  # how many bins, the first one's number
    runs, bins = [], 0
    for length in sorted(counts, reverse=True):
        need = capacity.demand(length)
        if (need > limits).any():
            raise ValueError(f"a piece of {length} tokens exceeds a capacity")
        todo, place = counts[length], 0
        while todo:
            fits = np.flatnonzero((left >= need).all(1))
            if len(fits):
                if rule == "norm":
                    best = fits[np.argmin((((left[fits] - need) / limits) ** 2 * weigh).sum(1))]
                else:
                    best = fits[np.argmax((left[fits] * need / limits**2 * weigh).sum(1))]
                residual, (number, first) = left[best].copy(), held[best]
            else:
                best, residual, first = None, limits, bins
                number = todo
            each = int((residual // need).min()) if rule == "norm" or best is None else 1
            full = min(int(number), todo // each)
            placed = []
            if full:
                placed.append((full, int(first), each))
            if full < number and (rest := min(todo - full * each, each)) and rest < each:
                placed.append((1, int(first) + full, rest))
            used = sum(n for n, _, _ in placed)
            for n, at, k in placed:
                runs.append((length, place, n * k, at, k, int(limits[0] - residual[0])))
                place += n * k
                todo -= n * k
                left = np.vstack([left, residual - k * need])
                held = np.vstack([held, [n, at]])
            if best is None:
                bins += used
            else:
                held[best] = number - used, first + used
            open_sets = (held[:, 0] > 0) & (left >= capacity.demand(1)).all(1)
            left, held = left[open_sets], held[open_sets]
    return np.array(runs, dtype=np.int64).reshape(-1, 6)


def pack(cut: DataFrame, capacity: Capacity = Capacity(), rule: str = "norm") -> DataFrame:
    """Add sequence_id and offset to the pieces. ``cut`` is settled first: it is read for the counts and the places."""
    cut = settle(cut, "pieces")
    by_task = cut.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = by_task.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs = plan(counts, capacity, rule)
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
    starts = (runs[:, 0] << 44) | runs[:, 1]
    names = [c for c in cut.columns if c not in ("part", "place")]
    schema = StructType([cut.schema[c] for c in names]).add("sequence_id", "long").add("offset", "long")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            place = batch.column("place").to_numpy() + batch.column("first").to_numpy()
            length = batch.column("length").to_numpy()
            found = runs[np.searchsorted(starts, (length << 44) | place, side="right") - 1]
            row = place - found[:, 1]
            places = [found[:, 3] + row // found[:, 4], found[:, 5] + row % found[:, 4] * length]
            yield pa.RecordBatch.from_arrays([*map(batch.column, names), *map(pa.array, places)], names=schema.names)

    return cut.join(by_sorting(first), ["part", "length"]).mapInArrow(run, schema)
