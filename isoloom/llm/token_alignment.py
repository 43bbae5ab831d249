"""Cross-tokenizer alignment: which tokens of one tokenizer stand for which of another.

Both encode the same bytes (a space, then the text); byte offsets where tokens of both end cut them into groups, and the
tokens of a group are linked, each with each.

1. A space or line end between two visible characters ends a token in both tokenizers, so texts are cut there into
   units, and a unit is encoded and aligned once per worker, whatever the number of its uses.
2. A table made beforehand gives, for each token of the first tokenizer, the token of the second one with the same
   bytes. One-to-one groups are such pairs; how many documents hold each of them is counted in a vector as long as the
   vocabulary, one per task, and the vectors are added up.
3. All other pairs come from irregular groups. They alone are shuffled: once per shard with the number of its documents
   that hold them, and come back with the number of all documents.
4. Vectors of the highest counts per token (as long as the vocabulary) decide which links are best.

A text that is null or empty, or that either tokenizer doesn't give back byte by byte, has no tokens. Each row is a
document, repeated rows too. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from functools import lru_cache
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from isoloom.llm.common import settle
from isoloom.llm.shards import entries, in_shards, listed, packed, sums_between, unpacked, with_values

SHARD_BYTES = 8 * 1024 * 1024
UNITS_AT_ONCE = 20_000  # encoded and aligned together
KEPT_UNITS = 250_000  # of a worker; beyond it the units are forgotten at the end of a shard
LARGE_GROUP = 4096
EDGE = re.compile(r"(?<=\S)(?=[ \n]\S)")


class Codec:
    """Both tokenizers, the bytes of their tokens and the table of equal tokens."""

    def __init__(self, first: str, second: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(first)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=second)
        size = self.b.get_piece_size()
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves; others follow at 256
        hidden = [b for b in range(256) if b not in shown]
        byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        entry = {i: bytes(map(byte.__getitem__, w)) for w, i in self.a.get_vocab(with_added_tokens=False).items() if all(c in byte for c in w)}
        self.b_bytes = [
            bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()
            for i, piece in enumerate(map(self.b.id_to_piece, range(size)))
        ]
        self.n_a, self.n_b = max(self.a.get_vocab_size(), 1 + max(entry)), size
        self.a_length = np.zeros(self.n_a, dtype=np.int64)
        self.a_length[list(entry)] = [len(w) for w in entry.values()]
        self.b_length = np.array([len(w) for w in self.b_bytes], dtype=np.int64)
        equal = {w: i for i, w in enumerate(self.b_bytes) if self.b.is_byte(i)}
        equal |= {w: i for i, w in enumerate(self.b_bytes) if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i))}
        self.same = np.array([equal.get(entry.get(i), -1) for i in range(self.n_a)], dtype=np.int64)

        kinds = ((self.n_a, ",|"), (self.n_b, ",;"))  # each id with the sign behind it, inside and at the end of its group
        self.signed = [np.array([f"{i}{sign}" for sign in signs for i in range(n)], dtype=object) for n, signs in kinds]

    def encode(self, units: list[str]) -> tuple[list, list]:
        """Token ids of each unit (which begins with a space or line end) in both; None where bytes are lost."""
        a = [e.ids for e in self.a.encode_batch_fast(units, add_special_tokens=False)]
        b = self.b.encode([u[1:] if u[0] == " " else u for u in units], num_threads=1)  # B puts a space before the text
        b = [ids if u[0] == " " else ids[1:] for u, ids in zip(units, b)]
        blobs = [u.encode("utf-8", "replace") for u in units]
        pieces = [b"".join(map(self.b_bytes.__getitem__, ids)) for ids in b]
        if pieces != blobs:
            for i in range(len(units)):
                if pieces[i] != blobs[i]:
                    a[i] = b[i] = None
        return a, b


@lru_cache(maxsize=1)
def codec(first: str, second: str) -> Codec:
    """One per Python worker."""
    return Codec(first, second)


class Odd(LookupError):
    """A word with white space at its edge: the text has to be cut with care."""


class Units(dict):
    """Numbers of units; a plain word stands for the unit of a space and the word, an odd unit has a zero byte before."""

    def __init__(self) -> None:
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        if word[:1] == "\0":
            unit = word[1:]
        elif not word or word[0].isspace() or word[-1].isspace():
            raise Odd
        else:
            unit = " " + word
        self.fresh.append(unit)
        self[word] = number = len(self)
        return number

    def numbers(self, text: str) -> list[int]:
        if "\0" not in text:
            try:
                return list(map(self.__getitem__, text.split(" ")))
            except Odd:
                pass
        return [self["\0" + unit] for unit in EDGE.split(" " + text)]


class Aligner:
    """Units met by a worker: counts, links and group texts of each."""

    def __init__(self, codec: Codec) -> None:
        self.codec, self.units = codec, Units()
        self.counts = np.zeros((0, 4), dtype=np.int64)  # tokens of A and B, groups, links; -1 where bytes are lost
        self.ends = np.zeros(1, dtype=np.int64)  # ends of the units' links
        self.codes, self.times = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.texts: list[str] = []

    def learn(self) -> None:
        """Encode and align the fresh units."""
        units, self.units.fresh = self.units.fresh, []
        if not units:
            return
        a, b = self.codec.encode(units)
        lost = np.array([ids is None for ids in a])
        a, b = ([ids or [] for ids in lists] for lists in (a, b))
        flat, owner, ends = [], [], []
        for lists, length in ((a, self.codec.a_length), (b, self.codec.b_length)):
            flat.append(np.fromiter(chain.from_iterable(lists), dtype=np.int64))
            owner.append(np.repeat(np.arange(len(lists)), [len(ids) for ids in lists]))
            ends.append(np.cumsum(length[flat[-1]]))
        shared = np.intersect1d(ends[0], ends[1])  # units end in both, so groups stay within units
        group = [np.searchsorted(shared, e) for e in ends]
        size = [np.bincount(g, minlength=len(shared)) for g in group]
        first = [np.concatenate([[0], np.cumsum(s)[:-1]]) if len(s) else s for s in size]
        unit_of = owner[0][first[0]] if len(shared) else np.zeros(0, dtype=np.int64)
        number = size[0] * size[1]
        # Each A token of a group meets each B token; large groups meet by distinct ids with their counts.
        small = np.flatnonzero(number <= LARGE_GROUP)
        at = np.repeat(small, number[small])
        inner = np.arange(len(at)) - np.repeat(np.cumsum(number[small]) - number[small], number[small])
        codes = flat[0][first[0][at] + inner // size[1][at]] * self.codec.n_b + flat[1][first[1][at] + inner % size[1][at]]
        unit, times = unit_of[at], np.ones(len(at), dtype=np.int64)
        for g in np.flatnonzero(number > LARGE_GROUP):
            (ids_a, n_a), (ids_b, n_b) = (np.unique(flat[k][first[k][g] : first[k][g] + size[k][g]], return_counts=True) for k in (0, 1))
            codes = np.append(codes, (ids_a[:, None] * self.codec.n_b + ids_b[None, :]).ravel())
            times = np.append(times, (n_a[:, None] * n_b[None, :]).ravel())
            unit = np.append(unit, np.full(len(ids_a) * len(ids_b), unit_of[g]))
        order = np.argsort(unit, kind="stable")
        self.codes, self.times = np.append(self.codes, codes[order]), np.append(self.times, times[order])
        self.ends = np.append(self.ends, self.ends[-1] + np.cumsum(np.bincount(unit, minlength=len(units))))
        counts = np.column_stack([
            np.bincount(owner[0], minlength=len(units)), np.bincount(owner[1], minlength=len(units)),
            np.bincount(unit_of, minlength=len(units)), np.bincount(unit_of, weights=number, minlength=len(units)).astype(np.int64),
        ])
        counts[lost] = -1
        self.counts = np.concatenate([self.counts, counts])
        # Texts of the groups: ids of A, then of B, each with the sign behind it.
        out, n = np.empty(len(flat[0]) + len(flat[1]), dtype=object), (self.codec.n_a, self.codec.n_b)
        last = [first[k][group[k]] + size[k][group[k]] - 1 == np.arange(len(flat[k])) for k in (0, 1)]
        signed = [self.codec.signed[k][last[k] * n[k] + flat[k]] for k in (0, 1)]
        out[np.arange(len(flat[0])) + first[1][group[0]]] = signed[0]
        out[np.arange(len(flat[1])) + (first[0] + size[0])[group[1]]] = signed[1]
        out, cuts = out.tolist(), np.concatenate([[0], np.cumsum(counts[:, 0] * ~lost + counts[:, 1] * ~lost)]).tolist()
        self.texts.extend("".join(out[i:j]) for i, j in zip(cuts, cuts[1:]))


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


class Documents:
    """The documents of one shard: counts, digest of the groups, and links as places in the list of distinct pairs."""

    def __init__(self, first: str, second: str) -> None:
        self.names = first, second
        if self.names not in _ALIGNERS or len(_ALIGNERS[self.names].units) > KEPT_UNITS:
            _ALIGNERS[self.names] = Aligner(codec(first, second))
        self.aligner, self.rows = _ALIGNERS[self.names], []

    def add(self, text: str | None) -> None:
        self.rows.append(np.array(self.aligner.units.numbers(text) if text else [], dtype=np.int64))
        if len(self.aligner.units.fresh) >= UNITS_AT_ONCE:
            self.aligner.learn()

    def lists(self) -> dict:
        know = self.aligner
        know.learn()
        rows = [r if (know.counts[r, 0] >= 0).all() else r[:0] for r in self.rows]
        digest = [
            hashlib.sha256("".join(map(know.texts.__getitem__, r.tolist()))[:-1].encode()).hexdigest() if len(r) else "" for r in rows
        ]
        cuts = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
        unit = np.concatenate(rows) if rows else np.zeros(0, dtype=np.int64)
        counts = [sums_between(know.counts[unit, k], cuts) for k in range(4)]
        used, unit = np.unique(unit, return_inverse=True)
        # Pairs of the units in use, equal ones first, then by code.
        length = know.ends[used + 1] - know.ends[used]
        flat = np.repeat(know.ends[used] - (np.cumsum(length) - length), length) + np.arange(length.sum())
        codes = np.unique(know.codes[flat])
        same = self.aligner.codec.same[codes // know.codec.n_b] == codes % know.codec.n_b
        order = np.argsort(~same, kind="stable")
        place = np.empty(len(codes), dtype=np.int64)
        place[order] = np.arange(len(codes))
        own, times = place[np.searchsorted(codes, know.codes[flat])], know.times[flat]
        cell, uses = np.unique(np.repeat(np.arange(len(rows)), np.diff(cuts)) * max(len(used), 1) + unit, return_counts=True)
        doc, unit = np.divmod(cell, max(len(used), 1))
        start = np.cumsum(length) - length
        wide = length[unit]
        at = np.repeat(start[unit] - (np.cumsum(wide) - wide), wide) + np.arange(wide.sum())
        cell = np.repeat(doc, wide) * max(len(codes), 1) + own[at]
        times = times[at] * np.repeat(uses, wide)
        order2 = np.argsort(cell, kind="stable")
        cell, times = cell[order2], times[order2]
        new = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]])) if len(cell) else np.zeros(0, dtype=np.int64)
        times = np.add.reduceat(times, new) if len(new) else times
        doc, link = np.divmod(cell[new], max(len(codes), 1))
        return {
            "n_a": counts[0], "n_b": counts[1], "n_groups": counts[2], "n_links": counts[3], "groups_sha256": digest,
            "starts": np.searchsorted(doc, np.arange(len(rows) + 1)).astype(np.int32), "links": [packed(link)], "times": times,
            "same": codes[order][: same.sum()], "other": codes[order][same.sum() :],
            "held": np.bincount(link, minlength=len(codes)).astype(np.int32),
        }


COUNTS = ("n_a", "n_b", "n_groups", "n_links")
LISTS = (
    ", ".join(f"{c} array<long>" for c in COUNTS) + ", groups_sha256 array<string>, starts array<int>, links array<binary>, "
    "times array<long>, same array<long>, other array<long>, held array<int>"
)


def aligned_shards(docs: DataFrame, first: str, second: str, keep: list[str]) -> DataFrame:
    """The documents aligned, in shards: counts, and links as numbers in the shard's lists of equal pairs (``same``) and
    others (``other``); ``held``: how many documents of the shard hold each pair."""
    return settle(in_shards(docs, "text", keep, LISTS, lambda: Documents(first, second), SHARD_BYTES), "aligned")


def same_counts(shards: DataFrame, n_a: int, n_b: int) -> np.ndarray:
    """Documents that hold each token of the first tokenizer linked with its equal; one vector per task, added up."""

    def run(batches):
        import pyarrow as pa

        vector = np.zeros(n_a, dtype=np.int64)
        for batch in batches:
            for same, held in zip(batch.column("same"), batch.column("held")):
                tokens = same.values.to_numpy() // n_b
                vector[tokens] += held.values.to_numpy()[: len(tokens)]
        token = np.flatnonzero(vector)
        yield pa.RecordBatch.from_arrays([pa.array(token), pa.array(vector[token])], names=["token", "n"])

    parts = shards.select("same", "held").mapInArrow(run, "token long, n long")
    return _vector(parts.groupBy("token").agg(F.sum("n").alias("n")), n_a)


def _vector(counts: DataFrame, length: int) -> np.ndarray:
    """Counts by token (at most one row per token of the vocabulary) as an array."""
    found = counts.select("token", "n").toPandas()
    out = np.zeros(length, dtype=np.int64)
    out[found["token"].to_numpy(dtype=np.int64)] = found["n"].to_numpy(dtype=np.int64)
    return out


def other_counts(shards: DataFrame) -> DataFrame:
    """shard, at, code, value: documents of all shards that hold each irregular pair (one row per shard and pair)."""
    held = F.slice("held", F.size("same") + 1, F.greatest(F.size("other"), F.lit(1)))
    rows = listed(shards.select("shard", "other", held.alias("part")), "other", "part").where("other is not null")
    total = F.sum("part").over(Window.partitionBy("other"))
    return rows.select("shard", "at", F.col("other").alias("code"), total.alias("value"))


def align(docs: DataFrame, first: str, second: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row of ``docs``."""
    import pyarrow as pa

    both = codec(first, second)
    n_a, n_b = both.n_a, both.n_b
    shards = aligned_shards(docs, first, second, ["doc_id"])
    equal = same_counts(shards, n_a, n_b)
    others = settle(other_counts(shards), "pairs")
    best = np.maximum(equal, _vector(others.groupBy(F.expr(f"code div {n_b}").alias("token")).agg(F.max("value").alias("n")), n_a))
    rows = StructType([docs.schema["doc_id"], *StructType.fromDDL(", ".join(f"{c} long" for c in (*COUNTS, "n_best", "count_sum")))])
    rows = rows.add("groups_sha256", "string")

    def run(row, at, value):
        same, other = entries(row, "same"), entries(row, "other")
        tokens = np.concatenate([same, other]) // n_b
        counts = np.concatenate([equal[same // n_b], np.zeros(len(other), dtype=np.int64)])
        counts[len(same) + at] = value
        starts, links, times = entries(row, "starts"), unpacked(row, "links"), entries(row, "times")
        is_best = counts == best[tokens]
        sums = [sums_between(times * w[links], starts) for w in (is_best, counts)]
        kept = [row.column(c).combine_chunks().flatten() for c in ("doc_id", *COUNTS)]
        columns = [*kept, *[pa.array(s, pa.int64()) for s in sums], row.column("groups_sha256").combine_chunks().flatten()]
        return pa.Table.from_arrays(columns, names=rows.names)

    return with_values(shards, others.select("shard", "at", "value"), rows, run)
