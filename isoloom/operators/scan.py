"""A library of sequences found in contigs inside the map tasks, family by family.

The library is broadcast as an index from seeds (k letters, two bits each) to (family, strand, place). Members of a
family, as the alleles of a locus, share most seeds, so a seed has one entry per family and place, not one per member. A
contig is cut into windows; the seeds of a window vote for diagonals of families, and only on diagonals with enough votes
the members are compared, all of one length at once. No row per base exists and contigs are not shuffled.

A hit belongs to the window in which it starts, and windows reach as far as the longest member, so each hit is found once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from isoloom.functions.dna import piece, windows

WINDOW = 32_768
MAX_LIBRARY_BASES = 32_000_000  # both strands, in one byte a base
MAX_ENTRIES = 2_000_000  # of 16 bytes, for the seeds of all families: with the bases under 64 MB
MAX_SEED = 31
FILTER_BITS = 22
SPREAD = np.uint64(0x9E3779B97F4A7C15)
DIGIT = np.full(256, 4, dtype=np.uint8)
DIGIT[[65, 67, 71, 84]] = range(4)
OTHER_STRAND = np.arange(256, dtype=np.uint8)
OTHER_STRAND[[65, 67, 71, 84]] = [84, 71, 67, 65]
LETTERS_AT_ONCE = 2_000_000
SCAN_LETTERS = 500_000  # a scan holds some hundred bytes for each letter of a piece


def two_bit(data: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k letters at each place in two bits each, and whether all of them are among ACGT."""
    digit = DIGIT[data]
    n = len(data) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=bool)
    power, length, done = (digit & 3).astype(np.uint64), 1, 0
    code = np.zeros(n, dtype=np.uint64)
    while True:  # lengths double; those in the binary form of k are put together
        if k & length:
            code = (code << np.uint64(2 * length)) | power[done : done + n]
            done += length
        if 2 * length > k:
            break
        power = (power[:-length] << np.uint64(2 * length)) | power[length:]
        length *= 2
    odd = np.concatenate([[0], np.cumsum(digit > 3)])
    return code, odd[k:] == odd[:-k]


def seed_codes(data: np.ndarray, k: int) -> np.ndarray:
    """A code for the k letters at each place: two bits a letter; with other letters than ACGT a hash, marked by the
    highest bit."""
    code, clean = two_bit(data, k)
    for i in np.flatnonzero(~clean):
        digest = hashlib.blake2b(data[i : i + k].tobytes(), digest_size=8).digest()
        code[i] = int.from_bytes(digest, "little") | (1 << 63)
    return code


def in_pieces(batches, column: str, letters: int = SCAN_LETTERS):
    """The rows of each batch in slices of few letters in ``column``, so that what is built per letter stays bounded
    however many rows a batch has. A row is never cut; an empty batch has no slice."""
    import pyarrow.compute as pc

    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False), dtype=np.int64)
        begin = 0
        while begin < len(ends):
            done = ends[begin - 1] if begin else 0
            stop = max(begin + 1, int(np.searchsorted(ends, done + letters, side="right")))
            yield batch.slice(begin, stop - begin)
            begin = stop


def kmer_counts(df: DataFrame, seq: str, k: int, keep: Sequence[str]) -> DataFrame:
    """``keep``, ``kmer`` (the lesser of both strands, two bits a letter, as a number) and ``n``, how often it stands there;
    k letters with others than ACGT among them are left out.

    Counted inside the map tasks, a bounded piece at a time: a k-mer comes once per piece and row of ``keep``."""
    if k > MAX_SEED:
        raise ValueError(f"k-mers of over {MAX_SEED} letters don't fit a number")
    schema = StructType([df.schema[c] for c in keep]).add("kmer", "long").add("n", "long")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            frame = batch.select(list(keep)).to_pandas()
            group = frame.groupby(list(keep), sort=False, dropna=False).ngroup().to_numpy()
            first = np.unique(group, return_index=True)[1]
            bins = batch.column("_bin").to_pylist()
            ends = np.cumsum([len(b) for b in bins])
            begin = 0
            while begin < len(bins):
                stop = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + LETTERS_AT_ONCE)))
                sizes = [len(b) for b in bins[begin:stop]]
                data = np.frombuffer(b"".join(bins[begin:stop]), dtype=np.uint8)
                code, clean = two_bit(data, k)
                other, _ = two_bit(OTHER_STRAND[data[::-1]], k)
                row = np.repeat(np.arange(begin, stop), sizes)
                whole = np.flatnonzero(clean & (row[: len(code)] == row[k - 1 :])) if len(code) else np.zeros(0, dtype=np.int64)
                least, own = np.minimum(code, other[::-1])[whole], group[row[whole]]
                order = np.lexsort((least, own))
                least, own = least[order], own[order]
                new = np.flatnonzero(np.concatenate([[True], (least[1:] != least[:-1]) | (own[1:] != own[:-1])])) if len(own) else order
                rows = batch.select(list(keep)).take(pa.array(first[own[new]]))
                columns = [pa.array(least[new].view(np.int64)), pa.array(np.diff(np.append(new, len(own))))]
                yield pa.RecordBatch.from_arrays([*rows.columns, *columns], names=schema.names)
                begin = stop

    return windows(df, seq, k, keep).select(*keep, "_bin").mapInArrow(run, schema)


@dataclass
class Library:
    """Members and the index over them. A member is a sequence with its family, its number and its strand."""

    k: int
    seqs: list[bytes]
    family: list[int]
    codes: np.ndarray = field(init=False)
    owner: np.ndarray = field(init=False)
    place: np.ndarray = field(init=False)
    maybe: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        blocks: dict[int, dict[int, list[int]]] = {}
        for i, (s, f) in enumerate(zip(self.seqs, self.family)):
            blocks.setdefault(f, {}).setdefault(len(s), []).append(i)
        self.blocks: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        parts = []
        for f, by_length in blocks.items():
            codes, places = [], []
            for length, members in by_length.items():
                letters = np.frombuffer(b"".join(self.seqs[i] for i in members), dtype=np.uint8)
                self.blocks.setdefault(f, []).append((np.array(members), letters.reshape(len(members), length)))
                code = seed_codes(letters, self.k)
                at = np.arange(len(code)) % length
                whole = at + self.k <= length
                codes.append(code[whole])
                places.append(at[whole] + 1)
            code, at = np.concatenate(codes), np.concatenate(places)
            order = np.lexsort((at, code))
            code, at = code[order], at[order]
            new = np.concatenate([[True], (code[1:] != code[:-1]) | (at[1:] != at[:-1])]) if len(code) else np.zeros(0, dtype=bool)
            parts.append((code[new], np.full(new.sum(), f, dtype=np.int32), at[new].astype(np.int32)))
        code, owner, at = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, dtype=d) for d in (np.uint64, np.int32, np.int32))
        order = np.argsort(code, kind="stable")
        self.codes, self.owner, self.place = code[order], owner[order], at[order]
        self.maybe = np.zeros(1 << FILTER_BITS, dtype=bool)
        self.maybe[self.spot(self.codes)] = True

    @property
    def longest(self) -> int:
        return max(map(len, self.seqs), default=0)

    @staticmethod
    def spot(codes: np.ndarray) -> np.ndarray:
        return (codes * SPREAD) >> np.uint64(64 - FILTER_BITS)

    def votes(self, data: np.ndarray, row: np.ndarray, at: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
        """Row, family and diagonal (place in the contig less place in the member) with at least ``least`` seeds.
        ``row`` and ``at`` (from 1) tell where each letter of ``data`` stands."""
        codes = seed_codes(data, self.k)
        n = len(codes)
        here = np.flatnonzero((row[:n] == row[self.k - 1 :][:n]) & self.maybe[self.spot(codes)]) if n else np.zeros(0, dtype=np.int64)
        first, end = (np.searchsorted(self.codes, codes[here], side=s) for s in ("left", "right"))
        met = end > first
        here, first, number = here[met], first[met], (end - first)[met]
        entry = np.repeat(first - (np.cumsum(number) - number), number) + np.arange(number.sum())
        place = np.repeat(here, number)
        rows, owner, diag = row[place], self.owner[entry], at[place] - self.place[entry]
        order = np.lexsort((diag, owner, rows))
        rows, owner, diag = rows[order], owner[order], diag[order]
        new = np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]) | (owner[1:] != owner[:-1]) | (diag[1:] != diag[:-1])])) if len(rows) else order
        number = np.diff(np.append(new, len(rows)))
        keep = number >= least
        new, number = new[keep], number[keep]
        return rows[new], owner[new], diag[new], number

    def hopeful(self, owner: np.ndarray, diag: np.ndarray, number: np.ndarray, lengths: np.ndarray, coverage: float, identity: float) -> np.ndarray:
        """Which diagonals a member can lie on, by the ``number`` of their seeds. A mismatch spoils at most k seeds, so a
        member that is alike enough brings its overlap less k - 1 and less k per allowed mismatch; members too short or
        too long for the place don't count."""
        keep = np.zeros(len(owner), dtype=bool)
        begin = np.maximum(1, 1 - diag)
        order = np.argsort(owner, kind="stable")
        bounds = np.flatnonzero(np.diff(owner[order], prepend=-1, append=-1)) if len(owner) else np.zeros(1, dtype=np.int64)
        for low, high in zip(bounds, bounds[1:]):
            own = order[low:high]
            for _, block in self.blocks[int(owner[own[0]])]:
                size = block.shape[1]
                overlap = np.minimum(size, lengths[own] - diag[own]) - begin[own] + 1
                spared = overlap - (self.k - 1) - np.floor(overlap * (1 - identity) + 1e-6) * self.k
                keep[own] |= (overlap >= size * coverage) & (overlap >= self.k) & (number[own] >= spared)
        return keep

    def members_on(self, family: int, diag: int, contig_length: int, letters: np.ndarray, start: int, coverage: float, identity: float, seeds: int):
        """(members, begin, overlap, equal letters) of each length of the family, where the overlap suffices; ``letters``
        begin at the place ``start`` (from 1) of the contig."""
        begin = max(1, 1 - diag)
        for members, block in self.blocks[family]:
            size = block.shape[1]
            overlap = min(size, contig_length - diag) - begin + 1
            if overlap < size * coverage or overlap < self.k:
                continue
            low = begin + diag - start
            equal = block[:, begin - 1 : begin - 1 + overlap] == letters[low : low + overlap]
            same = equal.sum(1)
            good = np.flatnonzero(same >= overlap * identity)
            if len(good):
                runs = np.concatenate([np.zeros((len(good), 1), dtype=np.int32), np.cumsum(equal[good], axis=1, dtype=np.int32)], axis=1)
                enough = ((runs[:, self.k :] - runs[:, : -self.k]) == self.k).sum(1) >= seeds
                good = good[enough]
            if len(good):
                yield members[good], begin, overlap, same[good]


def collected(members: DataFrame, names: Sequence[str], k: int) -> tuple[Library, dict[str, list]] | None:
    """The library of ``members`` (``family``, the columns ``names``, ``strand``, ``seq``) and its labels, or None when
    the measured bases or the seeds are too many to be sent to every task."""
    size = members.agg(F.sum(F.length("seq") + 64).alias("n")).first()["n"] or 0
    if size > MAX_LIBRARY_BASES or k > MAX_SEED:
        return None
    table = members.where(F.length("seq") >= k).select("family", *names, "strand", "seq").toPandas()
    groups = table.groupby(["family", "strand"], sort=False).ngroup().tolist()
    library = Library(k, [s.encode() for s in table["seq"]], groups)
    if len(library.codes) > MAX_ENTRIES:
        return None
    return library, {c: table[c].astype(object).tolist() for c in (*names, "strand")}


def scan_families(
    contigs: DataFrame, library: Library, labels: dict[str, list], coverage: float, identity: float, min_seeds: int
) -> DataFrame:
    """Hits of the members in the contigs, without gaps: ``sample, contig_id``, the labels of the member (strand among
    them), ``start, end, overlap, size, same``. Members with fewer than k + min_seeds - 1 letters can't be found."""
    send = contigs.sparkSession.sparkContext.broadcast
    longest, names = max(library.longest, library.k), list(labels)
    library, labels = send(library), send(labels)
    key = ("sample", "contig_id")
    kinds = [contigs.schema[c] for c in key] + [StructField(c, StringType()) for c in names]
    schema = StructType(kinds + [StructField(c, LongType()) for c in ("start", "end", "overlap", "size", "same")])
    whole = contigs.where(F.length("seq") >= library.value.k).select(*key, F.col("seq").cast("binary").alias("whole"))
    cut = whole.select(*key, "whole", F.explode(F.sequence(F.lit(0), F.length("whole") - 1, F.lit(WINDOW))).alias("offset"))
    cut = cut.select(*key, F.length("whole").cast("long").alias("length"), F.col("offset").cast("long").alias("offset"), piece(F.col("whole"), F.col("offset") + 1, int(WINDOW + longest)).alias("bin"))

    def run(batches):
        import pyarrow as pa

        index, label = library.value, labels.value
        for batch in in_pieces(batches, "bin"):
            bins = batch.column("bin").to_pylist()
            ends = np.cumsum([len(b) for b in bins], dtype=np.int64)
            starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
            data = np.frombuffer(b"".join(bins), dtype=np.uint8)
            lengths, offsets = (batch.column(c).to_numpy() for c in ("length", "offset"))
            row = np.repeat(np.arange(batch.num_rows), ends - starts)
            at = np.arange(len(data)) - starts[row] + offsets[row] + 1
            where, found, numbers = [], [], []
            rows, owner, diags, number = index.votes(data, row, at, min_seeds)
            likely = index.hopeful(owner, diags, number, lengths[rows], coverage, identity)
            for r, family, diag in zip(*(x[likely].tolist() for x in (rows, owner, diags))):
                start = max(1, 1 - diag) + diag
                if not offsets[r] < start <= offsets[r] + WINDOW:
                    continue  # starts in another window
                letters = data[starts[r] : ends[r]]
                for own, begin, overlap, same in index.members_on(family, diag, int(lengths[r]), letters, int(offsets[r]) + 1, coverage, identity, min_seeds):
                    for m, s in zip(own.tolist(), same.tolist()):
                        where.append(r)
                        found.append(m)
                        numbers.append((start, start + overlap - 1, overlap, len(index.seqs[m]), s))
            columns = [batch.column(c).take(pa.array(where, pa.int64())) for c in key]
            columns += [pa.array([label[c][m] for m in found], pa.string()) for c in names]
            columns += [pa.array(list(c), pa.int64()) for c in (zip(*numbers) if numbers else [()] * 5)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return cut.mapInArrow(run, schema)


def scan_exact(contigs: DataFrame, probes: DataFrame, names: Sequence[str], widths: Sequence[int]) -> DataFrame:
    """``sample, contig_id`` and ``names`` for each place of a contig where a probe lies letter by letter.

    ``probes`` (the columns ``names``, ``width``, ``probe``; of a size checked by the caller) is collected and broadcast:
    its first ``width`` letters are the seed, the whole probe is compared where the seed is met."""
    table = probes.select(*names, "width", "probe").toPandas()
    seqs, width = [p.encode() for p in table["probe"]], table["width"].to_numpy(dtype=np.int64)
    indexes = []
    for w in sorted(set(widths)):
        own = np.flatnonzero(width == w)
        codes = np.array([seed_codes(np.frombuffer(seqs[i][:w], dtype=np.uint8), w)[0] for i in own], dtype=np.uint64)
        order = np.argsort(codes, kind="stable")
        if len(own):
            indexes.append((w, codes[order], own[order]))
    sent = contigs.sparkSession.sparkContext.broadcast((indexes, seqs, {c: table[c].astype(object).tolist() for c in names}))
    longest = max(map(len, seqs), default=1)
    key = ("sample", "contig_id")
    schema = StructType([contigs.schema[c] for c in key] + [probes.schema[c] for c in names])
    whole = contigs.where("seq <> ''").select(*key, F.col("seq").cast("binary").alias("whole"))
    cut = whole.select(*key, "whole", F.explode(F.sequence(F.lit(0), F.length("whole") - 1, F.lit(WINDOW))).alias("offset"))
    cut = cut.select(*key, piece(F.col("whole"), F.col("offset") + 1, WINDOW + longest - 1).alias("bin"))

    def run(batches):
        import pyarrow as pa

        indexes, seqs, labels = sent.value
        for batch in in_pieces(batches, "bin"):
            bins = batch.column("bin").to_pylist()
            ends = np.cumsum([len(b) for b in bins])
            blob = b"".join(bins)
            data = np.frombuffer(blob, dtype=np.uint8)
            row = np.repeat(np.arange(len(bins)), [len(b) for b in bins])
            met = set()
            for w, codes, owner in indexes:
                found = seed_codes(data, w)
                first, last = (np.searchsorted(codes, found, side=s) for s in ("left", "right"))
                for at in np.flatnonzero(last > first).tolist():
                    r = int(row[at])
                    for i in owner[first[at] : last[at]].tolist():
                        end = at + len(seqs[i])
                        if (r, i) not in met and end <= ends[r] and blob[at:end] == seqs[i]:
                            met.add((r, i))
            rows, own = zip(*met) if met else ((), ())
            columns = [batch.column(c).take(pa.array(rows, pa.int64())) for c in key]
            columns += [pa.array([labels[c][i] for i in own], pa.string()) for c in names]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return cut.mapInArrow(run, schema)
