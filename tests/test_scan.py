"""The in-task scanner against letter-by-letter search and against the join of seeds."""

import random

import numpy as np
import pyarrow as pa
import pytest

from isoloom.operators import scan, screen, typing


def dna(rng, n, letters="ACGT"):
    return "".join(rng.choice(letters) for _ in range(n))


def changed(rng, seq, n):
    out = list(seq)
    for i in rng.sample(range(len(out)), n):
        out[i] = rng.choice("ACGT")
    return "".join(out)


def reverse(seq):
    return seq[::-1].translate(str.maketrans("ACGT", "TGCA"))


@pytest.mark.parametrize("k", [1, 2, 5, 11, 15, 31])
def test_seed_codes_tell_words_apart(k):
    rng = random.Random(k)
    text = dna(rng, 400, "ACGTN" if k > 2 else "ACGT") + "ACGT" * 20
    codes = scan.seed_codes(np.frombuffer(text.encode(), dtype=np.uint8), k)
    words = [text[i : i + k] for i in range(len(text) - k + 1)]
    assert len(codes) == len(words) and len(set(codes.tolist())) == len(set(words))
    assert len(set(zip(codes.tolist(), words))) == len(set(words))
    assert len(scan.seed_codes(np.frombuffer(b"A" * (k - 1), dtype=np.uint8), k)) == 0


def world(rng, spark, n_contigs=30, alleles_per_locus=200):
    loci = {f"loc{i}": dna(rng, 90 + 7 * i) for i in range(5)}
    library = []
    for locus, seq in loci.items():
        for a in range(alleles_per_locus):
            own = changed(rng, seq, rng.randrange(0, 6))
            library.append(("s", locus, str(a), own if a % 9 else own[: 60 + a % 7]))
    contigs = []
    for c in range(n_contigs):
        parts = [dna(rng, rng.randrange(0, 300))]
        for _, _, _, seq in rng.sample(library, 4):
            seq = changed(rng, seq, rng.randrange(0, 5))
            parts += [rng.choice([seq, reverse(seq), seq[: len(seq) // 2], seq[30:]]), dna(rng, rng.randrange(0, 200), "ACGTN")]
        contigs.append((f"x{c % 7}", f"c{c}", "".join(parts)))
    contigs += [("x0", "short", "ACG"), ("x1", "empty", "")]
    return (
        spark.createDataFrame(contigs, "sample string, contig_id string, seq string"),
        spark.createDataFrame(library + library[:20], "scheme string, locus string, allele string, seq string"),
    )


@pytest.mark.parametrize("window", [64, 32_768])
def test_scanner_equals_seed_join(spark, monkeypatch, window):
    rng = random.Random(window)
    contigs, alleles = world(rng, spark)
    genes = alleles.dropDuplicates(["locus", "seq"]).selectExpr("concat(locus, '_', allele) as gene", "seq")
    monkeypatch.setattr(scan, "WINDOW", window)
    calls = [lambda: screen.gene_screen(contigs, genes, 0.4, 0.9, 9), lambda: typing.near_alleles(contigs, alleles, 9)]
    found = [sorted(map(tuple, call().collect())) for call in calls]
    monkeypatch.setattr(scan, "MAX_LIBRARY_BASES", 0)
    assert found == [sorted(map(tuple, call().collect())) for call in calls]
    assert min(map(len, found)) > 200


def test_scanner_finds_what_letters_show(spark):
    rng = random.Random(3)
    genes = {f"g{i}": dna(rng, 60) for i in range(6)}
    contig = "".join(dna(rng, 70) + changed(rng, g, 3) for g in genes.values()) + reverse(genes["g2"])[:50]
    k, found = 8, set()
    for name, gene in genes.items():
        for strand, seq in (("+", gene), ("-", reverse(gene))):
            for diag in range(-len(seq) + 1, len(contig)):
                low, high = max(0, -diag), min(len(seq), len(contig) - diag)
                pairs = [seq[i] == contig[i + diag] for i in range(low, high)]
                seeds = sum(all(pairs[i : i + k]) for i in range(len(pairs) - k + 1))
                if seeds >= 2 and len(pairs) >= 0.6 * len(seq) and sum(pairs) >= 0.8 * len(pairs):
                    found.add((name, strand, low + diag + 1, high + diag))
    rows = screen.gene_screen(
        spark.createDataFrame([("s", "c", contig)], "sample string, contig_id string, seq string"),
        spark.createDataFrame(list(genes.items()), "gene string, seq string"), k=k,
    )
    got = {(r["gene"], r["strand"], r["start"], r["end"]) for r in rows.collect()}
    assert got == found and len(found) >= 7


def test_batches_are_scanned_in_bounded_pieces():
    texts = [b"A" * n for n in (0, 40, 70, 250, 10, 0, 90)] * 20
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.binary())], ["bin"])
    pieces = [p.column("bin").to_pylist() for p in scan.in_pieces([batch.slice(0, 0), batch], "bin", 100)]
    assert [t for p in pieces for t in p] == texts
    assert all(sum(map(len, p)) <= 100 or len(p) == 1 for p in pieces)


def test_diagonals_without_enough_seeds_are_left_out():
    rng = random.Random(5)
    members = [dna(rng, 200) for _ in range(30)]
    library = scan.Library(11, [m.encode() for m in members], [0] * 30)
    contig = dna(rng, 3000) + changed(rng, members[4], 9) + dna(rng, 3000) + members[7][100:160] + members[8][:60]
    data = np.frombuffer(contig.encode(), dtype=np.uint8)
    rows, owner, diag, number = library.votes(data, np.zeros(len(data), dtype=np.int64), np.arange(1, len(data) + 1), 2)
    likely = library.hopeful(owner, diag, number, np.array([len(data)])[rows], 0.1, 0.95)
    found = lambda which: {
        (d, int(m)) for d in diag[which].tolist() for own, *_ in library.members_on(0, d, len(data), data, 1, 0.1, 0.95, 2) for m in own
    }
    assert found(likely) == found(np.ones(len(diag), dtype=bool)) == {(3000, 4), (6260, 8)}
    assert likely.sum() < len(diag)


def test_no_exchange_of_bases(spark):
    contigs, alleles = world(random.Random(1), spark, 3, 20)
    plan = typing.near_alleles(contigs, alleles, 9)._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert "Exchange" not in plan and "Join" not in plan and plan.count("Generate") == 1  # of windows


def test_library_of_no_members(spark):
    contigs, alleles = world(random.Random(2), spark, 3, 5)
    assert typing.near_alleles(contigs, alleles.limit(0), 9).count() == 0
    assert typing.near_alleles(contigs.limit(0), alleles, 9).count() == 0


def test_kmer_counts_equal_letters(spark, monkeypatch):
    monkeypatch.setattr(scan, "LETTERS_AT_ONCE", 100)
    rng = random.Random(6)
    rows = [(i % 3, dna(rng, n, "ACGTN" if i % 2 else "ACGT")) for i, n in enumerate((0, 3, 4, 60, 9000, 41, 700))] + [(None, "ACGTACGT"), (1, None)]
    k, want = 5, {}
    for key, seq in rows:
        for i in range(len(seq or "") - k + 1):
            word = seq[i : i + k]
            if set(word) <= set("ACGT"):
                code = int("".join(str("ACGT".index(c)) for c in min(word, reverse(word))), 4)
                want[key, code] = want.get((key, code), 0) + 1
    got = {}
    for r in scan.kmer_counts(spark.createDataFrame(rows, "i int, s string"), "s", k, ["i"]).collect():
        got[r["i"], r["kmer"]] = got.get((r["i"], r["kmer"]), 0) + r["n"]
    assert got == want
