import pytest
from pyspark.sql import functions as F

from isoloom.functions import dates, dna, names, quality, text

DATES = {
    "1/7/24": "2024-07-01", "01.07.2024": "2024-07-01", "2024-7-1": "2024-07-01", "2024/07/01": "2024-07-01",
    "24-07-01": "2001-07-24", "1-7/24": "2024-07-01", "1/7/68": "2068-07-01", "1/7/69": "1969-07-01", "31/02/2024": None,
    "29/02/23": None, "7/13/24": None, "20240701": None, "1/7/024": None, "2024-07-01 10:00": None, " 1/7/24": None, "": None,
}
FILES = {
    "A1_S5_R1_001.fastq.gz": ("A1", "R1"), "A1_S5_L001_R2_001.fastq.gz": ("A1_S5_L001", "R2"), "A1_R2.fq": ("A1", "R2"),
    "A1.r1.fastq.gz": ("A1", "R1"), "A1_F.fq.gz": ("A1", "R1"), "A1_R.fastq": ("A1", "R2"), "A1_f.fastq": ("A1_f", "R1"),
    "x_S2_r2_001.fastq.gz": ("x_S2", "R2"), "A.B_R1.fastq": ("A.B", "R1"), "A1_1.fastq.gz": ("A1_1", None),
}


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_dates(rows):
    df = rows("t string", *[(t,) for t in DATES]).select(
        "t", dates.parse_date(F.col("t")).cast("string").alias("d"), dates.iso_or_original(F.col("t")).alias("kept")
    )
    for r in df.collect():
        assert r["d"] == DATES[r["t"]], r["t"]
        assert r["kept"] == (DATES[r["t"]] or r["t"])


def test_file_names(rows):
    df = rows("p string", *[(f"/d/{f}",) for f in FILES])
    got = df.select("p", names.illumina_sample_id(F.col("p")).alias("s"), names.mate_role(F.col("p")).alias("m")).collect()
    for r in got:
        assert (r["s"], r["m"]) == FILES[r["p"][3:]]


def test_long_read_names(rows):
    df = rows("p string", ("/d/n.x.fastq.gz",), ("/d/n.fq",), ("/d/n.txt",))
    assert [r[0] for r in df.select(names.nanopore_sample_id(F.col("p"))).collect()] == ["n.x", "n", "n.txt"]


@pytest.mark.parametrize(
    "run, issue",
    [("240512_CLIN002", None), ("240512_XXXX002", "HOSPITAL_UNKNOWN"), ("24512_CLIN002", "RUN_NAME_FORMAT"), ("", "RUN_NAME_MISSING")],
)
def test_run_names(spark, run, issue):
    assert one(spark, names.run_name_issue(F.lit(run))) == issue


@pytest.mark.parametrize(
    "r1, r2, nano, reported, staged",
    [
        ("a", None, None, "ILLUMINA", "ILLUMINA"), ("a", "b", "c", "HYBRID", "HYBRID"), (None, None, "c", "NANOPORE", "NANOPORE"),
        (None, "b", None, None, "ILLUMINA"), (None, None, None, None, None), ("", "", "", None, None),
    ],
)
def test_methods(rows, r1, r2, nano, reported, staged):
    df = rows("r1 string, r2 string, n string", (r1, r2, nano))
    a, b, c = F.col("r1"), F.col("r2"), F.col("n")
    got = df.select(names.sequencing_method((a,), c), names.sequencing_method((a, b), c)).first()
    assert tuple(got) == (reported, staged)


def test_deposit_path(spark):
    at = lambda m, f, n: one(spark, names.deposit_path("/s", F.lit("240512_CLIN002"), F.lit(m), F.lit(f), F.lit(n)))
    assert at("ILLUMINA", "/d/x_R1.fastq.gz", None) == "/s/CVA_CLIN/illumina/240512_CLIN002/fastq/x_R1.fastq.gz"
    assert at("NANOPORE", None, "/d/n.fq") == "/s/CVA_CLIN/nanopore/240512_CLIN002/fastq/n.fq"
    assert at(None, None, None) == "/s/CVA_CLIN/nanopore/240512_CLIN002/fastq"
    assert one(spark, names.deposit_path("/s", F.lit("norun"), F.lit("ILLUMINA"), F.lit("/a"), F.lit("/b"))) is None


def test_texts(spark):
    assert one(spark, text.wrap_outside_brackets(F.lit("a-b[x y] c[z w]"))) == "a-b[x y]\nc[z w]"
    assert one(spark, text.wrap_outside_brackets(F.lit(None).cast("string"))) is None
    assert one(spark, text.gff_retag(F.lit("c\tID=x;q=1;Name=q;name=z"))) == "c\tID=x;Name=x;q=1;OldName=q;name=z"
    assert one(spark, text.gff_retag(F.lit("c\tID=x"))) == "c\tID=x;Name=x"
    assert one(spark, text.sanitize_id(F.lit("a b.c,d-e"))) == "a_b_c_d_e"
    assert one(spark, text.organism_key(F.lit("Enterococcus faecium"))) == "enterococcus_faecium"


def test_null_tokens(rows):
    df = rows("a string, b int", ("NA", 1), ("null", 2), ("None", 3), ("none", 4), ("", 5), (" NA", 6))
    assert [r["a"] for r in text.null_tokens(df).orderBy("b").collect()] == [None, None, None, "none", None, " NA"]


def test_tail_keep_matches_definition(spark, rows):
    import random

    rng = random.Random(5)
    quals = ["".join(chr(33 + rng.choice((2, 12, 25, 38))) for _ in range(rng.randrange(0, 60))) for _ in range(300)]

    def keep(q, w=10):
        ends = [i + w for i in range(len(q) - w + 1) if sum(ord(c) - 33 for c in q[i:i + w]) >= 20 * w]
        return max(ends, default=0)

    df = rows("i int, q string", *enumerate(quals)).select("i", quality.tail_keep(F.col("q")).alias("k"))
    assert {r["i"]: r["k"] for r in df.collect()} == {i: keep(q) for i, q in enumerate(quals)}


def test_quality_counts(spark):
    q = F.lit("".join(chr(33 + x) for x in (0, 14, 15, 19, 20, 29, 30, 41)))
    assert one(spark, quality.count_below(q, 15)) == 2
    assert one(spark, quality.count_from(q, 20)) == 4
    assert one(spark, quality.count_from(q, 30)) == 2


def test_kmers_cover_every_position_once(rows):
    import random

    rng = random.Random(1)
    seqs = ["".join(rng.choice("ACGT") for _ in range(n)) for n in (1, 4, 5, 4096, 4097, 4100, 9001)]
    df = dna.kmer_rows(rows("i int, s string", *enumerate(seqs)), "s", 5, ["i"])
    got = {(r["i"], r["pos"], bytes(r["kmer"]).decode()) for r in df.collect()}
    want = {(i, p + 1, s[p:p + 5]) for i, s in enumerate(seqs) for p in range(len(s) - 4)}
    assert got == want and df.count() == len(want)


def test_canonical_kmers(rows):
    df = dna.canonical_kmers(rows("i int, s string", (1, "AACGNTTGCA"), (2, "TGCAAC")), "s", 4, ["i"])
    flip = str.maketrans("ACGT", "TGCA")

    def least(s):
        return sorted(min(w, w.translate(flip)[::-1]) for w in (s[p:p + 4] for p in range(len(s) - 3)) if "N" not in w)

    for i, s in ((1, "AACGNTTGCA"), (2, "TGCAAC")):
        assert sorted(bytes(r["kmer"]).decode() for r in df.filter(F.col("i") == i).collect()) == least(s)
