import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from isoloom.operators import summary
from isoloom.sinks import files as sinks
from isoloom.sources import results, sequences
from isoloom.sources.lines import edge_lines, numbered_lines, placed_lines
from isoloom.sources.results import scan_gff
from isoloom.sources.sheet import scan_numbered_sheet, scan_sheet


@pytest.fixture
def tiny_splits(spark):
    """Files cut into splits of a few hundred bytes."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300b")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for key, value in old.items():
        spark.conf.set(key, value)


def test_line_numbers_across_splits(spark, tmp_path, tiny_splits):
    for name, n in (("a.txt", 500), ("b.txt", 3), ("c.txt", 77)):
        (tmp_path / name).write_text("".join(f"{name}{i}\n" for i in range(1, n + 1)))
    lines = numbered_lines(spark, str(tmp_path))
    assert lines.rdd.getNumPartitions() > 3
    got = lines.select(F.element_at(F.split("file", "/"), -1).alias("f"), "line_no", "value").collect()
    assert len(got) == 580
    assert all(r["value"] == f"{r['f']}{r['line_no']}" for r in got)


def test_annotation_ends_where_it_is_read(spark, tmp_path, tiny_splits):
    """In the first split, in a later one, nowhere; twice in a file; lines are numbered and cut without a shuffle of lines."""
    texts = {"a.gff": ["##FASTA", *["ACGT" * 20] * 50], "b.gff": [f"b{i}" for i in range(300)] + ["##FASTA x", "c", "##FASTA", "d"], "c.gff": ["c1", "", "c3"]}
    for name, text in texts.items():
        (tmp_path / name).write_text("".join(f"{line}\n" for line in text))
    lines = scan_gff(spark, str(tmp_path))
    got = {(r["file"].rsplit("/", 1)[1], r["line_no"], r["value"]) for r in lines.collect()}
    want = {("b.gff", i + 1, f"b{i}") for i in range(300)} | {("c.gff", 1, "c1"), ("c.gff", 2, ""), ("c.gff", 3, "c3")}
    assert got == want
    plan = lines._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert "MapInArrow" in plan and "SortMergeJoin" not in plan


def test_line_numbers_without_broadcast(spark, tmp_path, tiny_splits, monkeypatch):
    monkeypatch.setattr("isoloom.sources.lines.MAX_BROADCAST_BLOCKS", 0)
    (tmp_path / "a.txt").write_text("".join(f"{i}\n" for i in range(1, 400)))
    assert all(str(r["line_no"]) == r["value"] for r in numbered_lines(spark, str(tmp_path)).collect())


@pytest.mark.parametrize("sep", [";", ","])
def test_separator_comes_from_the_header(spark, tmp_path, sep):
    (tmp_path / "s.csv").write_text(f"id{sep}x\n01{sep}NA\n\"a{sep}b\"{sep}none\n")
    assert [tuple(r) for r in scan_sheet(spark, str(tmp_path / "s.csv")).collect()] == [("01", None), (f"a{sep}b", "none")]
    numbered = scan_numbered_sheet(spark, str(tmp_path / "s.csv")).orderBy("row_no").collect()
    assert [(r["row_no"], r["id"], r["x"]) for r in numbered] == [(2, "01", None), (3, f"a{sep}b", "none")]


def fastq(n, tag=""):
    return "".join(f"@{tag}{i} x\n{'ACGT' * (i % 7 + 1)}\n+\n{'@III' * (i % 7 + 1)}\n" for i in range(n))


def test_compressed_reads_stay_whole(spark, tmp_path):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        for f in range(5):
            with gzip.open(tmp_path / f"s{f}.fastq.gz", "wt") as out:
                out.write(fastq(50 + f, f"f{f}_"))
        got = sequences.scan_fastq(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == 260
    for r in got:
        i = int(r["read_id"].split("_")[1].split()[0])
        assert r["seq"] == "ACGT" * (i % 7 + 1) and r["qual"] == "@III" * (i % 7 + 1)


def test_plain_reads_across_splits(spark, tmp_path, tiny_splits):
    (tmp_path / "s.fastq").write_text(fastq(200).replace("\n", "\r\n"))
    got = {r["read_id"]: (r["seq"], r["qual"]) for r in sequences.scan_fastq(spark, str(tmp_path)).collect()}
    assert got == {f"{i} x": ("ACGT" * (i % 7 + 1), "@III" * (i % 7 + 1)) for i in range(200)}


def test_fasta_and_alleles(spark, tmp_path, tiny_splits):
    folder = tmp_path / "lp"
    folder.mkdir()
    body = ">neuA_neuAH_1 note A>G\nacgt\nAC\n>neuA_neuAH_12\nGG\n"
    (folder / "neuA.tfa").write_text(body + body)
    (folder / "flaA.tfa").write_text("".join(f">flaA_{i}\n{'ACGTAC' * 30}\n{'T' * i}\n" for i in range(1, 40)))
    got = {(r["scheme"], r["locus"], r["allele"]): r["seq"] for r in sequences.scan_alleles(spark, str(folder)).collect()}
    assert got[("lp", "neuA_neuAH", "1")] == "ACGTAC" and got[("lp", "neuA_neuAH", "12")] == "GG"
    assert len(got) == 41 and got[("lp", "flaA", "7")] == "ACGTAC" * 30 + "T" * 7


def test_hits_keep_first_seen_order_and_empty_files_vanish(spark, tmp_path, tiny_splits):
    lines = [f"AMR\tcore\tg{i % 60}" for i in range(59, -1, -1)] * 3
    (tmp_path / "A 1_amrfinder.tsv").write_text("Type\tScope\tElement symbol\n" + "\n".join(lines) + "\n")
    (tmp_path / ".B_amrfinder.tsv").write_text("Type\tScope\tElement symbol\nAMR\tcore\tx\n")
    (tmp_path / "C_amrfinder.tsv").write_text("")
    got = summary.amr_summary(results.scan_amr_hits(spark, str(tmp_path))).collect()
    assert [r["Sample"] for r in got] == ["A 1"]
    assert got[0]["AMR"] == " ".join(f"g{i}" for i in range(59, -1, -1)) and got[0]["VIRULENCE"] == ""


def test_pheno_counts_calls_and_gff(spark, tmp_path):
    sample = tmp_path / "resfinder" / "S1"
    sample.mkdir(parents=True)
    table = "tobramycin\tami\tResistant\t3\tx\namikacin\tami\tNo resistance\t0\t\n"
    (sample / "pheno_table.txt").write_text("# x\n" * 17 + table)
    (sample / "ResFinder_results_tab.txt").write_text("Resistance gene\tIdentity\naac\t100\nNA\t9\naac\t8\n")
    rows = results.scan_pheno(spark, str(tmp_path / "resfinder")).orderBy("line_no").collect()
    assert [(r["sample"], r["antimicrobial"], r["predicted"]) for r in rows] == [("S1", "tobramycin", "Resistant"), ("S1", "amikacin", "No resistance")]
    genes = results.scan_resistance_genes(spark, str(tmp_path / "resfinder"))
    assert [tuple(r) for r in summary.resistance_genes(genes).collect()] == [("S1", "aac")]
    (tmp_path / "S1_counts.txt").write_text("42\n")
    assert [tuple(r) for r in results.scan_counts(spark, str(tmp_path)).collect()] == [("S1", 42)]
    (tmp_path / "S1_mlst.tsv").write_text("S1\tsch\t7\taroC(1)\tdnaN(2)\nbad\tline\n")
    call = results.scan_mlst_calls(spark, str(tmp_path)).collect()
    assert [(r["sample"], r["st"], r["alleles"]) for r in call] == [("S1", "7", ["aroC(1)", "dnaN(2)"])]
    (tmp_path / "S1.gff").write_text("a\nb\n##FASTA\nc\n##FASTA\n")
    assert sorted(r["value"] for r in results.scan_gff(spark, str(tmp_path)).collect()) == ["a", "b"]


def test_profiles_and_species(spark, tmp_path):
    (tmp_path / "p.txt").write_text("ST\tx\ty\tclonal_complex\n1\t5\t6\t\n2\t7\t8\tCC1\n")
    got = {tuple(r) for r in results.scan_profiles(spark, str(tmp_path / "p.txt"), "p").collect()}
    assert got == {("p", "1", "x", "5"), ("p", "1", "y", "6"), ("p", "2", "x", "7"), ("p", "2", "y", "8")}
    (tmp_path / "sp.csv").write_text("name;genome_size;gram;is_bacteria;use_platon\ne_coli;5000000;negative;true;\n")
    assert tuple(results.scan_species(spark, str(tmp_path / "sp.csv")).first()) == ("e_coli", 5000000, "negative", True, None)


def test_inventory_and_manifest(spark, tmp_path):
    for name in ("a_R1.fastq.gz", "b.fq", "c.txt", "d.sam.gz", "e.fastq.bak", "f x.fq.gz"):
        (tmp_path / name).write_bytes(name.encode())
    found = results.scan_read_files(spark, str(tmp_path)).collect()
    assert {r["path"].rsplit("/", 1)[1]: r["ext_rank"] for r in found} == {"a_R1.fastq.gz": 0, "b.fq": 3, "f x.fq.gz": 2}
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "z.txt").write_bytes(b"z" * 5000)
    for limit in (256 << 20, 100):  # built-in digest, and streamed digest for the larger file
        listed = results.scan_files(spark, str(tmp_path), "c.txt", whole_limit=limit)
        got = {r["rel_path"]: r["md5"] for r in listed.collect()}
        assert got["sub/z.txt"] == hashlib.md5(b"z" * 5000).hexdigest() and "c.txt" not in got and len(got) == 6


def test_round_trips(spark, tmp_path, rows):
    df = rows("sheet string, row_no long, id string, note string", ("r1", 2, "01", 'a;"b"'), ("r2", 2, "x", None), ("r1", 3, "y", " "))
    sinks.write_validated(df, str(tmp_path / "v"), ("sheet",))
    back = scan_sheet(spark, str(tmp_path / "v"), ";")
    assert {(r["id"], r["note"], r["sheet"]) for r in back.collect()} == {("01", 'a;"b"', "r1"), ("x", None, "r2"), ("y", " ", "r1")}
    reads = rows("sample string, read_id string, seq string, qual string", ("s", "r1", "ACG", "III"), ("s", "r2", "A", "@"))
    sinks.write_fastq(reads, str(tmp_path / "q"), ("sample",))
    assert {tuple(r)[1:] for r in sequences.scan_fastq(spark, str(tmp_path / "q")).collect()} == {("r1", "ACG", "III"), ("r2", "A", "@")}
    sinks.write_fasta(rows("id string, seq string", ("c1", "ACGT" * 50), ("c2", "A" * 60)), str(tmp_path / "f"))
    assert {(r["id"], r["seq"]) for r in sequences.scan_fasta(spark, str(tmp_path / "f")).collect()} == {("c1", "ACGT" * 50), ("c2", "A" * 60)}


def test_files_with_other_headers(spark, tmp_path):
    folder = tmp_path / "a%b +x"
    folder.mkdir()
    (folder / "a.csv").write_text("id;path;organism\nA1;/d/1;Kleb\n\nA2;/d/2;\"two\nlines\"\n")
    (folder / "b.csv").write_text("organism,id,path\nKleb,B1,/d/2\n")
    got = {(r["row_no"], r["id"], r["path"], r["organism"]) for r in scan_numbered_sheet(spark, str(folder)).collect()}
    assert got == {(2, "A1", "/d/1", "Kleb"), (3, "A2", "/d/2", "two\nlines"), (2, "B1", "/d/2", "Kleb")}
    (folder / "P_amrfinder.tsv").write_text("Element symbol\tScope\tType\nzz\tcore\tAMR\nyy\tcore\tAMR\n")
    (folder / "P_amrfinder.x.tsv").write_text("Type\tElement symbol\tScope\nAMR\taa\tcore\n")
    (folder / "Q_amrfinder.tsv").write_text("Element symbol\tScope\tType\n")
    hits = results.scan_amr_hits(spark, str(folder))
    assert [r["AMR"] for r in summary.amr_summary(hits).collect()] == ["zz yy aa"]
    assert {r["sample"] for r in results.scan_samples(spark, str(folder)).collect()} == {"P", "Q"}


def test_mixed_and_broken_reads(spark, tmp_path):
    record = lambda i: f"@r{i}\nACGT\n+\nIIII\n"
    (tmp_path / "plain.fastq").write_text("".join(map(record, range(200))))
    with gzip.open(tmp_path / "packed.fastq.gz", "wt") as out:
        out.write("".join(map(record, range(200, 300))))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    try:
        got = sorted(tuple(r)[1:] for r in sequences.scan_fastq(spark, str(tmp_path)).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == sorted((f"r{i}", "ACGT", "IIII") for i in range(300))
    for name, text in (("cut.fastq", "@r\nAC\n+\n"), ("marks.fastq", "r\nAC\n+\nII\n"), ("length.fastq", "@r\nAC\n+\nI\n")):
        for pack in (False, True):
            folder = tmp_path / f"{name}-{pack}"
            folder.mkdir()
            if pack:
                with gzip.open(folder / f"{name}.gz", "wt") as out:
                    out.write(text)
            else:
                (folder / name).write_text(text)
            reads = sequences.scan_fastq(spark, str(folder))
            for ask in (reads.collect, reads.count, reads.select("seq").collect, reads.select("file").count, reads.select("qual").collect):
                with pytest.raises(Exception, match="FASTQ"):
                    ask()


def test_broken_reads_in_tiny_splits(spark, tmp_path, tiny_splits):
    for name, text in (("late.fastq", fastq(300) + "@x\nACG\n+\nII\n" + fastq(5)), ("shifted.fastq", fastq(300) + "\n" + fastq(5)), ("cut.fastq", fastq(300) + "@x\nACG\n")):
        (tmp_path / name).write_text(text)
        for column in ("read_id", "seq", "qual"):
            with pytest.raises(Exception, match="FASTQ"):
                sequences.scan_fastq(spark, str(tmp_path / name)).select(column).collect()
    (tmp_path / "blank.fastq").write_text(fastq(300) + "\n" * 9)
    assert sequences.scan_fastq(spark, str(tmp_path / "blank.fastq")).count() == 300


def test_reads_stay_in_their_splits(spark, tmp_path, tiny_splits):
    (tmp_path / "s.fastq").write_text(fastq(400))
    reads = sequences.scan_fastq(spark, str(tmp_path))
    inside = {tuple(r) for r in reads.select("read_id", "seq").collect()}
    assert inside == {(f"{i} x", "ACGT" * (i % 7 + 1)) for i in range(400)}
    raw, offsets, few = placed_lines(spark, str(tmp_path / "s.fastq"))
    assert few and 0 < edge_lines(raw, offsets, 4).count() <= 7 * offsets.count()


def test_first_line_may_be_blank(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\n\nid;x\nA;1\n")
    (tmp_path / "b.csv").write_text("\n\nx,id\n2,B\n")
    for path, want in (("a.csv", {("A", "1")}), ("b.csv", {("B", "2")}), (".", {("A", "1"), ("B", "2")})):
        got = scan_numbered_sheet(spark, str(tmp_path / path), headers=True).collect()
        assert {(r["id"], r["x"]) for r in got} == want and {r["row_no"] for r in got} == {2}
        assert {(r["id"], tuple(r["header"])) for r in got} <= {("A", ("id", "x")), ("B", ("x", "id"))}
