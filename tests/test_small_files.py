"""Folders of many small files: few tasks, the same rows as by Spark's readers, no shuffle left behind."""

import gzip
import time

import pytest
from pyspark.sql import functions as F

from isoloom.operators import summary
from isoloom.plans import files
from isoloom.sources import results, tables
from isoloom.sources.lines import numbered_lines
from isoloom.sources.sheet import scan_numbered_sheet, scan_sheet

NAMES = ("a", "b %41+c", "ñ#1", "x[1]", "d;e=f", "q?&'")


@pytest.fixture
def by_spark(monkeypatch):
    """Turns reading in the tasks off."""

    def turn_off():
        for module in ("lines", "tables"):
            monkeypatch.setattr(f"isoloom.sources.{module}.find_files", lambda *_: None)

    return turn_off


def tasks(df):
    return df.rdd.getNumPartitions()


def test_many_files_are_read_by_few_tasks(spark, tmp_path):
    for i in range(150):
        (tmp_path / f"S{i}").mkdir()
        (tmp_path / f"S{i}" / "pheno_table.txt").write_text("#\n" * 17 + f"d{i}\tc\tResistant\t1\n")
        (tmp_path / f"S{i}" / "ResFinder_results_tab.txt").write_text(f"Resistance gene\tIdentity\ng{i}\t9\n")
        (tmp_path / f"S{i}_amrfinder.tsv").write_text(f"Type\tScope\tElement symbol\nAMR\tcore\ts{i}\n")
        (tmp_path / f"S{i}_mlst.tsv").write_text(f"S{i}\tsch\t{i}\taroC(1)\n")
        (tmp_path / f"S{i}.gff").write_text(f"v{i}\n##FASTA\nA\n")
        (tmp_path / f"S{i}.csv").write_text(f"id;x\nS{i};1\n")
    key = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "4m")  # a file a task for Spark's readers
    try:
        folder, at = str(tmp_path), "sample"
        scans = [
            (results.scan_pheno(spark, folder), at), (results.scan_resistance_genes(spark, folder), at), (results.scan_amr_hits(spark, folder), at),
            (results.scan_mlst_calls(spark, folder), at), (results.scan_gff(spark, folder).withColumn("s", F.concat(F.lit("S"), F.substring("value", 2, 9))), "s"),
        ]
        scans.append((scan_sheet(spark, str(tmp_path / "S1.csv")), "id"))
        assert [tasks(df) for df, _ in scans] == [8] * 6
        for df, column in scans[:5]:
            assert sorted(r[0] for r in df.select(column).collect()) == sorted(f"S{i}" for i in range(150))
    finally:
        spark.conf.set(key, old)


def test_lines_are_those_of_sparks_reader(spark, tmp_path, by_spark):
    for i, name in enumerate(NAMES):
        (tmp_path / f"{name}.txt").write_bytes(b"a\r\nb\rc\n\n" + f"é\t{i}\x0b ".encode() + b"\n##stop\nz" * (i % 2))
    (tmp_path / "bom.txt").write_bytes(b"\xef\xbb\xbfone\ntwo")
    (tmp_path / "empty.txt").write_text("")
    (tmp_path / "_hidden.txt").write_text("x\n")
    with gzip.open(tmp_path / "p.txt.gz", "wt") as out:
        out.write("1\n2\n")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "s.txt").write_text("below\n")
    ways = [{"path": str(tmp_path)}, {"path": f"file://{tmp_path}"}, {"path": str(tmp_path / "a.txt")}] + [{"path": str(tmp_path), **more} for more in ({"recursiveFileLookup": "true"}, {"stop": "##"}, {"skip": 1}, {"pathGlobFilter": "[!b]*.txt"})]
    read = lambda: [sorted(tuple(r) for r in numbered_lines(spark, **w).select("file", "line_no", "value").collect()) for w in ways]
    in_tasks = read()
    by_spark()
    assert in_tasks == read() and len(in_tasks[0]) > 25


SHEETS = {
    "plain": b"id;x;y\nA;1;2\nB;;3\n\nC;1\nD;1;2;3\n", "comma": b'y,id,x\n"1","E","a ""b"", c"\n,F," "\n"",G,\n', "crlf": b"\r\nid;x;y\r\nH;1;2\r\n",
    "line ends": b'id;x;y\nI;"two\nlines";3\n', "stray": b'id;x;y\nJ;a"b";"c\nK;d";e"f\n', "mixed": b"id;x;y\r\nL;1\rM;2;\n", "double": b"id;id;\nN;2;3\n",
    "blank": b"id;x;y\n  \nO;1;2\n", "bom": b"\xef\xbb\xbfid;x;y\nP;1;2\n", "bytes": b"id;x;y\nQ;\xff;2\n", "head": b"id;x;y\n", "none": b"\n\n",
}


@pytest.mark.parametrize("kinds", [("plain", "comma", "crlf", "head", "none"), ("line ends", "stray", "mixed"), ("double", "blank", "bom", "bytes")])
def test_sheets_are_those_of_sparks_reader(spark, tmp_path, by_spark, kinds):
    (tmp_path / "a.csv").write_bytes(b"id;x;y\nA1;1;NA\n")
    for kind in kinds:
        (tmp_path / f"{kind} %41.csv").write_bytes(SHEETS[kind])

    def read():
        plain, numbered = scan_sheet(spark, str(tmp_path)), scan_numbered_sheet(spark, str(tmp_path), headers=True)
        return [sorted((repr(sorted(r.asDict().items(), key=str)) for r in df.collect())) for df in (plain, numbered)]

    in_tasks = read()
    by_spark()
    assert in_tasks == read()


def test_tab_tables_are_those_of_sparks_reader(spark, tmp_path, by_spark):
    for i, line in enumerate(["AMR\tcore\tb", '"AMR"\tcore\t"x\\"y"', "AMR\r", " \n\nAMR\t\tc\td", "AMR\té\t"]):
        (tmp_path / f"A{i}_amrfinder.tsv").write_text(f"Type\tScope\tElement symbol\nAMR\tcore\ta\n{line}\nAMR\tplus\tz\n", newline="")
    (tmp_path / "B_amrfinder.tsv").write_text("Element symbol\tType\tScope\ny\tVIRULENCE\tplus\n")
    read = lambda: sorted(repr(tuple(r)[:4]) for r in results.scan_amr_hits(spark, str(tmp_path)).collect())
    in_tasks = read()
    by_spark()
    assert in_tasks == read() and len(in_tasks) == 16


def test_rounds_write_every_file_and_leave_no_shuffle(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "ROUND_BYTES", 0)
    name = F.when(F.col("id") % 50 != 7, F.concat(F.lit("d"), (F.col("id") % 3).cast("string"), F.lit("/f"), (F.col("id") % 50).cast("string")))
    spark.range(5000).select(name.alias("name"), F.col("id").cast("string").alias("value"), (-F.col("id")).alias("at")).write.parquet(str(tmp_path / "lines"))
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffles = lambda: {f for f in blocks.getAllFiles().mkString("\n").split("\n") if "shuffle_" in f}
    before = shuffles()
    files.write_named_files(spark.read.parquet(str(tmp_path / "lines")), str(tmp_path / "out"), ["at"], "head\n")
    until = time.time() + 20
    while shuffles() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffles() - before
    want = {}
    for i in sorted(range(5000), reverse=True):
        if i % 50 != 7:
            want.setdefault(f"d{i % 3}/f{i % 50}", ["head"]).append(str(i))
    got = {str(p.relative_to(tmp_path / "out")): p.read_text() for p in (tmp_path / "out").rglob("f*")}
    assert got == {f: "\n".join(rows) + "\n" for f, rows in want.items()} and len(want) == 147


def test_headers_without_a_line(spark, tmp_path):
    (tmp_path / "A_amrfinder.tsv").write_text("\n\n")
    assert results.scan_amr_hits(spark, str(tmp_path)).count() == 0 and results.scan_amr_hits(spark, str(tmp_path / "no")).count() == 0
    assert tables.scan_by_header(spark, str(tmp_path), lambda h: "\t", lambda df, *_: df) is None


def test_drugs_without_resistance_arent_shuffled(spark, rows):
    """One row a sample and task stands for all drugs that aren't predicted resistant, or of no class."""
    given = [(f"s{i % 2}", f"d{i}", f"c{i % 3}", "No resistance", i) for i in range(400)] + [
        ("s0", "b", "k", "Resistant", 9), ("s0", "a", "k", "Resistant", 7), ("s0", "a", "k", "Resistant", 11), ("s0", "a", "k", None, 1),
        ("s0", None, "n", "Resistant", 3), ("s0", "x", None, "Resistant", 2), (None, "y", "j", "Resistant", 5), ("s2", None, None, None, 1),
    ]
    pheno = rows("sample string, antimicrobial string, class string, predicted string, line_no long", *given).coalesce(1)
    out = summary.phenotype_summary(pheno)
    assert {tuple(r) for r in out.collect()} == {("s0", "a-b[k] [n]"), ("s1", ""), ("s2", ""), (None, "y[j]")}
    grouped = out._jdf.queryExecution().optimizedPlan().toString().split("Aggregate [")[-1].split("]")[0]
    assert "sample" in grouped and grouped.count("_groupingexpression") == 2
