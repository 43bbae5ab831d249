"""The tables that stand in for reads, on odd rows."""

import gzip

from pyspark.sql import functions as F

from isoloom.operators import reads as read_operators
from isoloom.plans import catalog, files, views


def test_reads_are_laid_out_in_the_map_tasks(spark, tmp_path, monkeypatch):
    rows = [(3, "a", "en", "x" * 99 + "Yz"), (None, "a", "en", "Hello, world"), (7, None, "en", "AbKİ ä z" * 40), (8, "b", "en", ""), (9, "b", "en", None), (10, "b", None, "1 2 3")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, text string")
    docs.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    want = set()
    for doc, source, _, text in rows:
        bases = "".join("ACGT"[(ord(c) - 97) % 4] for c in (text or "").lower() if "a" <= c <= "z")
        for i in range(0, -(-len(bases) // 100)):
            own = bases[100 * i : 100 * i + 100]
            seq, qual = "", ""
            for p, c in enumerate(own, 1):
                seq += "N" if doc is not None and p % (7 + (doc + i) % 50) == 0 else c
                low = 40 if doc is None else p * (doc % 6) // 10 + (p * 7 + ord(c)) % 9
                qual += chr(33 + max(2, 40 - low))
            pair = f"{i // 2}" if doc is None else f"{doc}_{i // 2}"
            want.add((source, pair, i % 2 + 1, seq, qual))
    reads = views.reads(spark, str(tmp_path))
    assert {tuple(r) for r in reads.collect()} == want and len(want) == 5
    plan = reads._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert "MapInArrow" in plan and "transform(" not in plan


def test_mixed_sheets_are_read_once(spark, tmp_path):
    """The checks ask for the rows of the sheets several times; the files are opened for the first alone."""
    rows = [(k, 7 * k, f"2024-05-{k % 28 + 1:02d}", "O", "1-URGENT") for k in range(1, 41)]
    orders = spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderdate string, o_orderstatus string, o_orderpriority string")
    orders.selectExpr("* except (o_orderdate)", "cast(o_orderdate as date) o_orderdate").write.parquet(str(tmp_path / "orders.parquet"))
    issues = catalog.QUERIES["validation_mixed_sheets"](spark, str(tmp_path))
    assert issues.inputFiles() and not [f for f in issues.inputFiles() if f.endswith(".csv")]
    assert {r["code"] for r in issues.select("code").distinct().collect()} >= {"FILE_MISSING", "COLUMNS_REQUIRED", "BLANK"}


def test_packed_files_are_whole(spark, tmp_path):
    """Files of many batches, one after the other in a task; the highest level of gzip (2 in byte 8) is not used."""
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "70")
    try:
        name = F.concat(F.lit("f"), (F.col("id") % 9).cast("string"), F.when(F.col("id") % 3 == 0, ".fastq").otherwise(".fastq.gz"))
        lines = spark.range(6000).select(name.alias("name"), F.concat(F.lit("@é"), F.sha2(F.col("id").cast("string"), 256)).alias("value"), "id")
        files.write_named_files(lines.coalesce(1), str(tmp_path / "out"), ["id"])
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    want = {}
    for row in lines.orderBy("id").collect():
        want.setdefault(row["name"], []).append(row["value"])
    assert {p.name for p in (tmp_path / "out").iterdir() if not p.name.startswith(".")} == set(want) and len(want) == 9
    for file, rows in want.items():
        data = (tmp_path / "out" / file).read_bytes()
        assert not file.endswith(".gz") or data[8] != 2
        text = gzip.decompress(data) if file.endswith(".gz") else data
        assert text.decode() == "\n".join(rows) + "\n"
    assert spark.read.text(str(tmp_path / "out")).count() == 6000


def test_lines_counted_per_file_make_the_same_reads(spark, rows):
    lines = rows("sample string, mate int", *[("a", 1)] * 10, *[("a", 2)] * 7, *[("a", None)] * 3, *[("b", None)] * 4, (None, 1))
    samples = rows("sample string", ("a",), ("b",), ("c",), (None,))
    counted = lines.groupBy("sample", "mate").agg(F.count("*").alias("n"))
    want = {("a", 5, 2, 1), ("b", 1, 0, 0), ("c", 0, 0, 0), (None, 0, 0, 0)}
    for given in (lines, counted):
        counts = read_operators.read_count(samples, given)
        assert {tuple(r) for r in counts.collect()} == want
        assert [f.dataType.simpleString() for f in counts.schema] == ["string", "bigint", "bigint", "bigint"]


def test_names_of_read_files_are_taken_apart_per_file(spark, tmp_path):
    docs = spark.createDataFrame([(1, "s1", "en", "abc" * 150), (2005, "s1", "en", "x" * 250)], "doc_id long, source string, lang string, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([("p",)], "p_type string").write.parquet(str(tmp_path / "part.parquet"))
    assert {tuple(r) for r in catalog.QUERIES["read_count"](spark, str(tmp_path)).collect()} == {("s1", 8, 5, 3), ("p", 0, 0, 0)}
    lines = catalog._read_lines(spark, str(tmp_path))
    assert {tuple(r) for r in lines.collect()} == {("s1", 1, 12), ("s1", 2, 8), ("s1", 1, 8), ("s1", 2, 4)}
