from isoloom.plans import workflow
from isoloom.plans.catalog import QUERIES


def test_from_files_to_reports(spark, tmp_path):
    reads = tmp_path / "fastq"
    reads.mkdir()
    for name in ("a_R1.fastq.gz", "a_R2.fastq.gz", "b_R1.fastq.gz"):
        (reads / name).write_bytes(b"x")
    sheet, left_out = workflow.sheet_from_folder(spark, str(reads), "normal", "illumina")
    row = sheet.first()
    assert row["id"] == "a" and row["illumina_r1"].endswith("/fastq/a_R1.fastq.gz")
    assert [tuple(r) for r in left_out.collect()] == [("b", "R2")]

    (tmp_path / "240512_CLIN002.csv").write_text(
        "CODIGO_MUESTRA_ORIGEN;PETICION;FECHA_TOMA_MUESTRA;ESPECIE_SECUENCIA;MOTIVO_WGS;ILLUMINA_R1;ILLUMINA_R2;NANOPORE\n"
        f"a;1;1/7/24;E;V;{reads}/a_R1.fastq.gz;{reads}/a_R2.fastq.gz;\nz;2;x;E;V;{reads}/no.fq;;\n"
    )
    issues, valid = workflow.validate_files(spark, str(tmp_path / "240512_CLIN002.csv"), "gva", None, [str(reads)])
    assert {(r["row_no"], r["code"]) for r in issues.collect()} == {(3, "DATE_INVALID"), (3, "FILE_MISSING")}

    found = tmp_path / "results"
    found.mkdir()
    (found / "a_mlst.tsv").write_text("a\tsch\t5\tx(1)\n")
    (found / "a_amrfinder.tsv").write_text("")
    report = workflow.report_from_results(spark, str(found)).collect()
    assert [(r["Sample"], r["ST"], r["AMR"], r["GENE_resfinder"]) for r in report] == [("a", "5", None, None)]
    workflow.write_reports(spark, valid.drop("sheet", "row_no"), str(found), str(tmp_path / "out"), "240512_CLIN002", "/s")
    lab = spark.read.csv(str(tmp_path / "out" / "240512_CLIN002_lab"), sep=";", header=True)
    got = {r["CODIGO_MUESTRA_ORIGEN"]: (r["ST_WGS"], r["FICHERO_LECTURAS_WGS"]) for r in lab.collect()}
    assert got == {"a": ("5", "/s/CVA_CLIN/illumina/240512_CLIN002/fastq/a_R1.fastq.gz"), "z": (None, "/s/CVA_CLIN/illumina/240512_CLIN002/fastq/no.fq")}


def test_contigs_of_few_samples_are_not_shuffled_for_the_gate(spark):
    report = QUERIES["run_report"](spark, "/root/testdata/sf0.001")
    plan = report._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    gates = [line for line in plan.splitlines() if "LeftAnti" in line and "Join [sample" in line]
    assert gates and all("BroadcastHashJoin" in line for line in gates)
