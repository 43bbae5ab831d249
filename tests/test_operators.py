import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from isoloom.operators import assembly, lab, pairing, qc, reads, screen, staging, summary, taxonomy, typing, validation
from isoloom.sources.results import split_mlst_calls
from isoloom.streaming.ingest import ingest_new_files, ingested_counts

FLIP = str.maketrans("ACGT", "TGCA")


def rc(s):
    return s.translate(FLIP)[::-1]


def dna(rng, n):
    return "".join(rng.choice("ACGT") for _ in range(n))


# --- report ---------------------------------------------------------------------------------------------------------


def test_golden_report_row(rows):
    calls = split_mlst_calls(rows("value string", ("23_SALM_92123\tsenterica_achtman_2\t1628\taroC(46)\tdnaN(60)\themD(10)\thisD(9)\tpurE(6)\tsucA(12)\tthrA(17)",)))
    amr = [("AMR", "core", "fosA7.7"), ("AMR", "plus", "mdsA"), ("AMR", "core", "fosA7.7"), ("AMR", "plus", "mdsB"), ("VIRULENCE", "plus", "iroB"),
           ("AMR", "core", "tet(C)"), ("VIRULENCE", "plus", "iroC"), ("STRESS", "plus", "zzz"), ("VIRULENCE", "plus", "sinH"), ("AMR", "plus", "mdsA")]
    s = "23_SALM_92123"
    hits = rows("sample string, type string, scope string, symbol string, line_no long", *[(s, *h, i) for i, h in enumerate(amr)])
    genes = rows("sample string, gene string, line_no long", *[(s, g, i) for i, g in enumerate(["aac(6')-Iaa", "fosA7", None, "tet(C)", "fosA7"])])
    drugs = [("tetracycline", "tetracycline"), ("tobramycin", "aminoglycoside"), ("fosfomycin", "fosfomycin"), ("amikacin", "aminoglycoside"), ("tobramycin", "aminoglycoside"), ("doxycycline", "tetracycline"), ("x", None)]
    pheno = rows("sample string, antimicrobial string, class string, predicted string, line_no long", *[(s, d, c, "Resistant", i) for i, (d, c) in enumerate(drugs)], (s, "y", "other", "No resistance", 9))
    got = summary.combined_report(calls, hits, genes, pheno).collect()
    assert [tuple(r) for r in got] == [(
        s, "senterica_achtman_2", "1628", "aroC(46) dnaN(60) hemD(10) hisD(9) purE(6) sucA(12) thrA(17)", "fosA7.7 mdsA mdsB tet(C)",
        "iroB iroC sinH", "fosA7.7 tet(C)", "aac(6')-Iaa fosA7 tet(C)",
        "tobramycin-amikacin[aminoglycoside] fosfomycin[fosfomycin] tetracycline-doxycycline[tetracycline]",
    )]


def test_report_order_and_missing_sides(rows):
    mlst = rows("Sample string, Scheme_mlst string, ST string, MLST string", ("b", "x", "9", ""), ("b", "x", "10", ""), ("b", "x", None, ""), ("a", "x", "1", ""))
    amr = rows("Sample string, AMR string, VIRULENCE string, SCOPE_core string", ("c", "g", "", ""))
    res = rows("Sample string, GENE_resfinder string, PHENO_resfinder string", ("d", "g", ""), ("b", "h", ""))
    got = summary.report_sort(summary.combine_results(mlst, amr, res)).collect()
    assert [(r["Sample"], r["ST"], r["AMR"], r["GENE_resfinder"]) for r in got] == [
        ("a", "1", None, None), ("b", "10", None, "h"), ("b", "9", None, "h"), ("b", None, None, "h"), ("c", None, "g", None), ("d", None, None, "g")
    ]


def test_empty_inputs_give_an_empty_report(rows):
    calls = rows("sample string, scheme string, st string, alleles array<string>")
    hits = rows("sample string, type string, scope string, symbol string, line_no long")
    genes = rows("sample string, gene string, line_no long")
    pheno = rows("sample string, antimicrobial string, class string, predicted string, line_no long")
    report = summary.combined_report(calls, hits, genes, pheno)
    assert report.count() == 0 and report.columns == list(summary.REPORT_COLUMNS)


# --- validation -----------------------------------------------------------------------------------------------------

GVA = "sheet string, run string, row_no long, CODIGO_MUESTRA_ORIGEN string, PETICION string, FECHA_TOMA_MUESTRA string, ESPECIE_SECUENCIA string, MOTIVO_WGS string, ILLUMINA_R1 string, ILLUMINA_R2 string, NANOPORE string"


def test_hospital_sheets(rows):
    ok = ("E1", "9", "1/7/24", "Enterococcus faecium", "Vigilancia", "/d/a", "/d/b", None)
    sheet = rows(
        GVA, ("good", "240512_CLIN002", 2, *ok), ("warn", "240512_CLIN002", 2, "ñ1", "9", None, "o", "v", "/d/a", None, None),
        ("bad", "240512_CLIN002", 2, "a b", " ", "31/02/2024", None, "", None, "/d/b", None), ("bad", "240512_CLIN002", 3, "a_b-1", *ok[1:]),
        ("fatal", "240512_CLIN002", 2, None, "9", "x", "o", "v", "/d/zz", None, None), ("fatal", "240512_CLIN002", 3, "a b", "", "x", "o", "v", "/d/a", None, None),
        ("run", "240512_XXXX002", 2, None, None, None, None, None, None, None, None),
    )
    files = rows("path string", ("/d/a",), ("/d/b",))
    issues, valid = validation.validate(sheet, "gva", files)
    got = sorted((r["sheet"], r["severity"], r["row_no"], r["column_name"], r["code"]) for r in issues.collect())
    assert got == sorted([
        ("warn", 1, 2, "collection_date", "BLANK"),
        ("bad", 2, 2, "id2", "BLANK"), ("bad", 2, 2, "organism", "BLANK"), ("bad", 2, 2, "relevance", "BLANK"),
        ("bad", 2, 2, "illumina_r1|nanopore", "NO_DATA_SOURCE"), ("bad", 2, 2, "id", "ID_CHARACTERS"), ("bad", 2, 2, "collection_date", "DATE_INVALID"),
        ("fatal", 2, 3, "id2", "BLANK"), ("fatal", 3, 2, "id", "ID_MISSING"), ("run", 3, 0, "run", "HOSPITAL_UNKNOWN"),
    ])
    status = {r["sheet"]: r["status"] for r in validation.validation_status(sheet, issues).collect()}
    assert status == {"good": 0, "warn": 1, "bad": 2, "fatal": 3, "run": 3}
    assert {(r["sheet"], r["id"], r["collection_date"]) for r in valid.collect()} == {
        ("good", "E1", "2024-07-01"), ("warn", "ñ1", None), ("bad", "a b", "31/02/2024"), ("bad", "a_b-1", "2024-07-01")
    }
    lines = validation.report_lines(issues).orderBy("sheet", "section", "check", "row_no", "line").collect()
    text = [r["line"] for r in lines if r["sheet"] == "fatal"]
    assert text == ["===== FATAL ERRORS =====", "Rows without a value in the identification column: [2]", "", "===== ERRORS =====", "Error in row 3: PETICION not specified", ""]


def test_missing_files_and_model(rows):
    sheet = rows("sheet string, row_no long, id string, illumina_r1 string, nanopore string", ("s", 2, "a", "/no", None), ("s", 3, "b", None, "/n"), ("t", 2, "c", "/a", None))
    issues, _ = validation.validate(sheet, "normal", rows("path string", ("/a",), ("/n",)), "nonsense")
    assert {(r["sheet"], r["code"], r["detail"]) for r in issues.collect()} == {("s", "FILE_MISSING", "/no"), ("s", "MODEL_INVALID", "nonsense")}
    assert validation.model_issues(sheet, validation.BASECALLING_MODELS[0]).count() == 0
    assert [r["code"] for r in validation.model_issues(sheet, None).collect()] == ["MODEL_MISSING"]


def test_sheets_are_judged_by_their_own_header(rows):
    schema = "sheet string, row_no long, header array<string>, id string, illumina_r1 string, organism string"
    sheet = rows(
        schema, ("good", 2, ["id", "illumina_r1", "organism"], "a", "r/x.fq", "Candida auris"), ("noid", 2, ["illumina_r1"], None, "/d/r/x.fq", None),
        ("nodata", 2, ["id", "organism"], "b", None, "o"), ("good", 3, ["id", "illumina_r1", "organism"], "c", "r/y.fq", "Bug x"),
    )
    issues, valid = validation.validate(sheet, "normal", rows("path string", ("file:/d/r/x.fq",)), base="/d", species=rows("name string", ("candida_auris",)))
    assert {(r["sheet"], r["row_no"], r["code"], r["detail"]) for r in issues.collect()} == {
        ("noid", 0, "COLUMNS_REQUIRED", "id"), ("nodata", 0, "COLUMNS_NO_DATA", "illumina_r1, illumina_r2, nanopore"),
        ("good", 3, "FILE_MISSING", "r/y.fq"), ("good", 3, "ORGANISM_UNKNOWN", "Bug x"),
    }
    assert {tuple(r) for r in valid.select("sheet", "id").collect()} == {("good", "a"), ("good", "c")}
    lacking = rows("sheet string, run string, row_no long, header array<string>, CODIGO_MUESTRA_ORIGEN string, PETICION string, NANOPORE string, MOTIVO_WGS string",
                   ("s", "240512_CLIN002", 2, ["CODIGO_MUESTRA_ORIGEN", "PETICION", "NANOPORE"], "a", "1", "/n", None))
    issues, _ = validation.validate(lacking, "gva", None, validation.BASECALLING_MODELS[0])
    assert [(r["code"], r["detail"]) for r in issues.collect()] == [("COLUMNS_IMPORTANT", "FECHA_TOMA_MUESTRA, ESPECIE_SECUENCIA, MOTIVO_WGS")]


def test_header_checks(rows):
    assert validation.column_problems(["PETICION"], "gva")[0][:2] == (3, "COLUMNS_REQUIRED")
    assert validation.column_problems(["PETICION", "CODIGO_MUESTRA_ORIGEN"], "gva")[0][:2] == (3, "COLUMNS_NO_DATA")
    assert validation.column_problems(["PETICION", "CODIGO_MUESTRA_ORIGEN", "NANOPORE"], "gva")[0][:2] == (2, "COLUMNS_IMPORTANT")
    assert validation.column_problems(["id", "nanopore"], "normal") == []
    issues, valid = validation.validate(rows("sheet string, row_no long, x string", ("s", 2, "a")), "normal")
    assert [(r["severity"], r["code"], r["detail"]) for r in issues.collect()] == [(3, "COLUMNS_REQUIRED", "id")] and valid.count() == 0
    assert validation.primary_id(["a", "ID2"]) == "ID2" and validation.primary_id(["id", "id2"], "id2") == "id2"
    with pytest.raises(ValueError):
        validation.primary_id(["a"])


def test_organisms(rows):
    sheet = rows("id string, organism string", ("1", "Enterococcus faecium"), ("2", "Nothing known"), ("3", None))
    species = rows("name string, genome_size long", ("enterococcus_faecium", 2900000))
    got = {r["id"]: (r["organism"], r["known"], r["genome_size"]) for r in validation.organism_lookup(sheet, species).collect()}
    assert got == {"1": ("enterococcus_faecium", True, 2900000), "2": ("nothing_known", False, None), "3": (None, False, None)}


# --- files, lab, staging --------------------------------------------------------------------------------------------


def test_pairs_and_template(rows):
    files = rows("path string, ext_rank int", ("/d/a_R1.fastq.gz", 0), ("/d/a_R1.fq", 3), ("/d/a_R2.fastq", 1), ("/d/b_R1.fq", 3), ("/d/c_1.fq", 3))
    pairs = pairing.paired_mates(files)
    assert {tuple(r) for r in pairs.collect()} == {("a", "/d/a_R1.fq", "/d/a_R2.fastq"), ("b", "/d/b_R1.fq", None)}
    assert [tuple(r) for r in pairing.incomplete_pairs(pairs).collect()] == [("b", "R2")]
    sheet = pairing.sheet_template(pairs.filter("r2 IS NOT NULL"), "gva").first()
    assert tuple(sheet) == ("a", "", "", "", "", "", "", "", "/d/a_R1.fq", "/d/a_R2.fastq", "")


def test_lab_report(rows):
    sheet = rows("id string, id2 string, illumina_r1 string, illumina_r2 string, nanopore string, outbreak_id string", ("a", "1", "/x/a_R1.fq", "/x/a_R2.fq", None, "B"), ("b", "2", None, None, None, None))
    report = rows(", ".join(f"{c} string" for c in summary.REPORT_COLUMNS), ("2", "sch", "7", "l(1)", "g", "v", "g", "r", "p"))
    assert lab.detect_join_key(sheet, report).first()[0] == "id2"
    assert lab.detect_join_key(sheet, report.withColumn("Sample", F.lit("zz"))).first()[0] is None
    got = {r["CODIGO_MUESTRA_ORIGEN"]: r for r in lab.lab_report_auto(sheet, report, F.lit("240512_CLIN002"), "/s").collect()}
    assert got["b"]["ID_WS"] == "sch" and got["b"]["R_Geno_WGS"] == "g" and got["b"]["OBS_MET_WGS"] is None
    assert got["a"]["FICHERO_LECTURAS_WGS"] == "/s/CVA_CLIN/illumina/240512_CLIN002/fastq/a_R1.fq" and got["a"]["ST_WGS"] is None
    assert not {"SCOPE_core", "MLST_WGS", "PHENO_WGS"} & set(got["a"].asDict())
    kept = lab.lab_report(sheet, report, "id2", F.lit("x"), "/s", keep_typing=True)
    assert {"MLST_WGS", "PHENO_WGS"} <= set(kept.columns)
    with pytest.raises(ValueError):
        lab.lab_report_auto(sheet, report.withColumn("Sample", F.lit("zz")), F.lit("r"), "/s")


def test_stage_plan(rows):
    sheet = rows("run string, method string, illumina_r1 string, illumina_r2 string, nanopore string",
                 ("240512_CLIN002", "ILLUMINA", "/d/a1", "/d/a2", None), ("240512_CLIN002", None, None, "/d/b2", None), ("240512_CLIN003", "NANOPORE", None, None, "/d/n"))
    files = rows("path string", ("/d/a1",), ("/d/b2",), ("/d/n",))
    got = {(r["kind"], r["source"], r["target"]) for r in staging.stage_plan(sheet, files, "/s", ("{run}.tsv",)).collect()}
    assert got == {
        ("reads", "/d/a1", "/s/CVA_CLIN/illumina/240512_CLIN002/fastq/a1"), ("reads", "/d/n", "/s/CVA_CLIN/nanopore/240512_CLIN003/fastq/n"),
        ("report", "240512_CLIN002.tsv", "/s/CVA_CLIN/illumina/240512_CLIN002/240512_CLIN002.tsv"),
        ("report", "240512_CLIN003.tsv", "/s/CVA_CLIN/nanopore/240512_CLIN003/240512_CLIN003.tsv"),
    }


# --- reads ----------------------------------------------------------------------------------------------------------


def make_reads(rng, n):
    out = []
    for i in range(n):
        for mate in (1, 2):
            size = rng.randrange(0, 120)
            out.append((f"s{i % 3}", f"p{i}", mate, "".join(rng.choice("ACGTN" if i % 5 == 0 else "ACGT") for _ in range(size)), "".join(chr(33 + max(2, 40 - j * (i % 4) // 8 - rng.randrange(9))) for j in range(size))))
    return out


READ_TYPE = "sample string, pair_id string, mate int, seq string, qual string"


def test_trimming_is_idempotent_and_pairs_survive_together(rows):
    data = rows(READ_TYPE, *make_reads(random.Random(3), 200))
    once = reads.cut_tail(data)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, reads.cut_tail(once).collect()))
    kept = Counter(r["pair_id"] for r in reads.filter_reads(data).collect())
    assert kept and set(kept.values()) == {2}
    totals = reads.filter_summary(data).agg(F.sum("reads_before"), F.sum("reads_after"), F.sum(F.col("passed") + F.col("low_quality") + F.col("too_many_n") + F.col("too_short"))).first()
    assert tuple(totals) == (400, sum(kept.values()), 400)


def test_results_do_not_depend_on_partitions(spark, rows):
    data = rows(READ_TYPE, *make_reads(random.Random(4), 100))
    want = None
    for parts, shuffle in ((1, "1"), (7, "3"), (16, "8")):
        spark.conf.set("spark.sql.shuffle.partitions", shuffle)
        got = sorted(map(tuple, reads.filter_summary(data.repartition(parts)).collect())), sorted(map(tuple, qc.duplication_levels(data.repartition(parts)).collect()))
        want = want or got
        assert got == want
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_read_count_and_gate(rows):
    lines = rows("sample string, mate int", *[("a", 1)] * 4006, *[("a", 2)] * 6)
    counts = reads.read_count(rows("sample string", ("a",), ("b",)), lines)
    assert {tuple(r) for r in counts.collect()} == {("a", 1003, 1001, 1), ("b", 0, 0, 0)}
    assert [r["sample"] for r in reads.min_reads_gate(counts).collect()] == ["a"] and reads.min_reads_gate(counts, 1001).count() == 0


def test_assembly_stats_against_definition(rows):
    rng = random.Random(9)
    lengths = {f"s{i}": [rng.choice((5, 8, 8, 13, 40, 100)) for _ in range(rng.randrange(1, 30))] for i in range(20)}
    data = rows("sample string, contig_id string, seq string", *[(s, str(i), "A" * n) for s, ns in lengths.items() for i, n in enumerate(ns)])
    for r in assembly.assembly_stats(data, 6).collect():
        used = sorted((n for n in lengths[r["sample"]] if n >= 6), reverse=True)
        for share, n_name, l_name in ((50, "n50", "l50"), (90, "n90", "l90")):
            run, want = 0, (None, None)
            for place, n in enumerate(used, 1):
                run += n
                if run * 100 >= sum(used) * share:
                    want = (n, place)
                    break
            assert (r[n_name], r[l_name]) == want, (r, used)
        assert r["contigs"] == len(used) and r["contigs_0"] == len(lengths[r["sample"]])


# --- typing and genes -----------------------------------------------------------------------------------------------


def allele_case():
    rng = random.Random(11)
    lib = [("s", f"l{i % 3}", str(i), dna(rng, rng.choice((8, 20, 31, 60, 200)))) for i in range(30)]
    contigs = []
    for c in range(25):
        parts = [dna(rng, rng.randrange(0, 5000))]
        for a in rng.sample(lib, 3):
            parts += [rng.choice((a[3], rc(a[3]))), dna(rng, rng.randrange(0, 40))]
        contigs.append((f"m{c % 4}", f"c{c}", "".join(parts)))
    return contigs, lib


def test_allele_search_finds_all_by_both_ways(rows):
    contigs, lib = allele_case()
    want = {(s, c, *a[:3]) for s, c, seq in contigs for a in lib if a[3] in seq or rc(a[3]) in seq}
    cs = rows("sample string, contig_id string, seq string", *contigs)
    al = rows("scheme string, locus string, allele string, seq string", *lib, *[(s, l, a, q.lower()) for s, l, a, q in lib])
    for limit in (64 << 20, 0):
        assert {tuple(r) for r in typing.allele_exact(cs, al, max_bytes=limit).collect()} == want
    assert typing.allele_exact(cs, al.limit(0)).count() == 0


def test_calls_do_not_change_on_the_other_strand(rows):
    rng = random.Random(2)
    lib = [("x", f"l{i % 3}", str(i), dna(rng, 150)) for i in range(9)] + [("y", "k", "1", dna(rng, 120))]
    profiles = rows("scheme string, st string, locus string, allele string", *[("x", "5", f"l{i}", str(i + 3)) for i in range(3)])
    novel = list(lib[8][3])
    novel[70] = FLIP_ONE[novel[70]]
    contigs = [
        ("full", "c1", dna(rng, 50) + lib[3][3] + dna(rng, 9) + lib[4][3]), ("full", "c2", rc(lib[5][3])),
        ("mixed", "c1", lib[0][3] + dna(rng, 30) + lib[3][3]), ("mixed", "c2", "".join(novel)), ("mixed", "c3", dna(rng, 40) + lib[1][3][:60]),
        ("none", "c1", dna(rng, 500)),
    ]
    al = rows("scheme string, locus string, allele string, seq string", *lib)
    want = {
        "full": ("x", "5", 100.0, "l0(3) l1(4) l2(5)"), "mixed": ("x", "-", 57.0, "l0(0,3) l1(1?) l2(~8)"), "none": ("-", "-", 0.0, ""),
    }
    for turn in (False, True):
        cs = rows("sample string, contig_id string, seq string", *[(s, c, rc(q) if turn else q) for s, c, q in contigs])
        got = {r["sample"]: (r["scheme"], r["st"], r["score"], " ".join(r["alleles"])) for r in typing.call_types(cs, al, profiles).collect()}
        assert got == want


FLIP_ONE = {"A": "T", "T": "A", "C": "G", "G": "C"}


def brute_screen(contigs, genes, coverage, identity, k, min_seeds):
    out = set()
    for s, c, seq in contigs:
        for g, gene in genes:
            for strand, q in (("+", gene), ("-", rc(gene))):
                for diag in range(-len(q) + 1, len(seq)):
                    b, e = max(0, -diag), min(len(q), len(seq) - diag)
                    same = [q[i] == seq[i + diag] for i in range(b, e)]
                    seeds = sum(all(same[i:i + k]) for i in range(len(same) - k + 1))
                    if seeds >= min_seeds and len(same) >= coverage * len(q) and sum(same) >= identity * len(same):
                        out.add((s, c, g, strand, b + diag + 1, e + diag, round(len(same) / len(q), 6), round(sum(same) / len(same), 6)))
    return out


@pytest.mark.parametrize("coverage, identity", [(0.6, 0.8), (0.1, 0.95)])
def test_gene_screen_equals_brute_force(rows, coverage, identity):
    rng = random.Random(21)
    genes = [(f"g{i}", dna(rng, rng.randrange(40, 90))) for i in range(4)]
    contigs = []
    for c in range(8):
        seq = dna(rng, rng.randrange(0, 60))
        for _, q in rng.sample(genes, 2):
            copy = "".join(FLIP_ONE[x] if rng.random() < 0.05 else x for x in q)
            seq += rng.choice((copy, rc(copy), copy[: len(copy) // 2])) + dna(rng, rng.randrange(0, 20)) + "A" * rng.randrange(0, 30)
        contigs.append(("s", f"c{c}", seq))
    got = screen.gene_screen(rows("sample string, contig_id string, seq string", *contigs), rows("gene string, seq string", *genes), coverage, identity, 7, 2)
    want = brute_screen(contigs, genes, coverage, identity, 7, 2)
    assert want and {tuple(r) for r in got.collect()} == want


def test_best_hits_and_first_records(rows):
    hits = rows("sample string, contig_id string, gene string, strand string, start long, end long, coverage double, identity double",
                ("s", "c", "a", "+", 1, 100, 1.0, 0.9), ("s", "c", "b", "+", 90, 200, 1.0, 0.95), ("s", "c", "d", "+", 201, 300, 0.7, 0.9), ("s", "k", "a", "-", 5, 50, 1.0, 1.0))
    assert {(r["contig_id"], r["gene"]) for r in screen.best_hit_per_locus(hits).collect()} == {("c", "b"), ("c", "d"), ("k", "a")}
    records = rows("name string, pos long, body string", ("x", 3, "c"), ("x", 1, "z"), ("y", 2, "b"))
    assert {tuple(r) for r in staging.first_per_key(records, ["name"], ["pos"]).collect()} == {("x", 1, "z"), ("y", 2, "b")}


# --- taxa -----------------------------------------------------------------------------------------------------------


def test_taxon_votes_equal_the_definition(rows):
    rng = random.Random(8)
    k, levels = 6, ["l1", "l2", "l3"]
    paths = [(1, 2, 3), (1, 2, 4), (1, 5, None), (9, 8, 7)]
    genomes = [(*p, dna(rng, 150) + ("ACGTTGCAACG" if p[0] == 1 else "")) for p in paths]
    data = [("s", f"r{i}", g[3][a:a + 40] + h[3][b:b + rng.randrange(0, 40)]) for i in range(60)
            for g, h, a, b in [(rng.choice(genomes), rng.choice(genomes), rng.randrange(100), rng.randrange(100))]]
    data += [("s", "rn", "NNNNNNNNNNNN"), ("s", "short", "ACG")]

    def mers(s):
        return [min(w, rc(w)) for w in (s[i:i + k] for i in range(len(s) - k + 1)) if "N" not in w]

    def common(ps):
        out = []
        for column in zip(*ps):
            if len(set(column)) > 1 or column[0] is None:
                break
            out.append(column[0])
        return tuple(out)

    held = defaultdict(list)
    for *p, seq in genomes:
        for w in mers(seq):
            held[w].append(tuple(p))
    table = {w: common(ps) for w, ps in held.items()}
    want = {}
    for _, read, seq in data:
        hits = Counter(table[w] for w in mers(seq) if w in table)
        weight = {t: sum(n for u, n in hits.items() if t[: len(u)] == u) for t in hits}
        best = max(weight.values(), default=0)
        want[read] = ("C", best, common([t + (None,) * (3 - len(t)) for t in weight if weight[t] == best])) if hits else ("U", 0, ())
    ref = rows("l1 long, l2 long, l3 long, seq string", *genomes)
    rd = rows("sample string, read_id string, seq string", *data)
    calls = taxonomy.classify(rd, taxonomy.build_kmer_table(ref, levels, k), levels, k)
    got = {r["read_id"]: (r["status"], r["support"], tuple(r[c] for c in levels if r[c] is not None)) for r in calls.collect()}
    assert got == want
    report = {r["taxon"]: (r["clade_reads"], r["direct_reads"]) for r in taxonomy.taxon_report(calls, levels).collect()}
    assert report["unclassified"] == (2, 2) and report["root"][0] == 60
    assert taxonomy.classified_reads(rd, calls).count() == 60


# --- streaming ------------------------------------------------------------------------------------------------------


def test_new_files_are_added_once(spark, rows, tmp_path):
    source, state = str(tmp_path / "in"), str(tmp_path / "state")
    first = rows("sample string, v int", ("a", 1), ("b", 2), ("a", 3))
    first.write.parquet(source)
    for _ in range(2):
        ingest_new_files(spark, source, first.schema, ["sample"], state)
        assert {tuple(r) for r in ingested_counts(spark, state, ["sample"]).collect()} == {("a", 2), ("b", 1)}
    rows("sample string, v int", ("a", 9), ("c", 1)).write.mode("append").parquet(source)
    ingest_new_files(spark, source, first.schema, ["sample"], state)
    assert {tuple(r) for r in ingested_counts(spark, state, ["sample"]).collect()} == {("a", 3), ("b", 1), ("c", 1)}


def test_best_hits_of_touching_genes(rows):
    hits = rows(
        "sample string, contig_id string, gene string, strand string, start long, end long, coverage double, identity double",
        ("s", "c", "A", "+", 1, 1000, 1.0, 0.9), ("s", "c", "B", "+", 998, 1900, 1.0, 0.95), ("s", "c", "C", "+", 1897, 2900, 1.0, 0.99),
        ("s", "c", "C2", "+", 1900, 2850, 1.0, 0.97),
    )
    assert {r["gene"] for r in screen.best_hit_per_locus(hits).collect()} == {"A", "C"}
    assert {r["gene"] for r in screen.best_hit_per_locus(hits, rivalry=0.1).collect()} == {"A", "B", "C"}
    assert screen.best_hit_per_locus(hits.limit(0)).count() == 0


def test_lab_report_of_a_sheet_with_types(rows):
    sheet = rows(
        "id string, illumina_r1 string, illumina_r2 string, nanopore string, ST_WGS string, amr string",
        ("a", "/x/a_R1.fq", None, None, "9", "old"), ("b", None, None, None, "8", None),
    )
    report = rows(", ".join(f"{c} string" for c in summary.REPORT_COLUMNS), ("a", "sch", "7", "l(1)", None, "v", "g", "r", "p"))
    got = {r["CODIGO_MUESTRA_ORIGEN"]: r for r in lab.lab_report(sheet, report, "id", F.lit("x"), "/s").collect()}
    assert (got["a"]["ST_WGS"], got["a"]["R_Geno_WGS"], got["b"]["ST_WGS"], got["b"]["R_Geno_WGS"]) == ("7", "old", "8", None)


def test_one_profile_gives_all_read_tables(spark, rows, monkeypatch):
    monkeypatch.setattr(qc, "LETTERS_AT_ONCE", 50)
    rng = random.Random(8)
    some = [("s%d" % rng.randrange(2), rng.randrange(1, 3), "".join(rng.choice("ACGTN") for _ in range(n))) for n in (0, 1, 2, 3, 8, 8, 30, 41, 100, 7)]
    reads = rows("sample string, mate int, seq string, qual string", *[(s, m, t, "".join(chr(33 + rng.randrange(42)) for _ in t)) for s, m, t in some], ("s0", 1, None, None))
    profile = qc.read_profile(reads)
    tables = qc.profile_tables(profile)
    one_by_one = {
        "per_base_quality": qc.per_base_quality(reads.withColumn("stage", F.lit("raw"))).drop("stage"), "base_content": qc.base_content(reads), "n_content": qc.n_content(reads),
        "gc_distribution": qc.gc_distribution(reads), "per_read_quality": qc.per_read_quality(reads), "length_distribution": qc.length_distribution(reads.where("seq is not null").unionByName(reads.where("seq is null").fillna("", ["seq"]))),
    }
    assert tables.keys() == one_by_one.keys()
    for name, want in one_by_one.items():
        assert sorted(map(tuple, tables[name].select(want.columns).collect())) == sorted(map(tuple, want.collect())), name
    twice = {tuple(r)[:-1]: r["n"] for r in qc.add_profiles(profile.unionByName(profile)).collect()}
    assert twice == {tuple(r)[:-1]: 2 * r["n"] for r in profile.collect()}


def test_first_places_in_files_are_narrowed_without_sorting(spark):
    """Split by split first; the file's name, then the split, then the row decide."""
    place = "struct<file:string,block:bigint,row:bigint>"
    data = [("s", "b", ("f2", 0, 1)), ("s", "b", ("f1", 9, 7)), ("s", "a", ("f1", 9, 8)), ("s", "c", ("f1", 0, 50)), ("s", None, ("f0", 0, 0)), (None, "z", ("f0", 0, 0))]
    genes = spark.createDataFrame(data, f"sample string, gene string, line_no {place}")
    got = summary.resistance_genes(genes)
    assert {tuple(r) for r in got.collect()} == {("s", "c b a"), (None, "z")}
    plan = got._jdf.queryExecution().sparkPlan().toString()
    assert "HashAggregate" in [line for line in plan.splitlines() if "Aggregate" in line][-1]  # the rows themselves; sorting comes with one row per split


def test_product_of_samples_and_drugs_is_not_shuffled(spark):
    """Null samples, genes and drugs match nothing; each sample has each drug once."""
    catalogue = spark.createDataFrame([("g1", "c", "d"), ("g2", "c", "d"), ("g2", "c", "e"), ("g2", None, "f"), (None, "c", "h")], "gene string, class string, antimicrobial string")
    hits = spark.createDataFrame([("s", "g1"), ("s", "g2"), ("s", "g2"), ("t", "x"), (None, "g1"), ("u", None)], "sample string, gene string")
    got = screen.gene_phenotype(hits, catalogue, spark.createDataFrame([("s",), ("v",)], "sample string"))
    drugs = [("c", "d"), ("c", "e"), (None, "f"), ("c", "h")]
    found = {("s", "c", "d"): 2, ("s", "c", "e"): 1}
    want = [(s, *d, "Resistant" if (s, *d) in found else "No resistance", found.get((s, *d), 0)) for s in ("s", "t", None, "u", "v") for d in drugs]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    plan = got._jdf.queryExecution().toString().split("== Physical Plan ==")[1].splitlines()
    unfolded = next(i for i, line in enumerate(plan) if "Generate inline" in line)
    assert not any("Exchange hashpartitioning" in line or "SortMergeJoin" in line for line in plan[:unfolded])
