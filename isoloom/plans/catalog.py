"""Every operator as a query over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isoloom.functions import dates, names, text
from isoloom.operators import assembly, lab, pairing, qc, reads, screen, staging, summary, taxonomy, typing, validation
from isoloom.plans import files, views, workflow
from isoloom.session import kept, scratch_path
from isoloom.sinks import files as sinks
from isoloom.sources import results, sequences
from isoloom.sources.sheet import scan_numbered_sheet, scan_sheet
from isoloom.streaming.ingest import ingest_new_files, ingested_counts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Outputs that are there in ``resume_plan``: gaps at early and late stages, half of a pair among them.
GAPS = (
    "not (row_no % 97 = 5 and stage = 'trimmed' and read = '2') and not (row_no % 89 = 7 and stage = 'assembly') "
    "and not (row_no % 83 = 11 and stage = 'annotation') and not (row_no % 79 = 13 and stage in ('mlst', 'fastqc_raw'))"
)

KEYS = {"scan_sheet_text": "scan_sheet"}
MIN_READS = 400
SCREEN_K = 11
MODEL = "dna_r10.4.1_e8.2_400bps_sup@v9.9.9"
REPORTS = ("{run}_combined.tsv", "{run}_lab.csv")
TEXT_TOKENS = ("NA", "none", "None", "n/a", " NA", "Nan", "nan", "", "#N/A N/A", "0", "<NA>", "-nan", "null", "Null")
OVERVIEW = (
    "reads_before", "bases_before", "q30_rate_before", "reads_after", "bases_after", "q30_rate_after",
    "contigs", "total_length", "n50", "gc_percent", "pct_left_r1", "pct_left_r2",
)


def query(fn: Query) -> Query:
    QUERIES[KEYS.get(fn.__name__, fn.__name__)] = fn
    return fn


def _s(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("string")


def _name_of(path: Column, marker: str = ".") -> Column:
    return F.element_at(F.split(text.basename(path), f"[{marker}]"), 1)


# --- sources --------------------------------------------------------------------------------------------------------


@query
def scan_sheet_text(spark, d):
    return scan_sheet(spark, files.sheet_files(spark, d))


@query
def sheet_row_number(spark, d):
    rows = scan_numbered_sheet(spark, files.sheet_files(spark, d))
    return rows.select(_name_of(F.col("sheet")).alias("run"), "row_no", F.col("CODIGO_MUESTRA_ORIGEN").alias("id"), F.col("COMENTARIO_WGS").alias("comment"))


@query
def null_tokens(spark, d):
    k = F.col("o_orderkey")
    token = F.get(F.array(*[F.lit(t) for t in TEXT_TOKENS]), (k % len(TEXT_TOKENS)).cast("int"))
    orders = views.table(spark, d, "orders")
    return text.null_tokens(orders.select(k, token.alias("cell"), F.when(k % 2 == 0, token).otherwise(F.col("o_orderpriority")).alias("other")))


@query
def scan_fastq_inventory(spark, d):
    found = results.scan_read_files(spark, files.text_files(spark, d))
    return found.select(text.basename(F.col("path")).alias("name"), F.col("ext_rank").cast("long").alias("ext_rank"))


@query
def scan_fastq(spark, d):
    scanned = sequences.scan_fastq(spark, files.fastq_files(spark, d))
    return scanned.select(_name_of(F.col("file")).alias("sample"), "read_id", "seq", "qual")


@query
def scan_fastq_plain(spark, d):
    scanned = sequences.scan_fastq(spark, files.fastq_files(spark, d, packed="false"))
    return scanned.select(_name_of(F.col("file")).alias("sample"), "read_id", "seq", "qual")


@query
def scan_fasta(spark, d):
    scanned = sequences.scan_fasta(spark, files.fasta_files(spark, d))
    return scanned.select(
        _name_of(F.col("file")).alias("sample"), "id", "description", F.length("seq").cast("long").alias("bases"), F.md5(F.col("seq").cast("binary")).alias("digest")
    )


@query
def scan_alleles(spark, d):
    return sequences.scan_alleles(spark, files.allele_files(spark, d), recursiveFileLookup="true")


@query
def scan_profiles(spark, d):
    wide = views.wide_profiles(spark, d)
    loci = {"s1": views.FIRST_SCHEME_LOCI, "s2": None}
    names = [c for c in wide.columns if c.startswith("loc")]
    parts = []
    for scheme, n in loci.items():
        own = names[:n] if n else names[views.FIRST_SCHEME_LOCI :]
        parts.append(results.scan_profiles(spark, files.profile_file(spark, d, scheme, own), scheme))
    return summary.concat_files(parts)


def _with_hits(lists, rows):
    """First-seen lists, which rest on the order of rows in the files, and the number of rows read."""
    return lists.join(rows.groupBy(F.col("sample").alias("Sample")).agg(F.count("*").alias("hits")), "Sample")


@query
def scan_amr_hits(spark, d):
    hits = results.scan_amr_hits(spark, files.amr_files(spark, d))
    return _with_hits(summary.amr_summary(hits), hits)


@query
def scan_mlst_calls(spark, d):
    calls = results.scan_mlst_calls(spark, files.mlst_files(spark, d))
    return calls.select("sample", "scheme", "st", F.concat_ws(",", "alleles").alias("alleles"))


@query
def scan_resistance_genes(spark, d):
    rows = results.scan_resistance_genes(spark, files.gene_files(spark, d))
    return _with_hits(summary.resistance_genes(rows), rows)


@query
def scan_pheno(spark, d):
    rows = results.scan_pheno(spark, files.pheno_files(spark, d))
    return _with_hits(summary.phenotype_summary(rows), rows)


@query
def scan_counts(spark, d):
    return results.scan_counts(spark, files.count_files(spark, d))


@query
def scan_gff(spark, d):
    lines = results.scan_gff(spark, files.gff_files(spark, d))
    return lines.select(text.basename(F.col("file")).alias("file"), "line_no", "value")


@query
def gff_rewrite(spark, d):
    kept = results.before_fasta(views.gff_lines(spark, d))
    return kept.select("file", text.gff_retag(F.col("value")).alias("value"))


# --- sinks ----------------------------------------------------------------------------------------------------------


@query
def write_validated(spark, d):
    _, valid = validation.validate(views.sheet_raw(spark, d), "gva")
    path = scratch_path(spark, "validated")
    sinks.write_validated(valid, path)
    back = scan_sheet(spark, path, ";")
    return back.select("id", "id2", "collection_date", "organism", "relevance", "outbreak_id", "illumina_r1", "illumina_r2", "nanopore")


def _all_issues(spark, d):
    return validation.validate(views.sheet_raw(spark, d), "gva", views.stored_files(spark, d), MODEL)[0]


@query
def validation_issues(spark, d):
    return _all_issues(spark, d)


@query
def validation_mixed_sheets(spark, d):
    sheet = kept(scan_numbered_sheet(spark, files.mixed_sheet_files(spark, d), headers=True), "sheet-rows")
    sheet = sheet.withColumn("run", _name_of(text.basename(F.col("sheet"))))
    species = spark.createDataFrame([(s,) for s in validation_species()], "name string")
    issues, _ = validation.validate(sheet, "gva", views.stored_files(spark, d), MODEL, base="/d", species=species)
    return issues.withColumn("sheet", F.regexp_replace(text.basename(F.col("sheet")), "[.]csv$", ""))


def validation_species() -> list[str]:
    """The organisms of the sheets but the first, in table form."""
    return [s.lower().replace(" ", "_") for s in views.SPECIES[1:]]


@query
def validation_report(spark, d):
    return validation.report_lines(_all_issues(spark, d))


@query
def validation_status(spark, d):
    return validation.validation_status(views.sheet_raw(spark, d), _all_issues(spark, d))


@query
def write_report_tsv(spark, d):
    path = scratch_path(spark, "report")
    sinks.write_report_tsv(_report(spark, d), path)
    return text.null_tokens(spark.read.csv(path, sep="\t", header=True, escape='"'))


@query
def write_lab_csv(spark, d):
    path = scratch_path(spark, "lab")
    sinks.write_lab_csv(_lab(spark, d), path)
    return scan_sheet(spark, path, ";").select(*LAB_COLUMNS)


@query
def sheet_template(spark, d):
    pairs = pairing.paired_mates(views.read_files(spark, d)).filter("r1 IS NOT NULL AND r2 IS NOT NULL")
    return pairing.sheet_template(pairs, "gva")


@query
def sheet_template_long_reads(spark, d):
    return pairing.sheet_template(pairing.long_read_files(views.read_files(spark, d)), "normal")


@query
def checksum_manifest(spark, d):
    listed = results.scan_files(spark, files.manifest_files(spark, d), "checksum.md5")
    return sinks.manifest_lines(listed)


def _metrics(spark, d):
    raw = views.reads(spark, d)
    left = qc.deduplicated_share(qc.duplication_levels(raw))
    by_mate = lambda m: F.max(F.when(F.col("mate") == m, F.col("pct_left"))).alias(f"pct_left_r{m}")
    left = left.groupBy("sample").agg(by_mate(1), by_mate(2))
    parts = [
        qc.long_metrics(reads.filter_summary(raw), "filter", [n for n in OVERVIEW if n.endswith(("_before", "_after"))]),
        qc.long_metrics(assembly.assembly_stats(views.contigs(spark, d), 0), "assembly", ["contigs", "total_length", "n50", "gc_percent"]),
        qc.long_metrics(left, "duplication", ["pct_left_r1", "pct_left_r2"]),
    ]
    return summary.concat_files(parts)


@query
def qc_metrics_sink(spark, d):
    path = scratch_path(spark, "metrics")
    sinks.write_qc_metrics(_metrics(spark, d), path)
    return spark.read.parquet(path).select("sample", _s("stage").alias("stage"), "metric", "value")


@query
def qc_overview(spark, d):
    return qc.qc_overview(_metrics(spark, d), list(OVERVIEW))


# --- sheet checks ---------------------------------------------------------------------------------------------------


@query
def run_name_check(spark, d):
    sheets = views.sheet_raw(spark, d).groupBy("run").agg(F.count("*").alias("samples"))
    return sheets.select("run", "samples", names.hospital_code(F.col("run")).alias("hospital"), F.coalesce(names.run_name_issue(F.col("run")), F.lit("OK")).alias("verdict"))


@query
def rename_internal(spark, d):
    return validation.rename_internal(views.sheet_raw(spark, d)).drop("sheet", "run")


@query
def blank_field_issues(spark, d):
    return validation.blank_field_issues(views.sheet(spark, d))


@query
def missing_ids(spark, d):
    return validation.missing_ids(views.sheet(spark, d)).select("sheet", "row_no", "code")


@query
def id_charset(spark, d):
    customers = views.table(spark, d, "customer")
    k = F.col("c_custkey")
    ident = F.get(F.array(*[F.concat(F.lit(p), k.cast("string")) for p in ("ñ", "a b", "a.b", "a_b-", "Ü#", "x/")]), (k % 6).cast("int"))
    sheet = customers.select(F.col("c_mktsegment").alias("sheet"), k.alias("row_no"), ident.alias("id"))
    return validation.id_charset_issues(sheet).select("row_no", "code", "detail")


@query
def missing_files(spark, d):
    return validation.missing_files(views.sheet(spark, d), views.stored_files(spark, d))


@query
def normalise_date(spark, d):
    rows = views.sheet(spark, d).select("row_no", F.col("collection_date").alias("written"))
    return rows.select(
        "row_no", "written", _s(dates.parse_date(F.col("written"))).alias("parsed"), dates.iso_or_original(F.col("written")).alias("kept")
    )


@query
def date_issues(spark, d):
    return validation.date_issues(views.sheet(spark, d)).select("sheet", "row_no", "code", "detail")


@query
def model_check(spark, d):
    return validation.model_issues(views.sheet(spark, d), MODEL).select("sheet", "severity", "code", "detail")


@query
def sanitize_id(spark, d):
    written = F.concat_ws(" .", "c_name", "c_mktsegment", F.concat(F.lit("x,y-"), _s("c_custkey")))
    return views.table(spark, d, "customer").select("c_custkey", text.sanitize_id(written).alias("clean"))


@query
def organism_lookup(spark, d):
    species = views.table(spark, d, "part").groupBy("p_name").agg(F.max("p_size").cast("long").alias("genome_size"))
    listed = species.filter(~F.col("p_name").startswith("cold")).select(text.organism_key(F.col("p_name")).alias("name"), "genome_size")
    sheet = views.table(spark, d, "part").select("p_partkey", F.initcap("p_name").alias("organism"))
    out = validation.organism_lookup(sheet, listed)
    return out.select("p_partkey", "organism", "known", F.coalesce("genome_size", F.lit(-1)).alias("genome_size"))


# --- file names -----------------------------------------------------------------------------------------------------


@query
def illumina_sample_id(spark, d):
    return views.read_files(spark, d).select("path", names.illumina_sample_id(F.col("path")).alias("sample"))


@query
def nanopore_sample_id(spark, d):
    return views.read_files(spark, d).select("path", names.nanopore_sample_id(F.col("path")).alias("sample"))


@query
def mate_role(spark, d):
    return views.read_files(spark, d).select("path", F.coalesce(names.mate_role(F.col("path")), F.lit("none")).alias("mate"))


@query
def basename(spark, d):
    s = views.sheet(spark, d).select("row_no", F.coalesce("illumina_r1", "nanopore", "illumina_r2").alias("path"))
    return s.select("row_no", text.basename(F.col("path")).alias("file"))


@query
def paired_mates(spark, d):
    return pairing.paired_mates(views.read_files(spark, d))


@query
def incomplete_pairs(spark, d):
    return pairing.incomplete_pairs(pairing.paired_mates(views.read_files(spark, d)))


@query
def last_wins(spark, d):
    return pairing.long_read_files(views.read_files(spark, d))


@query
def seq_method(spark, d):
    recorded = F.when(F.col("row_no") % 10 == 0, "NANOPORE")
    first, long_reads = F.col("illumina_r1"), F.col("nanopore")
    return views.sheet(spark, d).select(
        "row_no", names.sequencing_method((first,), long_reads).alias("reported"), staging.staging_method().alias("staged"), staging.staging_method(recorded).alias("kept")
    )


@query
def hospital_code(spark, d):
    run = F.when(F.col("row_no") % 7 == 0, F.replace(F.col("run"), F.lit("_"), F.lit("-"))).otherwise(F.col("run"))
    return views.sheet(spark, d).select("row_no", run.alias("run"), names.hospital_code(run).alias("hospital"))


@query
def deposit_path(spark, d):
    s = views.sheet(spark, d)
    run = F.when(F.col("row_no") % 7 == 0, "norun").otherwise(F.col("run"))
    method = names.sequencing_method((F.col("illumina_r1"),), F.col("nanopore"))
    return s.select("row_no", names.deposit_path(views.STORE, run, method, F.col("illumina_r1"), F.col("nanopore")).alias("path"))


@query
def wrap_phenotypes(spark, d):
    item = F.concat_ws(" ", F.concat("p_name", F.lit("["), "p_type", F.lit(" x]")), F.concat(F.lit("a["), "p_brand", F.lit(" y z]")), F.col("p_name"))
    odd = F.when(F.col("p_partkey") % 5 == 0, F.concat(item, F.lit(" ] b [ c"))).otherwise(item)
    return views.table(spark, d, "part").select("p_partkey", text.wrap_outside_brackets(odd).alias("wrapped"))


@query
def latest_version(spark, d):
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd")
    name = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("v"), stamp, F.lit(".9"))).when(F.col("o_orderkey") % 3 == 1, stamp).otherwise(
        F.concat(stamp, F.lit("."), _s(F.col("o_orderkey") % 4))
    )
    orders = views.table(spark, d, "orders")
    return staging.latest_version(orders.select(name.alias("name")))


# --- lab report and staging -----------------------------------------------------------------------------------------

# Columns of the laboratory report.
LAB_COLUMNS = (
    "CODIGO_MUESTRA_ORIGEN", "PETICION", "FECHA_TOMA_MUESTRA", "ESPECIE_SECUENCIA", "MOTIVO_WGS", "NUM_BROTE", "CONFIRMACION",
    "COMENTARIO_WGS", "ILLUMINA_R1", "ILLUMINA_R2", "NANOPORE", "CARRERA", "ID_WS", "ST_WGS", "R_Geno_WGS", "V_WGS", "MO_EST_WGS", "TIPO_ANALISIS_WGS", "PLASMIDOS_WGS", "OBS_MET_WGS", "FICHERO_LECTURAS_WGS",
)


def _lab_results(spark, d):
    """Combined report with one row per order: its own hits as sample ``M<order>``."""
    hits = views.table(spark, d, "lineitem").join(views.table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    hits = hits.select(
        F.concat(F.lit("M"), _s("l_orderkey")).alias("sample"), F.when(F.col("l_returnflag") == "A", "AMR").otherwise("VIRULENCE").alias("type"),
        F.lit("core").alias("scope"), F.col("p_brand").alias("symbol"),
        F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("line_no"),
    )
    amr = summary.amr_summary(hits)
    order = F.expr("cast(substring(Sample, 2) as long)")
    typed = {
        "Scheme_mlst": F.concat(F.lit("scheme"), (order % 3).cast("string")), "ST": F.when(order % 4 != 0, (order % 50).cast("string")),
        **{c: F.lit(None).cast("string") for c in ("MLST", "GENE_resfinder", "PHENO_resfinder")},
    }
    return amr.withColumns(typed).select(*summary.REPORT_COLUMNS)


def _lab_sheet(spark, d):
    """A sheet that holds types already: some of the same samples, some of others, some none."""
    sheet = validation.normalise_dates(views.sheet(spark, d))
    prefilled = {"st": F.when(F.col("row_no") % 3 != 0, F.lit("old")), "R_Geno_WGS": F.lit("old genes")}
    return sheet.withColumns(prefilled).drop("sheet", "row_no")


def _lab(spark, d):
    return lab.lab_report(_lab_sheet(spark, d), _lab_results(spark, d), "id", F.col("run"), views.STORE)


@query
def lab_projection(spark, d):
    return _lab(spark, d).select(*LAB_COLUMNS)


@query
def lab_join(spark, d):
    joined = lab.lab_join(_lab_sheet(spark, d), _lab_results(spark, d), "id")
    return joined.select("id", "id2", "run", "nanopore", "illumina_r2", "AMR", "VIRULENCE", "SCOPE_core")


@query
def detect_join_key(spark, d):
    s = views.sheet(spark, d)
    cases = {
        "first": s.filter("id IS NOT NULL").select(F.col("id").alias("Sample")),
        "second": s.filter("trim(id2) <> ''").select(F.col("id2").alias("Sample")),
        "neither": s.select(F.coalesce("id", "id2").alias("Sample")),
    }
    return summary.concat_files([lab.detect_join_key(s, r).select(F.lit(n).alias("reported"), F.coalesce("join_key", F.lit("none")).alias("join_key")) for n, r in cases.items()])


@query
def paired_only(spark, d):
    return lab.paired_only(views.sheet(spark, d)).select("row_no", "id", "illumina_r2")


def _typed_samples(spark, d):
    return lab.paired_only(views.sheet(spark, d)).filter("id IS NOT NULL").select("row_no", F.col("id").alias("sample"))


@query
def expected_outputs(spark, d):
    return staging.expected_outputs(_typed_samples(spark, d), ("prokka",))


@query
def missing_outputs(spark, d):
    samples = _typed_samples(spark, d)
    done = staging.expected_outputs(samples.filter("row_no % 3 <> 0"))
    partly = staging.expected_outputs(samples.filter("row_no % 3 = 0")).filter(F.col("stage").isin("fastqc_raw", "counts"))
    return staging.missing_outputs(staging.expected_outputs(samples), summary.concat_files([done, partly]))


@query
def resume_plan(spark, d):
    sheet = lab.paired_only(views.sheet(spark, d)).where("trim(id2) <> '' and id is not null")
    samples = staging.sample_ids(sheet.drop("id"), "id").select("run", F.concat("sample", F.lit("_"), _s("row_no")).alias("sample"), "row_no")
    made = staging.expected_outputs(samples.select("run", "sample"), (), {**staging.SAMPLE_STAGES, **staging.WORK_STAGES})
    made = made.join(samples.drop("run"), "sample").where(GAPS)
    paths = made.select(F.concat("run", F.lit("/"), "path").alias("path"))
    of_runs = staging.run_outputs(samples, "gva").where("right(run, 1) <> '3' or stage <> 'summary'").select("path")
    return staging.resume_plan(samples, paths.unionByName(of_runs), "gva", ("kraken2",))


def _methods(spark, d):
    return views.sheet(spark, d).withColumn("method", names.sequencing_method((F.col("illumina_r1"),), F.col("nanopore")))


@query
def run_platforms(spark, d):
    return staging.run_platforms(_methods(spark, d))


@query
def stage_plan(spark, d):
    return staging.stage_plan(_methods(spark, d), views.stored_files(spark, d), views.STORE, REPORTS)


# --- combined report ------------------------------------------------------------------------------------------------


def _report(spark, d):
    return summary.combined_report(
        views.mlst_calls(spark, d), views.amr_hits(spark, d), views.resistance_gene_rows(spark, d), views.pheno(spark, d)
    )


@query
def amr_summary(spark, d):
    return summary.amr_summary(views.amr_hits(spark, d))


@query
def resfinder_genes(spark, d):
    return summary.resistance_genes(views.resistance_gene_rows(spark, d))


@query
def phenotype_summary(spark, d):
    return summary.phenotype_summary(views.pheno(spark, d))


@query
def mlst_summary(spark, d):
    return summary.mlst_summary(views.mlst_calls(spark, d))


@query
def combine_results(spark, d):
    return summary.combine_results(
        summary.mlst_summary(views.mlst_calls(spark, d)), summary.amr_summary(views.amr_hits(spark, d)),
        summary.resistance_summary(views.resistance_gene_rows(spark, d), views.pheno(spark, d)),
    )


@query
def report_sort(spark, d):
    return _report(spark, d)


@query
def concat_files(spark, d):
    hits = views.amr_hits(spark, d)
    part = lambda t, *cols: hits.filter(F.col("type") == t).select("sample", "symbol", *cols)
    return summary.concat_files([part("AMR", "scope"), part("VIRULENCE"), part("STRESS", "type")]).groupBy("sample", "symbol", "scope", "type").agg(F.count("*").alias("hits"))


# --- reads ----------------------------------------------------------------------------------------------------------


@query
def cut_tail(spark, d):
    return reads.cut_tail(views.reads(spark, d))


@query
def length_filter(spark, d):
    return reads.length_filter(reads.cut_tail(views.reads(spark, d)))


@query
def quality_filter(spark, d):
    return reads.quality_filter(views.reads(spark, d))


@query
def filter_summary(spark, d):
    return reads.filter_summary(views.reads(spark, d))


def _read_lines(spark, d):
    """Lines of the read files by sample and mate, counted per file: its name is taken apart once, not for each line."""
    lines = spark.read.text(files.fastq_files(spark, d)).groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count("*").alias("n"))
    mate = F.regexp_extract("file", r"_r(\d)\.", 1).cast("int")
    return lines.select(_name_of(F.col("file")).alias("sample"), mate.alias("mate"), "n")


def _read_samples(spark, d):
    docs = views.table(spark, d, "documents").select(F.col("source").alias("sample"))
    return docs.unionByName(views.table(spark, d, "part").select(F.col("p_type").alias("sample"))).distinct()


@query
def read_count(spark, d):
    return reads.read_count(_read_samples(spark, d), _read_lines(spark, d))


@query
def min_reads_gate(spark, d):
    counts = views.reads(spark, d).groupBy("sample").agg(F.count_if(F.col("mate") == 1).alias("reads_r1"), F.count("*").alias("reads"))
    return reads.min_reads_gate(counts, MIN_READS)


@query
def read_profile(spark, d):
    return qc.read_profile(views.reads(spark, d))


@query
def per_base_quality(spark, d):
    return qc.per_base_quality(qc.staged(views.reads(spark, d)))


@query
def per_read_quality(spark, d):
    return qc.per_read_quality(views.reads(spark, d))


@query
def base_content(spark, d):
    return qc.base_content(views.reads(spark, d))


@query
def n_content(spark, d):
    return qc.n_content(views.reads(spark, d))


@query
def gc_distribution(spark, d):
    return qc.gc_distribution(views.reads(spark, d))


@query
def length_distribution(spark, d):
    return qc.length_distribution(views.reads(spark, d))


@query
def duplication_levels(spark, d):
    return qc.duplication_levels(views.reads(spark, d))


@query
def deduplicated_share(spark, d):
    return qc.deduplicated_share(qc.duplication_levels(views.reads(spark, d)))


@query
def overrepresented(spark, d):
    return qc.overrepresented(views.reads(spark, d))


@query
def assembly_stats(spark, d):
    return assembly.assembly_stats(views.contigs(spark, d), 0)


@query
def assembly_stats_min500(spark, d):
    return assembly.assembly_stats(views.contigs(spark, d))


@query
def first_per_key(spark, d):
    docs = views.table(spark, d, "documents").select("text", "doc_id", "source")
    return staging.first_per_key(docs, ["text"], ["doc_id"]).select(F.md5(F.col("text").cast("binary")).alias("digest"), "doc_id", "source")


# --- typing and genes -----------------------------------------------------------------------------------------------


@query
def allele_exact(spark, d):
    return typing.allele_exact(views.typing_contigs(spark, d), views.alleles(spark, d))


def _status(spark, d):
    c, a = views.typing_contigs(spark, d), views.alleles(spark, d)
    return typing.locus_status(typing.allele_exact(c, a), typing.near_alleles(c, a, SCREEN_K), a)


@query
def locus_status(spark, d):
    return _status(spark, d)


@query
def profile_lookup(spark, d):
    return typing.profile_lookup(_status(spark, d), views.profiles(spark, d))


@query
def best_scheme(spark, d):
    calls = typing.call_types(views.typing_contigs(spark, d), views.alleles(spark, d), views.profiles(spark, d), SCREEN_K)
    return calls.withColumn("alleles", F.concat_ws(" ", "alleles"))


def _screen(spark, d):
    return screen.gene_screen(views.screen_contigs(spark, d), views.genes(spark, d), k=SCREEN_K)


@query
def gene_screen(spark, d):
    return _screen(spark, d)


@query
def best_hit_per_locus(spark, d):
    return screen.best_hit_per_locus(_screen(spark, d))


@query
def gene_phenotype(spark, d):
    gene = F.concat_ws("_", "p_brand", "p_type", _s("p_size"))
    part = views.table(spark, d, "part")
    catalogue = part.select(gene.alias("gene"), F.col("p_type").alias("class"), F.element_at(F.split("p_name", " "), 2).alias("antimicrobial")).distinct()
    hits = views.table(spark, d, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.concat(F.lit("O"), F.expr("l_orderkey div 4").cast("string")).alias("sample"), gene.alias("gene")
    )
    orders = views.table(spark, d, "orders").select(F.concat(F.lit("O"), F.expr("o_orderkey div 4").cast("string")).alias("sample"))
    extra = orders.select(F.concat("sample", F.lit("x")).alias("sample"))  # samples without any hit
    return screen.gene_phenotype(hits, catalogue, summary.concat_files([orders, extra.where("sample like 'O1%'")]))


def _catalogue(genes: DataFrame) -> DataFrame:
    """Symbol, type, scope and drug of each gene, by the number in its name."""
    n = F.expr("cast(substring(gene, 5) as long)")
    return genes.select(
        "gene", F.concat(F.lit("sym"), _s(n % 9)).alias("symbol"), F.when(n % 3 == 0, "VIRULENCE").otherwise("AMR").alias("type"),
        F.when(n % 2 == 0, "core").otherwise("plus").alias("scope"), F.concat(F.lit("class"), _s(n % 4)).alias("class"),
        F.when(n % 5 != 0, F.concat(F.lit("drug"), _s(n % 7))).alias("antimicrobial"),
    )


@query
def run_report(spark, d):
    counts = views.reads(spark, d).groupBy("sample").agg(F.count_if(F.col("mate") == 1).alias("reads_r1"))
    return workflow.report_from_contigs(
        views.typing_contigs(spark, d), counts, views.alleles(spark, d), views.profiles(spark, d), views.genes(spark, d),
        _catalogue(views.genes(spark, d)), SCREEN_K, MIN_READS,
    )


# --- taxa -----------------------------------------------------------------------------------------------------------


def _taxon_table(spark, d):
    return taxonomy.build_kmer_table(views.reference_genomes(spark, d), views.LEVELS, views.TAXON_K)


def _calls(spark, d):
    return taxonomy.classify(views.taxon_reads(spark, d), _taxon_table(spark, d), views.LEVELS, views.TAXON_K)


def _taxon_name() -> Column:
    return F.concat_ws("|", F.lit("root"), *[_s(c) for c in views.LEVELS]).alias("taxon")


@query
def kmer_taxon(spark, d):
    hits = taxonomy.kmer_hits(views.taxon_reads(spark, d), _taxon_table(spark, d), views.LEVELS, views.TAXON_K)
    return hits.select("sample", "read_id", _taxon_name(), "n")


@query
def read_vote(spark, d):
    return _calls(spark, d).select("sample", "read_id", "status", "length", "support", _taxon_name())


@query
def classified_reads(spark, d):
    kept = taxonomy.classified_reads(views.taxon_reads(spark, d), _calls(spark, d))
    return kept.select("sample", "read_id", "mate", F.length("seq").cast("long").alias("length"))


@query
def taxon_report(spark, d):
    return taxonomy.taxon_report(_calls(spark, d), views.LEVELS)


# --- streaming ------------------------------------------------------------------------------------------------------


@query
def incremental_ingest(spark, d):
    state = scratch_path(spark, "ingest")
    schema = views.table(spark, d, "events").schema
    for _ in range(2):  # the second run finds no new file and adds nothing
        ingest_new_files(spark, d, schema, ["event_type", "user_id"], state, pathGlobFilter="events.parquet")
    return ingested_counts(spark, state, ["event_type", "user_id"])
