"""The usual ways through the operators, from files to files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isoloom.functions.text import basename
from isoloom.operators import lab, pairing, reads, screen, summary, typing, validation
from isoloom.session import broadcast_if_small, by_sorting
from isoloom.sinks import files as sinks
from isoloom.sources import results
from isoloom.sources.sheet import scan_numbered_sheet


def sheet_from_folder(spark: SparkSession, folder: str, mode: str, platform: str) -> tuple[DataFrame, DataFrame]:
    """A sample sheet for the read files in a folder, and the samples left out because a mate is missing."""
    files = results.scan_read_files(spark, folder)
    if platform == "nanopore":
        samples = pairing.long_read_files(files)
        return pairing.sheet_template(samples, mode), pairing.incomplete_pairs(samples.select("sample", F.lit("").alias("r1"), F.lit("").alias("r2")))
    pairs = pairing.paired_mates(files)
    return pairing.sheet_template(pairs.dropna(subset=["r1", "r2"]), mode), pairing.incomplete_pairs(pairs)


def validate_files(
    spark: SparkSession,
    path: str,
    mode: str = "normal",
    run: str | None = None,
    read_folders: list[str] | None = None,
    model: str | None = None,
    base: str = "",
    species: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Issues and validated rows of the sheets under ``path``, each judged by its own header. Without ``run`` a sheet's
    file name is its run. Relative paths of read files are below ``base``."""
    sheet = scan_numbered_sheet(spark, path, headers=True)
    name = F.element_at(F.split(basename(F.col("sheet")), r"\."), 1)
    if mode == "gva":
        sheet = sheet.withColumn("run", F.lit(run) if run else name)
    inventory = None
    if read_folders:
        inventory = summary.concat_files([results.scan_read_files(spark, f).select("path") for f in read_folders])
    return validation.validate(sheet, mode, inventory, model, base, species)


def report_from_results(spark: SparkSession, folder: str) -> DataFrame:
    """The combined report of all result files in a folder; kinds of result that are absent stay empty. A sample whose
    result files are empty, or hold a header alone, has its row too."""
    return summary.combined_report(
        results.scan_mlst_calls(spark, folder),
        results.scan_amr_hits(spark, folder),
        results.scan_resistance_genes(spark, f"{folder}/resfinder"),
        results.scan_pheno(spark, f"{folder}/resfinder"),
        results.scan_samples(spark, folder),
    )


def report_from_contigs(
    contigs: DataFrame, counts: DataFrame, alleles: DataFrame, profiles: DataFrame, genes: DataFrame, catalogue: DataFrame,
    k: int = typing.SEED, min_reads: int = reads.MIN_READS,
) -> DataFrame:
    """The combined report straight from contigs: sequence types, genes found and the drugs they speak against.

    ``counts`` has ``sample, reads_r1``: contigs of a counted sample with too few reads are not looked at, but the sample
    keeps its row. ``catalogue`` tells for each gene its symbol, type and scope, and the class and antimicrobial that it
    stands for (null where there is none); a gene may have several. Of genes that overlap, the best is reported. The
    order of symbols is that of the places in the contigs.
    """
    few = counts.select("sample").exceptAll(reads.min_reads_gate(counts, min_reads).select("sample"))
    used = contigs.join(broadcast_if_small(few, ["sample"]), "sample", "left_anti")  # contigs of few samples aren't shuffled
    samples = contigs.select("sample").unionByName(counts.select("sample")).distinct()
    calls = typing.call_types(used, alleles, profiles, k).where("scheme <> '-'")
    found = screen.best_hit_per_locus(screen.gene_screen(used, genes, k=k))
    labels = catalogue.select("gene", "symbol", "type", "scope").distinct()
    place = F.struct("contig_id", "start", "gene", "strand").alias("line_no")
    hits = found.select("sample", "gene", place).join(by_sorting(labels), "gene").select("sample", "type", "scope", "symbol", "line_no")
    resistant = hits.where(F.col("type") == "AMR").select("sample", F.col("symbol").alias("gene"), "line_no")
    drugs = catalogue.where("type = 'AMR' and antimicrobial is not null").select("gene", "class", "antimicrobial").distinct()
    pheno = screen.gene_phenotype(found.select("sample", "gene"), drugs, samples)
    pheno = pheno.withColumn("line_no", F.col("antimicrobial"))
    return summary.combined_report(calls, hits, resistant, pheno, samples)


def write_reports(spark: SparkSession, sheet: DataFrame, results_folder: str, out: str, run: str, store: str | None = None) -> None:
    """Combined report as tab text and, with a store, the laboratory report."""
    report = report_from_results(spark, results_folder)
    sinks.write_report_tsv(report, f"{out}/{run}_combined")
    if store:
        sinks.write_lab_csv(lab.lab_report_auto(sheet, report, F.lit(run), store), f"{out}/{run}_lab")
