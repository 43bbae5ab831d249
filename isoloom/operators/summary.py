"""From result rows to one line per sample."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RESISTANT = "Resistant"  # fixed value

# Columns of the combined report, in order.
REPORT_COLUMNS = (
    "Sample", "Scheme_mlst", "ST", "MLST", "AMR", "VIRULENCE", "SCOPE_core", "GENE_resfinder", "PHENO_resfinder",
)


def _seen(first: str, text: str) -> Column:
    return F.when(F.col(first).isNotNull(), F.struct(F.col(first).alias("at"), F.col(text).alias("text")))


def _in_order(seen: Column, glue: str) -> Column:
    """Texts joined by the place where each was first seen. The list holds distinct texts only."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(seen)), lambda s: s["text"]), glue)


def _first_places(rows: DataFrame, keys: list[Column], **conditions: Column) -> DataFrame:
    """Per ``keys`` the first ``line_no`` at which each condition holds.

    A place in a file is narrowed to one row number per split first, where rows are read and without sorting them: Spark
    sorts the rows of an aggregate of structs, each with the name of its file."""
    first = lambda value: [F.min(F.when(c, value)).alias(n) for n, c in conditions.items()]
    fields = getattr(rows.schema["line_no"].dataType, "names", None)
    if fields != ["file", "block", "row"]:
        return rows.groupBy(*keys).agg(*first(F.col("line_no")))
    near = rows.groupBy(*keys, F.col("line_no")["file"].alias("file"), F.col("line_no")["block"].alias("block")).agg(*first(F.col("line_no")["row"]))
    names = [c for c in near.columns if c not in ("file", "block", *conditions)]
    place = lambda n: F.min(F.when(F.col(n).isNotNull(), F.struct("file", "block", F.col(n).alias("row")))).alias(n)
    return near.groupBy(*names).agg(*map(place, conditions))


def amr_summary(hits: DataFrame) -> DataFrame:
    """Per sample the distinct symbols of resistance, virulence and core scope, in first-seen order.

    Rows shrink to one per (sample, symbol) before they meet by sample, so a sample with very many rows only ever
    brings its distinct symbols to one place.
    """
    symbols = _first_places(
        hits, [F.col("sample"), F.coalesce("symbol", F.lit("nan")).alias("symbol")],
        amr=F.col("type") == "AMR", virulence=F.col("type") == "VIRULENCE", core=F.col("scope") == "core",
    )
    return symbols.groupBy(F.col("sample").alias("Sample")).agg(
        _in_order(_seen("amr", "symbol"), " ").alias("AMR"),
        _in_order(_seen("virulence", "symbol"), " ").alias("VIRULENCE"),
        _in_order(_seen("core", "symbol"), " ").alias("SCOPE_core"),
    )


def resistance_genes(genes: DataFrame) -> DataFrame:
    """Per sample the distinct genes in first-seen order; null genes are left out."""
    first = _first_places(genes, [F.col("sample"), F.col("gene")], at=F.col("gene").isNotNull())
    return first.groupBy(F.col("sample").alias("Sample")).agg(_in_order(_seen("at", "gene"), " ").alias("GENE_resfinder"))


def phenotype_summary(pheno: DataFrame) -> DataFrame:
    """Per sample ``drug1-drug2[class]`` of the drugs predicted resistant, classes ascending, null class left out.

    Of all other rows only their sample goes on, which keeps its place in the result."""
    hit = (F.col("predicted") == RESISTANT) & F.col("class").isNotNull()
    of_hit = [F.when(hit, F.col(c)).alias(c) for c in ("class", "antimicrobial")]
    drugs = pheno.groupBy("sample", *of_hit).agg(F.min(F.when(hit, F.col("line_no"))).alias("at"))
    classes = drugs.groupBy("sample", "class").agg(
        F.count("at").alias("n"), _in_order(_seen("at", "antimicrobial"), "-").alias("drugs")
    )
    label = F.when(F.col("n") > 0, F.struct("class", F.concat("drugs", F.lit("["), "class", F.lit("]")).alias("text")))
    return classes.groupBy(F.col("sample").alias("Sample")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(label)), lambda s: s["text"]), " ").alias("PHENO_resfinder")
    )


def resistance_summary(genes: DataFrame, pheno: DataFrame, samples: DataFrame | None = None) -> DataFrame:
    """Genes and phenotypes side by side; a sample that lacks one of them gets an empty text for it."""
    both = resistance_genes(genes).join(phenotype_summary(pheno), "Sample", "full")
    if samples is not None:
        both = both.join(samples.select(F.col("sample").alias("Sample")).distinct(), "Sample", "full")
    return both.select(
        "Sample", *[F.coalesce(c, F.lit("")).alias(c) for c in ("GENE_resfinder", "PHENO_resfinder")]
    )


def mlst_summary(calls: DataFrame) -> DataFrame:
    """Every call as one row, alleles joined by spaces."""
    return calls.select(
        F.col("sample").alias("Sample"),
        F.col("scheme").alias("Scheme_mlst"),
        F.col("st").alias("ST"),
        F.concat_ws(" ", "alleles").alias("MLST"),
    )


def combine_results(mlst: DataFrame, amr: DataFrame, resistance: DataFrame) -> DataFrame:
    """Keep every sample of the three tables.

    The two per-sample tables meet first, one row a side. Calls are many per sample and may pile up on one, so they
    are the left side of a left join, which can be split when skewed; samples without a call are added after.
    """
    sides = amr.join(resistance, "Sample", "full")
    typed = mlst.join(sides, "Sample", "left")
    untyped = sides.join(mlst.select("Sample").distinct(), "Sample", "left_anti")
    return typed.unionByName(untyped, allowMissingColumns=True).select(*REPORT_COLUMNS)


def report_sort(report: DataFrame) -> DataFrame:
    """By sample, then by sequence type as text; missing values last."""
    return report.orderBy(F.asc_nulls_last("Sample"), F.asc_nulls_last("ST"))


def combined_report(
    calls: DataFrame, hits: DataFrame, genes: DataFrame, pheno: DataFrame, samples: DataFrame | None = None
) -> DataFrame:
    """``samples`` (column ``sample``) names those that get a row even when no result table has one for them."""
    return report_sort(combine_results(mlst_summary(calls), amr_summary(hits), resistance_summary(genes, pheno, samples)))


def concat_files(frames: list[DataFrame]) -> DataFrame:
    """Stack tables by column name; a column missing from one of them is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
