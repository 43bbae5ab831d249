"""Allele search, locus states and sequence types."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isoloom.functions.dna import kmer_rows, piece, revcomp
from isoloom.operators.scan import MAX_SEED, collected, scan_exact, scan_families
from isoloom.operators.screen import MIN_SEEDS, SEED, gene_screen, shares
from isoloom.session import BROADCAST_MAX_BYTES, by_sorting, bytes_within

SEED_WIDTHS = (31, 12, 1)
# Points per locus state, bonus for a known profile, limits of near matches.
EXACT_POINTS, NOVEL_POINTS, PARTIAL_POINTS, TYPE_BONUS = 90.0, 63.0, 18.0, 10.0
NOVEL_IDENTITY, PARTIAL_COVERAGE = 0.95, 0.10


def allele_exact(
    contigs: DataFrame,
    alleles: DataFrame,
    widths: tuple[int, ...] = SEED_WIDTHS,
    max_bytes: int = BROADCAST_MAX_BYTES,
) -> DataFrame:
    """``sample, contig_id, scheme, locus, allele`` where the allele or its reverse complement lies in the contig.

    The first bases of each allele are looked up among all contig positions and the whole allele is then compared.
    Alleles too short for the usual seed use a shorter one, so none is left out. A library of proven size is sent to the
    tasks and the contigs are not shuffled; a larger one is joined by hash, and only candidates see the sequence.
    """
    probes = alleles.select("scheme", "locus", "allele", F.upper("seq").alias("seq")).distinct()
    probes = probes.select(
        "scheme", "locus", "allele", F.explode(F.array_distinct(F.array("seq", revcomp(F.col("seq"))))).alias("probe")
    ).filter(F.length("probe") > 0)
    width = reduce(lambda chain, w: chain.when(F.length("probe") >= w, F.lit(w)), widths, F)
    probes = probes.withColumn("width", width)
    used = {r["width"]: r["longest"] for r in probes.groupBy("width").agg(F.max(F.length("probe")).alias("longest")).collect()}
    if max(used, default=0) <= MAX_SEED and bytes_within(probes, ["scheme", "locus", "allele", "probe"], max_bytes):
        return scan_exact(contigs, probes, ("scheme", "locus", "allele"), sorted(used)).distinct()
    found = [_find_by_shuffle(contigs, probes.filter(F.col("width") == w), w, used[w]) for w in sorted(used)]
    if not found:
        found = [_find_by_shuffle(contigs, probes, widths[0], widths[0])]
    return reduce(DataFrame.unionByName, found).distinct()


def _seeds(probes: DataFrame, width: int) -> DataFrame:
    binary = probes.select("scheme", "locus", "allele", F.col("probe").cast("binary").alias("probe"), F.length("probe").alias("size"))
    return binary.withColumn("seed", F.xxhash64(piece(F.col("probe"), 1, width)))


def _find_by_shuffle(contigs: DataFrame, probes: DataFrame, width: int, longest: int) -> DataFrame:
    """Only hashes and positions meet the seeds; the sequence is joined back for the candidates."""
    key = ["sample", "contig_id"]
    places = kmer_rows(contigs, "seq", width, key).select(*key, "pos", F.xxhash64("kmer").alias("seed"))
    candidates = places.join(by_sorting(_seeds(probes, width)), "seed").drop("seed")
    binary = contigs.select(*key, F.col("seq").cast("binary").alias("bin"))
    hits = candidates.join(binary, key)
    return hits.filter(piece(F.col("bin"), F.col("pos"), F.col("size")) == F.col("probe")).select(*key, "scheme", "locus", "allele")


def near_alleles(contigs: DataFrame, alleles: DataFrame, k: int = SEED) -> DataFrame:
    """``sample, scheme, locus, allele, coverage, identity`` of alleles that lie in contigs with few mismatches.

    The alleles of a locus are a family: places are found by seeds of the whole locus, alleles compared there alone."""
    parts = ("scheme", "locus", "allele")
    library = alleles.select(F.concat_ws("\t", "scheme", "locus").alias("family"), F.concat_ws("\t", *parts).alias("gene"), *parts, F.upper("seq").alias("seq"))
    library = library.distinct()
    strands = library.select("family", *parts, F.inline(F.array(F.struct(F.lit("+").alias("strand"), "seq"), F.struct(F.lit("-").alias("strand"), revcomp(F.col("seq")).alias("seq")))))
    sent = collected(strands, parts, k)
    if sent:
        return scan_families(contigs, *sent, PARTIAL_COVERAGE, NOVEL_IDENTITY, MIN_SEEDS).select("sample", *parts, *shares())
    hits = gene_screen(
        contigs, library.select("gene", "seq"),
        coverage=PARTIAL_COVERAGE, identity=NOVEL_IDENTITY, k=k,
    )
    names = F.split("gene", "\t")
    return hits.select("sample", *[names[i].alias(p) for i, p in enumerate(parts)], "coverage", "identity")


def locus_status(exact: DataFrame, near: DataFrame, alleles: DataFrame) -> DataFrame:
    """``sample, scheme, locus, status, state`` for every locus of each scheme seen in the sample.

    Status is ``n`` for an exact allele (``n,m`` for several), ``~n`` for a full-length near match, ``n?`` for a
    partial one and ``-`` for none. Hits shrink to one row per allele before they meet by locus.
    """
    number = F.struct(F.col("allele").try_cast("long").alias("n"), F.col("allele").alias("allele"))
    key = ["sample", "scheme", "locus"]
    best = F.struct(F.col("identity").alias("identity"), F.col("coverage").alias("coverage"))
    per_allele = exact.select(*key, "allele", F.lit(2).alias("kind"), F.lit(1.0).alias("identity"), F.lit(1.0).alias("coverage"))
    near_rows = near.select(
        *key, "allele", F.when(F.col("coverage") >= 1.0, 1).otherwise(0).alias("kind"), "identity", "coverage"
    )
    merged = per_allele.unionByName(near_rows).groupBy(*key, "allele").agg(
        F.max(F.struct("kind", best.alias("score"))).alias("best")
    )
    # lowest rank first: best kind, then identity, coverage, and the smaller allele
    ranked = merged.select(*key, number.alias("number"), "best.kind", F.struct(
        (-F.col("best.score.identity")).alias("i"), (-F.col("best.score.coverage")).alias("c"), number.alias("number")
    ).alias("rank"))
    pick = lambda kind: F.min(F.when(F.col("kind") == kind, F.col("rank")))["number"]["allele"]
    found = ranked.groupBy(*key).agg(
        F.array_sort(F.collect_list(F.when(F.col("kind") == 2, F.col("number")))).alias("exact"),
        pick(1).alias("novel"), pick(0).alias("partial"),
    )
    names = F.array_join(F.transform("exact", lambda a: a["allele"]), ",")
    status = (
        F.when(F.size("exact") > 0, names)
        .when(F.col("novel").isNotNull(), F.concat(F.lit("~"), "novel"))
        .otherwise(F.concat("partial", F.lit("?")))
    )
    state = (
        F.when(F.size("exact") == 1, "exact").when(F.size("exact") > 1, "several")
        .when(F.col("novel").isNotNull(), "novel").otherwise("partial")
    )
    cell = F.struct(F.col("locus"), F.struct(status.alias("status"), state.alias("state")))
    seen = found.groupBy("sample", "scheme").agg(F.map_from_entries(F.collect_list(cell)).alias("cells"))
    loci = alleles.groupBy("scheme").agg(F.array_sort(F.collect_set("locus")).alias("loci"))
    each = seen.join(loci, "scheme").select("sample", "scheme", "cells", F.explode("loci").alias("locus"))
    here = F.try_element_at("cells", F.col("locus"))
    return each.select(
        *key, F.coalesce(here["status"], F.lit("-")).alias("status"), F.coalesce(here["state"], F.lit("none")).alias("state")
    )


def _profile_key(locus: str, allele: str) -> Column:
    """One text per profile; the list is as long as the scheme has loci."""
    return F.array_join(F.array_sort(F.collect_list(F.concat(locus, F.lit("="), allele))), ";")


def scheme_calls(status: DataFrame, profiles: DataFrame) -> DataFrame:
    """``sample, scheme, st, score, alleles``: one pass over the loci of each scheme, then the profile looked up.

    The type is the one whose profile equals the alleles; ``-`` if a locus is unclear or none matches.
    """
    points = (
        F.when(F.col("state").isin("exact", "several"), EXACT_POINTS).when(F.col("state") == "novel", NOVEL_POINTS)
        .when(F.col("state") == "partial", PARTIAL_POINTS).otherwise(0.0)
    )
    keyed = status.groupBy("sample", "scheme").agg(
        F.bool_and(F.col("state") == "exact").alias("clear"),
        _profile_key("locus", "status").alias("key"),
        (F.sum(points) / F.count("*")).alias("points"),
        F.array_sort(F.collect_list(F.concat("locus", F.lit("("), "status", F.lit(")")))).alias("alleles"),
    )
    known = profiles.groupBy("scheme", "st").agg(_profile_key("locus", "allele").alias("profile"))
    known = known.groupBy("scheme", "profile").agg(F.min("st").alias("known_st"))
    # Most calls are unclear: they have no profile to look up and stay out of the join.
    clear = keyed.where("clear").join(known.withColumnRenamed("profile", "key"), ["scheme", "key"], "left")
    typed = clear.unionByName(keyed.where("clear is null or not clear"), allowMissingColumns=True)
    bonus = F.when(F.col("known_st").isNotNull(), TYPE_BONUS).otherwise(0.0)
    return typed.select(
        "sample", "scheme", F.coalesce("known_st", F.lit("-")).alias("st"), F.round(F.col("points") + bonus, 6).alias("score"), "alleles"
    )


def profile_lookup(status: DataFrame, profiles: DataFrame) -> DataFrame:
    return scheme_calls(status, profiles).select("sample", "scheme", "st")


def best_scheme(calls: DataFrame) -> DataFrame:
    """One row per sample: the scheme with the most points; equal points go to the first scheme name."""
    order = Window.partitionBy("sample").orderBy(F.desc("score"), "scheme")
    first = calls.withColumn("nth", F.row_number().over(order)).filter("nth = 1")
    return first.select("sample", "scheme", "st", "score", "alleles")


def call_types(contigs: DataFrame, alleles: DataFrame, profiles: DataFrame, k: int = SEED) -> DataFrame:
    """The typing call of every sample that has contigs; samples without any hit get ``-``."""
    status = locus_status(allele_exact(contigs, alleles), near_alleles(contigs, alleles, k), alleles)
    best = best_scheme(scheme_calls(status, profiles))
    none = F.lit("-")
    return contigs.select("sample").distinct().join(best, "sample", "left").select(
        "sample", F.coalesce("scheme", none).alias("scheme"), F.coalesce("st", none).alias("st"),
        F.coalesce("score", F.lit(0.0)).alias("score"), F.coalesce("alleles", F.array().cast("array<string>")).alias("alleles"),
    )
