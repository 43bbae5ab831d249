"""Genes in contigs, without gaps: shared k-mers on one diagonal, then base-by-base identity.

A hit with insertions or deletions falls apart into several diagonals and may be missed or under-called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isoloom.functions.dna import kmer_rows, piece, revcomp
from isoloom.operators.scan import collected, scan_families
from isoloom.session import broadcast_if_small, by_sorting, bytes_within, with_computed

# Thresholds of the acquired-gene screen.
COVERAGE, IDENTITY = 0.6, 0.8
SEED, MIN_SEEDS = 15, 2
PANEL_PARTS = 16
HIT_COLUMNS = ("sample", "contig_id", "gene", "strand", "start", "end", "coverage", "identity")


def both_strands(genes: DataFrame) -> DataFrame:
    strand = lambda s, seq: F.struct(F.lit(s).alias("strand"), seq.alias("seq"))
    both = F.array(strand("+", F.col("seq")), strand("-", revcomp(F.col("seq"))))
    return genes.select("gene", F.explode(both).alias("g")).select("gene", "g.strand", "g.seq")


def equal_bases(a: Column, b: Column) -> Column:
    same = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: (x == y) & (x != ""))
    return F.size(F.filter(same, lambda s: s))


def gene_screen(
    contigs: DataFrame,
    genes: DataFrame,
    coverage: float = COVERAGE,
    identity: float = IDENTITY,
    k: int = SEED,
    min_seeds: int = MIN_SEEDS,
) -> DataFrame:
    """Every (gene, contig, strand, diagonal) with enough shared k-mers, coverage and identity. Genes with fewer than
    ``k + min_seeds - 1`` letters share too few k-mers to be found.

    A library of proven size is sent to the tasks (``scan``). For a larger one only positions travel through a seed join;
    they are added up per diagonal before the shuffle. No frequent seed is dropped. What the counts already rule out
    goes before any sequence is looked at: too short an overlap, or fewer shared k-mers than the allowed mismatches
    could destroy (each mismatch breaks at most k of them).
    """
    strands = both_strands(genes)
    sent = collected(strands.withColumn("family", F.col("gene")), ["gene"], k)
    if sent:
        return _scored(scan_families(contigs, *sent, coverage, identity, min_seeds))
    library = strands.withColumn("size", F.length("seq"))
    seeds = kmer_rows(library, "seq", k, ["gene", "strand", "size"]).withColumnRenamed("pos", "gene_pos")
    seeds = broadcast_if_small(seeds, ["gene", "kmer"])
    key = ["sample", "contig_id"]
    sized = contigs.withColumn("contig_len", F.length("seq"))
    shared = kmer_rows(sized, "seq", k, [*key, "contig_len"]).join(seeds, "kmer")
    diagonals = shared.groupBy(
        *key, "contig_len", "gene", "strand", "size", (F.col("pos") - F.col("gene_pos")).alias("diag")
    ).agg(F.count("*").alias("seeds"))
    placed = diagonals.withColumn("begin", F.greatest(F.lit(1), 1 - F.col("diag"))).withColumn(
        "overlap", F.least(F.col("size"), F.col("contig_len") - F.col("diag")) - F.col("begin") + 1
    )
    spared = F.col("overlap") - (k - 1) - F.floor(F.col("overlap") * (1 - identity) + 1e-9) * k
    candidates = placed.filter(
        (F.col("seeds") >= min_seeds) & (F.col("overlap") >= F.col("size") * coverage) & (F.col("seeds") >= spared)
    )
    gene_seqs = broadcast_if_small(strands.withColumnRenamed("seq", "gene_seq"), ["gene", "gene_seq"])
    contig_seqs = contigs.select(*key, F.col("seq").cast("binary").alias("bin"))
    pairs = candidates.join(gene_seqs, ["gene", "strand"]).join(contig_seqs, key)
    same = equal_bases(
        F.col("gene_seq").substr(F.col("begin"), F.col("overlap")),
        piece(F.col("bin"), F.col("begin") + F.col("diag"), F.col("overlap")).cast("string"),
    )
    scored = with_computed(pairs, same=same).filter(F.col("same") >= F.col("overlap") * identity)
    first = F.col("begin") + F.col("diag")
    return _scored(scored.withColumns({"start": first.cast("long"), "end": (first + F.col("overlap") - 1).cast("long")}))


def shares() -> list[Column]:
    """Coverage and identity of a hit."""
    shared = {"coverage": F.col("overlap") / F.col("size"), "identity": F.col("same") / F.col("overlap")}
    return [F.round(value, 6).alias(name) for name, value in shared.items()]


def _scored(hits: DataFrame) -> DataFrame:
    return hits.select("sample", "contig_id", "gene", "strand", "start", "end", *shares())


def best_hit_per_locus(hits: DataFrame, rivalry: float = 0.0) -> DataFrame:
    """The best hit of each place: identity first, then coverage, gene name and position.

    Hits of one contig that overlap, directly or through others, form an island. Inside it hits are taken greedily by
    rank; a hit falls when it shares more than ``rivalry`` of the shorter one's length with a better hit that was
    taken, so genes that merely touch all stay. An island holds the hits of one stretch of a contig.
    """
    contig = Window.partitionBy("sample", "contig_id")
    order = contig.orderBy("start", "end", "gene", "strand")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = hits.withColumn("opens", F.when(reach.isNull() | (F.col("start") > reach), 1).otherwise(0))
    places = opened.withColumn("place", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    fields = ("identity", "coverage", "gene", "start", "strand", "end")
    ranked = F.struct(*[(-F.col(c)).alias(c) if c in ("identity", "coverage") else F.col(c) for c in fields])
    islands = places.groupBy("sample", "contig_id", "place").agg(F.array_sort(F.collect_list(ranked)).alias("ranked"))

    def rivals(a: Column, b: Column) -> Column:
        shared = F.least(a["end"], b["end"]) - F.greatest(a["start"], b["start"]) + 1
        shorter = F.least(a["end"] - a["start"], b["end"] - b["start"]) + 1
        return (shared > 0) & (shared > shorter * rivalry)

    def take(taken: Column, hit: Column) -> Column:
        return F.when(F.exists(taken, lambda other: rivals(other, hit)), taken).otherwise(F.concat(taken, F.array(hit)))

    # No taken hit at the start: an empty list of the same type.
    kept = F.aggregate("ranked", F.slice("ranked", 1, 0), take)
    best = islands.select("sample", "contig_id", F.inline(kept))
    return best.withColumns({"identity": -F.col("identity"), "coverage": -F.col("coverage")}).select(*HIT_COLUMNS)


def gene_phenotype(hits: DataFrame, catalogue: DataFrame, samples: DataFrame | None = None) -> DataFrame:
    """Per sample and drug of the catalogue (``gene, class, antimicrobial``) Resistant or No resistance.

    ``samples`` names all samples screened, those without a hit too; by default those with a hit are reported. Every
    sample gets a row per drug; the drugs are measured before they are broadcast, and otherwise joined in parts.
    """
    panel = catalogue.select("class", "antimicrobial").distinct()
    named = (hits if samples is None else samples.select("sample").unionByName(hits.select("sample"))).select("sample").distinct()
    if bytes_within(catalogue, ["gene", "class", "antimicrobial"]):
        return _predicted(_by_number(named, hits, catalogue.select("gene", "class", "antimicrobial").distinct()))
    found = hits.select("sample", "gene").distinct().join(by_sorting(catalogue), "gene").groupBy("sample", "class", "antimicrobial").agg(
        F.count_distinct("gene").alias("genes")
    )
    part = F.sequence(F.lit(0), F.lit(PANEL_PARTS - 1))
    parts = panel.select("class", "antimicrobial", F.explode(part).alias("part"))
    named = named.withColumn("part", F.pmod(F.xxhash64("sample"), F.lit(PANEL_PARTS)).cast("int"))
    rows = named.join(by_sorting(parts), "part").drop("part")
    return _predicted(rows.join(found, ["sample", "class", "antimicrobial"], "left"))


def _by_number(named: DataFrame, hits: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Each sample with each drug of a catalogue of measured size, and how many genes were found for it.

    A sample's distinct genes come together as numbers, a list no longer than the catalogue; drugs are looked up and counted
    in that list, the other drugs are unfolded beside them and the names come last. So neither the drugs of the hits nor
    the product of samples and drugs is ever shuffled, sorted or held."""
    number = lambda *by: (F.row_number().over(Window.orderBy(*by)) - 1)
    panel = catalogue.select("class", "antimicrobial").distinct().withColumn("drug", number("class", "antimicrobial"))
    count = panel.count()
    known = catalogue.where("gene is not null").join(F.broadcast(panel.where("class is not null and antimicrobial is not null")), ["class", "antimicrobial"])
    genes = known.groupBy("gene").agg(F.array_sort(F.collect_list("drug")).alias("drugs")).withColumn("number", number("gene"))
    lists = genes.agg(F.array_sort(F.collect_list(F.struct("number", "drugs"))).alias("all")).select(F.col("all")["drugs"].alias("drugs_of"))
    met = hits.join(F.broadcast(genes.select("gene", "number")), "gene").select("sample", "number").distinct()
    met = met.groupBy("sample").agg(F.collect_list("number").alias("numbers"))
    each = named.join(by_sorting(met), "sample", "left").crossJoin(F.broadcast(lists))
    drugs = F.flatten(F.transform(F.coalesce("numbers", F.array().cast("array<int>")), lambda n: F.get(F.col("drugs_of"), n)))
    each = with_computed(each.select("sample", F.array_sort(drugs).alias("own")), size=F.size("own"))
    here, before = lambda i: F.get(F.col("own"), i), lambda i: F.get(F.col("own"), i - 1)
    places = F.when(F.col("size") > 0, F.sequence(F.lit(0), F.col("size") - 1)).otherwise(F.array().cast("array<int>"))
    each = with_computed(each, starts=F.filter(places, lambda i: (i == 0) | (here(i) != before(i))))
    entry = "array<struct<drug:int,genes:bigint>>"
    after = lambda i: F.coalesce(F.get(F.col("starts"), i + 1), F.col("size"))
    have = F.transform("starts", lambda s, i: F.struct(here(s).alias("drug"), (after(i) - s).cast("long").alias("genes")))
    all_drugs = F.sequence(F.lit(0), F.lit(count - 1)) if count else F.array().cast("array<int>")
    none = F.transform(F.array_except(all_drugs, "own"), lambda d: F.struct(d.alias("drug"), F.lit(None).cast("long").alias("genes")))
    rows = each.select("sample", F.inline(F.concat(have.cast(entry), none.cast(entry))))
    return rows.join(F.broadcast(panel), "drug")


def _predicted(rows: DataFrame) -> DataFrame:
    return rows.select(
        "sample", "class", "antimicrobial",
        F.when(F.col("genes") > 0, "Resistant").otherwise("No resistance").alias("predicted"),
        F.coalesce("genes", F.lit(0)).cast("long").alias("genes"),
    )
