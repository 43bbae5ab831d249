"""What should exist, what is missing, and where files are to be deposited."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isoloom.functions.names import deposit_folder, sequencing_method
from isoloom.functions.text import basename, is_given, plain_path
from isoloom.operators.validation import primary_id
from isoloom.session import by_sorting

# Outputs per sample, with {sample} and {read} filled in.
SAMPLE_STAGES = {
    "fastqc_raw": "qc/fastqc_raw/{sample}_r{read}_fastqc.zip",
    "fastqc_trim": "qc/fastqc_trim/{sample}_r{read}_fastqc.zip",
    "kraken2": "qc/kraken2/{sample}.txt",
    "quast": "qc/quast/{sample}",
    "annotation": "annotation/{sample}",
    "counts": "qc/count_reads/{sample}_counts.txt",
    "amrfinder": "amr_mlst/{sample}_amrfinder.tsv",
    "mlst": "amr_mlst/{sample}_mlst.tsv",
    "resfinder": "amr_mlst/resfinder/{sample}/ResFinder_results.txt",
}
# Work files per sample that later stages are made from, and outputs per run; the last two in hospital mode.
WORK_STAGES = {"trimmed": "trimmed/{sample}_r{read}.fastq.gz", "assembly": "assembly/{sample}/{sample}.fasta"}
RUN_STAGES = {
    "multiqc": "qc/multiqc.html", "summary": "report/{run}_combined.tsv",
    "lab": "report/{run}_lab.csv", "deposit": "report/{run}_copies.txt",
}
HOSPITAL_STAGES = ("lab", "deposit")
# What each stage is made from.
MADE_FROM = {
    "fastqc_trim": ("trimmed",), "kraken2": ("trimmed",), "counts": ("trimmed",), "assembly": ("trimmed",),
    "quast": ("assembly",), "annotation": ("assembly",), "amrfinder": ("assembly", "annotation"), "mlst": ("assembly",),
    "resfinder": ("assembly",), "multiqc": ("fastqc_raw", "fastqc_trim", "kraken2", "quast"),
    "summary": ("amrfinder", "mlst", "resfinder"), "lab": ("summary",), "deposit": ("summary", "lab"),
}
READS = ("1", "2")
STAGE_OF_SKIP = {"prokka": "annotation"}  # fixed value: switch name and the stage it turns off


def stage_list(skip: tuple[str, ...] = (), patterns: dict[str, str] = SAMPLE_STAGES) -> list[tuple[str, str, str]]:
    """(stage, read, pattern) of every output a sample should have; read is empty where it does not apply."""
    off = {STAGE_OF_SKIP.get(s, s) for s in skip}
    return [
        (stage, read, pattern)
        for stage, pattern in patterns.items()
        if stage not in off
        for read in (READS if "{read}" in pattern else ("",))
    ]


def expected_outputs(samples: DataFrame, skip: tuple[str, ...] = (), patterns: dict[str, str] = SAMPLE_STAGES) -> DataFrame:
    """``sample, stage, read, path``, after ``run`` where ``samples`` has it: a fixed list of stages unfolded on each
    sample."""
    stages = F.array(*[F.struct(F.lit(s).alias("stage"), F.lit(r).alias("read"), F.lit(p).alias("p")) for s, r, p in stage_list(skip, patterns)])
    key = [c for c in ("run", "sample") if c in samples.columns]
    rows = samples.select(*key, F.explode(stages).alias("s"))
    path = F.replace(F.replace(F.col("s.p"), F.lit("{sample}"), F.col("sample")), F.lit("{read}"), F.col("s.read"))
    return rows.select(*key, "s.stage", "s.read", path.alias("path"))


def run_outputs(runs: DataFrame, mode: str = "normal") -> DataFrame:
    """``run, stage, path`` of the outputs that a run as a whole should have."""
    stages = [(s, p) for s, p in RUN_STAGES.items() if mode == "gva" or s not in HOSPITAL_STAGES]
    rows = runs.select("run").distinct().select("run", F.inline(F.array(*[F.struct(F.lit(s).alias("stage"), F.lit(p).alias("p")) for s, p in stages])))
    return rows.select("run", "stage", F.concat("run", F.lit("/"), F.replace("p", F.lit("{run}"), F.col("run"))).alias("path"))


def followers(stage: str) -> list[str]:
    """All stages that are made from ``stage``, directly or through others."""
    found = [stage]
    for name in found:
        found += [s for s, parts in MADE_FROM.items() if name in parts and s not in found]
    return found[1:]


def resume_plan(samples: DataFrame, present: DataFrame, mode: str = "normal", skip: tuple[str, ...] = ()) -> DataFrame:
    """What a resumed run has to make: ``run, sample, stage, reason``; sample is null for outputs of the run.

    An output that is absent is ``missing``; whatever is made from it, for its sample or its run, ``follows`` even if it
    is there. ``samples`` has run and sample; ``present`` (column ``path``) lists the files as ``<run>/<path>``. The
    graph of stages is small and fixed, so its closure is a literal and each missing output is unfolded once; what
    concerns the run is reduced to one row per run and stage before it is joined to anything.
    """
    mine = expected_outputs(samples, skip, {**SAMPLE_STAGES, **WORK_STAGES})
    mine = mine.select("run", "sample", "stage", F.concat("run", F.lit("/"), "path").alias("path"))
    wanted = mine.unionByName(run_outputs(samples, mode), allowMissingColumns=True)
    absent = missing_outputs(wanted, present).select("run", "sample", "stage").distinct()
    off = {STAGE_OF_SKIP.get(s, s) for s in skip} | (set() if mode == "gva" else set(HOSPITAL_STAGES))
    stages = [s for s in (*SAMPLE_STAGES, *WORK_STAGES, *RUN_STAGES) if s not in off]
    closure = F.create_map(*[x for s in stages for x in (F.lit(s), F.array(*[F.lit(f) for f in followers(s) if f not in off]).cast("array<string>"))])
    after = absent.select("run", "sample", F.explode(closure[F.col("stage")]).alias("stage"))
    of_run = F.col("stage").isin(*RUN_STAGES)
    rows = absent.withColumn("rank", F.lit(0)).unionByName(
        after.select("run", F.when(~of_run, F.col("sample")).alias("sample"), "stage", F.lit(1).alias("rank"))
    )
    first = rows.groupBy("run", "sample", "stage").agg(F.min("rank").alias("rank"))
    return first.select("run", "sample", "stage", F.when(F.col("rank") == 0, "missing").otherwise("follows").alias("reason"))


def sample_ids(sheet: DataFrame, wanted: str = "id") -> DataFrame:
    """The sheet with ``sample``, taken from the wanted id column, or the first that is known to carry ids."""
    return sheet.withColumn("sample", F.col(f"`{primary_id(sheet.columns, wanted)}`"))


def missing_outputs(expected: DataFrame, present: DataFrame) -> DataFrame:
    """Expected outputs that are not there: the work a resumed run has to do."""
    return expected.join(by_sorting(present.select("path").distinct()), "path", "left_anti").select(*expected.columns)


def run_platforms(methods: DataFrame) -> DataFrame:
    """Per run whether any sample has short reads and whether any has long reads."""
    has = lambda *m: F.coalesce(F.bool_or(F.col("method").isin(*m)), F.lit(False))
    return methods.groupBy("run").agg(
        has("ILLUMINA", "HYBRID").alias("has_illumina"), has("NANOPORE", "HYBRID").alias("has_nanopore")
    )


def staging_method(existing: Column | None = None) -> Column:
    """Method as judged when staging: either mate proves short reads, a recorded method is kept."""
    return sequencing_method((F.col("illumina_r1"), F.col("illumina_r2")), F.col("nanopore"), existing)


def stage_plan(sheet: DataFrame, inventory: DataFrame, store: str, reports: tuple[str, ...] = (), base: str = "") -> DataFrame:
    """``run, kind, platform, source, target`` for files to deposit. Schemes and authorities of paths don't count when
    the sheet's are looked up in the inventory; relative ones are below ``base``.

    ``sheet`` has run, method and the three path columns. Read files go to the platform of their column when they
    exist, their sample has a method and the run has that platform; reports (names with {run}) go to each platform
    of the run.
    """
    known = sheet.filter(F.col("method").isNotNull())
    flags = run_platforms(known)
    paths = known.unpivot(["run"], ["illumina_r1", "illumina_r2", "nanopore"], "from_column", "source").filter(is_given(F.col("source")))
    there = inventory.select(plain_path(F.col("path")).alias("plain")).distinct()
    found = paths.withColumn("plain", plain_path(F.col("source"), base)).join(by_sorting(there), "plain", "left_semi").drop("plain")
    platform = F.when(F.col("from_column") == "nanopore", "nanopore").otherwise("illumina")
    served = F.when(F.col("platform") == "nanopore", F.col("has_nanopore")).otherwise(F.col("has_illumina"))
    reads = found.withColumn("platform", platform).join(flags, "run").filter(served)
    folder = deposit_folder(store, F.col("run"), F.col("platform"))
    plan = reads.select(
        "run", F.lit("reads").alias("kind"), "platform", "source",
        F.concat(folder, F.lit("/fastq/"), basename(F.col("source"))).alias("target"),
    )
    if reports:
        each = F.array_compact(F.array(F.when(F.col("has_illumina"), "illumina"), F.when(F.col("has_nanopore"), "nanopore")))
        runs = flags.select("run", F.explode(each).alias("platform"))
        runs = runs.select("run", "platform", F.explode(F.array(*[F.lit(r) for r in reports])).alias("name"))
        name = F.replace(F.col("name"), F.lit("{run}"), F.col("run"))
        plan = plan.unionByName(runs.select(
            "run", F.lit("report").alias("kind"), "platform", name.alias("source"), F.concat(folder, F.lit("/"), name).alias("target")
        ))
    return plan.filter(F.col("target").isNotNull())


def latest_version(names: DataFrame) -> DataFrame:
    """Lexically greatest of the names that start with a date and a dot."""
    dated = names.filter(F.col("name").rlike(r"^\d{4}-\d{2}-\d{2}\..*"))
    return dated.agg(F.max("name").alias("latest"))


def first_per_key(records: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first record of each key. A minimum per key meets map-side, so a key held by very many rows stays cheap."""
    rest = [c for c in records.columns if c not in (*key, *order)]
    first = F.min(F.struct(*order, *rest)).alias("first")
    return records.groupBy(*key).agg(first).select(*key, *[f"first.{c}" for c in (*order, *rest)])
