"""Names of runs, hospitals and sequencing files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from isoloom.functions.text import basename, is_given

# Shape of a run name, hospital codes, read-file extensions.
RUN_NAME = r"^\d{6}_[A-Z]{4}\d{3}$"
HOSPITALS = ("ALIC", "CAST", "ELCH", "GRAL", "PESE", "CLIN", "LAFE", "EPIM")
READ_EXTENSIONS = (".fastq.gz", ".fastq", ".fq.gz", ".fq")

# Ways a short-read file name carries its sample, tried in this order.
SAMPLE_SHAPES = (
    r"^(.+?)_S\d+_R[12](?:_001)?\.f(?:ast)?q(?:\.gz)?$",
    r"^(.+?)_R[12](?:_001)?\.f(?:ast)?q(?:\.gz)?$",
    r"^(.+?)_r[12](?:_001)?\.f(?:ast)?q(?:\.gz)?$",
    r"^(.+?)\.R[12]\.f(?:ast)?q(?:\.gz)?$",
    r"^(.+?)\.r[12]\.f(?:ast)?q(?:\.gz)?$",
    r"^(.+?)_[FR]\.f(?:ast)?q(?:\.gz)?$",
)
# Endings that mark the first and the second mate, in any letter case.
MATE_ENDINGS = {
    "R1": r"(?i)(_R1(_001)?|\.R1|_F)\.f(ast)?q(\.gz)?$",
    "R2": r"(?i)(_R2(_001)?|\.R2|_R)\.f(ast)?q(\.gz)?$",
}


def hospital_code(run: Column) -> Column:
    """First four letters after the underscore; null without an underscore."""
    return F.substring(F.get(F.split(run, "_"), F.lit(1)), 1, 4)


def run_name_issue(run: Column) -> Column:
    """Null for an accepted run name, otherwise the code of what is wrong."""
    return (
        F.when(~is_given(F.coalesce(run, F.lit(""))), "RUN_NAME_MISSING")
        .when(~run.rlike(RUN_NAME), "RUN_NAME_FORMAT")
        .when(~hospital_code(run).isin(*HOSPITALS), "HOSPITAL_UNKNOWN")
    )


def illumina_sample_id(path: Column) -> Column:
    name = basename(path)
    shaped = [F.nullif(F.regexp_extract(name, shape, 1), F.lit("")) for shape in SAMPLE_SHAPES]
    without_extension = F.regexp_replace(name, r"(?<=[^.])\.[^.]*$", "")
    return F.coalesce(*shaped, F.element_at(F.split(without_extension, r"\."), 1))


def nanopore_sample_id(path: Column) -> Column:
    return F.regexp_replace(basename(path), r"\.f(ast)?q(\.gz)?$", "")


def mate_role(path: Column) -> Column:
    """R1, R2, or null for a name that says neither."""
    name = basename(path)
    return F.when(name.rlike(MATE_ENDINGS["R1"]), "R1").when(name.rlike(MATE_ENDINGS["R2"]), "R2")


def extension_rank(path: Column) -> Column:
    """Place of the file's extension in the order in which files are listed; null for other files."""
    ranked = enumerate(READ_EXTENSIONS)
    return reduce(lambda chain, item: chain.when(F.endswith(path, F.lit(item[1])), F.lit(item[0])), ranked, F)


def sequencing_method(
    illumina: tuple[Column, ...], nanopore: Column, existing: Column | None = None
) -> Column:
    """HYBRID, ILLUMINA, NANOPORE or null. ``illumina`` lists the columns that prove short reads."""
    short = reduce(lambda a, b: a | b, [is_given(c) for c in illumina])
    method = (
        F.when(short & is_given(nanopore), "HYBRID").when(short, "ILLUMINA").when(is_given(nanopore), "NANOPORE")
    )
    return method if existing is None else F.coalesce(existing, method)


def platform_of(method: Column) -> Column:
    return F.when(method.isin("ILLUMINA", "HYBRID"), "illumina").otherwise("nanopore")


def deposit_folder(store: str, run: Column, platform: Column) -> Column:
    """Run folder in the store; null when the run name has no hospital part."""
    return F.concat(F.lit(f"{store}/CVA_"), hospital_code(run), F.lit("/"), platform, F.lit("/"), run)


def deposit_path(store: str, run: Column, method: Column, illumina_r1: Column, nanopore: Column) -> Column:
    """Where the reads of a sample lie: the file of its main platform if there is one, else the folder."""
    platform = platform_of(method)
    file = F.when(platform == "illumina", illumina_r1).otherwise(nanopore)
    folder = F.concat(deposit_folder(store, run, platform), F.lit("/fastq"))
    return F.when(folder.isNotNull(), F.concat_ws("/", folder, F.when(is_given(file), basename(file))))
