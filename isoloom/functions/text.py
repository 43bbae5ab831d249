"""Small text expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Cell texts that count as missing.
NULL_TOKENS = (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def null_tokens(df: DataFrame) -> DataFrame:
    """Turn empty cells and the missing-value tokens of every string column into null (exact match)."""
    tokens = ("",) + NULL_TOKENS
    return df.select(
        *[
            F.when(~F.col(f"`{name}`").isin(*tokens), F.col(f"`{name}`")).alias(name) if kind == "string" else F.col(f"`{name}`")
            for name, kind in df.dtypes
        ]
    )


def is_blank(col: Column) -> Column:
    """Null or nothing but white space."""
    return col.isNull() | col.rlike(r"^(?U)\s*$")


def is_given(col: Column) -> Column:
    """Neither null nor the empty text (white space counts as given)."""
    return col.isNotNull() & (col != "")


def sanitize_id(col: Column) -> Column:
    """Space, dot, comma and dash become an underscore."""
    return F.regexp_replace(col, "[ .,-]", "_")


def organism_key(col: Column) -> Column:
    return F.replace(F.lower(col), F.lit(" "), F.lit("_"))


def basename(col: Column) -> Column:
    return F.element_at(F.split(col, "/"), -1)


def wrap_outside_brackets(col: Column) -> Column:
    """Spaces become line breaks, except inside ``[...]``."""
    pieces = F.regexp_extract_all(col, F.lit(r"\[.*?\]|[^\[]+|\["), F.lit(0))
    bracketed = lambda piece: piece.rlike(r"(?s)^\[.*\]$")
    return F.array_join(
        F.transform(pieces, lambda piece: F.when(bracketed(piece), piece).otherwise(F.replace(piece, F.lit(" "), F.lit("\n")))),
        "",
    )


def gff_retag(col: Column) -> Column:
    """First ``Name=`` tag becomes ``OldName=``; the first ``ID=x`` gains ``;Name=x``."""
    renamed = F.regexp_replace(col, r"^(.*?\W)(?i:Name)=", "$1OldName=")
    return F.regexp_replace(renamed, r"^(.*?)ID=([^;]+)", "$1ID=$2;Name=$2")


def plain_path(path: Column, base: str = "") -> Column:
    """A path without scheme and authority, for comparing listed paths with written ones; relative ones get ``base``."""
    bare = F.regexp_replace(F.regexp_replace(path, r"^[A-Za-z][\w+.-]*://[^/]*", ""), r"^[A-Za-z][\w+.-]*:(?=/)", "")
    return F.when(bare.startswith("/"), bare).otherwise(F.concat(F.lit(base.rstrip("/") + "/"), bare)) if base else bare
