"""Sample-sheet checks. Problems are rows: sheet, severity, row_no, column_name, code, detail."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isoloom.functions.dates import iso_or_original, parse_date
from isoloom.functions.names import run_name_issue
from isoloom.functions.text import is_blank, is_given, organism_key, plain_path
from isoloom.session import broadcast_if_small, by_sorting

FATAL, ERROR, WARNING = 3, 2, 1

# Hospital column names and the internal names they stand for.
INTERNAL_NAMES = {
    "CODIGO_MUESTRA_ORIGEN": "id",
    "PETICION": "id2",
    "FECHA_TOMA_MUESTRA": "collection_date",
    "ESPECIE_SECUENCIA": "organism",
    "MOTIVO_WGS": "relevance",
    "ILLUMINA_R1": "illumina_r1",
    "ILLUMINA_R2": "illumina_r2",
    "NANOPORE": "nanopore",
    "ID_WS": "scheme_mlst",
    "ST_WGS": "st",
    "MLST_WGS": "mlst",
    "R_Geno_WGS": "amr",
    "PHENO_WGS": "pheno_resfinder",
    "V_WGS": "virulence",
    "CONFIRMACION": "confirmation_note",
    "NUM_BROTE": "outbreak_id",
    "COMENTARIO_WGS": "comment",
}
# Columns a sheet must, should or may hold.
REQUIRED = {"gva": ("PETICION", "CODIGO_MUESTRA_ORIGEN"), "normal": ("id",)}
ANY_OF = {"gva": ("ILLUMINA_R1", "ILLUMINA_R2", "NANOPORE"), "normal": ("illumina_r1", "illumina_r2", "nanopore")}
IMPORTANT = {"gva": ("FECHA_TOMA_MUESTRA", "ESPECIE_SECUENCIA", "MOTIVO_WGS"), "normal": ()}
# Accepted basecalling models.
BASECALLING_MODELS = (
    "dna_r10.4.1_e8.2_400bps_hac@v4.2.0",
    "dna_r10.4.1_e8.2_400bps_sup@v4.2.0",
    "dna_r9.4.1_450bps_hac@v3.3",
    "dna_r9.4.1_450bps_sup@v3.3",
)
# Titles of the report's sections (fixed values); sentences of the problems, partly in our own words, and the place of each
# check in the report.
SECTION_TITLES = {FATAL: "===== FATAL ERRORS =====", ERROR: "===== ERRORS =====", WARNING: "===== WARNINGS ====="}
MESSAGES = {
    "RUN_NAME_MISSING:run": ("run_name not specified in configuration for GVA mode", 0),
    "RUN_NAME_FORMAT:run": (
        "The run_name format '{detail}' is invalid for GVA mode. It must follow the format AAMMDD_HOSPXXX", 0),
    "HOSPITAL_UNKNOWN:run": ("Invalid hospital code in '{detail}'", 0),
    "COLUMNS_REQUIRED:header": ("Missing mandatory columns: {detail}", 1),
    "COLUMNS_NO_DATA:header": ("At least one of these columns must be included: {detail}", 1),
    "COLUMNS_IMPORTANT:header": ("Missing important columns: {detail}", 1),
    "BLANK:id2": ("Error in row {row}: PETICION not specified", 2),
    "BLANK:organism": ("Error in row {row}: ESPECIE_SECUENCIA/organism not specified", 2),
    "BLANK:relevance": ("Error in row {row}: MOTIVO_WGS/relevance not specified", 2),
    "BLANK:collection_date": ("Warning in row {row}: FECHA_TOMA_MUESTRA/collection_date not specified", 2),
    "NO_DATA_SOURCE:illumina_r1|nanopore": (
        "Error in row {row}: No data source specified (illumina_r1 or nanopore)", 2),
    "ID_MISSING:id": ("Rows without a value in the identification column: [{row}]", 3),
    "ID_CHARACTERS:id": ("Error in row {row}: ID '{detail}' contains invalid special characters", 4),
    "FILE_MISSING:illumina_r1": ("The file {detail} in column {column}, row {row} does not exist", 5),
    "FILE_MISSING:illumina_r2": ("The file {detail} in column {column}, row {row} does not exist", 6),
    "FILE_MISSING:nanopore": ("The file {detail} in column {column}, row {row} does not exist", 7),
    "DATE_INVALID:collection_date": ("Error in row {row}: Invalid date format: '{detail}'", 8),
    "ORGANISM_UNKNOWN:organism": ("The organism '{detail}' in row {row} is not in the species table", 8),
    "MODEL_MISSING:nanopore": ("Nanopore samples detected but no basecalling model is configured", 9),
    "MODEL_INVALID:nanopore": ("Invalid Dorado model '{detail}'", 9),
}
PATH_COLUMNS = ("illumina_r1", "illumina_r2", "nanopore")
ISSUE_COLUMNS = ("sheet", "severity", "row_no", "column_name", "code", "detail")


def rename_internal(df: DataFrame) -> DataFrame:
    """Internal names for the hospital's; where a table has both, the hospital's column wins."""
    new_names = {old: new for old, new in INTERNAL_NAMES.items() if old in df.columns}
    return df.drop(*[new for new in new_names.values() if new in df.columns]).withColumnsRenamed(new_names)


def _problem(cond: Column, severity: int, column: str, code: str, detail: Column | None = None) -> Column:
    return F.when(
        cond,
        F.struct(
            F.lit(severity).cast("long").alias("severity"),
            F.lit(column).alias("column_name"),
            F.lit(code).alias("code"),
            (F.lit(None).cast("string") if detail is None else detail).alias("detail"),
        ),
    )


def _explode_problems(df: DataFrame, rules: list[Column]) -> DataFrame:
    """All rules in one scan: each row yields the problems it has, none for most rows."""
    if not rules:
        rules = [_problem(F.lit(False), ERROR, "", "")]
    found = F.filter(F.array(*rules), lambda p: p.isNotNull())
    return df.select("sheet", "row_no", F.explode(found).alias("p")).select(
        "sheet", F.col("p.severity").alias("severity"), F.col("row_no").cast("long").alias("row_no"),
        "p.column_name", "p.code", "p.detail",
    )


def _blank_rules(columns: list[str]) -> list[Column]:
    rules = [
        _problem(is_blank(F.col(c)), severity, c, "BLANK")
        for c, severity in (("id2", ERROR), ("organism", ERROR), ("relevance", ERROR), ("collection_date", WARNING))
        if c in columns
    ]
    sources = [~is_blank(F.col(c)) for c in ("illumina_r1", "nanopore") if c in columns]
    none = ~(sources[0] | sources[-1]) if sources else F.lit(True)
    return [*rules, _problem(none, ERROR, "illumina_r1|nanopore", "NO_DATA_SOURCE")]


def _late_rules(columns: list[str]) -> list[Column]:
    rules = [_problem(F.col("id").rlike(r"(?U)[^\w\-]"), ERROR, "id", "ID_CHARACTERS", F.col("id"))]
    if "collection_date" in columns:
        date = F.col("collection_date")
        rules.append(_problem(is_given(date) & parse_date(date).isNull(), ERROR, "collection_date", "DATE_INVALID", date))
    return rules


def blank_field_issues(sheet: DataFrame) -> DataFrame:
    """Hospital mode: blank fields, and rows with neither first-mate nor long reads."""
    return _explode_problems(sheet, _blank_rules(sheet.columns))


def _no_id_rule() -> Column:
    return _problem(F.col("id").isNull() | (F.col("id") == ""), FATAL, "id", "ID_MISSING")


def missing_ids(sheet: DataFrame) -> DataFrame:
    return _explode_problems(sheet, [_no_id_rule()])


def id_charset_issues(sheet: DataFrame) -> DataFrame:
    return _explode_problems(sheet, _late_rules(["id"]))


def date_issues(sheet: DataFrame) -> DataFrame:
    return _explode_problems(sheet, _late_rules(sheet.columns)[1:])


def normalise_dates(sheet: DataFrame) -> DataFrame:
    """ISO dates where the text is a date; other texts stay."""
    return sheet.withColumn("collection_date", iso_or_original(F.col("collection_date")))


def missing_files(sheet: DataFrame, inventory: DataFrame, base: str = "") -> DataFrame:
    """A warning for each given path that is not in the inventory (column ``path``). Schemes and authorities don't
    count; relative paths of the sheet are looked up below ``base``."""
    columns = [c for c in PATH_COLUMNS if c in sheet.columns]
    paths = sheet.unpivot(["sheet", "row_no"], columns, "column_name", "path").filter(is_given(F.col("path")))
    there = inventory.select(plain_path(F.col("path")).alias("plain")).distinct()
    absent = paths.withColumn("plain", plain_path(F.col("path"), base)).join(by_sorting(there), "plain", "left_anti")
    return absent.select(
        "sheet", F.lit(WARNING).cast("long").alias("severity"), F.col("row_no").cast("long").alias("row_no"),
        "column_name", F.lit("FILE_MISSING").alias("code"), F.col("path").alias("detail"),
    )


def _sheet_level(sheets: DataFrame, severity: Column | int, column: str, code: Column | str, detail: Column) -> DataFrame:
    severity = severity if isinstance(severity, Column) else F.lit(severity)
    code = code if isinstance(code, Column) else F.lit(code)
    return sheets.select(
        "sheet", severity.cast("long").alias("severity"), F.lit(0).cast("long").alias("row_no"),
        F.lit(column).alias("column_name"), code.alias("code"), detail.cast("string").alias("detail"),
    )


def model_issues(sheet: DataFrame, model: str | None) -> DataFrame:
    """Sheets with long reads need an accepted basecalling model."""
    if "nanopore" not in sheet.columns or model in BASECALLING_MODELS:
        return _sheet_level(sheet.limit(0), ERROR, "nanopore", "MODEL_INVALID", F.lit(model))
    with_long = sheet.groupBy("sheet").agg(F.max(is_given(F.coalesce("nanopore", F.lit("")))).alias("long_reads"))
    code = "MODEL_INVALID" if model else "MODEL_MISSING"
    return _sheet_level(with_long.filter("long_reads"), ERROR, "nanopore", code, F.lit(model))


def run_name_issues(sheets: DataFrame) -> DataFrame:
    """Fatal problem per sheet (columns ``sheet, run``) whose run name is missing, misshapen or of no known hospital."""
    code = run_name_issue(F.col("run"))
    return _sheet_level(sheets.select("sheet", "run").distinct().withColumn("code", code).filter("code IS NOT NULL"),
                        FATAL, "run", F.col("code"), F.col("run"))


def column_problems(columns: list[str], mode: str) -> list[tuple[int, str, str]]:
    """Problems visible from the header alone: (severity, code, columns)."""
    missing = [c for c in REQUIRED[mode] if c not in columns]
    if missing:
        return [(FATAL, "COLUMNS_REQUIRED", ", ".join(missing))]
    if not any(c in columns for c in ANY_OF[mode]):
        return [(FATAL, "COLUMNS_NO_DATA", ", ".join(ANY_OF[mode]))]
    missing = [c for c in IMPORTANT[mode] if c not in columns]
    return [(ERROR, "COLUMNS_IMPORTANT", ", ".join(missing))] if missing else []


def primary_id(columns: list[str], wanted: str = "id") -> str:
    """The wanted id column, else the first one that is known to carry ids."""
    if wanted in columns:
        return wanted
    for name in columns:
        if name.lower() in ("id", "id2", "codigo_muestra_origen"):
            return name
    raise ValueError(f"no id column among {columns}")


def header_problem(header: Column, mode: str) -> Column:
    """The problem of a sheet's header (``severity, code, detail``), as ``column_problems`` finds it, or null."""
    lacking = lambda names: F.filter(F.array(*[F.lit(n) for n in names]), lambda n: ~F.array_contains(header, n))

    def problem(cond: Column, severity: int, code: str, names: Column) -> Column:
        return F.when(cond, F.struct(F.lit(severity).alias("severity"), F.lit(code).alias("code"), F.array_join(names, ", ").alias("detail")))

    required, any_of = lacking(REQUIRED[mode]), F.array(*[F.lit(n) for n in ANY_OF[mode]])
    found = [
        problem(F.size(required) > 0, FATAL, "COLUMNS_REQUIRED", required),
        problem(~F.arrays_overlap(header, any_of), FATAL, "COLUMNS_NO_DATA", any_of),
    ]
    if IMPORTANT[mode]:
        important = lacking(IMPORTANT[mode])
        found.append(problem(F.size(important) > 0, ERROR, "COLUMNS_IMPORTANT", important))
    return F.coalesce(*found)


def _has(column: str, mode: str) -> Column:
    """Whether the row's own sheet has the column, under its internal or hospital name."""
    names = [column, *[old for old, new in INTERNAL_NAMES.items() if new == column]] if mode == "gva" else [column]
    return F.arrays_overlap("header", F.array(*[F.lit(n) for n in names]))


def sheet_facts(sheet: DataFrame, mode: str) -> DataFrame:
    """What is decided per sheet, from one aggregate: ``header``, the fatal ``run_wrong``, its header problem, whether
    ids are missing (``no_id``) and whether long reads are named (``long_reads``)."""
    run_wrong = F.max(F.col("run_problem").isNotNull()) if mode == "gva" else F.max(F.lit(False))
    facts = sheet.groupBy("sheet").agg(
        F.first("header").alias("header"), run_wrong.alias("run_wrong"),
        F.max(F.col("id").isNull() | (F.col("id") == "")).alias("no_id"),
        F.max(is_given(F.coalesce("nanopore", F.lit("")))).alias("long_reads"),
    )
    problem = header_problem(F.col("header"), mode)
    return facts.withColumn("problem", problem).withColumn(
        "stopped", F.col("run_wrong") | F.coalesce(F.col("problem.severity") == FATAL, F.lit(False))
    )


def validate(
    sheet: DataFrame,
    mode: str = "normal",
    inventory: DataFrame | None = None,
    model: str | None = None,
    base: str = "",
    species: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Issues and validated sheet for any number of sheets at once.

    ``sheet`` carries ``sheet`` and ``row_no`` (plus ``run`` in hospital mode) next to the columns as written. Sheets of
    different headers are judged each by its own, which ``header`` holds as a list; without it all have the columns of the
    table. Checks that come after a fatal problem of a sheet are not reported for that sheet, and its rows are not passed
    on. Relative paths are looked up in ``inventory`` below ``base``; with ``species`` (column ``name``) organisms that
    it doesn't list give a warning.

    Nothing is computed before the result is asked for: what is decided per sheet comes from one aggregate, which the
    rows meet in one join.
    """
    own = [c for c in sheet.columns if c not in ("sheet", "row_no", "run", "header")]
    rows = sheet if "header" in sheet.columns else sheet.withColumn("header", F.array(*[F.lit(c) for c in own]))
    rows = rename_internal(rows) if mode == "gva" else rows
    written = rows.columns
    rows = rows.withColumns({c: F.lit(None).cast("string") for c in ("id", "nanopore") if c not in written})
    rows = rows.withColumn("run_problem", run_name_issue(F.col("run"))) if mode == "gva" else rows
    facts = sheet_facts(rows, mode)
    marked = rows.join(facts.select("sheet", "stopped", F.col("no_id").alias("_no_id")), "sheet").where("not stopped")
    usable = marked.where("not _no_id").select([c for c in written if c not in ("header", "run_problem")])
    guarded = lambda rules, column: [F.when(_has(column, mode), r) for r in rules]
    early = []
    if mode == "gva":
        for column in ("id2", "organism", "relevance", "collection_date"):
            early += guarded(_blank_rules([column])[:1], column) if column in written else []
        early.append(_blank_rules([c for c in ("illumina_r1", "nanopore") if c in written])[-1])
    late = _late_rules(written) if "id" in written else []
    rules = [*early, _no_id_rule(), *[F.when(~F.col("_no_id"), r) for r in late]]
    issues = [_explode_problems(marked, rules)]
    if mode == "gva":
        wrong = rows.where("run_problem is not null").select("sheet", "run", F.col("run_problem").alias("code")).distinct()
        issues.append(_sheet_level(wrong, FATAL, "run", F.col("code"), F.col("run")))
    headers = facts.where("problem is not null and not run_wrong")
    issues.append(_sheet_level(headers, F.col("problem.severity"), "header", F.col("problem.code"), F.col("problem.detail")))
    if model not in BASECALLING_MODELS:
        with_long = facts.where("long_reads and not stopped and not no_id")
        issues.append(_sheet_level(with_long, ERROR, "nanopore", "MODEL_INVALID" if model else "MODEL_MISSING", F.lit(model)))
    if inventory is not None:
        issues.append(missing_files(usable, inventory, base))
    if species is not None and "organism" in written:
        issues.append(unknown_organisms(usable, species))
    return _stack(issues), normalise_dates(usable) if "collection_date" in usable.columns else usable


def unknown_organisms(sheet: DataFrame, species: DataFrame) -> DataFrame:
    """A warning for each given organism that the species table doesn't list."""
    given = sheet.where(~is_blank(F.col("organism"))).withColumn("name", organism_key(F.col("organism")))
    return given.join(by_sorting(species.select("name").distinct()), "name", "left_anti").select(
        "sheet", F.lit(WARNING).cast("long").alias("severity"), F.col("row_no").cast("long").alias("row_no"),
        F.lit("organism").alias("column_name"), F.lit("ORGANISM_UNKNOWN").alias("code"), F.col("organism").alias("detail"),
    )


def _stack(parts: list[DataFrame]) -> DataFrame:
    out = parts[0].select(*ISSUE_COLUMNS)
    for part in parts[1:]:
        out = out.unionByName(part.select(*ISSUE_COLUMNS))
    return out


def validation_status(sheets: DataFrame, issues: DataFrame) -> DataFrame:
    """Per sheet 3 fatal, 2 error, 1 warning, 0 nothing found."""
    worst = issues.groupBy("sheet").agg(F.max("severity").alias("status"))
    return sheets.select("sheet").distinct().join(worst, "sheet", "left").select(
        "sheet", F.coalesce("status", F.lit(0).cast("long")).alias("status")
    )


def message(code: Column, column: Column, row_no: Column, detail: Column) -> Column:
    """The problem as a sentence."""
    template = F.coalesce(_lookup(0)[F.concat_ws(":", code, column)], F.concat_ws(" ", code, column))
    with_row = F.replace(template, F.lit("{row}"), row_no.cast("string"))
    with_column = F.replace(with_row, F.lit("{column}"), column)
    return F.replace(with_column, F.lit("{detail}"), F.coalesce(detail, F.lit("")))


def _lookup(part: int) -> Column:
    pairs = [F.lit(x) for key, entry in MESSAGES.items() for x in (key, entry[part])]
    return F.create_map(*pairs)


def report_lines(issues: DataFrame) -> DataFrame:
    """Text of the validation report: ``sheet, section, check, row_no, line``; the middle three give the order.

    Sections follow each other as fatal errors, errors, warnings; each ends with a blank line; empty ones are absent.
    Problems stay one line each, so a section of any size is spread over the cluster.
    """
    section = (F.lit(FATAL) - F.col("severity")).cast("long").alias("section")
    check = F.coalesce(_lookup(1)[F.concat_ws(":", "code", "column_name")], F.lit(0)).cast("long").alias("check")
    text = message(F.col("code"), F.col("column_name"), F.col("row_no"), F.col("detail"))
    body = issues.select("sheet", section, check, "row_no", text.alias("line"))
    titles = F.create_map(*[F.lit(x) for pair in SECTION_TITLES.items() for x in pair])
    edge = lambda at, line: F.struct(F.lit(at).cast("long").alias("check"), line.alias("line"))
    edges = F.array(edge(-1, titles[F.col("severity").cast("int")]), edge(99, F.lit("")))
    heads = issues.select("sheet", "severity").distinct().select("sheet", section, F.inline(edges))
    return body.unionByName(heads.withColumn("row_no", F.lit(0).cast("long")))


def organism_lookup(sheet: DataFrame, species: DataFrame) -> DataFrame:
    """Organism in table form (lower case, underscores) with the species columns; ``known`` tells whether it is listed."""
    keyed = sheet.withColumn("organism", organism_key(F.col("organism")))
    listed = broadcast_if_small(species.withColumnRenamed("name", "organism").withColumn("listed", F.lit(True)), ["organism"])
    return keyed.join(listed, "organism", "left").withColumn("known", F.coalesce("listed", F.lit(False))).drop("listed")
