"""Plain SQL for each query, written independently of the DataFrame code, over the same whole tables."""

from __future__ import annotations

import re

from isoloom.plans import views as v
from isoloom.plans.catalog import MIN_READS, MODEL, OVERVIEW, REPORTS, SCREEN_K, TEXT_TOKENS
from isoloom.plans.files import DOCS_PER_CHUNK, READ_ENDINGS, ROWS_PER_CHUNK

# Fixed values, written out here so that the SQL doesn't rest on the code it checks.
NULL_TOKENS = (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
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


def _list(values) -> str:
    return "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in values) + "]"


def _dna(col: str) -> str:
    return f"translate(regexp_replace(lower({col}), '[^a-z]', '', 'g'), '{v.LETTERS}', '{v.BASES}')"


def _rc(col: str) -> str:
    return f"reverse(translate({col}, 'ACGT', 'TGCA'))"


def _null(col: str) -> str:
    return f"CASE WHEN {col} IN ({', '.join(repr(t) for t in ('',) + NULL_TOKENS)}) THEN NULL ELSE {col} END"


# --- derived tables -------------------------------------------------------------------------------------------------

SHEET = f"""
keys AS (SELECT *, o_orderkey AS k, o_custkey AS c FROM orders),
sheet0 AS (
  SELECT k, c,
    (CASE WHEN c % 50 = 7 THEN '2405' ELSE '2405' || lpad((c % 28 + 1)::VARCHAR, 2, '0') END)
      || '_' || {_list(v.SITES)}[c % 9 + 1] || lpad((c % 20)::VARCHAR, 3, '0') AS run,
    day(o_orderdate)::VARCHAR AS dd, month(o_orderdate)::VARCHAR AS mm, year(o_orderdate)::VARCHAR AS yy,
    o_orderstatus, o_orderpriority
  FROM keys),
sheet AS (
  SELECT run AS sheet, run, k + 2 AS row_no, k, c,
    CASE WHEN k % 997 = 0 THEN NULL WHEN k % 101 = 0 THEN 'M ' || k WHEN k % 103 = 0 THEN 'ñ' || k ELSE 'M' || k END AS id,
    CASE WHEN c % 11 = 0 THEN '  ' ELSE 'P' || c END AS id2,
    CASE WHEN k % 6 = 0 THEN dd || '/' || mm || '/' || substr(yy, 3, 2)
         WHEN k % 6 = 1 THEN lpad(dd, 2, '0') || '.' || lpad(mm, 2, '0') || '.' || yy
         WHEN k % 6 = 2 THEN yy || '-' || mm || '-' || dd
         WHEN k % 6 = 3 THEN yy || '/' || lpad(mm, 2, '0') || '/' || lpad(dd, 2, '0')
         WHEN k % 6 = 4 THEN '31/' || lpad(mm, 2, '0') || '/' || yy
         WHEN k % 12 = 5 THEN ' ' END AS collection_date,
    CASE WHEN k % 13 <> 0 THEN {_list(v.SPECIES)}[k % 5 + 1] END AS organism,
    CASE WHEN k % 17 = 0 THEN '' ELSE 'Vigilancia' END AS relevance,
    CASE WHEN k % 19 = 0 THEN 'B' || k END AS outbreak_id,
    o_orderstatus AS confirmation_note, o_orderpriority AS comment,
    CASE WHEN k % 4 < 2 THEN '/d/' || run || '/M' || k || '_S1_R1_001.fastq.gz' END AS illumina_r1,
    CASE WHEN k % 4 <> 2 THEN '/d/' || run || '/M' || k || '_S1_R2_001.fastq.gz' END AS illumina_r2,
    CASE WHEN k % 4 = 2 OR k % 8 = 1 THEN '/d/' || run || '/M' || k || '.fastq.gz' END AS nanopore
  FROM sheet0),
stored AS (
  SELECT p AS path FROM (SELECT unnest([illumina_r1, illumina_r2, nanopore]) AS p FROM sheet WHERE k % 5 <> 0) WHERE p IS NOT NULL),
slashed AS (SELECT *, regexp_replace(collection_date, '[.-]', '/', 'g') AS s FROM sheet),
dated AS (
  SELECT *, CASE
    WHEN regexp_matches(s, '^\\d{{1,2}}/\\d{{1,2}}/\\d{{2}}$') THEN try_strptime(s, '%d/%m/%y')
    WHEN regexp_matches(s, '^\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}$') THEN try_strptime(s, '%d/%m/%Y')
    WHEN regexp_matches(s, '^\\d{{4}}/\\d{{1,2}}/\\d{{1,2}}$') THEN try_strptime(s, '%Y/%m/%d') END AS day
  FROM slashed),
methods AS (
  SELECT *, CASE WHEN illumina_r1 IS NOT NULL AND nanopore IS NOT NULL THEN 'HYBRID' WHEN illumina_r1 IS NOT NULL THEN 'ILLUMINA'
    WHEN nanopore IS NOT NULL THEN 'NANOPORE' END AS method FROM dated)"""

ISSUES = SHEET + f""",
verdicts AS (
  SELECT DISTINCT run, CASE WHEN NOT regexp_matches(run, '^[0-9]{{6}}_[A-Z]{{4}}[0-9]{{3}}$') THEN 'RUN_NAME_FORMAT'
    WHEN substr(split_part(run, '_', 2), 1, 4) NOT IN ('ALIC','CAST','ELCH','GRAL','PESE','CLIN','LAFE','EPIM') THEN 'HOSPITAL_UNKNOWN' END AS code
  FROM sheet),
named AS (SELECT d.* FROM dated d JOIN verdicts q ON d.run = q.run AND q.code IS NULL),
blanks AS (
  SELECT sheet, 2 AS severity, row_no, 'id2' AS column_name, 'BLANK' AS code, NULL AS detail FROM named WHERE id2 IS NULL OR trim(id2) = ''
  UNION ALL SELECT sheet, 2, row_no, 'organism', 'BLANK', NULL FROM named WHERE organism IS NULL OR trim(organism) = ''
  UNION ALL SELECT sheet, 2, row_no, 'relevance', 'BLANK', NULL FROM named WHERE relevance IS NULL OR trim(relevance) = ''
  UNION ALL SELECT sheet, 1, row_no, 'collection_date', 'BLANK', NULL FROM named WHERE collection_date IS NULL OR trim(collection_date) = ''
  UNION ALL SELECT sheet, 2, row_no, 'illumina_r1|nanopore', 'NO_DATA_SOURCE', NULL FROM named WHERE illumina_r1 IS NULL AND nanopore IS NULL),
noid AS (SELECT sheet, 3 AS severity, row_no, 'id' AS column_name, 'ID_MISSING' AS code, NULL AS detail FROM named WHERE id IS NULL OR id = ''),
usable AS (SELECT * FROM named WHERE sheet NOT IN (SELECT sheet FROM noid)),
issues0 AS (
  SELECT run AS sheet, 3 AS severity, 0 AS row_no, 'run' AS column_name, code, run AS detail FROM verdicts WHERE code IS NOT NULL
  UNION ALL SELECT * FROM blanks UNION ALL SELECT * FROM noid
  UNION ALL SELECT sheet, 2, row_no, 'id', 'ID_CHARACTERS', id FROM usable WHERE regexp_matches(id, '[^\\p{{L}}0-9_-]')
  UNION ALL SELECT sheet, 2, row_no, 'collection_date', 'DATE_INVALID', collection_date FROM usable WHERE collection_date <> '' AND day IS NULL
  UNION ALL SELECT sheet, 2, 0, 'nanopore', 'MODEL_INVALID', '{MODEL}' FROM usable GROUP BY sheet HAVING count(nanopore) > 0
  UNION ALL SELECT sheet, 1, row_no, col, 'FILE_MISSING', p FROM (
    SELECT sheet, row_no, unnest(['illumina_r1', 'illumina_r2', 'nanopore']) AS col, unnest([illumina_r1, illumina_r2, nanopore]) AS p FROM usable)
    WHERE p IS NOT NULL AND p NOT IN (SELECT path FROM stored)),
issues AS (SELECT sheet, severity::BIGINT AS severity, row_no::BIGINT AS row_no, column_name, code, detail FROM issues0)"""

HITS = """
hits AS (
  SELECT 'S' || l_suppkey AS sample, CASE l_returnflag WHEN 'A' THEN 'AMR' WHEN 'N' THEN 'VIRULENCE' ELSE 'STRESS' END AS type,
    CASE WHEN l_linestatus = 'F' THEN 'core' ELSE 'plus' END AS scope, p_brand AS symbol, p_name, p_type, p_size, l_returnflag,
    row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey) AS ord
  FROM lineitem JOIN part ON l_partkey = p_partkey),
amr AS (
  SELECT s.sample AS "Sample", {lists} FROM (SELECT DISTINCT sample FROM hits) s)"""


def _seen(cond: str, text: str, glue: str = " ", table: str = "hits", at: str = "ord") -> str:
    return (
        f"(SELECT string_agg(t, '{glue}' ORDER BY a) FROM (SELECT {text} AS t, min({at}) AS a FROM {table} h"
        f" WHERE h.sample = s.sample AND {cond} GROUP BY {text}))"
    )


HITS = HITS.replace("{lists}", ", ".join(
    f'coalesce({_seen(cond, "symbol")}, \'\') AS "{name}"'
    for name, cond in (("AMR", "type = 'AMR'"), ("VIRULENCE", "type = 'VIRULENCE'"), ("SCOPE_core", "scope = 'core'"))
)) + f""",
genes_of AS (
  SELECT s.sample AS "Sample", coalesce({_seen("p_size <> 7", "symbol")}, '') AS "GENE_resfinder" FROM (SELECT DISTINCT sample FROM hits) s),
drugs AS (
  SELECT sample, p_type AS class, p_name AS drug, min(ord) AS ord FROM hits WHERE l_returnflag = 'R' AND p_size <> 13 GROUP BY ALL),
classes AS (SELECT sample, class, string_agg(drug, '-' ORDER BY ord) || '[' || class || ']' AS t FROM drugs GROUP BY sample, class),
pheno_of AS (
  SELECT s.sample AS "Sample", coalesce((SELECT string_agg(t, ' ' ORDER BY class) FROM classes c WHERE c.sample = s.sample), '') AS "PHENO_resfinder"
  FROM (SELECT DISTINCT sample FROM hits) s)"""

MLST = """
calls AS (
  SELECT 'S' || (o_custkey * 2) AS sample, lower(c_mktsegment) AS scheme, (o_orderkey % 500)::VARCHAR AS st,
    list_transform(range(0, 5 + o_orderkey % 3), lambda i: ['aroC','dnaN','hemD','hisD','purE','sucA','thrA'][i + 1] || '(' || ((o_orderkey * (i + 3)) % 97) || ')') AS alleles
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

REPORT = HITS + "," + MLST + """,
report AS (
  SELECT coalesce(m.sample, a."Sample") AS "Sample", m.scheme AS "Scheme_mlst", m.st AS "ST", array_to_string(m.alleles, ' ') AS "MLST",
    a."AMR", a."VIRULENCE", a."SCOPE_core", g."GENE_resfinder", p."PHENO_resfinder"
  FROM calls m FULL JOIN amr a ON m.sample = a."Sample" LEFT JOIN genes_of g ON g."Sample" = a."Sample" LEFT JOIN pheno_of p ON p."Sample" = a."Sample")"""

FILES = """
names0 AS (SELECT o_orderkey AS k, unnest(CASE WHEN o_orderkey % 9 <> 0 THEN ['1', '2'] ELSE ['1'] END) AS m FROM orders),
paths AS (
  SELECT '/d/f' || (k % 3) || '/A' || (k // 3) || replace(replace(
    ['_S5_R{m}_001.fastq.gz', '_S5_L001_R{m}_001.fastq.gz', '_R{m}.fq', '.r{m}.fastq.gz', '_{f}.fq.gz', '_S2_r{m}_001.fastq', '.x_R{m}.fastq', '_{m}.fastq.gz'][k % 8 + 1],
    '{m}', m), '{f}', CASE m WHEN '1' THEN 'F' ELSE 'R' END) AS path FROM names0),
named AS (
  SELECT path, split_part(path, '/', 4) AS name,
    CASE WHEN path LIKE '%.fastq.gz' THEN 0 WHEN path LIKE '%.fastq' THEN 1 WHEN path LIKE '%.fq.gz' THEN 2 WHEN path LIKE '%.fq' THEN 3 END AS ext
  FROM paths),
ids AS (
  SELECT *, regexp_replace(name, '\\.f(ast)?q(\\.gz)?$', '') AS long_id,
    CASE WHEN regexp_matches(name, '(?i)(_R1(_001)?|\\.R1|_F)\\.f(ast)?q(\\.gz)?$') THEN 'R1'
         WHEN regexp_matches(name, '(?i)(_R2(_001)?|\\.R2|_R)\\.f(ast)?q(\\.gz)?$') THEN 'R2' END AS mate,
    CASE WHEN regexp_matches(name, '^.+?_S[0-9]+_R[12](_001)?\\.f(ast)?q(\\.gz)?$') THEN regexp_extract(name, '^(.+?)_S[0-9]+_R[12](_001)?\\.f(ast)?q(\\.gz)?$', 1)
         WHEN regexp_matches(name, '^.+?_R[12](_001)?\\.f(ast)?q(\\.gz)?$') THEN regexp_extract(name, '^(.+?)_R[12](_001)?\\.f(ast)?q(\\.gz)?$', 1)
         WHEN regexp_matches(name, '^.+?_r[12](_001)?\\.f(ast)?q(\\.gz)?$') THEN regexp_extract(name, '^(.+?)_r[12](_001)?\\.f(ast)?q(\\.gz)?$', 1)
         WHEN regexp_matches(name, '^.+?\\.[Rr][12]\\.f(ast)?q(\\.gz)?$') THEN regexp_extract(name, '^(.+?)\\.[Rr][12]\\.f(ast)?q(\\.gz)?$', 1)
         WHEN regexp_matches(name, '^.+?_[FR]\\.f(ast)?q(\\.gz)?$') THEN regexp_extract(name, '^(.+?)_[FR]\\.f(ast)?q(\\.gz)?$', 1)
         ELSE split_part(name, '.', 1) END AS sample
  FROM named),
pairs AS (
  SELECT sample, max_by(path, (ext, path)) FILTER (mate = 'R1') AS r1, max_by(path, (ext, path)) FILTER (mate = 'R2') AS r2
  FROM ids WHERE mate IS NOT NULL GROUP BY sample)"""

CONTIGS = f"""
contigs AS (SELECT source AS sample, doc_id::VARCHAR AS contig_id, seq FROM (SELECT source, doc_id, {_dna('text')} AS seq FROM documents) WHERE seq <> '')"""

READS = f"""
dnas AS (SELECT * FROM (SELECT doc_id, source, {_dna('text')} AS seq FROM documents) WHERE seq <> ''),
pieces AS (
  SELECT doc_id, source, i, substr(seq, i * {v.PIECE} + 1, {v.PIECE}) AS base
  FROM (SELECT doc_id, source, seq, unnest(range(0, (length(seq) - 1) // {v.PIECE} + 1)) AS i FROM dnas)),
reads AS (
  SELECT source AS sample, doc_id || '_' || (i // 2) AS pair_id, (i % 2 + 1)::INTEGER AS mate,
    array_to_string(list_transform(range(1, length(base) + 1), lambda p: CASE WHEN p % (7 + (doc_id + i) % 50) = 0 THEN 'N' ELSE substr(base, p, 1) END), '') AS seq,
    array_to_string(list_transform(range(1, length(base) + 1), lambda p:
      chr((33 + greatest(2, 40 - (p * (doc_id % 6)) // 10 - (p * 7 + ascii(substr(base, p, 1))) % 9))::INTEGER)), '') AS qual
  FROM pieces)"""

TRIM = READS + """,
quals AS (SELECT *, list_transform(range(1, length(qual) + 1), lambda p: ascii(substr(qual, p, 1)) - 33) AS q FROM reads),
kept AS (
  SELECT *, CASE WHEN length(qual) < 10 THEN 0 ELSE
    coalesce(list_max(list_filter(range(1, length(qual) - 8), lambda i: list_sum(q[i:i + 9]) >= 200)) + 9, 0) END AS keep FROM quals),
trimmed AS (SELECT sample, pair_id, mate, substr(seq, 1, keep) AS seq, substr(qual, 1, keep) AS qual, q[1:keep] AS q FROM kept)"""

BASES = READS + """,
spread AS (SELECT sample, mate, qual, seq, unnest(range(1, length(seq) + 1)) AS pos FROM reads),
bases AS (SELECT sample, mate, pos, substr(seq, pos, 1) AS b FROM spread)"""


def _low(q: str) -> str:
    return f"len(list_filter({q}, lambda x: x < 15)) * 100 > len({q}) * 40"


def _many_n(seq: str) -> str:
    return f"length({seq}) - length(replace({seq}, 'N', '')) > 5"


JUDGED = TRIM + f""",
judged AS (
  SELECT *, CASE WHEN length(seq) = 0 THEN 'too_short' WHEN {_low('q')} THEN 'low_quality' WHEN {_many_n('seq')} THEN 'too_many_n'
    WHEN length(seq) < 50 THEN 'too_short' ELSE 'passed' END AS verdict,
    sum(CASE WHEN verdict = 'passed' THEN 1 ELSE 0 END) OVER (PARTITION BY sample, pair_id) = 2 AS survives
  FROM trimmed),
sides AS (
  SELECT k.sample, count(*) AS reads_before, sum(length(k.seq)) AS bases_before,
    sum(len(list_filter(k.q, lambda x: x >= 20))) AS q20b, sum(len(list_filter(k.q, lambda x: x >= 30))) AS q30b
  FROM kept k GROUP BY k.sample),
afters AS (
  SELECT sample, count(*) FILTER (survives) AS reads_after, coalesce(sum(length(seq)) FILTER (survives), 0) AS bases_after,
    sum(len(list_filter(q, lambda x: x >= 20))) FILTER (survives) AS q20a, sum(len(list_filter(q, lambda x: x >= 30))) FILTER (survives) AS q30a,
    count(*) FILTER (verdict = 'passed') AS passed, count(*) FILTER (verdict = 'low_quality') AS low_quality,
    count(*) FILTER (verdict = 'too_many_n') AS too_many_n, count(*) FILTER (verdict = 'too_short') AS too_short
  FROM judged GROUP BY sample),
summary AS (
  SELECT sample, reads_before::BIGINT AS reads_before, bases_before::BIGINT AS bases_before, round(q20b / bases_before, 6) AS q20_rate_before,
    round(q30b / bases_before, 6) AS q30_rate_before, reads_after::BIGINT AS reads_after, bases_after::BIGINT AS bases_after,
    round(q20a / nullif(bases_after, 0), 6) AS q20_rate_after, round(q30a / nullif(bases_after, 0), 6) AS q30_rate_after,
    passed, low_quality, too_many_n, too_short
  FROM sides JOIN afters USING (sample))"""

COPIES = """
copies AS (SELECT sample, mate, seq, count(*) AS copies FROM reads GROUP BY ALL),
levels AS (SELECT sample, mate, copies, count(*) AS sequences, (copies * count(*))::BIGINT AS reads FROM copies GROUP BY sample, mate, copies),
shares AS (SELECT sample, mate, round(sum(sequences) * 100.0 / sum(reads), 6)::DOUBLE AS pct_left FROM levels GROUP BY sample, mate)"""


def _stats(minimum: int) -> str:
    ranked = f"""
used AS (
  SELECT sample, contig_id, length(seq) AS len, row_number() OVER w AS rank, sum(length(seq)) OVER w AS upto, sum(length(seq)) OVER (PARTITION BY sample) AS total
  FROM contigs WHERE length(seq) >= {minimum}
  WINDOW w AS (PARTITION BY sample ORDER BY length(seq) DESC, contig_id)),
stats0 AS (
  SELECT sample, count(*) AS contigs, max(total)::BIGINT AS total_length, max(len)::BIGINT AS largest,
    max(len) FILTER (upto * 100 >= total * 50)::BIGINT AS n50, min(rank) FILTER (upto * 100 >= total * 50)::BIGINT AS l50,
    max(len) FILTER (upto * 100 >= total * 90)::BIGINT AS n90, min(rank) FILTER (upto * 100 >= total * 90)::BIGINT AS l90
  FROM used GROUP BY sample),
content AS (
  SELECT sample, sum(length(seq) - length(translate(seq, 'GC', ''))) AS gc, sum(length(seq) - length(translate(seq, 'ACGT', ''))) AS acgt,
    sum(length(seq) - length(translate(seq, 'N', ''))) AS nb FROM contigs WHERE length(seq) >= {minimum} GROUP BY sample),
thresholds AS (
  SELECT sample, {', '.join(f"count(*) FILTER (length(seq) >= {t}) AS contigs_{t}" for t in (0, 1000, 5000, 10000, 25000, 50000))}
  FROM contigs GROUP BY sample)"""
    return ranked + f""",
stats AS (
  SELECT sample, coalesce(contigs, 0)::BIGINT AS contigs, coalesce(total_length, 0)::BIGINT AS total_length, largest, n50, l50, n90, l90,
    round(gc * 100.0 / acgt, 6)::DOUBLE AS gc_percent, round(nb * 100000.0 / total_length, 6)::DOUBLE AS n_per_100kb,
    {', '.join(f"contigs_{t}" for t in (0, 1000, 5000, 10000, 25000, 50000))}
  FROM thresholds LEFT JOIN stats0 USING (sample) LEFT JOIN content USING (sample))"""


_FILTER_METRICS = [n for n in OVERVIEW if n.endswith(("_before", "_after"))]
METRICS = JUDGED + "," + COPIES + "," + CONTIGS + "," + _stats(0) + f""",
metrics AS (
  {' UNION ALL '.join(f"SELECT sample, 'filter' AS stage, '{m}' AS metric, {m}::DOUBLE AS value FROM summary" for m in _FILTER_METRICS)}
  UNION ALL {' UNION ALL '.join(f"SELECT sample, 'assembly', '{m}', {m}::DOUBLE FROM stats" for m in ("contigs", "total_length", "n50", "gc_percent"))}
  UNION ALL SELECT sample, 'duplication', 'pct_left_r' || m, max(pct_left) FILTER (mate = m) FROM shares, (SELECT unnest([1, 2]) AS m) GROUP BY sample, m)"""


def _mutated(col: str, every: int) -> str:
    return (
        f"array_to_string(list_transform(range(1, length({col}) + 1), lambda p: CASE WHEN p % {every} = 0"
        f" THEN translate(substr({col}, p, 1), 'ACGT', 'TGCA') ELSE substr({col}, p, 1) END), '')"
    )


ALLELES = f"""
library AS (SELECT item_id, {_dna('text')} AS g FROM benchmark WHERE {_dna('text')} <> ''),
alleles AS (
  SELECT CASE WHEN item_id % {v.LOCI} < {v.FIRST_SCHEME_LOCI} THEN 's1' ELSE 's2' END AS scheme, 'loc' || (item_id % {v.LOCI}) AS locus,
    item_id::VARCHAR AS allele, g AS seq FROM library)"""

TYPING = CONTIGS + "," + ALLELES + f""",
changed AS (
  SELECT item_id, item_id // {v.LOCI} AS grp, CASE
    WHEN item_id // {v.LOCI} % 4 = 1 AND item_id % {v.LOCI} = 3 THEN {_mutated('g', 25)}
    WHEN item_id // {v.LOCI} % 4 = 2 AND item_id % {v.LOCI} = 5 THEN substr(g, 1, length(g) * 2 // 5)
    WHEN item_id // {v.LOCI} % 4 = 3 AND item_id % {v.LOCI} = 2 THEN '' ELSE g END AS body FROM library),
typed_contigs AS (
  SELECT * FROM contigs
  UNION ALL SELECT 'plant' || grp, 'p' || item_id, CASE WHEN item_id % 2 = 1 THEN {_rc("('ACCA' || body || 'TGGT')")} ELSE 'ACCA' || body || 'TGGT' END FROM changed
  UNION ALL SELECT 'plant' || (item_id // {v.LOCI} - 1), 'x' || item_id, g FROM library
    WHERE item_id // {v.LOCI} % 4 = 0 AND item_id >= {v.LOCI} AND item_id % {v.LOCI} = 6),
exact AS (
  SELECT DISTINCT sample, contig_id, scheme, locus, allele FROM typed_contigs c JOIN alleles a ON contains(c.seq, a.seq) OR contains(c.seq, {_rc('a.seq')}))"""


def _screen(contigs: str, genes: str, coverage: float, identity: float, k: int = SCREEN_K) -> str:
    """Same definition in SQL: two shared k-mers on one diagonal, then coverage and identity of the overlap."""
    return f"""
strands AS (SELECT gene, '+' AS strand, seq FROM {genes} UNION ALL SELECT gene, '-', {_rc('seq')} FROM {genes}),
seeds AS (SELECT gene, strand, p AS gene_pos, substr(seq, p, {k}) AS kmer FROM (SELECT *, unnest(range(1, length(seq) - {k} + 2)) AS p FROM strands)),
parts AS (
  SELECT sample, contig_id, o, substr(seq, o + 1, {200 + k - 1}) AS part FROM (SELECT *, unnest(range(0, length(seq), 200)) AS o FROM {contigs})),
places AS (
  SELECT sample, contig_id, o + p AS pos, substr(part, p, {k}) AS kmer
  FROM (SELECT *, unnest(range(1, least(200, length(part) - {k} + 1) + 1)) AS p FROM parts WHERE length(part) >= {k})),
diagonals AS (
  SELECT sample, contig_id, gene, strand, pos - gene_pos AS diag FROM places JOIN seeds USING (kmer) GROUP BY ALL HAVING count(*) >= 2),
laps AS (
  SELECT d.*, s.seq AS g, c.seq AS c, greatest(1, 1 - diag) AS b, least(length(s.seq), length(c.seq) - diag) AS e
  FROM diagonals d JOIN strands s USING (gene, strand) JOIN {contigs} c USING (sample, contig_id)),
cut AS (
  SELECT sample, contig_id, gene, strand, b + diag AS s0, e - b + 1 AS n, length(g) AS size, substr(g, b, e - b + 1) AS x, substr(c, b + diag, e - b + 1) AS y
  FROM laps WHERE e - b + 1 >= length(g) * {coverage}::DOUBLE),
scored AS (SELECT *, n - hamming(x, y) AS same FROM cut),
hits AS (
  SELECT sample, contig_id, gene, strand, s0::BIGINT AS start, (s0 + n - 1)::BIGINT AS "end", round(n / size, 6) AS coverage, round(same / n, 6) AS identity
  FROM scored WHERE same >= n * {identity}::DOUBLE)"""


STATUS = TYPING + """,
probes AS (SELECT scheme || '/' || locus || '/' || allele AS gene, seq FROM alleles),""" + _screen("typed_contigs", "probes", 0.1, 0.95) + """,
near AS (
  SELECT sample, split_part(gene, '/', 1) AS scheme, split_part(gene, '/', 2) AS locus, split_part(gene, '/', 3) AS allele, coverage, identity FROM hits),
cells AS (
  SELECT DISTINCT s.sample, s.scheme, l.locus FROM (SELECT sample, scheme FROM exact UNION SELECT sample, scheme FROM near) s
  JOIN (SELECT DISTINCT scheme, locus FROM alleles) l ON s.scheme = l.scheme),
found AS (
  SELECT sample, scheme, locus,
    (SELECT string_agg(allele, ',' ORDER BY allele::BIGINT) FROM (SELECT DISTINCT allele FROM exact x WHERE x.sample = c.sample AND x.locus = c.locus AND x.scheme = c.scheme)) AS ex,
    (SELECT count(DISTINCT allele) FROM exact x WHERE x.sample = c.sample AND x.locus = c.locus AND x.scheme = c.scheme) AS n,
    (SELECT first(allele ORDER BY identity DESC, coverage DESC, allele::BIGINT) FROM near x WHERE x.sample = c.sample AND x.locus = c.locus AND x.scheme = c.scheme AND coverage >= 1) AS nov,
    (SELECT first(allele ORDER BY identity DESC, coverage DESC, allele::BIGINT) FROM near x WHERE x.sample = c.sample AND x.locus = c.locus AND x.scheme = c.scheme AND coverage < 1) AS par
  FROM cells c),
status AS (
  SELECT sample, scheme, locus, CASE WHEN n > 0 THEN ex WHEN nov IS NOT NULL THEN '~' || nov WHEN par IS NOT NULL THEN par || '?' ELSE '-' END AS status,
    CASE WHEN n = 1 THEN 'exact' WHEN n > 1 THEN 'several' WHEN nov IS NOT NULL THEN 'novel' WHEN par IS NOT NULL THEN 'partial' ELSE 'none' END AS state
  FROM found)"""

_WIDE = ", ".join(f"max(item_id) FILTER (item_id % {v.LOCI} = {i}) AS loc{i}" for i in range(v.LOCI))
PROFILES = f"""
groups AS (SELECT item_id // {v.LOCI} AS grp, {_WIDE} FROM benchmark GROUP BY 1 HAVING count(*) = {v.LOCI}),
wide AS (
  SELECT (grp + 1)::VARCHAR AS st, [{', '.join(f"loc{i}" for i in range(v.LOCI))}] AS ids FROM groups
  UNION ALL SELECT (grp + 100001)::VARCHAR, [{', '.join(f"loc{i} + {v.LOCI if i % 2 == 0 else 0}" for i in range(v.LOCI))}] FROM groups),
profiles AS (
  SELECT CASE WHEN i < {v.FIRST_SCHEME_LOCI} THEN 's1' ELSE 's2' END AS scheme, st, 'loc' || i AS locus, ids[i + 1]::VARCHAR AS allele
  FROM wide, (SELECT unnest(range(0, {v.LOCI})) AS i))"""

TYPES = STATUS + "," + PROFILES + """,
known AS (SELECT scheme, st, string_agg(locus || '=' || allele, ';' ORDER BY locus) AS profile FROM profiles GROUP BY scheme, st),
keyed AS (SELECT sample, scheme, bool_and(state = 'exact') AS clear, string_agg(locus || '=' || status, ';' ORDER BY locus) AS profile FROM status GROUP BY sample, scheme),
types AS (
  SELECT k.sample, k.scheme, coalesce(min(n.st), '-') AS st FROM keyed k LEFT JOIN known n ON k.scheme = n.scheme AND k.profile = n.profile AND k.clear GROUP BY 1, 2)"""

SCREEN = CONTIGS + "," + ALLELES + f""",
genes AS (SELECT 'gene' || allele AS gene, seq FROM alleles),
screened AS (
  SELECT * FROM contigs UNION ALL
  SELECT 'copy' || item_id, 'q' || item_id, CASE WHEN item_id % 2 = 1 THEN {_rc('body')} ELSE body END FROM (SELECT item_id, 'ACCA' || {_mutated('g', 15)} || 'TGGT' AS body FROM library)),
""" + _screen("screened", "genes", 0.6, 0.8)

_K = v.TAXON_K


def _kmers(table: str, keep: str) -> str:
    return (
        f"(SELECT {keep}, least(w, {_rc('w')}) AS kmer FROM (SELECT {keep}, substr(part, p, {_K}) AS w FROM (SELECT *, unnest(range(1, least(200, length(part) - {_K} + 1) + 1)) AS p FROM"
        f" (SELECT *, substr(seq, o + 1, {200 + _K - 1}) AS part FROM (SELECT *, unnest(range(0, length(seq), 200)) AS o FROM {table})) WHERE length(part) >= {_K})))"
    )


TAXA = f"""
genomes AS (
  SELECT (ascii(lang) * 1000 + ascii(substr(lang, 2, 1)))::BIGINT AS l1,
    (ascii(lang) * 1000 + ascii(substr(lang, 2, 1)))::BIGINT * 100000 + regexp_extract(source, '([0-9]+)', 1)::BIGINT AS l2, {_dna('text')} AS seq FROM documents),
table0 AS (
  SELECT kmer, CASE WHEN min(l1) = max(l1) THEN min(l1) END AS l1, CASE WHEN min(l2) = max(l2) THEN min(l2) END AS l2 FROM {_kmers('genomes', 'l1, l2')} GROUP BY kmer),
turns AS (
  SELECT 'C' || (conv_id % 12) AS sample, conv_id || '_' || (turn // 2) AS read_id, turn % 2 + 1 AS mate, {_dna('text')} AS seq FROM conversations),
hits AS (SELECT sample, read_id, l1, l2, count(*) AS n FROM {_kmers('turns', 'sample, read_id')} JOIN table0 USING (kmer) GROUP BY ALL),
weighed AS (
  SELECT h.*, (SELECT sum(n) FROM hits x WHERE x.sample = h.sample AND x.read_id = h.read_id
      AND (x.l1 IS NULL OR x.l1 = h.l1) AND (x.l2 IS NULL OR x.l2 = h.l2)) AS weight
  FROM hits h),
tops AS (SELECT *, max(weight) OVER (PARTITION BY sample, read_id) AS top FROM weighed),
votes AS (
  SELECT sample, read_id, max(top) AS support, CASE WHEN min(coalesce(l1, -1)) = max(coalesce(l1, -1)) THEN min(l1) END AS l1,
    CASE WHEN min(coalesce(l1, -1)) = max(coalesce(l1, -1)) AND min(coalesce(l2, -1)) = max(coalesce(l2, -1)) THEN min(l2) END AS l2
  FROM tops WHERE weight = top GROUP BY sample, read_id),
called AS (
  SELECT r.sample, r.read_id, CASE WHEN v.support IS NULL THEN 'U' ELSE 'C' END AS status, r.length, coalesce(v.support, 0)::BIGINT AS support, v.l1, v.l2
  FROM (SELECT sample, read_id, sum(length(seq))::BIGINT AS length FROM turns GROUP BY 1, 2) r LEFT JOIN votes v USING (sample, read_id))"""
_TAXON = "'root' || coalesce('|' || l1, '') || coalesce('|' || l2, '') AS taxon"

# --- queries --------------------------------------------------------------------------------------------------------

ORACLE: dict[str, str] = {}


def _q(name: str, ctes: str, body: str) -> None:
    ORACLE[name] = (f"WITH {ctes.strip()}\n" if ctes else "") + body


_SHEET_OUT = {
    "CODIGO_MUESTRA_ORIGEN": "id", "PETICION": "id2", "FECHA_TOMA_MUESTRA": "collection_date", "ESPECIE_SECUENCIA": "organism", "MOTIVO_WGS": "relevance",
    "NUM_BROTE": "outbreak_id", "CONFIRMACION": "confirmation_note", "COMENTARIO_WGS": "comment", "ILLUMINA_R1": "illumina_r1", "ILLUMINA_R2": "illumina_r2", "NANOPORE": "nanopore",
}
_q("scan_sheet", SHEET, "SELECT " + ", ".join(f'{_null(c)} AS "{n}"' for n, c in _SHEET_OUT.items()) + " FROM sheet")
_q("sheet_row_number", SHEET, f"SELECT run, (row_number() OVER (PARTITION BY run, k // {ROWS_PER_CHUNK} ORDER BY k) + 1)::BIGINT AS row_no, id, comment FROM sheet")
_q("null_tokens", f"t AS (SELECT o_orderkey, {_list(TEXT_TOKENS)}[o_orderkey % {len(TEXT_TOKENS)} + 1] AS cell, o_orderpriority FROM orders)",
   f"SELECT o_orderkey, {_null('cell')} AS cell, CASE WHEN o_orderkey % 2 = 0 THEN {_null('cell')} ELSE o_orderpriority END AS other FROM t")
_q("scan_fastq_inventory",
   f"t AS (SELECT DISTINCT source || '_' || (doc_id // {DOCS_PER_CHUNK}) || {_list(READ_ENDINGS)}[regexp_extract(source, '([0-9]+)', 1)::INTEGER % {len(READ_ENDINGS)} + 1] AS name FROM documents)",
   "SELECT name, CASE WHEN name LIKE '%.fastq.gz' THEN 0 WHEN name LIKE '%.fastq' THEN 1 WHEN name LIKE '%.fq.gz' THEN 2 ELSE 3 END::BIGINT AS ext_rank FROM t"
   " WHERE regexp_matches(name, '[.](fastq|fq)([.]gz)?$')")
for _name in ("scan_fastq", "scan_fastq_plain"):
    _q(_name, READS, "SELECT sample, pair_id || '/' || mate AS read_id, seq, qual FROM reads")
_q("scan_fasta", CONTIGS, "SELECT sample, contig_id AS id, contig_id || ' from ' || sample AS description, length(seq)::BIGINT AS bases, md5(seq) AS digest FROM contigs")
# Fixed values, written out here so that the SQL doesn't rest on the code it checks.
_MADE_FROM = (
    "fastqc_trim<trimmed counts<trimmed assembly<trimmed quast<assembly annotation<assembly amrfinder<assembly amrfinder<annotation "
    "mlst<assembly resfinder<assembly multiqc<fastqc_raw multiqc<fastqc_trim multiqc<quast summary<amrfinder summary<mlst "
    "summary<resfinder lab<summary deposit<summary deposit<lab"
)
ORACLE["resume_plan"] = "WITH RECURSIVE " + SHEET.strip() + f""",
edges AS (SELECT split_part(e, '<', 1) AS stage, split_part(e, '<', 2) AS part FROM (SELECT unnest(string_split('{_MADE_FROM}', ' ')) AS e)),
closure AS (SELECT part AS origin, stage FROM edges UNION SELECT c.origin, e.stage FROM closure c JOIN edges e ON e.part = c.stage),
samples AS (SELECT run, row_no, id2 || '_' || row_no AS sample FROM sheet WHERE illumina_r2 IS NOT NULL AND trim(id2) <> '' AND id IS NOT NULL),
gone AS (
  SELECT run, sample, 'trimmed' AS stage FROM samples WHERE row_no % 97 = 5 UNION ALL SELECT run, sample, 'assembly' FROM samples WHERE row_no % 89 = 7
  UNION ALL SELECT run, sample, 'annotation' FROM samples WHERE row_no % 83 = 11
  UNION ALL SELECT run, sample, unnest(['mlst', 'fastqc_raw']) FROM samples WHERE row_no % 79 = 13
  UNION ALL SELECT DISTINCT run, NULL, 'summary' FROM samples WHERE right(run, 1) = '3'),
rows AS (
  SELECT *, 0 AS rank FROM gone
  UNION ALL SELECT g.run, CASE WHEN c.stage NOT IN ('multiqc', 'summary', 'lab', 'deposit') THEN g.sample END, c.stage, 1 FROM gone g JOIN closure c ON c.origin = g.stage)
SELECT run, sample, stage, CASE WHEN min(rank) = 0 THEN 'missing' ELSE 'follows' END AS reason FROM rows GROUP BY run, sample, stage"""
_q("scan_alleles", ALLELES, "SELECT DISTINCT scheme, locus, allele, seq FROM alleles")
_q("scan_profiles", PROFILES, "SELECT scheme, st, locus, allele FROM profiles")
_HITS_OF = ' JOIN (SELECT sample AS "Sample", count(*) AS hits FROM hits GROUP BY 1) n USING ("Sample")'
_q("scan_amr_hits", HITS, "SELECT * FROM amr" + _HITS_OF)
_q("scan_mlst_calls", MLST, "SELECT sample, scheme, st, array_to_string(alleles, ',') AS alleles FROM calls")
_q("scan_resistance_genes", HITS, "SELECT * FROM genes_of" + _HITS_OF)
_q("scan_pheno", HITS, "SELECT * FROM pheno_of" + _HITS_OF)
_q("scan_counts", READS, "SELECT sample, count(*) AS reads FROM reads GROUP BY sample")

_GFF = f"""
gff0 AS (
  SELECT 'F' || l_suppkey AS file, 'F' || l_suppkey || '.' || lpad((l_orderkey // {ROWS_PER_CHUNK})::VARCHAR, 9, '0') || '.gff' AS part, l_orderkey, l_linenumber, l_partkey,
    CASE WHEN l_orderkey % 1000 = 999 THEN '##FASTA' WHEN l_orderkey % 3 = 0 THEN 'c' || l_partkey || chr(9) || 'Name=q' || l_linenumber || ';note=' || l_orderkey
    ELSE 'c' || l_partkey || chr(9) || 'x' || chr(9) || 'CDS' || chr(9) || l_linenumber || chr(9) || l_partkey || chr(9) || '.' || chr(9) || '+' || chr(9)
      || '0' || chr(9) || 'ID=g' || l_orderkey || ';name=n' || l_partkey || ';Name=m' || l_linenumber || ';product=ID=z' END AS value FROM lineitem),
gff AS (
  SELECT *, row_number() OVER (PARTITION BY {{by}} ORDER BY l_orderkey, l_linenumber, l_partkey) AS line_no FROM gff0),
ends AS (SELECT {{by}}, min(line_no) AS stop FROM gff WHERE value = '##FASTA' GROUP BY 1)"""
_q("scan_gff", _GFF.format(by="part"), "SELECT g.part AS file, line_no, value FROM gff g LEFT JOIN ends e ON g.part = e.part WHERE stop IS NULL OR line_no < stop")
_q("gff_rewrite", _GFF.format(by="file"),
   "SELECT g.file, CASE WHEN l_orderkey % 3 = 0 THEN replace(value, 'Name=', 'OldName=')"
   " ELSE replace(regexp_replace(value, ';name=', ';OldName='), 'ID=g' || l_orderkey || ';', 'ID=g' || l_orderkey || ';Name=g' || l_orderkey || ';') END AS value"
   " FROM gff g LEFT JOIN ends e ON g.file = e.file WHERE stop IS NULL OR line_no < stop")

_q("validation_issues", ISSUES, "SELECT * FROM issues")
_MIXED = SHEET.replace(
    "SELECT run AS sheet, run, k + 2 AS row_no",
    f"SELECT run || '.' || (k // {ROWS_PER_CHUNK}) AS sheet, run, row_number() OVER (PARTITION BY run, k // {ROWS_PER_CHUNK} ORDER BY k) + 1 AS row_no, right(run, 1)::INT % 4 AS kind",
) + ISSUES.removeprefix(SHEET).replace("q.code IS NULL)", "q.code IS NULL AND kind <> 2)").replace(
    "named WHERE relevance", "named WHERE kind <> 3 AND (relevance").replace("trim(relevance) = ''", "trim(relevance) = '')").replace(
    "named WHERE collection_date", "named WHERE kind <> 3 AND (collection_date").replace("trim(collection_date) = ''", "trim(collection_date) = '')").replace(
    "usable WHERE collection_date", "usable WHERE kind <> 3 AND collection_date").replace("issues0 AS (\n  SELECT run AS sheet, 3 AS severity, 0 AS row_no, 'run' AS column_name, code, run AS detail FROM verdicts WHERE code IS NOT NULL", """issues0 AS (
  SELECT DISTINCT sheet, 3 AS severity, 0 AS row_no, 'run' AS column_name, code, run AS detail FROM sheet JOIN verdicts USING (run) WHERE code IS NOT NULL
  UNION ALL SELECT DISTINCT sheet, 3, 0, 'header', 'COLUMNS_REQUIRED', 'CODIGO_MUESTRA_ORIGEN' FROM sheet JOIN verdicts USING (run) WHERE code IS NULL AND kind = 2
  UNION ALL SELECT DISTINCT sheet, 2, 0, 'header', 'COLUMNS_IMPORTANT', 'FECHA_TOMA_MUESTRA, MOTIVO_WGS' FROM sheet JOIN verdicts USING (run) WHERE code IS NULL AND kind = 3
  UNION ALL SELECT sheet, 1, row_no, 'organism', 'ORGANISM_UNKNOWN', organism FROM usable WHERE organism = '""" + v.SPECIES[0] + "'")
_q("validation_mixed_sheets", _MIXED, "SELECT sheet, severity, row_no, column_name, code, CASE WHEN code = 'FILE_MISSING' THEN substr(detail, 4) ELSE detail END AS detail FROM issues")
_q("validation_status", ISSUES, "SELECT s.sheet, coalesce(max(severity), 0)::BIGINT AS status FROM (SELECT DISTINCT sheet FROM sheet) s LEFT JOIN issues i ON s.sheet = i.sheet GROUP BY s.sheet")
_q("validation_report", ISSUES, """
SELECT sheet, 3 - severity AS section, CASE code WHEN 'RUN_NAME_FORMAT' THEN 0 WHEN 'HOSPITAL_UNKNOWN' THEN 0 WHEN 'BLANK' THEN 2 WHEN 'NO_DATA_SOURCE' THEN 2 WHEN 'ID_MISSING' THEN 3
    WHEN 'ID_CHARACTERS' THEN 4 WHEN 'FILE_MISSING' THEN CASE column_name WHEN 'illumina_r1' THEN 5 WHEN 'illumina_r2' THEN 6 ELSE 7 END WHEN 'DATE_INVALID' THEN 8 ELSE 9 END::BIGINT AS "check", row_no,
  CASE code
    WHEN 'RUN_NAME_FORMAT' THEN 'The run_name format ''' || detail || ''' is invalid for GVA mode. It must follow the format AAMMDD_HOSPXXX'
    WHEN 'HOSPITAL_UNKNOWN' THEN 'Invalid hospital code in ''' || detail || ''''
    WHEN 'NO_DATA_SOURCE' THEN 'Error in row ' || row_no || ': No data source specified (illumina_r1 or nanopore)'
    WHEN 'ID_MISSING' THEN 'Rows without a value in the identification column: [' || row_no || ']'
    WHEN 'ID_CHARACTERS' THEN 'Error in row ' || row_no || ': ID ''' || detail || ''' contains invalid special characters'
    WHEN 'FILE_MISSING' THEN 'The file ' || detail || ' in column ' || column_name || ', row ' || row_no || ' does not exist'
    WHEN 'DATE_INVALID' THEN 'Error in row ' || row_no || ': Invalid date format: ''' || detail || ''''
    WHEN 'MODEL_INVALID' THEN 'Invalid Dorado model ''' || detail || ''''
    ELSE CASE column_name WHEN 'id2' THEN 'Error in row ' || row_no || ': PETICION not specified' WHEN 'organism' THEN 'Error in row ' || row_no || ': ESPECIE_SECUENCIA/organism not specified'
      WHEN 'relevance' THEN 'Error in row ' || row_no || ': MOTIVO_WGS/relevance not specified' ELSE 'Warning in row ' || row_no || ': FECHA_TOMA_MUESTRA/collection_date not specified' END END AS line
FROM issues
UNION ALL SELECT DISTINCT sheet, 3 - severity, -1, 0, CASE severity WHEN 3 THEN '===== FATAL ERRORS =====' WHEN 2 THEN '===== ERRORS =====' ELSE '===== WARNINGS =====' END FROM issues
UNION ALL SELECT DISTINCT sheet, 3 - severity, 99, 0, '' FROM issues""")
_q("write_validated", ISSUES, "SELECT " + ", ".join(f"{_null(c)} AS {c}" for c in ("id", "id2")) + ", "
   + _null("coalesce(strftime(day, '%Y-%m-%d'), collection_date)") + " AS collection_date, "
   + ", ".join(f"{_null(c)} AS {c}" for c in ("organism", "relevance", "outbreak_id", "illumina_r1", "illumina_r2", "nanopore")) + " FROM usable")
_q("write_report_tsv", REPORT, 'SELECT "Sample", "Scheme_mlst", "ST", ' + ", ".join(f"nullif(\"{c}\", '') AS \"{c}\"" for c in ("MLST", "AMR", "VIRULENCE", "SCOPE_core", "GENE_resfinder", "PHENO_resfinder")) + " FROM report")

_SHEET_TEMPLATE = ", ".join(f"'' AS \"{c}\"" for c in ("PETICION", "FECHA_TOMA_MUESTRA", "ESPECIE_SECUENCIA", "MOTIVO_WGS", "NUM_BROTE", "CONFIRMACION", "COMENTARIO_WGS", "NANOPORE"))
_q("sheet_template", FILES, f'SELECT sample AS "CODIGO_MUESTRA_ORIGEN", {_SHEET_TEMPLATE}, r1 AS "ILLUMINA_R1", r2 AS "ILLUMINA_R2" FROM pairs WHERE r1 IS NOT NULL AND r2 IS NOT NULL')
_q("sheet_template_long_reads", FILES, "SELECT long_id AS id, '' AS collection_date, '' AS organism, '' AS illumina_r1, '' AS illumina_r2, max_by(path, (ext, path)) AS nanopore FROM ids GROUP BY long_id")
_q("last_wins", FILES, "SELECT long_id AS sample, max_by(path, (ext, path)) AS nanopore FROM ids GROUP BY long_id")
_q("illumina_sample_id", FILES, "SELECT path, sample FROM ids")
_q("nanopore_sample_id", FILES, "SELECT path, long_id AS sample FROM ids")
_q("mate_role", FILES, "SELECT path, coalesce(mate, 'none') AS mate FROM ids")
_q("paired_mates", FILES, "SELECT sample, r1, r2 FROM pairs")
_q("incomplete_pairs", FILES, "SELECT sample, CASE WHEN r1 IS NULL THEN 'R1' ELSE 'R2' END AS missing FROM pairs WHERE r1 IS NULL OR r2 IS NULL")
_q("checksum_manifest", "", f"SELECT md5(string_agg(text, chr(10) ORDER BY doc_id) || chr(10)) || '  ' || lang || '/' || source || '_' || (doc_id // {DOCS_PER_CHUNK}) || '.txt' AS value"
   f" FROM documents GROUP BY lang, source, doc_id // {DOCS_PER_CHUNK}")
_q("qc_metrics_sink", METRICS, "SELECT sample, stage, metric, value FROM metrics")
_q("qc_overview", METRICS, "SELECT sample, " + ", ".join(f"max(value) FILTER (metric = '{m}') AS {m}" for m in OVERVIEW) + " FROM metrics GROUP BY sample")

_q("run_name_check", ISSUES, "SELECT s.run, count(*) AS samples, substr(split_part(s.run, '_', 2), 1, 4) AS hospital, coalesce(max(q.code), 'OK') AS verdict FROM sheet s JOIN verdicts q ON s.run = q.run GROUP BY s.run")
_q("rename_internal", SHEET, "SELECT row_no, " + ", ".join(_SHEET_OUT.values()) + " FROM sheet")
_RAW_BLANKS = ISSUES.replace("named AS (SELECT d.* FROM dated d JOIN verdicts q ON d.run = q.run AND q.code IS NULL)", "named AS (SELECT * FROM dated)")
_q("blank_field_issues", _RAW_BLANKS, "SELECT sheet, severity::BIGINT AS severity, row_no, column_name, code, detail::VARCHAR AS detail FROM blanks")
_q("missing_ids", _RAW_BLANKS, "SELECT sheet, row_no, code FROM noid")
_q("id_charset", "t AS (SELECT c_custkey, ['ñ', 'a b', 'a.b', 'a_b-', 'Ü#', 'x/'][c_custkey % 6 + 1] || c_custkey AS id FROM customer)",
   "SELECT c_custkey AS row_no, 'ID_CHARACTERS' AS code, id AS detail FROM t WHERE regexp_matches(id, '[^\\p{L}\\p{N}_-]')")
_q("missing_files", SHEET, """SELECT sheet, 1::BIGINT AS severity, row_no, col AS column_name, 'FILE_MISSING' AS code, p AS detail FROM (
    SELECT sheet, row_no, unnest(['illumina_r1', 'illumina_r2', 'nanopore']) AS col, unnest([illumina_r1, illumina_r2, nanopore]) AS p FROM sheet)
    WHERE p IS NOT NULL AND p NOT IN (SELECT path FROM stored)""")
_q("normalise_date", SHEET, "SELECT row_no, collection_date AS written, strftime(day, '%Y-%m-%d') AS parsed, coalesce(strftime(day, '%Y-%m-%d'), collection_date) AS kept FROM dated")
_q("date_issues", SHEET, "SELECT sheet, row_no, 'DATE_INVALID' AS code, collection_date AS detail FROM dated WHERE collection_date <> '' AND day IS NULL")
_q("model_check", SHEET, f"SELECT sheet, 2::BIGINT AS severity, 'MODEL_INVALID' AS code, '{MODEL}' AS detail FROM sheet GROUP BY sheet HAVING count(nanopore) > 0")
_q("sanitize_id", "", "SELECT c_custkey, translate(c_name || ' .' || c_mktsegment || ' .' || 'x,y-' || c_custkey, ' .,-', '____') AS clean FROM customer")
_q("organism_lookup", "s AS (SELECT p_name, max(p_size)::BIGINT AS g FROM part WHERE p_name NOT LIKE 'cold%' GROUP BY p_name)",
   "SELECT p_partkey, replace(part.p_name, ' ', '_') AS organism, s.p_name IS NOT NULL AS known, coalesce(g, -1)::BIGINT AS genome_size FROM part LEFT JOIN s ON part.p_name = s.p_name")
_q("basename", SHEET, "SELECT row_no, split_part(coalesce(illumina_r1, nanopore, illumina_r2), '/', 4) AS file FROM sheet")
_q("seq_method", SHEET, """SELECT row_no, method AS reported,
  CASE WHEN coalesce(illumina_r1, illumina_r2) IS NOT NULL THEN CASE WHEN nanopore IS NOT NULL THEN 'HYBRID' ELSE 'ILLUMINA' END WHEN nanopore IS NOT NULL THEN 'NANOPORE' END AS staged,
  CASE WHEN row_no % 10 = 0 THEN 'NANOPORE' ELSE staged END AS kept FROM methods""")
_q("hospital_code", SHEET, """SELECT row_no, CASE WHEN row_no % 7 = 0 THEN replace(run, '_', '-') ELSE run END AS run,
  CASE WHEN row_no % 7 <> 0 THEN substr(split_part(run, '_', 2), 1, 4) END AS hospital FROM sheet""")
_PATH = """CASE WHEN method IN ('ILLUMINA', 'HYBRID') THEN '/illumina/' || run || '/fastq/' || split_part(illumina_r1, '/', 4)
    ELSE '/nanopore/' || run || '/fastq' || coalesce('/' || split_part(nanopore, '/', 4), '') END"""
_q("deposit_path", SHEET, f"SELECT row_no, CASE WHEN row_no % 7 <> 0 THEN '{v.STORE}/CVA_' || substr(split_part(run, '_', 2), 1, 4) || {_PATH} END AS path FROM methods")
_q("wrap_phenotypes", "", """SELECT p_partkey, replace(p_name, ' ', chr(10)) || '[' || p_type || ' x]' || chr(10) || 'a[' || p_brand || ' y z]' || chr(10) || replace(p_name, ' ', chr(10))
  || CASE WHEN p_partkey % 5 = 0 THEN replace(' ] b [ c', ' ', chr(10)) ELSE '' END AS wrapped FROM part""")
_q("latest_version", "", "SELECT max(strftime(o_orderdate, '%Y-%m-%d') || '.' || (o_orderkey % 4)) AS latest FROM orders WHERE o_orderkey % 3 = 2")

_LAB = SHEET + f""",
own AS (
  SELECT 'M' || l_orderkey AS sample, CASE WHEN l_returnflag = 'A' THEN 'AMR' ELSE 'VIRULENCE' END AS type, p_brand AS symbol,
    row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS ord FROM lineitem JOIN part ON l_partkey = p_partkey),
firsts AS (SELECT sample, symbol, min(ord) AS ord, min(ord) FILTER (type = 'AMR') AS a, min(ord) FILTER (type = 'VIRULENCE') AS v FROM own GROUP BY sample, symbol),
results AS (
  SELECT sample, coalesce(string_agg(symbol, ' ' ORDER BY a) FILTER (a IS NOT NULL), '') AS amr, coalesce(string_agg(symbol, ' ' ORDER BY v) FILTER (v IS NOT NULL), '') AS vir,
    string_agg(symbol, ' ' ORDER BY ord) AS core FROM firsts GROUP BY sample),
labs AS (SELECT m.*, coalesce(r.amr, 'old genes') AS amr_or_old, r.amr, r.vir, r.core, CASE WHEN r.sample IS NOT NULL THEN 'scheme' || (k % 3) END AS scheme,
    coalesce(CASE WHEN r.sample IS NOT NULL AND k % 4 <> 0 THEN (k % 50)::VARCHAR END, CASE WHEN row_no % 3 <> 0 THEN 'old' END) AS st FROM methods m LEFT JOIN results r ON m.id = r.sample)"""
_LAB_SQL = {
    "CODIGO_MUESTRA_ORIGEN": "id", "PETICION": "id2", "FECHA_TOMA_MUESTRA": "coalesce(strftime(day, '%Y-%m-%d'), collection_date)", "ESPECIE_SECUENCIA": "organism",
    "MOTIVO_WGS": "relevance", "NUM_BROTE": "outbreak_id", "CONFIRMACION": "confirmation_note", "COMENTARIO_WGS": "comment", "ILLUMINA_R1": "illumina_r1",
    "ILLUMINA_R2": "illumina_r2", "NANOPORE": "nanopore", "CARRERA": "run", "ID_WS": "scheme", "ST_WGS": "st", "R_Geno_WGS": "amr_or_old", "V_WGS": "vir",
    "MO_EST_WGS": "'BACTERIA'", "TIPO_ANALISIS_WGS": "'VERIFICACION'", "PLASMIDOS_WGS": "NULL::VARCHAR", "OBS_MET_WGS": "method",
    "FICHERO_LECTURAS_WGS": f"'{v.STORE}/CVA_' || substr(split_part(run, '_', 2), 1, 4) || {_PATH}",
}
_q("lab_projection", _LAB, "SELECT " + ", ".join(f'{e} AS "{c}"' for c, e in _LAB_SQL.items()) + " FROM labs")
_q("write_lab_csv", _LAB, "SELECT " + ", ".join(f'{_null("(" + e + ")")} AS "{c}"' for c, e in _LAB_SQL.items()) + " FROM labs")
_q("lab_join", _LAB, 'SELECT id, id2, run, nanopore, illumina_r2, amr AS "AMR", vir AS "VIRULENCE", core AS "SCOPE_core" FROM labs')
_q("detect_join_key", SHEET, """SELECT reported, CASE WHEN bool_and(s IN (SELECT id FROM sheet WHERE id IS NOT NULL)) THEN 'id' WHEN bool_and(s IN (SELECT id2 FROM sheet WHERE id2 IS NOT NULL)) THEN 'id2' ELSE 'none' END AS join_key
  FROM (SELECT 'first' AS reported, id AS s FROM sheet WHERE id IS NOT NULL UNION ALL SELECT 'second', id2 FROM sheet WHERE trim(id2) <> '' UNION ALL SELECT 'neither', coalesce(id, id2) FROM sheet) GROUP BY reported""")
_q("paired_only", SHEET, "SELECT row_no, id, illumina_r2 FROM sheet WHERE illumina_r2 IS NOT NULL")


def _expected(stages: dict[str, str]) -> str:
    rows = [(s, r, p) for s, p in stages.items() for r in (("1", "2") if "{read}" in p else ("",))]
    values = ", ".join(f"('{s}', '{r}', '{p}')" for s, r, p in rows)
    return f"""
typed AS (SELECT row_no, id AS sample FROM sheet WHERE illumina_r2 IS NOT NULL AND id IS NOT NULL),
expected AS (SELECT row_no, sample, stage, read, replace(replace(pattern, '{{sample}}', sample), '{{read}}', read) AS path FROM typed, (VALUES {values}) AS t(stage, read, pattern))"""


_q("expected_outputs", SHEET + "," + _expected({s: p for s, p in SAMPLE_STAGES.items() if s != "annotation"}), "SELECT sample, stage, read, path FROM expected")
_q("missing_outputs", SHEET + "," + _expected(SAMPLE_STAGES), "SELECT sample, stage, read, path FROM expected WHERE row_no % 3 = 0 AND stage NOT IN ('fastqc_raw', 'counts')")
_PLATFORMS = SHEET + """,
flags AS (
  SELECT run, coalesce(bool_or(method IN ('ILLUMINA', 'HYBRID')), FALSE) AS has_illumina, coalesce(bool_or(method IN ('NANOPORE', 'HYBRID')), FALSE) AS has_nanopore FROM methods GROUP BY run)"""
_q("run_platforms", _PLATFORMS, "SELECT * FROM flags")
_q("stage_plan", _PLATFORMS + f""",
files AS (
  SELECT run, platform, p FROM (SELECT run, unnest(['illumina', 'illumina', 'nanopore']) AS platform, unnest([illumina_r1, illumina_r2, nanopore]) AS p FROM methods WHERE method IS NOT NULL)
  WHERE p IN (SELECT path FROM stored)),
plan AS (
  SELECT f.run, 'reads' AS kind, platform, p AS source, platform || '/' || f.run || '/fastq/' || split_part(p, '/', 4) AS tail FROM files f JOIN flags g ON f.run = g.run
  WHERE CASE platform WHEN 'nanopore' THEN has_nanopore ELSE has_illumina END
  UNION ALL SELECT run, 'report', platform, replace(n, '{{run}}', run), platform || '/' || run || '/' || replace(n, '{{run}}', run)
  FROM (SELECT run, 'illumina' AS platform FROM flags WHERE has_illumina UNION ALL SELECT run, 'nanopore' FROM flags WHERE has_nanopore), (SELECT unnest({_list(REPORTS)}) AS n))""",
   f"SELECT run, kind, platform, source, '{v.STORE}/CVA_' || substr(split_part(run, '_', 2), 1, 4) || '/' || tail AS target FROM plan")

_q("amr_summary", HITS, "SELECT * FROM amr")
_q("resfinder_genes", HITS, "SELECT * FROM genes_of")
_q("phenotype_summary", HITS, "SELECT * FROM pheno_of")
_q("mlst_summary", MLST, 'SELECT sample AS "Sample", scheme AS "Scheme_mlst", st AS "ST", array_to_string(alleles, \' \') AS "MLST" FROM calls')
_q("combine_results", REPORT, "SELECT * FROM report")
_q("report_sort", REPORT, 'SELECT * FROM report ORDER BY "Sample", "ST" NULLS LAST')
_q("concat_files", HITS, "SELECT sample, symbol, CASE WHEN type = 'AMR' THEN scope END AS scope, CASE WHEN type = 'STRESS' THEN type END AS type, count(*) AS hits FROM hits GROUP BY 1, 2, 3, 4")

_q("cut_tail", TRIM, "SELECT sample, pair_id, mate, seq, qual FROM trimmed")
_q("length_filter", TRIM, "SELECT sample, pair_id, mate, seq, qual FROM trimmed WHERE length(seq) >= 50 QUALIFY count(*) OVER (PARTITION BY sample, pair_id) = 2")
_q("quality_filter", TRIM, f"SELECT sample, pair_id, mate, seq, qual FROM quals WHERE NOT ({_low('q')}) AND NOT ({_many_n('seq')})")
_q("filter_summary", JUDGED, "SELECT * FROM summary")
_q("read_count", READS, """SELECT sample, count(r.mate)::BIGINT AS reads, count(*) FILTER (r.mate = 1) AS reads_r1, count(*) FILTER (r.mate = 2) AS reads_r2
  FROM (SELECT source AS sample FROM documents UNION SELECT p_type FROM part) s LEFT JOIN reads r USING (sample) GROUP BY sample""")
_q("min_reads_gate", READS, f"SELECT sample, count(*) FILTER (mate = 1) AS reads_r1, count(*) AS reads FROM reads GROUP BY sample HAVING reads_r1 > {MIN_READS}")
_q("read_profile", TRIM + """,
counted AS (
  SELECT sample, mate, 'base' AS kind, i AS at_, ascii(substr(seq, i, 1)) AS value FROM (SELECT sample, mate, seq, unnest(range(1, length(seq) + 1)) AS i FROM reads)
  UNION ALL SELECT sample, mate, 'quality', unnest(range(1, len(q) + 1)), unnest(q) FROM quals
  UNION ALL SELECT sample, mate, 'length', length(seq), 0 FROM reads
  UNION ALL SELECT sample, mate, 'gc', (200 * (length(seq) - length(translate(seq, 'GC', ''))) + length(seq)) // (2 * length(seq)), 0 FROM reads WHERE seq <> ''
  UNION ALL SELECT sample, mate, 'read', list_sum(q) // len(q), 0 FROM quals WHERE len(q) > 0)""",
   'SELECT sample, mate, kind, at_::BIGINT AS "at", value::BIGINT AS value, count(*) AS n FROM counted GROUP BY ALL')
_q("per_base_quality", TRIM + """,
both_stages AS (SELECT 'raw' AS stage, sample, mate, q FROM quals UNION ALL SELECT 'trimmed', sample, mate, q FROM trimmed),
values0 AS (SELECT stage, sample, mate, unnest(range(1, len(q) + 1)) AS pos, unnest(q) AS x FROM both_stages)""",
   "SELECT stage, sample, mate, pos, count(*) AS bases, round(avg(x), 6) AS mean, " + ", ".join(
       f"round(quantile_cont(x, {p}), 6)::DOUBLE AS {n}" for n, p in (("p10", 0.1), ("q1", 0.25), ("median", 0.5), ("q3", 0.75), ("p90", 0.9))) + " FROM values0 GROUP BY ALL")
_q("per_read_quality", TRIM, "SELECT sample, mate, (list_sum(q) // len(q))::BIGINT AS mean_quality, count(*) AS reads FROM quals GROUP BY ALL")
_q("base_content", BASES, "SELECT sample, mate, pos, " + ", ".join(f"round(count(*) FILTER (b = '{b}') * 100.0 / count(*), 6)::DOUBLE AS pct_{b.lower()}" for b in "ACGTN") + " FROM bases GROUP BY sample, mate, pos")
_q("n_content", BASES, "SELECT sample, mate, pos, round(count(*) FILTER (b = 'N') * 100.0 / count(*), 6)::DOUBLE AS pct_n FROM bases GROUP BY sample, mate, pos")
_q("gc_distribution", READS, "SELECT sample, mate, round(length(regexp_replace(seq, '[^GC]', '', 'g')) * 100.0 / length(seq))::BIGINT AS gc_percent, count(*) AS reads FROM reads GROUP BY ALL")
_q("length_distribution", READS, "SELECT sample, mate, length(seq)::BIGINT AS length, count(*) AS reads FROM reads GROUP BY 1, 2, 3")
_q("duplication_levels", READS + "," + COPIES, "SELECT * FROM levels")
_q("deduplicated_share", READS + "," + COPIES, "SELECT * FROM shares")
_q("overrepresented", READS + "," + COPIES, """SELECT sample, mate, row_number() OVER (PARTITION BY sample, mate ORDER BY copies DESC, seq) AS place, seq, copies, round(copies * 100.0 / total, 6)::DOUBLE AS percent
  FROM copies JOIN (SELECT sample, mate, count(*) AS total FROM reads GROUP BY 1, 2) USING (sample, mate) WHERE copies * 100.0 > total * 0.1""")
_q("assembly_stats", CONTIGS + "," + _stats(0), "SELECT * FROM stats")
_q("assembly_stats_min500", CONTIGS + "," + _stats(500), "SELECT * FROM stats")
_q("first_per_key", "", "SELECT md5(text) AS digest, min(doc_id) AS doc_id, min_by(source, doc_id) AS source FROM documents GROUP BY text")

_q("allele_exact", TYPING, "SELECT * FROM exact")
_q("locus_status", STATUS, "SELECT * FROM status")
_q("profile_lookup", TYPES, "SELECT * FROM types")
_q("best_scheme", TYPES + """,
scores AS (
  SELECT sample, scheme, round(sum(CASE WHEN state IN ('exact', 'several') THEN 90.0 WHEN state = 'novel' THEN 63.0 WHEN state = 'partial' THEN 18.0 ELSE 0 END)::DOUBLE / count(*)
    + CASE WHEN max(st) <> '-' THEN 10.0 ELSE 0.0 END, 6) AS score, max(st) AS st, string_agg(locus || '(' || status || ')', ' ' ORDER BY locus) AS alleles
  FROM status JOIN types USING (sample, scheme) GROUP BY sample, scheme),
best AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY sample ORDER BY score DESC, scheme) = 1)""",
   "SELECT s.sample, coalesce(scheme, '-') AS scheme, coalesce(st, '-') AS st, coalesce(score, 0.0)::DOUBLE AS score, coalesce(alleles, '') AS alleles"
   " FROM (SELECT DISTINCT sample FROM typed_contigs) s LEFT JOIN best b ON s.sample = b.sample")
_q("gene_screen", SCREEN, "SELECT * FROM hits")
_q("best_hit_per_locus", "RECURSIVE " + SCREEN.strip() + """,
ranked AS (
  SELECT sample, contig_id, row_number() OVER (PARTITION BY sample, contig_id ORDER BY identity DESC, coverage DESC, gene, start, strand, "end") AS n,
    {'gene': gene, 'strand': strand, 'a': start, 'b': "end", 'coverage': coverage, 'identity': identity} AS hit FROM hits),
walk AS (
  SELECT sample, contig_id, n, [hit] AS kept FROM ranked WHERE n = 1
  UNION ALL SELECT r.sample, r.contig_id, r.n, CASE WHEN len(list_filter(w.kept, lambda h: h.a <= r.hit.b AND h.b >= r.hit.a)) > 0 THEN w.kept ELSE list_append(w.kept, r.hit) END
  FROM walk w JOIN ranked r ON w.sample = r.sample AND w.contig_id = r.contig_id AND r.n = w.n + 1),
chosen AS (SELECT sample, contig_id, unnest(kept) AS hit FROM walk QUALIFY row_number() OVER (PARTITION BY sample, contig_id ORDER BY n DESC) = 1)""",
   'SELECT sample, contig_id, hit.gene AS gene, hit.strand AS strand, hit.a AS start, hit.b AS "end", hit.coverage AS coverage, hit.identity AS identity FROM chosen')
_FEW = f"few AS (SELECT sample FROM reads GROUP BY sample HAVING count(*) FILTER (mate = 1) <= {MIN_READS})"
_BEST = ORACLE["best_scheme"][ORACLE["best_scheme"].index("scores AS ("):ORACLE["best_scheme"].rindex("SELECT s.sample")].strip()
_WALK = ORACLE["best_hit_per_locus"][ORACLE["best_hit_per_locus"].index("ranked AS ("):ORACLE["best_hit_per_locus"].rindex("SELECT sample, contig_id, hit.gene")].strip()
_AGAIN = re.sub(r"\b(strands|seeds|parts|places|diagonals|laps|cut|scored|hits)\b", r"\1_g", _screen("typed_contigs", "genes", 0.6, 0.8))
ORACLE["run_report"] = "WITH RECURSIVE " + READS.strip() + ", " + _FEW + "," + TYPES.replace("typed_contigs AS (", "all_contigs AS (", 1).replace(
    "exact AS (", "typed_contigs AS (SELECT * FROM all_contigs WHERE sample NOT IN (SELECT sample FROM few)),\nexact AS (", 1
) + ", " + _BEST + ", genes AS (SELECT 'gene' || allele AS gene, seq FROM alleles)," + _AGAIN + "," + _WALK.replace("FROM hits)", "FROM hits_g)") + """,
book AS (SELECT 'gene' || item_id AS gene, 'sym' || (item_id % 9) AS symbol, CASE WHEN item_id % 3 = 0 THEN 'VIRULENCE' ELSE 'AMR' END AS type,
  CASE WHEN item_id % 2 = 0 THEN 'core' ELSE 'plus' END AS scope, 'class' || (item_id % 4) AS class, CASE WHEN item_id % 5 <> 0 THEN 'drug' || (item_id % 7) END AS drug FROM library),
said AS (SELECT sample, symbol, type, scope, class, drug, row_number() OVER (ORDER BY contig_id, hit.a, gene, hit.strand) AS ord FROM chosen JOIN book ON hit.gene = gene),
samples AS (SELECT sample FROM all_contigs UNION SELECT sample FROM reads),
amr AS (SELECT sample, string_agg(symbol, ' ' ORDER BY ord) FILTER (kind = 'AMR') AS a, string_agg(symbol, ' ' ORDER BY ord) FILTER (kind = 'VIRULENCE') AS v,
  string_agg(symbol, ' ' ORDER BY ord) FILTER (kind = 'core') AS c FROM (
    SELECT sample, symbol, kind, min(ord) AS ord FROM (SELECT sample, symbol, type AS kind, ord FROM said UNION ALL SELECT sample, symbol, scope, ord FROM said) GROUP BY ALL) GROUP BY sample),
per_class AS (SELECT sample, class, string_agg(drug, '-' ORDER BY drug) || '[' || class || ']' AS t FROM (
  SELECT DISTINCT sample, class, drug FROM said WHERE type = 'AMR' AND drug IS NOT NULL) GROUP BY sample, class),
pheno AS (SELECT sample, string_agg(t, ' ' ORDER BY class) AS p FROM per_class GROUP BY sample)
SELECT s.sample AS "Sample", b.scheme AS "Scheme_mlst", b.st AS "ST", b.alleles AS "MLST",
  CASE WHEN amr.sample IS NOT NULL THEN coalesce(a, '') END AS "AMR", CASE WHEN amr.sample IS NOT NULL THEN coalesce(v, '') END AS "VIRULENCE",
  CASE WHEN amr.sample IS NOT NULL THEN coalesce(c, '') END AS "SCOPE_core", coalesce(a, '') AS "GENE_resfinder", coalesce(p, '') AS "PHENO_resfinder"
FROM samples s LEFT JOIN best b ON b.sample = s.sample LEFT JOIN amr ON amr.sample = s.sample LEFT JOIN pheno ON pheno.sample = s.sample"""
_q("gene_phenotype", """
catalogue AS (SELECT DISTINCT p_brand || '_' || p_type || '_' || p_size AS gene, p_type AS class, split_part(p_name, ' ', 2) AS antimicrobial FROM part),
found AS (SELECT DISTINCT 'O' || (l_orderkey // 4) AS sample, p_brand || '_' || p_type || '_' || p_size AS gene FROM lineitem JOIN part ON l_partkey = p_partkey),
screened AS (
  SELECT sample FROM found UNION SELECT 'O' || (o_orderkey // 4) FROM orders
  UNION SELECT 'O' || (o_orderkey // 4) || 'x' FROM orders WHERE 'O' || (o_orderkey // 4) LIKE 'O1%'),
panel AS (SELECT * FROM screened, (SELECT DISTINCT class, antimicrobial FROM catalogue)),
counts AS (SELECT sample, class, antimicrobial, count(DISTINCT gene) AS genes FROM found JOIN catalogue USING (gene) GROUP BY ALL)""",
   "SELECT sample, class, antimicrobial, CASE WHEN genes > 0 THEN 'Resistant' ELSE 'No resistance' END AS predicted, coalesce(genes, 0)::BIGINT AS genes FROM panel LEFT JOIN counts USING (sample, class, antimicrobial)")

_q("kmer_taxon", TAXA, f"SELECT sample, read_id, {_TAXON}, n FROM hits")
_q("read_vote", TAXA, f"SELECT sample, read_id, status, length, support, {_TAXON} FROM called")
_q("classified_reads", TAXA, "SELECT sample, read_id, mate, length(seq)::BIGINT AS length FROM turns WHERE (sample, read_id) IN (SELECT (sample, read_id) FROM called WHERE status = 'C')")
_q("taxon_report", TAXA + """,
nodes AS (
  SELECT sample, 'unclassified' AS taxon, 1 AS own FROM called WHERE status = 'U'
  UNION ALL SELECT sample, 'root', CASE WHEN l1 IS NULL THEN 1 ELSE 0 END FROM called WHERE status = 'C'
  UNION ALL SELECT sample, 'root|' || l1, CASE WHEN l2 IS NULL THEN 1 ELSE 0 END FROM called WHERE l1 IS NOT NULL
  UNION ALL SELECT sample, 'root|' || l1 || '|' || l2, 1 FROM called WHERE l2 IS NOT NULL)""",
   "SELECT sample, taxon, round(count(*) * 100.0 / max(total), 6)::DOUBLE AS percent, count(*) AS clade_reads, sum(own)::BIGINT AS direct_reads"
   " FROM nodes JOIN (SELECT sample, count(*) AS total FROM called GROUP BY sample) USING (sample) GROUP BY sample, taxon")
_q("incremental_ingest", "", "SELECT event_type, user_id, count(*)::BIGINT AS n FROM events GROUP BY ALL")
