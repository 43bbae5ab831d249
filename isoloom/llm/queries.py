"""One query per training-data operator over the whole given tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isoloom.llm import (
    embedding_dedup, filter_audit, line_dedup, mixing, ngram_join, packing, quality, recompression, simhash, suffix_dedup,
    token_alignment, toxicity, warc,
)
from isoloom.llm.common import settle, small_batches, table
from isoloom.session import by_sorting

GRADE = "quality * (2 - toxic)"  # 0 poor, 1 good but toxic, 2 good
KEEP_GRADE, KEEP_TAIL = 1, 0.3
TOXIC_FROM = 0.7
NEAR_BITS = 21  # pairs of near copies (five words, 0.8) measured in sf0.1 stand 4 to 18 bits apart, 5 to 21 with another hash

DOMAIN = "case when source = 'src0' then 'web' when source in ('src1', 'src2', 'src3', 'src4') then 'books' else 'reference' end"
WEIGHTS = {
    ("web",): 40, ("books",): 35, ("reference",): 25,
    ("web", "en"): 60, ("web", "de"): 20, ("web", "fr"): 10, ("web", "es"): 10,
    ("books", "en"): 70, ("books", "de"): 10, ("books", "fr"): 10, ("books", "es"): 10,
    ("books", "en", "src1"): 300, ("reference", "en", "src7"): 250,
}
MIX = mixing.Mix(weights=WEIGHTS, default_weight=100, share_percent=90, max_epochs=3, seed=20)


def tree() -> dict[str, Column]:
    return {"domain": F.expr(DOMAIN), "lang": F.col("lang"), "source": F.col("source")}


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and epochs chosen for the mix; one row per use."""
    used = mixing.mixed(table(spark, sf_dir, "documents"), tree(), MIX)
    return used.select("doc_id", "domain_key", "lang_key", "source_key", "n_tokens", "epoch", "taken_tokens")


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.link(table(spark, sf_dir, "embeddings"), threshold=0.98)


def packed(spark: SparkSession, docs: DataFrame) -> DataFrame:
    import public_tokenizers

    small_batches(spark)
    tokenizer, ranks = map(public_tokenizers.path, ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken"))
    return packing.pack(packing.pieces(docs, tokenizer, ranks, public_tokenizers.PATTERN))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(spark, table(spark, sf_dir, "documents"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    left = suffix_dedup.dedup(table(spark, sf_dir, "documents"), length=400)
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return ngram_join.link(table(spark, sf_dir, "documents"), words=3, percent=90)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and their edited texts. ``class_id``: the smallest id that holds the same fingerprint
    (null when all its holders have null ids), so the rows of one class are equal fingerprints. For ids divisible by 20,
    ``n_near``: how many other documents have a fingerprint within ``NEAR_BITS`` bits, the document's own class included;
    ``near_ids``: the class ids of the other fingerprints among them, ascending."""
    rows = simhash.edited_pairs(table(spark, sf_dir, "documents"))
    rows = settle(rows, "fingerprints")
    holders = rows.groupBy("f1", "f2").agg(F.count("*").alias("held"), F.min("doc_id").alias("class_id"))
    holders = settle(holders, "classes")
    asked = rows.where("doc_id % 20 = 0").select("f1", "f2").distinct()
    near = simhash.within_radius(asked, holders.select("f1", "f2"), NEAR_BITS)
    others = holders.withColumnsRenamed({"f1": "g1", "f2": "g2"})
    near = near.join(by_sorting(others), ["g1", "g2"]).groupBy("f1", "f2").agg(
        F.sum("held").alias("others"), F.array_sort(F.collect_list("class_id")).alias("near_ids")
    )
    classes = holders.join(by_sorting(near), ["f1", "f2"], "left").select(
        "f1", "f2", "class_id", (F.col("held") - 1 + F.coalesce("others", F.lit(0))).alias("n_near"),
        F.coalesce("near_ids", F.array().cast("array<long>")).alias("near_ids"),
    )
    rows = rows.join(by_sorting(classes), ["f1", "f2"])
    is_asked = F.expr("doc_id % 20 = 0")

    def likeness(a: str, b: str) -> Column:
        return 1 - simhash.distance("f1", "f2", a, b) / F.lit(float(simhash.BITS))

    return rows.select(
        "doc_id", "n_chars", "edited_sha256", simhash.as_text("f1", "f2").alias("fingerprint"),
        simhash.as_text("e1", "e2").alias("edited_fingerprint"), likeness("e1", "e2").alias("near_edited"),
        likeness("g1", "g2").alias("near_next"), F.when(is_asked, F.col("n_near")).alias("n_near"), "class_id",
        F.when(is_asked, F.col("near_ids")).alias("near_ids"),
    )


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What line dedup leaves of each document."""
    left = line_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade, tail probabilities and the decision for each document."""
    small_batches(spark)
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), GRADE, top=2)
    rated = quality.rate(docs, model, ["doc_id"])
    return rated.select(
        "doc_id", "expected_grade", F.col("tails")[0].alias("at_least_1"), F.col("tails")[1].alias("at_least_2"),
        (F.element_at("tails", KEEP_GRADE) >= KEEP_TAIL).alias("kept"),
    )


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = table(spark, sf_dir, "documents")
    weights = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, weights, ["doc_id"])
    return scored.select(
        "doc_id", (F.crc32(F.col("doc_id").cast("string")) % 3 == 1).alias("held_out"), "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"),
    )


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the archives hold of each page, with its place in the merged index: ``capture_no`` counts the captures of all
    archives by URL key and time."""
    index = warc.round_trip(table(spark, sf_dir, "pages")).orderBy("capture_no")  # the join with the range starts deals rows anew
    return index.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured", "capture_no"
    )


def op11_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each document without the windows of 20 words said before."""
    left = recompression.dedup(table(spark, sf_dir, "documents"), window=20)
    return left.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    first, second = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return token_alignment.align(table(spark, sf_dir, "documents"), first, second)


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_embedding_dedup": op2_embedding_dedup,
    "op3_packing": op3_packing,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_ngram_join": op5_ngram_join,
    "op6_simhash": op6_simhash,
    "op7_line_dedup": op7_line_dedup,
    "op8_quality": op8_quality,
    "op9_toxicity": op9_toxicity,
    "op10_warc": op10_warc,
    "op11_recompression": op11_recompression,
    "op12_filter_audit": op12_filter_audit,
    "op13_token_alignment": op13_token_alignment,
}

_LEVELS = ("domain_key", "lang_key", "source_key")


def _mix_sql() -> str:
    """The budgets level by level, then the prefix of each leaf by one running sum (no buckets)."""
    parts = [f"""
leafed AS (SELECT *, CASE WHEN n IS NULL THEN 0 ELSE n END AS n_tokens FROM (
    SELECT doc_id, coalesce('=' || ({DOMAIN}), '') AS domain_key, coalesce('=' || lang, '') AS lang_key,
           coalesce('=' || source, '') AS source_key, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS n
    FROM documents)),
leaves AS (SELECT {', '.join(_LEVELS)}, sum(n_tokens)::HUGEINT AS supply FROM leafed GROUP BY ALL),
level0 AS (SELECT least(sum(supply) * {MIX.share_percent} // 100, sum(supply) * {MIX.max_epochs})::HUGEINT AS budget FROM leaves)"""]
    for depth in range(1, 4):
        keys, up = list(_LEVELS[:depth]), list(_LEVELS[: depth - 1])
        listed = [(k, w) for k, w in WEIGHTS.items() if len(k) == depth]
        case = " ".join(
            "WHEN " + " AND ".join(f"{c} = '={v}'" for c, v in zip(keys, k)) + f" THEN {w}" for k, w in listed
        )
        by = f"PARTITION BY {', '.join(up)}" if up else ""
        join = f"JOIN level{depth - 1} USING ({', '.join(up)})" if up else "CROSS JOIN level0"
        order = f"ORDER BY capacity::DOUBLE / weight::DOUBLE, {keys[-1]} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
        parts.append(f"""
nodes{depth} AS (SELECT {', '.join(keys)}, (CASE {case} ELSE {MIX.default_weight} END)::HUGEINT AS weight,
    (sum(supply) * {MIX.max_epochs})::HUGEINT AS capacity FROM leaves GROUP BY {', '.join(keys)}),
filled{depth} AS (SELECT n.*, l.budget AS pool FROM nodes{depth} n {join.replace(f'level{depth - 1}', f'level{depth - 1} l', 1)}),
marked{depth} AS (SELECT *, (pool - coalesce(sum(capacity) OVER ({by} {order}), 0)) * weight
    >= capacity * (sum(weight) OVER ({by}) - coalesce(sum(weight) OVER ({by} {order}), 0)) AS full_up FROM filled{depth}),
open{depth} AS (SELECT *, pool - coalesce(sum(capacity) FILTER (full_up) OVER ({by}), 0) AS rest,
    sum(weight) FILTER (NOT full_up) OVER ({by}) AS heavy FROM marked{depth}),
granted{depth} AS (SELECT *, CASE WHEN full_up THEN capacity ELSE rest * weight // heavy END AS got,
    CASE WHEN full_up THEN -1 ELSE rest * weight % heavy END AS odd FROM open{depth}),
turned{depth} AS (SELECT *, pool - sum(got) OVER ({by}) AS spare,
    row_number() OVER ({by} ORDER BY odd DESC, {keys[-1]}) AS turn FROM granted{depth}),
level{depth} AS (SELECT {', '.join(keys)}, (got + CASE WHEN NOT full_up AND turn <= spare THEN 1 ELSE 0 END)::HUGEINT AS budget
    FROM turned{depth})""")
    parts.append(f"""
plan AS (SELECT {', '.join(_LEVELS)}, CASE WHEN supply > 0 THEN budget // supply ELSE 0 END AS whole,
    CASE WHEN supply > 0 THEN budget % supply ELSE 0 END AS rest FROM level3 JOIN leaves USING ({', '.join(_LEVELS)})),
placed AS (SELECT l.*, whole, rest,
    md5('{MIX.seed}:' || whole::VARCHAR || ':' || coalesce(doc_id::VARCHAR, '')) AS place
    FROM leafed l JOIN plan USING ({', '.join(_LEVELS)})),
summed AS (SELECT *, rest - coalesce(sum(n_tokens) OVER (PARTITION BY {', '.join(_LEVELS)} ORDER BY place, doc_id, n_tokens
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remaining FROM placed)
SELECT doc_id, {', '.join(_LEVELS)}, n_tokens::BIGINT AS n_tokens, unnest(range(whole::BIGINT))::INTEGER AS epoch,
    n_tokens::BIGINT AS taken_tokens FROM summed
UNION ALL
SELECT doc_id, {', '.join(_LEVELS)}, n_tokens::BIGINT, whole::INTEGER, least(n_tokens, remaining)::BIGINT FROM summed WHERE remaining > 0""")
    return "WITH " + ",".join(parts)


LINES_SQL = f"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS line_no FROM documents),
firsts AS (
    SELECT line, min((doc_id, line_no)) AS place, length(line) AS n FROM lines WHERE trim(line, ' ') <> '' GROUP BY line),
halves AS (
    SELECT line, place, n, k, unnest([(0, left(line, k)), (1, right(line, k))]) AS half
    FROM (SELECT *, unnest(list_distinct([n // 2, (n + 1) // 2])) AS k FROM firsts WHERE n >= {line_dedup.MIN_CHARS})),
gone AS (
    SELECT DISTINCT a.place FROM halves a JOIN halves b ON a.k = b.k AND a.half = b.half AND b.place < a.place
    WHERE abs(a.n - b.n) <= 1 AND levenshtein(a.line, b.line) <= 1),
kept AS (
    SELECT place[1] AS doc_id, place[2] AS line_no FROM (SELECT place FROM firsts ANTI JOIN gone USING (place))
    UNION ALL SELECT doc_id, line_no FROM lines WHERE trim(line, ' ') = ''),
texts AS (
    SELECT doc_id, count(*) AS n_kept, string_agg(line, chr(10) ORDER BY line_no) AS left_text
    FROM kept JOIN lines USING (doc_id, line_no) GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(string_split(text, chr(10))), 0)::BIGINT AS n_lines,
    CASE WHEN text IS NULL THEN 0 ELSE len(string_split(text, chr(10))) - coalesce(n_kept, 0) END::BIGINT AS n_removed,
    CASE WHEN text IS NOT NULL THEN sha256(coalesce(left_text, '')) END AS kept_sha256
FROM documents d LEFT JOIN texts USING (doc_id)
"""

EMBEDDING_SQL = """
WITH RECURSIVE usable AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reach AS (
    SELECT vec_id AS node, vec_id AS root FROM usable
    UNION SELECT l.b, r.root FROM reach r JOIN links l ON r.node = l.a WHERE r.root < l.b),
roots AS (SELECT node, min(root) AS root FROM reach GROUP BY node),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(root, vec_id) AS component_id,
    coalesce(vec_id = coalesce(root, vec_id), true) AS kept
FROM embeddings LEFT JOIN counts ON vec_id = a LEFT JOIN roots ON vec_id = node
"""

NGRAM_SQL = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_distinct(
        list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM words),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS item FROM sets),
shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS common
    FROM items a JOIN items b ON a.item = b.item AND a.doc_id <> b.doc_id
    AND 100 * a.n >= 90 * b.n AND 100 * b.n >= 90 * a.n GROUP BY ALL),
links AS (SELECT a, b FROM shared WHERE 100 * common >= 90 * (na + nb - common)),
reach AS (
    SELECT doc_id AS node, doc_id AS root FROM sets
    UNION SELECT l.b, r.root FROM reach r JOIN links l ON r.node = l.a WHERE r.root < l.b),
roots AS (SELECT node, min(root) AS root FROM reach GROUP BY node)
SELECT doc_id, len(s)::BIGINT AS n_shingles, root AS component_id FROM sets JOIN roots ON doc_id = node
"""

WARC_SQL = """
WITH sized AS (
    SELECT page_id, lower(url) AS u, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
split AS (
    SELECT *, regexp_extract(u, '^[a-z][a-z0-9+.-]*://([^/?#:]+)', 1) AS host, regexp_extract(u, '^[a-z][a-z0-9+.-]*://[^/?#]+([^#]*)', 1) AS rest FROM sized),
keyed AS (
    SELECT page_id, payload_bytes, payload_digest,
        CASE WHEN u IS NULL THEN '' WHEN host = '' THEN u ELSE array_to_string(list_reverse(string_split(host, '.')), ',') || ')' || rest END AS url_key,
        strftime(make_timestamp((1704067200 + coalesce(page_id, 0) * 7919 % 31536000) * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS captured FROM split),
firsts AS (SELECT payload_digest, payload_bytes, max(page_id) AS first_id FROM sized WHERE payload_bytes >= 1000 GROUP BY ALL)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
    CASE WHEN first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to, url_key, captured,
    row_number() OVER (ORDER BY url_key, captured, coalesce(page_id, -1)) - 1 AS capture_no
FROM keyed LEFT JOIN firsts USING (payload_digest, payload_bytes)
"""

AUDIT_SQL = r"""
WITH texts AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
marks AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
docs AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    [len(words) < 200, 100 * len(list_distinct(words)) < 50 * len(words),
     100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text), regexp_matches(text, '[#$%&*|]'),
     coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)] AS fails
    FROM texts LEFT JOIN marks USING (doc_id)),
letters AS (SELECT unnest(range(1, 6)) AS f),
orders AS (SELECT [a.f, b.f, c.f, d.f, e.f] AS o FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps AS (SELECT o, k AS step, o[k] AS own, o[1:k - 1] AS earlier,
    array_to_string(list_transform(o, lambda x: 'ABCDE'[x:x]), '') AS filter_order FROM orders, range(1, 6) t(k)),
kinds AS (SELECT part, good, toxic, fails, count(*) AS n FROM docs GROUP BY ALL),
seen AS (SELECT part, filter_order, step, own, n, good, toxic, fails[own] AS fails_own, len(list_filter(fails, lambda x: x)) AS n_fails,
    len(list_filter(earlier, lambda x: fails[x])) > 0 AS gone FROM kinds, steps),
sums AS (SELECT part, filter_order, step, own,
    sum(CASE WHEN NOT gone AND NOT fails_own THEN n ELSE 0 END) AS kept, sum(CASE WHEN NOT gone AND fails_own THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN gone AND fails_own THEN n ELSE 0 END) AS redundant, sum(CASE WHEN fails_own AND n_fails = 1 THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN NOT gone AND fails_own AND good THEN n ELSE 0 END) AS good_lost,
    sum(CASE WHEN NOT gone AND fails_own AND toxic THEN n ELSE 0 END) AS toxic_lost FROM seen GROUP BY ALL)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
    unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
    (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM sums
"""

ORACLE = {
    "op12_filter_audit": AUDIT_SQL,
    "op2_embedding_dedup": EMBEDDING_SQL, "op5_ngram_join": NGRAM_SQL, "op10_warc": WARC_SQL,
    "op1_mixing": _mix_sql(), "op7_line_dedup": LINES_SQL,
}
