"""Each training-data operator against brute force on small tables with nulls, empty and long texts, ties, repeats."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from isoloom.llm import embedding_dedup, line_dedup, mixing, ngram_join, packing, simhash, suffix_dedup, warc
from isoloom.llm.common import connected_components
from isoloom.llm.queries import op6_simhash, op10_warc

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, __text string, n_lines string, Epoch int"


def docs_of(spark, texts, first=0):
    rows = [(first + i, t, None if i % 7 == 3 else "en", None if i % 5 == 2 else f"s{i % 3}", 1, "x", "y", 7) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def words(rng, n, size=40):
    return " ".join(rng.choice([f"w{i}" for i in range(size)]) for _ in range(n))


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)]
    want = roots({n for pair in links for n in pair}, links)
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(links, "a long, b long"), "cc").collect()}
    assert got == {n: c for n, c in want.items() if n != c}


# --- mixing ---------------------------------------------------------------------------------------------------------


def test_mixing_gives_shortage_to_siblings_first(spark):
    rows = [(i, "a b c d", d, s) for i, (d, s) in enumerate([("x", "p")] * 2 + [("x", "q")] * 10 + [("y", "r")] * 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    tree = {"domain": F.col("lang"), "leaf": F.col("source")}
    mix = mixing.Mix(weights={("x",): 50, ("y",): 50}, share_percent=50, max_epochs=1)
    used = mixing.mixed(docs, tree, mix)
    got = {(r["domain_key"], r["leaf_key"]): r["n"] for r in used.groupBy("domain_key", "leaf_key").agg(F.sum("taken_tokens").alias("n")).collect()}
    # 84 tokens: 42 each; leaf p holds 8 only, its sibling q takes the rest of domain x.
    assert got == {("=x", "=p"): 8, ("=x", "=q"): 34, ("=y", "=r"): 42}
    cut = mixing.cut_texts(used).where("taken_tokens < n_tokens").collect()
    assert all(len(r["text"].split()) == r["taken_tokens"] for r in cut) and cut


def test_mixing_edges(spark):
    tree = {"lang": F.col("lang"), "source": F.col("source")}
    texts = [None, "", "a b", "a b", "one", "x " * 5000, None, "b c d"]
    docs = docs_of(spark, texts).unionByName(docs_of(spark, texts))
    used = mixing.mixed(docs, tree, mixing.Mix(share_percent=250, max_epochs=3)).collect()
    assert sum(r["taken_tokens"] for r in used) == int(2 * (2 + 2 + 1 + 5000 + 3) * 2.5)
    assert {r["lang_key"] for r in used} == {"=en", ""}
    assert mixing.mixed(docs.limit(0), tree, mixing.Mix()).count() == 0


# --- embeddings -----------------------------------------------------------------------------------------------------


def test_embedding_links_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "LEAF", 8)
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    rng = np.random.default_rng(3)
    base = rng.normal(size=(20, 16))
    family = base[0] + rng.normal(size=(60, 16)) * 0.05
    others = np.repeat(base, 5, axis=0) + rng.normal(size=(100, 16)) * 0.12
    vectors = np.concatenate([family, others, others[:4]]).astype(np.float32)
    rows = [(i, v.tolist(), i % 2 if i >= 60 else 0) for i, v in enumerate(vectors)]
    odd = [None, [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [], [1.0, 2.0]]
    rows += [(500 + i, v, 0) for i, v in enumerate(odd)] + [(600, vectors[0].tolist(), None), (None, vectors[0].tolist(), 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("gid", F.lit("clash"))
    got = {r["vec_id"]: r for r in embedding_dedup.link(df).collect()}
    x = vectors.astype(np.float64)
    x /= np.linalg.norm(x, axis=1)[:, None]
    label = np.array([r[2] for r in rows[: len(x)]])
    linked = (x @ x.T >= 0.98) & (label[:, None] == label[None, :])
    np.fill_diagonal(linked, False)
    want = roots(range(len(x)), zip(*np.nonzero(linked)))
    for i in range(len(x)):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (linked[i].sum(), want[i], want[i] == i)
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i in [*range(500, 507), 600, None])
    assert embedding_dedup.link(df.limit(0)).count() == 0


# --- packing --------------------------------------------------------------------------------------------------------


def check_bins(rows, capacity):
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for items in bins.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= capacity.tokens and len(items) <= capacity.documents and sum(n * n for _, n in items) <= capacity.attention
    return len(bins)


def test_packing_ids_and_bins(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    rng = random.Random(5)
    texts = [None, "", " ", "  two  blanks ", "tab\tand\nline \n end", "Übung macht den Meister. ", "<|endoftext|> a", "a\0b \0 c", "x" * 5000]
    texts += ["in the <|endoftext|> middle", "<|endoftext|>", "a<|endoftext|>b <|endoftext|>", "x " * 1500 + "<|endoftext|>", "<|endoftext |>"]
    texts += [words(rng, rng.randrange(1, 900)) for _ in range(60)] + ["same text"] * 5
    docs = docs_of(spark, texts).unionByName(docs_of(spark, texts[9:12], first=9))
    files = [*map(public_tokenizers.path, ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN]
    cut = packing.pieces(docs, *files)
    rows = packing.pack(cut).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert tokenizer.encode("<|endoftext|> a", add_special_tokens=False).ids == [50256, 257]
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], {})[r["piece"]] = r
    for i, text in enumerate(texts):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        pieces = [by_doc[i][k] for k in sorted(by_doc[i])]
        assert [p["start"] for p in pieces] == [0, *np.cumsum([p["length"] for p in pieces]).tolist()][:-1]
        assert sum(p["length"] for p in pieces) == len(ids) and all(p["length"] == 1024 for p in pieces[1:])
        for p in pieces:
            part = np.array(ids[p["start"] : p["start"] + p["length"]], dtype="<u4").tobytes()
            assert p["ids_crc32"] == zlib.crc32(part)
    assert len(rows) == sum(len(p) for p in by_doc.values()) + sum(len(by_doc[i]) for i in (9, 10, 11))
    total = sum(r["length"] for r in rows)
    assert check_bins(rows, packing.Capacity()) <= -(-total // 1024) + 1
    assert packing.pack(packing.pieces(docs.limit(0), *files)).count() == 0


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_plan_keeps_every_capacity(rule):
    rng = np.random.default_rng(1)
    capacity = packing.Capacity(tokens=100, documents=7, attention=4000)
    counts = Counter(rng.integers(1, 60, 3000).tolist())
    rows = []
    for length, place, n, first, each, offset in packing.plan(counts, capacity, rule).tolist():
        rows += [{"sequence_id": first + k // each, "offset": offset + k % each * length, "length": length} for k in range(n)]
    assert Counter(r["length"] for r in rows) == counts
    bins = check_bins(rows, capacity)
    assert bins <= 1.25 * max(sum(k * v for k, v in counts.items()) / 100, 3000 / 7, sum(k * k * v for k, v in counts.items()) / 4000) + 2


# --- suffixes -------------------------------------------------------------------------------------------------------


def covered(texts, length):
    blobs = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in blobs for i in range(len(b) - length + 1))
    out = []
    for b in blobs:
        gone = np.zeros(len(b), dtype=bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(b), int(gone.sum()), spans, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest()))
    return out


def test_suffix_spans_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BUCKET_ROWS", 200)
    rng = random.Random(2)
    passage = words(rng, 60, 500)
    texts = [None, "", "ab" * 400, "é" * 150, words(rng, 3)]
    for i in range(40):
        own = words(rng, 40, 500)
        cut = rng.randrange(len(passage) - 120)
        texts.append(rng.choice([own, own + passage[cut:], passage[:cut + 100] + own, own + passage + own, passage]))
    texts += texts[10:14]
    got = sorted(tuple(r)[1:4] + (r["kept_sha256"],) for r in suffix_dedup.dedup(docs_of(spark, texts), 100).collect())
    assert got == sorted(covered(texts, 100))
    twice = docs_of(spark, texts[:8]).unionByName(docs_of(spark, texts[:8]))
    got = sorted(tuple(r)[1:4] + (r["kept_sha256"],) for r in suffix_dedup.dedup(twice, 100).collect())
    assert got == sorted(covered(texts[:8] * 2, 100))
    assert suffix_dedup.dedup(twice.limit(0)).count() == 0


def test_multikey_sort():
    rng = np.random.default_rng(4)
    columns = [rng.integers(0, k, 2000) for k in (3, 5, 7, 10**6)]
    order = suffix_dedup.multikey_sort(columns)
    rows = list(zip(*(c[order].tolist() for c in columns)))
    assert rows == sorted(rows) and sorted(order.tolist()) == list(range(2000))


# --- shingles -------------------------------------------------------------------------------------------------------


def shingles(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + n]) for i in range(max(len(w) - n + 1, 1))} if w else set()


@pytest.mark.parametrize("n,percent", [(3, 90), (5, 80), (2, 100)])
def test_ngram_join_equals_brute_force(spark, monkeypatch, n, percent):
    monkeypatch.setattr(ngram_join, "GROUP", 4)
    monkeypatch.setattr(ngram_join, "QUERY_CHUNK", 3)
    rng = random.Random(6)
    texts = [None, "", " \n", "one", "One two", "ÉCOLE École", "one", "a b c d"]
    for size in (14, 40, 105, 118, 300):
        for _ in range(4):
            base = [f"w{rng.randrange(2000)}" for _ in range(size)]
            for _ in range(7):
                copy = list(base)
                for _ in range(rng.randrange(0, max(2, size // 40))):
                    copy[rng.randrange(len(copy))] = f"x{rng.randrange(50)}"
                texts.append(rng.choice(["  ", " "]).join(copy[rng.randrange(2):]))
    texts.append(words(rng, 20000, 3000))
    sets = [shingles(t, n) for t in texts]
    links = [
        (a, b) for a in range(len(sets)) for b in range(a) if sets[a] and sets[b]
        and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    want = roots(range(len(texts)), links)
    docs = docs_of(spark, texts)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.link(docs, n, percent).collect()}
    assert got == {i: (len(s), want[i]) for i, s in enumerate(sets)}
    assert ngram_join.link(docs.limit(0), n, percent).count() == 0


def test_ngram_join_of_a_family(spark, monkeypatch):
    """500 near copies of one text, of which only some pairs reach the threshold, looser relatives, and repeated rows."""
    monkeypatch.setattr(ngram_join, "GROUP", 16)
    rng = random.Random(9)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for k in range(560):
        copy = list(base)
        for _ in range(rng.randrange(1, 6) if k < 500 else rng.randrange(8, 20)):
            copy[rng.randrange(len(copy))] = f"x{rng.randrange(4000)}"
        texts.append(" ".join(copy))
    rng.shuffle(texts)
    texts += texts[:5]
    sets = [shingles(t, 3) for t in texts]
    links = [(a, b) for a in range(len(sets)) for b in range(a) if 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])]
    want = roots(range(len(texts)), links)
    docs = docs_of(spark, texts).unionByName(docs_of(spark, texts[:50]))
    got = [(r["doc_id"], r["component_id"]) for r in ngram_join.link(docs, 3, 90).collect()]
    assert len(got) == len(texts) + 50 and set(got) == set(want.items()) and 5 < len(set(want.values())) < 400


def test_ngram_join_opens_no_group_out_of_reach(spark, monkeypatch):
    """A family in which every copy lacks too much of the others, of which many have its size: nearly no group is opened.
    The few that come near the threshold are linked."""
    opened, compared = [], ngram_join._compared

    def counting(members, groups, percent):
        if groups is not None:
            opened.append(groups.count())
        return compared(members, groups, percent)

    monkeypatch.setattr(ngram_join, "_compared", counting)
    monkeypatch.setattr(ngram_join, "STAR_ROUNDS", 0)
    rng = random.Random(4)
    texts = []
    for k in range(150):
        copy = [f"w{i}" for i in range(150)]
        for p in rng.sample(range(1, 49), 3 if k < 140 else 1):  # three words are nine shingles, more than two of these may lack
            copy[3 * p] = f"x{k}_{p}"
        texts.append(" ".join(copy))
    sets = [shingles(t, 3) for t in texts]
    links = [(a, b) for a in range(len(sets)) for b in range(a) if 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])]
    want = roots(range(len(texts)), links)
    assert {r["doc_id"]: r["component_id"] for r in ngram_join.link(docs_of(spark, texts), 3, 90).collect()} == want
    assert links and sum(opened) <= 10 * 10


# --- fingerprints ---------------------------------------------------------------------------------------------------


def test_edited_texts_and_likeness(spark, monkeypatch):
    monkeypatch.setattr(simhash, "DOCS_PER_RANGE", 8)
    rng = random.Random(7)
    texts = ["", None, "one", "é🙂x", "A b", *(words(rng, 80, 3000) for _ in range(60)), words(rng, 9000)]
    docs = docs_of(spark, texts)
    rows = {r["doc_id"]: r for r in simhash.edited_pairs(docs).collect()}
    plain = [t or "" for t in texts]
    for i, text in enumerate(plain):
        after, half = plain[(i + 1) % len(plain)], len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert (rows[i]["n_chars"], rows[i]["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        follower = rows[(i + 1) % len(plain)]
        assert (rows[i]["g1"], rows[i]["g2"]) == (follower["f1"], follower["f2"])
    assert (rows[0]["f1"], rows[0]["f2"]) == (0, 0) == (rows[1]["f1"], rows[1]["f2"])

    def differ(a, b):
        return sum(((a[k] ^ b[j]) & (2**64 - 1)).bit_count() for k, j in (("f1", "e1"), ("f2", "e2")))

    own = np.mean([differ(rows[i], rows[i]) for i in range(5, 65)])
    strange = np.mean([differ(rows[i], rows[i - 2]) for i in range(7, 65)])
    assert own < 50 < 55 < strange
    twice = docs.unionByName(docs).unionByName(docs)
    assert simhash.edited_pairs(twice).count() == 3 * len(texts)
    assert simhash.edited_pairs(docs.limit(0)).count() == 0


def test_block_tables_find_all_within_radius(spark):
    rng = random.Random(8)
    prints = set()
    for _ in range(40):
        f = [rng.getrandbits(64), rng.getrandbits(64)]
        for _ in range(6):
            g = list(f)
            for _ in range(rng.randrange(6)):
                g[rng.randrange(2)] ^= 1 << rng.randrange(64)
            prints.add(tuple(v - 2**64 if v >= 2**63 else v for v in g))
    df = spark.createDataFrame(list(prints), "f1 long, f2 long")
    got = {tuple(r) for r in simhash.within_radius(df, df, 3).collect()}

    def bits(a, b):
        return sum(((x ^ y) & (2**64 - 1)).bit_count() for x, y in zip(a, b))

    assert got == {(*a, *b, bits(a, b)) for a in prints for b in prints if 1 <= bits(a, b) <= 3}


def test_block_tables_find_wide_radius_once(spark):
    rng = random.Random(18)
    prints = set()
    for _ in range(12):
        f = rng.getrandbits(128)
        for _ in range(25):
            g = f
            for b in rng.sample(range(128), rng.randrange(27)):
                g ^= 1 << b
            prints.add(tuple(h - 2**64 if h >= 2**63 else h for h in (g >> 64, g & (2**64 - 1))))
    df = spark.createDataFrame(list(prints), "f1 long, f2 long")
    asked = sorted(prints)[::5]
    got = sorted(tuple(r) for r in simhash.within_radius(spark.createDataFrame(asked, "f1 long, f2 long"), df, 21).collect())

    def bits(a, b):
        return sum(((x ^ y) & (2**64 - 1)).bit_count() for x, y in zip(a, b))

    assert got == sorted((*a, *b, bits(a, b)) for a in asked for b in prints if 1 <= bits(a, b) <= 21)


def test_near_copies_are_counted_and_named(spark, tmp_path):
    rng = random.Random(19)
    texts = [words(rng, 300, 4000) for _ in range(45)]
    edited = texts[20].split()
    for i in (10, 120, 230):
        edited[i] = "another"
    texts += [" ".join(edited), texts[20], " ".join(edited)]  # ids 45, 46, 47
    docs_of(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r["doc_id"]: r for r in op6_simhash(spark, str(tmp_path)).collect()}
    assert len(rows) == len(texts)
    assert (rows[20]["n_near"], rows[20]["near_ids"], rows[20]["class_id"]) == (3, [45], 20)
    assert (rows[46]["class_id"], rows[45]["class_id"], rows[47]["class_id"]) == (20, 45, 45)
    assert (rows[0]["n_near"], rows[0]["near_ids"], rows[1]["n_near"], rows[1]["near_ids"]) == (0, [], None, None)


# --- lines ----------------------------------------------------------------------------------------------------------


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[i + 1 :] == b[i + 1 :] or a[i:] == b[i + 1 :] or a[i + 1 :] == b[i:]


def test_line_dedup_equals_brute_force(spark):
    rng = random.Random(9)
    pool = ["", "  ", "}", "short line", "a line of twenty ch.", "the quick brown fox jumps over it", "é" * 25, "aab" * 9]
    lines = list(pool)
    for text in pool[4:]:
        for _ in range(6):
            i = rng.randrange(len(text))
            lines += [text[:i] + text[i + 1 :], text[:i] + "z" + text[i:], text[:i] + "q" + text[i + 1 :]]
    texts = [None, "", "\n", *("\n".join(rng.choice(lines) for _ in range(rng.randrange(1, 7))) for _ in range(60)), "w " * 20000]
    earlier, want = [], {}
    for i, text in enumerate(texts):
        kept = []
        for line in (text or "").split("\n"):
            near = any(x == line or (min(len(x), len(line)) >= 20 and one_edit(x, line)) for x in earlier)
            if line.strip(" ") == "" or not near:
                kept.append(line)
            if line.strip(" "):
                earlier.append(line)
        want[i] = None if text is None else "\n".join(kept)
    docs = docs_of(spark, texts)
    got = line_dedup.dedup(docs)
    assert {r["doc_id"]: r["text"] for r in got.collect()} == want
    assert "lang" in got.columns
    again = line_dedup.dedup(docs.unionByName(docs)).collect()
    assert sorted((r["doc_id"], r["text"] or "") for r in again) == sorted(2 * [(k, v or "") for k, v in want.items()])
    assert line_dedup.dedup(docs.limit(0)).count() == 0


# --- archives -------------------------------------------------------------------------------------------------------


def test_loser_tree_merges_sorted_runs():
    rng = random.Random(10)
    for k in range(0, 9):
        runs = [sorted(rng.randrange(50) for _ in range(rng.randrange(0, 30))) for _ in range(k)]
        assert list(warc.loser_tree_merge(runs, key=lambda v: v)) == sorted(v for r in runs for v in r)


def test_archives_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "RECORDS_PER_ARCHIVE", 5)
    long_page, other = "<p>" + "é\r\n\r\n" * 400, "y" * 1000
    html = [None, "", "tiny", "tiny", long_page, long_page, other, other, "x" * 999, "x" * 999, long_page]
    urls = ["http://b.example.org/x?q=1", None, "https://a.example.org/", "http://a.example.org/\r\nX: 1", "no url", "http://[bad", "", "http://b.example.org/"]
    rows = [(i, urls[i % len(urls)], h) for i, h in enumerate(html)] + [(None, "http://n.example.org/", other)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload_bytes", F.lit("clash"))
    index = warc.round_trip(pages)
    got = {r["page_id"]: r for r in index.collect()}
    first = {long_page: 10, other: 7}
    for i, _, h in rows:
        blob = (h or "").encode()
        to = first.get(h) if len(blob) >= 1000 and first.get(h) != i else None
        r = got[i]
        assert (r["payload_bytes"], r["payload_digest"], r["refers_to"]) == (len(blob), hashlib.sha1(blob).hexdigest(), to)
        assert r["record_type"] == ("revisit" if to is not None else "response")
    assert got[1]["url"] is None and got[0]["url"] == urls[0]
    ordered = sorted(got.values(), key=lambda r: r["capture_no"])
    assert [r["capture_no"] for r in ordered] == list(range(len(rows)))
    keys = [(r["url_key"], r["captured"]) for r in ordered]
    assert keys == sorted(keys)
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_index_is_ordered_across_ranges(spark, tmp_path):
    rows = [(i, f"http://h{i % 3}.example.org/{i % 10}", f"page {i}") for i in range(200)]
    path = str(tmp_path / "archives")
    warc.write_archives(warc.with_record_types(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)), path, 30)
    index = warc.merged_index(spark, path, range_captures=20).orderBy("capture_no").collect()
    keys = [(r["url_key"], r["captured"], r["page_id"]) for r in index]
    assert [r["capture_no"] for r in index] == list(range(200)) and keys == sorted(keys)


def test_warc_rows_stand_in_index_order(spark, tmp_path, monkeypatch):
    merge = warc.merged_index
    monkeypatch.setattr(warc, "merged_index", lambda session, path: merge(session, path, range_captures=20))
    pages = [(i, f"http://s{i * 7 % 11}.org/p{i % 13}", f"<p>{i}</p>") for i in range(300)]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    want = sorted((warc.url_key(url), i * 7919 % 31536000, i) for i, url, _ in pages)
    assert [r["page_id"] for r in op10_warc(spark, str(tmp_path)).collect()] == [i for *_, i in want]
