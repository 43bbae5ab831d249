"""Recompression, filter audit and tokenizer alignment against brute force."""

import hashlib
import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import public_tokenizers
import pytest

from isoloom.llm import filter_audit, recompression, shards, token_alignment
from isoloom.llm.common import table

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, N_WORDS string, shard string, words int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
FIRST, SECOND = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, None if k % 4 == 3 else ("en", "de", "fr")[k % 3], "x", "y", 3) for k, (i, t) in enumerate(rows)], SCHEMA)


def without_repeats(texts, window):
    """doc_id to (words, removed, digest), window by window in order."""
    seen, out = set(), {}
    for doc, text in sorted(texts):
        words = WORD.findall(text or "")
        gone = set()
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            if key in seen:
                gone.update(range(i, i + window))
            seen.add(key)
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out[doc] = (len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def repeated_texts(seed):
    rng = random.Random(seed)
    some = lambda n, size: [f"w{rng.randrange(size)}" for _ in range(n)]
    shared = some(70, 5000)
    texts = [None, "", " \n\t ", "one two", " ".join(some(19, 50)), " ".join(["a"] * 500), " ".join(["a"] * 45), "b " * 20 + "a " * 41 + "b " * 41]
    texts += [" ".join(["a"] * 60 + some(30, 3) + ["a"] * 41 + ["b"] * 30), "x y " * 60, "x y z " * 50 + "q"]
    for k in range(40):
        parts = some(rng.randrange(5, 60), 5000) + shared[rng.randrange(0, 30) : rng.randrange(40, 71)] + some(rng.randrange(5, 60), 5000)
        texts.append(rng.choice([" ", "\n", " \t"]).join(parts))
        if k % 4 == 0:
            texts.append(texts[-1])
        if k % 5 == 0:
            parts[rng.randrange(len(parts))] = "edited"
            texts.append(" ".join(parts))
    texts.append(" ".join(some(3000, 4)))  # few words: very many small repeats
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("names", [recompression.BROADCAST_NAMES, 0])
def test_recompression_equals_windows(spark, names, monkeypatch):
    monkeypatch.setattr(recompression, "BROADCAST_NAMES", names)
    rows = list(enumerate(repeated_texts(3), 5))
    got = recompression.dedup(docs_of(spark, rows), 20).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got} == without_repeats(rows, 20)
    assert len(got) == len(rows)


def test_recompression_on_documents(spark):
    docs = table(spark, SF, "documents")
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in recompression.dedup(docs).collect()}
    assert got == without_repeats([tuple(r) for r in docs.select("doc_id", "text").collect()], 20)
    assert sum(r[1] for r in got.values()) > 0


def test_recompression_odd_rows(spark):
    text = " ".join(f"v{i}" for i in range(30))
    rows = [(3, text), (3, text), (None, text), (7, text + " more"), (None, None), (8, "short")]
    got = Counter((r["doc_id"], r["n_words"], r["n_removed"]) for r in recompression.dedup(docs_of(spark, rows)).collect())
    assert got == Counter([(3, 30, 0), (3, 30, 0), (None, 30, 30), (7, 31, 30), (None, 0, 0), (8, 1, 0)])
    assert recompression.dedup(docs_of(spark, rows).limit(0)).count() == 0


def test_every_window_keeps_a_symbol():
    rng = np.random.default_rng(4)
    for size in (2, 5, 1000):
        text = " ".join(f"w{i}" for i in rng.integers(0, size, 4000))
        words = recompression.words_of([text.encode()], 20)
        low, high, anchor = recompression.stretches(words, 20)
        assert low[0] == 0 and high[-1] == 3980 and (low[1:] == high[:-1] + 1).all() and (anchor != 0).all()


def audit_rows(rows, labels):
    """The audit by applying the filters one after another."""
    marks = {}
    for doc, quality, toxic in labels:
        good, bad = marks.get(doc, (False, False))
        marks[doc] = (good or quality == 1, bad or toxic == 1)
    smallest = {}
    for doc, text, _ in rows:
        if doc is not None:
            smallest[text or ""] = min(smallest.get(text or "", doc), doc)
    docs = []
    for doc, text, lang in rows:
        text = text or ""
        words = WORD.findall(text)
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)), "E": doc is not None and smallest[text] < doc,
        }
        docs.append((lang or "", fails, *(marks.get(doc) if doc in marks and doc is not None else (False, False))))
    out = {}
    for part in {d[0] for d in docs}:
        own = [d[1:] for d in docs if d[0] == part]
        shapley = Counter()
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, f in enumerate(order, 1):
                kept, gone = [d for d in left if not d[0][f]], [d for d in left if d[0][f]]
                redundant = sum(d[0][f] for d in own) - len(gone)
                alone = sum(d[0][f] and sum(d[0].values()) == 1 for d in own)
                out[part, order, step] = [len(kept), len(gone), redundant, alone, sum(d[1] for d in gone), sum(d[2] for d in gone)]
                shapley[f] += len(gone)
                left = kept
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return out


def test_filter_audit_equals_filters_in_turn(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "BUCKET_WORDS", 300)
    rng = random.Random(5)
    texts = [None, "", "A " * 300, "a b " * 120, "ÄÖÜ Zz x " * 90, "x#y", " ".join(map(str, range(250))), "Q" * 5000 + " r"]
    texts += [" ".join(f"w{rng.randrange(rng.choice([20, 900]))}" for _ in range(rng.randrange(150, 400))) for _ in range(30)]
    texts += rng.sample(texts, 15)
    rows = [(i, t) for i, t in enumerate(texts)] + [(2, "again"), (2, texts[2]), (None, texts[2]), (None, "only here"), (None, "only here")]
    docs = docs_of(spark, rows)
    labels = [(i, rng.randrange(2), rng.randrange(2)) for i in range(0, 50, 2)] + [(4, 1, 0), (4, None, 1), (None, 1, 1), (9, None, None)]
    got = filter_audit.audit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    found = {tuple(r[:3]): list(r[3:]) for r in got.collect()}
    assert found == audit_rows([tuple(r) for r in docs.select("doc_id", "text", "lang").collect()], labels)
    assert filter_audit.audit(docs.limit(0), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).count() == 0


def test_matrix_numbers_words_alike(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "BUCKET_WORDS", 7)
    texts = ["b a b", None, "a c", "c c c d", "", "e"]
    blocks = filter_audit.term_shards(docs_of(spark, list(enumerate(texts))).repartition(3), ["doc_id"])
    word = {r["number"]: r["word"] for r in filter_audit.dictionary(blocks).collect()}
    assert sorted(word.values()) == list("abcde")
    seen = {}
    for block in filter_audit.matrix(blocks, ["doc_id"]).collect():
        for i, doc in enumerate(block["doc_id"]):
            cells = range(block["starts"][i], block["starts"][i + 1])
            assert [block["columns"][c] for c in cells] == sorted({block["columns"][c] for c in cells})
            seen[doc] = {word[block["columns"][c]]: block["data"][c] for c in cells}
    assert seen == {i: dict(Counter((t or "").split())) for i, t in enumerate(texts)}


def aligned(texts):
    """The alignment text by text with whole encodings."""
    both = token_alignment.Codec(FIRST, SECOND)
    vocabulary = {i: w for w, i in both.a.get_vocab().items()}
    hidden = [b for b in range(256) if not (33 <= b < 127 or 161 <= b < 173 or b >= 174)]
    byte = {chr(256 + hidden.index(b)) if b in hidden else chr(b): b for b in range(256)}
    docs = []
    for text in texts:
        a = both.a.encode(" " + text, add_special_tokens=False).ids if text else []
        b = both.b.encode(text) if text else []
        a_bytes, b_bytes = [bytes(byte[c] for c in vocabulary[i]) for i in a], [both.b_bytes[i] for i in b]
        whole = (" " + (text or "")).encode()
        if b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            a, b, a_bytes, b_bytes = [], [], [], []
        ends = [set(np.cumsum([len(x) for x in s]).tolist()) for s in (a_bytes, b_bytes)]
        groups, at, i, j = [], 0, 0, 0
        for end in sorted(ends[0] & ends[1]):
            left, right, x, y = [], [], at, at
            while x < end:
                left.append(a[i]), (x := x + len(a_bytes[i])), (i := i + 1)
            while y < end:
                right.append(b[j]), (y := y + len(b_bytes[j])), (j := j + 1)
            groups.append((left, right))
            at = end
        docs.append((len(a), len(b), groups))
    count = Counter(pair for _, _, groups in docs for pair in {(x, y) for left, right in groups for x in left for y in right})
    best = {}
    for (x, _), n in count.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for n_a, n_b, groups in docs:
        links = [(x, y) for left, right in groups for x in left for y in right]
        text = ";".join(",".join(map(str, left)) + "|" + ",".join(map(str, right)) for left, right in groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if groups else ""
        out.append((n_a, n_b, len(groups), len(links), sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links), digest))
    return out


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
ODD_TEXTS = [
    None, "", " ", "a", " a", "a ", "a  b\n\nc \n d", "x y 　z  w", "᠎ ​ q﻿ r", "a▁b", "tab\tand\rreturn\x1cfs \x85 nel",
    "<s>hi</s> <unk> <|endoftext|> <0x41>", "zero\0byte \0 end", "naïve café 日本語のテキスト 👩‍👩‍👧 \U0001f600", "don't we'll 12345 $$$ %%%&&&", "a" * 9000, "ab" * 3000 + " " + "?" * 700,
    "line\nline two\nend", "é ́x", "\n\n", "same words same words", "same words same words",
]


@pytest.mark.parametrize("size", [token_alignment.SHARD_BYTES, 3000])
def test_alignment_equals_whole_texts(spark, size, monkeypatch):
    monkeypatch.setattr(token_alignment, "SHARD_BYTES", size)
    monkeypatch.setattr(token_alignment, "LARGE_GROUP", 4)
    texts = ODD_TEXTS + [r[0] for r in table(spark, SF, "documents").select("text").limit(60).collect()]
    docs = docs_of(spark, list(enumerate(texts))).repartition(3)
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in token_alignment.align(docs, FIRST, SECOND).collect()}
    want = aligned(texts)
    assert {i: r for i, r in got.items() if r != want[i]} == {} and len(got) == len(want)
    assert token_alignment.align(docs.limit(0), FIRST, SECOND).count() == 0


def test_shards_keep_order_and_rows(spark):
    docs = docs_of(spark, [(i, "x" * (i * 50)) for i in range(40)] + [(None, None)])

    class Lengths:
        def __init__(self):
            self.sizes = []

        def add(self, text):
            self.sizes.append(len(text or ""))

        def lists(self):
            return {"sizes": self.sizes}

    rows = shards.in_shards(docs, "text", ["doc_id", "lang"], "sizes array<int>", Lengths, limit=2000).collect()
    assert len({r["shard"] for r in rows}) == len(rows) > 8
    pairs = [p for r in rows for p in zip(r["doc_id"], r["sizes"])]
    assert sorted(pairs, key=str) == sorted([(i, i * 50) for i in range(40)] + [(None, 0)], key=str)
