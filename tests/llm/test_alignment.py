"""Tokenizer alignment against whole texts encoded at once and pairs counted one by one."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldgauge.llm import alignment, perfect_hash, queries, vectors
from tests.llm.conftest import SCHEMA

SF = "/root/testdata/sf0.001"
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
ODD_TEXTS = [
    "a  b", " lead", "trail ", "  ", "\n", "\n\n x", "a \n b", "tab\t x", "<|endoftext|> <s></s><unk> <0x41>", "it's 'tis",
    "a▁b", "▁", "x ▁ y", "ａ　ｂ wide", "  x   y", "é é", "\U0001f600 \U0001f468‍\U0001f469‍\U0001f467!",
    "\x00\x01 \x1c x", "a" * 3000, "1234567 89", "don't  stop   me    now", "x\r\n  y", "​ z﻿ q", " \u0085 n",
]


@pytest.fixture(scope="module")
def files():
    return queries.tokenizer_files()


@pytest.fixture(scope="module")
def aligner(files):
    return alignment.Aligner(*files)


def test_quick_encoding_is_the_vocabularys_own(files, aligner):
    ranks = alignment.ranks_of(files[0])
    assert ranks is not None
    quick = alignment.Aligner(*files, ranks)
    deal = random.Random(4)
    for text in ODD_TEXTS + ["".join(chr(deal.randrange(1, 0x250)) for _ in range(40)) for _ in range(300)]:
        assert quick.quick(text) == aligner.slow(text), text
    # a merge list in another order than the ids has no ranks
    import json

    other = json.loads(files[0])
    other["model"]["merges"] = other["model"]["merges"][:5] + other["model"]["merges"][4:]
    assert alignment.ranks_of(json.dumps(other)) is None


def plain(aligner, texts):
    """Rows of the result by encoding whole texts and walking over single bytes."""
    found = []
    for text in texts:
        whole = f" {text}".encode() if text else b""
        a = aligner.slow(f" {text}") if text else []
        b = aligner.b.encode(text) if text else []
        spelled = [b"".join(aligner.a_bytes[i] for i in a), b"".join(aligner.b_bytes[i] for i in b)]
        found.append((a, b) if text and spelled == [whole, whole] else ([], []))
    rows, counts = [], Counter()
    for a, b in found:
        owners = [[k for k, i in enumerate(ids) for _ in sizes[i]] for ids, sizes in ((a, aligner.a_bytes), (b, aligner.b_bytes))]
        links = sorted(set(zip(*owners)))
        pairs = [(a[i], b[k]) for i, k in links]
        groups, left, right = [], [], []
        for at, (i, k) in enumerate(links):
            if i not in left:
                left.append(i)
            if k not in right:
                right.append(k)
            last = at + 1 == len(links)
            if last or (links[at + 1][0] != i and links[at + 1][1] != k):
                groups.append(f"{','.join(str(a[x]) for x in left)}|{','.join(str(b[x]) for x in right)}")
                left, right = [], []
        counts.update(set(pairs))
        rows.append((len(a), len(b), pairs, groups))
    best = defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    return [
        (n_a, n_b, len(groups), len(pairs), sum(counts[p] == best[p[0]] for p in pairs), sum(counts[p] for p in pairs), ";".join(groups))
        for n_a, n_b, pairs, groups in rows
    ]


def test_alignment_equals_whole_texts(spark, files, aligner):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    want = dict(zip(texts, plain(aligner, texts.values())))
    got = alignment.align(docs, *files).collect()
    assert len(got) == len(texts)
    for row in got:
        assert tuple(row[c] for c in COLUMNS) == want[row.doc_id], row.doc_id
    digests = {r.doc_id: r.groups_sha256 for r in queries.op13_alignment(spark, SF).collect()}
    assert digests == {d: hashlib.sha256(w[-1].encode()).hexdigest() if w[-1] else "" for d, w in want.items()}


@pytest.mark.parametrize("most_pairs", [alignment.MOST_PAIRS, 10])
def test_alignment_of_odd_texts(frame, odd_rows, files, aligner, most_pairs):
    deal = random.Random(3)
    mixed = ["".join(deal.choices([" ", "  ", "\n", "\t", "ab", "the", "é", "▂", " ", "7", "'s", "-"], k=30)) for _ in range(150)]
    rows = odd_rows + [(1000 + i, t, "x") for i, t in enumerate(ODD_TEXTS + mixed)]
    want = plain(aligner, [t for _, t, _ in rows])
    got = alignment.align(frame(rows), *files, most_pairs=most_pairs).collect()
    key = lambda x: (str(x[0]), x[1:])
    assert sorted([(r.doc_id, *(r[c] for c in COLUMNS)) for r in got], key=key) == sorted(
        [(i, *w) for (i, _, _), w in zip(rows, want)], key=key)


def test_alignment_of_an_empty_table_and_clashing_names(spark, clash, files):
    none = spark.createDataFrame([], SCHEMA)
    assert alignment.align(none, *files).collect() == []
    assert alignment.align(none, *files, most_pairs=-1).collect() == []
    more = clash.withColumns({c: F.lit(1) for c in ["pair", "n", "row", "pairs", "a", "groups", "task", "block", "body"]})
    assert alignment.align(more, *files).count() == clash.count()


def test_undecodable_text_has_no_tokens(spark, files):
    docs = spark.createDataFrame([(1, b"\xff\xfe x"), (2, b"fine")], "doc_id bigint, text binary")
    rows = {r.doc_id: r.n_a for r in alignment.align(docs.withColumn("text", F.col("text").cast("string")), *files).collect()}
    assert rows[1] == 0 and rows[2] > 0


def test_perfect_hash_is_minimal_and_verified(spark):
    deal = np.random.default_rng(1)
    keys = np.unique((deal.integers(0, 50_000, 40_000) << 32) | deal.integers(0, 32_000, 40_000))
    table = spark.createDataFrame([(int(k),) for k in keys], "pair bigint")
    hashed = perfect_hash.perfect_hash(table, "pair", len(keys), bucket=3000)
    assert sorted(hashed.index(keys)) == list(range(len(keys)))
    strangers = np.setdiff1d(keys + 1, keys)
    assert (hashed.index(strangers) == -1).all()
    empty = perfect_hash.perfect_hash(table.limit(0), "pair", 0)
    assert list(empty.index(keys[:3])) == [-1, -1, -1]


def test_tree_sum_adds_all_vectors(spark):
    length, tasks = vectors.BLOCK + 7, 40
    rows = [(t, block, body) for t in range(tasks) if t != 5
            for batch in vectors.blocks(np.full(length, t, np.int64), t)
            for _, block, body in zip(*batch.to_pydict().values())]
    parts = spark.createDataFrame(rows, vectors.SCHEMA)
    assert (vectors.tree_sum(parts, tasks, length, "int64") == sum(range(tasks)) - 5).all()
