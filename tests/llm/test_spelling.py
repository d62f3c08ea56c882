"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import peerledger.llm.spelling as spelling
from conftest import edge_rows
from peerledger.llm import queries
from peerledger.llm.spelling import keyed_crc, near_pairs, spelling_forms, word_counts

A_TO_Z = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def counted(rows, least_length, least_count, deletion):
    seen = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(A_TO_Z)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if deletion and h % deletion == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= least_length:
                seen[run] += 1
    return {w: n for w, n in seen.items() if n >= least_count}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def answer(words, ratio):
    near = {w: [v for v in words if one_edit(v, w)] for w in words}
    form = {}
    for w, some in near.items():
        best = min(some, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None
    rows = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        rows.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return Counter(rows)


def wordy(seed, size, alphabet="abé"):
    """Few letters make many near words; counts are very uneven."""
    draw = random.Random(seed)
    words = {"".join(draw.choice(alphabet) for _ in range(draw.choice([1, 6, 6, 7, 7, 8, 12]))): int(5 * 1.1 ** draw.randrange(60)) for _ in range(size)}
    words |= {"z" * 3000: 9, "z" * 3001: 50, "z" * 2999 + "y": 9, "aaaaaa": 10**9}
    return words


@pytest.mark.parametrize("block", [1024, 7])
def test_forms(spark, monkeypatch, block):
    monkeypatch.setattr(spelling, "BLOCK", block)
    words = wordy(3, 400)
    df = spark.createDataFrame(list(words.items()), "word string, n bigint").repartition(5)
    got = spelling_forms(df).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert Counter(map(tuple, got)) == answer(words, 5)


def test_pairs_come_once(spark):
    words = wordy(4, 300)
    df = spark.createDataFrame(list(words.items()), "word string, n bigint").repartition(3)
    got = [frozenset((r.a, r.b)) for r in near_pairs(df).collect()]
    assert len(got) == len(set(got))
    assert set(got) == {frozenset((a, b)) for a in words for b in words if a < b and one_edit(a, b)}


def test_one_edit_in_every_place(spark):
    base = "abcdefghij"
    words = {base: 100}
    for i in range(len(base)):
        words |= {base[:i] + base[i + 1 :]: 5, base[:i] + "x" + base[i:]: 5, base[:i] + "y" + base[i + 1 :]: 5}
    words[base + "x"] = 5
    df = spark.createDataFrame(list(words.items()), "word string, n bigint")
    row = next(r for r in spelling_forms(df).collect() if r.word == base)
    assert row.n_near == len(words) - 1


def test_words_of_texts(spark, edges):
    texts = [(r[0], r[1]) for r in edge_rows()] + [(7, "Öffnung ÖFFNUNG öffnungen a×÷bcdef " * 200)]
    df = edges.select("doc_id", "text").union(spark.createDataFrame([texts[-1]], "doc_id bigint, text string"))
    for deletion in (None, 3):
        got = {r.word: r.n for r in word_counts(df, least_length=5, least_count=2, deletion=deletion).collect()}
        assert got == counted(texts, 5, 2, deletion)


def test_words_handed_on_early(monkeypatch):
    monkeypatch.setattr(spelling, "HELD_WORDS", 3)
    monkeypatch.setattr(spelling, "SLICE_CHARS", 100)
    rows = [(r[0], r[1]) for r in edge_rows()]
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows])], ["key", "text"])
    parts = list(spelling._count_words(iter([batch]), 4, 5))
    assert len(parts) > 3
    got = Counter()
    for part in parts:
        for word, n in zip(*(c.to_pylist() for c in part.columns)):
            got[word] += n
    assert got == counted(rows, 4, 1, 5)


def test_checksum_of_runs():
    text = "abcÿé" * 3 + "x"
    letters = np.frombuffer(text.encode("latin-1"), np.uint8)
    begin, end = np.array([0, 3, 5, 15]), np.array([16, 5, 5, 16])
    got = keyed_crc([b"12:", b"-3:"], np.array([0, 1, 1, 0]), letters, begin, end).tolist()
    assert got == [zlib.crc32((p + text[a:b]).encode()) for p, a, b in zip(["12:", "-3:", "-3:", "12:"], begin, end)]


def test_nothing(spark, nothing):
    assert spelling_forms(word_counts(nothing)).count() == 0


def test_query(spark, tmp_path):
    draw = random.Random(5)
    texts = [(i, " ".join(draw.choice(["abcdefgh", "abcdefg", "bcdefgh", "Zürich", "zürichs"]) for _ in range(200))) for i in range(40)]
    spark.createDataFrame(texts, "doc_id bigint, text string").withColumn("n", F.lit(1)).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op13_spelling_variants(spark, str(tmp_path)).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert Counter(map(tuple, got)) == answer(counted(texts, 6, 5, 199), 5)
