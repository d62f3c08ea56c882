"""Aligned tokens against the two libraries and plain loops."""

import hashlib
from collections import Counter

import numpy as np
import pytest

import peerledger.llm.alignment as alignment
from conftest import edge_rows, sentence
from peerledger.llm import queries
from peerledger.llm.alignment import align
from peerledger.llm.queries import tokenizer_file

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"
ODD_TEXTS = [
    " ",
    "  two  spaces   here ",
    "a▁b takes the mark",
    "tabs\tand\r\nlines\n\n end",
    "<s>x</s> <0x0A> <unk> <|endoftext|>",
    "\x00 zero ﻿ bom 　 wide \xa0 hard",
    "é ﬁ Ünïcödé 中文字 🙂🙂 עברית",
    "don't we'll  'tis 12345 3.14 a1b2",
    "x" * 3000,
    "中" * 700,
    " " * 900 + "far",
    sentence(9, 4000),
]


@pytest.fixture(scope="module")
def libraries():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(tokenizer_file(A)), SentencePieceProcessor(model_file=tokenizer_file(B))
    a.encode_special_tokens = True
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte = {chr(x): x for x in plain} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in plain)}

    def tokens(text):
        if not text:
            return [], []
        left = [(i, bytes(byte[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        right = []
        for i in b.encode(text):
            p = b.id_to_piece(i)
            right.append((i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()))
        whole = (" " + text).encode()
        return (left, right) if b"".join(x for _, x in left) == whole == b"".join(x for _, x in right) else ([], [])

    return tokens


def answer(rows, tokens):
    parts = []
    for key, text in rows:
        spans = []
        left, right = tokens(text)
        for side in (left, right):
            at, own = 0, []
            for i, data in side:
                own.append((i, at, at + len(data)))
                at += len(data)
            spans.append(own)
        a_ends, b_ends = ({e for *_, e in own} for own in spans)
        shared = sorted(a_ends & b_ends)
        sides = [{end: [] for end in shared} for _ in spans]
        for own, side in zip(spans, sides):
            ends = iter(shared)
            end = next(ends, None)
            for i, _, e in own:
                side[end].append(str(i))
                if e == end:
                    end = next(ends, None)
        groups = [",".join(sides[0][end]) + "|" + ",".join(sides[1][end]) for end in shared]
        links, j = [], 0
        for i, s, e in spans[0]:
            while spans[1][j][2] <= s:
                j += 1
            k = j
            while k < len(spans[1]) and spans[1][k][1] < e:
                links.append((i, spans[1][k][0]))
                k += 1
        parts.append((key, left, right, groups, links))
    counts = Counter(link for *_, links in parts for link in links)
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(n, best.get(b, 0))
    return Counter(
        (key, len(left), len(right), len(groups), len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links), ";".join(groups))
        for key, left, right, groups, links in parts
    )


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")


@pytest.mark.parametrize("partitions", [1, 5])
def test_texts(spark, edges, libraries, partitions):
    rows = [(r[0], r[1]) for r in edge_rows()] + [(100 + i, t) for i, t in enumerate(ODD_TEXTS)]
    odd = spark.createDataFrame(rows[len(edge_rows()) :], "doc_id bigint, text string")
    df = edges.select("doc_id", "text", "key", "n").unionByName(odd, allowMissingColumns=True).repartition(partitions)
    got = align(df, tokenizer_file(A), tokenizer_file(B)).select("doc_id", *COLUMNS).collect()
    assert Counter(map(tuple, got)) == answer(rows, libraries)


def test_small_slices_and_memory(libraries, monkeypatch):
    """Words forgotten in between and windows met again give the same windows."""
    monkeypatch.setattr(alignment, "CACHED_WORDS", 5)
    a, b = alignment.byte_side(tokenizer_file(A)), alignment.piece_side(tokenizer_file(B))
    block = alignment.Block(0)
    for text in [*ODD_TEXTS, *ODD_TEXTS]:
        n_a, n_b, n_windows, numbers = alignment._part(block, a, b, [text, "", text])
        left, right = libraries(text)
        assert n_a.tolist() == [len(left), 0, len(left)] and n_b.tolist() == [len(right), 0, len(right)]
        shown = ";".join(block.shown[k] for k in numbers[: n_windows[0]].tolist())
        assert sum(g.split("|")[0].count(",") + 1 for g in shown.split(";") if g) == len(left)
        assert numbers[: n_windows[0]].tolist() == numbers[n_windows[0] :].tolist()


def test_models_whose_pieces_join_words(libraries, monkeypatch):
    a, b = alignment.byte_side(tokenizer_file(A)), alignment.piece_side(tokenizer_file(B))
    whole = alignment.Side(b.spelt, alignment._split_nothing, b.encode)
    for text in ODD_TEXTS:
        one, other = alignment.Block(0), alignment.Block(0)
        alone = alignment._part(one, a, b, [text])
        joined = alignment._part(other, a, whole, [text])
        assert [v.tolist() for v in alone] == [v.tolist() for v in joined] and one.shown == other.shown


def test_nothing(nothing):
    assert align(nothing, tokenizer_file(A), tokenizer_file(B)).count() == 0


def test_query(spark, edges, libraries, tmp_path):
    edges.write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op11_alignment(spark, str(tmp_path)).select("doc_id", *COLUMNS[:-1], "groups_sha256").collect()
    rows = answer([(r[0], r[1]) for r in edge_rows()], libraries)
    digest = lambda groups: hashlib.sha256(groups.encode()).hexdigest() if groups else ""
    expected = Counter()
    for row, n in rows.items():
        expected[(*row[:-1], digest(row[-1]))] += n
    assert Counter(map(tuple, got)) == expected


def test_windows_written_together(libraries):
    """All windows of a slice are written in one pass, and byte lengths need no pass per word."""
    a, b = alignment.byte_side(tokenizer_file(A)), alignment.piece_side(tokenizer_file(B))
    windows = [[([7], [12345, 0]), ([10, 99999 % len(a.spelt)], [3])], [([0], [0])], [([5, 66, 777], [1, 22, 333, 4444])]]
    groups = [g for w in windows for g in w]
    last = np.array([i == len(w) - 1 for w in windows for i in range(len(w))])
    sides = [(np.concatenate([g[s] for g in groups]), np.array([len(g[s]) for g in groups])) for s in (0, 1)]
    expected = [";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in w) for w in windows]
    assert alignment._groups_shown(a, b, *sides[0], *sides[1], last) == expected
    words = ["plain", " é", "日本", "", "🙂 x", "ÿ"]
    assert alignment._byte_lengths(words, "".join(words)).tolist() == [len(w.encode()) for w in words]
