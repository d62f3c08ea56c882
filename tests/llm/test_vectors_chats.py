"""Embeddings, conversations and the pipeline on edge tables and against brute force."""

import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from peerledger.llm import metric_join
from peerledger.llm.chat_format import rotate
from peerledger.llm.metric_join import near_vectors


def vector_answer(rows, cosine):
    def usable(label, v):
        return label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = [0] * len(rows)
    for i, (_, v, a) in enumerate(rows):
        for j, (_, w, b) in enumerate(rows[:i]):
            if usable(a, v) and usable(b, w) and a == b and len(v) == len(w):
                x, y = np.array(v, np.float32).astype(float), np.array(w, np.float32).astype(float)
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= cosine:
                    links[i] += 1
                    links[j] += 1
                    parent[find(i)] = find(j)
    least = defaultdict(list)
    for i, row in enumerate(rows):
        least[find(i)].append(row[0])
    answer = []
    for i, (key, _, _) in enumerate(rows):
        component = min((k for k in least[find(i)] if k is not None), default=None)
        answer.append((key, links[i], component, key == component))
    return Counter(answer)


def test_near_vectors(spark, monkeypatch):
    draw = np.random.default_rng(2)
    rows = []
    centres = draw.normal(size=(12, 8))
    for i in range(240):
        rows.append((i, (centres[i % 12] + draw.normal(size=8) * 0.08).tolist(), i % 3 if i % 7 else None))
    rows += [(500 + i, rows[1][1], rows[1][2]) for i in range(30)]
    rows += [(600, None, 1), (601, [0.0] * 8, 1), (602, [None] + [1.0] * 7, 1), (603, [float("nan")] * 8, 1), (604, [], 1), (605, [1.0, 2.0], 1)]
    rows += [(606, [2 * x for x in rows[2][1]], rows[2][2]), (None, rows[2][1], rows[2][2]), (500, rows[1][1], rows[1][2]), (607, [float("inf")] * 8, 0)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id bigint, embedding array<float>, label int, cell string, key int")
    expected = vector_answer(rows, 0.98)
    for cell, block in ((1024, 1024), (8, 5)):
        monkeypatch.setattr(metric_join, "BLOCK", block)
        got = near_vectors(df, cell=cell).collect()
        assert Counter(map(tuple, got)) == expected
    assert near_vectors(df.filter("vec_id < 0")).count() == 0


def dense_answer(labels, vectors, cosine):
    """Links, and the smallest linked row, of each row, label by label."""
    links, least = np.zeros(len(labels), np.int64), np.arange(len(labels))
    for label in set(labels):
        own = np.flatnonzero(np.array(labels) == label)
        norms = np.linalg.norm(vectors[own], axis=1)
        near = vectors[own] @ vectors[own].T / (norms[:, None] * norms[None, :]) >= cosine
        links[own] = near.sum(axis=1) - 1
        root = own.copy()
        while True:
            lower = np.array([root[row].min() for row in near])
            if (lower == root).all():
                break
            root = lower
        least[own] = root
    return {(i, int(links[i]), int(least[i]), bool(least[i] == i)) for i in range(len(labels))}


def test_one_hot_label_and_many_small_ones(spark):
    """Half of the vectors under one label: it has pivots of its own, chains of links run through its cells."""
    draw = np.random.default_rng(6)
    n, dim = 8000, 12
    labels = ["hot" if i % 2 else f"small{i % 200}" for i in range(n)]
    vectors = draw.normal(size=(n, dim))
    for start in range(1, n, 400):  # walks in small steps: rows of one label linked one after the other
        for k in range(1, 12):
            vectors[start + 2 * k] = vectors[start + 2 * k - 2] + draw.normal(size=dim) * 0.12
    vectors[3000:3200] = vectors[3000] + draw.normal(size=(200, dim)) * 0.02
    df = spark.createDataFrame([(i, labels[i], v.tolist()) for i, v in enumerate(vectors)], "vec_id bigint, label string, embedding array<double>").repartition(6)
    points = df.select(F.col("vec_id").alias("cid"), "label", F.size("embedding").alias("dim"), F.col("embedding").alias("vector"))
    radius = float(np.sqrt(0.04))
    assert {r.label: len(r.points) // dim > 10 for r in metric_join.pivots_of(points, 128, radius).collect()} == {"hot": True}
    expected = dense_answer(labels, vectors, 0.98)
    assert sum(x[1] > 0 for x in expected) > 300
    for cell in (128, 1024, 10**6):
        assert {tuple(r) for r in near_vectors(df, cell=cell).collect()} == expected


def test_a_dense_cloud_has_few_cells(spark):
    draw = np.random.default_rng(3)
    cloud = (np.ones(8) + draw.normal(size=(3000, 8)) * 0.01).tolist()
    points = spark.createDataFrame([(i, 1, 8, v) for i, v in enumerate(cloud)], "cid bigint, label int, dim int, vector array<double>")
    (row,) = metric_join.pivots_of(points, 100, float(np.sqrt(0.04))).collect()
    assert len(row.points) // 8 <= 8
    visits = sum(len(r) for _, r, _ in metric_join.visits_of(metric_join._units(np.array(cloud)), np.array(row.points).reshape(-1, 8), 0.2))
    assert visits <= 2 * metric_join.COPIES * len(cloud)


def chat_answer(rows, turns):
    said = defaultdict(set)
    for conv, turn, role, text in rows:
        said[conv].add((turn, role, text or ""))
    import hashlib

    answer = Counter()
    for conv, lines in said.items():
        lines = sorted(lines, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "", hashlib.md5(r[2].encode()).hexdigest()))
        for who in {r[1] for r in lines if r[1] not in (None, "system")}:
            start = 0
            for part in range(0, len(lines), turns):
                text, masks = "", []
                for _, role, line in lines[part : part + turns]:
                    head = "<|assistant|>\n" if role == who else "<|system|>\n" if role == "system" else f"<|user name={role or 'unknown'}|>\n"
                    begin = len(text) + len(head)
                    text += head + line + "<|end|>\n"
                    if role == who:
                        masks.append((begin, len(text)))
                answer[conv, who, part // turns, start, text, len(lines[part : part + turns]), tuple(masks)] += 1
                start += len(text)
    return answer


def test_rotation(spark, monkeypatch):
    from peerledger.llm import chat_format

    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi 🙂"), (1, 2, "bob", "hello"), (1, 3, "ann", ""), (1, 3, "ann", "again"), (1, 2, "bob", "hello")]
    rows += [(2, 0, "system", "alone"), (3, None, "ann", "when?"), (3, 5, None, "who?"), (3, 5, "cat", None), (None, 1, "ann", "lost"), (None, 1, "bob", "lost")]
    rows += [(4, i, ("ann", "bob", "cat")[i % 3], f"line {i} " * 20) for i in range(700)] + [(5, 7, "ann", f"same turn {i}") for i in range(300)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id bigint, turn int, role string, text string, pos int, part string")
    expected = chat_answer(rows, 64)
    for crowded in (4096, 20):
        monkeypatch.setattr(chat_format, "CROWDED", crowded)
        got = rotate(df).collect()
        found = Counter((r.conv_id, r.perspective, r.part, r.start, r.text, r.n_turns, tuple((m.begin, m.end) for m in r.masks)) for r in got)
        assert found == expected
    assert rotate(df.filter("conv_id = 99")).count() == 0


def test_pipeline_against_brute_force(spark, edges):
    from test_texts import BLANK, jaccard_answer, water_filled

    docs = edges
    got = {}
    for name, apply in corpus_pipeline.STAGES:
        docs = apply(spark, docs, "").persist()
        got[name] = docs.collect()
        if name != "token_ids":
            assert docs.columns == edges.columns
    rows = edges.collect()
    with_language = [r for r in rows if r.text and any(c.isalpha() for c in r.text)]
    assert Counter(map(repr, got["language"])) == Counter(map(repr, with_language))
    best = {}
    for r in with_language:
        if r.text not in best or (best[r.text].doc_id or -1) < (r.doc_id or -1):
            best[r.text] = r
    assert Counter(map(repr, got["exact_copies"])) == Counter(map(repr, best.values()))
    answer = jaccard_answer([(r.doc_id, r.text) for r in best.values()], 5, 80)
    assert Counter(r.doc_id for r in got["near_copies"]) == Counter({c for _, _, c in answer})
    sizes = defaultdict(int)
    for r in got["near_copies"]:
        sizes[r.source] += len(BLANK.findall(r.text.encode()))
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    wanted = water_filled([sizes[s] for s in order], [(3, 1, 2)[i % 3] for i in range(len(order))], 1.5, 2)
    for s, target in zip(order, wanted):
        own = [len(BLANK.findall(r.text.encode())) for r in got["mixture"] if r.source == s]
        largest = max(len(BLANK.findall(r.text.encode())) for r in got["near_copies"] if r.source == s)
        assert abs(sum(own) - target) <= largest / 2 + 2
    assert max(Counter(r.doc_id for r in got["mixture"]).values()) <= 2
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = Counter((r.doc_id, tuple(library.encode(r.text, add_special_tokens=False).ids), len(r.text.encode())) for r in got["mixture"])
    assert Counter((r.doc_id, tuple(r.ids), r.n_bytes) for r in got["token_ids"]) == ids


def test_pipeline_rejects_texts_of_no_known_language(spark):
    draw = random.Random(3)
    words = ["".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(2000)]
    rows = [(i, " ".join(draw.sample(words[i % 2 :: 2], 60)), ("en", "de")[i % 2]) for i in range(400)]
    foreign = [(1000 + i, " ".join("".join(draw.choice("αβγδεζηθικλμνξοπρστυφχψω") for _ in range(6)) for _ in range(60)), None) for i in range(40)]
    docs = spark.createDataFrame(rows + foreign, "doc_id int, text string, lang string")
    kept = dict(corpus_pipeline.STAGES)["language"](spark, docs, "").collect()
    assert sorted(r.doc_id for r in kept) == list(range(400))


def test_pipeline_of_nothing(spark, nothing):
    docs = nothing
    for _, apply in corpus_pipeline.STAGES:
        docs = apply(spark, docs, "")
    assert docs.count() == 0
