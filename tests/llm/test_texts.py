"""Text operators on edge tables and against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from conftest import sentence
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import SCHEMA, edge_rows
from peerledger.llm import suffix_dedup
from peerledger.llm.bpe import decode, encode
from peerledger.llm.components import components
from peerledger.llm.exact_dedup import exact_dedup
from peerledger.llm.jaccard import Part, near_duplicates, places
from peerledger.llm.language_id import MIN_SHARE, NEAR_BEST, UNKNOWN, grams_of, predict, train
from peerledger.llm.mixing import mix
from peerledger.llm.sharding import jump_hash, shard
from peerledger.llm.suffix_dedup import remove_repeats
from peerledger.llm.token_store import WaveletMatrix, occurrences, read_tokens, tokens_at, write_tokens
from peerledger.llm.words import BYTE, WORD, code_point_classes, encoder, flat_ids, split_words, spread
from peerledger.session import fresh_path

BLANK = re.compile(rb"[^\x20\x09-\x0D]+")


def docs():
    return [(r[0], r[1] or "") for r in edge_rows()]


def texts_by_id():
    found = defaultdict(list)
    for i, t in docs():
        found[i].append(t)
    return found


def weak(key):
    """A hash under which nearly everything collides."""
    return F.pmod(F.xxhash64(key), F.lit(3))


@pytest.mark.parametrize("options", [{}, {"block_bytes": 7}, {"block_bytes": 64, "bucket": weak}, {"bucket": weak}])
def test_exact_dedup(edges, options):
    got = exact_dedup(edges, **options).select("doc.*", "keep_id", "group_size", "kept").collect()
    groups = defaultdict(list)
    for i, t in docs():
        groups[t].append(i)
    assert len(got) == len(docs())
    for r in got:
        same = groups[r.text or ""]
        assert r.group_size == len(same)
        assert r.keep_id == max((i for i in same if i is not None), default=None)
    kept = Counter(r.text or "" for r in got if r.kept)
    assert kept == Counter(groups.keys())
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_dedup_of_nothing(nothing):
    assert exact_dedup(nothing).count() == 0


def published_jump(key: int, buckets: int) -> int:
    b, j = -1, 0
    while j < buckets:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_hash_is_the_published_one(spark):
    keys = [0, 1, -1, 2**63 - 1, -(2**63), *range(100, 160)]
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    for n in (1, 2, 8, 50):
        for r in df.select("k", jump_hash(F.col("k"), n).alias("j")).collect():
            assert (r.j.shard, r.j.grown) == (published_jump(r.k % 2**64, n), published_jump(r.k % 2**64, n + 1))


def test_sharding(edges, nothing):
    got = shard(edges).collect()
    assert len(got) == len(docs())
    by_key = {}
    for r in got:
        assert by_key.setdefault(r.doc_id, (r.shard, r.grown_shard)) == (r.shard, r.grown_shard)
        assert r.grown_shard in (r.shard, 8)
    for s in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    expected = Counter((i, len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in docs())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == expected
    assert shard(nothing).count() == 0


def water_filled(sizes, weights, share, limit):
    total, left, target, free = sum(sizes) * share, None, {}, set(range(len(sizes)))
    left = total
    while free:
        level = left / sum(weights[i] for i in free)
        full = [i for i in free if level * weights[i] >= limit * sizes[i]]
        if not full:
            target |= {i: level * weights[i] for i in free}
            break
        for i in full:
            target[i] = limit * sizes[i]
            left -= target[i]
            free.discard(i)
    return [target[i] for i in range(len(sizes))]


def test_mixing(edges, nothing):
    got = mix(edges).select("doc.doc_id", "doc.source", "size", "source_size", "target", "taken", "per_shard").collect()
    assert len(got) == len(docs())
    sizes = defaultdict(int)
    for r in edge_rows():
        sizes[r[3]] += len(BLANK.findall((r[1] or "").encode()))
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    weights = [(3, 1, 2)[i % 3] for i in range(len(order))]
    for s, target in zip(order, water_filled([sizes[s] for s in order], weights, 1.5, 2)):
        own = [r for r in got if r.source == s]
        assert all(r.source_size == sizes[s] and abs(r.target - target) <= 1e-6 * target for r in own)
        assert abs(sum(r.taken for r in own) - target) <= 2
    assert all(0 <= r.taken <= 2 * r.size and sum(r.per_shard) == r.taken for r in got)
    assert sorted(map(repr, got)) == sorted(map(repr, mix(edges.coalesce(1)).select(*[f"doc.{c}" for c in ("doc_id", "source")], "size", "source_size", "target", "taken", "per_shard").collect()))
    assert mix(nothing).count() == 0


def test_mixing_gives_seats_by_highest_quotients(spark):
    rows = [(i, " ".join(["w"] * n), f"s{i % 4}") for i, n in enumerate([500, 90, 40, 7] * 5)]
    got = mix(spark.createDataFrame(rows, "doc_id bigint, text string, source string"), blocks=100, shards=3)
    got = got.select("doc.source", "target", "taken", "per_shard").collect()
    targets = {r.source: r.target for r in got}
    block = max(1, round(sum(targets.values()) / max(100, 64 * 4)))
    seats = sorted(((t / (2 * k + 1), s) for s, t in targets.items() for k in range(1000)), key=lambda q: (-q[0], q[1]))
    won = Counter(s for _, s in seats[: round(sum(targets.values()) / block)])
    for s in targets:
        size = sum(n for i, n in enumerate([500, 90, 40, 7] * 5) if f"s{i % 4}" == s)
        assert sum(r.taken for r in got if r.source == s) == min(won[s] * block, 2 * size)


def test_mixing_keeps_small_sources(spark):
    rows = [(i, " ".join(["w"] * 1000), "big") for i in range(500)]
    rows += [(1000, "one two three", "small"), (1001, " ".join(["w"] * 300), "middle"), (1002, None, "none")]
    shards = 5
    got = mix(spark.createDataFrame(rows, "doc_id bigint, text string, source string"), blocks=16, shards=shards)
    got = got.select("doc.source", "target", "taken", "per_shard").collect()
    targets = {r.source: r.target for r in got}
    assert targets["small"] == 6 and targets["middle"] == 600
    taken = {s: sum(r.taken for r in got if r.source == s) for s in targets}
    assert taken["small"] == 6 and abs(taken["middle"] - 600) <= 600 / 64 and taken["none"] == 0
    assert abs(taken["big"] - targets["big"]) <= targets["big"] / 64
    total = round(sum(targets.values()))  # blocks of one word
    seats = sorted(((t / (2 * k + 1), s) for s, t in targets.items() for k in range(round(t) + 1)), key=lambda q: (-q[0], q[1]))[:total]
    per_shard = -(-total // shards)
    for i in range(shards):
        won = Counter(s for _, s in seats[i * per_shard : (i + 1) * per_shard])
        assert all(sum(r.per_shard[i] for r in got if r.source == s) == won[s] for s in targets)


def jaccard_answer(rows, words, percent):
    sets = []
    for _, t in rows:
        found = [w.lower() for w in BLANK.findall(t.encode())]
        whole = [tuple(found)] if found else []
        sets.append(frozenset(tuple(found[i : i + words]) for i in range(len(found) - words + 1)) if len(found) >= words else frozenset(whole))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= percent * len(sets[i] | sets[j]):
            parent[find(i)] = find(j)
    least = defaultdict(list)
    for i, (key, _) in enumerate(rows):
        least[find(i)].append(key)
    return Counter((key, len(sets[i]), min((k for k in least[find(i)] if k is not None), default=None)) for i, (key, _) in enumerate(rows))


@pytest.mark.parametrize("words,percent", [(4, 85), (5, 80), (2, 50)])
def test_near_duplicates(edges, words, percent):
    got = near_duplicates(edges, words=words, percent=percent).select("doc.doc_id", "n_shingles", "component_id", "kept").collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == jaccard_answer(docs(), words, percent)
    groups = Counter(r.component_id for r in got if r.n_shingles)
    assert Counter(r.component_id for r in got if r.kept and r.n_shingles) == Counter(groups.keys())
    assert all(r.kept for r in got if not r.n_shingles)


def test_near_duplicates_in_chains_and_crowds(spark):
    base = [f"w{i}" for i in range(60)]
    rows = [(0, " ".join(base))]
    for i in range(1, 25):  # each two words away from the one before: ends of the chain are not similar
        base[2 * i] = f"v{i}"
        rows.append((i, " ".join(base)))
    crowd = [f"c{i}" for i in range(200)]
    for i in range(40):  # all near one original, not all near each other
        mine = list(crowd)
        for j in range(4):
            mine[(i * 37 + j * 11) % 200] = f"x{i}.{j}"
        rows.append((100 + i, " ".join(mine)))
    passage = " ".join(f"p{i}" for i in range(40))
    rows += [(200 + i, passage + " " + " ".join(f"q{i}.{j}" for j in range(200))) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    for words, percent in ((3, 80), (4, 85)):
        got = near_duplicates(df, words=words, percent=percent).select("doc.doc_id", "n_shingles", "component_id").collect()
        assert Counter(map(tuple, got)) == jaccard_answer(rows, words, percent)


def test_many_near_copies_of_long_texts(spark):
    """1,500 near copies of 25 KB: one component, in parts that are bounded by bytes."""
    base = sentence(77, 3500).split(" ")
    draw = random.Random(12)

    def copy(i):
        words = list(base)
        for _ in range(3):
            words[draw.randrange(len(words))] = f"edit{i}"
        return " ".join(words)

    rows = [(i, copy(i)) for i in range(1500)] + [(2000 + i, sentence(300 + i, 3500)) for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8)
    got = {r.doc_id: (r.component_id, r.kept) for r in near_duplicates(df, carry=[F.col("doc_id")]).select("doc.doc_id", "component_id", "kept").collect()}
    assert got == {i: (0, i == 0) for i in range(1500)} | {2000 + i: (2000 + i, True) for i in range(5)}


def test_parts_answer_as_plain_sets_do():
    draw = np.random.default_rng(4)
    sets = [np.unique(draw.integers(0, 60, size=draw.integers(1, 50)).astype(np.uint64) * np.uint64(7)) for _ in range(40)]
    union, members = np.unique(np.concatenate(sets[:30]), return_inverse=True)
    sizes = np.array([len(s) for s in sets[:30]])
    part = Part(union, sizes, members.ravel(), np.arange(100, 130), np.arange(30) % 4)
    for percent in (30, 50, 80):
        for tokens in sets:
            near = part.asked(len(tokens), places(union, tokens), percent)
            plain = [i for i, s in enumerate(sets[:30]) if 100 * len(set(s) & set(tokens)) >= percent * len(set(s) | set(tokens))]
            assert near.tolist() == plain
            first = {}
            for i in plain:
                first.setdefault(i % 4, i)
            assert part.one_each(near).tolist() == [first[c] for c in sorted(first)]


def test_near_duplicates_of_nothing(nothing):
    assert near_duplicates(nothing).count() == 0


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3), (150, 139), (1, 2)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "u bigint, v bigint")).collect()))
    assert got == {i: 1 for i in range(1, 41)} | {i: 100 for i in range(100, 140)} | {150: 100}
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_language(edges, nothing):
    model = train(edges.filter("lang is not null"))
    got = predict(edges, model, ["doc_id", "text"]).collect()
    assert len(got) == len(docs())
    for r in got:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == UNKNOWN) != letters and 0 <= r.score <= 1
        assert r.lang_pred in {"en", "de", "fr", UNKNOWN}
    assert predict(nothing, model).count() == 0
    assert {r.lang_pred for r in predict(edges, train(nothing)).collect()} == {UNKNOWN}


def test_language_counts_copies_once(spark):
    """One text, 2,500 times in the language, is in the sample: the other texts of the language are still recognised."""
    draw = random.Random(5)
    names = ["".join(draw.choice(half) for _ in range(7)) for half in ("abcdefghijklm", "nopqrstuvwxyz") for _ in range(20)]
    low, high = [[" ".join(draw.sample(part, 5)) + f" {i}" for i in range(n)] for part, n in ((names[:20], 500), (names[20:], 4000))]
    tries = spark.createDataFrame([(f"0 {i}w {i}",) for i in range(3000)], "text string")
    hot = tries.filter(F.pmod(F.xxhash64("text"), F.lit(2**20)) < 10000).first().text
    rows = [(hot, "low")] * 2500 + [(t, "low") for t in low] + [(t, "high") for t in high]
    model = train(spark.createDataFrame(rows, "text string, lang string"), rows_per_language=50)
    held = spark.createDataFrame([(i, " ".join(draw.sample(names[:20], 8))) for i in range(50)], "doc_id int, text string")
    assert {r.lang_pred for r in predict(held, model).collect()} == {"low"}


def test_language_held_out_accuracy(spark):
    from peerledger.llm.queries import op1_language_id

    sf = "/root/testdata/sf0.01"
    got = op1_language_id(spark, sf).filter("held_out").join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    right, total = got.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right >= 0.97 * total > 0


def invented(languages, texts, seed=8):
    """Texts of languages that share some words."""
    draw = random.Random(seed)
    shared = ["".join(draw.choice("abcdefghij") for _ in range(5)) for _ in range(15)]
    rows = []
    for n in range(languages):
        own = ["".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(25)]
        rows += [(f"l{n:03d}", " ".join(draw.choice(own if draw.random() < 0.7 else shared) for _ in range(30))) for _ in range(texts)]
    return rows


def test_more_languages_than_a_word_has_bits(spark):
    rows = invented(130, 12)
    df = spark.createDataFrame([(i, lang, text) for i, (lang, text) in enumerate(rows)], "doc_id int, lang string, text string")
    model = train(df.filter("doc_id % 4 > 0"))
    assert model.slots.shape[0] == 3 and len(model.languages) == 130
    got = predict(df.filter("doc_id % 4 = 0"), model, ["lang"]).collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.97 * len(got)


def test_popcounts_against_plain_sets(spark):
    rows = sorted(set(invented(70, 15, 3) + [("l000", "odd ßé 中文 words"), ("l001", "12 !!")]))
    df = spark.createDataFrame(rows, "lang string, text string")
    model = train(df)
    texts_of = Counter(lang for lang, _ in rows)
    seen = defaultdict(Counter)
    for lang, text in rows:
        for gram in set(grams_of([text])[0].tolist()):
            seen[gram][lang] += 1
    has = defaultdict(set)
    for gram, langs in seen.items():
        shares = {lang: n / texts_of[lang] for lang, n in langs.items()}
        able = {lang: share for lang, share in shares.items() if share >= MIN_SHARE}
        for lang, share in able.items():
            if share >= NEAR_BEST * max(able.values()):
                has[lang].add(gram)
    some = [text for _, text in rows[::7]]
    grams, owner = grams_of(some)
    got = model.popcounts(grams, owner, len(some))
    false = model.false_rates()
    extra = 0.0
    for i, text in enumerate(some):
        own = grams_of([text])[0].tolist()
        exact = np.array([sum(g in has[lang] for g in own) for lang in model.languages])
        assert (got[i] >= exact).all()  # a filter forgets nothing
        spread = np.sqrt(len(own) * false * (1 - false))
        assert (got[i] - exact <= (len(own) - exact) * false + 8 * spread + 2).all()
        extra += (got[i] - exact).sum()
    expected = sum(len(grams_of([t])[0]) for t in some) * false.sum()
    assert extra <= 1.5 * expected + 10
    answer = {r.text: r.lang_pred for r in predict(df, model, ["text"]).collect()}
    for lang, text in rows:
        counts = {n: sum(g in has[n] for g in grams_of([text])[0].tolist()) for n in model.languages}
        first, second = sorted(counts.values())[-1:-3:-1]
        if first - second > 8:
            assert counts[answer[text]] == first


def ids_of(texts, style, path):
    known = encoder(path, False)
    words = split_words(texts, style, known.specials)
    ids, sizes = spread(words.numbers, *flat_ids(known.encode(words.distinct)))
    ends = np.concatenate(([0], np.cumsum(sizes)))[np.concatenate(([0], np.cumsum(words.per_text)))]
    return [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])]


def test_words_are_split_as_the_library_splits_them():
    import random

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    draw = random.Random(3)
    pool = [*"abzAZ  \t\n\r'\"!.,09éßΣ中🙂½ﬁ\x85\x00", "'s", "'re", "'LL", " 's", "''s", "  ", "<|endoftext|>", "'ll"]
    texts = ["".join(draw.choices(pool, k=draw.choice([0, 1, 3, 40]))) for _ in range(800)]
    texts += ["a" + chr(c) + "a 1" + chr(c) + " " + chr(c) for c in range(0x2000)]
    assert ids_of(texts, BYTE, path) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert code_point_classes()[ord("é")] == 1
    assert split_words(["it's 12 o'clock"], WORD).distinct == ["it", "'s", "1", "2", "o", "'", "clock"]


def test_bpe_round_trip(edges, nothing):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    got = decode(encode(edges, path, buckets=5), path).collect()
    expected = Counter()
    for i, t in docs():
        ids = library.encode(t, add_special_tokens=False).ids
        expected[i, tuple(ids), library.decode(ids, skip_special_tokens=False)] += 1
    assert Counter((r.doc_id, tuple(r.ids), r.decoded) for r in got) == expected
    assert decode(encode(nothing, path), path).count() == 0


def test_token_store(spark, edges, nothing):
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(tokenizer)
    path = fresh_path(spark, "store")
    write_tokens(edges, path, tokenizer, end_id=1, chunk_tokens=500)
    rows = read_tokens(spark, path).orderBy("start").collect()
    expected = {i: Counter(tuple([*library.encode(t, add_special_tokens=False).ids, 1]) for t in ts) for i, ts in texts_by_id().items()}
    got, at = defaultdict(Counter), 0
    for r in rows:
        assert r.start == at and r.n_tokens == len(r.ids)
        at += r.n_tokens
        got[r.key][tuple(r.ids)] += 1
    assert got == expected
    keys = [r.key for r in rows]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    everything = [t for r in rows for t in r.ids]
    common = [t for t, _ in Counter(everything).most_common(3)] + [40000]
    counts = dict(map(tuple, occurrences(spark, path, common).collect()))
    assert counts == {t: everything.count(t) for t in common}
    places = occurrences(spark, path, [1], positions=True).collect()
    assert sorted(p.position for p in places) == [i for i, t in enumerate(everything) if t == 1]
    asked = [0, 5, 5, 499, 500, 501, len(everything) // 2, len(everything) - 1, len(everything), -1, None, 10**12]
    wanted = spark.createDataFrame([(p, "x") for p in asked], "position bigint, token string")
    assert dict(map(tuple, tokens_at(spark, path, wanted).collect())) == {p: everything[p] for p in asked if p is not None and 0 <= p < len(everything)}
    digests = read_tokens(spark, path, digests=True).orderBy("start").collect()
    assert [d.ids_crc32 for d in digests] == [zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in rows]
    empty = fresh_path(spark, "store")
    write_tokens(nothing, empty, tokenizer, end_id=1)
    assert read_tokens(spark, empty).count() == 0
    assert tokens_at(spark, empty, wanted).count() == 0


def test_token_store_holds_every_id_or_says_so(spark, edges):
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    few = edges.filter("doc_id in (7, 8)").select("doc_id", "text")
    wide = fresh_path(spark, "store")
    write_tokens(few, wide, tokenizer, end_id=70_000)
    assert {r.ids[-1] for r in read_tokens(spark, wide).collect()} == {70_000}
    with pytest.raises(Exception, match="id 70000 does not fit 16 bits"):
        write_tokens(few, fresh_path(spark, "store"), tokenizer, end_id=70_000, bits=16)


def test_wavelet_matrix():
    draw = np.random.default_rng(1)
    for size in (0, 1, 7, 2048, 5001):
        ids = draw.integers(0, 50, size).astype(np.uint16)
        made = WaveletMatrix.of(ids, 16)
        held = WaveletMatrix(made.size, made.zeros, made.planes.tobytes(), made.ones.tobytes())
        assert (held.all() == ids).all()
        for at in draw.integers(0, size, 20) if size else ():
            token = int(ids[at])
            assert held.access(int(at)) == token
            before = int((ids[:at] == token).sum())
            assert held.rank(token, int(at)) == before and held.select(token, before) == at
        assert held.rank(70, size) == 0 and held.select(70, 0) == -1


def repeats(rows, length):
    data = [t.encode() for _, t in rows]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    answer = Counter()
    for (key, _), d in zip(rows, data):
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = [m.span() for m in re.finditer(rb"\x01+", bytes(gone))]
        kept = bytes(b for b, g in zip(d, gone) if not g)
        answer[key, len(d), tuple(spans), hashlib.sha256(kept).hexdigest()] += 1
    return answer


@pytest.mark.parametrize("options", [{}, {"length": 40, "prefix": 8, "batches": 3, "crowded": 2}, {"length": 60, "prefix": 30, "batches": 1}])
def test_repeated_strings(edges, options, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SLICE_BYTES", 5000)
    got = remove_repeats(edges, **options).select("doc.doc_id", "n_bytes", "spans", "kept").collect()
    found = Counter((r.doc_id, r.n_bytes, tuple((s.begin, s.end) for s in r.spans), hashlib.sha256(r.kept).hexdigest()) for r in got)
    assert found == repeats(docs(), options.get("length", 200))


def test_repeated_strings_of_nothing(nothing):
    assert remove_repeats(nothing).count() == 0
