"""Exact near duplicates by the Jaccard similarity of word shingles, joined through a token-group matrix.

1. A document is a set of 64-bit shingle hashes. Equal sets are one class; everything below works on classes.
2. Shingles have one order for all: those frequent in a sample of the documents last, others by hash. Two sets that are similar
   enough share DEPTH of their first n - need + DEPTH shingles (fewer for tiny sets), which are therefore all that is
   shuffled; the order decides the cost and never the result.
3. Classes are grouped: where more than LEAD share a smallest hash, they elect a leader and join it if they are similar to it. Such a
   group is connected, so it needs no pairs inside. The others form loose groups by their smallest hash, whose own links are looked
   for too. Groups are cut into parts of about PART members and PART_BYTES of text.
4. The token-group matrix holds, per shingle, the parts that have it among their first ones. A class reads the rows of its own first
   shingles: a part qualifies for it if enough of them are there.
5. Each part that somebody asks for, or that is loose, is stored once as a row of the matrix: the union of its members' whole sets and,
   member by member, which shingles of the union are theirs. Loose parts note their inner links there.
6. A query's overlap with a part's stored union bounds what it can share with any member; only where the bound suffices is the part
   opened, and all its members are compared in one pass over the member rows. A query gets one link to each connected set of them. No
   link between different components is lost, and no group emits its pairs. Queries stream past the part, so a task holds one part.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerledger.llm.bits import bit_table, marked
from peerledger.llm.bpe import compressed, decompressed, packed, unpacked
from peerledger.llm.components import components
from peerledger.llm.memory import frugal
from peerledger.llm.words import slices
from peerledger.session import Scope, stage, stage_counted, staging

DEPTH = 4
PART = 256
PART_BYTES = 2_000_000
QUERIES = 256
LEAD = 8  # classes sharing a smallest hash, from which on they elect a leader
FIRST_BITS = 48  # kept of a first shingle: sharing one by chance adds a candidate and costs no link
ROOTS = 3  # smallest hashes kept per class
FREQUENT_SAMPLE = 32  # one document in so many is looked at for frequent shingles
FREQUENT_ROWS = 3
FREQUENT_KEPT = 200_000
SLICE_CHARS = 500_000
STEP = 0x9E3779B97F4A7C15
MASK = 2**64 - 1


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the published finalizer of a well-known generator)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _tables() -> tuple[np.ndarray, np.ndarray]:
    lower = np.arange(256, dtype=np.uint8)
    lower[ord("A") : ord("Z") + 1] += 32
    gap = np.zeros(256, bool)
    gap[[0x20, *range(0x09, 0x0E)]] = True
    return lower, gap


LOWER, GAP = _tables()


def shingles_of(texts: Sequence[str], words: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text, sorted, end to end; and each one's text."""
    data = [t.encode("utf-8") + b" " for t in texts]
    raw = LOWER[np.frombuffer(b"".join(data), np.uint8)]
    sizes = np.fromiter(map(len, data), np.int64, len(data))
    inside = np.concatenate(([False], ~GAP[raw], [False]))
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    begin, end = edge[::2], edge[1::2]
    if not len(begin):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    powers = np.full(len(raw) + 1, STEP, np.uint64)
    powers[0] = 1
    back = np.full(len(raw) + 1, pow(STEP, -1, 2**64), np.uint64)
    back[0] = 1
    np.multiply.accumulate(powers, out=powers)
    np.multiply.accumulate(back, out=back)
    running = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * powers[:-1], out=running[1:])
    word = mixed((running[end] - running[begin]) * back[begin] + (end - begin).astype(np.uint64))
    owner = np.searchsorted(np.cumsum(sizes), begin, side="right")
    count = np.bincount(owner, minlength=len(texts))
    if len(word) >= words:
        chain = word[: len(word) - words + 1] * np.uint64(1)
        for i in range(1, words):
            chain = chain * np.uint64(STEP) + word[i : len(word) - words + 1 + i]
        whole = owner[: len(chain)] == owner[words - 1 :]
        tokens, owners = mixed(chain[whole] + np.uint64(words)), owner[: len(chain)][whole]
    else:
        tokens, owners = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    short = np.flatnonzero((count > 0) & (count < words))
    if len(short):
        first = np.cumsum(count) - count
        extra = []
        for t in short:
            chain = 0
            for w in word[first[t] : first[t] + count[t]].tolist():
                chain = (chain * STEP + w) & MASK
            extra.append((chain + int(count[t])) & MASK)
        tokens = np.concatenate((tokens, mixed(np.array(extra, np.uint64))))
        owners = np.concatenate((owners, short))
    order = np.lexsort((tokens, owners))
    tokens, owners = tokens[order], owners[order]
    fresh = np.ones(len(tokens), bool)
    fresh[1:] = (tokens[1:] != tokens[:-1]) | (owners[1:] != owners[:-1])
    return tokens[fresh], owners[fresh]


def needed(n, percent: int):
    """Shared shingles without which a set of n cannot be similar enough to any."""
    return -(-n * percent // 100)


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32)), pa.array(values.view(np.int64)))


@frugal
def _sample_tokens(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(0).to_pylist()
        for begin, end in slices(texts, SLICE_CHARS):
            tokens, _ = shingles_of(texts[begin:end], words)
            found, counts = np.unique(tokens, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(counts)], ["token", "rows"])


@frugal
def _features(batches: Iterator[pa.RecordBatch], words: int, percent: int, frequent, depth: int, carried: int, inside: str | None) -> Iterator[pa.RecordBatch]:
    """The carried columns, text bytes, set size, set identity (two sums over the set), smallest hashes, and first shingles of every text."""
    common, ranks = frequent.value
    for batch in batches:
        column = batch.column(carried) if inside is None else batch.column(0).field(inside)
        texts = [t or "" for t in column.to_pylist()]
        for begin, end in slices(texts, SLICE_CHARS):
            tokens, owner = shingles_of(texts[begin:end], words)
            n = np.bincount(owner, minlength=end - begin)
            start = (np.cumsum(n) - n)[n > 0]
            sums = np.zeros((2, end - begin), np.uint64)
            roots = np.zeros((ROOTS, end - begin), np.uint64)
            if len(tokens):
                sums[0, n > 0] = np.add.reduceat(mixed(tokens + np.uint64(1)), start)
                sums[1, n > 0] = np.add.reduceat(mixed(tokens ^ np.uint64(STEP)), start)
                for r in range(ROOTS):
                    roots[r, n > 0] = np.minimum.reduceat(mixed(tokens + np.uint64((r + 2) * STEP & MASK)), start)
            rank = np.zeros(len(tokens), np.int64)
            if len(common):
                at = np.minimum(np.searchsorted(common, tokens), len(common) - 1)
                rank = np.where(common[at] == tokens, ranks[at], 0)
            order = np.lexsort((tokens, rank, owner))
            place = np.arange(len(tokens)) - np.repeat(start, n[n > 0])
            first = np.minimum(n, n - needed(n, percent) + depth)
            kept = order[place < first[owner]]
            some = [c.slice(begin, end - begin) for c in batch.columns[:carried]]
            length = np.fromiter((len(t.encode()) for t in texts[begin:end]), np.int64, end - begin)
            numbers = [pa.array(length), pa.array(n), *(pa.array(s.view(np.int64)) for s in (*sums, *roots)), _lists(tokens[kept] >> np.uint64(64 - FIRST_BITS), first)]
            yield pa.RecordBatch.from_arrays([*some, *numbers], [*batch.schema.names[:carried], "length", "n", "a", "b", *(f"root{r}" for r in range(ROOTS)), "first"])


@frugal
def _wanted_sets(batches: Iterator[pa.RecordBatch], words: int, wanted) -> Iterator[pa.RecordBatch]:
    """(a, b, body) of the texts whose set may be wanted: `wanted` is a bit table over set identities."""
    bits = wanted.value
    for batch in batches:
        texts = [t or "" for t in batch.column(0).to_pylist()]
        for begin, end in slices(texts, SLICE_CHARS):
            tokens, owner = shingles_of(texts[begin:end], words)
            n = np.bincount(owner, minlength=end - begin)
            start = (np.cumsum(n) - n)[n > 0]
            if not len(tokens):
                continue
            a = np.add.reduceat(mixed(tokens + np.uint64(1)), start)
            b = np.add.reduceat(mixed(tokens ^ np.uint64(STEP)), start)
            _, once = np.unique(a, return_index=True)
            keep = np.zeros(len(a), bool)
            keep[once] = True
            keep &= marked(bits, a)
            some = np.flatnonzero(n > 0)[keep]
            bodies = [compressed(texts[begin + i].encode()) for i in some.tolist()]
            columns = [pa.array(a[keep].view(np.int64)), pa.array(b[keep].view(np.int64)), pa.array(bodies, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b", "body"])


WANTED_BITS = 2**23


def _ranges(sizes: Sequence[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of items of about `most` in all; a larger item is alone."""
    begin, total = 0, 0
    for i, size in enumerate(sizes):
        if total and total + size > most:
            yield begin, i
            begin, total = i, 0
        total += size
    if begin < len(sizes):
        yield begin, len(sizes)


def sets_of(bodies: Sequence[bytes], words: int) -> Iterator[np.ndarray]:
    """The sorted shingle hashes of each compressed text. About SLICE_CHARS bytes of text are unpacked at a time."""
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    for begin, end in _ranges([zstandard.frame_content_size(b) for b in bodies], SLICE_CHARS):
        tokens, owner = shingles_of([unpack(b).decode() for b in bodies[begin:end]], words)
        yield from np.split(tokens, np.cumsum(np.bincount(owner, minlength=end - begin))[:-1])


def places(union: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Where the tokens that a sorted union has are in it."""
    if not len(union):
        return np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(union, tokens), len(union) - 1)
    return at[union[at] == tokens]


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(places(a, b))
    return 100 * both >= percent * (len(a) + len(b) - both)


class Part:
    """Member rows of the matrix: the union of the members' sets, and each member's places in it, end to end."""

    def __init__(self, union: np.ndarray, sizes: np.ndarray, members: np.ndarray, names: np.ndarray, connected: np.ndarray):
        self.union, self.sizes, self.members, self.names, self.connected = union, sizes, members, names, connected
        self.starts = np.cumsum(sizes) - sizes
        self.flags = np.zeros(len(union), bool)

    def asked(self, size: int, at: np.ndarray, percent: int, first: int = 0) -> np.ndarray:
        """Members from number `first` on that are similar to a set of `size` tokens, of which the union has those at `at`."""
        self.flags[at] = True
        begin = int(self.starts[first])
        both = np.add.reduceat(self.flags[self.members[begin:]], self.starts[first:] - begin, dtype=np.int64)
        self.flags[at] = False
        return first + np.flatnonzero(100 * both >= percent * (size + self.sizes[first:] - both))

    def one_each(self, near: np.ndarray) -> np.ndarray:
        """The first of the members `near` in each connected set."""
        return near[np.unique(self.connected[near], return_index=True)[1]]


def _roots(count: int, pairs: Iterator[tuple[int, np.ndarray]]) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """The smallest connected member of each, and the pairs (i, j) that connected two sets."""
    root = list(range(count))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    used = []
    for i, near in pairs:
        for j in near.tolist():
            x, y = top(i), top(j)
            if x != y:
                root[max(x, y)] = min(x, y)
                used.append((i, j))
    return np.array([top(i) for i in range(count)], np.int64), used


PART_FIELDS = "to bigint, part int, least bigint, n_union bigint, union binary, sizes array<bigint>, members binary, names array<bigint>, connected array<bigint>, u array<bigint>, v array<bigint>"


def _store_part(rows: pa.Table, words: int, percent: int) -> pa.Table:
    """The matrix row of one part, with the links between members of a loose part that connect what all of them would."""
    names = rows.column("cid").to_numpy()
    sets = list(sets_of(rows.column("body").to_pylist(), words))
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    union, members = np.unique(np.concatenate(sets), return_inverse=True)
    part = Part(union, sizes, members.ravel(), names, np.zeros(len(names), np.int64))
    links: list[tuple[int, int]] = []
    if rows.column("loose")[0].as_py():
        ends = part.starts + sizes
        pairs = ((i, part.asked(int(sizes[i]), part.members[part.starts[i] : ends[i]], percent, i + 1)) for i in range(len(names) - 1))
        part.connected, links = _roots(len(names), pairs)
    row = {
        "to": rows.column("to")[0].as_py(),
        "part": rows.column("part")[0].as_py(),
        "least": int(sizes.min()),
        "n_union": len(union),
        "union": compressed(union.tobytes()),
        "sizes": sizes.tolist(),
        "members": packed(part.members),
        "names": names.tolist(),
        "connected": part.connected.tolist(),
        "u": [int(names[i]) for i, _ in links],
        "v": [int(names[j]) for _, j in links],
    }
    kinds = {"to": pa.int64(), "part": pa.int32(), "least": pa.int64(), "n_union": pa.int64(), "union": pa.binary(), "members": pa.binary()}
    return pa.table({k: pa.array([v], kinds.get(k, pa.list_(pa.int64()))) for k, v in row.items()})


@frugal
def _open(batches: Iterator[pa.RecordBatch], words: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Links (u, v): at most one from each query to each connected set of a part's members. Rows come in order of part, slice, role: the
    stored part, then its queries."""
    union, least, stored, part = np.zeros(0, np.uint64), 0, None, None
    for batch in batches:
        asks = batch.column("asks").to_pylist()
        names = batch.column("cid").to_pylist()
        sets = sets_of([b for b, a in zip(batch.column("body").to_pylist(), asks) if a], words)
        found: list[tuple[int, int]] = []
        for i, query in enumerate(asks):
            if not query:
                stored, part = batch.column("row")[i].as_py(), None
                union = np.frombuffer(decompressed(stored["union"], 8 * stored["n_union"]), np.uint64)
                least = stored["least"]
                continue
            tokens = next(sets)
            at = places(union, tokens)
            if len(at) < needed(max(len(tokens), least), percent):
                continue
            if part is None:
                sizes = np.array(stored["sizes"], np.int64)
                members = unpacked(stored["members"], int(sizes.sum())).astype(np.int64)
                part = Part(union, sizes, members, np.array(stored["names"]), np.array(stored["connected"]))
            found += [(names[i], int(part.names[j])) for j in part.one_each(part.asked(len(tokens), at, percent))]
        yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64())], ["u", "v"])


@frugal
def _near_leader(batches: Iterator[pa.RecordBatch], words: int, percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        leaders, bodies = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        first = {name: i for i, name in reversed(list(enumerate(leaders)))}
        led = sets_of(batch.column(3).take(pa.array(sorted(first.values()), pa.int64())).to_pylist(), words)
        known = {leaders[i]: tokens for i, tokens in zip(sorted(first.values()), led)}
        keep = [similar(known[leader], tokens, percent) for leader, tokens in zip(leaders, sets_of(bodies, words))]
        kept = batch.filter(pa.array(keep, pa.bool_()))
        yield pa.RecordBatch.from_arrays(kept.columns[:2], ["cid", "leader"])


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    words: int = 5,
    percent: int = 80,
    carry: Sequence[Column] | None = None,
) -> DataFrame:
    """One row per document: (doc, n_shingles, component_id, kept).

    Words are runs of bytes other than blanks and control white space, A-Z lower-cased; a text of fewer than `words` words is one
    shingle. Two documents link when 100 * shared >= percent * united shingles. `component_id` is the smallest key that
    links lead to; in each component the row with that key stays (one of them, if rows share it; NULL keys come last). Documents
    without words, or NULL, have 0 shingles, link with nothing and stay. Rows with equal keys are rows of their own. `doc` holds
    the columns of `docs`, or `carry`. Whole texts are read; one text at a time must fit a task.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(f"`{text}`").alias("text"))
    sample = texts.filter(F.pmod(F.xxhash64("text"), F.lit(FREQUENT_SAMPLE)) == 0).dropna()
    counted = sample.mapInArrow(partial(_sample_tokens, words=words), "token bigint, rows bigint").groupBy("token").agg(F.sum("rows").alias("rows"))
    frequent = counted.filter(F.col("rows") >= FREQUENT_ROWS).orderBy(F.desc("rows"), "token").limit(FREQUENT_KEPT).toArrow()
    common = frequent.column("token").to_numpy().view(np.uint64) if frequent.num_rows else np.zeros(0, np.uint64)
    order = np.argsort(common)
    ranks = frequent.column("rows").to_numpy()[order] if frequent.num_rows else np.zeros(0, np.int64)
    frequent_shared = spark.sparkContext.broadcast((common[order], ranks))

    doc = F.struct(*(carry or [F.col(f"`{c}`") for c in docs.columns])).alias("doc")
    read = docs.select(doc, F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    inside = text if carry is None else None  # all columns are carried: the text goes to the tasks as one of them
    if inside is not None:
        read = read.drop("text")
    numbers = [T.StructField(c, T.LongType()) for c in ("length", "n", "a", "b", *(f"root{r}" for r in range(ROOTS)))]
    schema = T.StructType([*read.schema.fields[:2], *numbers, T.StructField("first", T.ArrayType(T.LongType()))])
    task = partial(_features, words=words, percent=percent, frequent=frequent_shared, depth=DEPTH, carried=2, inside=inside)
    rows = stage(read.mapInArrow(task, schema).withColumn("row", F.monotonically_increasing_id()), "document-sets")

    with staging(spark) as scope:
        answer = _class_components(rows, texts, words, percent, scope)
        scope.keep(answer)
    empty = rows.filter("n = 0").select("doc", F.col("n").alias("n_shingles"), F.col("key").alias("component_id"), F.lit(True).alias("kept"))
    kept = (F.col("row") == F.col("least.row")).alias("kept")
    linked = rows.filter("n > 0").select("doc", "n", "a", "b", "row").join(answer, ["a", "b"])
    return linked.select("doc", F.col("n").alias("n_shingles"), F.col("least.key").alias("component_id"), kept).union(empty)


def _class_components(rows: DataFrame, texts: DataFrame, words: int, percent: int, scope: Scope) -> DataFrame:
    """(a, b, least) of each class: the first row, by key, of the classes that links lead to."""
    # Equal sets are one class. Its first row is by key, NULL last.
    order_key = F.struct(F.col("key").isNull().alias("none"), F.col("key").alias("key"), F.col("row").alias("row"))
    described = [F.first(c).alias(c) for c in ("length", "n", *(f"root{r}" for r in range(ROOTS)))]
    grouped = rows.filter("n > 0").groupBy("a", "b").agg(F.min(order_key).alias("head"), *described)
    classes = stage(grouped.withColumn("cid", F.monotonically_increasing_id()), "set-classes")

    # First shingles that several classes share; a class can only link if enough of its own are among them.
    heads = classes.select("cid", "n", F.col("head.row").alias("row"))
    every = heads.join(rows.select("row", "first"), "row").select("cid", "n", F.explode("first").alias("token"))
    every = stage(every, "first-shingles")
    again = stage(every.groupBy("token").count().filter("count > 1").select("token"), "repeated-shingles")
    posted = stage(every.join(again, "token"), "shared-first-shingles")
    scope.release(every, again)
    smallest = needed_column(F.col("n"), percent)  # of the sets that can be similar to one of n
    must_share = F.least(F.lit(DEPTH), needed_column(smallest, percent))
    able = posted.groupBy("cid", "n").count().filter(F.col("count") >= must_share).select("cid")
    chosen = classes.join(able, "cid").select("cid", "a", "b", "n", "length", *(f"root{r}" for r in range(ROOTS)))
    wanted = stage(chosen, "linkable-classes")
    bits = texts.sparkSession.sparkContext.broadcast(bit_table(wanted.select("a"), WANTED_BITS))
    sets = texts.mapInArrow(partial(_wanted_sets, words=words, wanted=bits), "a bigint, b bigint, body binary")
    sets = sets.join(wanted.select("cid", "a", "b"), ["a", "b"]).groupBy("cid").agg(F.first("body").alias("body"))
    sets = stage(sets, "linkable-texts")

    stars, groups = _lead(wanted, sets, words, percent)
    links = stage(stars.union(_cross(posted, groups, sets, words, percent, scope)), "class-links")
    roots = components(links).withColumnRenamed("node", "cid")
    at = classes.select("a", "b", "cid", "head").join(roots, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    heads = stage(at.groupBy("root").agg(F.min("head").alias("least")), "component-heads")
    return stage(at.join(heads, "root").select("a", "b", "least"), "class-components")


def needed_column(n: Column, percent: int) -> Column:
    return F.ceil(n * percent / 100)


def _lead(wanted: DataFrame, sets: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Links (u, v) of classes to leaders that they are similar to, and (cid, length, gid, loose) of all linkable classes.

    One round per kept smallest hash: those that no leader has yet, and of which more than LEAD share it, elect the first of them; a
    new leader takes its group along. Those left alone form loose groups by their smallest hash, similar but not known to be connected.
    """
    heads = wanted.select("cid", *(f"root{r}" for r in range(ROOTS)))
    groups = wanted.select("cid", "length", F.col("cid").alias("gid"))
    links = wanted.sparkSession.createDataFrame([], "cid bigint, leader bigint")
    for root in (f"root{r}" for r in range(ROOTS)):
        elected = heads.groupBy(root).agg(F.min("cid").alias("leader"), F.count("*").alias("size")).filter(F.col("size") > LEAD)
        elected = stage(elected.drop("size"), "leaders")
        pairs, count = stage_counted(heads.select("cid", root).join(elected, root).filter("cid <> leader").select("cid", "leader"), "led-pairs")
        if not count:
            continue
        led = stage(elected.select("leader").join(sets.toDF("leader", "led"), "leader"), "leader-texts")
        compared = pairs.join(sets, "cid").join(led, "leader").select("cid", "leader", "body", "led")
        joined = compared.mapInArrow(partial(_near_leader, words=words, percent=percent), "cid bigint, leader bigint")
        joined, count = stage_counted(joined, "led")
        if not count:
            continue
        links = links.union(joined)
        heads = stage(heads.join(joined.select("cid"), "cid", "left_anti"), "heads")
        moved = groups.join(joined.select(F.col("cid").alias("gid"), "leader"), "gid", "left")
        groups = stage(moved.select("cid", "length", F.coalesce("leader", "gid").alias("gid")), "groups")
    alone = stage(groups.groupBy("gid").count().filter("count = 1").select(F.col("gid").alias("cid")), "lone-classes")
    alone = alone.join(wanted.select("cid", "root0"), "cid")
    families = alone.groupBy("root0").agg(F.min("cid").alias("family"), F.count("*").alias("size")).filter("size > 1")
    families = alone.join(stage(families.drop("size"), "loose-families"), "root0").select("cid", "family")
    groups = groups.join(stage(families, "loose-groups"), "cid", "left")
    groups = groups.select("cid", "length", F.coalesce("family", "gid").alias("gid"), F.col("family").isNotNull().alias("loose"))
    return links.toDF("u", "v"), stage(groups, "groups")


def _cross(posted: DataFrame, groups: DataFrame, sets: DataFrame, words: int, percent: int, scope: Scope) -> DataFrame:
    """Links between classes of different groups, and inside loose ones, from (cid, n, token) and (cid, length, gid, loose)."""
    sizes = groups.groupBy("gid").agg(F.count("*").alias("members"), F.sum("length").alias("bytes"))
    parts = F.greatest(F.ceil(F.col("members") / PART), F.ceil(F.col("bytes") / PART_BYTES))
    parted = groups.join(stage(sizes, "group-sizes"), "gid").withColumn("part", F.pmod(F.xxhash64("cid"), parts).cast("int"))
    parted = stage(parted.drop("length", "bytes"), "group-parts")
    placed = stage(posted.join(parted, "cid"), "parted-shingles")
    scope.release(posted)
    matrix = placed.groupBy("token", "gid", "part").agg(F.min("n").alias("least"), F.first("members").alias("members"))
    matrix = matrix.select("token", F.col("gid").alias("to"), "part", "least", F.col("members").alias("to_members"))
    matrix = stage(matrix, "token-group-matrix")
    # The smaller group asks, so a large one is read by few; in a loose group the earlier part does.
    smaller = (F.col("members") < F.col("to_members")) | ((F.col("members") == F.col("to_members")) & (F.col("gid") < F.col("to")))
    asks = smaller & (F.col("gid") != F.col("to")) | (F.col("gid") == F.col("to")) & F.col("loose") & (F.col("own") < F.col("part"))
    asking = placed.select("token", "cid", "n", "gid", "members", "loose", F.col("part").alias("own"))
    met = asking.join(matrix, "token").filter(asks)
    share = F.least(F.lit(DEPTH), needed_column(F.col("n"), percent), needed_column(F.min("least"), percent))
    hits = met.groupBy("cid", "n", "to", "part").agg(F.count("*").alias("hits"), share.alias("share")).filter("hits >= share")
    queries = stage(hits.select("cid", "to", "part"), "part-queries")
    scope.release(placed, matrix)

    inner = parted.filter("loose").select(F.col("gid").alias("to"), "part", F.lit(0).alias("asks")).distinct()
    loads = queries.select("to", "part", F.lit(1).alias("asks")).union(inner).groupBy("to", "part").agg(F.sum("asks").alias("asks"))
    loads = stage(loads.select("to", "part", F.ceil(F.col("asks") / QUERIES).cast("int").alias("slices")), "part-loads")
    members = parted.select("cid", F.col("gid").alias("to"), "part", "loose").join(loads.select("to", "part"), ["to", "part"]).join(sets, "cid")
    stored = members.groupBy("to", "part").applyInArrow(lambda rows: _store_part(rows, words, percent), PART_FIELDS)
    stored = stage(stored, "stored-parts")
    inside = stored.select(F.explode(F.arrays_zip("u", "v")).alias("link")).select("link.u", "link.v")

    at = ["to", "part", "slice"]
    asked = queries.join(loads, ["to", "part"]).withColumn("slice", F.pmod(F.xxhash64("cid"), F.col("slices")).cast("int"))
    asked = asked.join(sets, "cid").select(*at, F.lit(True).alias("asks"), "cid", "body")
    held = stored.join(loads, ["to", "part"]).filter("slices > 0").withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    needs = ("union", "n_union", "least", "sizes", "members", "names", "connected")
    held = held.select(*at, F.lit(False).alias("asks"), F.struct(*needs).alias("row"))
    rows = asked.unionByName(held, allowMissingColumns=True).repartition(*at).sortWithinPartitions(*at, "asks")
    opened = rows.mapInArrow(partial(_open, words=words, percent=percent), "u bigint, v bigint")
    return inside.union(opened)
