"""Embedding near-duplicates by an exact metric range join.

Cosine >= c between vectors is distance <= r between their unit vectors, r = sqrt(2 - 2c). Every label with more vectors than fit a cell
has pivots of its own, which cut its vectors into cells, each vector's home being the nearest pivot. If x at home in cell j is within r
of y at home in cell i, the triangle inequality gives d(y, pj) <= d(y, pi) + 2r, and y is no further than r from the plane between
the pivots; where both hold, y visits j. Visits go to the smaller cell number only, so each pair meets once. Cells join
independently; a large one is cut into blocks, and each pair of blocks is a task of its own. A task compares all its pairs but
returns one link count per vector and a spanning forest, never pairs.

The pivots of a label are about as many as its vectors fill cells, at most twice the root of their number, and fewer where a sample of
the label shows that its vectors would visit more than COPIES cells on average: a cloud as dense as the radius gains nothing from cells.
So a vector is copied about COPIES times by visits, and once for each block of its cells that it meets.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerledger.llm.components import components
from peerledger.session import stage

CELL = 1024
PIVOT_BYTES = 2**25  # of all pivots, which are broadcast; beyond it, cells grow
FARTHEST = 512  # pivots chosen far from each other; more are taken as drawn
SAMPLE_PER_PIVOT = 4
COPIES = 4.0
BLOCK = 4096
COMPARED = 2**21  # distances or cosines computed at once
SLACK = 1e-9  # distances are only filters; the cosine decides


def _matrix(column) -> np.ndarray:
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = array.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(array), -1) if len(array) else np.zeros((0, 0))


def _units(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def spread_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Farthest-first choice from a sample of unit vectors."""
    chosen = [0]
    distance = np.linalg.norm(sample - sample[0], axis=1)
    while len(chosen) < min(count, len(sample)):
        chosen.append(int(distance.argmax()))
        distance = np.minimum(distance, np.linalg.norm(sample - sample[chosen[-1]], axis=1))
    return sample[chosen]


def visits_of(units: np.ndarray, points: np.ndarray, radius: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(home of each row, visiting rows, visited cells), a few rows at a time; row numbers count from the first of all."""
    step = max(1, COMPARED // len(points))
    for begin in range(0, len(units), step):
        some = units[begin : begin + step]
        distance = np.sqrt(np.maximum(0.0, 2 - 2 * some @ points.T))
        home = distance.argmin(axis=1)
        near = distance[np.arange(len(home)), home]
        reach = distance <= near[:, None] + 2 * radius + SLACK
        reach &= np.arange(len(points)) < home[:, None]
        row, cell = np.nonzero(reach)
        apart = np.linalg.norm(points[home[row]] - points[cell], axis=1)
        able = distance[row, cell] ** 2 - near[row] ** 2 <= 2 * apart * radius + SLACK
        yield home, begin + row[able], cell[able]


def _choose_pivots(rows: pa.Table, cell: int, radius: float) -> pa.Table:
    """The pivots of a label, from a sample of its vectors: half as many as long as the sample's vectors visit too many cells."""
    label, dim, wanted = (rows.column(c)[0].as_py() for c in ("label", "dim", "wanted"))
    sample = _units(_matrix(rows.column("vector")))
    far = spread_pivots(sample, min(wanted, FARTHEST))
    points = np.concatenate([far, sample[: wanted - len(far)]])
    while len(points) > 1:
        visits = sum(len(row) for _, row, _ in visits_of(sample, points, radius))
        if visits <= COPIES * len(sample):
            break
        points = points[: len(points) // 2]
    values = {"label": [label], "dim": [dim], "points": [points.ravel().tolist()]}
    return pa.table([pa.array(v, rows.schema.field(k).type if k in rows.schema.names else pa.list_(pa.float64())) for k, v in values.items()], list(values))


def pivots_of(points: DataFrame, cell: int, radius: float) -> DataFrame:
    """(label, dim, points): the pivots, end to end, of each label and dimension with more than `cell` vectors."""
    sizes = stage(points.groupBy("label", "dim").agg(F.count("*").alias("size")), "label-sizes")
    total = sizes.agg(F.sum(F.col("size") * F.col("dim") * 8).alias("bytes")).first()["bytes"] or 0
    cell = max(cell, -(-total // PIVOT_BYTES))
    wanted = F.least(F.ceil(F.col("size") / cell), 2 * F.ceil(F.sqrt("size"))).cast("int")
    large = sizes.filter(F.col("size") > cell).withColumn("wanted", wanted)
    odds = F.greatest(F.lit(1), F.floor(F.col("size") / (SAMPLE_PER_PIVOT * F.col("wanted"))))
    drawn = points.join(large, ["label", "dim"]).filter(F.pmod(F.xxhash64("cid"), odds) == 0)
    kind = points.schema["label"].dataType.simpleString()
    grouped = drawn.select("label", "dim", "wanted", "vector").groupBy("label", "dim")
    return grouped.applyInArrow(lambda rows: _choose_pivots(rows, cell, radius), f"label {kind}, dim int, points array<double>")


def _cells(batches: Iterator[pa.RecordBatch], pivots, radius: float) -> Iterator[pa.RecordBatch]:
    """(cid, label, dim, weight, vector, cell, visits) with a row for each vector's home and each of its visits."""
    known = pivots.value
    for batch in batches:
        keys = list(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()))
        numbers = {k: i for i, k in enumerate(dict.fromkeys(keys))}
        own = np.fromiter((numbers[k] for k in keys), np.int64, len(keys))
        for key, number in numbers.items():
            some = batch.filter(pa.array(own == number))
            rows, cells, guests = np.arange(some.num_rows), np.zeros(some.num_rows, np.int32), np.zeros(some.num_rows, bool)
            if key in known:
                found = list(visits_of(_units(_matrix(some.column(4))), known[key], radius))
                rows = np.concatenate((rows, *(row for _, row, _ in found)))
                guests = np.arange(len(rows)) >= some.num_rows
                cells = np.concatenate([f[0] for f in found] + [f[2] for f in found]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*some.take(pa.array(rows)).columns, pa.array(cells), pa.array(guests)], [*batch.schema.names, "cell", "visits"])


class Forest:
    """Edges that connect what all links seen so far connect: one between any two trees still apart."""

    def __init__(self):
        self.parent: dict[int, int] = {}
        self.edges: list[tuple[int, int]] = []

    def find(self, x: int) -> int:
        parent = self.parent
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def link(self, x: int, y: int) -> None:
        a, b = self.find(x), self.find(y)
        if a != b:
            self.parent[a] = b
            self.edges.append((x, y))


def _compare(rows: pa.Table, cosine: float) -> pa.Table:
    side = np.array(rows.column("side"))
    ids, weights, vectors = np.array(rows.column("cid")), np.array(rows.column("weight")), _matrix(rows.column("vector"))
    units_of = np.linalg.norm(vectors, axis=1)
    left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
    same = bool((side == 2).any())  # a block with itself: each pair once
    forest, n_left, n_right = Forest(), np.zeros(len(left), np.int64), np.zeros(len(right), np.int64)
    step = max(1, COMPARED // max(1, len(right)))
    for begin in range(0, len(left), step):
        a = left[begin : begin + step]
        links = vectors[a] @ vectors[right].T / (units_of[a][:, None] * units_of[right][None, :]) >= cosine
        if same:
            links &= ids[a][:, None] < ids[right][None, :]
        n_left[begin : begin + step] = links @ weights[right]
        n_right += links.T @ weights[a]
        for i in np.flatnonzero(links.any(axis=1)):
            for j in ids[right[links[i]]].tolist():
                forest.link(int(ids[a[i]]), j)
    counts = np.concatenate((n_left, n_right))
    names = np.concatenate((ids[left], ids[right]))
    found = counts > 0
    u = pa.concat_arrays([pa.array(names[found], pa.int64()), pa.array([e[0] for e in forest.edges], pa.int64())])
    v = pa.concat_arrays([pa.nulls(int(found.sum()), pa.int64()), pa.array([e[1] for e in forest.edges], pa.int64())])
    n = pa.concat_arrays([pa.array(counts[found], pa.int64()), pa.nulls(len(forest.edges), pa.int64())])
    return pa.table([u, v, n], ["u", "v", "n"])


def near_vectors(
    embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = 0.98, cell: int = CELL
) -> DataFrame:
    """One row per vector: (key, n_links, component_id, kept).

    Vectors link when their labels are equal and their cosine, in double precision, is at least `cosine`; n_links counts the other
    rows linked directly, component_id is the smallest key that links lead to. Vectors that are NULL, empty, zero or hold a
    NULL or non-finite number, or whose label is NULL, link with nothing; nor do vectors of different length. Equal vectors are
    compared as one and counted as many. Rows with equal keys are rows of their own; NULL keys give a NULL component only where all
    its keys are NULL. Other columns are not read.
    """
    spark = embeddings.sparkSession
    wide = F.col(f"`{vector}`").cast("array<double>")
    read = embeddings.select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").alias("label"), wide.alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(F.col("label").isNotNull() & finite & F.exists("vector", lambda x: x != 0), F.lit(False))
    rows = stage(read.withColumn("usable", usable), "vectors")
    grouped = rows.filter("usable").groupBy("label", "vector").agg(F.count("*").alias("weight"), F.min("key").alias("least"))
    classes = stage(grouped.withColumn("cid", F.monotonically_increasing_id()), "vector-classes")
    points = classes.select("cid", "label", F.size("vector").alias("dim"), "weight", "vector")

    radius = float(np.sqrt(max(0.0, 2 - 2 * cosine)))
    found = pivots_of(points, cell, radius).collect()  # at most PIVOT_BYTES, and one pivot more per large label
    pivots = {(r["label"], r["dim"]): np.array(r["points"]).reshape(-1, r["dim"]) for r in found}
    shared = spark.sparkContext.broadcast(pivots)
    schema = "cid bigint, label {0}, dim int, weight bigint, vector array<double>, cell int, visits boolean"
    placed = points.mapInArrow(partial(_cells, pivots=shared, radius=radius), schema.format(points.schema["label"].dataType.simpleString()))
    placed = stage(placed, "cells")

    at = ["label", "dim", "cell"]
    counted = placed.groupBy(*at).agg(F.count(F.when(~F.col("visits"), 1)).alias("homes"), F.count(F.when(F.col("visits"), 1)).alias("guests"))
    sizes = counted.select(*at, F.ceil(F.col("homes") / BLOCK).cast("int").alias("own"), F.ceil(F.col("guests") / BLOCK).cast("int").alias("other"))
    sized = placed.join(stage(sizes.filter("own > 0"), "cell-sizes"), at)
    # Blocks 0..own-1 are homes, the next `other` are guests. Pair (a, b) has a home block a and any block b >= a.
    block = F.when(F.col("visits"), F.col("own") + F.pmod(F.xxhash64("cid"), F.col("other"))).otherwise(F.pmod(F.xxhash64("cid"), F.col("own")))
    blocked = sized.withColumn("block", block.cast("int"))
    mine = F.col("block")
    first = F.sequence(F.lit(0), F.least(mine, F.col("own") - 1))
    as_second = F.transform(first, lambda a: F.struct(a.alias("a"), mine.alias("b"), F.when(a == mine, 2).otherwise(1).alias("side")))
    later = F.filter(F.sequence(mine, F.col("own") + F.col("other")), lambda b: (b > mine) & (b < F.col("own") + F.col("other")))
    as_first = F.transform(later, lambda b: F.struct(mine.alias("a"), b.alias("b"), F.lit(0).alias("side")))
    tasks = F.when(F.col("visits"), as_second).otherwise(F.concat(as_second, as_first))
    dealt = blocked.withColumn("task", F.explode(tasks)).select("cid", "weight", "vector", *at, "task.a", "task.b", "task.side")
    found = dealt.groupBy(*at, "a", "b").applyInArrow(lambda pairs: _compare(pairs, cosine), "u bigint, v bigint, n bigint")
    found = stage(found, "block-links")

    counts = found.filter("v is null").groupBy("u").agg(F.sum("n").alias("n")).withColumnRenamed("u", "cid")
    roots = components(found.filter("v is not null").select("u", "v")).withColumnRenamed("node", "cid")
    known = classes.join(roots, "cid", "left").join(counts, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    known = stage(known.select("label", "vector", "weight", "least", "root", F.coalesce("n", F.lit(0)).alias("n")), "known-classes")
    heads = stage(known.groupBy("root").agg(F.min("least").alias("component_id")), "component-heads")
    answer = stage(known.join(heads, "root").select("label", "vector", (F.col("n") + F.col("weight") - 1).alias("n_links"), "component_id"), "class-answers")
    linked = rows.filter("usable").join(answer, ["label", "vector"]).select("key", "n_links", "component_id")
    alone = rows.filter("not usable").select("key", F.lit(0).cast("bigint").alias("n_links"), F.col("key").alias("component_id"))
    result = linked.union(alone).withColumn("kept", F.col("key").eqNullSafe(F.col("component_id")))
    return result.withColumnRenamed("key", key)
