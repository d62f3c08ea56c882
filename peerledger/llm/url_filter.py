"""URL filter: rules by host and path, and a logistic regression on hashed character n-grams where no rule fits.

Only the URLs are read. Grams of host and path are kept apart and hashed to a fixed number of features, in work and memory linear in the
characters of a URL; the classifier is trained by Spark ML on a labelled URL table, which may be small.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerledger.llm.words import slices

FEATURES = 2**16
GRAMS = (3, 4, 5)
SLICE_CHARS = 500_000
SEEDS = {"host": np.uint64(0x9E3779B97F4A7C15), "path": np.uint64(0xC2B2AE3D27D4EB4F)}
STEP = np.uint64(0xD6E8FEB86659FD93)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Rule:
    """A verdict for a host, its subdomains, and the paths that start with `path`."""

    verdict: str
    host: str
    path: str

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | F.endswith(host, F.lit(f".{self.host}"))) & F.startswith(path, F.lit(self.path))


def host_of(url: Column) -> Column:
    """What follows the first `://`, up to `/`, `?`, `#` or the end, A to Z lower-cased; empty without one, or for NULL."""
    at = F.instr(url, "://")
    rest = F.substring(url, at + 3, F.length(url))
    return F.when(at > 0, F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)).otherwise("")


def path_of(url: Column) -> Column:
    """What follows the host, up to `?`, `#` or the end; empty where there is no host, or for NULL."""
    at = F.instr(url, "://")
    rest = F.substring(url, at + 3, F.length(url))
    return F.when(at > 0, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise("")


def gram_slots(parts: Sequence[str], seed: np.uint64) -> np.ndarray:
    """Text number times FEATURES plus slot, of each hashed gram of each text between two border marks. Empty texts have none."""
    joined = "".join(f"^{p}$" if p else "" for p in parts)
    chars = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(parts)), [len(p) + 2 if p else 0 for p in parts])
    found = []
    for n in GRAMS:
        count = max(0, len(chars) - n + 1)
        code = np.full(count, seed + np.uint64(n), np.uint64)
        for i in range(n):
            code = (code ^ chars[i : i + count]) * STEP
            code ^= code >> np.uint64(29)
        inside = owner[:count] == owner[n - 1 :] if count else np.zeros(0, bool)
        found.append(owner[:count][inside] * FEATURES + (code[inside] % np.uint64(FEATURES)).astype(np.int64))
    return np.concatenate(found)


def features(hosts: Sequence[str], paths: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """(URL, slot) of the distinct hashed grams of each URL, in order."""
    return np.divmod(np.unique(np.concatenate([gram_slots(hosts, SEEDS["host"]), gram_slots(paths, SEEDS["path"])])), FEATURES)


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, slots)."""
    for batch in batches:
        label, hosts, paths = (c.to_pylist() for c in batch.columns)
        owner, slots = features(hosts, paths)
        ends = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(hosts)))))
        lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(slots.astype(np.int32)))
        yield pa.RecordBatch.from_arrays([pa.array(label, pa.float64()), lists], ["label", "slots"])


def train(labelled: DataFrame, url: str = "url", label: str = "blocked", penalty: float = 0.01, rounds: int = 100) -> LogisticRegressionModel:
    """Fit on (url, label 0 or 1), both labels weighing the same in all. Rows without a label are left out; a NULL url has no grams and
    moves the intercept only."""
    known = labelled.select(F.col(f"`{url}`").alias("url"), F.col(f"`{label}`").cast("double").alias("label")).filter("label is not null")
    listed = known.select("label", host_of(F.col("url")), path_of(F.col("url"))).mapInArrow(_listed, "label double, slots array<int>")
    shares = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}  # two rows
    weight = F.lit(sum(shares.values())) / F.create_map(*[F.lit(v) for pair in shares.items() for v in pair])[F.col("label")]
    vector = F.udf(lambda slots: Vectors.sparse(FEATURES, slots, [1.0] * len(slots)), VectorUDT())
    learner = LogisticRegression(maxIter=rounds, regParam=penalty, standardization=False, weightCol="weight")
    return learner.fit(listed.select("label", vector("slots").alias("features"), weight.alias("weight")))


def _score(batches: Iterator[pa.RecordBatch], weights, intercept: float) -> Iterator[pa.RecordBatch]:
    """The batch's columns (key, host, path) and the probability of each row."""
    for batch in batches:
        hosts, paths = (c.to_pylist() for c in batch.columns[1:])
        scores = np.empty(len(hosts))
        for begin, end in slices([h + p for h, p in zip(hosts, paths)], SLICE_CHARS):
            owner, slots = features(hosts[begin:end], paths[begin:end])
            scores[begin:end] = intercept + np.bincount(owner, weights.value[slots], end - begin)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(1 / (1 + np.exp(-scores)))], ["key", "host", "path", "score"])


def judge(
    pages: DataFrame, model: LogisticRegressionModel, rules: Sequence[Rule] = (), key: str = "page_id", url: str = "url", threshold: float = 0.5
) -> DataFrame:
    """(key, host, path, rule, verdict, score) of every row.

    `score` is the model's probability that the URL is to be blocked, and its verdict is to block from `threshold` on. A rule that fits
    decides instead: the longest, by characters of host and path; of equally long ones that with the longer host. `rule` is its host
    and path, NULL where none fits. The rules are a list of the caller's, tested in one pass. A NULL url, or one without `://`, has empty
    host and path, which no rule fits unless its own are empty; repeated rows and keys stay rows of their own.
    """
    read = pages.select(F.col(f"`{key}`").alias("key"), F.col(f"`{url}`").alias("url"))
    parts = read.select("key", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    weights = pages.sparkSession.sparkContext.broadcast(model.coefficients.toArray())  # FEATURES doubles
    schema = T.StructType([*parts.schema.fields, T.StructField("score", T.DoubleType())])
    scored = parts.mapInArrow(partial(_score, weights=weights, intercept=model.intercept), schema)
    ordered = sorted(rules, key=lambda r: (-len(r.host + r.path), -len(r.host), r.verdict != BLOCK))
    fits = [F.when(r.fits(F.col("host"), F.col("path")), F.struct(F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict"))) for r in ordered]
    none = F.lit(None).cast("struct<rule:string,verdict:string>")
    own = F.when(F.col("score") >= threshold, BLOCK).otherwise(ALLOW)
    ruled = scored.withColumn("fit", F.coalesce(*fits, none))
    return ruled.select(F.col("key").alias(key), "host", "path", "fit.rule", F.coalesce("fit.verdict", own).alias("verdict"), "score")
