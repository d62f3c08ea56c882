"""One-hot columns, training projection and learner-ready types."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerledger import schemas as S
from peerledger.functions.coerce import to_int
from peerledger.functions.names import label_text
from peerledger.operators.ranking import hash_rank
from peerledger.session import stage


# Values of a column that may become columns of their own; a wider domain goes through `one_hot_sparse`.
MAX_FLAGS = 5_000


def category_values(
    df: DataFrame, columns: Sequence[str] = S.CATEGORICAL, max_values: int = MAX_FLAGS
) -> dict[str, list[str]]:
    """Sorted distinct non-null values per column, found in one job.

    The values become columns, so they are few: more than `max_values` of them in one column is an error, found before any is collected.
    """
    pair = F.explode(
        F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in columns])
    )
    found = df.select(pair.alias("p")).select("p.*").filter("value is not null").distinct()
    found = stage(found, "category-values")
    many = found.groupBy("name").count().filter(F.col("count") > max_values).collect()
    if many:
        raise ValueError(f"more than {max_values} distinct values in {sorted(r['name'] for r in many)}: use one_hot_sparse")
    rows = found.collect()
    return {c: sorted(r["value"] for r in rows if r["name"] == c) for c in columns}


def one_hot(
    df: DataFrame,
    columns: Sequence[str] = S.CATEGORICAL,
    values: Mapping[str, Sequence[str]] | None = None,
    on_collision: str = "or",
) -> DataFrame:
    """Replace each column by one 0/1 column per value; NULL gives all zeros.

    Values whose sanitised names coincide share one column that is 1 for any of them
    (on_collision="or") or get numbered names (on_collision="suffix").
    """
    if on_collision not in ("or", "suffix"):
        raise ValueError(f"unknown on_collision {on_collision!r}")
    values = values or category_values(df, columns)
    flags = []
    for column in columns:
        groups: dict[str, list[str]] = {}
        for value in sorted(values[column]):
            name = f"{column}_ohe_{label_text(value)}"
            if on_collision == "suffix" and name in groups:
                n = 2
                while f"{name}_{n}" in groups:
                    n += 1
                name = f"{name}_{n}"
            groups.setdefault(name, []).append(value)
        for name, members in groups.items():
            hit = F.col(column).isin(*members)
            flags.append(F.when(hit, F.lit(1)).otherwise(F.lit(0)).alias(name))
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, *flags)


def vocabulary(df: DataFrame, columns: Sequence[str] = S.CATEGORICAL, seed: int = 42) -> DataFrame:
    """(name, value, index), staged: the distinct non-null values of each column, numbered from 0 in the order of their seeded hash.

    However many values there are, none is collected and no task sorts a whole column of them.
    """
    pair = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in columns]))
    found = stage(df.select(pair.alias("p")).select("p.*").filter("value is not null").distinct(), "category-values")
    ranked = hash_rank(found, "value", seed, ["name"])
    return stage(ranked.select("name", "value", (F.col("rank") - 1).alias("index")), "vocabulary")


def one_hot_sparse(
    df: DataFrame, columns: Sequence[str] = S.CATEGORICAL, words: DataFrame | None = None, keep_index: bool = False
) -> DataFrame:
    """Replace each column by a sparse vector `<column>_ohe` with a 1 at the value's index; NULL and values that the vocabulary lacks
    give all zeros. `words` is a `vocabulary`, of another table too. The values are joined, not collected, so a domain may be as wide as the table."""
    words = vocabulary(df, columns) if words is None else words
    sizes = {r["name"]: r["size"] for r in words.groupBy("name").agg(F.count("*").alias("size")).collect()}  # a row per column
    for c in columns:
        size = sizes.get(c, 1)  # a column without values gets one place that nothing sets
        own = words.filter(F.col("name") == c).select(F.col("value").alias("_value"), F.col("index").alias("_index"))
        joined = df.join(own, F.col(f"`{c}`").cast("string") == F.col("_value"), "left")
        # One more category stands for nothing; the encoder drops the last category, so that it has no place in the vector.
        known = {"ml_attr": {"type": "nominal", "num_vals": size + 1, "name": f"{c}_index"}}
        index = F.coalesce("_index", F.lit(size)).cast("double")
        indexed = joined.withColumn(f"_{c}", index.alias(f"_{c}", metadata=known))
        encoder = OneHotEncoder(inputCols=[f"_{c}"], outputCols=[f"{c}_ohe"], dropLast=True)
        encoded = encoder.fit(indexed).transform(indexed)
        df = encoded.withColumn(f"{c}_index", F.col("_index")) if keep_index else encoded
        df = df.drop(c, "_value", "_index", f"_{c}")
    return df


def training_projection(df: DataFrame, label: str = S.LABEL) -> DataFrame:
    """Features first, label last."""
    return df.select(*[c for c in df.columns if c != label], label)


def fix_types(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Text columns become whole numbers, 0 where they do not parse."""
    text = [
        f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in keep
    ]
    zero = F.lit(0).cast("bigint")
    return df.withColumns({c: F.coalesce(to_int(F.col(c), "bigint"), zero) for c in text}) if text else df


def feature_names(df: DataFrame, drop: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in set(drop)]


def assemble(
    df: DataFrame, features: Sequence[str], output: str = "features", missing: float | None = None
) -> DataFrame:
    """Feature vector next to the remaining columns.

    Missing values stay visible as NaN, or become `missing` for learners that cannot see NaN.
    """

    def number(name: str) -> Column:
        value = F.col(name).cast("double")
        return (value if missing is None else F.coalesce(value, F.lit(float(missing)))).alias(name)

    rest = [c for c in df.columns if c not in set(features)]
    numbers = df.select(*rest, *[number(c) for c in features])
    built = VectorAssembler(inputCols=list(features), outputCol=output, handleInvalid="keep")
    return built.transform(numbers).select(*rest, output)
