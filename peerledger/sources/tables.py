"""Scans."""

from __future__ import annotations

import io
import re
from collections.abc import Iterator, Sequence
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerledger.functions.coerce import to_int
from peerledger.operators.sampling import head_sample

FOOTERS_A_TASK = 16
#: What Spark's readers report where a path has no Parquet files.
MISSING = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def scan(spark: SparkSession, path: str, schema: T.StructType | None = None, year_marker: str | None = None) -> DataFrame:
    """Parquet files under a path or glob; a missing path is reported with its name.

    With a contract, each file is read in its own types and cast to the contract, since Parquet does not read a number as text and
    batches of one table disagree. Names match whatever their case; a column that a file lacks is NULL; partition folders below
    the path, or below the last folder before a glob, are columns and prune files. Executors read the footers, in one job whatever the
    number of files. Files of one schema are read together, so pruning and pushed filters stay. With `year_marker` a column `year`
    is taken from the path.
    """
    try:
        whole = spark.read.options(**({} if schema is None else _base(path))).parquet(path)
    except AnalysisException as e:
        if (e.getCondition() or "").split(".")[0] not in MISSING:
            raise
        raise FileNotFoundError(f"no readable parquet at {path}") from e
    if schema is None:
        return whole if year_marker is None else with_path_year(whole, year_marker)
    groups = same_schema(spark, [unquote(f) for f in whole.inputFiles()])
    if len(groups) < 2 and "" not in groups:
        return _to_contract(whole, schema, year_marker)
    read = spark.read.options(**(_base(path) or {"basePath": path}))
    parts = [read.option("mergeSchema", str(not shape).lower()).parquet(*group) for shape, group in groups.items()]
    return reduce(DataFrame.unionByName, [_to_contract(part, schema, year_marker) for part in parts])


def _base(path: str) -> dict[str, str]:
    """The folder from which partition folders count, where the path is a glob; Spark takes a plain path itself."""
    parts = path.rstrip("/").split("/")
    globbed = next((i for i, p in enumerate(parts) if re.search(r"[*?\[{]", p)), None)
    if globbed is not None:
        return {"basePath": "/".join(parts[:globbed]) or "/"}
    return {"basePath": "/".join(parts[:-1])} if parts[-1].endswith(".parquet") and len(parts) > 1 else {}


def _shape(source) -> str:
    """Names and types of a Parquet footer."""
    import pyarrow.parquet as pq

    found = pq.read_metadata(source).schema
    columns = (found.column(i) for i in range(len(found)))
    return "; ".join(f"{c.path} {c.physical_type} {c.logical_type} {c.max_repetition_level}" for c in columns)


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, shape); the shape is NULL where only Spark can open the path."""
    from pyarrow import fs

    def shape(path: str) -> str | None:
        try:
            local = re.sub(r"^file:/*", "/", path)
            store, inner = (fs.LocalFileSystem(), local) if local.startswith("/") else fs.FileSystem.from_uri(path)
            with store.open_input_file(inner) as file:
                return _shape(file)
        except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
            return None

    for batch in batches:
        paths = batch.column(0).to_pylist()
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(map(shape, paths), pa.string())], ["path", "shape"])


def _whole_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        shapes = [_shape(io.BytesIO(content)) for content in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shapes, pa.string())], ["path", "shape"])


def same_schema(spark: SparkSession, files: Sequence[str]) -> dict[str, list[str]]:
    """Files by the schema of their footers, which executors read. Files in a store that only Spark's readers open are one group, named
    by the empty text, if Spark can merge their schemas; if not, they are read whole to tell. The list of files is the driver's, as in any scan."""
    if not files:
        return {}
    listed = spark.createDataFrame([(f,) for f in files], "path string").repartition(-(-len(files) // FOOTERS_A_TASK))
    rows = listed.mapInArrow(_footers, "path string, shape string").collect()
    unread = sorted(r["path"] for r in rows if r["shape"] is None)
    groups: dict[str, list[str]] = {}
    if unread and mergeable(spark, unread):
        groups[""] = unread
    elif unread:
        whole = spark.read.format("binaryFile").load(unread).select("path", "content")
        rows += whole.mapInArrow(_whole_files, "path string, shape string").collect()
    for path, shape in sorted((r["path"], r["shape"]) for r in rows if r["shape"] is not None):
        groups.setdefault(shape, []).append(path)
    return groups


def mergeable(spark: SparkSession, files: Sequence[str]) -> bool:
    try:
        spark.read.option("mergeSchema", "true").parquet(*files)
    except (PySparkException, Py4JJavaError):  # the merging tasks fail where footers disagree
        return False
    return True


def _to_contract(df: DataFrame, schema: T.StructType, year_marker: str | None) -> DataFrame:
    found = {f.name.lower(): f for f in df.schema.fields}
    columns = []
    for field in schema.fields:
        have = found.get(field.name.lower())
        if have is None:
            value = F.lit(None).cast(field.dataType)
        elif isinstance(have.dataType, T.DateType) and isinstance(field.dataType, T.StringType):
            value = F.date_format(F.col(f"`{have.name}`"), "yyyyMMdd")
        elif have.dataType == field.dataType:
            value = F.col(f"`{have.name}`")
        else:
            value = F.col(f"`{have.name}`").try_cast(field.dataType)
        columns.append(value.alias(field.name))
    return df.select(*columns, *([] if year_marker is None else [_path_year(year_marker)]))


def _path_year(marker: str) -> Column:
    return to_int(F.regexp_extract(F.col("_metadata.file_path"), rf"{marker}_(\d{{4}})", 1)).alias("year")


def with_path_year(df: DataFrame, marker: str) -> DataFrame:
    """`year` from the four digits after `<marker>_` in each row's file path; NULL if absent.

    Only for layouts that keep the year in a folder name. Data landed by `sinks.land_batches` has
    a `year=` partition instead, which also prunes files.
    """
    return df.select("*", _path_year(marker))


def scan_yearly(spark: SparkSession, root: str, marker: str, schema: T.StructType | None = None) -> DataFrame:
    return scan(spark, f"{root.rstrip('/')}/{marker}_*/*.parquet", schema, marker)


def scan_training(
    spark: SparkSession, path: str, sample_rows: int | None = None, keys: Sequence[str] = ()
) -> tuple[DataFrame, Observation]:
    """Training table and an observation that holds `rows` after the first action on it."""
    df = scan(spark, path)
    if sample_rows:
        df = head_sample(df, sample_rows, keys or df.columns)
    seen = Observation("training rows")
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen
