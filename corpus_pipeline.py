"""A corpus pipeline over `documents`: language, exact copies, near copies, mixture, token ids.

Each stage takes all that its predecessor kept; its result is written and read again, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerledger.llm.bpe import decode, encode
from peerledger.llm.exact_dedup import exact_dedup
from peerledger.llm.jaccard import near_duplicates
from peerledger.llm.language_id import predict, train
from peerledger.llm.mixing import mix
from peerledger.llm.registry import table
from peerledger.session import stage

TOKENIZER = "byte_bpe_50k.json"
ORACLE_SQL = None  # the tokenizer cannot be written in SQL


def columns_of(docs: DataFrame) -> list[str]:
    return [f"doc.`{c}`" for c in docs.columns]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no language is found are rejected: NULL texts, texts without a letter, and texts in which every language has
    no more n-grams than chance gives."""
    judged = predict(docs, train(docs), [F.struct(*[f"`{c}`" for c in docs.columns]).alias("doc")])
    return judged.filter("known").select(*columns_of(docs))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays. A NULL text equals an empty one; of rows that share text and id one stays,
    and a row without an id only if no equal text has one."""
    return exact_dedup(docs).filter("kept").select(*columns_of(docs))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays, one of them if rows share it; rows without an id come last.
    Texts that are NULL, empty or without words are near nothing and stay."""
    return near_duplicates(docs).filter("kept").select(*columns_of(docs))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, in whole documents: the one that a source's quota ends in is rounded.

    Texts that are NULL, empty or without words have nothing to take and go. Documents without a source are a source of their own. Rows
    that share id and text are taken one by one, in no order."""
    mixed = mix(docs)
    copies = F.floor((2 * F.col("taken") + F.col("size")) / (2 * F.col("size"))).cast("int")
    times = F.when(F.col("size") > 0, copies).otherwise(0)
    return mixed.select(F.explode(F.array_repeat("doc", times)).alias("doc")).select(*columns_of(docs))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, n_bytes, ids): n_bytes is the length of the text that the ids decode to. NULL and empty texts have no ids and
    0 bytes; repeated rows stay rows of their own."""
    import public_tokenizers

    tokenizer = public_tokenizers.path(TOKENIZER)
    read_back = decode(encode(docs, tokenizer), tokenizer)
    return read_back.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.octet_length("decoded").cast("bigint").alias("n_bytes"), "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("mixture", mixture),
    ("token_ids", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
