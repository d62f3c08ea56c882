"""Language identification with language-bitmask n-gram filters.

The model is one bit-sliced Bloom filter: slot i holds a mask with a bit per language, in as many words as the languages need, so the
masks at an n-gram's slots, ANDed, name every language that contains it. A text's n-grams give a popcount per language; the expected false positives, known from how
full each language's slice is, are taken off, and the largest corrected count decides.

An n-gram is N bytes of the lower-cased UTF-8 text in which everything but letters is a space. A language contains it if it is in
enough of the language's training texts, and not far fewer than in the language that has it most.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peerledger.llm.memory import frugal
from peerledger.llm.words import slices
from peerledger.session import stage_counted

N = 4
HASHES = 3
BITS = 63  # languages in a word of a mask
TRAIN_ROWS = 5000
MIN_SHARE = 0.002
NEAR_BEST = 0.25
SLOTS_PER_ENTRY = 8
CHANCE = 4.0  # standard deviations of the false positives, above which a text's n-grams count as known
SLICE_CHARS = 500_000
UNKNOWN = "und"
#: Odd constants of the slot hashes.
MIXERS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)

A_LETTER = re.compile(r"[^\W\d_]")


@dataclass
class LanguageFilter:
    languages: list[str]  # by bit
    shares: list[float]  # of the training rows, for texts that no n-gram decides
    slots: np.ndarray  # masks: a row per word, a column per slot

    def false_rates(self) -> np.ndarray:
        full = np.array([np.count_nonzero(self.slots[b // BITS] & np.uint64(1 << b % BITS)) for b in range(len(self.languages))])
        return (full / self.slots.shape[1]) ** HASHES

    def popcounts(self, grams: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
        """How many n-grams of each text the filter finds in each language: rows are texts, columns languages."""
        places = [slot_of(grams, i, self.slots.shape[1]) for i in range(HASHES)]
        counts = np.zeros((texts, len(self.languages)))
        for w, word in enumerate(self.slots):
            mask = word[places[0]]
            for place in places[1:]:
                mask &= word[place]
            for b in range(w * BITS, min((w + 1) * BITS, len(self.languages))):
                counts[:, b] = np.bincount(owner[(mask >> np.uint64(b % BITS)) & np.uint64(1) == 1], minlength=texts)
        return counts


def _letter_bytes() -> np.ndarray:
    """Of each byte: itself if it can be part of a letter, else a space. Bytes from 128 up belong to letters of other scripts, or
    to marks that all languages share."""
    table = np.full(256, 32, np.uint8)
    table[128:] = np.arange(128, 256)
    table[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
    return table


LETTERS = _letter_bytes()


def grams_of(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """N-grams of all texts, as integers, and the text each comes from; a space is put before and after each text."""
    data = [(" " + t.lower() + " ").encode("utf-8") for t in texts]
    raw = LETTERS[np.frombuffer(b"".join(data), np.uint8)].astype(np.uint32)
    lengths = np.fromiter(map(len, data), np.int64, len(data))
    if len(raw) < N:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    count = len(raw) - N + 1
    grams = np.zeros(count, np.uint32)
    for i in range(N):
        grams = (grams << np.uint32(8)) | raw[i : i + count]
    owner = np.repeat(np.arange(len(data)), lengths)
    whole = (owner[:count] == owner[N - 1 :]) & ((grams & np.uint32(0xFFFF)) != 0x2020)  # not across texts, not from gaps
    return grams[whole], owner[:count][whole]


def slot_of(gram: np.ndarray, i: int, slots: int) -> np.ndarray:
    mixed = gram.astype(np.uint64) * np.uint64(MIXERS[i])
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(MIXERS[(i + 1) % len(MIXERS)])
    return ((mixed >> np.uint64(20)) & np.uint64(slots - 1)).astype(np.int64)


@frugal
def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, texts): in how many texts of a batch each n-gram is."""
    for batch in batches:
        langs = np.array(batch.column(0).to_pylist(), dtype=object)
        texts = batch.column(1).to_pylist()
        for begin, end in slices(texts, SLICE_CHARS):
            grams, owner = grams_of(texts[begin:end])
            each = np.unique((owner.astype(np.uint64) << np.uint64(32)) | grams)  # once per text
            names = langs[begin:end][(each >> np.uint64(32)).astype(np.int64)]
            for lang in sorted(set(names)):
                found, texts_of = np.unique(each[names == lang] & np.uint64(0xFFFFFFFF), return_counts=True)
                columns = [pa.array([lang] * len(found), pa.string()), pa.array(found.astype(np.int64)), pa.array(texts_of.astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "gram", "texts"])


@frugal
def _slots(batches: Iterator[pa.RecordBatch], slots: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        gram = batch.column(0).to_numpy().astype(np.uint32)
        places = np.concatenate([slot_of(gram, i, slots) for i in range(HASHES)])
        words, masks = (np.tile(batch.column(i).to_numpy(zero_copy_only=False), HASHES) for i in (1, 2))
        yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(places), pa.array(masks)], ["word", "slot", "mask"])


def train(labelled: DataFrame, lang: str = "lang", text: str = "text", rows_per_language: int = TRAIN_ROWS) -> LanguageFilter:
    """Fit on at most about `rows_per_language` texts of each language, drawn by a hash of the text; equal texts of a language count
    as one, rows without text or language are not used. The filter's size follows the n-grams kept, which MIN_SHARE bounds however large the sample is."""
    rows = labelled.select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").alias("text")).dropna()
    texts = F.approx_count_distinct(F.xxhash64("text"), 0.02)
    found = rows.groupBy("lang").agg(F.count("*").alias("count"), texts.alias("texts")).collect()  # one row per language
    shares, distinct = {r["lang"]: r["count"] for r in found}, {r["lang"]: r["texts"] for r in found}
    names = sorted(shares, key=lambda n: (-shares[n], n))
    total = sum(shares.values()) or 1
    if not names:
        return LanguageFilter([], [], np.zeros((1, 1), np.uint64))

    def of_language(values: dict, kind: str) -> Column:
        """Looked up by name. The names are as many as the languages of the table."""
        return F.from_json(F.lit(json.dumps(values)), f"map<string,{kind}>")[F.col("lang")]

    limit = of_language({n: min(1.0, rows_per_language / distinct[n]) for n in names}, "double")
    drawn = rows.filter(F.pmod(F.xxhash64("text"), F.lit(2**20)) < limit * 2**20).distinct()
    sizes = {r["lang"]: r["count"] for r in drawn.groupBy("lang").count().collect()}
    counted = drawn.mapInArrow(_count_grams, "lang string, gram bigint, texts bigint").groupBy("lang", "gram").agg(F.sum("texts").alias("texts"))
    size = of_language({n: max(1, sizes.get(n, 0)) for n in names}, "double")
    best = F.max("share").over(Window.partitionBy("gram"))
    number = of_language({n: b for b, n in enumerate(names)}, "int")
    kept = counted.withColumn("share", F.col("texts") / size).filter(F.col("share") >= MIN_SHARE)
    kept = kept.withColumn("best", best).filter(F.col("share") >= NEAR_BEST * F.col("best")).withColumn("bit", number)
    one = F.expr(f"shiftleft(1L, bit % {BITS})")
    by_word = kept.withColumn("word", F.floor(F.col("bit") / BITS).cast("int")).groupBy("gram", "word")
    masks, entries = stage_counted(by_word.agg(F.bit_or(one).alias("mask")), "language-grams")
    slots = 1 << max(10, (SLOTS_PER_ENTRY * entries).bit_length())
    placed = masks.mapInArrow(partial(_slots, slots=slots), "word int, slot bigint, mask bigint")
    filled = placed.groupBy("word", "slot").agg(F.bit_or("mask").alias("mask")).toArrow()  # at most one row per word and slot
    table = np.zeros((-(-len(names) // BITS), slots), np.uint64)
    word, slot, mask = (filled.column(c).to_numpy() for c in ("word", "slot", "mask"))
    table[word, slot] = mask.astype(np.uint64)
    return LanguageFilter(names, [shares[n] / total for n in names], table)


@frugal
def _predict(batches: Iterator[pa.RecordBatch], model, inside: str | None) -> Iterator[pa.RecordBatch]:
    """The last column is the text, or the struct that has it in the field `inside`."""
    known: LanguageFilter = model.value
    false = known.false_rates()
    bits = len(known.languages)
    for batch in batches:
        last = batch.column(batch.num_columns - 1)
        texts = [t or "" for t in (last if inside is None else last.field(inside)).to_pylist()]
        kept = batch.columns[:-1] if inside is None else batch.columns
        chosen, scores, sure = [], [], []
        for begin, end in slices(texts, SLICE_CHARS):
            some = texts[begin:end]
            grams, owner = grams_of(some)
            counts = known.popcounts(grams, owner, len(some))
            all_grams = np.bincount(owner, minlength=len(some)).astype(float)
            corrected = np.maximum(0.0, (counts - all_grams[:, None] * false) / (1 - false))
            sums = corrected.sum(axis=1)
            expected = all_grams[:, None] * false
            beyond = (counts - expected > CHANCE * np.sqrt(expected * (1 - false))).any(axis=1)
            for i, text in enumerate(some):
                if not bits or not A_LETTER.search(text):
                    chosen.append(UNKNOWN)
                    scores.append(0.0)
                    sure.append(False)
                    continue
                sure.append(bool(beyond[i]))
                if sums[i] <= 0:  # nothing known: the most frequent language, with its share
                    chosen.append(known.languages[0])
                    scores.append(known.shares[0])
                else:
                    b = int(corrected[i].argmax())
                    chosen.append(known.languages[b])
                    scores.append(float(corrected[i, b] / sums[i]))
        columns = [*kept, pa.array(chosen, pa.string()), pa.array(scores, pa.float64()), pa.array(sure, pa.bool_())]
        yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[: len(kept)], "lang_pred", "score", "known"])


def predict(docs: DataFrame, model: LanguageFilter, carry: Sequence[str | Column] = ("doc_id",), text: str = "text") -> DataFrame:
    """`carry`, lang_pred, score (0 to 1) and known of every whole text: whether a language has more of its n-grams than chance gives. Texts that are NULL, empty or without a letter are `und` with score
    0; a text whose n-grams no language has gets the most frequent language. Ties go to the more frequent language. A filter
    trained on nothing says `und`. Where the last of `carry` is a struct with the field `text`, the text is not carried twice."""
    from pyspark.sql import types as T

    read = docs.select(*carry)
    last = read.schema.fields[-1].dataType if read.columns else None
    inside = text if isinstance(last, T.StructType) and text in last.names else None
    fields = read.schema.fields
    if inside is None:
        read = docs.select(*carry, F.col(f"`{text}`").alias("_text"))
    schema = T.StructType([*fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("known", T.BooleanType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return read.mapInArrow(partial(_predict, model=shared, inside=inside), schema)


def held_out(key: Column) -> Column:
    """The quarter of documents that training does not see; a NULL key is in no quarter, and is not trained on either."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(4)) == 2
