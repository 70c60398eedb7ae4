"""Importance resampling of documents towards the n-grams of a target table.

Both tables become counts of hashed n-grams. A bucket's gain is the logarithm of how much
more frequent it is in the target; a document's weight is the sum of the gains of its
n-grams. The documents to draw have the highest weight plus noise that depends on their
ids alone, which draws without replacement in proportion to the weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelyard.llm import interning
from parcelyard.llm import textarrays as ta
from parcelyard.llm.storage import carried, stored, text_or_empty

#: Longest run of words that is a feature; hash buckets.
MOST_WORDS = 3
BUCKETS = 10_000
#: Bytes of text that are interned at once; longer texts are cut between words.
PIECE_BYTES = 1 << 19
SEED = 42
LEAST_WORDS = 20
PERCENT = 5

COLUMNS = ("n_words", "n_features", "weight", "score", "rank")


def _long_parts(data: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, int]]:
    """Parts of one text of about ``most`` bytes, cut between words.

    Each later part starts with the last words of the one before, so that runs across the
    cut are whole; their number comes with the part.
    """
    lead, n_lead, at = np.zeros(0, np.uint8), 0, 0
    while at < len(data):
        end = min(at + most, len(data))
        while end < len(data) and interning._LETTER[data[end]]:  # a word is never cut
            block = data[end : end + most]
            gap = np.flatnonzero(~interning._LETTER[block])
            end += int(gap[0]) if len(gap) else len(block)
        part = np.concatenate([lead, data[at:end]])
        yield part, n_lead
        found = interning.words(part, np.array([0, len(part)]))
        n_lead = min(len(found.begin), MOST_WORDS - 1)
        lead = found.data[found.begin[-n_lead] :] if n_lead else np.zeros(0, np.uint8)
        at = end


def _interned(
    column: pa.Array, most: int
) -> Iterator[tuple[np.ndarray, np.ndarray, interning.NGrams]]:
    """(text of each unit, words of each unit, n-grams), a piece of the column at a time."""
    data, offsets = ta.text_bytes(column)
    for a, b in ta.pieces(offsets, most):
        part, cuts = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        units = [(part, cuts, np.zeros(b - a, np.int64))]
        if b == a + 1 and len(part) > most:
            units = [
                (x, np.array([0, len(x)]), np.array([n], np.int64))
                for x, n in _long_parts(part, most)
            ]
        for x, x_cuts, lead in units:
            found = interning.words(x, x_cuts)
            own = np.diff(found.first) - lead
            yield np.arange(a, b), own, interning.intern(found, MOST_WORDS, BUCKETS, lead)


def _count_batches(
    batches: Iterator[pa.RecordBatch], most: int = PIECE_BYTES
) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for _, _, grams in _interned(batch.column(0), most):
            total += np.bincount(grams.bucket, grams.count, BUCKETS).astype(np.int64)
    full = np.flatnonzero(total)
    yield pa.record_batch([pa.array(full, pa.int64()), pa.array(total[full])], ["bucket", "n"])


def _weight_batches(
    batches: Iterator[pa.RecordBatch], gains: np.ndarray, most: int = PIECE_BYTES
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_words, n_features, weight = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
        for texts, own, grams in _interned(batch.column("text"), most):
            np.add.at(n_words, texts, own)
            first, n = texts[0], len(texts)
            n_features[first : first + n] += np.bincount(grams.text, minlength=n)
            gain = gains[grams.bucket][grams.slot]
            # sums stay far below 2^53, so floating point holds them exactly
            weight[first : first + n] += np.bincount(grams.text, gain, n).astype(np.int64)
        kept = batch.drop_columns(["text"])
        yield pa.record_batch(
            [*kept.columns, *map(pa.array, (n_words, n_features, weight))],
            [*kept.schema.names, "n_words", "n_features", "weight"],
        )


def bucket_counts(table: DataFrame, text: str = "text") -> np.ndarray:
    """How many n-grams of all rows of ``table`` fall into each bucket.

    Every task sends its sums, at most one row per bucket. A null text has no n-grams; an
    empty table gives zeros.
    """
    texts = table.select(text_or_empty(text).alias("text"))
    counted = texts.mapInArrow(_count_batches, "bucket long, n long")
    out = np.zeros(BUCKETS, np.int64)
    for r in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the logarithm of each bucket's smoothed share in target over source."""
    n = len(source)
    over = (target + 1.0) * (float(source.sum()) + n)
    return np.floor(1000 * np.log(over / ((source + 1.0) * (float(target.sum()) + n)))).astype(np.int64)


def _ranked(rows: DataFrame) -> DataFrame:
    """``rows`` with their place by falling score, then rising id, counted from 1.

    Rows are dealt to ranges of the score and sorted there, so no task holds all of them;
    the counts of the ranges, a row each, give where the places of a range begin.
    """
    order = [F.desc("score"), F.asc_nulls_last("id"), F.asc("at")]
    within = F.monotonically_increasing_id()
    dealt = stored(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", within)
    )
    part = F.shiftright("place", 33)
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = (
        dealt.groupBy(part.alias("part"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("begin"))
    )
    place = F.col("begin") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return (
        dealt.withColumn("part", part)
        .join(F.broadcast(begins), "part")
        .select(*rows.columns, place.alias("rank"))
    )


def resample(
    docs: DataFrame,
    target: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
    piece_bytes: int = PIECE_BYTES,
) -> DataFrame:
    """Every row of ``docs`` without its text, with n_words, n_features, weight, score, rank.

    ``rank`` counts the drawn rows from 1: ``percent`` of the rows with ``least_words``
    words, of highest score, ties to the smaller id (a null id last, and its noise is that
    of an empty id). Rows with the same id and score, repeated ones among them, take ranks
    in any order. A null text has no words. Texts are read whole, long ones in parts. Of
    columns with the name of a result column, the result's is returned. An empty table
    gives an empty result, an empty target only negative or zero gains.
    """
    gains = bucket_gains(bucket_counts(docs, text), bucket_counts(target))
    source = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carried(docs, text, *COLUMNS)]).alias("row"),
        F.col(doc_id).alias("id"),
        text_or_empty(text).alias("text"),
    )
    weighed = source.mapInArrow(
        partial(_weight_batches, gains=gains, most=piece_bytes),
        source.drop("text").schema.add("n_words", "long").add("n_features", "long").add("weight", "long"),
    )
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    share = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    noise = F.floor(-1000 * F.log(-F.log(share))).cast("long")
    scored = stored(
        weighed.withColumn("score", F.col("weight") + noise).withColumn(
            "at", F.monotonically_increasing_id()
        )
    )
    able = F.col("n_words") >= least_words
    most = percent * scored.filter(able).count() // 100
    ranked = _ranked(scored.filter(able))
    drawn = F.when(F.col("rank") <= most, F.col("rank"))
    rest = scored.filter(~able).withColumn("rank", F.lit(None).cast("long"))
    return (
        ranked.withColumn("rank", drawn).union(rest.select(ranked.columns)).select("row.*", *COLUMNS)
    )
