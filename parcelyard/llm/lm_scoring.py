"""Language-model scores of whole texts, from corpus counts and a trained attention model.

The base score adds smoothed log probabilities of words, counted over all training
texts. The model score is the log probability of a text's subword ids: a causal
attention model gives the class of the next id, and the corpus counts of the ids give
its share within the class. All training texts are counted, and the attention weights
are trained on windows that cover each of them from start to end.

Training runs in synchronous rounds. Pieces of texts are dealt by hash to shards of about
the same size, so the number and order of files, partitions and tasks do not matter. All
shards of a round start from the same weights, are trained one by one in the order of
their hashes, and the mean of what they reach, by size, starts the next round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelyard.llm import attention as at
from parcelyard.llm import textarrays as ta
from parcelyard.llm.bytepair import kept_encoder
from parcelyard.llm.storage import shared_folder, stored, text_or_empty

SMOOTHING = 0.1
#: Words whose counts are broadcast; the counts of all others are joined.
FREQUENT = 1 << 18
#: Subword ids, the end among them.
IDS = 50257
END_ID = 50256
#: The end token's name among the hashed words.
END_WORD = np.uint64(0x9D5C0FB1A1F3E7C5)
#: Marks the start of a text where the id before a target is kept.
BEGIN_ID = 65535
#: Rounds of training, and the step size of the first one; it falls to an eighth of that.
ROUNDS, RATE = 8, 0.01
#: Ids of a piece of a text, of a shard, and the windows of a step of training.
PIECE_IDS, SHARD_IDS, STEP_WINDOWS = 4096, 1 << 20, 64
#: Tasks that add up the weights of a round.
SUMMING = 16


def held_out(key: str) -> Column:
    """Texts that are not learned from: a tenth of the keys; a null key counts as ''."""
    name = F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")
    return F.crc32(name) % 10 == 0


def _counted_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = ta.text_bytes(batch.column("text"))
        for a, b in ta.pieces(offsets):
            found = ta.words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], in_lower=True)
            word, n = np.unique(found.hash, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(word, END_WORD).view(np.int64)), pa.array(np.append(n, b - a))], ["word", "n"]
            )


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n): hashed words of all ``texts``, lower case, and one end for each text."""
    return (
        texts.select("text")
        .mapInArrow(_counted_batches, "word long, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
    )


def _prepared_batches(
    batches: Iterator[pa.RecordBatch], words: np.ndarray, logs: np.ndarray, model_json: str
) -> Iterator[pa.RecordBatch]:
    """Texts to their subword ids, the base score of frequent words, and the other words."""
    encoder = kept_encoder(model_json)
    rare_kind = pa.list_(pa.struct([("word", pa.int64()), ("n", pa.int32())]))
    for batch in batches:
        data, offsets = ta.text_bytes(batch.column("text"))
        rest = batch.drop_columns(["text"])
        for a, b in ta.pieces(offsets):
            found = ta.words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], in_lower=True)
            distinct, which = np.unique(found.hash, return_inverse=True)
            spot = np.minimum(np.searchsorted(words, distinct), max(len(words) - 1, 0))
            known = words[spot] == distinct if len(words) else np.zeros(len(distinct), bool)
            value = np.where(known, logs[spot], 0.0) if len(words) else np.zeros(len(distinct))
            text = found.text
            score = np.bincount(text, value[which], b - a)
            n_known = np.bincount(text, known[which], b - a).astype(np.int64)
            other = np.flatnonzero(~known[which])
            cell, n = np.unique(text[other] * len(distinct) + which[other], return_counts=True)
            owner, word = np.divmod(cell, max(len(distinct), 1))
            ends = np.searchsorted(owner, np.arange(b - a + 1)).astype(np.int32)
            rare = pa.ListArray.from_arrays(
                ends,
                pa.StructArray.from_arrays(
                    [pa.array(distinct[word].view(np.int64)), pa.array(n.astype(np.int32))], ["word", "n"]
                ),
            ).cast(rare_kind)
            small = ta.lower(data[offsets[a] : offsets[b]]).tobytes()
            cuts = (offsets[a : b + 1] - offsets[a]).tolist()
            ids, counts = encoder.encode([small[s:e].decode() for s, e in zip(cuts, cuts[1:])])
            ids = np.insert(ids, np.cumsum(counts), END_ID).astype("<u2")
            bounds = np.concatenate([[0], np.cumsum(2 * (counts + 1))]).astype(np.int32)
            held = pa.Array.from_buffers(
                pa.binary(), b - a, [None, pa.py_buffer(bounds), pa.py_buffer(ids.tobytes())]
            )
            yield pa.RecordBatch.from_arrays(
                [*rest.slice(a, b - a).columns, pa.array(np.diff(found.first)), pa.array(n_known),
                 pa.array(score), rare, held],
                [*rest.schema.names, "n_words", "n_frequent", "frequent_score", "rare", "ids"],
            )


def _ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a binary column, and the number in each row."""
    _, ends, data = column.buffers()
    bounds = np.frombuffer(ends, np.int32)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]]
    return raw.view("<u2"), np.diff(bounds) // 2


def _id_count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(IDS, np.int64)
    for batch in batches:
        if batch.num_rows:
            total += np.bincount(_ids(batch.column("ids"))[0], minlength=IDS)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["id", "n"])


def dealt_pieces(learned: DataFrame, shards: int, parts: int) -> DataFrame:
    """(part, shard, place, ids): texts cut into pieces, each behind the id before it.

    A shard and the place in it come from a hash of key, text and number of the piece.
    Shards are dealt to ``parts`` in turn.
    """
    whole = F.concat(F.lit(BEGIN_ID.to_bytes(2, "little")), "ids")
    cut = learned.select("doc", whole.alias("whole"), F.xxhash64("doc", "ids").alias("name")).select(
        "name", "whole", F.explode(F.expr(f"sequence(0L, (length(whole) - 3) div {2 * PIECE_IDS})")).alias("n")
    )
    ids = F.expr(f"substring(whole, cast({2 * PIECE_IDS} * n + 1 as int), {2 * PIECE_IDS + 2})")
    place = F.xxhash64("name", "n")
    shard = F.pmod(F.xxhash64(F.lit("shard"), "name", "n"), F.lit(shards))
    return cut.select(
        (shard % parts).cast("int").alias("part"), shard.alias("shard"), place.alias("place"), ids.alias("ids")
    )


def training_arrays(ids: np.ndarray, counts: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Inputs and target classes of the windows that cover some pieces, each id a target once.

    A piece is the id before its first target, or the mark of a start, and its targets.
    """
    counts = counts - 1
    rows = -(-counts // at.WINDOW)
    base = (np.cumsum(rows) - rows) * at.WINDOW
    begin = np.cumsum(counts) - counts
    place = np.arange(int(counts.sum())) + np.repeat(base - begin, counts)
    head = np.cumsum(counts + 1) - counts - 1
    last = head + counts
    inputs = np.full(int(rows.sum()) * at.WINDOW, at.PAD, np.int32)
    targets = np.full(len(inputs), -1, np.int64)
    before, after = np.delete(ids, last), np.delete(ids, head)
    inputs[place] = np.where(before == BEGIN_ID, at.START, at.bucket(before))
    targets[place] = classes[after]
    return inputs.reshape(-1, at.WINDOW), targets.reshape(-1, at.WINDOW)


def _trained_batches(
    batches: Iterator[pa.RecordBatch], values: np.ndarray, classes: np.ndarray, rate: float
) -> Iterator[pa.RecordBatch]:
    """Pieces in the order of shards to one row: the trained weights of all shards, added up.

    The weights of a shard count as often as it has windows; the first value is their number.
    """
    total, shard, model = np.zeros(len(values) + 1), None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        whole, sizes = _ids(batch.column("ids"))
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        names = batch.column("shard").to_numpy()
        firsts = np.flatnonzero(np.diff(names, prepend=names[0] - 1))
        for a, b in zip(firsts, [*firsts[1:], len(names)]):
            if model is None or names[a] != shard:
                if model is not None:
                    total += model.summed()
                shard, model = names[a], at.Trainer(at.shaped(values), STEP_WINDOWS, rate)
            for c, d in ta.pieces(bounds[a : b + 1], 1 << 18):
                ids = whole[bounds[a + c] : bounds[a + d]]
                model.add(*training_arrays(ids, sizes[a + c : a + d], classes))
    if model is not None:
        yield pa.RecordBatch.from_arrays([pa.array([(total + model.summed()).tobytes()], pa.binary())], ["total"])


def _summed_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        for row in batch.column("total"):
            one = np.frombuffer(row.as_buffer(), np.float64)
            total = one.copy() if total is None else total + one
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["total"])


def trained(learned: DataFrame, n_ids: int, values: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """``values`` after all rounds over the ``n_ids`` ids of ``learned`` (doc, ids).

    Each round takes one part of the shards, or all of its turn again where there are
    fewer shards than rounds, so every id is trained on at least once.
    """
    if not n_ids:
        return values
    shards = -(-n_ids // SHARD_IDS)
    parts = min(ROUNDS, shards)
    spark = learned.sparkSession
    path = shared_folder(spark)
    pieces = dealt_pieces(learned, shards, parts)
    pieces.write.partitionBy("part").parquet(path)
    dealt = spark.read.schema(pieces.schema).parquet(path)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    for n_round in range(ROUNDS):
        turn = dealt.filter(F.col("part") == n_round % parts).select("shard", "place", "ids")
        start = spark.sparkContext.broadcast((values, classes))
        rate = RATE * (1 / 8) ** (n_round / max(1, ROUNDS - 1))
        sums = (
            turn.repartition(min(-(-shards // parts), tasks), "shard")
            .sortWithinPartitions("shard", "place")
            .mapInArrow(lambda batches, s=start, r=rate: _trained_batches(batches, *s.value, r), "total binary")
        )
        if shards > SUMMING * parts:
            sums = sums.repartition(SUMMING).mapInArrow(_summed_batches, "total binary")
        total = np.sum([np.frombuffer(r["total"], np.float64) for r in sums.collect()], axis=0)
        start.unpersist()
        if np.ndim(total):
            values = total[1:] / total[0]
    return values


def _scored_batches(
    batches: Iterator[pa.RecordBatch], values: np.ndarray, classes: np.ndarray, shares: np.ndarray
) -> Iterator[pa.RecordBatch]:
    scorer = at.Scorer(at.shaped(values), 512)
    for batch in batches:
        rest = batch.drop_columns(["ids"])
        whole, sizes = _ids(batch.column("ids")) if batch.num_rows else (np.zeros(0), np.zeros(0, np.int64))
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        for a, b in ta.pieces(bounds, 1 << 18):
            ids, counts = whole[bounds[a] : bounds[b]], sizes[a:b]
            value = scorer.score(ids, classes[ids], counts).astype(np.float64) + shares[ids]
            score = np.add.reduceat(value, np.cumsum(counts) - counts)
            yield pa.RecordBatch.from_arrays(
                [*rest.slice(a, b - a).columns, pa.array(score)], [*rest.schema.names, "score"]
            )


def class_table(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class of each id, its log10 share within the class, and the share of each class.

    Ids are ranked by count and cut into classes of about equal mass, so that the most
    frequent ones have a class each. Counts are smoothed; the shares of a class add up
    to 1.
    """
    mass = counts + SMOOTHING
    order = np.argsort(-mass, kind="stable")
    reached = np.cumsum(mass[order]) - mass[order] / 2
    rank = np.minimum((reached / mass.sum() * at.CLASSES).astype(int), at.CLASSES - 1)
    classes = np.empty(len(counts), np.int64)
    classes[order] = rank
    total = np.bincount(classes, mass, at.CLASSES)
    return classes, np.log10(mass / total[classes]), total / total.sum()


def score_texts(
    df: DataFrame, model_path: str, key: str = "doc_id", text: str = "text", frequent: int = FREQUENT
) -> DataFrame:
    """(doc, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row of ``df``.

    Tokens are words in lower case (A-Z only) and one end for each text; a null or empty
    text is its end alone. ``score`` is the log10 probability of the text's subword ids
    and their end. Training texts are those that are not held out; without any, all
    counts are 0 and the attention weights stay as they began. Words are told apart by
    64-bit hashes. What is broadcast has a fixed size: the counts of the ``frequent``
    most frequent words, the counts of the ids, and the weights.
    """
    spark = df.sparkSession
    with open(model_path, encoding="utf-8") as file:
        model_json = file.read()
    source = df.select(
        F.col(key).alias("doc"), held_out(key).alias("held_out"), text_or_empty(text).alias("text")
    )
    kind = source.schema["doc"].dataType.simpleString()
    counts = stored(word_counts(source.filter("NOT held_out")))
    sums = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    total, distinct = sums[0] or 0, sums[1]
    log = lambda c: F.log10((c + SMOOTHING) / (total + SMOOTHING * (distinct + 1)))
    top = (
        counts.orderBy(F.desc("n"), "word").limit(frequent)
        .select("word", log(F.col("n")).alias("log")).toArrow()
    )
    words = top.column("word").to_numpy().view(np.uint64)
    by_word = np.argsort(words)
    shared = spark.sparkContext.broadcast(
        (words[by_word], top.column("log").to_numpy()[by_word], model_json)
    )
    prepared = stored(
        source.withColumn("row", F.monotonically_increasing_id()).mapInArrow(
            lambda batches: _prepared_batches(batches, *shared.value),
            f"doc {kind}, held_out boolean, row long, n_words long, n_frequent long, "
            "frequent_score double, rare array<struct<word: long, n: int>>, ids binary",
        )
    )

    learned = prepared.filter("NOT held_out")
    id_counts = np.zeros(IDS, np.int64)
    ids = learned.select("ids").mapInArrow(_id_count_batches, "id int, n long")
    for row in ids.groupBy("id").agg(F.sum("n").alias("n")).collect():
        id_counts[row["id"]] = row["n"]
    classes, shares, class_shares = class_table(id_counts)
    values = trained(
        learned.select("doc", "ids"), int(id_counts.sum()), at.flat(at.initial(class_shares)), classes
    )

    model = spark.sparkContext.broadcast((values, classes, shares))
    scored = prepared.drop("rare").mapInArrow(
        lambda batches: _scored_batches(batches, *model.value),
        f"doc {kind}, held_out boolean, row long, n_words long, n_frequent long, "
        "frequent_score double, score double",
    )
    rare = prepared.select("row", F.explode("rare").alias("w")).select("row", "w.word", F.col("w.n").alias("times"))
    met = rare.join(counts, "word", "left")
    others = met.groupBy("row").agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("times"))).alias("n_other"),
        F.sum(F.col("times") * log(F.coalesce("n", F.lit(0)))).alias("other_score"),
    )
    ends = counts.filter(F.col("word") == int(END_WORD.view(np.int64))).agg(F.sum("n")).first()[0] or 0
    return scored.join(others, "row", "left").select(
        "doc",
        "held_out",
        (F.col("n_words") + 1).alias("n_tokens"),
        (F.col("n_frequent") + F.coalesce("n_other", F.lit(0)) + int(ends > 0)).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("frequent_score") + F.coalesce("other_score", F.lit(0.0)) + log(F.lit(ends))).alias("base_score"),
        "score",
    )
