"""Mixing sources to target weights with soft domain membership.

A classifier trained on the labelled documents gives every document a posterior over
domains. Document rates are then fitted so that the expected tokens of each domain
meet their targets: nonnegative least squares by projected gradient steps, whose
only global state is one residual per domain.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelyard.llm import textarrays as ta
from parcelyard.llm.storage import stored, text_or_empty

SLOTS = 1 << 14
MOST_LABELLED = 6000


def _slot_counts(found: ta.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, slot, weight) of every word; a text's weights have unit length together.

    Weights grow with the logarithm of a word's count in the text.
    """
    key = found.text * SLOTS + (found.hash & np.uint64(SLOTS - 1)).astype(np.int64)
    cell, count = np.unique(key, return_counts=True)
    text, slot = np.divmod(cell, SLOTS)
    weight = 1 + np.log(count)
    norm = np.sqrt(np.bincount(text, weight**2, len(found.first) - 1))
    return text, slot, weight / norm[text]


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def fit_classifier(
    texts: Sequence[str], domains: Sequence[int], n_domains: int, rounds: int = 150, decay: float = 1e-4
) -> np.ndarray:
    """Weights (SLOTS + 1, n_domains) of a multinomial logistic regression; the last row is the bias.

    Full-batch steps with per-weight step sizes from accumulated squares. Domains that
    no label has keep zero weight and the bias of a rare one; with no texts at all the
    posterior is uniform.
    """
    weights = np.zeros((SLOTS + 1, n_domains))
    if not len(texts):
        return weights
    data, offsets = ta.text_bytes(pa.array(texts, pa.large_string()))
    parts = []
    for a, b in ta.pieces(offsets):
        text, slot, weight = _slot_counts(ta.words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], in_lower=True))
        parts.append((text + a, slot, weight))
    text, slot, weight = (np.concatenate(x) for x in zip(*parts))
    n = len(texts)
    truth = np.zeros((n, n_domains))
    truth[np.arange(n), domains] = 1
    weights[-1] = np.log((truth.sum(0) + 0.5) / (n + 0.5 * n_domains))
    squares = np.full_like(weights, 1e-8)
    used, column = np.unique(slot, return_inverse=True)
    for _ in range(rounds):
        z = np.stack([np.bincount(text, weight * weights[slot, k], n) for k in range(n_domains)], 1)
        error = (_softmax(z + weights[-1]) - truth) / n
        step = np.zeros_like(weights)
        for k in range(n_domains):
            step[used, k] = np.bincount(column, weight * error[text, k], len(used))
        step[-1] = error.sum(0)
        step[used] += decay * weights[used]
        squares += step**2
        weights -= 0.5 * step / np.sqrt(squares)
    return weights


def _posterior_batches(batches: Iterator[pa.RecordBatch], weights: np.ndarray) -> Iterator[pa.RecordBatch]:
    n_domains = weights.shape[1]
    for batch in batches:
        data, offsets = ta.text_bytes(batch.column("text"))
        for a, b in ta.pieces(offsets):
            found = ta.words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], in_lower=True)
            text, slot, weight = _slot_counts(found)
            z = np.stack([np.bincount(text, weight * weights[slot, k], b - a) for k in range(n_domains)], 1)
            posterior = _softmax(z + weights[-1])
            ends = np.arange(0, (b - a + 1) * n_domains, n_domains, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc").slice(a, b - a), batch.column("version").slice(a, b - a),
                 pa.array(np.diff(found.first)), pa.ListArray.from_arrays(ends, posterior.ravel())],
                ["doc", "version", "n_tokens", "posterior"],
            )


def domain(labels: DataFrame) -> Column:
    """Domains of the labels table: quality and toxic together, 0 to 3; null without both."""
    return (2 * F.col("quality") + F.col("toxic")).cast("int")


DOMAINS = 4
#: Rounds of the fit at most.
MOST_ROUNDS = 40


def labelled_texts(
    df: DataFrame,
    labels: DataFrame,
    most_rows: int = MOST_LABELLED,
    key: str = "doc_id",
    text: str = "text",
) -> tuple[list[str], list[int]]:
    """At most ``most_rows`` labelled texts and their domains, those with the smallest key hash.

    A key with several labels counts by the least. The bound holds for the broadcast
    and for what reaches the driver.
    """
    order = F.xxhash64(F.col(key))
    picked = (
        labels.withColumn("_domain", domain(labels))
        .filter(F.col(key).isNotNull() & F.col("_domain").between(0, DOMAINS - 1))
        .groupBy(key)
        .agg(F.min("_domain").alias("_domain"))
        .orderBy(order, key)
        .limit(most_rows)
    )
    rows = (
        df.select(key, text_or_empty(text).alias("text"))
        .join(F.broadcast(picked), key)
        .orderBy(order, key, F.xxhash64("text"))
        .limit(most_rows)
        .select("text", "_domain")
        .collect()
    )
    return [r["text"] for r in rows], [r["_domain"] for r in rows]


def posteriors(df: DataFrame, weights: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, version, n_tokens, posterior) of every row; tokens are the words of the whole text."""
    source = df.select(
        F.col(key).alias("doc"), F.xxhash64(text_or_empty(text)).alias("version"), text_or_empty(text).alias("text")
    )
    kind = source.schema["doc"].dataType.simpleString()
    shared = df.sparkSession.sparkContext.broadcast(weights)
    return source.mapInArrow(
        lambda batches: _posterior_batches(batches, shared.value),
        f"doc {kind}, version long, n_tokens long, posterior array<double>",
    )


def _stepped(totals: np.ndarray, steps: list[tuple[list[float], float]], high: float) -> tuple[np.ndarray, np.ndarray]:
    """Rates, and the points ahead of them, of documents after ``steps``.

    ``totals`` has a row per domain. A document without totals (NaN) gets rate 0.
    """
    rate = ahead = np.ones(totals.shape[1])
    for pull, speed in steps:
        move = sum(x * p for x, p in zip(totals, pull))
        last, rate = rate, np.fmin(high, np.fmax(0.0, ahead - move))
        ahead = rate + speed * (rate - last)
    return rate, ahead


def _totals(batch: pa.RecordBatch, n_domains: int) -> np.ndarray:
    """The last ``n_domains`` columns, nulls as NaN."""
    columns = batch.columns[batch.num_columns - n_domains :]
    return np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in columns])


def _reached_batches(
    batches: Iterator[pa.RecordBatch], n_domains: int, steps: list[tuple[list[float], float]], high: float
) -> Iterator[pa.RecordBatch]:
    """One row for all batches: domain totals at the rates and at the points ahead."""
    sums = np.zeros(2 * n_domains)
    for batch in batches:
        totals = _totals(batch, n_domains)
        sums += np.concatenate([np.nansum(totals * x, axis=1) for x in _stepped(totals, steps, high)])
    names = [f"{x}{i}" for x in "ra" for i in range(n_domains)]
    yield pa.RecordBatch.from_arrays([pa.array([x]) for x in sums], names)


def _rated_batches(
    batches: Iterator[pa.RecordBatch], n_domains: int, steps: list[tuple[list[float], float]], high: float
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rate, _ = _stepped(_totals(batch, n_domains), steps, high)
        n = batch.num_columns - n_domains
        yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(rate)], [*batch.schema.names[:n], "rate"])


def fit_rates(
    members: DataFrame,
    targets: Sequence[float],
    most_rounds: int = MOST_ROUNDS,
    tolerance: float = 1e-3,
    most_rate: float | None = None,
) -> tuple[DataFrame, list[float], list[float]]:
    """``members`` with a ``rate``, the domain totals reached, and the targets as totals.

    ``targets`` are shares of all tokens. Minimizes the squared distance between the
    expected totals ``sum(rate * n_tokens * posterior)`` and the targets, each domain
    scaled by the inverse of the documents' Gram matrix, over rates from 0 to
    ``most_rate`` (None: no upper bound), starting from rate 1, by projected gradient
    steps with momentum. Every round is one pass over the stored documents; a document's
    rate follows from the residuals of the rounds before, which are a few numbers each,
    and is computed for a whole batch at once. Stops once no domain misses its target by more than ``tolerance`` of
    all tokens, or after ``most_rounds``; a miss, which also comes of targets that no
    rates meet, is told by a warning with both totals.
    """
    k = len(targets)
    a = [F.col("n_tokens") * F.get(F.col("posterior"), F.lit(i)) for i in range(k)]
    sums = members.agg(
        *[F.sum(a[i]).alias(f"t{i}") for i in range(k)],
        *[F.sum(a[i] * a[j]).alias(f"g{i}_{j}") for i in range(k) for j in range(i, k)],
    ).first()
    total = np.array([sums[f"t{i}"] or 0.0 for i in range(k)])
    gram = np.array([[sums[f"g{min(i, j)}_{max(i, j)}"] or 0.0 for j in range(k)] for i in range(k)])
    aim = np.array(targets, float) / sum(targets) * total.sum()
    if not total.sum():
        return members.withColumn("rate", F.lit(1.0)), total.tolist(), aim.tolist()
    inverse = np.linalg.pinv(gram + 1e-9 * np.trace(gram) / k * np.eye(k))
    high = float(most_rate if most_rate is not None else "inf")
    parts = [x.cast("double").alias(f"_total{i}") for i, x in enumerate(a)]

    reached, ahead, steps = total, total, []
    for n in range(most_rounds):
        if np.abs(reached - aim).max() <= tolerance * total.sum():
            break
        steps.append(([float(x) for x in inverse @ (ahead - aim)], n / (n + 3)))
        work = partial(_reached_batches, n_domains=k, steps=list(steps), high=high)
        sums = members.select(*parts).mapInArrow(work, ", ".join(f"{x}{i} double" for x in "ra" for i in range(k)))
        found = sums.agg(*[F.sum(c).alias(c) for c in sums.columns]).first()
        reached = np.array([found[f"r{i}"] for i in range(k)])
        ahead = np.array([found[f"a{i}"] for i in range(k)])
    if np.abs(reached - aim).max() > tolerance * total.sum():
        missed = f"reached {np.round(reached).tolist()}, wanted {np.round(aim).tolist()}"
        warnings.warn(f"the domains' token totals miss their targets: {missed}", stacklevel=2)
    others = members.drop("rate")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in others.schema)
    work = partial(_rated_batches, n_domains=k, steps=steps, high=high)
    rated = members.select(*others.columns, *parts).mapInArrow(work, f"{schema}, rate double")
    return rated, reached.tolist(), aim.tolist()


def copies(rate: Column, *key: str) -> Column:
    """How often to take a document: its rate, rounded up or down by a hash of the key."""
    draw = F.pmod(F.xxhash64(*key, F.lit("copies")), F.lit(1 << 30)) / float(1 << 30)
    whole = F.floor(rate)
    return (whole + (draw < rate - whole).cast("int")).cast("int")


def mix(
    df: DataFrame,
    labels: DataFrame,
    targets: Sequence[float] | None = None,
    key: str = "doc_id",
    text: str = "text",
    most_rate: float | None = None,
    most_rounds: int = MOST_ROUNDS,
) -> DataFrame:
    """(doc, version, n_tokens, posterior, rate, n_copies), one row for each row of ``df``.

    Without ``targets``, the better domains gain: half of the way from the natural
    shares to all tokens in the domains of good quality that are not toxic, as the
    posteriors see them. A null or empty text has no tokens, its posterior is the
    classifier's bias, its rate stays 1. Repeated rows get the same rate. With no
    labels the posterior is uniform and any target is out of reach, so that rates move
    together at most. Rates have no upper bound unless ``most_rate`` names one; totals that
    miss their targets raise a warning.
    """
    weights = fit_classifier(*labelled_texts(df, labels, key=key, text=text), DOMAINS)
    members = stored(posteriors(df, weights, key, text))
    if targets is None:
        totals = members.agg(
            *[F.sum(F.col("n_tokens") * F.get("posterior", F.lit(i))).alias(f"t{i}") for i in range(DOMAINS)]
        ).first()
        natural = np.array([totals[i] or 0.0 for i in range(DOMAINS)])
        natural = natural / natural.sum() if natural.sum() else np.full(DOMAINS, 1 / DOMAINS)
        targets = [0.5 * x + (0.5 if i == GOOD else 0.0) for i, x in enumerate(natural)]
    rated, _, _ = fit_rates(members, targets, most_rounds, most_rate=most_rate)
    return rated.withColumn("n_copies", copies(F.col("rate"), "doc", "version"))


#: Good quality, not toxic.
GOOD = 2


def mixed_documents(df: DataFrame, labels: DataFrame, targets: Sequence[float] | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df``, all columns untouched, each as often as its rate says."""
    rates = mix(df, labels, targets, key, text).select(
        F.col("doc").alias("_doc"), F.col("version").alias("_version"), "n_copies"
    ).dropDuplicates(["_doc", "_version"])
    named = df.select(
        F.struct(*df.columns).alias("_row"), F.col(key).alias("_key"), F.xxhash64(text_or_empty(text)).alias("_text")
    )
    met = named.join(rates, F.col("_key").eqNullSafe(F.col("_doc")) & (F.col("_text") == F.col("_version")))
    often = met.filter("n_copies > 0").select(F.explode(F.sequence(F.lit(1), F.col("n_copies"))).alias("_n"), "_row")
    return often.select("_row.*")
