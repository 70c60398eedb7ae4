"""N-gram Jaccard join: documents whose five-word shingles overlap by 0.8 or more.

MinHash bands propose candidates. Within a block of candidates the MinHash values of
a pair are compared a few at a time, and a pair is dropped as soon as the posterior
probability that its similarity reaches the threshold falls below a tolerance. What
remains is verified on the shingle sets. Equal texts are compared once.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelyard.llm import textarrays as ta
from parcelyard.llm.components import components
from parcelyard.llm.narrowing import likely
from parcelyard.llm.storage import stored, text_or_empty

SHINGLE_WORDS = 5
SIMILARITY = 0.8
#: 24 bands of 4 values: a pair at the threshold misses all of them once in 300,000 times.
BANDS, ROWS = 24, 4
HASHES = BANDS * ROWS
STEP = 8
TOLERANCE = 1e-6
#: Members of one block; larger candidate groups are compared block by block.
BLOCK = 2048

_A = ta.mixed(np.arange(1, HASHES + 1, dtype=np.uint64)) | np.uint64(1)
_B = ta.mixed(np.arange(5001, HASHES + 5001, dtype=np.uint64))


def signatures(shingles: np.ndarray, first: np.ndarray) -> np.ndarray:
    """MinHash values, one row for each text; all ones where a text has no shingle."""
    out = np.empty((len(first) - 1, HASHES), np.uint32)
    for k in range(HASHES):
        values = ((shingles * _A[k] + _B[k]) >> np.uint64(32)).astype(np.uint32)
        out[:, k] = ta.segment_min(values, first, 0xFFFFFFFF)
    return out


def _band_keys(signature: np.ndarray) -> np.ndarray:
    grouped = signature.reshape(len(signature), BANDS, ROWS).astype(np.uint64)
    key = np.zeros(grouped.shape[:2], np.uint64) + np.arange(BANDS, dtype=np.uint64)
    for r in range(ROWS):
        key = ta.mixed(key * np.uint64(31) + grouped[:, :, r])
    return key.view(np.int64)


def _signed_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, version, text) to (doc, version, node, bands); texts without words have no bands."""
    for batch in batches:
        data, offsets = ta.text_bytes(batch.column("text"))
        for a, b in ta.pieces(offsets):
            found = ta.words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            runs, first = ta.windows(found, SHINGLE_WORDS)
            keys = _band_keys(signatures(runs, first))
            counts = np.where(np.diff(first) > 0, BANDS, 0)
            ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            bands = pa.ListArray.from_arrays(ends, keys[counts > 0].ravel())
            node = ta.sequence_hash(found, 1).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc").slice(a, b - a), batch.column("version").slice(a, b - a),
                 pa.array(node), bands],
                ["doc", "version", "node", "bands"],
            )


def _set_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, ..., text) to the same with the text's distinct shingles and MinHash values."""
    for batch in batches:
        data, offsets = ta.text_bytes(batch.column("text"))
        rest = batch.drop_columns(["text"])
        for a, b in ta.pieces(offsets):
            found = ta.words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            runs, first = ta.windows(found, SHINGLE_WORDS)
            signature = signatures(runs, first)
            sets = [np.unique(runs[first[i] : first[i + 1]]).tobytes() for i in range(b - a)]
            signed = [row.tobytes() for row in signature]
            yield pa.RecordBatch.from_arrays(
                [*rest.slice(a, b - a).columns, pa.array(sets, pa.binary()), pa.array(signed, pa.binary())],
                [*rest.schema.names, "set", "signature"],
            )


def least_matches(similarity: float = SIMILARITY, tolerance: float = TOLERANCE) -> list[int]:
    """For 0, STEP, 2 STEP, ... values compared: the matches below which a pair is dropped.

    With a uniform prior, m matches of n give the posterior Beta(m + 1, n - m + 1), whose
    mass at the threshold or above is the chance of at most m successes in n + 1 trials.
    """
    least = []
    for n in range(0, HASHES + 1, STEP):
        chance, m = 0.0, 0
        while True:
            chance += comb(n + 1, m) * similarity**m * (1 - similarity) ** (n + 1 - m)
            if chance >= tolerance:
                break
            m += 1
        least.append(m)
    return least


def surviving_pairs(
    x: np.ndarray, y: np.ndarray, same: bool, least: list[int]
) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (into x, into y) that no step of MinHash values rules out."""
    matches = np.zeros((len(x), len(y)), np.uint8)
    for k in range(STEP):
        matches += x[:, k][:, None] == y[:, k][None, :]
    left, right = np.nonzero(matches >= max(least[1], 1 if least[2] else 0))
    if same:
        ordered = left < right
        left, right = left[ordered], right[ordered]
    count = matches[left, right].astype(np.int16)
    for step in range(1, HASHES // STEP):
        for k in range(step * STEP, (step + 1) * STEP):
            count += x[left, k] == y[right, k]
        alive = count >= least[step + 1]
        left, right, count = left[alive], right[alive], count[alive]
    return left, right


def verified_pairs(
    left: np.ndarray, right: np.ndarray, xs: list[np.ndarray], ys: list[np.ndarray], similarity: float
) -> tuple[np.ndarray, np.ndarray]:
    """The pairs whose sorted shingle sets have the given Jaccard similarity or more."""
    if not len(left):
        return left, right
    _, ids = np.unique(np.concatenate([*xs, *ys]), return_inverse=True)
    sizes = np.array([len(s) for s in (*xs, *ys)])
    begins = np.cumsum(sizes) - sizes
    flag = np.zeros(int(ids.max()) + 1, bool)
    good = np.zeros(len(left), bool)
    order = np.argsort(left, kind="stable")
    firsts = np.flatnonzero(np.diff(left[order], prepend=-1))
    for at, to in zip(firsts, [*firsts[1:], len(order)]):
        pairs = order[at:to]
        p = left[pairs[0]]
        own = ids[begins[p] : begins[p] + sizes[p]]
        flag[own] = True
        other = right[pairs] + len(xs)
        n = sizes[other]
        ends = np.cumsum(n)
        where = np.arange(ends[-1]) - np.repeat(ends - n, n) + np.repeat(begins[other], n)
        shared = np.add.reduceat(flag[ids[where]].astype(np.int64), ends - n)
        good[pairs] = shared >= similarity * (n + sizes[p] - shared) - 1e-9
        flag[own] = False
    return left[good], right[good]


def _heads(n: int, left: np.ndarray, right: np.ndarray, names: np.ndarray) -> np.ndarray:
    """The least name among the members that links connect, for each of n members."""
    head = names.copy()
    while True:
        least = np.minimum(head[left], head[right])
        before = head.copy()
        np.minimum.at(head, left, least)
        np.minimum.at(head, right, least)
        if np.array_equal(before, head):
            return head


def _linked_batches(
    batches: Iterator[pa.RecordBatch], similarity: float, tolerance: float
) -> Iterator[pa.RecordBatch]:
    """Members of blocks, sorted by block, to (node, links, head) for each linked member."""
    least = least_matches(similarity, tolerance)

    def linked(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        block = pa.Table.from_batches(rows)
        node = block.column("node").to_numpy()
        side = block.column("side").to_numpy()
        signature = np.frombuffer(b"".join(block.column("signature").to_pylist()), np.uint32)
        signature = signature.reshape(-1, HASHES)
        sets = [np.frombuffer(s, np.uint64) for s in block.column("set").to_pylist()]
        ix, iy = np.flatnonzero(side <= 0), np.flatnonzero(side == 1)
        if same := side[0] == -1:
            iy = ix
        left, right = surviving_pairs(signature[ix], signature[iy], same, least)
        xs, ys = [sets[i] for i in ix], [sets[i] for i in iy]
        left, right = verified_pairs(left, right, xs, ys, similarity)
        left, right = ix[left], iy[right]
        links = np.bincount(left, minlength=len(node)) + np.bincount(right, minlength=len(node))
        head = _heads(len(node), left, right, node)
        some = links > 0
        return pa.RecordBatch.from_arrays(
            [pa.array(node[some]), pa.array(links[some]), pa.array(head[some])], ["node", "links", "head"]
        )

    held: list[pa.RecordBatch] = []
    at = None
    for batch in batches:
        names = np.stack([batch.column(c).to_numpy() for c in ("cluster", "i", "j")])
        cuts = [0, *(np.flatnonzero(np.any(names[:, 1:] != names[:, :-1], axis=0)) + 1), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if held and at != tuple(names[:, a]):
                yield linked(held)
                held = []
            at = tuple(names[:, a])
            held.append(batch.slice(a, b - a))
    if held:
        yield linked(held)


def candidate_clusters(signed: DataFrame) -> DataFrame:
    """(node, component): texts joined through shared bands, least member of a bucket to all."""
    texts = signed.groupBy("node").agg(F.first("bands").alias("bands"))
    keyed = stored(texts.select("node", F.explode("bands").alias("band")))
    least = (
        keyed.groupBy("band")
        .agg(F.min("node").alias("least"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
    )
    stars = keyed.join(least, "band").filter("node <> least").select("node", "least")
    return components(stars, "node", "least")


def _blocks(members: DataFrame, block: int) -> DataFrame:
    """Each member once for every pair of blocks it belongs to.

    A cluster of more than ``block`` members is dealt to blocks by hash, and every two
    blocks meet once. ``side`` is -1 where a block meets itself, else 0 or 1.
    """
    sizes = members.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("parts"))
    own = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    met = members.join(sizes, "cluster").withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    )
    side = F.when(F.col("own") == F.col("other"), -1).when(F.col("own") < F.col("other"), 0).otherwise(1)
    return met.select(
        "cluster", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        side.alias("side"), "node", "doc", "version",
    )


def _version(text: str) -> Column:
    return F.xxhash64(text_or_empty(text))


def similar_documents(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    similarity: float = SIMILARITY,
    tolerance: float = TOLERANCE,
    block: int = BLOCK,
) -> DataFrame:
    """(doc, version, node, owner, class_id, n_links, n_copies), one row for each row of ``df``.

    ``version`` is the hash of the text, ``node`` that of its word sequence. Texts of
    equal word sequence are copies of each other (``n_copies`` rows, itself included)
    and compared as one; ``n_links`` counts the other, different texts of the given
    similarity. Documents connected by links have the same ``owner``, the least node
    among them, and ``class_id``, the least key. Null and empty texts are copies of each other without links; a text of
    fewer than five words is one shingle. Null keys never name a class unless all are
    null. Repeated rows count as copies. Node and shingle hashes have 64 bits.
    """
    source = df.select(F.col(key).alias("doc"), _version(text).alias("version"), text_or_empty(text).alias("text"))
    kind = source.schema["doc"].dataType.simpleString()
    signed = stored(
        source.mapInArrow(_signed_batches, f"doc {kind}, version long, node long, bands array<long>")
    )
    clusters = stored(candidate_clusters(signed))
    members = (
        signed.join(clusters, "node")
        .groupBy("node", F.col("component").alias("cluster"))
        .agg(F.min(F.struct("doc", "version")).alias("one"))
        .select("node", "cluster", "one.*")
    )
    blocks = stored(_blocks(members, block))
    wanted = blocks.select("node", "doc", "version").distinct()
    texts = likely(source, wanted, "version")
    texts = texts.join(
        wanted.withColumnsRenamed({"doc": "_doc", "version": "_version"}),
        F.col("doc").eqNullSafe(F.col("_doc")) & (F.col("version") == F.col("_version")),
    )
    one_each = texts.select("node", "text").dropDuplicates(["node"])
    sets = one_each.mapInArrow(_set_batches, "node long, set binary, signature binary")
    dealt = (
        blocks.select("cluster", "i", "j", "side", "node")
        .join(sets, "node")
        .repartition("cluster", "i", "j")
        .sortWithinPartitions("cluster", "i", "j")
    )
    linked = stored(
        dealt.mapInArrow(
            partial(_linked_batches, similarity=similarity, tolerance=tolerance),
            "node long, links long, head long",
        )
    )
    owners = components(linked, "node", "head").withColumnsRenamed({"component": "owner"})
    links = linked.groupBy("node").agg(F.sum("links").alias("n_links"))
    found = links.join(owners, "node", "left").select("node", "n_links", F.coalesce("owner", "node").alias("owner"))
    copies = signed.groupBy("node").agg(F.min("doc").alias("least"), F.count(F.lit(1)).alias("n_copies"))
    named = stored(
        copies.join(found, "node", "left").withColumns(
            {"owner": F.coalesce("owner", "node"), "n_links": F.coalesce("n_links", F.lit(0))}
        )
    )
    classes = named.groupBy("owner").agg(F.min("least").alias("class_id"))
    return (
        signed.select("doc", "version", "node")
        .join(named.join(classes, "owner"), "node")
        .select("doc", "version", "node", "owner", "class_id", "n_links", "n_copies")
    )


def one_per_class(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df``, all columns untouched, that are the first of their class by key.

    Of rows with the same key, the one with the least text hash stays; of rows that
    also share the text, one. Rows without a key come last.
    """
    found = similar_documents(df, key, text)
    order = F.struct(F.isnull("doc").alias("unnamed"), "doc", "version")
    firsts = found.groupBy("owner").agg(F.min(order).alias("one"))
    firsts = firsts.select(F.col("one.doc").alias("_doc"), F.col("one.version").alias("_version"))
    named = df.select(F.struct(*df.columns).alias("_row"), F.col(key).alias("_key"), _version(text).alias("_text"))
    kept = named.join(
        firsts, F.col("_key").eqNullSafe(F.col("_doc")) & (F.col("_text") == F.col("_version"))
    )
    return kept.dropDuplicates(["_key", "_text"]).select("_row.*")
