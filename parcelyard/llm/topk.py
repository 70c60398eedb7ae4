"""Exact top-k inner products over norm-sorted vectors.

Vectors lie in blocks of falling length. In a basis from the singular vectors of the
whole table the leading coordinates carry most of a product; the rest is bounded by
the lengths of the residuals (Cauchy-Schwarz). A block is visited only by queries
that its longest vector could still serve, and within it a product is completed only
where partial sum and bound reach the query's k-th best so far.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelyard.llm.storage import stored

SCALE = 256
#: Vectors in a block and queries in a chunk: what one task holds at a time.
BLOCK, CHUNK = 8192, 1024
#: Bands of falling norm; a band of more than one block is dealt to several.
MOST_BANDS = 512
#: The longest vectors, which every query meets first; their number is fixed.
HEAD = 2048


def quantized(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component as a long; null if any component is unusable."""
    usable = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    )
    return F.when(usable, F.transform(vector, lambda x: F.floor(scale * x.cast("double"))))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _gram_batches(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    gram = np.zeros((width, width))
    for batch in batches:
        v = _matrix(batch.column("vector"), width).astype(np.float64)
        gram += v.T @ v
    cell = np.arange(width * width)
    yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(gram.ravel())], ["cell", "value"])


def rotation(vectors: DataFrame, width: int) -> np.ndarray:
    """Right singular vectors of the table, strongest first, from summed Gram matrices."""
    parts = vectors.select("vector").mapInArrow(partial(_gram_batches, width=width), "cell long, value double")
    gram = np.zeros(width * width)
    for row in parts.groupBy("cell").agg(F.sum("value").alias("value")).collect():
        gram[row["cell"]] = row["value"]
    _, basis = np.linalg.eigh(gram.reshape(width, width))
    return np.ascontiguousarray(basis[:, ::-1])


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to the smaller id."""
    return np.lexsort((ids, -score))[:k]


def _searched(
    queries: pa.Table, vectors: pa.Table, basis: np.ndarray, k: int, lead: int
) -> pa.RecordBatch:
    width = len(basis)
    q, v = _matrix(queries.column("vector"), width), _matrix(vectors.column("vector"), width)
    qid, vid = queries.column("id").to_numpy(), vectors.column("id").to_numpy()
    least = queries.column("least").to_numpy(zero_copy_only=False)
    qr, vr = q.astype(np.float64) @ basis, v.astype(np.float64) @ basis
    q_rest = np.linalg.norm(qr[:, lead:], axis=1)
    v_rest = np.linalg.norm(vr[:, lead:], axis=1)
    partial_sum = qr[:, :lead] @ vr[:, :lead].T
    room = 1e-6 + 1e-9 * np.linalg.norm(qr, axis=1) * np.linalg.norm(vr, axis=1).max()
    out_q, out_v, out_s = [], [], []
    for i in range(len(q)):
        may = np.flatnonzero(partial_sum[i] + q_rest[i] * v_rest + room[i] >= least[i])
        may = may[vid[may] != qid[i]]
        score = v[may] @ q[i]
        best = _best(score, vid[may], k)
        out_q += [np.full(len(best), qid[i])]
        out_v += [vid[may][best]]
        out_s += [score[best]]
    names = ["query_id", "vec_id", "score"]
    empty = [np.zeros(0, np.int64)]
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x or empty)) for x in (out_q, out_v, out_s)], names)


def _group(key, queries: pa.Table, vectors: pa.Table, basis, k: int, lead: int) -> pa.Table:
    names = ["query_id", "vec_id", "score"]
    if not queries.num_rows or not vectors.num_rows:
        return pa.table({n: pa.array([], pa.int64()) for n in names})
    return pa.Table.from_batches([_searched(queries, vectors, basis, k, lead)])


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


SCHEMA = "query_id long, vec_id long, score long"


def top_products(
    df: DataFrame,
    is_query: Column,
    k: int = 5,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: int = SCALE,
    block: int = BLOCK,
    chunk: int = CHUNK,
    head: int = HEAD,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` highest integer products of each query.

    Candidates are all rows but those with the query's own key; ties go to the smaller
    key, and a query with fewer candidates gets what there is. Rows with a null key or
    vector, or a null or non-finite component, take no part, nor do vectors of another
    width than the most frequent one. Of rows that share key and vector, one counts. Of
    equal vectors, the ``k + 1`` smallest keys compete, which can lose no result. Scores
    must fit 64 bits.
    """
    usable = df.select(F.col(key).cast("long").alias("id"), quantized(F.col(vector), scale).alias("vector"), is_query.alias("asks"))
    usable = usable.filter("id IS NOT NULL AND vector IS NOT NULL AND size(vector) > 0").distinct()
    usable = stored(usable.withColumn("width", F.size("vector")))
    widths = usable.groupBy("width").count().orderBy(F.desc("count"), "width").first()
    if widths is None:
        return usable.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    width = widths["width"]
    usable = usable.filter(F.col("width") == width)
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    competing = (
        usable.withColumn("twin", F.row_number().over(Window.partitionBy("vector").orderBy("id")))
        .filter(F.col("twin") <= k + 1)
        .select("id", "vector", norm.alias("norm"))
    )
    competing = stored(competing)
    n = competing.count()
    basis = rotation(competing, width)
    lead = max(1, width // 4)
    shared = df.sparkSession.sparkContext.broadcast(basis)
    first = competing.orderBy(F.desc("norm"), "id").limit(head).select("id", "vector").toArrow()

    queries = usable.filter(F.coalesce("asks", F.lit(False))).select("id", "vector", norm.alias("norm"))
    def meet_longest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, chunk):
                part = pa.Table.from_batches([batch.slice(a, chunk)])
                part = part.append_column("least", pa.array(np.full(part.num_rows, -np.inf)))
                yield _searched(part, first, shared.value, k, lead)

    leading = stored(queries.mapInArrow(meet_longest, SCHEMA))
    if n <= head:
        found = leading
    else:
        reached = leading.groupBy("query_id").agg(F.min("score").alias("worst"), F.count(F.lit(1)).alias("n"))
        least = F.when(F.col("n") >= k, F.col("worst").cast("double")).otherwise(F.lit(float("-inf")))
        bounded = queries.join(
            reached.select(F.col("query_id").alias("id"), least.alias("least")), "id", "left"
        ).withColumn("least", F.coalesce("least", F.lit(float("-inf"))))
        bands = min(-(-n // block), MOST_BANDS)
        cuts = competing.agg(
            F.percentile_approx("norm", [i / bands for i in range(1, bands)] or [1.0], F.lit(10 * bands))
        ).first()[0]
        edges = F.array(*[F.lit(float(c)) for c in sorted(set(cuts))])
        banded = competing.withColumn("band", F.size(F.filter(edges, lambda c: c < F.col("norm"))))
        sizes = banded.groupBy("band").agg(F.max("norm"), F.ceil(F.count(F.lit(1)) / block)).collect()
        longest = F.create_map(*[F.lit(x) for b, norm, _ in sizes for x in (b, float(norm))])
        parts = F.create_map(*[F.lit(x) for b, _, p in sizes for x in (b, int(p))])
        served = F.filter(
            F.map_keys(longest),
            lambda b: F.col("norm") * F.element_at(longest, b) * (1 + 1e-9) + 1e-6 >= F.col("least"),
        )
        chunks = max(1, -(-queries.count() // chunk))
        dealt = lambda n: F.pmod(F.xxhash64("id"), n).cast("int")
        asking = (
            bounded.withColumn("chunk", dealt(F.lit(chunks)))
            .withColumn("band", F.explode(served))
            .withColumn("part", F.explode(F.sequence(F.lit(0), F.element_at(parts, F.col("band")) - 1)))
            .select("band", "part", "chunk", "id", "vector", "least")
        )
        offered = (
            banded.withColumn("part", dealt(F.element_at(parts, F.col("band"))))
            .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
            .select("band", "part", "chunk", "id", "vector")
        )
        names = ["band", "part", "chunk"]
        found = (
            asking.groupBy(*names)
            .cogroup(offered.groupBy(*names))
            .applyInArrow(lambda key, q, v: _group(key, q, v, shared.value, k, lead), SCHEMA)
        )
    return _top(found, k).select("query_id", "rank", "vec_id", "score")
