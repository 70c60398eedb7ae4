"""Best-fit packing of documents into sequences by the sum-of-squares rule.

Documents become token ids and are cut into pieces no longer than a sequence. A piece
goes into the open sequence for which the sum, over all residual gaps, of the squared
number of open sequences with that gap gets smallest; a new sequence competes as well.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelyard.llm import textarrays as ta
from parcelyard.llm.bytepair import kept_encoder
from parcelyard.llm.storage import stored, text_or_empty

SEQUENCE = 1024
#: The id that ends every document.
END_ID = 2
#: Pieces that are packed together, in one task.
GROUP = 1 << 16
_NUMBER = "_piece_number"


class OpenSequences:
    """Open sequences by residual gap, and the rule that places a length."""

    def __init__(self, size: int = SEQUENCE):
        self.size = size
        self.count = np.zeros(size + 1, np.int64)
        self.stacks: list[list[int]] = [[] for _ in range(size + 1)]
        self.made = 0

    def place(self, length: int) -> tuple[int, int]:
        """Sequence and offset for a piece of ``length``; ties go to the smallest gap left."""
        size, count = self.size, self.count
        gaps = np.flatnonzero(count[length:size]) + length
        rest = gaps - length
        change = np.where(rest > 0, 2 * count[rest] + 1, 0) - (2 * count[gaps] - 1)
        best = int(np.argmin(change)) if len(gaps) else -1
        if best >= 0 and change[best] <= (2 * count[size - length] + 1 if length < size else 0):
            gap = int(gaps[best])
            sequence = self.stacks[gap].pop()
            count[gap] -= 1
        else:
            gap, sequence = size, self.made
            self.made += 1
        if gap > length:
            self.stacks[gap - length].append(sequence)
            count[gap - length] += 1
        return sequence, size - gap


def _piece_batches(
    batches: Iterator[pa.RecordBatch], model_json: str, size: int, end_id: int
) -> Iterator[pa.RecordBatch]:
    encoder = kept_encoder(model_json)
    for batch in batches:
        texts = batch.column("text")
        rest = batch.drop_columns(["text"])
        _, offsets = ta.text_bytes(texts)
        for a, b in ta.pieces(offsets, ta.PIECE_BYTES // 2):
            ids, counts = encoder.encode(texts.slice(a, b - a).to_pylist())
            ids = np.insert(ids, np.cumsum(counts), end_id).astype("<u4")
            counts = counts + 1
            n = -(-counts // size)
            doc = np.repeat(np.arange(b - a), n)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
            lead = counts - (n - 1) * size
            start = np.where(piece > 0, lead[doc] + (piece - 1) * size, 0)
            length = np.where(piece > 0, size, lead[doc])
            ends = np.concatenate([[0], np.cumsum(4 * length)]).astype(np.int32)
            data = pa.Array.from_buffers(
                pa.binary(), len(length), [None, pa.py_buffer(ends), pa.py_buffer(ids.tobytes())]
            )
            yield pa.RecordBatch.from_arrays(
                [*rest.slice(a, b - a).take(pa.array(doc)).columns,
                 pa.array(piece, pa.int32()), pa.array(start), pa.array(length), data],
                [*rest.schema.names, "piece", "start", "length", "ids"],
            )


def cut_pieces(
    df: DataFrame, model_path: str, size: int = SEQUENCE, end_id: int = END_ID, text: str = "text"
) -> DataFrame:
    """One row for each piece of each row of ``df``: its other columns, piece, start, length, ids.

    ``model_path`` is a ``tokenizers`` file, read by the driver. A text's ids end with
    ``end_id``; a null or empty text is that id alone. Longer texts are cut into pieces
    of ``size`` ids, of which the first may be shorter. ``ids`` holds little-endian
    unsigned 32-bit numbers. Columns of ``df`` named like a result give way.
    """
    with open(model_path, encoding="utf-8") as file:
        model = df.sparkSession.sparkContext.broadcast(file.read())
    others = [c for c in df.columns if c not in (text, "piece", "start", "length", "ids")]
    source = df.select(*others, text_or_empty(text).alias("text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema if f.name in others)
    return source.mapInArrow(
        lambda batches: _piece_batches(batches, model.value, size, end_id),
        f"{schema}{', ' if schema else ''}piece int, start long, length long, ids binary",
    )


def _placed_batches(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """(number, length) to the number, sequence and offset of every piece."""
    opened = OpenSequences(size)
    base = TaskContext.get().partitionId() << 40
    for batch in batches:
        placed = [opened.place(n) for n in batch.column("length").to_pylist()]
        sequence = np.array([s for s, _ in placed], np.int64) + base
        offset = np.array([o for _, o in placed], np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(_NUMBER), pa.array(sequence), pa.array(offset)],
            [_NUMBER, "sequence_id", "offset"],
        )


def place_pieces(pieces: DataFrame, size: int = SEQUENCE, group: int = GROUP) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; lengths are from 1 to ``size``.

    Pieces are dealt evenly to groups of about ``group``. Within one, those longer than
    half a sequence come first, longest first, and the others in the order of a hash,
    which leaves the least room unused; a group is packed as a stream that holds its open
    sequences only. Each group may leave some sequences unfilled, which is little against
    all it fills. The pieces are numbered and written to the shared folder first, so that a
    retried task sees the same rows. Groups get numbers and lengths only; a place finds its
    piece by the number, so no task holds the ids of a whole group.
    """
    columns = [c for c in pieces.columns if c not in ("sequence_id", "offset", _NUMBER)]
    fixed = stored(pieces.select(*columns, F.monotonically_increasing_id().alias(_NUMBER)))
    groups = max(1, -(-fixed.count() // group))
    halves = F.greatest(F.col("length"), F.lit(size // 2))
    placed = (
        fixed.select(_NUMBER, "length", F.xxhash64(*columns).alias("_hash"))
        .repartition(groups)
        .sortWithinPartitions(F.desc(halves), "_hash", _NUMBER)
        .select(_NUMBER, "length")
        .mapInArrow(partial(_placed_batches, size=size), f"{_NUMBER} long, sequence_id long, offset long")
    )
    return fixed.join(placed, _NUMBER).select(*columns, "sequence_id", "offset")
