"""Removal of long repeated byte strings by column-wise suffix construction.

A string of ``LENGTH`` bytes has a rarest-looking anchor inside it: the k-gram with the
least hash, the leftmost of equal ones. Equal strings have equal anchors at the same
place, so only texts that share an anchor need to be compared, and they are aligned by
it. Each anchor's windows are then treated as a collection of short documents of which
every round takes one more column: the order of all suffixes that start in the column
follows from the order of those one column on by a stable sort of the new symbols (the
column of the collection's Burrows-Wheeler transform, read by position), and the common
prefix with the predecessor is the least of the prefixes passed over, plus one. Columns
are spooled to a sequential file, which is read backwards column by column.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelyard.llm import textarrays as ta
from parcelyard.llm.narrowing import likely, narrowed, parted
from parcelyard.llm.storage import carried, stored, text_or_empty

LENGTH = 400
ANCHOR = 64
#: Windows of one anchor that are compared as a collection; the strings of anchors with
#: more are counted by hash instead, so that no task has to hold them together.
MOST_WINDOWS = 1 << 15
#: Bytes of windows that are held as one collection.
SPOOL_BYTES = 1 << 23

_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)


def rolling(data: np.ndarray, size: int) -> np.ndarray:
    """64-bit hashes of all ``size``-byte strings of ``data``, by doubling."""
    n = len(data) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    part, width, at = ta._BYTE[data], 1, 0
    while True:
        if size & width:
            out = ta.mixed(out * _STEP + part[at : at + n])
            at += width
        width *= 2
        if width > size:
            return out
        half = width // 2
        part = ta.mixed(part[:-half] * _U(0xD6E8FEB86659FD93) + part[half:])


def _least_in_windows(values: np.ndarray, size: int) -> np.ndarray:
    """The least of every ``size`` neighbours, from running minima of blocks."""
    n = len(values) - size + 1
    pad = -len(values) % size
    padded = np.concatenate([values, np.full(pad, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, size)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[size - 1 : size - 1 + n])


def anchors(data: np.ndarray, length: int = LENGTH, size: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """Anchor hash, its place, and first and last start of the strings that have it.

    Together the runs cover all starts of ``length``-byte strings of ``data``. Places
    take the low bits of the compared values, so that the leftmost of equal hashes wins.
    """
    if len(data) < length:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, none
    found = rolling(data, size)
    bits = _U(max(1, int(len(found) - 1).bit_length()))
    ranked = (found >> bits << bits) | np.arange(len(found), dtype=np.uint64)
    least = _least_in_windows(ranked, length - size + 1)
    place = (least & ((_U(1) << bits) - _U(1))).astype(np.int64)
    opens = np.flatnonzero(np.diff(place, prepend=-1))
    closes = np.concatenate([opens[1:], [len(place)]]) - 1
    return found[place[opens]], place[opens], opens, closes


def _anchor_batches(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """(doc, version, text) to one row for each anchor: doc, version, anchor, at, low, high."""
    for batch in batches:
        data, offsets = ta.text_bytes(batch.column("text"))
        rows, parts = [], []
        for i in range(batch.num_rows):
            found = anchors(data[offsets[i] : offsets[i + 1]], length)
            if len(found[0]):
                rows.append(np.full(len(found[0]), i))
                parts.append(found)
        if not rows:
            continue
        row = pa.array(np.concatenate(rows))
        anchor, at, low, high = (np.concatenate(x) for x in zip(*parts))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc").take(row), batch.column("version").take(row), pa.array(anchor.view(np.int64)),
             pa.array(at.astype(np.int32)), pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32))],
            ["doc", "version", "anchor", "at", "low", "high"],
        )


def _window_batches(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """(doc, version, text, repeats) to the window of each repeated anchor as a row."""
    kind = pa.list_(pa.struct([("anchor", pa.int64()), ("at", pa.int32()), ("low", pa.int32()), ("high", pa.int32())]))
    for batch in batches:
        data, offsets = ta.text_bytes(batch.column("text"))
        repeats = batch.column("repeats").cast(kind)
        row = np.repeat(np.arange(batch.num_rows), np.diff(repeats.offsets.to_numpy()))
        fields = repeats.flatten()
        low, high = fields.field("low").to_numpy(), fields.field("high").to_numpy()
        begin = offsets[row] + low
        size = high - low + length
        for a in range(0, len(row), 4096):
            b = min(a + 4096, len(row))
            windows = [data[s : s + n].tobytes() for s, n in zip(begin[a:b], size[a:b])]
            pick = pa.array(row[a:b])
            yield pa.RecordBatch.from_arrays(
                [batch.column("version").take(pick),
                 fields.field("anchor").slice(a, b - a), fields.field("at").slice(a, b - a),
                 fields.field("low").slice(a, b - a), pa.array(windows, pa.binary())],
                ["version", "anchor", "at", "low", "window"],
            )


def repeated_columns(
    symbols: np.ndarray, groups: np.ndarray, length: int
) -> Iterator[tuple[int, np.ndarray]]:
    """(column, windows whose ``length`` bytes from it are also another window's there).

    ``symbols`` has one row for each column, last column first; windows are sorted by
    group. A window ends where its bytes end: from there on its symbol is 0 and bytes
    count from 1, and it has no common prefix with any other.
    """
    columns, n = symbols.shape
    order = np.arange(n)
    common = np.zeros(n + 1, np.int32)
    group = groups.astype(np.uint16 if groups[-1] < 1 << 16 else np.int64)
    for back in range(columns):
        column = columns - 1 - back
        symbol = symbols[back]
        new = np.argsort(symbol[order], kind="stable")
        new = new[np.argsort(group[order[new]], kind="stable")]
        ordered = order[new]
        value, owner = symbol[ordered], group[ordered]
        equal = np.zeros(n, bool)
        equal[1:] = (value[1:] == value[:-1]) & (owner[1:] == owner[:-1]) & (value[1:] != 0)
        prefix = np.zeros(n + 1, np.int32)
        where = np.flatnonzero(equal)
        if len(where):
            passed = np.stack([new[where - 1] + 1, new[where] + 1], axis=1).ravel()
            prefix[where] = np.minimum.reduceat(common, passed)[::2] + 1
        order, common = ordered, prefix
        long = common >= length
        both = long[:-1] | long[1:]  # with the window before or the one after
        if both.any():
            yield column, order[both]


def _collection(rows: list[pa.RecordBatch], length: int) -> pa.RecordBatch | None:
    """Runs of repeated starts (version, start, end) in the windows of some anchors."""
    table = pa.Table.from_batches(rows)
    windows = table.column("window").to_pylist()
    at, low = table.column("at").to_numpy(), table.column("low").to_numpy()
    sizes = np.array([len(w) for w in windows])
    lead = at - low
    shift = lead.max() - lead
    _, groups = np.unique(table.column("anchor").to_numpy(), return_inverse=True)
    by_group = np.argsort(groups, kind="stable")
    columns = int((shift + sizes).max())
    with tempfile.TemporaryFile() as spool:
        symbols = np.memmap(spool, np.uint16, "w+", shape=(columns, len(windows)))
        for k, i in enumerate(by_group):
            body = np.frombuffer(windows[i], np.uint8)[::-1]
            first = columns - shift[i] - sizes[i]
            symbols[first : first + sizes[i], k] = body
            symbols[first : first + sizes[i], k] += 1
        hits = list(repeated_columns(symbols, groups[by_group], length))
        del symbols
    if not hits:
        return None
    who = by_group[np.concatenate([w for _, w in hits])]
    column = np.concatenate([np.full(len(w), c) for c, w in hits])
    start = column - shift[who] + low[who]
    by_start = np.lexsort((start, who))
    who, start = who[by_start], start[by_start]
    opens = np.ones(len(who), bool)
    opens[1:] = (who[1:] != who[:-1]) | (start[1:] != start[:-1] + 1)
    ends = np.concatenate([np.flatnonzero(opens)[1:], [len(who)]]) - 1
    pick = pa.array(who[opens])
    return pa.RecordBatch.from_arrays(
        [table.column("version").combine_chunks().take(pick),
         pa.array(start[opens].astype(np.int32)), pa.array((start[ends] + length).astype(np.int32))],
        ["version", "start", "end"],
    )


def _run_batches(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Windows sorted by anchor to runs of repeated starts, some whole anchors at a time."""
    held: list[pa.RecordBatch] = []
    size, last = 0, None
    for batch in batches:
        anchor = batch.column("anchor").to_numpy()
        cuts = [0, *(np.flatnonzero(anchor[1:] != anchor[:-1]) + 1), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if anchor[a] != last and size > SPOOL_BYTES:
                if (found := _collection(held, length)) is not None:
                    yield found
                held, size = [], 0
            last = anchor[a]
            held.append(batch.slice(a, b - a))
            size += 2 * length * (b - a)
    if held and (found := _collection(held, length)) is not None:
        yield found


def _string_batches(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Windows of crowded anchors to (version, start, hash, check) of each of their strings."""
    for batch in batches:
        low = batch.column("low").to_numpy()
        for a in range(0, batch.num_rows, 256):
            part = batch.slice(a, 256)
            starts, hashes, checks, rows = [], [], [], []
            for i, window in enumerate(part.column("window").to_pylist()):
                data = np.frombuffer(window, np.uint8)
                hashes.append(rolling(data, length))
                checks.append(rolling(data[::-1], length)[::-1])
                starts.append(low[a + i] + np.arange(len(hashes[-1])))
                rows.append(np.full(len(hashes[-1]), i))
            pick = pa.array(np.concatenate(rows))
            yield pa.RecordBatch.from_arrays(
                [part.column("version").take(pick),
                 pa.array(np.concatenate(starts).astype(np.int32)),
                 pa.array(np.concatenate(hashes).view(np.int64)), pa.array(np.concatenate(checks).view(np.int64))],
                ["version", "start", "hash", "check"],
            )


def _cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with their runs to the bytes that stay and the merged spans that go."""
    spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    for batch in batches:
        data, offsets = ta.text_bytes(batch.column("_text"))
        runs = batch.column("_runs").to_pylist()
        kept, gone = [], []
        for i in range(batch.num_rows):
            body = data[offsets[i] : offsets[i + 1]].tobytes()
            merged: list[list[int]] = []
            for run in sorted((r["start"], r["end"]) for r in runs[i] or ()):
                if merged and run[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], run[1])
                else:
                    merged.append(list(run))
            if batch.column("_whole")[i].as_py():
                merged = [[0, len(body)]]
            edges = [0, *(x for run in merged for x in run), len(body)]
            kept.append(b"".join(body[a:b] for a, b in zip(edges[::2], edges[1::2])))
            gone.append([{"start": a, "end": b} for a, b in merged])
        rest = batch.drop_columns(["_text", "_runs", "_whole"])
        yield pa.RecordBatch.from_arrays(
            [*rest.columns, pa.array(kept, pa.binary()), pa.array(gone, spans)],
            [*rest.schema.names, "kept", "removed"],
        )


def _windows(source: DataFrame, texts: DataFrame, length: int) -> DataFrame:
    """The windows of the listed anchors, each distinct text once."""
    wanted = texts.select(F.col("version").alias("_version"), F.col("doc").alias("_doc"), "repeats")
    near = likely(source, texts, "version")
    met = near.join(
        wanted, (F.col("version") == F.col("_version")) & F.col("doc").eqNullSafe(F.col("_doc"))
    ).dropDuplicates(["version", "doc"])
    return met.select("version", "text", "repeats").mapInArrow(
        partial(_window_batches, length=length),
        "version long, anchor long, at int, low int, window binary",
    )


RUNS = "version long, start int, end int"


def _compared(windows: DataFrame, length: int) -> DataFrame:
    dealt = windows.repartition("anchor").sortWithinPartitions("anchor")
    return dealt.mapInArrow(partial(_run_batches, length=length), RUNS)


def _counted(windows: DataFrame, length: int) -> DataFrame:
    """Runs of one start each, for anchors too crowded to compare: strings counted by hash."""
    strings = stored(
        windows.select("version", "low", "window").mapInArrow(
            partial(_string_batches, length=length), "version long, start int, hash long, check long"
        )
    )
    often = (
        strings.groupBy("hash", "check").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    )
    return strings.join(often, ["hash", "check"]).select(
        "version", "start", (F.col("start") + length).alias("end")
    )


def cut_repeats(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    most_windows: int = MOST_WINDOWS,
) -> DataFrame:
    """``df`` without its text, with ``kept`` (bytes that stay) and ``removed`` (spans of bytes).

    A byte goes if a ``length``-byte string over it also starts at another place of this
    or another row; strings are judged on the input and never cross rows. A null or
    empty text keeps no bytes and loses none. Rows that repeat key and text each lose
    all their bytes if there are ``length`` of them, as do all copies of a text. Columns
    of ``df`` named like a result give way. Texts and anchors are told apart by hashes of
    64 bits, counted strings by 128; windows are compared byte by byte.
    """
    source = df.select(
        F.col(key).alias("doc"), F.xxhash64(text_or_empty(text)).alias("version"), text_or_empty(text).alias("text")
    )
    kind = source.schema["doc"].dataType.simpleString()
    found = stored(
        source.mapInArrow(
            partial(_anchor_batches, length=length),
            f"doc {kind}, version long, anchor long, at int, low int, high int",
        )
    )
    least = found.groupBy("anchor").agg(
        *[f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in ("version", "at")]
    )
    repeated = stored(
        least.filter("min_version <> max_version OR min_at <> max_at").select("anchor")
    )
    place = F.struct("anchor", "at", "low", "high")
    texts = stored(
        narrowed(found, repeated, "anchor")
        .groupBy("version")
        .agg(F.min("doc").alias("doc"), F.collect_set(place).alias("repeats"))
    )
    crowded = stored(
        texts.select(F.explode("repeats.anchor").alias("anchor"))
        .groupBy("anchor")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > most_windows)
        .select("anchor")
    )
    runs = _compared(_windows(source, texts, length), length)
    if not crowded.isEmpty():
        places = texts.select("version", "doc", F.explode("repeats").alias("place"), "place.anchor")
        split = places.join(
            crowded.withColumn("crowd", F.lit(True)), "anchor", "left"
        ).withColumn("crowd", F.coalesce("crowd", F.lit(False)))
        split = stored(
            split.groupBy("version", "doc", "crowd").agg(F.collect_list("place").alias("repeats"))
        )
        runs = _compared(_windows(source, split.filter("NOT crowd"), length), length).union(
            _counted(_windows(source, split.filter("crowd"), length), length)
        )
    runs = runs.groupBy("version").agg(F.collect_set(F.struct("start", "end")).alias("_runs"))
    twins = source.groupBy("version").agg((F.count(F.lit(1)) > 1).alias("_twin"))
    cuts = stored(
        twins.filter("_twin").join(runs, "version", "full").withColumnRenamed("version", "_version")
    )
    others = carried(df, text, "kept", "removed")
    named = df.select(
        *others, text_or_empty(text).alias("_text"), F.xxhash64(text_or_empty(text)).alias("_own")
    )
    whole = F.coalesce("_twin", F.lit(False)) & (F.octet_length("_text") >= length)
    touched, untouched = parted(named, cuts.select(F.col("_version").alias("_own")), "_own")
    joined = touched.join(cuts, F.col("_own") == F.col("_version"), "left").unionByName(
        untouched, allowMissingColumns=True
    )
    joined = joined.select(*others, "_text", "_runs", whole.alias("_whole"))
    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in joined.schema if f.name in others]
    return joined.mapInArrow(
        _cut_batches,
        ", ".join([*schema, "kept binary, removed array<struct<start: int, end: int>>"]),
    )
