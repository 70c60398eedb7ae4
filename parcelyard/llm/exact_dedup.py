"""Exact copies by an extendible-hash index whose files all tasks share.

The 64-bit hash of a text is its key. A directory maps the leading bits of a key to a
bucket; a bucket that would hold more than its capacity is split by one more bit, and the
directory doubles when a bucket needs more bits than it has. Copies are folded where they
are read (the aggregation compares bytes), so a bucket gets each text once, however many
rows have it. The task that owns a range of buckets chains the different texts of one key.
Everything is built-in DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelyard.llm.narrowing import likely, parted
from parcelyard.llm.storage import carried, shared_folder, stored, text_or_empty

#: Bits of the directory at most: its 65,536 cells can be broadcast, whatever the data.
MOST_DEPTH = 16
#: Bytes of a bucket beyond which it is split: its texts, and what each key takes.
CAPACITY = 16 << 20
ENTRY_BYTES = 64
#: Groups that are broadcast to their rows, largest first: each other group has fewer than
#: a thousandth of the rows, so no task of the join is crowded.
LARGEST = 1000

COLUMNS = ("keep_id", "group_size", "kept", "text_sha256")


def _cell(key: str = "key") -> Column:
    return F.shiftrightunsigned(key, 64 - MOST_DEPTH).cast("int")


def directory(loads: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(cell, load, depth) from (cell, load): the bits that tell a cell's bucket from others.

    Starts as one bucket of no bits. In every round the buckets over ``capacity`` are
    split by one bit more. Cells are ``MOST_DEPTH`` bits wide, and a bucket of a single
    cell stays as it is; its task then spills. An empty table gives an empty directory.
    """
    cells = stored(loads.withColumn("depth", F.lit(0)))
    for depth in range(MOST_DEPTH):
        prefix = F.shiftright("cell", MOST_DEPTH - depth)
        full = (
            cells.filter(F.col("depth") == depth)
            .groupBy(prefix.alias("prefix"))
            .agg(F.sum("load").alias("held"))
            .filter(F.col("held") > capacity)
            .select("prefix", F.lit(depth).alias("depth"), F.lit(1).alias("bit"))
        )
        if full.isEmpty():
            break
        split = cells.withColumn("prefix", prefix).join(
            F.broadcast(full), ["prefix", "depth"], "left"
        )
        more = F.col("depth") + F.coalesce("bit", F.lit(0))
        cells = stored(split.select("cell", "load", more.alias("depth")))
    return cells


def build_index(
    texts: DataFrame, entries: DataFrame, capacity: int = CAPACITY
) -> tuple[DataFrame, DataFrame]:
    """The index over ``texts`` (id, key, text) with ``entries`` (key, n, size): directory, chains.

    Chains have one row per different text whose key occurs more than once: bucket (its
    first cell), depth, key, link (place in the chain of its key, from 1), text, keep_id
    (largest id) and group_size. They lie in shared files in order of bucket and key. A key
    of one row has nothing to be compared with, so its text is not moved at all.
    """
    loads = entries.groupBy(_cell().alias("cell")).agg(
        F.sum(ENTRY_BYTES + F.when(F.col("n") > 1, F.col("size")).otherwise(0)).alias("load")
    )
    cells = directory(loads, capacity)
    twins = entries.filter("n > 1").select("key")
    folded = (
        likely(texts, twins, "key")
        .groupBy("key", "text")
        .agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .filter("group_size > 1")
    )
    rest = f"{MOST_DEPTH} - depth"
    start = F.expr(f"shiftleft(shiftright(cell, {rest}), {rest})")
    placed = (
        folded.withColumn("cell", _cell())
        .join(F.broadcast(cells.select("cell", "depth")), "cell")
        .withColumn("bucket", start)
        .drop("cell")
    )
    chain = Window.partitionBy("bucket", "key").orderBy(F.sha2("text", 256))
    owned = placed.repartitionByRange("bucket").withColumn("link", F.row_number().over(chain))
    path = shared_folder(texts.sparkSession)
    owned.sortWithinPartitions("bucket", "key", "link").write.parquet(path)
    return cells, texts.sparkSession.read.schema(owned.schema).parquet(path)


def mark_copies(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY
) -> DataFrame:
    """Every row of ``docs`` without its text, with keep_id, group_size, kept, text_sha256.

    Rows are copies if their texts have the same bytes. The row with the largest id stays,
    ``kept``; a null id is smaller than any. Of rows with the same text and id exactly one
    is kept. A null text is the empty text. Long texts are hashed and compared whole. Of
    columns of ``docs`` with the name of a result column, the result's is returned. An
    empty table gives an empty result.
    """
    source = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carried(docs, text, *COLUMNS)]).alias("row"),
        F.col(doc_id).alias("id"),
        text_or_empty(text).alias("text"),
    ).withColumn("key", F.xxhash64("text"))
    rows = stored(
        source.select(
            "row",
            "id",
            "key",
            F.octet_length("text").cast("long").alias("size"),
            F.unhex(F.sha2("text", 256)).alias("sha"),
            F.monotonically_increasing_id().alias("at"),
        )
    )
    entries = stored(
        rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("size").alias("size"))
    )
    _, chains = build_index(source.select("id", "key", "text"), entries, capacity)
    # The chains compare bytes; a row finds its link by the digest, which the result names.
    links = chains.select("key", F.unhex(F.sha2("text", 256)).alias("sha"), "keep_id", "group_size")
    twins = entries.filter("n > 1").select("key")
    tops = (
        likely(rows, twins, "key")
        .groupBy("key", "sha")
        .agg(F.max(F.struct("id", "at"))["at"].alias("top"))
    )
    groups = stored(links.join(tops, ["key", "sha"]))
    large = F.broadcast(groups.orderBy(F.desc("group_size"), "key", "sha").limit(LARGEST))
    met = rows.join(large, ["key", "sha"], "left")
    rest = met.filter("group_size IS NULL").select(*rows.columns)
    several, alone = parted(rest, twins, "key")
    unknown = [F.lit(None).cast(t).alias(c) for c, t in groups.dtypes if c not in ("key", "sha")]
    names = ["row", "id", "sha", "at", "keep_id", "group_size", "top"]
    found = (
        met.filter("group_size IS NOT NULL")
        .select(names)
        .union(several.join(groups, ["key", "sha"], "left").select(names))
        .union(alone.select(*rows.columns, *unknown).select(names))
    )
    single = F.col("group_size").isNull()
    return found.select(
        "row.*",
        F.when(single, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (single | (F.col("at") == F.col("top"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
