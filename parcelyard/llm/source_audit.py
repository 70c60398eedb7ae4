"""How far the sources of each language diverge in the words they use.

Each language has its own CountVectorizer, with a least number of documents per term and
no bound on the vocabulary. It gets the terms of some texts at once, each as often as its
count has bits, so vectors are exact. They are summed per source as sparse (term, count)
rows. Sources are compared in blocks of terms and sources: a block
evaluates the terms that occur there, and the terms that neither source of a pair has add
one value, times their number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelyard.llm import interning
from parcelyard.llm import textarrays as ta
from parcelyard.llm.storage import shared_folder, stored, text_or_empty

#: Bytes of a term: letters a-z (A-Z are lowered) and all of characters beyond ASCII.
LETTERS = np.zeros(256, bool)
LETTERS[0x41:0x5B] = LETTERS[0x61:0x7B] = LETTERS[0x80:] = True
LEAST_DOCS = 10
MOST_TERMS = 2**31 - 1
SCALE = 1_000_000_000
TOP_TERMS = 10
#: Terms and sources of a block; a task holds two blocks of sources at most.
TERM_BLOCK = 4096
SOURCE_BLOCK = 256
#: Bytes of text whose terms are counted together.
PIECE_BYTES = 1 << 22
#: Cells (language, source, term) that a task holds before it merges them, and hands them on if that leaves half.
MOST_CELLS = 1 << 21
#: More than the sources that a task can meet.
MOST_SOURCES = 1 << 32
#: In every document, so that a language never has an empty vocabulary; no real term is empty.
EVERYWHERE = ""

COLUMNS = ["lang", "source", "part", "item", "value", "rank"]

_VECTORS = """lang string, source string, weight long,
    terms struct<type: tinyint, size: int, indices: array<int>, values: array<double>>"""


def _cells(cell: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different values in order, and how often each occurs."""
    cell = np.sort(cell)
    first = np.flatnonzero(np.diff(cell, prepend=-1))
    return cell[first], np.diff(first, append=len(cell))


def _merged(parts: list[np.ndarray]) -> np.ndarray:
    """Cells as columns (owner, term, times): one for each owner and term, in order, with the sum of its times."""
    owner, term, times = np.concatenate(parts, axis=1)
    ids, which = np.unique(owner, return_inverse=True)
    width = int(term.max(initial=0)) + 1
    cell = which * width + term
    order = np.argsort(cell)
    cell = cell[order]
    first = np.flatnonzero(np.diff(cell, prepend=-1))
    summed = np.add.reduceat(times[order], first) if len(first) else times
    return np.stack([ids[cell[first] // width], cell[first] % width, summed])


def _known(names: pa.Array, more: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """``names`` with what is new in ``more``, and the place of each of ``more`` in it."""
    joint = pa.concat_arrays([names, more]).dictionary_encode()
    return joint.dictionary, joint.indices.to_numpy()[len(names) :].astype(np.int64)


def _term_rows(
    cells: np.ndarray, names: pa.Array, sources: pa.Array, least_docs: int | None
) -> Iterator[pa.RecordBatch]:
    """Rows (n, source, weight, terms) of merged cells: by texts up to ``least_docs``, or by bits."""
    owner, term, times = cells
    most = int(times.max(initial=0))
    for k in range(most.bit_length() if least_docs is None else min(most, least_docs)):
        chosen = np.flatnonzero((times >> k) & 1 if least_docs is None else times > k)
        first = np.flatnonzero(np.diff(owner[chosen], prepend=-1))
        lists = pa.LargeListArray.from_arrays(
            pa.array(np.append(first, len(chosen))), names.take(pa.array(term[chosen]))
        )
        n, source = np.divmod(owner[chosen[first]], MOST_SOURCES)
        weight = np.full(len(first), 0 if least_docs is not None else 1 << k)
        yield pa.record_batch(
            [pa.array(n), sources.take(pa.array(source)), pa.array(weight), lists.cast(pa.list_(pa.string()))],
            ["n", "source", "weight", "terms"],
        )


def _term_batches(batches: Iterator[pa.RecordBatch], least_docs: int) -> Iterator[pa.RecordBatch]:
    """(n, source, weight, terms): what is counted by texts, and what by occurrences.

    Rows of weight 0 stand for the texts of a language: a term of k of them, and the one
    that every text has, is in k of these rows, or in ``least_docs`` if k is more. So a term
    is in that many of all rows if and only if it is in that many texts. The other rows have
    the terms of a source whose number has the bit ``weight``, so a term's weights add up to
    its occurrences. Both repeat far fewer strings than the texts do, as the cells of a
    task's pieces of text are merged as long as there are not too many.
    """
    by_text: list[np.ndarray] = []
    by_source: list[np.ndarray] = []
    names = pa.array([EVERYWHERE], pa.large_string())
    places = pa.array([], pa.string())

    def handed_on() -> Iterator[pa.RecordBatch]:
        for parts, least in ((by_text, least_docs), (by_source, None)):
            if parts:
                yield from _term_rows(_merged(parts), names, places, least)
            parts.clear()

    for batch in batches:
        data, offsets = ta.text_bytes(batch.column("text"))
        places, sources = _known(places, batch.column("source").cast(pa.string()))
        langs = batch.column("n").to_numpy() * MOST_SOURCES
        for a, b in ta.pieces(offsets, PIECE_BYTES):
            found = interning.words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], LETTERS)
            ends = np.concatenate([[0], np.cumsum(found.length)]).astype(np.int64)
            chars = np.ascontiguousarray(found.data[found.data != 0x20])
            terms = pa.LargeStringArray.from_buffers(
                len(found.length), pa.py_buffer(ends), pa.py_buffer(chars)
            ).dictionary_encode()
            names, place = _known(names, terms.dictionary)
            width = len(terms.dictionary) + 1
            place = np.append(0, place)
            code = terms.indices.to_numpy().astype(np.int64) + 1
            text = np.repeat(np.arange(b - a), np.diff(found.first))

            def counted(owners: np.ndarray, row: np.ndarray, term: np.ndarray) -> np.ndarray:
                ids, which = np.unique(owners, return_inverse=True)
                cell, times = _cells(which[row] * width + term)
                return np.stack([ids[cell // width], place[cell % width], times])

            once, _ = _cells(np.concatenate([text * width + code, np.arange(b - a) * width]))
            by_text.append(counted(langs[a:b], *np.divmod(once, width)))
            by_source.append(counted(langs[a:b] + sources[a:b], text, code))
            if sum(x.shape[1] for x in by_text + by_source) > MOST_CELLS:
                by_text[:], by_source[:] = [_merged(by_text)], [_merged(by_source)]
                if by_text[0].shape[1] + by_source[0].shape[1] > MOST_CELLS // 2:
                    yield from handed_on()
                    names = names.slice(0, 1)
    yield from handed_on()


def term_counts(docs: DataFrame, least_docs: int = LEAST_DOCS) -> tuple[DataFrame, DataFrame]:
    """Vocabulary (lang, index, term) and counts (lang, source, index, count) of kept terms.

    ``docs`` has lang, source and text without nulls. A language with fewer than
    ``least_docs`` documents keeps no term. The names of the other languages, and the
    vocabulary of one language at a time, pass through the driver, as CountVectorizer has it.
    """
    spark = docs.sparkSession
    words, vectors, listed = (shared_folder(spark) for _ in range(3))
    named = spark.createDataFrame([], "lang string, index int, term string")
    sizes = docs.groupBy("lang").count().filter(F.col("count") >= least_docs)
    langs = sorted(r["lang"] for r in sizes.select("lang").collect())
    if not langs:
        return named, spark.createDataFrame([], "lang string, source string, index int, count long")
    # Folders are numbered, as a language may be any text.
    numbers = spark.createDataFrame(list(zip(langs, range(len(langs)))), "lang string, n long")
    texts = docs.join(F.broadcast(numbers), "lang").select("n", "source", "text")
    tokens = texts.mapInArrow(lambda batches: _term_batches(batches, least_docs), "n long, source string, weight long, terms array<string>")
    tokens.withColumn("counted", F.col("weight") > 0).write.partitionBy("n", "counted").parquet(words)
    form = "source string, weight long, terms array<string>"
    for n, lang in enumerate(langs):
        held = spark.read.schema(f"{form}, counted boolean").parquet(f"{words}/n={n}")
        model = CountVectorizer(
            inputCol="terms", outputCol="vector", minDF=float(least_docs), vocabSize=MOST_TERMS
        ).fit(held.filter("NOT counted"))
        own = model.transform(held.filter("counted")).select(
            F.lit(lang).alias("lang"), "source", "weight", F.col("vector").alias("terms")
        )
        own.write.mode("append").parquet(vectors)
        rows = [(lang, i, t) for i, t in enumerate(model.vocabulary) if t != EVERYWHERE]
        spark.createDataFrame(rows, named.schema).write.mode("append").parquet(listed)
    vocabulary = spark.read.schema(named.schema).parquet(listed)
    # The stored form of a vector is a struct, so its parts can be read as columns.
    pairs = spark.read.schema(_VECTORS).parquet(vectors).select(
        "lang",
        "source",
        "weight",
        F.explode("terms.indices").alias("index"),  # a term stands once in each row
    )
    counts = pairs.groupBy("lang", "source", "index").agg(F.sum("weight").alias("count"))
    everywhere = vocabulary.select("lang", "index")
    return vocabulary, stored(
        counts.join(everywhere, ["lang", "index"], "left_semi").select(
            "lang", "source", "index", "count"
        )
    )


def share(count: str, total: str, size: str) -> Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 * size)), whose product may exceed 64 bits."""
    return F.expr(
        f"1 + (CAST({SCALE} AS DECIMAL(10,0)) * CAST({count} + 2 AS DECIMAL(20,0))) "
        f"DIV CAST(greatest({total} + 2 * {size}, 1) AS DECIMAL(20,0))"
    )


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q)) of shares of at most SCALE + 1, so 64 bits hold the square."""
    return (p - q) ** 2 // (p + q)


def _block_pairs(table: pa.Table) -> pa.Table:
    """Sums over the terms of one block, for all pairs of a first and a second block of sources.

    Rows are (lang, side, source, index, p); index -1 gives a source's share of a term that
    it does not have. A block that meets itself has no rows of side 1. ``n_terms`` is the
    number of terms that were evaluated: those that some source of the blocks has.
    """
    side, source, index, p = (
        table.column(c).to_numpy() for c in ("side", "source", "index", "p")
    )
    terms = np.unique(index[index >= 0])
    width = len(terms)

    def dense(k: int) -> tuple[np.ndarray, np.ndarray]:
        absent = np.flatnonzero((side == k) & (index < 0))
        absent = absent[np.argsort(source[absent])]
        ids = source[absent]
        shares = np.repeat(p[absent][:, None], width, axis=1)
        at = np.flatnonzero((side == k) & (index >= 0))
        shares[np.searchsorted(ids, source[at]), np.searchsorted(terms, index[at])] = p[at]
        return ids, shares

    ids, mine = dense(0)
    others, theirs = dense(1)
    same = not len(others)
    if same:
        others, theirs = ids, mine
    a, b, value = [], [], []
    for i in range(len(ids)):
        first = i + 1 if same else 0
        a += [ids[i]] * (len(others) - first)
        b += others[first:].tolist()
        value += distance(mine[i], theirs[first:]).sum(axis=1).tolist()
    n = len(value)
    return pa.table(
        [
            pa.array([table.column("lang")[0].as_py()] * n, pa.string()),
            pa.array(a, pa.int32()),
            pa.array(b, pa.int32()),
            pa.array(value, pa.int64()),
            pa.array([width] * n, pa.int64()),
        ],
        names=["lang", "a", "b", "value", "n_terms"],
    )


def _present_pairs(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, a, b, value, n_terms) for a < b: sums over the terms that their blocks have.

    ``counts`` has lang, a (number of the source), index and p, ``groups`` lang, a, size and
    p0. A row is repeated once per block of sources, and a task holds at most TERM_BLOCK
    terms of two such blocks. A term that no source of two blocks has is left to the caller.
    """
    block = lambda column, size: F.expr(f"CAST({column} DIV {size} AS INT)")
    absent = groups.filter("size > 0").select(
        "lang",
        "a",
        F.explode(F.sequence(F.lit(0), block("size", TERM_BLOCK))).alias("terms"),
        F.lit(-1).alias("index"),
        F.col("p0").alias("p"),
    )
    present = counts.select("lang", "a", block("index", TERM_BLOCK).alias("terms"), "index", "p")
    blocks = groups.groupBy("lang").agg(block("max(a)", SOURCE_BLOCK).alias("last"))
    spread = (
        present.union(absent)
        .join(blocks, "lang")
        .withColumn("own", block("a", SOURCE_BLOCK))
        .withColumn("other", F.explode(F.sequence(F.lit(0), "last")))
        .select(
            "lang",
            F.least("own", "other").alias("i"),
            F.greatest("own", "other").alias("j"),
            "terms",
            (F.col("own") > F.col("other")).cast("int").alias("side"),
            F.col("a").alias("source"),
            "index",
            "p",
        )
    )
    made = spread.groupBy("lang", "i", "j", "terms").applyInArrow(
        _block_pairs, "lang string, a int, b int, value long, n_terms long"
    )
    return made.groupBy("lang", "a", "b").agg(
        F.sum("value").alias("value"), F.sum("n_terms").alias("n_terms")
    )


def audit_sources(
    docs: DataFrame,
    lang: str = "lang",
    source: str = "source",
    text: str = "text",
    least_docs: int = LEAST_DOCS,
    top_terms: int = TOP_TERMS,
) -> DataFrame:
    """(lang, source, part, item, value, rank): how a source differs within its language.

    Part ``pair`` has every other source of the language by falling distance, part ``term``
    the ``top_terms`` terms that the source has more often than its language, by how much.
    Ties go to the item that is less by its bytes. Null lang, source and text are empty
    strings, an empty one is a language or source like others. Without kept terms all
    distances are 0 and there are no terms. Repeated rows count as often as they stand;
    other columns are not read. An empty table gives an empty result.
    """
    docs = docs.select(
        text_or_empty(lang).alias("lang"),
        text_or_empty(source).alias("source"),
        text_or_empty(text).alias("text"),
    )
    vocabulary, counts = term_counts(docs, least_docs)
    totals = counts.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    sizes = vocabulary.groupBy("lang").agg(F.count(F.lit(1)).alias("size"))
    by_name = Window.partitionBy("lang").orderBy("source")
    groups = (
        docs.select("lang", "source")
        .distinct()
        .join(totals, ["lang", "source"], "left")
        .join(sizes, "lang", "left")
        .fillna(0, ["total", "size"])
        .withColumn("a", F.row_number().over(by_name) - 1)
        .withColumn("p0", share("0L", "total", "size"))
    )
    groups = stored(groups)
    placed = counts.join(groups, ["lang", "source"]).withColumn("p", share("count", "total", "size"))
    placed = stored(placed.select("lang", "source", "a", "index", "p", "size"))

    one = groups.select("lang", "a", "size", "source", "p0")
    two = groups.select("lang", F.col("a").alias("b"), F.col("source").alias("item"), F.col("p0").alias("q0"))
    met = (
        one.join(two, "lang")
        .filter("a < b")
        .join(_present_pairs(placed, groups), ["lang", "a", "b"], "left")
        .fillna(0, ["value", "n_terms"])
        .withColumn("value", F.expr("value + (size - n_terms) * (((p0 - q0) * (p0 - q0)) DIV (p0 + q0))"))
    )
    pair = met.select("lang", "source", "item", "value").union(
        met.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")
    )

    whole = groups.groupBy("lang").agg(F.sum("total").alias("all"))
    in_lang = counts.groupBy("lang", "index").agg(F.sum("count").alias("in_lang"))
    term = (
        placed.join(in_lang, ["lang", "index"])
        .join(whole, "lang")
        .withColumn("q", share("in_lang", "`all`", "size"))
        .filter("p > q")
        .join(vocabulary, ["lang", "index"])
        .select(
            "lang",
            "source",
            F.col("term").alias("item"),
            F.expr("((p - q) * (p - q)) DIV (p + q)").alias("value"),
        )
    )
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(best))
    return (
        ranked(pair)
        .withColumn("part", F.lit("pair"))
        .select(*COLUMNS)
        .union(
            ranked(term)
            .filter(F.col("rank") <= top_terms)
            .withColumn("part", F.lit("term"))
            .select(*COLUMNS)
        )
    )
