import hashlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from parcelyard.llm import exact_dedup as ed
from tests.llm import helpers


def _expected(rows):
    ids, kept = defaultdict(list), set()
    for k, t in rows:
        ids[t or ""].append(k)
    out = Counter()
    for k, t in rows:
        t = t or ""
        keep = max((i for i in ids[t] if i is not None), default=None)
        stays = k == keep and t not in kept
        if stays:
            kept.add(t)
        out[(k, keep, len(ids[t]), stays, hashlib.sha256(t.encode()).hexdigest())] += 1
    return out


def _found(df):
    return Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect())


def test_equals_brute_force(spark):
    rows = helpers.odd_rows()
    rows += [(1000 + i, "hot copy\n" + "x" * 50) for i in range(300)]
    rows += [(2000, "trailing "), (2001, "trailing"), (2002, "Trailing"), (2003, "long " * 400_000)]
    rows += [(2004, "long " * 400_000), (None, "only null ids"), (None, "only null ids")]
    docs = helpers.documents(spark, rows).repartition(7)
    found = ed.mark_copies(docs)
    assert found.columns == ["doc_id", "lang", "source", "n_chars", *ed.COLUMNS]
    assert _found(found) == _expected(rows)
    # many splits, and only some of the groups broadcast
    assert _found(ed.mark_copies(docs, capacity=200)) == _expected(rows)


def test_join_without_broadcast_groups(spark, monkeypatch):
    rows = [(i, f"text {i % 40}") for i in range(200)] + [(500 + i, f"own {i}") for i in range(50)]
    monkeypatch.setattr(ed, "LARGEST", 3)
    assert _found(ed.mark_copies(helpers.documents(spark, rows))) == _expected(rows)


def test_directory_splits_overfull_buckets(spark):
    loads = [(c, 10) for c in range(0, 1 << ed.MOST_DEPTH, 64)]  # 1,024 cells
    loads += [(5, 100_000)]
    cells = ed.directory(spark.createDataFrame(loads, "cell int, load long"), 400).collect()
    held, depth = Counter(), {}
    for r in cells:
        prefix = (r.depth, r.cell >> (ed.MOST_DEPTH - r.depth))
        held[prefix] += r.load
        depth[r.cell] = r.depth
    assert sum(held.values()) == sum(n for _, n in loads)
    assert all(n <= 400 or d == ed.MOST_DEPTH for (d, _), n in held.items())
    assert depth[5] == ed.MOST_DEPTH and depth[1 << 15] == 5  # 32 cells to a bucket, no more splits
    empty = spark.createDataFrame([], "cell int, load long")
    assert ed.directory(empty, 400).count() == 0


def test_keys_that_collide_are_chained(spark):
    """Different texts under one key stay apart."""
    texts = [(i, 7, f"text {i % 3}") for i in range(9)] + [(20, -9, "a"), (21, -9, "a")]
    frame = spark.createDataFrame(texts, "id long, key long, text string")
    entries = spark.createDataFrame([(7, 9, 6), (-9, 2, 1)], "key long, n long, size long")
    _, chains = ed.build_index(frame, entries)
    got = {(r.key, r.link): (r.text, r.keep_id, r.group_size) for r in chains.collect()}
    assert len(got) == 4 and {k for k in got if k[0] == 7} == {(7, 1), (7, 2), (7, 3)}
    assert set(got.values()) == {("text 0", 6, 3), ("text 1", 7, 3), ("text 2", 8, 3), ("a", 21, 2)}


def test_odd_tables(spark):
    none = ed.mark_copies(helpers.documents(spark, []))
    assert none.count() == 0
    rows = helpers.odd_rows()
    clash = helpers.documents(spark, rows).select(
        "doc_id",
        "text",
        *[F.lit(-1).alias(c) for c in ("row", "id", "key", "sha", "at", "n", "size", "top", "_hit", "a.b")],
        F.lit("mine").alias("kept"),
    )
    found = ed.mark_copies(clash)
    assert _found(found) == _expected(rows)
    assert {"row", "key", "a.b"} <= set(found.columns) and found.filter("row <> -1").count() == 0
