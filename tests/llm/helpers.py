"""Small document tables with every odd case, and brute-force versions."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, stock=400):
    return " ".join(f"w{rng.randrange(stock):03d}x" for _ in range(n))


def odd_rows(seed=5):
    """(doc_id, text): nulls, empty and long texts, copies, near copies, repeated rows."""
    rng = random.Random(seed)
    base = words(rng, 120)
    near = base.split()
    near[60] = "changed"
    shared = words(rng, 90)
    twin = "ünï çödé " + words(rng, 60) + " 日本語"
    rows = [
        (0, base),
        (1, base),
        (2, " ".join(near)),
        (3, None),
        (4, ""),
        (5, " \n\t "),
        (None, words(rng, 70)),
        (None, None),
        (6, words(rng, 6000, 4000) + "\n" + shared + "\n" + words(rng, 3000, 4000)),
        (7, words(rng, 30) + "\n" + shared + "\n" + words(rng, 30)),
        (8, "too short"),
        (9, "\n".join(["the same line with some words in it again"] * 9 + [words(rng, 60)])),
        (10, words(rng, 80)),
        (10, words(rng, 80)),
        (11, twin),
        (11, twin),
    ]
    rows.append(rows[12])
    rows += [(100 + i, words(rng, 60 + i)) for i in range(20)]
    return rows


def documents(spark, rows):
    return spark.createDataFrame(
        [(k, t, "en", "s", len(t) if t else None) for k, t in rows], SCHEMA
    )


def labels(spark, rows):
    return spark.createDataFrame(
        [(k, k % 2, 0) for k, _ in rows if k is not None] + [(None, 1, 0), (4, None, None)],
        "doc_id long, quality int, toxic int",
    )
