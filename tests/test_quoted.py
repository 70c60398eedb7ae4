"""Quoted line breaks are read by many tasks per file, as the multi-line reader reads them."""

import random

import pytest
from pyspark.sql.types import StringType, StructField, StructType

from parcelyard.sources import quoted
from tests.helpers import plan, rows

NAMES = ["review_id", "order_id", "text"]
SCHEMA = StructType([StructField(n, StringType()) for n in NAMES])


def _field(rng, end):
    words = ["plain", "", " spaced ", "a,b", '"', '""', "x" * 30, "é日本", f"two{end}lines", end, f"{end}{end}", "'"]
    text = "".join(rng.choice(words) for _ in range(rng.randrange(5)))
    needs = any(c in text for c in ',"\n\r') or rng.random() < 0.3
    return '"' + text.replace('"', '""') + '"' if needs else text


def _write(path, n, seed, end="\n", bom="", last=True):
    rng = random.Random(seed)
    records = [f"r{i},{_field(rng, end)},{_field(rng, end)}" for i in range(n)]
    body = bom + end.join([",".join(NAMES), *records]) + (end if last else "")
    path.write_bytes(body.encode())


@pytest.fixture
def small_ranges(spark):
    """Ranges of a few hundred bytes."""
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = {n: spark.conf.get(n) for n in names}
    for n in names:
        spark.conf.set(n, "400b")
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def _reader(spark, path):
    options = {"header": "true", "enforceSchema": "false", "escape": '"', "multiLine": "true"}
    return spark.read.schema(SCHEMA).options(**options).csv(path)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_equals_the_multi_line_reader(spark, tmp_path, small_ranges, end):
    for k in range(4):
        _write(tmp_path / f"f{k}.csv", 150 + k, k, end, bom="﻿" if k == 1 else "", last=k != 2)
    (tmp_path / "none.csv").write_text(",".join(NAMES) + "\n")
    got = quoted.read_quoted(spark, str(tmp_path), SCHEMA, {"escape": '"'})
    assert rows(got) == rows(_reader(spark, str(tmp_path)))
    assert got.count() == 150 + 151 + 152 + 153


def test_a_file_is_read_in_many_ranges(spark, tmp_path, small_ranges):
    _write(tmp_path / "one.csv", 400, 9)
    lines = quoted.quoted_lines(spark, str(tmp_path / "one.csv"))
    assert lines.rdd.getNumPartitions() > 10
    assert lines.select("start").distinct().count() > 10
    got = quoted.read_quoted(spark, str(tmp_path / "one.csv"), SCHEMA, {"escape": '"'})
    assert rows(got) == rows(_reader(spark, str(tmp_path / "one.csv")))
    assert "Python" not in plan(got, "simple") and "BroadcastNestedLoopJoin" not in plan(got, "simple")


def test_a_record_across_many_ranges(spark, tmp_path, small_ranges):
    long = "\n".join(f'line {i} with ""quotes""' for i in range(300))
    (tmp_path / "f.csv").write_text(",".join(NAMES) + f'\na,b,c\nd,"{long}",e\nf,g,"h"\n')
    got = quoted.read_quoted(spark, str(tmp_path), SCHEMA, {"escape": '"'})
    assert rows(got, *NAMES) == {("a", "b", "c"): 1, ("d", long.replace('""', '"'), "e"): 1, ("f", "g", "h"): 1}


def test_other_headers_are_refused(spark, tmp_path):
    (tmp_path / "f.csv").write_text("review_id,text,order_id\na,b,c\n")
    with pytest.raises(Exception, match="header"):
        quoted.read_quoted(spark, str(tmp_path), SCHEMA, {"escape": '"'}).collect()
    (tmp_path / "f.csv").write_text('"review_id",Order_ID,"text"\na,"",\n\n')
    got = quoted.read_quoted(spark, str(tmp_path), SCHEMA, {"escape": '"'})
    assert rows(got) == rows(_reader(spark, str(tmp_path))) and got.count() == 1
    (tmp_path / "f.csv").write_text("")
    assert quoted.read_quoted(spark, str(tmp_path), SCHEMA, {"escape": '"'}).count() == 0
