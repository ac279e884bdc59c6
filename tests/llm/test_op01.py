"""WARC: payloads that hold the magic, small splits, and rows that repeat come back whole."""

import hashlib
import random

import pytest

from finsieve.llm import op01_warc as warc
from finsieve.session import new_path

FAKE = "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\n"


def expected(rows):
    keeper = {}
    for i, body in rows:
        b = (body or "").encode()
        if len(b) >= 1000 and i is not None:
            keeper[b] = max(i, keeper.get(b, -1))
    out = []
    for i, body in rows:
        b = (body or "").encode()
        k = keeper.get(b)
        later = k is not None and k != i
        out.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if later else "response", k if later else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("split", ["2k", "128m"])
def test_round_trip(spark, split):
    rng = random.Random(1)
    rows = []
    for i in range(48):
        body = [None, "", "x" * rng.randint(1, 200) + FAKE * rng.randint(1, 40), "WARC/1.", "WARC/1.0\r\n\r\n" * 900 + "é", "dup" * 500][i % 6]
        rows.append((i, body))
    rows += [(47, "dup" * 500), (None, "dup" * 500), (99, "x" * 300_000)]
    pages = spark.createDataFrame([(i, f"http://x/\n{i}", b, "y") for i, b in rows], "page_id long, url string, html string, digest string")
    path = new_path(spark, "warc-test")
    warc.write(pages.repartition(3), path)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        got = [tuple(r) for r in warc.payloads(warc.records(spark, path)).collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sorted(got, key=str) == [(i, n, d, t, r) for i, n, d, t, r in expected(rows)]


def test_empty(spark):
    path = new_path(spark, "warc-test")
    warc.write(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.payloads(warc.records(spark, path)).count() == 0


def test_false_header_is_no_record():
    assert warc.parse(b"0\r\nno colon\r\n\r\n") is None
    assert warc.parse(b"0\r\nContent-Length: x\r\n\r\n") is None
    assert warc.parse(b"2\r\nContent-Length: 1\r\n\r\n") is None
    assert warc.parse(b"1\r\nContent-Length: 12\r\n\r\nabc") == ({"content-length": "12"}, 32, 12)
