"""Malformed CSV records stand apart, and a file's order survives its splits."""

from __future__ import annotations

import os

import pytest
from martlane.operators import clean as C
from martlane.sources import extracts as X
from martlane.sources import records as R

HEAD = "Returned,Order ID,Region"
LINES = {
    "Yes,1,A": None, "Yes,2,A,EXTRA": "too_many_fields", "No,3": "too_few_fields", '"Yes,4,A': "unbalanced_quotes",
    'Yes,"5 ""big"", wide",A': None, '"","",""': None, 'Yes,6 "x,A': "unbalanced_quotes", 'Yes,"7"b,A': "unbalanced_quotes",
    '"Yes","8",""""': None, ",,": None, "x": "too_few_fields", '"a,b",c,"d"': None, "Yes,9,A\r": None,
}


def put(folder, name, *lines, tail=b""):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "wb") as f:
        f.write("\n".join(lines).encode() + tail)
    return folder


@pytest.mark.parametrize("multi_line", [False, True])
def test_every_record_is_kept_or_stands_apart(spark, scratch, multi_line):
    path = put(f"{scratch}/in", "a.csv", HEAD, *[x for x in LINES if multi_line is False or '"' not in x or LINES[x] is None],
               "", "   ", tail=b"\nYes,10\xc3,A\nNo,11,B")
    bad = {(r.record.rstrip("\r"), r.reason) for r in R.malformed_records(spark, path, multi_line).collect()}
    want = {(x, r) for x, r in LINES.items() if r and (not multi_line or '"' not in x)}
    assert {r for r in bad if "10" not in r[0]} == want
    assert {r[1] for r in bad if "10" in r[0]} == {"bad_bytes"}
    q = R.quarantine(spark, path, f"{scratch}/q", multi_line)
    good = X.read_returns(spark, path, malformed="apart", multi_line=multi_line)
    assert q.read == q.kept + sum(q.apart.values()) and q.kept == good.count() == sum(r is None for r in LINES.values()) + 1
    assert spark.read.parquet(f"{scratch}/q").count() == len(bad) == sum(q.apart.values())
    rows = {(r.returned, r.order_id, r.region) for r in good.collect()}
    assert ("Yes", '5 "big", wide', "A") in rows and ("a,b", "c", "d") in rows and ("Yes", "8", '"') in rows
    with pytest.raises(Exception, match="malformed record"):
        X.read_returns(spark, path, multi_line=multi_line).count()


def test_line_breaks_in_fields_are_set_apart_or_read(spark, scratch):
    path = put(f"{scratch}/in", "a.csv", HEAD, 'Yes,"two\nlines",A', "No,2,B")
    assert R.quarantine(spark, path, f"{scratch}/q").apart["unbalanced_quotes"] == 2
    assert [r.order_id for r in X.read_returns(spark, path, multi_line=True).collect()] == ["two\nlines", "2"]


def test_header_marks_and_empty_files(spark, scratch):
    folder = put(f"{scratch}/in", "a.csv", "\ufeffReturned,Order ID,Region", "Yes,1,A")
    put(folder, "b.csv", "\ufeffReturned,Order ID,Region", "Returned,Order ID,Region", "No,2,B")
    back = X.read_returns(spark, folder)
    assert back.columns == ["returned", "order_id", "region"] and back.count() == 2
    only = put(f"{scratch}/only", "a.csv", HEAD)
    assert X.read_returns(spark, only).count() == 0 and R.malformed_records(spark, only).count() == 0


def test_first_owner_follows_the_file_however_it_is_split(spark, scratch):
    lines = [f"P{k:05d},R{k % 7}" for k in range(4000)][::-1]
    path = put(f"{scratch}/in", "people.csv", "Person,Region", *lines)
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        people = X.read_people(spark, path)
        assert people.rdd.getNumPartitions() > 8 and people.count() == 4000
        got = {r.region: r.person for r in C.dedupe_people(people.repartition(5)).collect()}
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    want = {}
    for line in lines:
        person, region = line.split(",")
        want.setdefault(region, person)
    assert got == want
