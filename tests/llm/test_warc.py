import base64
import hashlib

import pytest

from numberplace.llm import warc
from numberplace.session import scratch_path

from .conftest import SF, rows_of

FAKE = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999999>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"


def expected(rows):
    out, last = [], {}
    for number, html in rows:
        if number is not None:
            last[html or ""] = max(number, last.get(html or "", number))
    for number, html in rows:
        data = (html or "").encode()
        top = last.get(html or "")
        first = top is None or number == top
        out.append((None if number is None else str(number), len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                    "response" if first else "revisit", None if first else str(top), True))
    return sorted(out, key=repr)


def round_trip(spark, df):
    path = scratch_path(spark)
    warc.write_archives(df, path)
    return path, rows_of(warc.read_archives(spark, path).drop("file", "offset"))


@pytest.fixture(scope="module")
def awkward_pages(spark):
    payloads = [None, "", "plain", "same", "same", "été\r\n\r\n", FAKE, FAKE + FAKE, f"a{FAKE}b{FAKE}c", "WARC/1.0\r\n",
                "WARC/1.0\r\nContent-Length: 5\r\n\r\n", "WARC/1.0", "\r\n\r\nWARC/1.0\r\n\r\n", "x" * 100_000, "same", "\r\n", "\x00"]
    rows = [(k, f"http://h/{k}\r\nX: y" if k % 3 else None, p) for k, p in enumerate(payloads)]
    rows += [(3, "u", "same"), (None, "u", "same"), (None, None, "only without id")]
    return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)


@pytest.mark.parametrize("split", ["128m", "200", "37"])
def test_awkward_pages(spark, awkward_pages, clashing, split):
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        path, found = round_trip(spark, clashing(awkward_pages))
        assert found == expected([(r.page_id, r.html) for r in awkward_pages.collect()])
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_given_pages_and_empty_table(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    assert round_trip(spark, pages)[1] == expected([(r.page_id, r.html) for r in pages.collect()])
    assert round_trip(spark, pages.limit(0))[1] == []


def test_files_are_archives_by_the_standard(spark, awkward_pages):
    path, found = round_trip(spark, awkward_pages)
    records = 0
    for (data,) in spark.read.format("binaryFile").load(f"{path}/part-*").select("content").collect():
        at = 0
        while at < len(data):
            assert data.startswith(b"WARC/1.0\r\n", at)
            begin, length, header = warc.parse(data[at + 10 :])
            assert {"warc-type", "warc-record-id", "warc-date", "content-length"} <= set(header)
            at += 10 + begin + length
            assert data[at : at + 4] == b"\r\n\r\n"
            at += 4
            records += 1
    assert records == len(found)


def test_least_bytes_and_damage(spark):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], "page_id long, url string, html string")
    path = scratch_path(spark)
    warc.write_archives(df.coalesce(1), path, least_bytes=3)
    found = {r.page_id: r for r in warc.read_archives(spark, path).collect()}
    assert [found[k].record_type for k in "1234"] == ["response", "response", "revisit", "response"]
    assert all(r.intact for r in found.values())
    (text,) = spark.read.text(f"{path}/part-*", wholetext=True).first()
    broken = scratch_path(spark)
    spark.createDataFrame([(text.replace("\r\n\r\nab\r\n", "\r\n\r\nxb\r\n", 1).removesuffix("\r\n\r\n"),)], "value string").write.option(
        "lineSep", "\r\n\r\n").text(broken)
    assert sorted(r.intact for r in warc.read_archives(spark, broken).collect()) == [False, True, True, True]


def test_other_splits_between_the_scans_raise(spark, tmp_path):
    """Records that hold magic lines are never left out in silence."""
    pages = spark.createDataFrame(
        [(k, f"http://a/{k}", f"<p>{k}</p>\nWARC/1.0\r\nno record\r\n" + "x" * 400) for k in range(200)], "page_id long, url string, html string")
    warc.write_archives(pages.coalesce(1), f"{tmp_path}/w")
    assert warc.read_archives(spark, f"{tmp_path}/w").count() == 200
    found = warc.read_archives(spark, f"{tmp_path}/w")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        with pytest.raises(Exception, match="split anew|add up"):
            found.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
