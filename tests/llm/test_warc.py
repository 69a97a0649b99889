from __future__ import annotations

import hashlib
import re

import pytest
from moodframe.llm import warc
from moodframe.session import scratch_path

PAGES = "page_id long, url string, html string"


def archived(spark, rows, schema=PAGES):
    path = scratch_path(spark, "warc")
    warc.write_archive(spark.createDataFrame(rows, schema), path)
    return path


def test_facts_by_hand(spark):
    long_, other = "é" * 60, "x" * 99
    rows = [(5, "u5", long_), (2, "u2", long_), (9, None, long_), (3, "u3", other), (4, "u4", other), (1, "", None), (7, "u\r\n7 ", "")]
    path = archived(spark, rows)
    got = {r.id: (r.url, r.payload_bytes, r.record_type, r.refers_to, r.payload_digest) for r in warc.read_archive(spark, path).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got == {
        5: ("u5", 120, "revisit", 2, sha(long_)), 2: ("u2", 120, "response", None, sha(long_)), 9: (None, 120, "revisit", 2, sha(long_)),
        3: ("u3", 99, "response", None, sha(other)), 4: ("u4", 99, "response", None, sha(other)),
        1: ("", 0, "response", None, sha("")), 7: ("u\r\n7 ", 0, "response", None, sha(""))}
    assert spark.read.parquet(f"{path}/payloads").count() == 3  # each payload once


def test_exact_round_trip_through_warc_files(spark):
    rows = [(i, f"http://h{i % 3}/a%20b?{i}", "line\r\n\r\nWARC/1.1\r\n" * (i % 7)) for i in range(40)]
    records = warc.read_archive(spark, archived(spark, rows))
    out = scratch_path(spark, "files")
    warc.export_warc(records, out)
    data = b"".join(bytes(r.content) for r in spark.read.format("binaryFile").load(out + "/part-*").collect())
    found, at = {}, 0
    while at < len(data):  # a plain reader of WARC files
        end = data.index(b"\r\n\r\n", at)
        fields = dict(x.split(": ", 1) for x in data[at:end].decode().split("\r\n")[1:])
        size = int(fields["Content-Length"])
        found[fields["WARC-Record-ID"]] = fields, data[end + 4:end + 4 + size]
        at = end + 8 + size
        assert data[at - 4:at] == b"\r\n\r\n"
    assert len(found) == 40
    for fields, body in found.values():
        id_ = int(re.match(r"<urn:record:(\d+):", fields["WARC-Record-ID"])[1])
        assert fields["WARC-Target-URI"] == rows[id_][1]
        if fields["WARC-Type"] == "revisit":
            body = found[fields["WARC-Refers-To"]][1]
        assert body == rows[id_][2].encode()
    assert {bytes(r.record) for r in records.collect()} == {
        data[m:m + n] for m, n in _spans(data)}


def _spans(data):
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at) + 4
        size = int(re.search(rb"Content-Length: (\d+)", data[at:end])[1])
        yield at, end + size + 4 - at
        at = end + size + 4


def test_ties_nulls_and_clashing_names(spark):
    text = "t" * 200
    rows = [(1, "b", text, "x", 1), (1, "b", text, "x", 1), (1, "a", text, None, None), (None, "a", text, None, None), (None, None, None, None, None)]
    path = archived(spark, rows, PAGES + ", digest string, payload int")
    got = sorted(((r.id, r.url, r.record_type, r.refers_to) for r in warc.read_archive(spark, path).collect()), key=str)
    assert got == sorted([(1, "a", "response", None), (1, "b", "revisit", 1), (1, "b", "revisit", 1), (None, "a", "revisit", 1),
                          (None, None, "response", None)], key=str)


def test_copies_beyond_one_task(spark):
    rows = [(i, "u", "same " * 40) for i in range(warc.HOT * 2 + 5)] + [(10 ** 6, "u", "other " * 40)]
    got = warc.read_archive(spark, archived(spark, rows))
    assert got.groupBy("record_type", "refers_to").count().collect().__len__() == 2
    assert got.filter("record_type = 'revisit' and refers_to = 0").count() == warc.HOT * 2 + 4


def test_damage_is_an_error(spark):
    path = archived(spark, [(1, "u", "z" * 150)])
    bad = spark.read.parquet(f"{path}/payloads").selectExpr("digest", "cast('other' as binary) AS payload")
    broken = scratch_path(spark, "warc")
    bad.write.parquet(f"{broken}/payloads")
    warc.read_headers(spark, path).select("block").withColumnRenamed("block", "value").write.option("lineSep", "\r\n\r\n").text(f"{broken}/headers")
    with pytest.raises(Exception, match="does not match"):
        warc.read_archive(spark, broken).collect()


def test_long_payload_and_empty_table(spark):
    long_ = "é中\n" * 300_000
    got = warc.read_archive(spark, archived(spark, [(1, "u", long_)])).first()
    assert got.payload.decode() == long_ and got.payload_bytes == len(long_.encode())
    assert warc.read_archive(spark, archived(spark, [])).count() == 0
