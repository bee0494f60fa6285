import base64
import gzip
import hashlib

import pytest
from pyspark.sql import types as T

from ebbtide.llm.warc import address, members, parse, read_archives, write_archives

SCHEMA = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
        T.StructField("rows", T.StringType()),
        T.StructField("payload", T.StringType()),
        T.StructField("copy", T.LongType()),
    ]
)


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 9) for r in rows], SCHEMA)


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


ROWS = [
    (1, "http://a/", "same"),
    (2, "http://b/", "same"),
    (3, "http://c/", None),
    (4, None, ""),
    (5, "http://e/\r\nWARC-Type: x é", "line\r\n\r\nWARC/1.1\r\n\r\nContent-Length: 3\r\n"),
    (6, "http://f/", "é\U0001f600" * 50_000),
    (7, "http://g/", "twice"),
    (7, "http://g/", "twice"),
    (7, "http://h/", "twice"),
    (None, "http://n/", "twice"),
    (None, None, "none"),
]


def test_round_trip_of_awkward_rows(spark):
    files = write_archives(pages(spark, ROWS).repartition(3), file_bytes=20_000)
    rows = read_archives(files).collect()
    assert sum(r.records for r in files.collect()) == len(rows) == len(ROWS)
    got = sorted(
        repr((r.page_id, r.payload_bytes, r.payload_digest)) for r in rows
    )
    assert got == sorted(
        repr((i, len((h or "").encode()), digest(h))) for i, _, h in ROWS
    )
    by_digest = {}
    for r in rows:
        by_digest.setdefault(r.payload_digest, []).append(r)
    for same in by_digest.values():
        responses = [r for r in same if r.record_type == "response"]
        assert len(responses) == 1
        best = responses[0]
        assert hashlib.sha1(best.payload).digest() == base64.b32decode(best.payload_digest)
        for r in same:
            if r.record_type == "revisit":
                assert r.refers_to == best.page_id and r.payload is None
                assert r.page_id is None or r.page_id <= best.page_id
    first = next(r for r in by_digest[digest("twice")] if r.record_type == "response")
    assert (first.page_id, first.url) == (7, "http://h/")


def test_short_payloads_are_never_revisits(spark):
    rows = read_archives(write_archives(pages(spark, ROWS), least_bytes=5)).collect()
    kinds = {}
    for r in rows:
        kinds.setdefault(r.payload_digest, []).append(r.record_type)
    assert kinds[digest("same")] == ["response"] * 2
    assert kinds[digest("")] == ["response"] * 2
    assert sorted(kinds[digest("twice")]) == ["response"] + ["revisit"] * 3


def test_short_equal_rows_keep_their_number(spark):
    rows = read_archives(write_archives(pages(spark, [(1, "u", "ab")] * 4), least_bytes=3))
    assert [(r.record_type, r.payload) for r in rows.collect()] == [("response", b"ab")] * 4


def test_empty_table(spark):
    files = write_archives(pages(spark, []))
    assert files.collect() == [] and read_archives(files).collect() == []


def test_archives_are_plain_warc(spark, tmp_path):
    folder = (tmp_path / "out").as_uri()
    files = write_archives(pages(spark, ROWS).coalesce(1), folder=folder).collect()
    assert files and all(f.path.startswith("file:///") for f in files)
    ids = set()
    for f in files:
        path = f.path.removeprefix("file://")
        with open(path, "rb") as stream:
            records = [parse(raw) for raw in members(stream, chunk=100)]
        assert records[0][0]["warc-type"] == "warcinfo"
        assert gzip.open(path).read().startswith(b"WARC/1.1\r\n")
        for fields, _ in records[1:]:
            assert fields["warc-record-id"] not in ids
            ids.add(fields["warc-record-id"])
            if fields["warc-type"] == "revisit":
                assert fields["warc-profile"].endswith("identical-payload-digest")
    assert len(ids) == len(ROWS)


def test_damage_is_found(spark, tmp_path):
    files = write_archives(pages(spark, ROWS[:1]), folder=(tmp_path / "d").as_uri())
    path = files.collect()[0].path.removeprefix("file://")
    data = open(path, "rb").read()
    open(path, "wb").write(data[:-5])
    with pytest.raises(Exception):
        read_archives(files).collect()
    assert address("a b\r\n") == "a%20b%0D%0A"
