import gzip
import hashlib

import pytest

from careledger.llm import warc

LONG = "<html>" + "p" * 120 + "</html>"
ROWS = [(5, "http://a.example/x y\r\nWARC/1.1", LONG), (3, "http://b.example/é", LONG), (9, None, LONG), (7, "u", None), (8, "u", ""),
        (1, "u", "short"), (2, "u", "short"), (None, "u", LONG), (3, "http://b.example/é", LONG), (4, "u", "WARC/1.1\r\n\r\n" * 40),
        (6, "u", "é😀" * 50), (10, "u", "é😀" * 50), (11, "u", "z" * 300_000)]


def pages(spark, rows=ROWS):
    return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)


def test_report_matches_brute_force(spark):
    got = warc.archive_report(pages(spark)).collect()
    heads = {}
    for page, _, html in ROWS:
        if page is not None:
            heads[html or ""] = min(page, heads.get(html or "", page))
    want = []
    for page, _, html in ROWS:
        body = (html or "").encode()
        again = len(body) >= 100 and page != heads[html or ""]
        want.append((page, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response",
                     heads[html or ""] if again else None))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("options", [{}, {"compression": "none"}, {"fileBytes": "500"}])
def test_round_trip_and_pushdown(spark, tmp_path, options):
    records = warc.page_records(pages(spark))
    warc.write_warc(records, str(tmp_path / "w"), **options)
    want = {(r.record_id, r.record_type, bytes(r.payload) if r.payload is not None else None) for r in records.collect()}
    back = warc.read_warc(spark, str(tmp_path / "w"))
    assert {(r.record_id, r.record_type, bytes(r.payload) if r.payload is not None else None) for r in back.collect()} == want
    assert back.count() == len(ROWS)
    only = warc.read_warc(spark, str(tmp_path / "w"), ["record_id", "record_type", "target_uri"])
    assert only.where("record_type = 'revisit'").count() == sum(w[1] == "revisit" for w in want) + 0
    assert only.where("record_type <> 'revisit' and target_uri like 'http://b%'").count() == 2
    assert only.where("target_uri is null").count() == 1


def test_reader_decides_on_headers(monkeypatch):
    """A record whose headers fail a pushed predicate has its payload skipped, not decoded."""
    import io

    from pyspark.sql.datasource import EqualTo, GreaterThan
    from pyspark.sql.types import StructType

    data = b"".join(warc._record({"record_id": f"<{i}>", "record_type": k, "payload": b"x" * 50}) for i, k in
                    enumerate(["response", "resource", "response"]))
    reader = warc.WarcReader(StructType.fromDDL("record_id string, payload binary"), {"path": "p"})
    left = list(reader.pushFilters([EqualTo(("record_type",), "resource"), GreaterThan(("payload_bytes",), 3)]))
    assert [type(f).__name__ for f in left] == ["GreaterThan"]
    assert list(reader._records(io.BufferedReader(io.BytesIO(data)), "p")) == [("<1>", b"x" * 50)]


def test_foreign_archive_in_one_gzip_member(spark, tmp_path):
    head = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <a>\r\nContent-Type: application/warc-fields\r\n" \
           b"WARC-Folded: x\r\n  y\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    (tmp_path / "f").mkdir()
    with gzip.open(tmp_path / "f" / "one.warc.gz", "wb") as out:
        out.write(head * 3)
    back = warc.read_warc(spark, str(tmp_path / "f")).collect()
    assert [(r.record_type, bytes(r.payload), r.payload_bytes) for r in back] == [("warcinfo", b"hello", 5)] * 3


def test_cut_off_record_raises(spark, tmp_path):
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "one.warc").write_bytes(b"WARC/1.0\r\nWARC-Type: resource\r\nContent-Length: 50\r\n\r\nhello")
    with pytest.raises(Exception, match="cut off"):
        warc.read_warc(spark, str(tmp_path / "f")).collect()


def test_empty_table(spark):
    assert warc.archive_report(pages(spark).limit(0)).count() == 0
