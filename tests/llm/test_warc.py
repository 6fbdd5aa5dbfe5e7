import gzip
import hashlib

from clickfeat.llm import warc

LONG = "<p>" + "long page text " * 20


def resolve(spark, tmp_path, rows):
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, _key string")
    first, second = str(tmp_path / "a"), str(tmp_path / "b")
    warc.write_archives(warc.page_records(pages), first)
    warc.deduplicate_archives(spark, first, second)
    return first, second


def test_round_trip_and_resolution(spark, tmp_path):
    rows = [
        (3, "http://a/", LONG, "k"), (1, "http://b/", LONG, "k"), (2, None, LONG + "x", None), (4, "u\r\nv", "short", "k"),
        (5, "", "short", ""), (6, "n", None, "k"), (7, "e", "", "k"), (8, "c", "a\r\n\r\nWARC/1.1\r\n\r\n" * 20, "k"),
        (9, "c", "a\r\n\r\nWARC/1.1\r\n\r\n" * 20, "k"), (10, "ü", "ü漢🙂" * 30, "k"), (11, "big", "b" * 9_000_000, "k"),
        (12, "edge", "y" * 99, "k"), (13, "edge", "y" * 99, "k"), (14, "edge", "z" * 100, "k"), (15, "edge", "z" * 100, "k"),
    ]
    first, second = resolve(spark, tmp_path, rows)
    stored = {r["record_id"]: r for r in warc.read_archives(spark, first).collect()}
    for page, _, html, _ in rows:
        assert stored[f"<urn:page:{page}>"]["payload"] == (html or "")
    got = {r["record_id"]: r for r in warc.full_payloads(spark, second).collect()}
    assert len(got) == len(rows)
    seen = {}
    for page, _, html, _ in sorted(rows, key=lambda r: r[0]):
        raw = (html or "").encode()
        original = seen.setdefault(raw, page) if len(raw) >= 100 else page
        r = got[f"<urn:page:{page}>"]
        assert r["payload_digest"] == hashlib.sha256(raw).hexdigest() and r["payload_length"] == len(raw)
        assert r["record_type"] == ("response" if original == page else "revisit")
        assert r["refers_to"] == (None if original == page else f"<urn:page:{original}>")
    payloads = {r["record_id"]: r["payload"] for r in warc.read_archives(spark, second).collect()}
    assert payloads["<urn:page:3>"] == "" and payloads["<urn:page:1>"] == LONG


def test_many_copies_of_one_page(spark, tmp_path):
    rows = [(i, "u", LONG if i % 3 else f"{LONG}{i}", "k") for i in range(600)]
    got = warc.full_payloads(spark, resolve(spark, tmp_path, rows)[1]).collect()
    assert len(got) == 600
    assert sum(r["record_type"] == "revisit" for r in got) == 399
    assert {r["refers_to"] for r in got} == {None, "<urn:page:1>"}


def test_rows_without_ids_and_repeated_rows(spark, tmp_path):
    rows = [(1, "u", LONG, "k"), (1, "u", LONG, "k"), (1, "u", LONG + "2", "k"), (None, "u", LONG, "k"), (None, None, None, None)]
    got = warc.full_payloads(spark, resolve(spark, tmp_path, rows)[1]).collect()
    assert len(got) == 5
    assert sorted(r["payload_length"] for r in got) == [0, *[len(LONG)] * 3, len(LONG) + 1]


def test_no_pages(spark, tmp_path):
    assert warc.full_payloads(spark, resolve(spark, tmp_path, [])[1]).collect() == []


def test_archives_of_several_gzip_members():
    record = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n"
    content = b"".join(gzip.compress(record % (len(p), p)) for p in (b"one", b"", b"x" * 400_000, b"\r\n\r\n"))
    assert [p for _, p in warc.parse_archive(content)] == [b"one", b"", b"x" * 400_000, b"\r\n\r\n"]
