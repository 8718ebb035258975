import glob
import gzip
import hashlib
import io
from collections import Counter

import pytest

from starloom.llm import common, warc


def expected(rows):
    """(page_id, bytes, digest, type, refers_to) by the contract, with plain loops."""
    raw = [(i, (h or "").encode()) for i, h in rows]
    least = {}
    for i, p in raw:
        if i is not None:
            least[p] = min(least.get(p, i), i)
    out = []
    for i, p in raw:
        own = hashlib.sha256(p).hexdigest()
        first = least.get(p) if len(p) >= 100 else None
        again = first is not None and first != i and sum(q == p for _, q in raw) > 1
        out.append((i, len(p), own, "revisit" if again else "response", first if again else None))
    return Counter(out)


def read_back(index, root):
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return Counter(tuple(r[c] for c in names) for r in warc.read_records(index, root, with_payload=False).collect())


LONG, EDGE, SMALL = "é" * 400, "x" * 100, "y" * 99
ROWS = [
    (5, "http://a/ b\r\nc é", LONG), (3, "http://a", LONG), (None, None, LONG), (3, "again", LONG), (9, None, EDGE), (8, "u", EDGE),
    (1, "u", SMALL), (2, "u", SMALL), (4, "u", None), (6, "u", ""), (None, "n", "z" * 200), (None, "n", "z" * 200), (7, "u", "\r\n\r\nWARC/1.1\r\n" * 40),
    (10, "big", "<p>" + "0123456789abcdef" * 200_000),
]
SCHEMA = "page_id long, url string, html string, payload_digest string, offset int, first string"


def frame(spark, rows=ROWS):
    return spark.createDataFrame([(*r, "clash", 1, None) for r in rows], SCHEMA)


@pytest.mark.parametrize("limit", [warc.BROADCAST_PAYLOADS, 0])
def test_defined_results_by_broadcast_and_by_shuffle(spark, monkeypatch, limit):
    monkeypatch.setattr(warc, "BROADCAST_PAYLOADS", limit)
    index, root = warc.write_archives(frame(spark))
    assert read_back(index, root) == expected([(r[0], r[2]) for r in ROWS])
    whole = warc.read_payloads(index, index, root).collect()
    assert Counter((r["page_id"], r["url"], bytes(r["payload"]).decode()) for r in whole) == Counter((a, u, h or "") for a, u, h in ROWS)


def test_hot_payload_is_split_off(spark, monkeypatch):
    monkeypatch.setattr(warc, "BROADCAST_PAYLOADS", 0)
    monkeypatch.setattr(warc, "HOT_SHARE", 2)
    rows = [(i, "u", LONG if i % 3 else f"{i // 6:0120d}") for i in range(120)]
    index, root = warc.write_archives(frame(spark, rows))
    assert read_back(index, root) == expected([(r[0], r[2]) for r in rows])


def test_empty_table(spark):
    index, root = warc.write_archives(spark.createDataFrame([], SCHEMA))
    assert index.count() == 0 and warc.read_records(index, root).count() == 0


def sequential(path):
    """All records of an archive from its start, without the index: (offset, length, fields, block)."""
    raw, at, out = open(path, "rb").read(), 0, []
    while at < len(raw):
        member = io.BytesIO(raw[at:])
        import zlib

        d = zlib.decompressobj(31)
        whole = d.decompress(member.read())
        size = len(raw) - at - len(d.unused_data)
        out.append((at, size, *warc.parse_record(whole)))
        at += size
    return out


def test_archives_are_plain_warc_files_and_agree_with_the_index(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 20_000)
    index, root = warc.write_archives(common.table(spark, "/root/testdata/sf0.001", "pages"))
    folder = warc.filesystem(root)[1]
    paths = glob.glob(f"{folder}/archives/*.warc.gz")
    assert len(paths) > 1
    seen = set()
    for p in paths:
        records = sequential(p)
        assert records[0][2]["warc-type"] == "warcinfo"
        assert gzip.open(p).read().count(b"WARC/1.1\r\n") >= len(records)  # the whole file is one gzip stream
        seen |= {(p.rsplit("/", 1)[1], at, size, f["warc-payload-digest"][7:], f.get("warc-target-uri")) for at, size, f, _ in records[1:]}
    assert seen == {tuple(r) for r in index.select("archive", "offset", "length", "payload_digest", "url").collect()}


def test_selection_reads_only_what_it_needs(spark):
    pages = common.table(spark, "/root/testdata/sf0.001", "pages")
    index, root = warc.write_archives(pages)
    some = index.where("page_id % 7 = 3 OR url LIKE '%example.net%'")
    got = {r["page_id"]: bytes(r["payload"]).decode() for r in warc.read_records(some, root).collect()}
    want = {r["page_id"]: r["html"] for r in pages.where("page_id % 7 = 3 OR url LIKE '%example.net%'").collect()}
    assert got == want and len(got) < pages.count()


def test_ranges_are_merged():
    places = [("a", 0, 10), ("a", 10, 5), ("a", 30, 5), ("a", 100, 5), ("b", 106, 4), ("b", 110, 90), ("b", 200, 1)]
    got = list(warc.coalesce_ranges(iter(places), gap=15, most=50))
    assert [(a, s, e, len(own)) for a, s, e, own in got] == [("a", 0, 35, 3), ("a", 100, 105, 1), ("b", 106, 110, 1), ("b", 110, 200, 1), ("b", 200, 201, 1)]
    assert list(warc.coalesce_ranges(iter([]))) == []


def test_damaged_archive_is_noticed(spark):
    index, root = warc.write_archives(frame(spark, [(1, "u", "a" * 300)]))
    wrong = index.selectExpr("archive", "offset", "length", "url", "repeat('0', 64) AS payload_digest")
    with pytest.raises(Exception, match="does not hold the payload"):
        warc.read_records(wrong, root).collect()
