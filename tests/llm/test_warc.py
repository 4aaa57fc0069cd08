import base64
import gzip
import hashlib
import json
from pathlib import Path
from urllib.parse import urlparse

import pytest
from lattica.llm import warc
from lattica.llm.common import new_path, table
from pyspark.sql import functions as F


def expected(rows, least=0):
    first = {}
    for i, _, h in rows:
        h = h or ""
        if i is not None:
            first[h] = min(i, first.get(h, i))
    out, seen = [], set()
    for i, _, h in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        p = (h or "").encode()
        again = h in seen if h else "" in seen
        seen.add(h or "")
        revisit = again and len(p) >= least
        out.append((i or 0, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "revisit" if revisit else "response", (first.get(h or "") or 0) if revisit else None))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.page_id or 0, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=str)


PAGES = [(5, "http://a/\r\nX: y", "same"), (3, "http://b/", "same"), (9, None, None), (7, "http://c/", ""), (1, "http://d/é", "héllo \U0001f600" * 9000), (None, "u", "only"), (None, "u", "same"), (11, "r", "\r\n\r\nWARC/1.1\r\n"), (12, "s", "x" * 3_000_000)]


def pages(spark, rows=PAGES):
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"bytes": F.lit(1), "sha1": F.lit("x"), "row": F.lit(2)})


@pytest.mark.parametrize("least", [0, 10])
@pytest.mark.parametrize("file_bytes", [1, 1 << 26])
def test_awkward_pages(spark, least, file_bytes):
    assert result(warc.round_trip(pages(spark), min_bytes=least, file_bytes=file_bytes, hot_keys=2 + least)) == expected(PAGES, least)


def test_repeated_rows_have_one_response(spark):
    rows = [(4, "u", "same")] * 3
    assert sorted(r[3:] for r in result(warc.round_trip(pages(spark, rows)))) == [("response", None), ("revisit", 4), ("revisit", 4)]


def test_real_pages(spark, sf):
    df = table(spark, sf, "pages")
    assert result(warc.round_trip(df)) == expected([(r.page_id, r.url, r.html) for r in df.collect()])


def test_members_stand_alone_and_hold_the_payloads(spark):
    folder = new_path(spark, "warc-test")
    files = warc.normalise(warc.write(pages(spark), f"{folder}/in"), f"{folder}/out")
    n = 0
    for r in files.collect():
        data = Path(urlparse(r.path).path).read_bytes()
        index = [json.loads(x) for x in Path(urlparse(r.path).path + ".idx").read_text().splitlines()]
        assert [x["offset"] for x in index] == [sum(y["length"] for y in index[:i]) for i in range(len(index))]
        assert sum(x["length"] for x in index) == len(data)
        for x in index:
            assert gzip.decompress(data[x["offset"] : x["offset"] + x["length"]]).startswith(b"WARC/1.1\r\n")
        n += len(index)
    assert n == len(PAGES)
    by = {r.page_id: r.payload for r in warc.read(files, with_payload=True).collect()}
    assert bytes(by[1]).decode() == PAGES[4][2] and by[5] is None and bytes(by[12]) == b"x" * 3_000_000


def test_empty_table(spark):
    assert warc.round_trip(pages(spark, [])).collect() == []
