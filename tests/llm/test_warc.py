import base64
import hashlib
import random

import pytest
from made import got
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewire.llm import warc as op
from tidewire.llm.common import staged_path


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def brute(rows, least=0):
    first = {}
    for page, _, html in rows:
        h = html or ""
        first[h] = min((x for x in (first.get(h), page) if x is not None), default=None)
    out = []
    for page, _, html in rows:
        h = html or ""
        again = len(h.encode()) >= least and first[h] is not None and page != first[h]
        out.append((page, len(h.encode()), digest(h), "revisit" if again else "response", first[h] if again else None))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    html = ["", None, "<p>é\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nx</p>", "a\n", "<p>x</p>", "\x00\x01", "y" * 200_000]
    out = [(i, rng.choice(["http://www.Example.com/a?b=2&a=1#f", "https://example.com:443/a?a=1&b=2", "http://b.org/x", "http://é.org/ü x\n", None, "no url", "http://[bad"]), rng.choice(html)) for i in range(120)]
    return [*out, out[0], (None, "http://b.org/x", "a\n"), (None, None, "only here"), (None, None, "only here")]


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, rows, least):
    pages = spark.createDataFrame([(*r, "clash", 1) for r in rows], "page_id long, url string, html string, sha string, n int").repartition(4)
    path = staged_path(spark, "archives")
    op.write_archives(pages, path, least, archive_bytes=40_000)
    out = op.merge_index(op.read_archives(spark, path), rows=20).collect()
    assert all(r.checked for r in out) and len({r.archive for r in out}) > 4
    found = sorted(((int(x) if (x := op._id(r.record.encode())) else None, r.payload_bytes, r.payload_digest, r.record_type, int(r.refers_to) if r.refers_to else None) for r in out), key=repr)
    assert found == brute(rows, least)
    out.sort(key=lambda r: r.position)
    assert [r.position for r in out] == list(range(len(rows)))
    keys = [(r.url_key, r.captured, r.record) for r in out]
    assert keys == sorted(keys)


def test_archives_are_bounded(spark, monkeypatch):
    """Sizes spread over four orders, large pages side by side: no archive is much over SPREAD times its size, or one record."""
    import glob
    import os

    sizes = [200 + i for i in range(300)] + [9_000 + i for i in range(40)] + [60_000 + i for i in range(30)] + [900_000]
    rows = [(i, f"http://x.org/{i}", "z" * n) for i, n in enumerate(sizes)] + [(1000, None, "z" * 60_000)]
    path = staged_path(spark, "archives")
    monkeypatch.setattr(op, "MAX_DIGESTS", 0)  # digests that aren't broadcast give the same
    op.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2), path, archive_bytes=20_000)
    files = [os.path.getsize(f) for f in glob.glob(path.removeprefix("file://") + "/*.txt")]
    assert max(x for x in files if x < 900_000) <= 4 * 20_000 + 2 * 61_000 and sum(x > 900_000 for x in files) == 1 and max(files) < 902_000
    monkeypatch.setattr(op, "MAX_RANGES", 3)
    out = op.merge_index(op.read_archives(spark, path), rows=20).collect()
    assert sorted(((int(op._id(r.record.encode())), r.payload_bytes, r.payload_digest, r.record_type, int(r.refers_to) if r.refers_to else None) for r in out), key=repr) == brute(rows)
    assert sorted(r.position for r in out) == list(range(len(rows)))


def test_query_columns(spark, tmp_path, rows):
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    assert got(op.op9_warc(spark, str(tmp_path)), "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == brute(rows)
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(str(tmp_path / "none" / "pages.parquet"))
    assert op.op9_warc(spark, str(tmp_path / "none")).collect() == []


@settings(deadline=None)
@given(st.lists(st.lists(st.integers(0, 9)), max_size=9))
def test_loser_tree(runs):
    runs = [sorted(r) for r in runs]
    assert list(op.LoserTree(runs)) == sorted(x for r in runs for x in r)


def test_url_keys():
    assert op.url_key("http://www.Example.com/A?b=2&a=1#x") == op.url_key("https://example.com:443/a?a=1&b=2") == "com,example)/a?a=1&b=2"
    assert op.url_key("http://x.org:8080") == "org,x:8080)/"


def test_broken_archives():
    good = b"WARC/1.1\r\nContent-Length: 2\r\n\r\nab\r\n\r\n"
    assert [(a, n, b) for a, n, _, b in op.records(good + good)] == [(0, len(good), b"ab"), (len(good), len(good), b"ab")]
    for bad in (b"XARC/1.1\r\nContent-Length: 2\r\n\r\nab\r\n\r\n", good[:-3] + b"..."):
        with pytest.raises(ValueError, match="record at byte|no WARC record"):
            list(op.records(bad))
