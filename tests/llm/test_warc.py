"""Archives against the pages that they were written from."""

import base64
import hashlib

import pytest

from panelcast.llm.queries import op3_warc
from panelcast.llm.warc import RECORD_SCHEMA, read_archives, write_archives
from panelcast.session import new_path

INNER = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"


def expected(rows, least=0):
    best = {}
    for page, _, html in rows:
        best[html or ""] = max(best.get(html or "", -1), -1 if page is None else page)
    out = []
    for page, url, html in rows:
        data = (html or "").encode()
        again = len(data) >= least and best[html or ""] not in (-1, page)
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        uri = None if url is None else url.replace("\r", "%0D").replace("\n", "%0A")
        out.append((page, len(data), digest, "revisit" if again else "response", best[html or ""] if again else None, uri))
    return sorted(out, key=repr)


def pages(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "page_id long, url string, html string, keeper long, sha string")


def read(spark, path):
    names = [f.split()[0] for f in RECORD_SCHEMA.split(", ")]
    return sorted((tuple(r[n] for n in names) for r in read_archives(spark, path).collect()), key=repr)


TRAPS = [INNER * 3, "x" + INNER + "y", "WARC/1.1\r\nfoo", "", None, "same", "WARC/1.1\r\n" * 20, "é漢\r\n\r\n", INNER, "WARC/1.1\r", "WARC/1.1"]


def rows():
    out = [(k, f"http://a.b/{k}", TRAPS[k % len(TRAPS)] if k % 3 else f"page {k} " * (k % 40)) for k in range(150)]
    return [*out, (None, None, "same"), (7000, "a\r\nb", "é" * 50), (3, "http://a.b/3", out[3][2]), (None, "u", "only here")]


@pytest.mark.parametrize("split", ["128m", "2000"])
def test_magic_inside_payloads_opens_no_record(spark, split):
    before = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    path = new_path(spark, "archives")
    write_archives(pages(spark, rows()).repartition(3), path)
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "100")
        assert read(spark, path) == expected(rows())
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)


def test_small_payloads_are_all_responses(spark):
    path = new_path(spark, "archives")
    write_archives(pages(spark, rows()), path, 100)
    assert read(spark, path) == expected(rows(), 100)


def test_no_pages(spark):
    path = new_path(spark, "archives")
    write_archives(pages(spark, []), path)
    assert read(spark, path) == []


def test_damage_raises(spark, tmp_path):
    path = new_path(spark, "archives")
    write_archives(pages(spark, rows()[:20]).coalesce(1), path)
    text = "".join(r["value"] for r in spark.read.option("wholetext", True).text(path).collect())
    for k, broken in enumerate((text[:-30], text + "trailing", text.replace("page 9", "page 8", 1))):
        (tmp_path / str(k)).mkdir()
        (tmp_path / str(k) / "part-0").write_bytes(broken.encode())
        with pytest.raises(Exception, match="chain of records|payload differs"):
            read(spark, str(tmp_path / str(k)))


def test_records_of_other_writers(spark, tmp_path):
    """A crawl's head, a request, a response without our headers, a resource, and a fake damaged response inside a payload."""
    fake = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Payload-Digest: sha1:WRONG\r\nWARC-Payload-Length: 1\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"

    def record(kind, block, *headers):
        head = "".join(f"{h}\r\n" for h in (f"WARC-Type: {kind}", *headers, f"Content-Length: {len(block.encode())}"))
        return f"WARC/1.1\r\n{head}\r\n{block}\r\n\r\n"

    http = "HTTP/1.1 200 OK\r\nX: y\r\n\r\n"
    parts = [
        record("warcinfo", "software: some crawler\r\n"), record("request", "GET / HTTP/1.1\r\n\r\n", "WARC-Target-URI: http://a.b/"),
        record("response", http + "<p>é</p>", "WARC-Record-ID: <urn:uuid:12>", "WARC-Target-URI: http://a.b/", "WARC-Payload-Digest: md5:abc"), record("resource", "raw" + fake, "WARC-Record-ID: <urn:uuid:13>"),
        record("revisit", http, "WARC-Refers-To: <urn:uuid:12>"), record("metadata", ""),
    ]
    (tmp_path / "a.warc").write_bytes("".join(parts).encode())
    sha = lambda text: base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()
    want = [
        (None, 24, sha("software: some crawler\r\n"), "warcinfo", None, None), (None, 18, sha("GET / HTTP/1.1\r\n\r\n"), "request", None, "http://a.b/"),
        (None, 9, sha("<p>é</p>"), "response", None, "http://a.b/"), (None, len("raw" + fake), sha("raw" + fake), "resource", None, None),
        (None, None, None, "revisit", None, None), (None, 0, sha(""), "metadata", None, None),
    ]
    assert read(spark, str(tmp_path)) == sorted(want, key=repr)


def test_given_pages(spark, sf):
    given = [tuple(r) for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html").collect()]
    assert sorted((tuple(r) for r in op3_warc(spark, sf).collect()), key=repr) == sorted((r[:5] for r in expected(given)), key=repr)
