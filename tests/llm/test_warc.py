import hashlib

from tests.llm.samples import words
from tidedesk.llm import warc
from tidedesk.llm.common import shared_folder
from tidedesk.llm.warc import archive_pages, dechunk, read_archives, write_archives


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "x") for r in rows], "page_id long, url string, html string, digest string, record string")


ROWS = [
    (5, "http://a/5", words(1, 100)),
    (3, "http://a/3", words(1, 100)),
    (3, "http://a/3", words(1, 100)),
    (7, None, words(1, 100)),
    (None, "u", words(1, 100)),
    (8, "http://a/8\r\nX: y", None),
    (9, "", ""),
    (10, "u", "short"),
    (11, "u", "short"),
    (12, "u", "é" * 49 + "x"),
    (13, "u", "é" * 49 + "x"),
    (14, "u", "é" * 50),
    (15, "u", "é" * 50),
    (16, "u", "line\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n0\r\n\r\nafter " * 20),
    (17, "u", "ñ" * 100_001),
    (18, "u", "WARC/1.1\r\n"),
]


def expected(rows):
    least = {}
    for page_id, _, html in rows:
        if page_id is not None:
            least[html] = min(page_id, least.get(html, page_id))
    out = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        first = least.get(html) if len(payload) >= 100 else None
        refers = first if first is not None and first != page_id else None
        kind = "response" if refers is None else "revisit"
        out.append((page_id, len(payload), hashlib.sha256(payload).hexdigest(), kind, refers, True))
    return sorted(out, key=str)


def test_round_trip(spark):
    got = sorted(map(tuple, archive_pages(pages(spark, ROWS)).collect()), key=str)
    assert got == expected(ROWS)


def test_payloads_come_back_whole(spark, monkeypatch):
    monkeypatch.setattr(warc, "SEGMENT_BYTES", 64)
    monkeypatch.setattr(warc, "CHUNK_BYTES", 33)
    path = shared_folder(spark, "warc")
    rows = [r for r in ROWS if r[0] != 17]
    write_archives(pages(spark, rows), path)
    out = read_archives(spark, path).where("record_type = 'response'").collect()
    texts = {str(p): h or "" for p, _, h in rows}
    assert all(bytes(r["payload"]).decode() == texts.get(r["page"], words(1, 100)) and r["sound"] for r in out)
    assert {"16", "3", "18"} <= {r["page"] for r in out}


def test_missing_pieces_are_told(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "SEGMENT_BYTES", 1000)
    path = str(tmp_path / "warc")
    write_archives(pages(spark, [(1, "u", words(2, 1000))]), path)
    whole = spark.read.option("lineSep", warc.END + "WARC").text(path)
    text = "".join(r[0] for r in spark.read.text(path, wholetext=True).collect())
    cut = text.split("WARC/1.1\r\n")
    assert whole.count() > 3
    (tmp_path / "cut").mkdir()
    (tmp_path / "cut" / "a.warc").write_bytes("WARC/1.1\r\n".join(cut[:2] + cut[3:]).encode())
    assert [r["sound"] for r in read_archives(spark, str(tmp_path / "cut")).collect()] == [False]


def test_dechunk():
    assert dechunk(b"3\r\nabc\r\nA;x=y\r\n0123456789\r\n0\r\n\r\n") == (b"abc0123456789", True)
    assert dechunk(b"0\r\n\r\n") == (b"", True)
    assert dechunk(b"5\r\nabc") == (b"", False)
    assert dechunk(b"zz\r\nabc\r\n0\r\n\r\n") == (b"", False)


def test_empty_table(spark):
    assert archive_pages(pages(spark, [])).count() == 0


def foreign(version, kind, fields, block, length=True):
    head = [f"WARC/{version}", f"WARC-Type: {kind}", *fields, *([f"Content-Length: {len(block)}"] if length else [])]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def test_archives_of_others(spark, tmp_path):
    import gzip

    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n"
    body = "<p>It says WARC/1.0\r\nand WARC/1.1\r\n in a line. ñ</p>".encode()
    records = [
        foreign("1.0", "warcinfo", ["WARC-Record-ID: <urn:uuid:0>"], b"software: x\r\n"),
        foreign("1.0", "response", ["WARC-Record-ID: <urn:uuid:1>", "X-Page-Id: 1", "WARC-Payload-Digest: sha1:ABC"], http + body),
        foreign("1.1", "response", ["WARC-Record-ID: <urn:uuid:2>", "X-Page-Id: 2"], http + b"two"),
        foreign("1.0", "response", ["WARC-Record-ID: <urn:uuid:3>", "X-Page-Id: 3"], http + b"no length", length=False),
        foreign("1.0", "response", ["WARC-Record-ID: <urn:uuid:4>", "X-Page-Id: 4", "Content-Length: many"], http + b"bad length", length=False),
        foreign("1.0", "response", ["WARC-Record-ID: <urn:uuid:5>", "X-Page-Id: 5", "X-Payload-Length: 9"], http + b"wrong"),
    ]
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(b"".join(records)))
    got = {r["page"]: r for r in read_archives(spark, str(tmp_path)).collect()}
    assert {p: (bytes(r["payload"]), r["sound"]) for p, r in got.items()} == {
        "1": (body, True),
        "2": (b"two", True),
        "3": (b"no length", False),
        "4": (b"bad length", False),
        "5": (b"wrong", False),
    }
