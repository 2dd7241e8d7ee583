import time
import zlib

import pytest

from postweave.llm import warc

PAGE = """<!DOCTYPE html><html lang="EN-gb"><head><title>A &amp; <b>B</b></title><style>p{x}</style><script>var a="</p><a href='no'>";</script></head>
<body><!-- <a href="hidden"> --><p>One &lt;two&gt;&nbsp; three<br>four</p><div>five <a href="/x?a=1&amp;b=2">six</a></div><a href='http://o.org/'>seven</a><a href=rel>8</a></body></html>"""


def test_plain_text_and_metadata():
    assert warc.plain_text(PAGE) == "A & B\nOne <two> three\nfour\nfive six\nseven8"
    assert warc.page_metadata(PAGE, "http://h.net/d/e") == [
        ("title", "A & B"),
        ("language", "en-gb"),
        ("outlink", "http://h.net/x?a=1&b=2"),
        ("outlink", "http://o.org/"),
        ("outlink", "http://h.net/d/rel"),
    ]


@pytest.mark.parametrize("row", [(1, "http://a.b/c", PAGE), (None, None, None), (2, "", ""), (3, "http://[bad", "<a href='//[x'>"), (4, "u\r\nX: y", "é\r\n\r\nü")])
def test_records_round_trip_and_link(row):
    fields, block = warc.response(*row)
    source = dict(fields)
    assert warc.parse(warc.serialized(fields, block)) == (fields, block)
    assert source["WARC-Payload-Digest"] == warc.digest((row[2] or "").encode())
    made = warc.derivatives(fields, block)
    assert [dict(f)["WARC-Type"] for f, _ in made] == ["metadata", "conversion"]
    for own, data in made:
        named = dict(own)
        assert warc.parse(warc.serialized(own, data)) == (own, data)
        assert named["WARC-Refers-To"] == source["WARC-Record-ID"] != named["WARC-Record-ID"]
        assert named.get("WARC-Target-URI") == source.get("WARC-Target-URI")
        assert named["WARC-Source-Payload-Digest"] == source["WARC-Payload-Digest"]
    assert warc.derivatives(fields, block) == made


def test_damage_is_found():
    record = warc.serialized(*warc.response(1, "u", "text"))
    with pytest.raises(ValueError):
        warc.parse(record.replace(b"text\r\n", b"tezt\r\n"))


def test_whole_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    found = {(r.page_id, r.record_type): r for r in warc.derivative_report(pages).collect()}
    rows = pages.collect()
    assert len(found) == 2 * len(rows)
    for row in rows:
        for fields, block in warc.derivatives(*warc.response(row.page_id, row.url, row.html)):
            named = dict(fields)
            r = found[row.page_id, named["WARC-Type"]]
            assert (r.record_id, r.refers_to, r.block_digest) == (named["WARC-Record-ID"], named["WARC-Refers-To"], named["WARC-Block-Digest"])
            assert (r.content_length, r.block_crc32, r.target_uri) == (len(block), zlib.crc32(block), row.url)


def test_files_hold_one_member_for_each_record(spark, tmp_path):
    pages = spark.createDataFrame([(k, f"http://x/{k}", "<p>" + "word " * k) for k in range(50)], "page_id int, url string, html string")
    manifest = warc.write_derivatives(pages.coalesce(1), str(tmp_path)).collect()
    records = [warc.parse(r) for m in manifest for r in warc.read_records(m.file)]
    assert len(records) == 100 == sum(m.records for m in manifest)


def test_awkward_rows(spark):
    rows = [(None, None, None), (1, "u", ""), (1, "u", ""), (2, "v", "<p>" + "long text " * 300_000)]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, record_id string")
    found = warc.derivative_report(pages).collect()
    assert sorted((str(r.page_id), r.record_type) for r in found) == sorted(
        (str(r[0]), kind) for r in rows for kind in ("metadata", "conversion")
    )
    assert warc.derivative_report(pages.limit(0)).collect() == []


@pytest.mark.parametrize("piece", ["<a ", "<", "<script>", "<!--", "<title", "<title>", "<a href='", "<p ", "<svg ", "<!doctype "])
def test_endless_tags_take_no_time(piece):
    page = piece * ((1 << 20) // len(piece))
    begun = time.perf_counter()
    warc.plain_text(page), warc.page_metadata(page, "http://a/b")
    assert time.perf_counter() - begun < 5


def test_hidden_parts():
    page = "<!DOCTYPE html>a<!-- x <b> -->b<script>if (1 < 2) {}</script>c<STYLE a='1'>p</style >d<noscript>e"
    assert warc.without_hidden(page) == " a b c d<noscript>e"
    assert warc.plain_text("a < b <i>e</i>") == "a < b e"
    assert warc.title_of("<title>one</title><title>two</title>") == "one" and warc.title_of("<title>one") is None


def test_ids_and_http_fields_come_back(spark):
    ids = ["1", "a\r\nWARC-Type: x", " 100% ", "", "é:"]
    pages = spark.createDataFrame([(i, "http://h/p", "<p>x</p>") for i in ids] + [(None, None, None)], "page_id string, url string, html string")
    found = warc.read_warc(warc.write_derivatives(pages)).collect()
    assert sorted(str(r.page_id) for r in found) == sorted([*map(str, ids), "None"] * 2)
    source = warc.response("1", "http://h/p", "<p>x</p>")
    for fields, _ in warc.derivatives(*source):
        assert dict(fields)["X-HTTP-Content-Type"] == "text/html; charset=utf-8" and dict(fields)["X-HTTP-Content-Length"] == "8"


def test_hidden_parts_of_a_page_are_looked_for_once(monkeypatch):
    calls, plain = [], warc.without_hidden
    monkeypatch.setattr(warc, "without_hidden", lambda page: calls.append(page) or plain(page))
    page = "<html><title>t</title><!-- <a href='no'> --><p>a \t b  c <br> d</p><a href='x'>e</a></html>"
    made = warc.derivatives(*warc.response(1, "http://h/", page))
    assert len(calls) == 1
    assert [block.decode() for _, block in made][1] == "t\na b c\nd\ne"
    assert b"outlink: http://h/x\r\n" in made[0][1] and b"no" not in made[0][1]
