import zlib
from urllib.parse import urljoin

import pytest

from postweave.llm import warc


def members(tmp_path, count):
    records = [warc.serialized(*warc.response(k, f"http://h/{k}", f"<p>{k} " + "x y " * (k % 50))) for k in range(count)]
    path = tmp_path / "a.warc.gz"
    with path.open("wb") as out:
        for record in records:
            zipper = zlib.compressobj(3, zlib.DEFLATED, 31)
            out.write(zipper.compress(record) + zipper.flush())
    return records, path


def test_records_may_end_anywhere_in_what_is_read(tmp_path, monkeypatch):
    records, path = members(tmp_path, 60)
    monkeypatch.setattr(warc, "READ_BYTES", 1000)
    monkeypatch.setattr(warc, "UNZIP_BYTES", 7)
    assert list(warc.read_records(f"file://{path}")) == records
    path.write_bytes(path.read_bytes()[:-9])
    with pytest.raises(ValueError):
        list(warc.read_records(f"file://{path}"))


def test_what_follows_a_record_is_not_copied_for_each(tmp_path, monkeypatch):
    records, path = members(tmp_path, 3000)
    given, plain = [], zlib.decompressobj

    class Counting:
        def __init__(self, *how):
            self.own = plain(*how)

        def decompress(self, data):
            given.append(len(data))
            return self.own.decompress(data)

        eof = property(lambda self: self.own.eof)
        unused_data = property(lambda self: self.own.unused_data)

    monkeypatch.setattr(warc.zlib, "decompressobj", Counting)
    assert list(warc.read_records(f"file://{path}")) == records
    assert sum(given) < len(records) * (20 << 10) + path.stat().st_size


@pytest.mark.parametrize("url", ["http://h/d/e?q#f", "HTTP://u@H:80", "mailto:x", "http:", "//h/x", "a/b", "", None, "x:y", "http://[bad"])
def test_paths_from_the_root_are_joined_as_others(url):
    paths = ["/a", "/a/b.c", "/a/", "/a//b", "/..", "/a/../b", "/a/.", "/a;p", "/a?q", "//a", "/é", "/", "/a%2Fb"]
    found = [value for name, value in warc.page_metadata("".join(f'<a href="{p}">' for p in paths), url) if name == "outlink"]
    expected = []
    for path in paths:
        try:
            expected.append(urljoin(url or "", path))
        except ValueError:
            expected.append(path)
    assert found == expected


def test_plain_paths_are_not_parsed_again(monkeypatch):
    calls, plain = [], warc.urljoin
    monkeypatch.setattr(warc, "urljoin", lambda *a: calls.append(a) or plain(*a))
    assert len(warc.page_metadata("<a href='/a/b.c'>" * 100, "http://h/")) == 100
    assert len(calls) == 1
