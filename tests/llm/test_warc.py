"""Archives of pages: round trips, the types of repeated payloads, the format itself."""

from __future__ import annotations

import hashlib
import struct
from collections import Counter, defaultdict

import pytest
import zstandard

from tests.llm.conftest import prose
from tidelines.llm import warc

SCHEMA = "page_id long, url string, html string, digest string, payload int, of string, type string, content binary"


def _table(spark, rows):
    return spark.createDataFrame([(i, u, h, "d", 1, "o", "t", b"c") for i, u, h in rows], SCHEMA).repartition(4)


def _odd():
    same, long = "<p>" + prose(1, 60), prose(2, 60_000)
    rows = [(i, f"http://x.org/{i}", f"<html>{prose(100 + i, 40)}</html>") for i in range(60)]
    rows += [(100 + i, f"http://copy.org/{i}", same) for i in range(200)]  # one payload on most pages
    rows += [(301, "u", long), (300, "v", long), (302, None, None), (303, "e", ""), (304, "e", "short"), (305, "f", "short")]
    rows += [(None, "n", "n" * 99), (None, "n", "n" * 100), (None, None, "n" * 100), (None, "m", "m" * 100), (40, "late", "m" * 100)]
    rows += [(400, "r", "repeated row " * 20)] * 3 + [(400, "a", "repeated row " * 20), (401, "r", "repeated row " * 20)]
    rows += [(500, "http://a b\r\nX: é/%41", "non-ASCII é 漢字 \r\n\r\n WARC/1.1 \x00 " + prose(3, 30))]
    rows += [(501, "s", "P*M\x18\x00\x00\x00\x00" * 30)]  # the bytes that end an archive
    return rows


def _plain(rows):
    """(page, bytes, digest, type, refers to) of every row."""
    groups, out = defaultdict(list), []
    for i, _, h in rows:
        groups[(h or "").encode()].append(i)
    for payload, ids in groups.items():
        ids = sorted(ids, key=lambda i: (i is None, i or 0))
        for k, i in enumerate(ids):
            revisit = k > 0 and len(payload) >= 100
            out.append((i, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if revisit else "response", ids[0] if revisit else None))
    return Counter(out)


def _write(spark, tmp_path, rows, **options):
    path = str(tmp_path / "archives")
    warc.write_archives(warc.with_types(_table(spark, rows)), path, **options)
    return path


def _number(text):
    return None if text is None else int(text)


@pytest.mark.parametrize("size", [20_000, 32 << 20])
@pytest.mark.parametrize("digests", [0, 1000])
def test_read_back_equals_what_was_written(spark, tmp_path, monkeypatch, size, digests):
    monkeypatch.setattr(warc, "DIGESTS", digests)
    rows = _odd()
    path = _write(spark, tmp_path, rows, archive_bytes=size)
    got = warc.read_archives(spark, path, with_payload=True).collect()
    assert Counter((_number(r["page"]), r["payload_bytes"], r["payload_digest"], r["type"], _number(r["refers_to_page"])) for r in got) == _plain(rows)
    stored = Counter(bytes(r["payload"]) for r in got if r["type"] == "response")
    kept = {h for h in ((h or "").encode() for _, _, h in rows) if len(h) >= 100}
    assert stored == Counter(h for h in ((h or "").encode() for _, _, h in rows) if len(h) < 100) + Counter(kept)
    assert len({r["record_id"] for r in got}) == len(got)
    assert {r["target_uri"] for r in got if r["page"] == "500"} == {"http://a%20b%0D%0AX:%20%C3%A9/%41"}
    assert {r["target_uri"] for r in got if r["page"] == "302"} == {"urn:x-page:302"}
    # Of rows that repeat an id, the one of the smallest url is the response.
    assert [r["target_uri"] for r in got if r["page"] == "400" and r["type"] == "response"] == ["a"]


def test_archives_are_files_of_single_frames_behind_a_dictionary(spark, tmp_path):
    path = _write(spark, tmp_path, _odd(), archive_bytes=60_000)
    files = list((tmp_path / "archives").glob("*.warc.zst"))
    assert len(files) > 4 and not list((tmp_path / "archives").glob("*.txt"))
    trained = 0
    for file in files:
        data = file.read_bytes()
        magic, size = struct.unpack_from("<II", data)
        assert magic == 0x184D2A5D
        learned = zstandard.ZstdDecompressor().decompress(data[8 : 8 + size])
        trained += learned[:4] == bytes.fromhex("37a430ec")
        # A plain streaming reader that is given the dictionary reads all records, frame after frame.
        plain = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(learned))
        text = plain.stream_reader(data, read_across_frames=True).read()
        heads = [head for _, head, _ in warc.records(memoryview(data))]
        assert heads[0]["warc-type"] == "warcinfo" and text.count(b"WARC-Record-ID: ") == len(heads)
    assert trained
    assert warc.read_archives(spark, path).count() == len(_odd())


def test_dictionary_makes_small_records_smaller():
    records = [warc.page_record(str(i), b"http://x", f"<html><head><title>{i}</title></head>{prose(i, 20)}".encode(), "0" * 64, "response", None, "d", str(i)) for i in range(300)]
    plain = zstandard.ZstdCompressor(level=3)
    assert len(warc.archive(records)) < 0.8 * sum(len(plain.compress(r)) for r in records)


def test_damage_is_an_error():
    whole = warc.archive([warc.page_record("1", b"u", b"x" * 500, hashlib.sha256(b"x" * 500).hexdigest(), "response", None, "d", "0")])
    assert len(list(warc.records(memoryview(whole)))) == 1
    for bad in (whole[:-1], whole[:5], b"\x00" * 20, whole + b"abc"):
        with pytest.raises(ValueError):
            list(warc.records(memoryview(bad)))
    flipped = bytearray(whole)
    flipped[-3] ^= 1
    with pytest.raises(zstandard.ZstdError):
        list(warc.records(memoryview(bytes(flipped))))
    false = warc.archive([warc.page_record("1", b"u", b"x" * 500, "0" * 64, "response", None, "d", "0")])
    with pytest.raises(ValueError):
        list(warc._read("f", false, False))


def test_no_pages(spark, tmp_path):
    path = _write(spark, tmp_path, [])
    assert warc.read_archives(spark, path).count() == 0
    assert warc.read_archives(spark, str(tmp_path / "nowhere")).count() == 0
