import base64
import hashlib
import io

import pytest
import zstandard

from reddwatch.llm import warc

ROWS = [
    (1, "http://a/1 x%y", "same", 1), (2, "http://a/2", "same", 1), (3, None, "own é\r\n\r\nmore", 1), (4, "u", None, 1),
    (5, "u\n5", "", 1), (7, "u", "x" * 20_000, 1), (8, "u", "<p>" * 900, 1), (None, "u", "same", 1), (None, "u", "alone", 1),
    (9, "u", "twice", 1), (9, "u", "twice", 1),
]


def expected(rows, least):
    payloads = {}
    for page_id, _, html, _ in rows:
        payloads.setdefault(html or "", []).append(page_id)
    out = []
    for page_id, url, html, _ in rows:
        data = (html or "").encode()
        known = [p for p in payloads[html or ""] if p is not None]
        largest = max(known, default=None)
        revisit = largest is not None and page_id != largest and len(data) >= least
        out.append((page_id, url, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                    "revisit" if revisit else "response", largest if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("least,bundle,frame", [(0, 8 << 20, 1 << 17), (5, 300, 100), (0, 8 << 20, 900)])
def test_round_trip(make, least, bundle, frame):
    pages = make(ROWS, "page_id long, url string, html string, payload int").repartition(2)
    found = warc.archived(pages, least=least, bundle=bundle, frame=frame)
    assert sorted(map(tuple, found.collect()), key=str) == expected(ROWS, least)
    assert warc.archived(pages.limit(0)).count() == 0


def test_payloads_index_and_frames(make):
    pages = make(ROWS, "page_id long, url string, html string, payload int").repartition(2)
    archives = warc.bundles(pages, bundle=5000, frame=1500)
    bundles = {r.bundle: bytes(r.data) for r in archives.collect()}
    for data in bundles.values():
        # Any reader of Zstandard gets the records one after another, as the seek table is skipped.
        whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
        parts = [warc.frame(data, *place) for place in warc.frames(data)]
        assert b"".join(parts) == whole and all(p.startswith(b"WARC/1.1\r\n") for p in parts)
    entries = warc.index(archives).collect()
    assert len(entries) == len(ROWS) == len({e.record_id for e in entries})
    assert len({(e.bundle, e.frame) for e in entries}) < len(ROWS)  # frames are shared
    for e in entries:
        plain = warc.frame(bundles[e.bundle], e.place, e.length)
        headers, _, _ = warc.parsed(plain[e.offset : e.offset + e.size])
        assert headers["WARC-Record-ID"] == e.record_id
        assert headers.get("WARC-Page-Id") == (None if e.page_id is None else str(e.page_id))
        assert warc.frames(bundles[e.bundle])[e.frame] == (e.place, e.length)
    payloads = {r.page_id: r.payload for r in warc.read(archives, payloads=True).collect() if r.page_id in (2, 3, 5, 7)}
    assert payloads == {2: b"same", 3: "own é\r\n\r\nmore".encode(), 5: b"", 7: b"x" * 20_000}


@pytest.mark.parametrize("by", ["record_id", "page_id"])
def test_lookup(make, by):
    pages = make(ROWS, "page_id long, url string, html string, payload int").repartition(2)
    archives = warc.written(warc.bundles(pages, frame=1500), "archives")
    ids = {r.page_id: r.record_id for r in warc.index(archives).collect()}
    if by == "page_id":
        wanted = make([(7,), (3,), (3,), (8,), (55,), (None,)], "page_id long")
    else:
        wanted = make([(ids[7],), (ids[3],), (ids[3],), (ids[8],), ("<urn:uuid:none>",), (None,)], "record_id string")
    found = warc.lookup(archives, wanted, by).collect()
    assert sorted((r.page_id, r.record_id) for r in found) == [(i, ids[i]) for i in (3, 7, 8)]
    records = {r.page_id: warc.parsed(bytes(r.record))[2] for r in found}
    assert records == {7: b"x" * 20_000, 3: "own é\r\n\r\nmore".encode(), 8: b"<p>" * 900}


def test_a_large_group_of_equal_payloads(make):
    rows = [(i, "u", "same" if i % 3 else f"own {i}", 1) for i in range(400)]
    pages = make(rows, "page_id long, url string, html string, payload int").repartition(4)
    found = warc.archived(pages)
    assert sorted(map(tuple, found.collect()), key=str) == expected(rows, 0)


def test_an_index_of_another_bundle_is_noticed(make):
    pages = make(ROWS, "page_id long, url string, html string, payload int").repartition(1)
    one, other = (warc.bundles(pages.filter(f"page_id {c} 5")).collect()[0] for c in ("<", ">"))
    with pytest.raises(ValueError):
        list(warc.records(bytes(one.data), bytes(other.records)))


def test_damage_is_noticed(make):
    pages = make([(1, "u", "payload", 1)], "page_id long, url string, html string, x int")
    data = bytes(warc.bundles(pages).collect()[0].data)
    with pytest.raises(ValueError):
        warc.frames(data[:-1])
