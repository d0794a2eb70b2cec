"""Seekable bundles: exact round trips, the footer, single records, and revisits."""

import hashlib
import io
import random

import pyarrow as pa
import pytest
import zstandard
from pyarrow import fs

from tidemark.llm import warc_bundles as W

SCHEMA = "page_id long, url string, html string, digest string, row string, payload string"


def sample(rng):
    big = "".join(rng.choice("abcdefgh <>é") for _ in range(40000))
    htmls = [None, "", "x" * 99, "x" * 100, "é" * 50, "é" * 49, "WARC/1.1\r\n\r\n" * 20, big, "\r\n\r\n" * 40] + [f"<p>{i}</p>" * 30 for i in range(20)]
    rows = []
    for i in range(160):
        rows.append((i, rng.choice((None, f"http://x/{i}", "http://x/a b%20c\r\nWARC-Type: fake é")), rng.choice(htmls), "d", "r", "p"))
    rows += [rows[5], rows[5], (None, None, "x" * 100, "d", "r", "p"), (None, "u", "only with a null id " * 9, "d", "r", "p"), (None, "u", "only with a null id " * 9, "d", "r", "p")]
    rows += [(500 + i, "hot", "the one hot payload " * 30, "d", "r", "p") for i in range(80)]
    return rows


def by_hand(rows):
    first, out = {}, []
    for page, _, html, *_ in rows:
        b = (html or "").encode()
        if len(b) >= 100:
            first[b] = min(first.get(b, (True, 0)), (page is None, page or 0))
    taken = set()
    for page, _, html, *_ in rows:
        b = (html or "").encode()
        digest = hashlib.sha256(b).hexdigest()
        if len(b) >= 100 and (b in taken or (page is None, page or 0) != first[b]):
            out.append((page, len(b), digest, "revisit", None if first[b][0] else first[b][1]))
        else:
            taken.add(b)
            out.append((page, len(b), digest, "response", None))
    return sorted(out, key=str)


@pytest.mark.parametrize("broadcast", [200_000, 0])
def test_pages_come_back(spark, monkeypatch, broadcast):
    monkeypatch.setattr(W, "BROADCAST_ROWS", broadcast)
    rows = sample(random.Random(2))
    pages = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = [tuple(r)[:5] for r in W.page_records(pages).collect()]
    assert sorted(got, key=str) == by_hand(rows)


def test_round_trip_index_and_single_records(spark, tmpdir_fresh):
    rows = sample(random.Random(3))
    pages = spark.createDataFrame(rows, SCHEMA).repartition(3)
    index = W.write_bundles(pages, tmpdir_fresh + "/bundles", frame_bytes=5000, bundle_bytes=20000)
    records = W.read_bundles(index).collect()
    assert len(records) == len(rows) == index.count() and index.select("file").distinct().count() > 3
    bodies = {r["record_id"]: bytes(r["payload"]) for r in records if r["record_type"] == "response"}
    want = sorted((str(p), str(u), (h or "").encode()) for p, u, h, *_ in rows)
    assert sorted((str(r["page_id"]), str(r["url"]), bodies[r["refers_to_record"] or r["record_id"]]) for r in records) == want
    assert all(r["refers_to_record"] in bodies for r in records if r["record_type"] == "revisit")
    # single records read only their own frames
    some = index.orderBy("record_id").limit(7)
    one = {r["record_id"]: r for r in W.fetch_records(index, some).collect()}
    whole = {r["record_id"]: r for r in records}
    assert len(one) == 7 and all(whole[k] == r for k, r in one.items())
    # every bundle is a plain Zstandard file, and its own map says where its records are
    places = {r["record_id"]: r for r in index.collect()}
    for name in {r["file"] for r in places.values()}:
        with fs.LocalFileSystem().open_input_file(name) as f:
            data, table = f.read(), W.read_seek_table(f)
            plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
            assert plain == b"".join(W.read_frame(f, *t) for t in table if t[2]) and sum(t[2] for t in table) == len(plain)
            for ident, (frame, offset, length) in W.read_record_map(f).items():
                r = places.pop(ident)
                assert (r["file"], r["frame"], r["offset"], r["length"]) == (name, frame, offset, length)
                assert W.decode_record(W.read_frame(f, *table[frame])[offset : offset + length])[0]["record_id"] == ident
    assert not places


def test_files_outside_the_index_do_not_count(spark, tmpdir_fresh):
    pages = spark.createDataFrame(sample(random.Random(4))[:40], SCHEMA)
    folder = tmpdir_fresh + "/b"
    first = W.write_bundles(pages, folder)
    W.write_bundles(pages, folder)  # files of another attempt
    assert W.read_bundles(first, payload=False).count() == 40


def test_damaged_bundles_are_refused(tmp_path):
    path = str(tmp_path / "x.warc.zst")
    w = W.BundleWriter(fs.LocalFileSystem().open_output_stream(path, compression=None))
    ident = W.record_id(1, "d", 0)
    w.add(ident, W.encode_record("response", ident, 1, None, "0" * 64, b"payload"))
    w.close()
    with fs.LocalFileSystem().open_input_file(path) as f:
        data = W.read_frame(f, *W.read_seek_table(f)[0])
    with pytest.raises(ValueError):
        W.decode_record(data)  # the digest does not fit
    with pytest.raises(ValueError):
        W.decode_record(data[:-10])
    with pytest.raises(ValueError):
        W.read_seek_table(pa.BufferReader(b"too short"))


def test_empty_table(spark):
    assert W.page_records(spark.createDataFrame([], SCHEMA)).count() == 0
