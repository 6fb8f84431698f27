import hashlib
import struct

import zstandard
from samples import prose

from paytide.llm import warc
from paytide.llm.tables import table
from paytide.session import work_path

ODD = [
    (1, "http://a/1", "x" * 200), (2, None, "x" * 200), (3, "http://a/3", None), (4, "http://a/\r\n4%20", ""),
    (5, "u", "short"), (6, "u", "short"), (7, "ü", "é" * 60), (8, "v", "é" * 60), (9, "w", prose(3, 200_000)),
    (None, "n", "x" * 200), (2, None, "x" * 200), (10, "r", "a\r\n\r\nWARC/1.1\r\n\r\nb" * 9),
]


def pages(spark, rows=ODD):
    return spark.createDataFrame([(*r, 1, "z") for r in rows], "page_id long, url string, html string, digest int, first string")


def archive(spark, df):
    path = work_path(spark, "warc_test")
    warc.write(df, path)
    return path


def test_roundtrip_of_odd_rows(spark):
    back = warc.read(spark, archive(spark, pages(spark))).collect()
    assert len(back) == len(ODD) and all(r["intact"] for r in back)
    want = sorted(((p, u) for p, u, _ in ODD), key=repr)
    assert sorted(((r["page_id"], r["url"]) for r in back), key=repr) == want
    html = {(p, u): h or "" for p, u, h in ODD}
    first = {}
    for p, _, h in sorted((r for r in ODD if r[0] is not None), key=lambda r: r[0]):
        first.setdefault(h or "", p)
    for r in back:
        payload = html[r["page_id"], r["url"]]
        assert r["payload_bytes"] == len(payload.encode())
        assert r["payload_digest"] == hashlib.sha256(payload.encode()).hexdigest()
        keeper = first[payload] if len(payload.encode()) >= 100 else r["page_id"]
        if keeper == r["page_id"]:
            assert (r["record_type"], r["refers_to"], bytes(r["payload"])) == ("response", None, payload.encode())
        else:
            assert (r["record_type"], r["refers_to"], r["payload"]) == ("revisit", keeper, None)


def test_frames_are_independent_and_the_table_leads_to_records(spark, monkeypatch):
    rows = [(n, f"http://h/{n}", prose(n, 300)) for n in range(200)]
    bundles = list(warc.bundle_rows((n, u, h, len(h), hashlib.sha256(h.encode()).hexdigest(), "response", None) for n, u, h in rows))
    (data, index), = bundles
    frames = warc.frames_of(data)
    assert len(frames) > 1 and len(index) == 200
    for entry in index[::17]:
        start, packed, size = frames[entry["frame"]]
        raw = zstandard.ZstdDecompressor().decompress(data[start : start + packed], max_output_size=size)
        found = warc.parse(raw, entry["offset"], entry["length"])
        assert found[2].decode() == rows[entry["page_id"]][2]
    # The seek table is a skippable frame, so any reader of the whole file sees the records alone.
    assert struct.unpack_from("<I", data, sum(f[1] for f in frames))[0] == warc.SKIPPABLE
    with zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True) as reader:
        assert reader.read().count(b"WARC/1.1\r\nWARC-Type") == 200
    monkeypatch.setattr(warc, "BUNDLE_BYTES", 10_000)
    small = list(warc.bundle_rows((n, u, h, len(h), "", "response", None) for n, u, h in rows))
    assert len(small) > 1 and sum(len(i) for _, i in small) == 200


def test_lookup(spark):
    path = archive(spark, table(spark, "/root/testdata/sf0.01", "pages"))
    found = {r["page_id"]: bytes(r["payload"]).decode() for r in warc.lookup(spark, path, [3, 77, 10**9]).collect()}
    html = {r["page_id"]: r["html"] for r in table(spark, "/root/testdata/sf0.01", "pages").where("page_id IN (3, 77)").collect()}
    assert found == html


def test_empty_table(spark):
    assert warc.roundtrip(pages(spark, [])).count() == 0
