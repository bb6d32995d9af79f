"""Archives: exact round trips, segments, and the format itself."""

import gzip
import hashlib
import re
from pathlib import Path

import pytest

from sluice.llm import warc as W

LONG = "é<p>" * 900
PAGES = [
    (3, "http://a/1", LONG), (1, "http://a/2", LONG), (2, None, LONG), (4, "u\r\nv", None), (5, "", ""), (6, "x", "s" * 99), (7, "x", "s" * 99),
    (8, "y", "t" * 100), (9, "y", "t" * 100), (10, "z", "WARC/1.1\r\n" + "\r\n\r\nWARC/1.1\r\n" * 3 + "WARC/1.1"), (11, "z", "a\r\n\r\n" * 40),
    (12, "z", "\r\n\r\n"), (13, "z", "漢字\U0001F600" * 500 + "\r\n\r\n"), (None, "n", LONG), (9, "y", "t" * 100), (14, "big", "0123456789" * 30_000),
]


def expected(pages):
    first = {}
    for i, _, html in pages:
        if i is not None and len((html or "").encode()) >= 100:
            first[html] = min(i, first.get(html, i))
    out = []
    for i, _, html in pages:
        raw = (html or "").encode()
        revisit = i is not None and first.get(html, i) < i
        out.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response", first[html] if revisit else None))
    return sorted(out, key=repr)


def frame(spark, pages=PAGES):
    return spark.createDataFrame([(*p, 1) for p in pages], "page_id long, url string, html string, payload int")


@pytest.mark.parametrize("chunk,rows", [(W.CHUNK, W.ARCHIVE_ROWS), (100, 7), (5, 1000)])
def test_round_trip(spark, stage, chunk, rows):
    found = W.round_trip(frame(spark).repartition(3), stage, chunk=chunk, archive_rows=rows)
    assert sorted(map(tuple, found.collect()), key=repr) == expected(PAGES)


def test_chunks_are_the_payload(spark, stage):
    W.write_archives(W.chunked(W.typed(frame(spark)), 64), f"{stage.path}/a")
    chunks = W.read_chunks(spark, f"{stage.path}/a")
    texts = {}
    for r in sorted(chunks.collect(), key=lambda r: r["chunk_no"]):
        assert len(r["chunk"].encode()) <= 64
        texts.setdefault((r["record_id"], r["id"]), []).append(r["chunk"])
    wanted = {i: h for i, _, h in PAGES if i not in (None, 9)}
    revisits = {2, 3}
    for (_, i), parts in texts.items():
        if i in wanted:
            assert "".join(parts) == ("" if i in revisits else wanted[i] or "")


def test_format(spark, stage):
    W.write_archives(W.chunked(W.typed(frame(spark).coalesce(1)), 1000), f"{stage.path}/a")
    folder = Path(re.sub("^file:/*", "/", f"{stage.path}/a"))
    raw = b"".join(gzip.decompress(p.read_bytes()) for p in sorted(folder.glob("*.gz")))
    ids, at = set(), 0
    while at < len(raw):
        end = raw.index(b"\r\n\r\n", at)
        head = raw[at:end].decode().split("\r\n")
        fields = dict(line.split(": ", 1) for line in head[1:])
        assert head[0] == "WARC/1.1" and fields["WARC-Type"] in ("response", "revisit", "continuation")
        if fields["WARC-Type"] == "continuation":
            assert fields["WARC-Segment-Origin-ID"] in ids and int(fields["WARC-Segment-Number"]) > 1
        assert fields["WARC-Record-ID"] not in ids
        ids.add(fields["WARC-Record-ID"])
        at = end + 4 + int(fields["Content-Length"])
        assert raw[at : at + 4] == b"\r\n\r\n"
        at += 4
    assert len(ids) > len(PAGES)


def test_damage_is_found(spark, stage):
    W.write_archives(W.chunked(W.typed(frame(spark)), 64), f"{stage.path}/a")
    chunks = W.read_chunks(spark, f"{stage.path}/a").where("NOT (id = 1 AND chunk_no = 3)")
    with pytest.raises(Exception, match="missing or damaged"):
        W.records(chunks).collect()


def test_splits_of_plain_archives(spark, stage):
    rows = W.chunked(W.typed(frame(spark)), 300).select(W.segment().alias("value"))
    rows.coalesce(1).write.option("lineSep", W.END).text(f"{stage.path}/plain")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in (501, 4096):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            found = W.records(W.read_chunks(spark, f"{stage.path}/plain")).drop("url").collect()
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        assert sorted(map(tuple, found), key=repr) == expected(PAGES)


def test_empty(spark, stage):
    assert W.round_trip(frame(spark, []), stage).collect() == []
