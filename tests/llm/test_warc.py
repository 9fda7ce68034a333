import base64
import gzip
import hashlib

import pytest

from reviewlens.llm import warc
from reviewlens.llm.queries import QUERIES
from reviewlens.llm.store import open_folder
from tests.llm.conftest import FOLDER

PAGES = [
    (5, "http://a/", "<p>same</p>"),
    (3, "http://b/\r\nX: y%", "<p>same</p>"),
    (9, None, "<p>same</p>"),
    (3, "http://b2/", "<p>same</p>"),
    (1, "u", None),
    (2, "u", ""),
    (None, "u", "<p>twin</p>"),
    (None, "v", "<p>twin</p>"),
    (None, "v", "<p>same</p>"),
    (7, "é漢", "é漢\r\n\r\n"),
    (8, "long", "x" * 300_000),
    (11, "long", "x" * 300_000),
]


def frame(spark):
    return spark.createDataFrame(
        [(*p, "f") for p in PAGES], "page_id long, url string, html string, file string"
    ).repartition(3)


def by_hand(pages, minimum=0):
    data = [(p, u, (h or "").encode()) for p, u, h in pages]
    out = []
    for p, u, payload in data:
        same = [q for q, _, other in data if other == payload and q is not None]
        n = sum(other == payload for _, _, other in data)
        first = min(same) if same and n > 1 and len(payload) >= minimum else None
        kind = "response" if first is None or p == first else "revisit"
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out.append((p, u, len(payload), digest, kind, first if kind == "revisit" else None))
    return sorted(out, key=repr)


def read(df):
    names = ("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


@pytest.mark.parametrize("minimum", [0, 12])
def test_round_trip(spark, tricky, minimum):
    folder, index = warc.write_archives(frame(spark), minimum=minimum, archive_bytes=500)
    out = warc.read_records(folder, index)
    assert read(out) == by_hand(PAGES, minimum)
    html = {(r["page_id"], r["url"], r["html"]) for r in out.collect() if r["record_type"] == "response"}
    assert html <= {(p, u, h or "") for p, u, h in PAGES}


def test_rare_payloads_join_by_shuffle(spark, tricky, monkeypatch):
    monkeypatch.setattr(warc, "MOST_COMMON", 0)
    assert read(warc.read_records(*warc.write_archives(frame(spark)))) == by_hand(PAGES)


def test_selected_records_only(spark, tricky):
    folder, index = warc.write_archives(frame(spark))
    some = warc.read_records(folder, index.where("url = 'u'"))
    assert read(some) == [r for r in by_hand(PAGES) if r[1] == "u"]


def test_ranges_join_neighbours_and_stay_bounded(spark):
    index = spark.createDataFrame(
        [("f", 0, 10), ("f", 10, 10), ("f", 35, 5), ("f", 90, 5), ("f", 95, 20), ("g", 0, 1)],
        "file string, offset long, length long",
    )
    got = sorted((r["file"], r["start"], r["stop"], len(r["cuts"])) for r in warc.byte_ranges(index, 20, 100).collect())
    assert got == [("f", 0, 40, 3), ("f", 90, 115, 2), ("g", 0, 1, 1)]


def test_files_are_plain_gzip_members(spark, tricky):
    folder, index = warc.write_archives(frame(spark))
    system, path = open_folder(folder)
    names = {r["file"] for r in index.collect()}
    text = b"".join(gzip.decompress(system.open_input_file(f"{path}/{n}").read()) for n in names)
    assert text.count(b"WARC/1.1\r\n") == len(PAGES)


def test_empty_table(spark, tricky):
    assert warc.read_records(*warc.write_archives(frame(spark).limit(0))).count() == 0


def test_query(spark):
    pages = [(r["page_id"], r["url"], r["html"]) for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()]
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    got = sorted(tuple(r[n] for n in names) for r in QUERIES["op4_warc_index_first"](spark, FOLDER).collect())
    assert got == sorted((r[0], *r[2:]) for r in by_hand(pages))
