"""WARC archives: round trips, the members and offsets of normalised files, revisits by brute force, damaged files."""

import collections
import gzip
import hashlib
import json
import os
import random
import zlib

from pyspark.sql import functions as F

from vigia.llm import warc

SCHEMA = "page_id long, url string, html string, file string, n int, key string"


def made(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(3)


def pages(seed=4):
    rng = random.Random(seed)
    bodies = ["é" * 499 + "x", "é" * 500, "y" * 999, "y" * 1000, "HTTP\r\n\r\nWARC/1.1\r\n\r\n" * 90, None, "", "<p>" + "z" * 3_000_000, "\x00\r\n\r\n" * 400]
    rows = [(k, rng.choice([None, "http://a.b/c d\r\nX: y", "http://ü.example/ü?q=1", ""]), rng.choice(bodies)) for k in range(120)]
    return [*rows, (None, "u", "q" * 2000), (None, "u", "q" * 2000), (500, "u", "r" * 1500), (500, "u", "r" * 1500), (None, "u", "r" * 1500), (-7, "u", "s" * 1500), (-9, "v", "s" * 1500)]


def brute(rows, least=1000):
    groups = collections.defaultdict(list)
    for i, (page, _, html) in enumerate(rows):
        groups[html or ""].append((page is not None, page or 0, i))
    out = []
    for i, (page, _, html) in enumerate(rows):
        data = (html or "").encode()
        stays = max(groups[html or ""])
        again = len(data) >= least and stays[2] != i
        out.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", rows[stays[2]][0] if again else None, True))
    return out


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((v is not None, v) for v in r))


def test_report_equals_brute_force(spark):
    rows = pages()
    for size in (1, warc.ARCHIVE_BYTES):
        got = warc.report(made(spark, rows), archive_bytes=size)
        assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact"]
        assert ordered(got.collect()) == ordered(brute(rows))
    assert warc.report(made(spark, rows).limit(0)).collect() == []
    sample = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    assert ordered(warc.report(sample).collect()) == ordered(brute([tuple(r) for r in sample.select("page_id", "url", "html").collect()]))


def test_archives_are_members_with_a_sidecar(spark, tmp_path):
    rows = pages()
    index = warc.archive(made(spark, rows), f"file://{tmp_path}/out")
    listed = [r.asDict() for r in index.collect()]
    for file in {r["file"] for r in listed}:
        path = file.removeprefix("file://")
        mine = sorted((r for r in listed if r["file"] == file), key=lambda r: r["offset"])
        assert [json.loads(x) for x in open(f"{path}.index.json")] == [{k: r[k] for k in warc.INDEX.names[1:]} for r in mine]
        data, at = open(path, "rb").read(), 0
        for r in mine:  # each member stands alone, one after the other, to the end of the file
            assert r["offset"] == at
            one = zlib.decompressobj(31)
            record = one.decompress(data[at : at + r["length"]])
            assert one.eof and not one.unused_data and record.startswith(b"WARC/1.1\r\nWARC-Type: " + r["record_type"].encode()) and record.endswith(b"\r\n\r\n")
            at += r["length"]
        assert at == len(data)
    assert sorted(os.listdir(tmp_path / "out")) == sorted(x for f in {os.path.basename(r["file"]) for r in listed} for x in (f, f"{f}.index.json"))
    back = warc.read(index).where("record_type = 'response'").select(F.col("fields")["Page-Id"].cast("long").alias("p"), F.col("payload").cast("string").alias("t")).collect()
    texts = {(p, h or "") for p, _, h in rows}
    assert all((r["p"], r["t"]) in texts for r in back)
    ids = {r["record_id"] for r in listed}
    to = [r["f"]["WARC-Refers-To"] for r in warc.read(index).where("record_type = 'revisit'").select(F.col("fields").alias("f")).collect()]
    assert to and all(x in ids for x in to) and len(ids) == len(listed)


def foreign(n, pad=b""):
    """Records of another writer: other order of fields, no payload digest, a request record."""
    out = b""
    for k in range(n):
        block = b"GET / HTTP/1.1\r\n\r\n" if k % 2 else b"HTTP/1.1 200 OK\r\n\r\n" + b"ab\r\n\r\n" * k
        out += f"WARC/1.0\r\nContent-Length: {len(block)}\r\nWARC-Type: {'request' if k % 2 else 'response'}\r\nContent-Type: application/http\r\nWARC-Record-ID: <urn:x:{k}>\r\n\r\n".encode() + block + b"\r\n\r\n" + pad
    return out


def test_files_of_other_writers_and_damaged_ones(spark, tmp_path):
    whole = foreign(9)
    files = {
        "one.gz": gzip.compress(whole), "plain.warc": whole, "members.gz": b"".join(gzip.compress(foreign(9)) for _ in range(2)), "gaps.gz": gzip.compress(foreign(9, b"\r\n")), "empty.gz": gzip.compress(b""), "nothing": b"",
        "cut.gz": gzip.compress(random.Random(1).randbytes(0) + foreign(400))[:-40], "text.gz": gzip.compress(b"no archive\r\n\r\n"), "short.warc": whole[:-30],
    }
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    for name, data in files.items():
        index = warc.normalise(spark.createDataFrame([(f"{tmp_path}/{name}",)], "file string"), f"{tmp_path}/new-{name}")
        kinds = collections.Counter(r["record_type"] for r in index.collect())
        good = [r for r in warc.read(index).orderBy("offset").collect()]
        if name in ("cut.gz", "text.gz", "short.warc"):
            assert kinds["damaged"] == 1
        else:
            assert kinds["damaged"] == 0 and len(good) == {"members.gz": 18, "empty.gz": 0, "nothing": 0}.get(name, 9)
        for k, r in enumerate(good[:9]):
            assert (r["record_id"], r["intact"]) == (f"<urn:x:{k}>", True) and bytes(r["payload"]) == (b"" if k % 2 else b"ab\r\n\r\n" * k)


def test_a_stream_is_inflated_in_chunks(tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "CHUNK", 7)
    (tmp_path / "a.gz").write_bytes(gzip.compress(foreign(30)))
    with open(tmp_path / "a.gz", "rb") as raw, open(tmp_path / "b.gz", "wb") as out:
        stream = warc.Inflated(raw)
        rows = list(warc.rewritten(stream, out, {}, "b"))
    assert len(rows) == 30 and gzip.decompress((tmp_path / "b.gz").read_bytes()) == foreign(30)
