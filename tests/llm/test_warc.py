"""Archives: exact round trip at any split, revisits, damage."""

from __future__ import annotations

import random
import zlib

import pytest

from riskmart.llm import warc

PAGES = "page_id long, url string, html string"


def archive(records):
    return b"".join(records)


def scan(data, split):
    read = lambda n, at: data[at:at + n]
    return [(at, h["warc-record-id"], block) for start in range(0, len(data), split)
            for at, h, block in warc.scan_range(read, len(data), start, start + split)]


@pytest.mark.parametrize("split", [1, 7, 100, 1000, 10**9])
def test_each_record_is_read_once_at_any_split(split):
    rng = random.Random(1)
    inner = warc.encode_record("urn:x:inner", None, b"inner")
    payloads = [rng.randbytes(rng.randrange(300)) + warc.MAGIC + inner[:rng.randrange(len(inner) + 1)] for _ in range(12)]
    records = [warc.encode_record(f"urn:x:{i}", "http://a/b c\r\nd", p, level=0) for i, p in enumerate(payloads)]
    found = scan(archive(records), split)
    assert [f[1] for f in found] == [f"<urn:x:{i}>" for i in range(12)]
    assert all(block.endswith(p) for (_, _, block), p in zip(found, payloads))


def test_damage_costs_the_damaged_record_only():
    records = [warc.encode_record(f"urn:x:{i}", None, b"text %d " % i * 50) for i in range(5)]
    broken = bytearray(records[2])
    broken[40] ^= 255
    data = archive([*records[:2], bytes(broken), *records[3:]])
    ids = [f[1] for f in scan(data, 10**9)]
    assert "<urn:x:2>" not in ids and {"<urn:x:3>", "<urn:x:4>", "<urn:x:0>"} <= set(ids)
    assert zlib.decompress(records[0], 31).startswith(b"WARC/1.1\r\nWARC-Type: response")


def test_round_trip_and_revisits(spark, tmp_path):
    rows = [(1, "http://a/1", "same"), (2, "http://a/2", "same"), (2, "http://a/2b", "same"), (3, None, None), (4, "", ""),
            (None, "http://n", "same"), (None, "http://m", "only"), (None, "http://m", "only"), (5, "http://a/ü \n", "é" * 5000)]
    pages = spark.createDataFrame(rows, PAGES).repartition(3)
    files = warc.write_warc(warc.with_revisits(pages), str(tmp_path / "w"))
    assert sum(r["records"] for r in files.collect()) == len(rows)
    got = sorted(((str(r["page_id"]), r["warc_type"], r["refers"], r["payload_bytes"], r["payload"])
                  for r in warc.read_warc(files, split_bytes=64).select(
                     warc.page_id_of("record_id").alias("page_id"), "warc_type", warc.page_id_of("refers_to").alias("refers"),
                     "payload_bytes", "payload").collect()), key=str)
    body = lambda t: bytearray(t.encode())
    assert got == sorted([
        ("1", "revisit", 2, 4, None), ("2", "response", None, 4, body("same")), ("2", "response", None, 4, body("same")),
        ("3", "revisit", 4, 0, None), ("4", "response", None, 0, body("")), ("None", "revisit", 2, 4, None),
        ("None", "response", None, 4, body("only")), ("None", "response", None, 4, body("only")),
        ("5", "response", None, 10000, body("é" * 5000))], key=str)


def test_least_size_and_empty_table(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")], PAGES)
    files = warc.write_warc(warc.with_revisits(pages, min_bytes=5), str(tmp_path / "w"))
    assert {(r[0], r[1]) for r in warc.read_warc(files).select(warc.page_id_of("record_id"), "warc_type").collect()} == {
        (1, "response"), (2, "response"), (3, "revisit"), (4, "response")}
    none = warc.write_warc(warc.with_revisits(pages.limit(0)), str(tmp_path / "e"))
    assert warc.read_warc(none).count() == 0
