"""Token files and the alignment of tokenizers, against the libraries alone."""

from __future__ import annotations

import hashlib
import io
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskmart.llm import hashing, pieces, token_align, token_files
from riskmart.session import scratch_path

BYTE, PIECE, WORDS = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model", "word_bpe_49k.json"))
ODD = [None, "", " ", "a", "  a b", "a  b", "a \n\nB c", "x.\n\nAb", "x.\nAb c", "\nAb", "don't. We'll go", "<|endoftext|> a<|endoftext|>b c", "<s> </s>",
       "日本 語 a b", "tab\t x y", "a . b , c", "\x1c a b\x1c c", "é è×÷ a", "end ", "a b\u0085 c", "1 2 3.4, 5", "a▁b", "x" * 3000, "a\x00b ", "🙂 ok. 🙂"]


def texts(n: int = 400) -> list[str]:
    rng = random.Random(8)
    return ["".join(rng.choice(["ab", "c", ".", ",", "! ", " ", " ", " ", "\n", "\t", "'s", "é", "1", "日", "<|", " The", " of"]) for _ in range(rng.randrange(30)))
            for _ in range(n)]


@pytest.mark.parametrize("path, plain", [(BYTE, False), (BYTE, True), (WORDS, False)])
def test_pieces_give_the_ids_of_whole_texts(path, plain, monkeypatch):
    monkeypatch.setattr(pieces, "BYTE_PIECES", 50)
    monkeypatch.setattr(pieces, "LINES", 7)
    bpe = pieces.ByteBpe(path, plain)
    assert bpe.cuts == (path == BYTE)
    given = [t or "" for t in ODD + texts()]
    for most in (200, 1 << 20):
        found = []
        for _, _, data, bounds in hashing.blocks(pa.array(given, pa.large_string()), most):
            ids, at = bpe.encode(data, bounds)
            found += [ids[a:b].tobytes() for a, b in zip(at[:-1], at[1:])]
        assert found == bpe.library(given)
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = plain
    assert [np.frombuffer(f, "<u4").tolist() for f in found] == [tokenizer.encode(t, add_special_tokens=False).ids for t in given]


@pytest.mark.parametrize("width", [2, 4])
@pytest.mark.parametrize("frame", [16, 100, 1 << 16])
def test_files_round_trip_and_unpack_only_what_is_asked_for(width, frame):
    rng = np.random.default_rng(frame)
    docs = [(None if i % 9 == 8 else i - 5, rng.integers(0, 1 << 16, rng.integers(0, 60 if i % 10 else 400)).astype(f"<u{width}")) for i in range(60)]
    docs.append((-(2**63), np.zeros(0, f"<u{width}")))
    sink = io.BytesIO()
    writer = token_files.Writer(sink.write, width, frame)
    for doc_id, ids in docs:
        writer.add(doc_id, ids.tobytes())
    writer.close()
    data = sink.getvalue()
    assert writer.bytes == len(data)
    whole = zstandard.ZstdDecompressor().decompressobj  # any tool: frame after frame, skippable ones passed over
    stream = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True)
    assert whole is not None and stream.read() == b"".join(ids.tobytes() for _, ids in docs)
    reader = token_files.Reader(lambda n, at: data[at:at + n], len(data))
    assert [None if null else int(i) for i, null in zip(reader.doc_ids, reader.null)] == [d for d, _ in docs]
    assert reader.unpacked == 0
    fits = next(k for k, (_, ids) in enumerate(docs) if 0 < len(ids) * width <= frame and k > 20)
    assert np.array_equal(reader.ids(fits), docs[fits][1]) and reader.unpacked == 1
    assert all(np.array_equal(reader.ids(k), ids) for k, (_, ids) in enumerate(docs))
    frames = len(reader.starts) - 1
    for step in (1, 3, frames + 1):
        starts = [d for f in range(0, frames, step) for d in reader.documents(f, f + step)]
        assert starts == list(range(len(docs)))
    broken = bytearray(data)
    broken[len(data) // 3] ^= 1
    reader = token_files.Reader(lambda n, at: bytes(broken[at:at + n]), len(data))
    with pytest.raises((ValueError, zstandard.ZstdError)):
        [reader.ids(k) for k in range(len(docs))]


def listed(docs, tokenizer, end=(0,)):
    """Rows in file order with their ids."""
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("th")).collect()
    rows.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["th"]))
    out, start = [], 0
    for r in rows:
        ids = [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, *end]
        out.append((r["doc_id"], start, len(ids), np.array(ids, "<u4").tobytes()))
        start += len(ids)
    return out


@pytest.mark.parametrize("file_bytes, frame, read", [(1 << 30, 1 << 18, 256), (4000, 64, 2)])
def test_token_files_equal_the_library(spark, edge, edge_clashing, empty, file_bytes, frame, read):
    odd = spark.createDataFrame([(100 + i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    docs = edge.select("doc_id", "text").union(odd).union(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").selectExpr("doc_id + 1000", "text"))
    files = token_files.write_tokens(docs.repartition(5), scratch_path(spark, "tokens"), BYTE, file_bytes=file_bytes, frame_bytes=frame)
    want = listed(docs, Tokenizer.from_file(BYTE))
    found = [tuple(r[:3]) + (bytes(r[3]),) for r in token_files.read_tokens(files, read).orderBy("start", "n_tokens").collect()]
    assert found == want
    assert (files.count() > 3) == (file_bytes < 1 << 30)
    wanted = spark.createDataFrame([(1007,), (2,), (2,), (104,), (999_999,), (None,)], "doc_id long")
    picked = sorted(tuple(r[:3]) + (bytes(r[3]),) for r in token_files.fetch(files, wanted).collect())
    assert picked == sorted(r for r in want if r[0] in (1007, 2, 104))
    none = token_files.write_tokens(empty, scratch_path(spark, "tokens"), BYTE)
    assert none.count() == 0 and token_files.read_tokens(none).count() == 0
    bare = token_files.write_tokens(edge_clashing, scratch_path(spark, "tokens"), BYTE, end_id=None)
    assert [r["n_tokens"] for r in token_files.read_tokens(bare).orderBy("start", "n_tokens").collect()] == [n for _, _, n, _ in listed(edge, Tokenizer.from_file(BYTE), ())]


def test_registered_token_query_has_the_contract_columns(spark):
    from riskmart.llm import queries

    rows = queries.op12_token_files(spark, "/root/testdata/sf0.001").orderBy("start").collect()
    want = listed(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), Tokenizer.from_file(BYTE))
    assert [tuple(r) for r in rows] == [(d, s, n, zlib.crc32(ids)) for d, s, n, ids in want]


def test_alignment_by_division_equals_the_set_of_shared_ends():
    rng = random.Random(2)
    for n in [*range(1, 12)] * 30 + [400] * 5:
        a, b = (sorted({*rng.sample(range(1, 2 * n + 2), min(n, 2 * n)), 2 * n + 2}) for _ in range(2))
        groups, i, j = [], 0, 0
        for end in sorted(set(a) & set(b)):
            groups.append((i, a.index(end) + 1, j, b.index(end) + 1))
            _, i, _, j = groups[-1]
        assert token_align.align(a, b) == groups
        pairs = [p for g in groups for p in token_align.links(a, b, g)]
        assert sorted(pairs) == [(i, j) for i in range(len(a)) for j in range(len(b)) if max([0, *a][i], [0, *b][j]) < min(a[i], b[j])]
    assert token_align.align([], []) == []


def expected_alignment(rows):
    """By the libraries on whole texts and pairs of overlapping ranges."""
    tokenizer, model = Tokenizer.from_file(BYTE), sentencepiece.SentencePieceProcessor(model_file=PIECE)
    tokenizer.encode_special_tokens = True
    level, sides, counts = pieces.byte_level(), {}, Counter()
    spell = lambda i: bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode()
    for key, text in rows:
        sides[key] = None
        if not text:
            continue
        a, b = tokenizer.encode(" " + text, add_special_tokens=False).ids, model.encode(text)
        parts = [[bytes(level[c] for c in tokenizer.id_to_token(i)) for i in a], [spell(i) for i in b]]
        if any(b"".join(p) != f" {text}".encode() for p in parts):
            continue
        ends = [np.cumsum([len(x) for x in p]).tolist() for p in parts]
        groups, links, i, j = [], [], 0, 0
        for end in sorted(set(ends[0]) & set(ends[1])):
            i1, j1 = ends[0].index(end) + 1, ends[1].index(end) + 1
            groups.append((a[i:i1], b[j:j1]))
            links += [(a[x], b[y]) for x in range(i, i1) for y in range(j, j1)
                      if max(ends[0][x] - len(parts[0][x]), ends[1][y] - len(parts[1][y])) < min(ends[0][x], ends[1][y])]
            i, j = i1, j1
        sides[key] = (len(a), len(b), groups, links)
        counts.update(links)
    top = {}
    for (_, b), n in counts.items():
        top[b] = max(top.get(b, 0), n)
    out = {}
    for key, side in sides.items():
        if side is None:
            out[key] = (0, 0, 0, 0, 0, 0, "")
            continue
        n_a, n_b, groups, links = side
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        out[key] = (n_a, n_b, len(groups), len(links), sum(counts[p] == top[p[1]] for p in links), sum(counts[p] for p in links),
                    hashlib.sha256(text.encode()).hexdigest())
    return out, counts


@pytest.mark.parametrize("block", [300, 1 << 20])
def test_alignment_equals_brute_force(spark, block):
    rows = [(i, t) for i, t in enumerate(ODD + texts(150) + [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).collect()])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want, counts = expected_alignment(rows)
    found = {r["doc_id"]: tuple(r)[1:8] for r in token_align.align_documents(docs, BYTE, PIECE, block).collect()}
    assert found == want and sum(w[0] == 0 for w in want.values()) >= 3
    pairs = {(r["a"], r["b"]): (r["links"], r["best"]) for r in token_align.pair_counts(docs, BYTE, PIECE, block).collect()}
    assert {p: n for p, (n, _) in pairs.items()} == dict(counts)
    assert all(best == (n == max(m for (_, b), (m, _) in pairs.items() if b == p[1])) for p, (n, best) in list(pairs.items())[:50])


def test_alignment_of_edge_rows(spark, edge, edge_clashing, empty, ordered):
    found = token_align.align_documents(edge, BYTE, PIECE, keep_groups=True)
    assert found.count() == edge.count()
    assert ordered(found) == ordered(token_align.align_documents(edge_clashing, BYTE, PIECE, keep_groups=True))
    assert all(hashlib.sha256(r["groups"].encode()).hexdigest() == r["groups_sha256"] for r in found.collect() if r["n_a"])
    assert token_align.align_documents(empty, BYTE, PIECE).count() == 0
