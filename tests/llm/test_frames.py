import io
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from tokenizers import Tokenizer

from canvass.llm import byte_bpe, frames
from canvass.llm.byte_bpe import ByteBPE


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(frames.VOCABULARY)


def plain(tokenizer, rows):
    out, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_cached_encoding(tokenizer, monkeypatch):
    monkeypatch.setattr(byte_bpe, "PIECES", 300)
    rnd, coder = random.Random(2), ByteBPE(frames.VOCABULARY)
    assert coder.plain
    bits = ["a", "It's", "'s", "s'", " ", "  ", "   ", "\n", "\n\n", "\t", "\r\n", "x.", "é", "É,", "×", "÷", "ß÷", "中文", "\xa0", "\u3000", "\x85", "\u2028"]
    bits += ["1234", "3.5", "!!", "...", "?!\n", "<|endoftext|>", "<|", "\0", "🙂", "\x1c", "we'll", "de%%%", "½", "ʼn", "ſ", "ǆ", "e\u0301", "\x7f", "~", "/", "9", "Å.", "'"]
    texts = ["", " ", "\n", " a", "a ", "×", "\n.", None] + [
        "".join(rnd.choice(bits) + rnd.choice(["", "", " ", "\n"]) for _ in range(rnd.randrange(1, 40))) for _ in range(4000)
    ]
    for size in (1, 7, 500):
        rnd.shuffle(texts)
        for i in range(0, len(texts), size):
            part = texts[i : i + size]
            # a slice of a longer array: offsets don't start at zero
            got = coder.encode(pa.array(["other"] + part).slice(1), 2)
            assert len(got) == len(part)
            for t, ids in zip(part, got, strict=True):
                assert ids.tolist() == tokenizer.encode(t or "", add_special_tokens=False).ids + [2], repr(t)


def test_other_vocabularies_are_encoded_whole():
    path = frames.public_tokenizers.path("word_bpe_49k.json")
    coder, model = ByteBPE(path), Tokenizer.from_file(path)
    assert not coder.plain
    for t in ("Two words.\nAnd", "", " É "):
        assert coder.encode(pa.array([t]), 7)[0].tolist() == model.encode(t, add_special_tokens=False).ids + [7]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[1])


def test_round_trip(documents, tokenizer, monkeypatch):
    monkeypatch.setattr(frames, "FRAME_TOKENS", 50)
    rnd = random.Random(1)
    rows = [(i * 7 % 101, " ".join(rnd.choice(["one", "two", "tres"]) for _ in range(rnd.randrange(60)))) for i in range(101)]
    rows += [(None, "no id"), (200, None), (201, ""), (202, "long " * 5000)]
    got = rows_of(frames.token_frames(documents(*rows, parts=6)))
    assert got == plain(tokenizer, rows)


def test_repeated_rows(documents, tokenizer):
    rows = [(5, "same"), (5, "same"), (5, "other words"), (4, "x")]
    got = rows_of(frames.token_frames(documents(*rows)))
    assert sorted(r[2:] for r in got) == sorted(r[2:] for r in plain(tokenizer, rows))
    assert [r[0] for r in got] == [4, 5, 5, 5]
    assert all(a[1] + a[2] == b[1] for a, b in zip(got, got[1:]))


def test_no_rows(documents):
    assert rows_of(frames.token_frames(documents((1, "a")).filter("false"))) == []


def shard(pairs, limit=100):
    out = io.BytesIO()
    frames.FRAME_TOKENS, before = limit, frames.FRAME_TOKENS
    writer = frames.Writer(out)
    for i, ids in pairs:
        writer.add(i, np.array(ids, np.uint32))
    writer.close()
    frames.FRAME_TOKENS = before
    return out.getvalue()


def test_random_access():
    pairs = [(i // 2, [i] * (i % 60 + 1)) for i in range(400)]
    data = shard(pairs)
    reader = frames.Reader(pa.BufferReader(data))
    for wanted in (0, 57, 199):
        before = reader.read_bytes
        assert [x.tolist() for x in reader.documents(wanted)] == [ids for i, ids in pairs if i == wanted]
        assert reader.read_bytes - before < len(data) / 10
    assert reader.documents(1000) == []


def test_any_zstandard_reader():
    data = shard([(1, [7, 8]), (2, [9])], limit=2)
    bodies = b"".join(zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).readall() for _ in [0])
    assert bodies.endswith(np.array([9], "<u4").tobytes())


def test_damage():
    data = bytearray(shard([(1, list(range(50)))]))
    data[12] ^= 1
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(frames.Reader(pa.BufferReader(bytes(data))).frame(0))


def test_clashing_columns(spark, tokenizer):
    df = spark.createDataFrame([(1, "a b", 5, 6, "x")], "doc_id long, text string, id long, tie long, part string")
    assert rows_of(frames.token_frames(df)) == plain(tokenizer, [(1, "a b")])


def test_given_documents(spark, tokenizer):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = plain(tokenizer, [(r.doc_id, r.text) for r in docs.collect()])
    assert rows_of(frames.token_frames(docs.repartition(7))) == want
