import json
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import path as tokenizer_path
from pyarrow import fs
from tokenizers import Tokenizer

from fitweave.llm import packed_ids
from fitweave.llm.packed_ids import Encoder, PackedFile, encode_to_files, encoded, least_bits, packed, read_packed, unpacked, write_packed

BPE = tokenizer_path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def whole():
    tokenizer = Tokenizer.from_file(BPE)
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def parts():
    return Encoder(BPE)


@pytest.mark.parametrize("bits", range(1, 33))
def test_packing_round_trip(bits):
    rng = np.random.default_rng(bits)
    for n in (0, 1, 7, 8, 9, 1000):
        ids = rng.integers(0, 1 << bits, n, dtype=np.uint64).astype(np.uint32)
        data = packed(ids, bits)
        assert len(data) == -(-n // 8) * bits and unpacked(data, bits, n).tolist() == ids.tolist()
        number = sum(int(x) << (i * bits) for i, x in enumerate(ids))
        assert int.from_bytes(data, "little") == number


def test_ids_beyond_the_bits_are_refused():
    with pytest.raises(ValueError):
        packed(np.array([8], np.uint32), 3)


def test_least_bits():
    assert [least_bits(n) for n in (1, 2, 3, 256, 257, 50257, 65536, 65537)] == [1, 1, 2, 8, 9, 16, 16, 17]


SIGNS = [" ", "  ", "\n", "\t", "\x0b", "\x1c", "\x1f", "\x85", "\xa0", "᠎", " ", " ", "　", "​", "a", "word", "'s", "'LL", "é", "漢",
         "\U0001f600", "7", "12", "!", "?!", "<|endoftext|>", "<|", "‍", "\0"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(SIGNS), st.text(max_size=4)), max_size=30).map("".join))
def test_parts_give_the_ids_of_the_whole_text(whole, parts, text):
    assert np.frombuffer(parts.encode([text])[0], "<u4").tolist() == whole(text)


def test_many_texts_at_once_and_a_full_store(whole, monkeypatch):
    monkeypatch.setattr(packed_ids, "KEPT_PARTS", 40)
    rng = random.Random(5)
    texts = ["".join(rng.choices(SIGNS, k=rng.choice([0, 1, 8, 60]))) for _ in range(400)] + ["x" * 500 + " " + "y" * 500] * 2
    found = Encoder(BPE)
    for k in range(0, len(texts), 100):
        got = found.encode(texts[k : k + 100])
        assert [np.frombuffer(x, "<u4").tolist() for x in got] == [whole(t) for t in texts[k : k + 100]]
    assert len(found.later) <= 40


def test_other_tokenizers_get_whole_texts():
    path = tokenizer_path("word_bpe_49k.json")
    tokenizer, found = Tokenizer.from_file(path), Encoder(path)
    texts = ["Some  Words here", "", " a b"]
    assert not found.by_part
    assert [np.frombuffer(x, "<u4").tolist() for x in found.encode(texts)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def rows_and_extra():
    rng = random.Random(2)
    rows = [(i, "".join(rng.choices(SIGNS, k=rng.choice([0, 3, 200])))) for i in range(-20, 180)]
    rows += [(None, "no id"), (None, None), (7, "again"), (7, "again"), (8, None), (500, "long word " * 60_000)]
    rng.shuffle(rows)
    return rows


def test_files_read_back(spark, make, tmp_path, whole):
    rows = rows_and_extra()
    docs = make([(f"x{i}", d, 5, t) for i, (d, t) in enumerate(rows)], "start string, doc_id long, n_tokens int, text string", 5)
    path = str(tmp_path / "ids")
    encode_to_files(docs, BPE, 2, path, block=64, file_ids=3000, file_docs=40)
    with open(f"{path}/manifest.json") as file:
        manifest = json.load(file)
    assert manifest["bits"] == 16 and len(manifest["files"]) > 3
    want = [[*whole(t or ""), 2] for _, t in rows]
    assert manifest["ids"] == sum(map(len, want))
    for options in ({}, {"read_blocks": 1}):
        found = sorted((r.asDict() for r in read_packed(spark, path, **options).collect()), key=lambda r: r["start"])
        keys = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in found]
        assert keys == sorted(keys)
        starts = np.cumsum([0, *[r["n_tokens"] for r in found]])
        assert [r["start"] for r in found] == starts[:-1].tolist()
        got = [(r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in found]
        assert all(len(x) == r["n_tokens"] for (_, x), r in zip(got, found))
        key = lambda r: (r[0] is not None, r[0] or 0, r[1])
        assert sorted(got, key=key) == sorted([(d, ids) for (d, _), ids in zip(rows, want)], key=key)


def test_random_access_reads_its_blocks_alone(spark, make, tmp_path):
    rng = np.random.default_rng(3)
    ids = [rng.integers(0, 1 << 13, n, dtype=np.uint32) for n in (0, 5, 64, 1000, 0, 3, 129)]
    path = str(tmp_path / "ids")
    rows = spark.createDataFrame([(i, bytearray(x.astype("<u4").tobytes())) for i, x in enumerate(ids)], "doc_id long, ids binary").coalesce(1)
    write_packed(rows, path, 13, block=64)
    files = fs.LocalFileSystem()
    with open(f"{path}/manifest.json") as file:
        (name,) = [x["name"] for x in json.load(file)["files"]]
    file = PackedFile(files, f"{path}/{name}")
    joined = np.concatenate(ids)
    assert np.diff(file.offsets)[:-1].tolist() == [64 * 13 // 8] * (file.n_blocks - 1)
    for a, b in rng.integers(0, len(joined) + 1, (200, 2)):
        assert file.ids(a, b).tolist() == joined[a:b].tolist()
    assert [file.document(k).tolist() for k in range(len(ids))] == [x.tolist() for x in ids]
    assert {r["doc_id"]: r["n_tokens"] for r in read_packed(spark, path, read_blocks=1).collect()} == {i: len(x) for i, x in enumerate(ids)}
    # A changed byte is noticed where it is read, and nowhere else.
    with open(f"{path}/{name}", "r+b") as raw:
        raw.seek(int(file.offsets[3]) + 1)
        byte = raw.read(1)
        raw.seek(int(file.offsets[3]) + 1)
        raw.write(bytes([byte[0] ^ 1]))
    again = PackedFile(files, f"{path}/{name}")
    assert again.ids(0, 192).tolist() == joined[:192].tolist()
    with pytest.raises(ValueError, match="block 3"):
        again.ids(0, 193)


def test_files_of_lost_attempts_are_not_read(spark, make, tmp_path):
    path = str(tmp_path / "ids")
    encode_to_files(make([(1, "a b"), (2, "c")], "doc_id long, text string"), BPE, 2, path)
    before = sorted(map(tuple, read_packed(spark, path).select("doc_id", "start", "n_tokens").collect()))
    with open(f"{path}/ids-000000-0000-lost.bin", "wb") as file:
        file.write(b"half a file")
    assert sorted(map(tuple, read_packed(spark, path).select("doc_id", "start", "n_tokens").collect())) == before == [(1, 0, 3), (2, 3, 2)]


def test_empty_table(spark, make, tmp_path):
    path = str(tmp_path / "ids")
    docs = make([], "doc_id long, text string")
    encode_to_files(docs, BPE, 2, path)
    assert read_packed(spark, path).collect() == [] and encoded(docs, BPE).collect() == []


def test_query_on_the_smallest_table(spark, whole):
    from fitweave.llm.queries import QUERIES

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    want, start = [], 0
    for d, t in sorted((r["doc_id"], r["text"] or "") for r in docs):
        ids = np.array([*whole(t), 2], "<u4")
        want.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, QUERIES["op12_token_files"](spark, "/root/testdata/sf0.001").collect())) == want
