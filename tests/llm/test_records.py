"""Binary records of token ids: the format, the index, reads in order and shuffled, against the tokenizers library."""

import glob
import random
import struct
import zlib

import numpy as np
import pytest

from pricelake.llm import records
from pricelake.llm.checksums import crc32c, masked
from pricelake.llm.records import Corrupt, read_records, read_shuffled, record_files, record_index, write_records

from .messy import by_row, frame, texts

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["<|endoftext|> it's IT'S", "a\x1cb\x85c d e", "é ́x e ́", "ΣΑΣ Σ\tΟΔΟΣ.", "don't\r\nstop '  t", "\U0001f600\U0001f600 x", "İstanbul İ",
       "x" * 3000, " lead", "trail ", "‍̀ à̖ ̖", "１２ 漢字かな", "<|start oftext|>"]


def plain(data: bytes) -> int:
    crc = 0xFFFFFFFF
    for byte in data:
        crc ^= byte
        for _ in range(8):
            crc = (crc >> 1) ^ (0x82F63B78 if crc & 1 else 0)
    return crc ^ 0xFFFFFFFF


def test_checksums_equal_the_bitwise_definition():
    rng = random.Random(3)
    data = bytes(rng.randrange(256) for _ in range(4000))
    begin = [rng.randrange(4000) for _ in range(50)] + [0, 4000]
    size = [rng.randrange(min(4000 - b, 700) + 1) for b in begin[:-2]] + [4000, 0]
    assert crc32c(np.frombuffer(data, np.uint8), begin, size).tolist() == [plain(data[b: b + n]) for b, n in zip(begin, size)]
    assert crc32c(np.frombuffer(b"123456789", np.uint8), [0], [9])[0] == 0xE3069283  # the check value of CRC-32C
    assert crc32c(np.zeros(0, np.uint8), [0], [0])[0] == 0 and len(crc32c(np.zeros(0, np.uint8), [], [])) == 0


def expected(rows):
    tokenizer = tokenizers.Tokenizer.from_file(PATH)
    return [(i, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]) for i, t in rows]


@pytest.mark.parametrize("by_word", [True, False])
def test_records_equal_the_library(spark, tmp, monkeypatch, by_word):
    rows = [(i, t) for i, t in texts() if i is not None] + [(1000 + k, t) for k, t in enumerate(ODD)] + [(None, None), (None, "x y")]
    monkeypatch.setattr(records, "REMEMBERED_WORDS", 200)
    write_records(frame(spark, rows), f"{tmp}/out", PATH, by_word=by_word)
    got = [tuple(r) for r in read_records(spark, f"{tmp}/out").collect()]
    want = expected(rows)
    assert by_row((i, list(ids)) for i, _, _, ids in got) == by_row(want)
    assert all(n == len(ids) for _, _, n, ids in got)
    # Starts: in order of ids (null first), each record begins where the one before it ends.
    at, last = 0, None
    for i, start, n, _ in sorted(got, key=lambda r: r[1]):
        assert start == at and (last is None or (i is not None and i >= last))
        at, last = at + n, i
    mixed = [tuple(r) for r in read_shuffled(spark, f"{tmp}/out", seed=7).collect()]
    assert by_row((i, list(ids)) for i, _, ids in mixed) == by_row(want)
    again = [r[0] for r in read_shuffled(spark, f"{tmp}/out", seed=8).collect()]
    assert [r[0] for r in mixed] != again and sorted(map(repr, again)) == sorted(repr(r[0]) for r in mixed)


def test_files_hold_frames_in_order_and_small_files_roll_over(spark, tmp, monkeypatch):
    monkeypatch.setattr(records, "FILE_BYTES", 1)
    monkeypatch.setattr(records, "READ_BYTES", 64)
    rows = [(i, "word " * (i % 9)) for i in range(2500)]
    write_records(frame(spark, rows).coalesce(1), f"{tmp}/out", PATH, by_word=True)
    listed = {(r["file"], r["offset"]): r for r in record_index(spark, f"{tmp}/out").collect()}
    found = 0
    for file in glob.glob(f"{tmp}/out/data/*.rec"):
        with open(file, "rb") as f:
            data = f.read()
        at = 0
        while at < len(data):
            n, head = struct.unpack_from("<QI", data, at)
            payload = data[at + 12: at + 12 + n]
            if found % 40 == 0:
                assert head == masked(plain(data[at: at + 8])).item()
                assert struct.unpack_from("<I", data, at + 12 + n)[0] == masked(plain(payload)).item()
            row = listed[(file.rsplit("/", 1)[1], at)]
            assert (row["length"], row["doc_id"]) == (n, struct.unpack_from("<q", payload)[0])
            at += n + 16
            found += 1
        assert at == len(data)
    assert found == len(rows) == len(listed)
    assert record_files(spark, f"{tmp}/out").count() == len(glob.glob(f"{tmp}/out/data/*.rec")) > 1
    digest = {r["doc_id"]: zlib.crc32(r["ids"]) for r in read_records(spark, f"{tmp}/out", as_array=False).collect()}
    assert digest == {i: zlib.crc32(np.array(ids, "<u4").tobytes()) for i, ids in expected(rows)}


def test_damage_is_noticed(spark, tmp):
    write_records(frame(spark, [(1, "some words here"), (2, "more words")]), f"{tmp}/out", PATH)
    (file, *_rest) = sorted(glob.glob(f"{tmp}/out/data/*.rec"))
    with open(file, "rb") as f:
        whole = f.read()
    for at in (0, 9, 20, len(whole) - 1):
        with open(file, "wb") as f:
            f.write(whole[:at] + bytes([whole[at] ^ 4]) + whole[at + 1:])
        with pytest.raises(Exception, match="Corrupt"):
            read_records(spark, f"{tmp}/out").collect()
    with open(file, "wb") as f:
        f.write(whole[:-3])
    with pytest.raises(Exception, match="Corrupt"):
        read_records(spark, f"{tmp}/out").collect()


def test_files_of_lost_attempts_are_not_read_and_empty_tables_work(spark, tmp):
    write_records(frame(spark, []), f"{tmp}/none", PATH)
    assert read_records(spark, f"{tmp}/none").collect() == [] == read_shuffled(spark, f"{tmp}/none", 1).collect()
    write_records(frame(spark, [(1, "a")]), f"{tmp}/out", PATH)
    with open(f"{tmp}/out/data/lost.rec", "wb") as f:
        f.write(b"half a frame")
    assert [r["doc_id"] for r in read_records(spark, f"{tmp}/out").collect()] == [1]
    records._drop_unlisted(spark, f"{tmp}/out")
    assert not glob.glob(f"{tmp}/out/data/lost.rec")
    wide = tokenizers.Tokenizer(tokenizers.models.WordLevel({f"w{i}": i for i in range(70000)}, unk_token="w0"))
    wide.pre_tokenizer = tokenizers.pre_tokenizers.WhitespaceSplit()
    wide.save(f"{tmp}/wide.json")
    write_records(frame(spark, [(1, "w69999 w3")]), f"{tmp}/wide", f"{tmp}/wide.json", end_id=2)
    assert [list(r["ids"]) for r in read_records(spark, f"{tmp}/wide").collect()] == [[69999, 3, 2]]
