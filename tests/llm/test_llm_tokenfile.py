"""Token files: ids of the library, frames that can be read alone, damage that is found."""

import glob
import random
import struct
import zlib

import public_tokenizers
import pytest
import xxhash
import zstandard
from tokenizers import Tokenizer

import __spark_entry__ as entry_points
from cases import frame, odd_rows, with_clashes
from chatlake.llm import tokenfile

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


SPECIAL = ["<|endoftext|>", "a<|endoftext|>b <|startoftext|>", "<|ENDOFTEXT|> <|end", "x <| endoftext|>", "<<|endoftext|>>\n<|endoftext|><|endoftext|>", "pipe | less < more"]


def hash_of(text):
    h = xxhash.xxh64_intdigest((text or "").encode(), 42)
    return h - (1 << 64) if h >> 63 else h


def ids_of(tokenizer, text):
    ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
    return struct.pack(f"<{len(ids)}I", *ids)


def test_files_hold_all_documents_in_order(spark, tokenizer, tmp_path):
    rows = [(r[0], r[1]) for r in odd_rows(random.Random(2))] + [(i, t) for i, t in enumerate(SPECIAL, 500)]
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hash_of(r[1])))
    out = str(tmp_path / "files")
    tokenfile.write(with_clashes(frame(spark, rows)), PATH, out, end_id=1)
    want = [ids_of(tokenizer, t) for _, t in rows]
    plain = b"".join(zstandard.ZstdDecompressor().stream_reader(open(f, "rb"), read_across_frames=True).read() for f in sorted(glob.glob(f"{out}/part-*")))
    assert plain == b"".join(want)
    read = tokenfile.read(spark, out).orderBy("file", "place").collect()
    assert [r["doc_id"] for r in read] == [r[0] for r in rows]
    assert [bytes(r["ids"]) for r in read] == want
    some = tokenfile.read(spark, out, [300, 3]).collect()
    assert {(r["doc_id"], bytes(r["ids"])) for r in some} == {(r[0], w) for r, w in zip(rows, want) if r[0] in (300, 3)}


def test_only_the_frame_asked_for_is_opened_and_damage_is_found():
    docs = [(i, struct.pack("<I", i) * 9000) for i in range(6)]
    content = b"".join(row + tokenfile.SEPARATOR for row in tokenfile._file_rows(iter(docs)))
    broken = bytearray(content)
    second = int(tokenfile.Reader(content).at[1])
    broken[second + 20] ^= 0xFF
    file = tokenfile.Reader(bytes(broken))
    assert file.document(5) == docs[5][1]
    with pytest.raises(Exception):
        file.document(int(list(file.frames).index(1)))


def test_names_of_special_tokens_in_texts(tokenizer):
    rng = random.Random(3)
    texts = ["".join(rng.choices([*SPECIAL, " ", "word", "İ", "e\u0301", "'s", "<", "|", ">"], k=rng.randrange(1, 12))) for _ in range(2000)]
    assert tokenfile.encoder(PATH).encode(texts, 1) == [ids_of(tokenizer, t) for t in texts]
    assert 49407 in tokenizer.encode("<|endoftext|>", add_special_tokens=False).ids


def test_empty_table(spark, tmp_path):
    out = str(tmp_path / "none")
    tokenfile.write(frame(spark, []), PATH, out, end_id=1)
    assert tokenfile.read(spark, out).count() == 0


def test_query(spark, sf_dir, tokenizer):
    docs = sorted(map(tuple, spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()))
    want, start = [], 0
    for key, text in docs:
        ids = ids_of(tokenizer, text)
        want.append((key, start, len(ids) // 4, zlib.crc32(ids)))
        start += len(ids) // 4
    got = entry_points.queries()["op2_token_files"](spark, sf_dir)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, got.collect())) == want
