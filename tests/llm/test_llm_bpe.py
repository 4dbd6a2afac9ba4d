"""Byte-level BPE against the tiktoken library."""

import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as entry_points
from cases import frame, odd_rows, with_clashes
from chatlake.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("reference", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def packed(ids):
    return b"".join(i.to_bytes(4, "little") for i in ids)


@given(texts=st.lists(st.one_of(st.text(max_size=60), st.text(alphabet=" \n\t'sdremvtlx1é .", max_size=60)), max_size=6))
@settings(max_examples=150, deadline=None)
def test_ids_are_those_of_the_library(texts):
    own = bpe.codec(PATH)
    ranks = tiktoken.Encoding("reference", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    ids = own.encode(texts)
    assert ids == [packed(ranks.encode_ordinary(t)) for t in texts]
    assert [own.decode(x) for x in ids] == [t.encode() for t in texts]


def test_long_words_merge_alike(reference):
    own = bpe.codec(PATH)
    rng = random.Random(3)
    for n in (63, 64, 65, 500):
        text = "".join(rng.choice("abcde") for _ in range(n))
        assert own.encode([text]) == [packed(reference.encode_ordinary(text))]


def test_scan_in_blocks_is_the_plain_scan():
    scanner = bpe.codec(PATH).scanner
    rng = random.Random(4)
    kinds = [rng.randrange(8) for _ in range(3 * scanner.BLOCK + 17)]
    state, want = bpe.FRESH, []
    for k in kinds:
        state = bpe._step(state, k)
        want.append(state)
    functions = scanner.of_kind[kinds]
    assert scanner.after_fresh[scanner.prefixes(functions)].tolist() == want


def expected(rows, reference):
    out = []
    for r in rows:
        text = r[1] or ""
        ids = reference.encode_ordinary(text)
        out.append((r[0], len(ids), hashlib.sha256(packed(ids)).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_odd_documents(spark, reference):
    rows = [(r[0], r[1]) for r in odd_rows(random.Random(1))]
    got = bpe.digest(bpe.encode(with_clashes(frame(spark, rows)), PATH), PATH)
    assert sorted(map(tuple, got.collect()), key=repr) == expected(rows, reference)
    assert bpe.digest(bpe.encode(frame(spark, []), PATH), PATH).count() == 0


def test_offsets_cut_the_text(spark):
    text = "café it's 42 中"
    row = bpe.encode(frame(spark, [(1, text)]), PATH, offsets=True).first()
    own = bpe.codec(PATH)
    ends = list(memoryview(bytes(row["ends"])).cast("q"))
    ids = list(memoryview(bytes(row["ids"])).cast("I"))
    data, begin = text.encode(), 0
    for i, end in zip(ids, ends):
        assert own.decode(packed([i])) == data[begin:end]
        begin = end
    assert begin == len(data)


def test_query(spark, sf_dir, reference):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = entry_points.queries()["op1_byte_bpe"](spark, sf_dir)
    assert got.columns[:4] == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == expected(docs, reference)
