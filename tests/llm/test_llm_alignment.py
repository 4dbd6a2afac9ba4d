"""Token alignment against whole encodings compared byte by byte."""

import hashlib
import random
import re
from collections import Counter

import public_tokenizers
import pytest

import __spark_entry__ as entry_points
from cases import frame, odd_rows, prose, with_clashes
from chatlake.llm import alignment

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
POOL = [" ", "  ", "\n", "\t", " \n", "\r\n", "\x85", "\xa0", "\x1c", "\x1f", chr(0x2028), chr(0x3000), chr(0x2581), "a", "word", " the", "The", "it's", "'s", " 's"]
POOL += ["1234", "é", "e" + chr(0x301), chr(0x301), "中文", "😀", "<|endoftext|>", "<s>", "</s>", "<unk>", "<0x41>", "...", "!!", "_", "\0", chr(0x200B), "हिन्दी", "ﬁ", chr(0xFEFF)]


@pytest.fixture(scope="module")
def sides():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B_PATH)


def spans(tokens):
    out, at = [], 0
    for t in tokens:
        out.append((at, at + len(t)))
        at += len(t)
    return out


def plain(sides, text):
    """n_a, n_b, n_groups, links (pairs of ids) and the hash of one text, or None."""
    a, b = sides
    plain_bytes = [*range(33, 127), *range(161, 173), *range(174, 256)]
    of = {chr(x): x for x in plain_bytes}
    of |= {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in plain_bytes)}
    if not text:
        return None
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    bytes_a = [bytes(of[c] for c in a.id_to_token(i)) for i in ids_a]
    pieces = map(b.id_to_piece, ids_b)
    bytes_b = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace(chr(0x2581), " ").encode() for p in pieces]
    if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
        return None
    at_a, at_b = spans(bytes_a), spans(bytes_b)
    links, j = [], 0
    for i, (start, end) in enumerate(at_a):
        while at_b[j][1] <= start:
            j += 1
        k = j
        while k < len(at_b) and at_b[k][0] < end:
            links.append((ids_a[i], ids_b[k]))
            k += 1
    ends = sorted({e for _, e in at_a} & {e for _, e in at_b})
    groups, start = [], 0
    for end in ends:
        both = [",".join(str(t) for t, (s, _) in zip(ids, at) if start <= s < end) for ids, at in ((ids_a, at_a), (ids_b, at_b))]
        groups.append("|".join(both))
        start = end
    return len(ids_a), len(ids_b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()


def expected(sides, rows):
    found = [(r[0], plain(sides, r[1])) for r in rows]
    counts = Counter(link for _, f in found if f for link in f[3])
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    out = []
    for key, f in found:
        if f is None:
            out.append((key, 0, 0, 0, 0, 0, 0, ""))
        else:
            out.append((key, *f[:3], len(f[3]), sum(counts[x] == best[x[1]] for x in f[3]), sum(counts[x] for x in f[3]), f[4]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("piece", [1 << 19, 7])
def test_hostile_texts(sides, monkeypatch, piece):
    monkeypatch.setattr(alignment, "PIECE_CHARS", piece)
    rng = random.Random(51)
    texts = ["".join(rng.choices(POOL, k=rng.randrange(1, 25))) for _ in range(700)]
    own = alignment.aligner(A_PATH, B_PATH)
    n = 0
    for text, got in zip(texts, alignment.align_texts(own, texts)):
        want = plain(sides, text)
        n += want is None
        assert got[:5] == ((*want[:3], len(want[3]), want[4]) if want else (0, 0, 0, 0, "")), text
    assert 0 < n < len(texts)


@pytest.mark.parametrize("limit", [alignment.COUNTS_BYTES, 0])
def test_odd_documents(spark, sides, limit):
    rng = random.Random(52)
    rows = [r for r in odd_rows(rng) if r[0] not in (300, 301)]
    rows += [(300, prose(rng, 3000)), (301, "y" * 5000), (302, "a" + chr(0x2581) + "b"), (303, "  two  blanks \n"), (304, "<|endoftext|> x")]
    docs = with_clashes(frame(spark, rows))
    got = alignment.alignment(docs, A_PATH, B_PATH, counts_bytes=limit)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect()), key=repr) == expected(sides, rows)
    assert alignment.alignment(frame(spark, []), A_PATH, B_PATH).count() == 0


def test_very_long_text_is_aligned_in_pieces(sides):
    rng = random.Random(53)
    text = prose(rng, 30_000)
    own = alignment.aligner(A_PATH, B_PATH)
    whole = next(alignment.align_texts(own, [text]))
    pieces = list(alignment._pieces(text + " " + text * 3))
    assert " ".join(u for p in pieces for u in p) == text + " " + text * 3
    assert whole[0] == len(sides[0].encode(" " + text, add_special_tokens=False).ids)


def test_ties_count_as_best(spark):
    for kind in ("<u4", "<u8"):
        rows = spark.createDataFrame([(bytearray(alignment.np.array(own, kind).tobytes()),) for own in ([7, 7, 17], [], [17, 3])], "links binary")
        found = {r["pair"]: (r["n"], r["best"]) for r in alignment.pair_counts(rows, 10, kind).collect()}
        assert found == {7: (2, True), 17: (2, True), 3: (1, True)}


def test_query(spark, sides, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = entry_points.queries()["op12_token_alignment"](spark, sf_dir)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect()), key=repr) == expected(sides, docs)
