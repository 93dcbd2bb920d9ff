import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from unirec.llm import token_codec
from unirec.llm.token_codec import ByteBpe, Codebook, code_lengths, pack_block, read_ids, unpack_block, write_ids

PATH = public_tokenizers.path("byte_bpe_50k.json")
ALPHABET = ["a", "bc", "The", "don't", "I'll", " ", "  ", "\n", "\t", "\r\n", ".", ",", "!?", "12", "é", "ß", "ñ", "日本", " ", "　", "🙂",
            "<|endoftext|>", "'s", "\x00", "\x1c", "\x85", "-", "_", "x.", "Y!", ";"]


def test_pieces_give_the_ids_of_whole_texts():
    rng = random.Random(3)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(40))) for _ in range(3000)] + ["", None, " ", ".", "a.", " a", "word. Next"]
    bpe, plain = ByteBpe(PATH), Tokenizer.from_file(PATH)
    ids, counts = bpe.encode(pa.array(texts))
    ends = np.cumsum(counts)
    for t, n, e in zip(texts, counts, ends):
        assert ids[e - n:e].tolist() == plain.encode(t or "", add_special_tokens=False).ids, repr(t)
    ids, counts = bpe.encode(pa.array([None, ""], pa.string()))
    assert len(ids) == 0 and counts.tolist() == [0, 0]
    sliced = pa.array(texts)[100:200]
    ids, counts = bpe.encode(sliced)
    assert counts.tolist() == [len(plain.encode(t or "", add_special_tokens=False).ids) for t in texts[100:200]]


def test_a_remembered_piece_is_one_object():
    bpe = ByteBpe(PATH)
    bpe.encode(pa.array(["some plain words and, more of them."]))
    kept = [ids for known in bpe.known.values() for ids in known.values()]
    assert all(type(ids) is bytes and len(ids) % 4 == 0 for ids in kept)


MARKED = ["a", "B7", "été", "x'", "'", "s", "ll", "ñ", "½", "<|endoftext|>", "<|", "|>", "_", "(", ".", "!", ">", "#", "*" * 20, "\n", "\n", " ", " ", "\t", "\x7f", "…"]


def test_cuts_at_line_feeds_and_marks_give_the_ids_of_whole_texts():
    rng = random.Random(4)
    texts = ["".join(rng.choice(MARKED) for _ in range(rng.randrange(25))) for _ in range(6000)]
    texts += ["\n", "a\n", "\na", "\n\n", "a\n\nb", "a\nb\nc\n", "a\t\t", "\t\tb", "a!" * 40, "a" + "!" * 40]
    bpe, plain = ByteBpe(PATH, 500), Tokenizer.from_file(PATH)
    for part in range(0, len(texts), 700):
        ids, counts = bpe.encode(pa.array(texts[part:part + 700]))
        ends = np.cumsum(counts)
        for t, n, e in zip(texts[part:part + 700], counts, ends):
            assert ids[e - n:e].tolist() == plain.encode(t, add_special_tokens=False).ids, repr(t)


def test_words_at_line_feeds_and_before_marks_are_encoded_once():
    words = [f"word{chr(97 + i)}" for i in range(26)]
    bpe = ByteBpe(PATH)
    bpe.encode(pa.array([" ".join(f"{a}{m}\n{b}{m}" for a in words for b in words for m in (".", "!!", ",***"))]))
    assert sum(map(len, bpe.known.values())) < 100  # 26 words after a space, 26 after a line feed, the first word, the marks


def test_long_pieces_are_not_remembered():
    texts = ["字" * 30000, "x" * 200 + " " + "y" * 50000, "short " + "字" * 40]
    bpe, plain = ByteBpe(PATH), Tokenizer.from_file(PATH)
    for _ in range(2):
        ids, counts = bpe.encode(pa.array(texts))
        assert ids.tolist() == [i for t in texts for i in plain.encode(t, add_special_tokens=False).ids]
        assert counts.sum() == len(ids)
    assert sum(len(ids) for known in bpe.known.values() for ids in known.values()) < 1000


def test_code_lengths_are_optimal_and_limited():
    counts = {i: n for i, n in enumerate([1, 1, 2, 3, 5, 8, 13, 21, 34, 55])}
    free = code_lengths(counts, 20)
    assert sum(counts[t] * n for t, n in free.items()) == huffman_cost(list(counts.values()))
    tight = code_lengths(counts, 4)
    assert max(tight.values()) == 4 and sum(2.0 ** -n for n in tight.values()) == 1
    assert code_lengths({7: 3}) == {7: 1}
    with pytest.raises(ValueError):
        code_lengths({i: 1 for i in range(5)}, 2)


def huffman_cost(weights):
    import heapq
    heapq.heapify(weights)
    cost = 0
    while len(weights) > 1:
        a, b = heapq.heappop(weights), heapq.heappop(weights)
        cost += a + b
        heapq.heappush(weights, a + b)
    return cost


@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 5000])
def test_blocks_round_trip(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.geometric(0.01, n), 3000).astype(np.uint32)
    ids = ids * 15 % 50000
    counts = dict(zip(*[x.tolist() for x in np.unique(np.append(ids, [1, 2]), return_counts=True)]))
    book = Codebook(code_lengths(counts))
    sizes = np.array([n // 3, n - n // 3])
    docs, nulls, got_sizes, got = unpack_block(book, pack_block(book, np.array([5, 0]), np.array([False, True]), sizes, ids))
    assert got.tolist() == ids.tolist() and got_sizes.tolist() == sizes.tolist()
    assert docs.tolist() == [5, 0] and nulls.tolist() == [0, 1]


def test_files_give_the_ids_of_every_document(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_codec, "BLOCK_TOKENS", 50)
    rows = [(i * 7 % 101, " ".join(f"Word{j % (i + 1)}, the" for j in range(i % 30)), "x") for i in range(101)]
    rows += [(200, None, "a"), (201, "", "b"), (None, "no id", "c"), (50, "again", "d"), (50, "again", "d"), (202, "long " * 3000, "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, part string").repartition(5)
    write_ids(docs, PATH, 0, f"{tmp_path}/t")
    got = read_ids(spark, f"{tmp_path}/t").collect()
    plain = Tokenizer.from_file(PATH)
    want = []
    for d, t, _ in rows:
        ids = plain.encode(t or "", add_special_tokens=False).ids + [0]
        want.append((d, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert sorted(((g.doc_id is not None, g.doc_id or 0, g.n_tokens, g.ids_crc32) for g in got)) == sorted((d is not None, d or 0, n, c) for d, n, c in want)
    at = 0
    for g in sorted(got, key=lambda g: g.start):
        assert g.start == at
        at += g.n_tokens
    ordered = [g.doc_id for g in sorted(got, key=lambda g: g.start)]
    assert ordered[0] is None and ordered[1:] == sorted(ordered[1:])


def test_empty_table(spark, tmp_path):
    write_ids(spark.createDataFrame([], "doc_id long, text string"), PATH, 0, f"{tmp_path}/t")
    assert read_ids(spark, f"{tmp_path}/t").count() == 0
