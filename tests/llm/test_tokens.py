from __future__ import annotations

import zlib

import numpy as np
import pytest

from locusframe.llm import byte_bpe, packing, token_files
from locusframe.llm.common import tokenizer_path
from locusframe.llm.tokens import BYTE_PATTERN, byte_memory, packed, spaced, word_memory, words
from tests.llm.helpers import awkward_rows, docs, prose

TEXTS = [t or "" for _, t, _ in awkward_rows()] + [
    "a  b", " a", "a\n\n\nb c", "don't it's, x!!\n", "a \n b\n c \n\n", "\n", " ", "x\x1cy !\x1c z", "a × b÷, c×, d",
    "é́ é", "word,word. (w) #a# $$$ $a", "tab\tand wide",
]


def library(name: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path(name))
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize(
    ("name", "memory", "keys"),
    [("word_bpe_49k.json", word_memory, words), ("byte_bpe_50k.json", byte_memory, spaced)],
)
def test_chunked_ids_are_those_of_the_library(name, memory, keys):
    encode = library(name)
    for text in TEXTS:
        assert memory(name).pack(keys(text.encode())) == packed(encode(text)), text


def test_byte_bpe_is_that_of_tiktoken(spark):
    import tiktoken

    name = "byte_bpe_multi_50k.tiktoken"
    encoder, memory = byte_bpe.loaded(name)
    known = tiktoken.Encoding("own", pat_str=BYTE_PATTERN, mergeable_ranks=encoder.ranks, special_tokens={})
    for text in [*TEXTS, "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", prose(5, 50), "zzzzqqqqxxxxjjjj" * 20]:
        ids = memory.pack(spaced(text.encode()))
        assert ids == packed(known.encode_ordinary(text)), text
        assert encoder.decode(ids) == text.encode()
    rows = byte_bpe.decode_ids(byte_bpe.encode_texts(docs(spark), name), name).collect()
    assert sorted((r.doc_id or 0, bytes(r.decoded)) for r in rows) == sorted(
        (i or 0, (t or "").encode()) for i, t, _ in awkward_rows()
    )
    assert byte_bpe.encode_texts(docs(spark, []), name).count() == 0


def test_memory_stays_bounded():
    memory = byte_memory("byte_bpe_50k.json")
    small = type(memory)(memory._encode, limit=20)
    for i in range(200):
        small.pack([b"w%d" % i, b"the"])
    assert len(small) <= 21 and len(small._old) <= 21


def test_repair_round_trip_and_random_access():
    rng = np.random.default_rng(1)
    texts = [np.append(rng.integers(2, 6, n), 1).astype("<u4") for n in (0, 1, 2, 500, 40)]
    texts += [np.append(np.full(333, 3), 1).astype("<u4"), np.append(np.tile([4, 5, 6], 200), 1).astype("<u4")]
    content = token_files.encode_shard([5, None, 7, 8, 9, 10, 11], texts, 100, 1, 1000)
    shard = token_files.Shard(content)
    assert shard.doc_ids() == [5, None, 7, 8, 9, 10, 11]
    for i, text in enumerate(texts):
        assert (shard.document(i) == text).all()
    whole = np.concatenate(texts)
    for start in range(0, len(whole), 37):
        assert (shard.tokens(start, start + 50) == whole[start : start + 50]).all()
    assert len(shard._symbols) < len(whole) // 2


def test_token_files_keep_order_and_ids(spark):
    encode = library("word_bpe_49k.json")
    manifest = token_files.write_shards(docs(spark), "word_bpe_49k.json", 49_408, end_id=1, shard_ids=500)
    rows = sorted(token_files.read_shards(manifest).collect(), key=lambda r: r.start)
    at = 0
    ordered = sorted(awkward_rows(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    for row, (doc_id, text, _) in zip(rows, ordered, strict=True):
        ids = packed([*encode(text or ""), 1])
        assert (row.doc_id, row.start, row.n_tokens, bytes(row.ids)) == (doc_id, at, len(ids) // 4, ids)
        at += row.n_tokens
    empty = token_files.write_shards(docs(spark, []), "word_bpe_49k.json", 49_408, end_id=1)
    assert token_files.read_shards(empty).count() == 0


def test_packing_places_every_id_once(spark):
    encode = library("byte_bpe_50k.json")
    many = awkward_rows() + [(100 + i, prose(i, 30 + i), "x") for i in range(150)]
    rows = packing.pack_documents(docs(spark, many).coalesce(2), "byte_bpe_50k.json", 0, window=256, piece=64).collect()
    windows: dict[int, list] = {}
    for row in rows:
        windows.setdefault(row.sequence_id, []).append(row)
        assert row.ids_crc32 == zlib.crc32(bytes(row.ids)) and len(row.ids) == 4 * row.length > 0
    for members in windows.values():
        at = 0
        for row in sorted(members, key=lambda r: r.offset):
            assert row.offset == at
            at += row.length
        assert at <= 256
    for doc_id, text, _ in many:
        whole = packed([*encode(text or ""), 0])
        pieces = sorted((r for r in rows if r.doc_id == doc_id), key=lambda r: r.start)
        copies = sum(1 for x in many if x[0] == doc_id)
        assert sum(r.length for r in pieces) == copies * len(whole) // 4
        for r in pieces:
            assert bytes(r.ids) == whole[4 * r.start : 4 * (r.start + r.length)] and r.doc_tokens == len(whole) // 4
    filled = sum(r.length for r in rows)
    assert filled / (256 * len(windows)) > 0.95
    assert packing.pack_documents(docs(spark, []), "byte_bpe_50k.json", 0).count() == 0


def test_differencing_is_near_equal_and_raises_the_count():
    sizes = [7, 7, 6, 5, 4, 3, 3, 2, 1]
    sums = sorted(sum(sizes[i] for i in w) for w in packing.differencing(sizes, 3))
    assert sum(sums) == sum(sizes) and sums[-1] - sums[0] <= 1
    # Three items of 6 fit no two windows of 10.
    dealt = packing.balanced([6, 6, 6], 10)
    assert len(dealt) == 3 and sorted(i for w in dealt for i in w) == [0, 1, 2]
