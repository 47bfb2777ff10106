"""Tokenizing operators beside the libraries themselves."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from sluice.llm import bpe, token_index
from sluice.llm.batches import flat
from sluice.session import fresh_folder


@pytest.fixture(scope="module")
def ranks():
    return bpe.encoder(bpe.rank_file(bpe.default_ranks()))[0]


@pytest.fixture(scope="module")
def library():
    return token_index._encoder(open(token_index.default_tokenizer()).read())


def made_up(n, alphabet, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_pre_tokens(ranks):
    texts = made_up(4_000, " '  \n\t\xa0\u3000\x1f\x85strvemdlaZé\u0301ß漢字①1²9½.,!#$\u200b😀\x00", 1) + ["", "'s", "''s", "'s's", " 's", "'llx"]
    tokens, first = bpe.pre_tokens(*flat(pa.array(texts)))
    tokens = tokens.to_pylist()
    for text, a, b in zip(texts, first[:-1], first[1:], strict=True):
        assert b"".join(tokens[a:b]) == text.encode()
        assert [i for w in tokens[a:b] for i in ranks._encode_single_piece(w)] == ranks.encode_ordinary(text)


def test_byte_bpe(docs, rows, ranks):
    want = {}
    for d, t in rows:
        ids = ranks.encode_ordinary(t or "")
        want[d] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
    assert {r.doc_id: tuple(r)[1:] for r in bpe.round_trip(docs).collect()} == want


def test_byte_bpe_many_buckets_and_decode(docs, rows):
    path = bpe.default_ranks()
    back = bpe.decode(bpe.encode(docs, path, bucket_bytes=32 << 10), path)
    assert {r.doc_id: bytes(r.decoded).decode() for r in back.collect()} == {d: t or "" for d, t in rows}


def test_byte_bpe_repeated_and_empty(repeated, empty, rows):
    got = bpe.round_trip(repeated).collect()
    assert len(got) == 2 * len(rows) + 1 and sum(r.doc_id is None for r in got) == 1
    assert bpe.round_trip(empty).collect() == []


def test_pieces(library):
    texts = made_up(4_000, "aAbZ' .,=!<|>s t12\n\tÉéÉ\u0338\u030cJj漢🙂\x00\x1c\xa0#endoftext—", 5) + ["<|endoftext|> <|EndOfText|> it's IT'S J\u030c", "x" * 3_000]
    ids, counts = library.ids(*flat(pa.array(texts)))
    at = np.append(0, np.cumsum(counts))
    for k, text in enumerate(texts):
        assert ids[at[k]:at[k + 1]].tolist() == library.tokenizer.encode(text, add_special_tokens=False).ids


def test_token_index(docs, rows, library):
    want, at = {}, 0
    for d, t in sorted(rows):
        ids = np.array(library.tokenizer.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        want[d] = (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert {r.doc_id: tuple(r)[1:] for r in token_index.report(docs).collect()} == want


def test_token_index_repeated_and_empty(repeated, empty, rows):
    got = token_index.report(repeated).orderBy("start").collect()
    assert len(got) == 2 * len(rows) + 1 and got[0].doc_id is None
    assert [r.doc_id for r in got[1:]] == sorted(r.doc_id for r in got[1:])
    assert all(a.start + a.n_tokens == b.start for a, b in zip(got[:-1], got[1:], strict=True))
    assert token_index.report(empty).collect() == []


def test_lookup(spark, docs, rows, library):
    path = token_index.write_shards(docs, fresh_folder(spark, "shards"), token_index.default_tokenizer(), shard_ids=2_000)
    assert spark.read.parquet(f"{path}/manifest").count() > 3
    keys = spark.createDataFrame([(d,) for d, _ in rows[::3]] + [(999_999,), (0,), (None,)], "doc_id long")
    got = {r.key: r.ids for r in token_index.lookup(keys, path).collect()}
    assert got == {d: library.tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for d, t in rows[::3]}


def test_perfect_index():
    keys = np.unique(np.random.default_rng(1).integers(-(1 << 62), 1 << 62, 5_000))
    index = token_index.PerfectIndex.build(keys)
    assert sorted(index.find(keys)) == list(range(len(keys)))
    assert (index.find(keys + 1) >= 0).sum() <= 3
    with pytest.raises(ValueError):
        token_index.PerfectIndex.build(np.array([1, 1], np.int64))


def test_token_index_other_tokenizers(docs, rows, tmp_path):
    from tokenizers import Tokenizer, models, pre_tokenizers

    words = Tokenizer(models.WordLevel({"[UNK]": 0, "hello": 1, "world": 2, "a1": 3}, unk_token="[UNK]"))
    words.pre_tokenizer = pre_tokenizers.Whitespace()
    words.save(str(tmp_path / "words.json"))
    for path in [str(tmp_path / "words.json"), "/opt/tokenizers/byte_bpe_50k.json"]:
        library = Tokenizer.from_file(path)
        assert not token_index.cuts_as_pieces(open(path).read())
        want, at = {}, 0
        for d, t in sorted(rows):
            ids = np.array(library.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
            want[d] = (at, len(ids), zlib.crc32(ids.tobytes()))
            at += len(ids)
        assert {r.doc_id: tuple(r)[1:] for r in token_index.report(docs, path).collect()} == want
