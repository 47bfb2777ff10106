"""Byte-level BPE: every distinct word is encoded once for the whole corpus.

Documents are cut into pre-tokens block by block (a block is some megabytes of
text).  A block's distinct words are exploded into buckets by a hash of the
word, a row per block and bucket; a bucket gathers the words of all blocks,
encodes each distinct one once, and sends the ids home.  There they are joined
to the block's pre-tokens, kept as codes in order of position.  A hot word
costs one entry per block, not one per occurrence.
"""

import base64
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.batches import flat, ranges, release, steps

#: The split of texts that the rank files of byte-level vocabularies assume (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BLOCK_BYTES = 4 << 20
#: Bytes of text that are cut at once.
CUT_BYTES = 1 << 20
#: Bytes of text behind one bucket of words.
BUCKET_BYTES = 24 << 20
_OTHER, _LETTER, _NUMBER, _SPACE, _END = range(5)


def rank_file(path) -> bytes:
    with open(path, "rb") as f:
        return f.read()


@cache
def encoder(ranks_text: bytes):
    """The tokenizer of a rank file, and the bytes of each id."""
    import tiktoken

    ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, ranks_text.splitlines() or [])}
    table = [b""] * (max(ranks.values()) + 1)
    for word, rank in ranks.items():
        table[rank] = word
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), pa.array(table, pa.large_binary())


@cache
def character_classes() -> np.ndarray:
    """The class of every code point as the tokenizer library's own patterns see it."""
    import tiktoken

    ranks = {bytes([i]): i for i in range(256)}
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    text = "".join(map(chr, points))
    classes = np.zeros(0x110000, np.uint8)
    for pattern, kind in ((r"\p{L}", _LETTER), (r"\p{N}", _NUMBER), (r"\s", _SPACE)):
        found = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary(text)
        members = np.frombuffer(bytes(found).decode().encode("utf-32-le"), np.uint32)
        classes[members] = kind
    return classes


def pre_tokens(data, offsets) -> tuple[pa.Array, np.ndarray]:
    """All pre-tokens of a run of texts in order, and the first one of each text.

    The same cut as ``PATTERN``: a run of one class is a token; a blank before
    it belongs to it; of other white space before it the last character stands
    alone; an apostrophe with one of the seven endings is a token.
    """
    lengths = np.diff(offsets)
    # One closing byte after every text keeps runs from crossing texts.
    at = offsets[1:] + np.arange(len(lengths))
    padded = np.zeros(len(data) + len(lengths), np.uint8)
    mask = np.ones(len(padded), bool)
    mask[at] = False
    padded[mask] = data
    lead = (padded & 0xC0) != 0x80
    places = np.flatnonzero(lead)
    points = np.frombuffer(padded.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    closing = np.searchsorted(places, at)
    kinds = character_classes()[points]
    kinds[closing] = _END
    n = len(points)
    start = np.empty(n, bool)
    start[:1] = True
    start[1:] = kinds[1:] != kinds[:-1]
    start[closing] = True
    following = np.append(kinds[1:], _END)
    last_blank = np.flatnonzero((kinds == _SPACE) & (following < _SPACE))
    start[last_blank] = True
    start[last_blank[points[last_blank] == 32] + 1] = False
    mark = np.flatnonzero((points == 39) & start & (following == _LETTER))
    one, two = points[mark + 1], points[np.minimum(mark + 2, n - 1)]
    short = np.isin(one, [ord(c) for c in "stmd"])
    pair = np.isin(one, [ord("r"), ord("v")]) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    start[mark[short | pair] + 1] = False
    start[mark[short] + 2] = True
    start[mark[pair] + 3] = True
    first = np.flatnonzero(start)
    is_end = kinds[first] == _END
    begins = places[first]
    spans = pa.Array.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(np.append(begins, len(padded)).astype(np.int64)), pa.py_buffer(padded)])
    # Tokens before each closing mark, less the marks themselves.
    marks = np.flatnonzero(is_end)
    return spans.filter(pa.array(~is_end)), np.concatenate([[0], marks - np.arange(len(marks))])


def _blocks(batches):
    """(block, ids, codes in order, first code of each text, distinct words) of every block."""
    task, serial = TaskContext.get().partitionId(), 0
    for batch in batches:
        data, offsets = flat(batch.column(1))
        for i, j in steps(offsets, BLOCK_BYTES):
            parts, bounds = [], [np.zeros(1, np.int64)]
            for a, b in steps(offsets[i:j + 1] - offsets[i], CUT_BYTES):
                own = offsets[i + a:i + b + 1]
                tokens, first = pre_tokens(data[own[0]:own[-1]], own - own[0])
                parts.append(tokens)
                bounds.append(first[1:] + bounds[-1][-1])
            coding = pa.concat_arrays(parts).dictionary_encode()
            del parts
            release()
            yield (task << 32) + serial, batch.column(0)[i:j], coding.indices.to_numpy(), np.concatenate(bounds), coding.dictionary
            serial += 1


def _word_hashes(words, offsets):
    """A 64-bit hash of every word of a flat array."""
    lengths = np.diff(offsets)
    powers = np.full(int(lengths.max(initial=0)) + 1, 0x9E3779B97F4A7C15, np.uint64).cumprod()
    mixed = (words.astype(np.uint64) + np.uint64(1)) * powers[ranges(np.zeros(len(lengths), np.int64), lengths)]
    out = np.add.reduceat(mixed, offsets[:-1]) if len(lengths) else np.zeros(0, np.uint64)
    return out ^ (out >> np.uint64(32))


def _explode_words(buckets):
    """A row per block and bucket: the block's words in the bucket, in order of their codes."""

    def run(batches):
        codec = pa.Codec("zstd", compression_level=3)
        for block, _, _, _, words in _blocks(batches):
            data, offsets = flat(words)
            bucket = (_word_hashes(data, offsets) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cut = np.flatnonzero(np.append(True, bucket[order][1:] != bucket[order][:-1])) if len(order) else order
            for a, b in zip(cut.tolist(), np.append(cut[1:], len(order)).tolist() if len(cut) else [], strict=True):
                own = order[a:b]
                lengths = np.diff(offsets)[own]
                text, sizes = data[ranges(offsets[own], lengths)].tobytes(), lengths.astype(np.uint32).tobytes()
                packed = [pa.array([codec.compress(x, asbytes=True)], pa.binary()) for x in (text, sizes)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(bucket[own[0]])]), pa.array([block]), *packed, pa.array([[len(text), len(own)]], pa.list_(pa.int64()))],
                    names=["bucket", "block", "words", "sizes", "raw"])

    return run


def _encode_bucket(ranks):
    """Encode every distinct word of a bucket once; the ids of each block's words, in their order."""

    def run(table: pa.Table) -> pa.Table:
        codec, (encoding, _) = pa.Codec("zstd", compression_level=3), encoder(ranks.value)
        texts, sizes, rows = [], [], table.to_pylist()
        for row in rows:
            texts.append(codec.decompress(row["words"], row["raw"][0], asbytes=True))
            sizes.append(np.frombuffer(codec.decompress(row["sizes"], row["raw"][1] * 4, asbytes=True), np.uint32))
        ends = np.concatenate([[0], np.cumsum(np.concatenate(sizes), dtype=np.int64)])
        given = pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(b"".join(texts))])
        coded = given.dictionary_encode()
        found = [encoding._encode_single_piece(w) for w in coded.dictionary.to_pylist()]
        counts = np.fromiter(map(len, found), np.uint32, len(found))
        pool = np.fromiter(chain.from_iterable(found), np.uint32, int(counts.sum()))
        starts, codes = np.cumsum(counts) - counts, coded.indices.to_numpy()
        at, out = 0, []
        for row, own in zip(rows, sizes, strict=True):
            code = codes[at:at + len(own)]
            at += len(own)
            ids, many = pool[ranges(starts[code], counts[code])], counts[code]
            # Ids below 65536 in two bytes.
            kind = np.uint16 if len(ids) == 0 or ids.max() < 1 << 16 else np.uint32
            packed = [codec.compress(x.tobytes(), asbytes=True) for x in (ids.astype(kind), many)]
            out.append((row["block"], row["bucket"], *packed, [len(ids), len(many), np.dtype(kind).itemsize]))
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()))
        return pa.table([pa.array([o[k] for o in out], kind) for k, kind in enumerate(kinds)], names=["home", "bucket", "ids", "counts", "raw"])

    return run


def _code_texts(buckets):
    """A row per block: its texts as codes, and each word's place among the ids sent home."""

    def run(batches):
        codec = pa.Codec("zstd", compression_level=3)
        for block, ids, codes, bounds, words in _blocks(batches):
            data, offsets = flat(words)
            bucket = (_word_hashes(data, offsets) % np.uint64(buckets)).astype(np.int64)
            place = np.empty(len(bucket), np.int64)
            place[np.argsort(bucket, kind="stable")] = np.arange(len(bucket))
            coded = place[codes].astype(np.uint16 if len(bucket) <= 1 << 16 else np.uint32)
            # The four bytes of a code compress better apart.
            planes = coded.view(np.uint8).reshape(-1, coded.itemsize).T.tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array([block]), pa.array([ids.to_pylist()], pa.list_(ids.type)), pa.array([bounds], pa.list_(pa.int64())),
                 pa.array([codec.compress(planes, asbytes=True)], pa.binary()), pa.array([[len(planes), coded.itemsize, len(bucket)]], pa.list_(pa.int64()))],
                names=["block", "keys", "bounds", "codes", "raw"])

    return run


def _bytes_of(values, bounds, table):
    """The bytes of every run of ids: the token-byte table joined by position in it."""
    data, at = flat(table.take(values))
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(at[bounds].astype(np.int32)), pa.py_buffer(data)])


def _place(names, id_type, ranks):
    """The ids of a block's texts by position, and their bytes if there is a third name."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        codec = pa.Codec("zstd")
        pools, many = [np.zeros(0, np.uint32)], [np.zeros(0, np.uint32)]
        for row in sorted(right.to_pylist(), key=lambda r: r["bucket"]):
            n_ids, n_words, width = row["raw"]
            pools.append(np.frombuffer(codec.decompress(row["ids"], n_ids * width, asbytes=True), np.uint16 if width == 2 else np.uint32).astype(np.uint32))
            many.append(np.frombuffer(codec.decompress(row["counts"], n_words * 4, asbytes=True), np.uint32))
        pool, counts = np.concatenate(pools), np.concatenate(many).astype(np.int64)
        starts = np.cumsum(counts) - counts
        keys, columns = [], [[], []]
        for row in left.to_pylist():
            size, width, n_words = row["raw"]
            if n_words != len(counts):
                raise ValueError("the documents changed between two reads of a block")
            planes = np.frombuffer(codec.decompress(row["codes"], size, asbytes=True), np.uint8)
            codes = np.ascontiguousarray(planes.reshape(width, -1).T).view(np.uint16 if width == 2 else np.uint32)[:, 0]
            # In steps, as the gathered index is wider than the ids.
            out = [pool[ranges(starts[part], counts[part])] for part in (codes[a:a + (1 << 18)] for a in range(0, len(codes), 1 << 18))]
            at = np.concatenate([[0], np.cumsum(counts[codes])])[np.asarray(row["bounds"])]
            values = pa.array((np.concatenate(out) if out else pool[:0]).view(np.int32))
            keys += row["keys"]
            columns[0].append(pa.ListArray.from_arrays(pa.array(at, pa.int32()), values))
            if len(names) == 3:
                columns[1].append(_bytes_of(values, at, encoder(ranks.value)[1]))
        table = pa.table([pa.array(keys, id_type), *(pa.concat_arrays(c) for c in columns if c)], names=names)
        del columns, pools, many
        release()
        return table

    return run


def encode(docs: DataFrame, ranks_path: str, id_col="doc_id", text_col="text", with_bytes=False, bucket_bytes=BUCKET_BYTES) -> DataFrame:
    """Token ids of every whole text: (id_col, token_ids array<int>), one row per input row.

    ``with_bytes`` decodes the ids where they are placed and adds ``decoded``,
    which spares reading them once more.

    A null or empty text has no ids; a null id stays null; repeated rows are
    encoded each.  The rank file is read on the driver and broadcast: a
    vocabulary is a few megabytes whatever the corpus.  ``docs`` is read twice,
    once for its words and once for their places, which is cheaper than
    keeping both; it has to give the same rows in the same order, as files and
    written tables do.
    """
    spark = docs.sparkSession
    ranks = spark.sparkContext.broadcast(rank_file(ranks_path))
    source = docs.select(F.col(id_col).cast("long").alias("key"), F.col(text_col).alias("text"))
    total = docs.select(F.sum(F.octet_length(text_col))).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    words = source.mapInArrow(_explode_words(buckets), "bucket long, block long, words binary, sizes binary, raw array<long>")
    sent = words.groupBy("bucket").applyInArrow(_encode_bucket(ranks), "home long, bucket long, ids binary, counts binary, raw array<long>")
    coded = source.mapInArrow(_code_texts(buckets), "block long, keys array<long>, bounds array<long>, codes binary, raw array<long>")
    names = [id_col, "token_ids"] + ["decoded"] * with_bytes
    schema = f"`{id_col}` long, token_ids array<int>" + ", decoded binary" * with_bytes
    return coded.groupBy("block").cogroup(sent.groupBy("home")).applyInArrow(_place(names, pa.int64(), ranks), schema)


def decode(tokens: DataFrame, ranks_path: str, id_col="doc_id") -> DataFrame:
    """The bytes of every row's ids: (id_col, token_ids, decoded binary).

    The token-byte table has one row per vocabulary entry and is broadcast; the
    join is by position in it.  An id outside the table raises.  Null ids give
    no bytes.
    """
    ranks = tokens.sparkSession.sparkContext.broadcast(rank_file(ranks_path))

    def run(batches):
        _, table = encoder(ranks.value)
        for batch in batches:
            lists = batch.column(1)
            values, counts = lists.flatten(), lists.value_lengths().fill_null(0).to_numpy()
            bounds = np.concatenate([[0], np.cumsum(counts)])
            for i, j in steps(bounds, 1 << 20):
                rows = _bytes_of(values[bounds[i]:bounds[j]], bounds[i:j + 1] - bounds[i], table)
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], lists[i:j], rows], names=[id_col, "token_ids", "decoded"])

    source = tokens.select(F.col(id_col), F.col("token_ids"))
    return source.mapInArrow(run, f"`{id_col}` long, token_ids array<int>, decoded binary")


def digests(decoded: DataFrame, *more) -> DataFrame:
    """Count and hashes of ids and of decoded bytes, then the columns ``more``."""
    return decoded.select(
        "doc_id", F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), *more,
    )


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def round_trip(docs: DataFrame, ranks_path=None) -> DataFrame:
    """Encode, decode and digest: (doc_id, n_tokens, ids_sha256, decoded_sha256)."""
    ranks_path = ranks_path or default_ranks()
    return digests(encode(docs, ranks_path, with_bytes=True))
