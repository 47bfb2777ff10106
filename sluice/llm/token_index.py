"""Token ids in shards of raw payload, with a minimal perfect hash index over the keys.

A shard is one row of a Parquet table: the little-endian ids of consecutive
documents in ascending key order, where each document begins, and an index
from a key to its place.  The index is a minimal perfect hash in levels
(Limasset et al., "Fast and scalable minimal perfect hashing"): a key's bit in
the first level where no other key shares it, ranked by counted bits, is its
slot; a slot holds a fingerprint of the key, so that a foreign key is told
apart, and the key's first document.  A lookup costs the same in any shard.
"""

import json
import os
import zlib
from array import array
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.llm.batches import BLANK, LOWER, flat, ranges, steps
from sluice.session import fresh_folder

END_ID = 2
#: Ids after which a shard is closed; a longer document is a shard of its own.
SHARD_IDS = 2 << 20
#: Pieces whose ids a worker remembers; then it forgets those not in sight.
_REMEMBERED = 900_000
_GAMMA = 2
_LEVELS = 48
#: What stands for a document without a key.
_NO_KEY = np.int64(-0x7FFFFFFFFFFFFFFF)


_ALL = np.arange(256)
#: 0 letters, 1 digits, 2 others: ASCII only.
_KIND = np.where((_ALL | 32 >= 97) & (_ALL | 32 <= 122), 0, np.where((_ALL >= 48) & (_ALL <= 57), 1, 2)).astype(np.uint8)
# The same as tables of 256 bytes: translating a text is faster than looking up every byte.
_SOLID, _KINDS, _LOWERED = (~BLANK).tobytes(), _KIND.tobytes(), LOWER.tobytes()
_ODD = ((_ALL >= 128) | (_ALL == 39) | (_ALL == 60)).tobytes()


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _mix(keys, seed):
    """64-bit hash of 64-bit keys."""
    x = keys.view(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectIndex:
    """Minimal perfect hash of distinct keys, with 32-bit fingerprints."""

    def __init__(self, sizes, bits, ranks, prints):
        self.sizes, self.bits, self.ranks, self.prints = sizes, bits, ranks, prints
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)

    @classmethod
    def build(cls, keys):
        sizes, levels, rest, level = [], [], keys, 0
        while len(rest):
            if level == _LEVELS:
                raise ValueError("keys are not distinct")
            size = -(-_GAMMA * len(rest) // 64) * 64
            place = (_mix(rest, level) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(place, minlength=size) == 1
            levels.append(alone)
            sizes.append(size)
            rest = rest[~alone[place]]
            level += 1
        flags = np.concatenate(levels) if levels else np.zeros(0, bool)
        bits = np.packbits(flags, bitorder="little").view(np.uint64)
        ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(bits), dtype=np.int64)])[:-1].astype(np.int64)
        made = cls(np.array(sizes, np.int64), bits, ranks, np.zeros(len(keys), np.uint32))
        made.prints[made._slots(keys)] = _mix(keys, 1 << 20).astype(np.uint32)
        return made

    def _slots(self, keys):
        slots = np.full(len(keys), -1, np.int64)
        open_keys = np.arange(len(keys))
        for level, size in enumerate(self.sizes.tolist()):
            own = keys[open_keys]
            place = (_mix(own, level) % np.uint64(size)).astype(np.int64) + self.starts[level]
            word, bit = place >> 6, (place & 63).astype(np.uint64)
            here = (self.bits[word] >> bit & np.uint64(1)).astype(bool)
            below = np.bitwise_count(self.bits[word[here]] & ((np.uint64(1) << bit[here]) - np.uint64(1)))
            slots[open_keys[here]] = self.ranks[word[here]] + below
            open_keys = open_keys[~here]
        return slots

    def find(self, keys):
        """The slot of every key, -1 for a key that was not indexed."""
        keys = np.asarray(keys, np.int64)
        slots = self._slots(keys)
        own = slots >= 0
        own[own] = self.prints[slots[own]] == _mix(keys[own], 1 << 20).astype(np.uint32)
        return np.where(own, slots, -1)


def _pieces(data, offsets):
    """Pieces of texts that the tokenizer treats one by one: array, and the first piece of each text.

    Its normaliser and splits never look across white space.  A run of ASCII
    without apostrophe or '<' is cut further where letters, digits and other
    characters meet, as the tokenizer does, and lower-cased.
    """
    raw = data.tobytes()
    solid = np.frombuffer(raw.translate(_SOLID), bool)
    begins, ends = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1]
    ends[:-1] &= ~solid[1:]
    edge = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
    begins[edge] |= solid[edge]
    ends[edge - 1] |= solid[edge - 1]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    if not len(starts):
        return pa.array([], pa.large_binary()), np.zeros(len(offsets), np.int64)
    odd = np.zeros(len(data) + 1, np.int32)
    np.cumsum(np.frombuffer(raw.translate(_ODD), np.uint8), dtype=np.int32, out=odd[1:])
    plain = odd[stops] == odd[starts]
    inside = np.zeros(len(data) + 1, np.int8)
    inside[starts[plain]] += 1
    inside[stops[plain]] -= 1
    simple = np.cumsum(inside[:-1], dtype=np.int8).view(bool)
    lower = np.where(simple, np.frombuffer(raw.translate(_LOWERED), np.uint8), data)
    kind = np.frombuffer(raw.translate(_KINDS), np.uint8)
    cut = simple & solid
    cut[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == 1)
    starts = np.flatnonzero(begins | cut)
    # Pieces are all bytes but white space, so what is left needs no other mark than its starts.
    before = np.zeros(len(data) + 1, np.int32)
    np.cumsum(solid, dtype=np.int32, out=before[1:])
    bounds = np.append(before[starts], before[-1]).astype(np.int64)
    pieces = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(lower[solid])])
    return pieces, np.searchsorted(starts, offsets)


# The normaliser and pre-tokenizer of word_bpe_49k.json, whose cuts ``_pieces`` makes.
PIECE_NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
PIECE_PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}


def cuts_as_pieces(text: str) -> bool:
    """Whether a tokenizer normalises and splits as ``_pieces`` does; others have whole texts encoded."""
    config = json.loads(text)
    return config.get("normalizer") == PIECE_NORMALIZER and config.get("pre_tokenizer") == PIECE_PRE_TOKENIZER


class _Encoder:
    """The library's ids of pieces; those of many pieces are remembered over a worker's tasks.

    A tokenizer that normalises or splits otherwise is given whole texts, so
    its ids are always the library's own.
    """

    def __init__(self, text):
        self.by_pieces = cuts_as_pieces(text)
        # Tasks are the parallelism; threads of the library would contend.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(text)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known: dict[bytes, bytes] = {}

    def ids(self, data, offsets):
        """Ids of all texts of a run and the number of each."""
        if not self.by_pieces:
            raw = data.tobytes()
            made = self.tokenizer.encode_batch_fast(
                [raw[a:b].decode() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)], add_special_tokens=False)
            sizes = np.array([len(e.ids) for e in made], np.int64)
            pool = np.fromiter((i for e in made for i in e.ids), np.uint32, int(sizes.sum()))
            return pool, sizes
        pieces, first = _pieces(data, offsets)
        coded = pieces.dictionary_encode()
        words = coded.dictionary.to_pylist()
        fresh = [w for w in words if w not in self.known]
        if len(self.known) + len(fresh) > _REMEMBERED:
            # What is met again and again stays.
            self.known = {w: self.known[w] for w in words if w in self.known}
        made = self.tokenizer.encode_batch_fast([w.decode() for w in fresh], add_special_tokens=False)
        self.known.update(zip(fresh, [array("I", e.ids).tobytes() for e in made], strict=True))
        found = [self.known[w] for w in words]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        pool = np.frombuffer(b"".join(found), np.uint32)
        starts, codes = np.cumsum(sizes) - sizes, coded.indices.to_numpy()
        total = np.concatenate([[0], np.cumsum(sizes[codes])])
        return pool[ranges(starts[codes], sizes[codes])], np.diff(total[first])


@cache
def _encoder(text: str) -> _Encoder:
    return _Encoder(text)


_SHARD = ("part int, serial int, n_docs long, n_ids long, least_key long, payload binary, bounds binary, keys binary, "
          "first_docs binary, level_sizes binary, bits binary, ranks binary, prints binary")


def _shard(part, serial, keys, counts, ids):
    keys, counts = np.concatenate(keys), np.concatenate(counts)
    distinct, first = np.unique(keys, return_index=True)
    index = PerfectIndex.build(distinct)
    places = np.zeros(len(distinct), np.int64)
    places[index.find(distinct)] = first
    blobs = [np.concatenate(ids).astype("<u4"), np.concatenate([[0], np.cumsum(counts)]).astype("<i8"), keys.astype("<i8"),
             places.astype("<i8"), index.sizes.astype("<i8"), index.bits.astype("<u8"), index.ranks.astype("<i8"), index.prints.astype("<u4")]
    names = [f.split()[0] for f in _SHARD.split(", ")]
    numbers = [pa.array([part], pa.int32()), pa.array([serial], pa.int32()), pa.array([len(keys)]), pa.array([int(counts.sum())]), pa.array([int(keys[0])])]
    return pa.RecordBatch.from_arrays(numbers + [pa.array([b.tobytes()], pa.binary()) for b in blobs], names=names)


def _pack(shared, end_id, shard_ids):
    def run(batches):
        encoder, part, serial = _encoder(shared.value), TaskContext.get().partitionId(), 0
        keys, counts, ids, held = [], [], [], 0
        for batch in batches:
            data, offsets = flat(batch.column(1))
            own_keys = batch.column(0).fill_null(int(_NO_KEY)).to_numpy()
            for i, j in steps(offsets, 2 << 20):
                own, sizes = encoder.ids(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                sizes = sizes + 1
                with_end = np.full(int(sizes.sum()), end_id, np.uint32)
                last = np.zeros(len(with_end), bool)
                last[np.cumsum(sizes) - 1] = True
                with_end[~last] = own
                ends, done = np.cumsum(sizes), 0
                while done < len(sizes):
                    before = int(ends[done - 1]) if done else 0
                    fits = int(np.searchsorted(ends, before + shard_ids - held, "right"))
                    if fits <= done and held:
                        yield _shard(part, serial, keys, counts, ids)
                        keys, counts, ids, held, serial = [], [], [], 0, serial + 1
                        continue
                    fits = max(fits, done + 1)
                    keys.append(own_keys[i + done:i + fits])
                    counts.append(sizes[done:fits])
                    ids.append(with_end[before:int(ends[fits - 1])])
                    held, done = held + int(ends[fits - 1]) - before, fits
        if keys:
            yield _shard(part, serial, keys, counts, ids)

    return run


def write_shards(docs: DataFrame, path: str, tokenizer_path: str, id_col="doc_id", text_col="text", end_id=END_ID, shard_ids=SHARD_IDS) -> str:
    """Encode every whole text and write shards in ascending key order below ``path``.

    Rows are range-partitioned by key before they are encoded; only keys and
    texts are shuffled, and no task holds more than a step of ids beside its
    open shard.  Rows without a key come first; rows that share a key follow
    each other in the order of their texts; a null or empty text is the end id
    alone.  A second, small table gives each shard's first id in the whole.
    """
    spark = docs.sparkSession
    with open(tokenizer_path) as f:
        shared = spark.sparkContext.broadcast(f.read())
    source = docs.select(F.col(id_col).cast("long").alias("key"), F.col(text_col).alias("text"))
    dealt = source.repartitionByRange("key").sortWithinPartitions("key", "text")
    dealt.mapInArrow(_pack(shared, end_id, shard_ids), _SHARD).write.option("compression", "zstd").parquet(f"{path}/shards")
    shards = spark.read.parquet(f"{path}/shards").select("part", "serial", "n_ids", "n_docs", "least_key")
    # One row per shard, not per document.
    before = F.sum("n_ids").over(Window.orderBy("part", "serial").rowsBetween(Window.unboundedPreceding, -1))
    shards.withColumn("first_id", F.coalesce(before, F.lit(0))).coalesce(1).write.parquet(f"{path}/manifest")
    return path


def _open(row):
    get = lambda name, kind: np.frombuffer(row[name], kind)
    index = PerfectIndex(get("level_sizes", "<i8"), get("bits", "<u8"), get("ranks", "<i8"), get("prints", "<u4"))
    return get("payload", "<u4"), get("bounds", "<i8"), get("keys", "<i8"), get("first_docs", "<i8"), index


def _read_back(batches):
    for batch in batches:
        for row in batch.to_pylist():
            payload, bounds, keys, first_docs, index = _open(row)
            slots = index.find(keys)
            if (slots < 0).any():
                raise ValueError("a document is not in its shard's index")
            # Documents of one key lie together: the first is looked up, the others follow it.
            run_at = first_docs[slots]
            doc = run_at + (np.arange(len(keys)) - np.maximum.accumulate(np.where(np.append(True, keys[1:] != keys[:-1]), np.arange(len(keys)), 0)))
            starts, ends = bounds[doc], bounds[doc + 1]
            view = memoryview(payload).cast("B")
            crc = np.array([zlib.crc32(view[a:b]) for a, b in zip((4 * starts).tolist(), (4 * ends).tolist(), strict=True)], np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, mask=keys == _NO_KEY), pa.array(starts + row["first_id"]), pa.array(ends - starts), pa.array(crc)],
                names=["doc_id", "start", "n_tokens", "ids_crc32"])


def _with_manifest(spark, path):
    shards = spark.read.parquet(f"{path}/shards").drop("n_ids", "n_docs", "least_key")
    return shards.join(spark.read.parquet(f"{path}/manifest"), ["part", "serial"])


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, each found through its shard's index."""
    return _with_manifest(spark, path).mapInArrow(_read_back, "doc_id long, start long, n_tokens long, ids_crc32 long")


def lookup(keys: DataFrame, path: str, key_col="doc_id") -> DataFrame:
    """(key, ids array<int>) of the documents with the given keys; a key without documents gives no row.

    The shard of a key is found by the shards' least keys (16 bytes a shard,
    broadcast); each shard is then read once for its own keys.  A key of
    several documents gives one row per document and shard that holds it.
    """
    spark = keys.sparkSession
    rows = spark.read.parquet(f"{path}/manifest").orderBy("part", "serial").select("part", "serial", "least_key").collect()
    bounds = spark.sparkContext.broadcast((np.array([r.least_key for r in rows], np.int64), [(r.part, r.serial) for r in rows]))

    def deal(batches):
        least, names = bounds.value
        for batch in batches:
            own = batch.column(0).to_numpy()
            low = np.maximum(np.searchsorted(least, own, "left") - 1, 0)
            high = np.searchsorted(least, own, "right")
            picked = [(k, *names[s]) for k, a, b in zip(own.tolist(), low.tolist(), high.tolist(), strict=True) for s in range(a, b)]
            yield pa.RecordBatch.from_arrays([pa.array([p[n] for p in picked], t) for n, t in enumerate((pa.int64(), pa.int32(), pa.int32()))], names=["key", "part", "serial"])

    def fetch(wanted: pa.Table, shard: pa.Table) -> pa.Table:
        out_keys, out_ids = [], []
        for row in shard.to_pylist():
            payload, starts, keys, first_docs, index = _open(row)
            asked = np.unique(wanted.column("key").to_numpy())
            slots = index.find(asked)
            for key, slot in zip(asked[slots >= 0].tolist(), slots[slots >= 0].tolist(), strict=True):
                doc = int(first_docs[slot])
                while doc < len(keys) and keys[doc] == key:
                    out_keys.append(key)
                    out_ids.append(payload[starts[doc]:starts[doc + 1]].astype(np.int32))
                    doc += 1
        return pa.table([pa.array(out_keys, pa.int64()), pa.array(out_ids, pa.list_(pa.int32()))], names=["key", "ids"])

    asked = keys.select(F.col(key_col).cast("long").alias("key")).where("key is not null").distinct()
    dealt = asked.mapInArrow(deal, "key long, part int, serial int")
    shards = spark.read.parquet(f"{path}/shards")
    return dealt.groupBy("part", "serial").cogroup(shards.groupBy("part", "serial")).applyInArrow(fetch, "key long, ids array<int>")


def report(docs: DataFrame, tokenizer_path=None) -> DataFrame:
    """Write the shards to the shared folder and read them back: see ``read_documents``."""
    spark = docs.sparkSession
    path = write_shards(docs, fresh_folder(spark, "token-shards"), tokenizer_path or default_tokenizer())
    return read_documents(spark, path)
