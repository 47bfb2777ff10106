"""Removal of repeated passages by longest-previous-factor arrays over a dealt suffix order.

A byte goes if it lies in a 100-byte string that also starts earlier in the
corpus.  One suffix order of all texts would be one task's work, so suffixes
are dealt by content: the least-hashed 16 bytes within the first 100 bytes of a
suffix (its anchor) are the same wherever those 100 bytes occur.  Neighbouring
suffixes mostly share their anchor and travel as one string of about 145 bytes.
Within a bucket of anchors, strings that occur whole elsewhere are settled by
their first occurrence; the others' suffixes are put in suffix order (to a
depth of 100 bytes, ties by position), and the longest previous factor of a
suffix is read off its previous smaller position in that order.

Anchors with very many occurrences are found first; their suffixes are dealt
one by one by a hash of their 100 bytes instead, so no group of different
strings grows with one frequent anchor.
"""

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.batches import flat, ranges, steps
from sluice.session import materialize

LENGTH = 100
ANCHOR = 16
BLOCK_BYTES = 8 << 20
STEP = 2 << 20
#: Bytes of text behind one bucket, and rows beyond which an anchor's suffixes are dealt singly.
BUCKET_BYTES = 8 << 20
HOT_ROWS = 65_536
HOT_ANCHORS = 1 << 20
#: What stands for a document without an id: it comes last.
_NO_ID = 0x7FFFFFFFFFFFFFFF
_SINGLE = 255

_M1, _M2, _M3 = (np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def _words(data, big=False):
    """The eight bytes from every place on as one number."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    view = np.ndarray((len(data) + 1,), ">u8" if big else "<u8", padded.data, strides=(1,))
    return view[:len(data)].astype(np.uint64)


def _hash(eight, at, size):
    """64-bit hash of ``size`` bytes (8 at least) at the places ``at``; ``eight`` comes from ``_words``."""
    h = np.full(len(at), size, np.uint64)
    for k in [*range(0, size - 7, 8), *([size - 8] if size % 8 else [])]:
        h = (h ^ (eight[at + k] * _M2)) * _M1
        h ^= h >> np.uint64(29)
    h *= _M3
    return h ^ (h >> np.uint64(32))


def _sliding_min(values, width):
    """Minimum of ``width`` values from every place on."""
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[:len(values) - rest], values[rest:]) if rest else values


def _runs(data, offsets, length):
    """Runs of window starts with one anchor: start, number of windows, anchor, text number."""
    empty = np.zeros(0, np.int64)
    if len(data) < length:
        return empty, empty, empty, empty
    eight = _words(data)
    order = (eight[:-8] * _M1) ^ (eight[8:] * _M2)
    order ^= order >> np.uint64(31)
    order *= _M3
    n = len(data) - ANCHOR + 1
    order = (order[:n] & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
    least = (_sliding_min(order, length - ANCHOR + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    del order
    sizes = np.maximum(np.diff(offsets) - length + 1, 0)
    starts = ranges(offsets[:-1], sizes)
    if not len(starts):
        return empty, empty, empty, empty
    anchor = least[starts]
    fresh = np.ones(len(starts), bool)
    fresh[1:] = (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)
    row = np.repeat(np.arange(len(sizes)), sizes)
    fresh[1:] |= row[1:] != row[:-1]
    first = np.flatnonzero(fresh)
    return starts[first], np.diff(np.append(first, len(starts))), anchor[first], row[first]


def _gather(data, starts, lengths):
    """The bytes of ranges that may overlap, one after the other."""
    out = np.empty(int(lengths.sum()), np.uint8)
    at = 0
    for i in range(0, len(starts), 8192):
        part = data[ranges(starts[i:i + 8192], lengths[i:i + 8192])]
        out[at:at + len(part)] = part
        at += len(part)
    return out


def _blocks(batches, limit=BLOCK_BYTES):
    """(serial, ids, tags, data, offsets) of some megabytes of text each."""
    serial = 0
    for batch in batches:
        data, offsets = flat(batch.column(2))
        ids, tags = (batch.column(k).to_numpy() for k in (0, 1))
        for i, j in steps(offsets, limit):
            yield serial, ids[i:j], tags[i:j], data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
            serial += 1


def _block_runs(data, offsets, length):
    """The runs of a block, computed in smaller steps."""
    parts = []
    for i, j in steps(offsets, STEP):
        start, count, anchor, row = _runs(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], length)
        parts.append((start + offsets[i], count, anchor + offsets[i], row + i))
    if not parts:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(p) for p in zip(*parts, strict=True))


def _frequent(length, least):
    """Anchors with ``least`` runs or more in a block, and their number there."""

    def run(batches):
        for _, _, _, data, offsets in _blocks(batches):
            _, _, anchor, _ = _block_runs(data, offsets, length)
            keys, counts = np.unique(_hash(_words(data), anchor, ANCHOR), return_counts=True)
            often = counts >= least
            yield pa.RecordBatch.from_arrays([pa.array(keys[often].view(np.int64)), pa.array(counts[often])], names=["anchor", "n"])

    return run


_DEALT = "bucket int, block long, strings binary, sizes binary, at binary, codes binary, docs binary, starts binary, ids binary, tags binary, raw array<long>"


def _packed(codec, *arrays):
    raw = [a.tobytes() for a in arrays]
    return [codec.compress(r, asbytes=True) if r else b"" for r in raw], [len(r) for r in raw]


def _row(bucket, block, packed, sizes):
    names = [f.split()[0] for f in _DEALT.split(", ")]
    arrays = [pa.array([bucket], pa.int32()), pa.array([block], pa.int64()), *(pa.array([p], pa.binary()) for p in packed), pa.array([sizes], pa.list_(pa.int64()))]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def _deal(length, buckets, hot):
    """One row per block and bucket: distinct strings, and every place where they stand."""

    def run(batches):
        task = TaskContext.get().partitionId()
        codec = pa.Codec("zstd", compression_level=6)
        often = hot.value
        for serial, ids, tags, data, offsets in _blocks(batches):
            block = (task << 32) + serial
            start, count, anchor, row = _block_runs(data, offsets, length)
            eight = _words(data)
            key = _hash(eight, anchor, ANCHOR) if len(anchor) else np.zeros(0, np.uint64)
            at = (anchor - start).astype(np.uint8)
            if len(often) and len(key):
                single = often[np.minimum(np.searchsorted(often, key), len(often) - 1)] == key
                if single.any():
                    alone = ranges(start[single], count[single])
                    key = np.append(key[~single], _hash(eight, alone, length))
                    at = np.append(at[~single], np.full(len(alone), _SINGLE, np.uint8))
                    row = np.append(row[~single], np.repeat(row[single], count[single]))
                    start = np.append(start[~single], alone)
                    count = np.append(count[~single], np.ones(len(alone), np.int64))
            del eight
            bucket = (key % np.uint64(buckets)).astype(np.int64)
            by = np.argsort(bucket, kind="stable")
            start, count, row, at, bucket = start[by], count[by], row[by], at[by], bucket[by]
            bounds = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(0, np.int64)
            for a, b in zip(bounds.tolist(), np.append(bounds[1:], len(bucket)).tolist() if len(bounds) else [], strict=True):
                size = count[a:b] + length - 1
                text = _gather(data, start[a:b], size)
                ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
                coded = pa.Array.from_buffers(pa.large_binary(), b - a, [None, pa.py_buffer(ends), pa.py_buffer(text)]).dictionary_encode()
                codes = coded.indices.to_numpy().astype(np.uint32)
                strings, string_ends = flat(coded.dictionary)
                _, first = np.unique(codes, return_index=True)
                docs = row[a:b]
                inside = start[a:b] - offsets[docs]
                packed, raw = _packed(codec, strings, np.diff(string_ends).astype(np.uint8), at[a:b][first], np.diff(codes.astype(np.int64), prepend=0).astype(np.int32),
                                      np.diff(docs, prepend=0).astype(np.int32), inside.astype(np.uint32), np.diff(ids[docs], prepend=0))
                yield _row(int(bucket[a]), block, [*packed, b""], raw)
            packed, raw = _packed(codec, ids, tags)
            yield _row(serial % buckets, block, [b""] * 6 + packed, [0] * 6 + raw)

    return run


def _suffix_classes(text, windows, length):
    """The rank of every window's first ``length`` bytes in suffix order, by prefix doubling."""
    def ranked(key):
        order = np.argsort(key)
        step = np.empty(len(key), bool)
        step[:1] = False
        step[1:] = key[order][1:] != key[order][:-1]
        rank = np.empty(len(key), np.uint64)
        rank[order] = np.cumsum(step).astype(np.uint64)
        return rank

    rank, depth = ranked(_words(text, big=True)), 8
    while 2 * depth <= length:
        # Whatever lies beyond the end belongs to no window.
        rank = ranked(rank << np.uint64(32) | np.append(rank[depth:], np.zeros(min(depth, len(rank)), np.uint64)))
        depth *= 2
    if depth == length:
        return rank[windows]
    return ranked(rank[windows] << np.uint64(32) | rank[windows + length - depth])


def _repeated_starts(text, windows, position, length):
    """Windows whose longest previous factor has ``length`` bytes at least.

    In suffix order with ties by position the previous smaller position of a
    suffix, as far as it shares all ``length`` bytes, is the one before it.
    """
    rank = _suffix_classes(text, windows, length)
    order = np.lexsort([position, rank])
    group = np.append(True, rank[order][1:] != rank[order][:-1])
    first = position[order][np.maximum.accumulate(np.where(group, np.arange(len(order)), 0))]
    out = np.zeros(len(windows), bool)
    out[order] = position[order] > first
    return out


def _unlikely(text, begin, size, at, key, length):
    """Strings that share with no other of their anchor what any common window would have to hold.

    A window reaches half of its bytes beyond the anchor to the left or to the
    right, so a partner has the same bytes on one of these sides.
    """
    reach = (length - ANCHOR) // 2 // 8 * 8
    eight = _words(text)
    likely = at == _SINGLE
    for side in (0, 1):
        # The side's bytes together with the anchor.
        first = at.astype(np.int64) - (reach if side == 0 else 0)
        has = (at != _SINGLE) & (first >= 0) & (first + reach + ANCHOR <= size)
        rows = np.flatnonzero(has)
        mark = _hash(eight, begin[rows] + first[rows], reach + ANCHOR) ^ key[rows]
        _, which, n = np.unique(mark, return_inverse=True, return_counts=True)
        likely[rows[n[which] > 1]] = True
    return ~likely


def _settle(length):
    """Repeated spans of a bucket, by block and document; block directories pass through."""
    def run(table: pa.Table) -> pa.Table:
        codec = pa.Codec("zstd")
        texts, sizes, at, code, block, doc, start, ids, through = [], [], [], [], [], [], [], [], []
        n_strings = 0
        for row in table.to_pylist():
            kinds = {"strings": np.uint8, "sizes": np.uint8, "at": np.uint8, "codes": np.int32, "docs": np.int32, "starts": np.uint32, "ids": np.int64}
            if row["tags"]:
                through.append((row["block"], row["ids"], row["tags"], row["raw"][6]))
                continue
            got = {n: np.frombuffer(codec.decompress(row[n], raw, asbytes=True), kinds[n]) if raw else np.zeros(0, kinds[n]) for n, raw in zip(kinds, row["raw"], strict=True)}
            texts.append(got["strings"])
            sizes.append(got["sizes"].astype(np.int64))
            at.append(got["at"])
            code.append(np.cumsum(got["codes"].astype(np.int64)) + n_strings)
            n_strings += len(got["sizes"])
            block.append(np.full(len(got["codes"]), row["block"], np.int64))
            doc.append(np.cumsum(got["docs"].astype(np.int64)))
            start.append(got["starts"].astype(np.int64))
            ids.append(np.cumsum(got["ids"]))
        found = [np.zeros(0, np.int64)] * 4
        if texts:
            found = _spans_of(np.concatenate(texts), np.concatenate(sizes), np.concatenate(at), np.concatenate(code),
                              np.concatenate(block), np.concatenate(doc), np.concatenate(start), np.concatenate(ids), length)
        blocks, docs, begin, end = found
        by = np.lexsort([begin, docs, blocks])
        blocks, docs, begin, end = blocks[by], docs[by], begin[by], end[by]
        cut = np.flatnonzero(np.append(True, blocks[1:] != blocks[:-1])) if len(blocks) else np.zeros(0, np.int64)
        stop = np.append(cut[1:], len(blocks)) if len(cut) else cut
        out = [(int(blocks[a]), docs[a:b].tobytes(), begin[a:b].tobytes(), end[a:b].tobytes(), None, None, 0) for a, b in zip(cut.tolist(), stop.tolist(), strict=True)]
        out += [(b, None, None, None, i, t, n) for b, i, t, n in through]
        kinds = [pa.int64()] + [pa.binary()] * 5 + [pa.int64()]
        return pa.table([pa.array([o[k] for o in out], kind) for k, kind in enumerate(kinds)], names=["block", "docs", "begins", "ends", "ids", "tags", "raw"])

    return run


def _spans_of(text, size, at, code, block, doc, start, ids, length):
    ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    coded = pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(text)]).dictionary_encode()
    same = coded.indices.to_numpy().astype(np.int64)
    n = len(coded.dictionary)
    own = np.zeros(n, np.int64)
    own[same[::-1]] = np.arange(len(same))[::-1]
    begin, size, at = ends[own], size[own], at[own]
    code = same[code]
    # A position is its document's rank by id, then the byte.
    _, rank = np.unique(ids, return_inverse=True)
    place = rank.astype(np.int64) << 32 | start
    order = np.lexsort([place, code])
    lead = np.flatnonzero(np.append(True, code[order][1:] != code[order][:-1]))
    first = np.empty(n, np.int64)
    first[code[order][lead]] = place[order][lead]
    later = place > first[code]
    spans = [(block[later], doc[later], start[later], start[later] + size[code[later]])]
    eight = _words(text)
    key = np.empty(n, np.uint64)
    single = at == _SINGLE
    key[single] = _hash(eight, begin[single], length)
    key[~single] = _hash(eight, begin[~single] + at[~single].astype(np.int64), ANCHOR)
    del eight
    _, which, members = np.unique(key, return_inverse=True, return_counts=True)
    rest = np.flatnonzero(members[which] > 1)
    if len(rest):
        rest = rest[~_unlikely(text, begin[rest], size[rest], at[rest], key[rest], length)]
    if len(rest):
        packed = _gather(text, begin[rest], size[rest])
        base = np.cumsum(size[rest]) - size[rest]
        count = size[rest] - length + 1
        windows = ranges(base, count)
        inside = ranges(np.zeros(len(rest), np.int64), count)
        again = _repeated_starts(packed, windows, np.repeat(first[rest], count) + inside, length)
        # Runs of repeated windows within a string, for every place that is its first.
        string = np.repeat(rest, count)[again]
        inside = inside[again]
        head = np.flatnonzero(np.append(True, (string[1:] != string[:-1]) | (inside[1:] != inside[:-1] + 1))) if len(string) else np.zeros(0, np.int64)
        tail = np.append(head[1:], len(string)) - 1 if len(head) else head
        run_string, run_from, run_to = string[head], inside[head], inside[tail] + length
        bounds = np.searchsorted(run_string, np.arange(n + 1))
        firsts = np.flatnonzero(~later)
        firsts = firsts[bounds[code[firsts] + 1] > bounds[code[firsts]]]
        many = bounds[code[firsts] + 1] - bounds[code[firsts]]
        pick, who = ranges(bounds[code[firsts]], many), np.repeat(firsts, many)
        spans.append((block[who], doc[who], start[who] + run_from[pick], start[who] + run_to[pick]))
    return [np.concatenate(p) for p in zip(*spans, strict=True)]


_SPAN_LIST = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))


def _merge(table: pa.Table) -> pa.Table:
    """Merged spans of a block's documents, by id and tag."""
    codec = pa.Codec("zstd")
    ids = tags = np.zeros(0, np.int64)
    docs, begins, ends = [], [], []
    for row in table.to_pylist():
        if row["ids"] is not None:
            ids, tags = (np.frombuffer(codec.decompress(row[k], row["raw"], asbytes=True), np.int64) for k in ("ids", "tags"))
        else:
            for out, name in ((docs, "docs"), (begins, "begins"), (ends, "ends")):
                out.append(np.frombuffer(row[name], np.int64))
    out_ids, out_tags, out_spans = [], [], []
    if docs:
        doc, begin, end = (np.concatenate(x) for x in (docs, begins, ends))
        by = np.lexsort([begin, doc])
        doc, begin, end = doc[by], begin[by], end[by]
        # Reach so far; documents are set apart by an offset beyond any text.
        far = (doc << 32) + end
        reach = np.maximum.accumulate(far)
        head = np.flatnonzero(np.append(True, (doc << 32)[1:] + begin[1:] > reach[:-1]))
        stop = reach[np.append(head[1:], len(doc)) - 1] - (doc[head] << 32)
        spans: dict[int, list] = {}
        for d, a, b in zip(doc[head].tolist(), begin[head].tolist(), stop.tolist(), strict=True):
            spans.setdefault(d, []).append({"begin": a, "end": b})
        rows = np.array(list(spans), np.int64)
        out_ids, out_tags, out_spans = ids[rows], tags[rows], list(spans.values())
    return pa.table([pa.array(out_ids, pa.int64()), pa.array(out_tags, pa.int64()), pa.array(out_spans, _SPAN_LIST)], names=["key", "tag", "spans"])


def repeated_spans(docs: DataFrame, id_col="doc_id", text_col="text", length=LENGTH, hot_rows=HOT_ROWS, bucket_bytes=BUCKET_BYTES) -> DataFrame:
    """(key, tag, spans) of every text with bytes to remove.

    key: the id, the largest long for a null one; tag: xxhash64 of the text;
    spans: maximal runs (begin, end) of UTF-8 bytes covered by ``length``-byte
    strings that also start earlier, by (id, byte).  Rows that share an id hold
    the same positions and are not earlier than each other; repeated rows give
    one row here.  Texts shorter than ``length`` have no spans.
    """
    if not ANCHOR + 16 <= length <= 128:
        raise ValueError("length must be 32 to 128")
    spark = docs.sparkSession
    source = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("key"), F.xxhash64(text_col).alias("tag"), F.col(text_col).alias("text"))
    total = docs.select(F.sum(F.octet_length(text_col))).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    # Runs hold some 40 windows; the list of frequent anchors stays below HOT_ANCHORS.
    limit = max(hot_rows, total // 40 // HOT_ANCHORS)
    least = max(2, limit // max(1, -(-total // BLOCK_BYTES)))
    often = source.mapInArrow(_frequent(length, least), "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n")).where(F.col("n") >= limit)
    hot = np.sort(np.array([r.anchor for r in often.select("anchor").collect()], np.int64).view(np.uint64))
    dealt = source.mapInArrow(_deal(length, buckets, spark.sparkContext.broadcast(hot)), _DEALT)
    settled = dealt.groupBy("bucket").applyInArrow(_settle(length), "block long, docs binary, begins binary, ends binary, ids binary, tags binary, raw long")
    merged = settled.groupBy("block").applyInArrow(_merge, "key long, tag long, spans array<struct<begin:bigint,end:bigint>>")
    return materialize(merged.groupBy("key", "tag").agg(F.first("spans").alias("spans")), "repeated-spans")


def _cut(batches):
    for batch in batches:
        data, offsets = flat(batch.column(1))
        whole = memoryview(np.ascontiguousarray(data))
        kept = []
        for spans, a, b in zip(batch.column(2).to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            pieces, at = [], a
            for span in spans or ():
                pieces.append(whole[at:a + span["begin"]])
                at = a + span["end"]
            kept.append(b"".join([*pieces, whole[at:b]]))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(offsets)), batch.column(2), pa.array(kept, pa.binary())], names=["id", "n_bytes", "spans", "kept"])


def remove_repeats(docs: DataFrame, id_col="doc_id", text_col="text", **options) -> DataFrame:
    """(id_col, n_bytes, spans, kept binary) of every row: what was removed, and the bytes that stay.

    A null or empty text has no bytes.  The bytes that stay need not be UTF-8.
    """
    found = repeated_spans(docs, id_col, text_col, **options)
    given = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("key"), F.xxhash64(text_col).alias("tag"))
    joined = given.join(found, ["key", "tag"], "left").select("id", "text", "spans")
    return joined.mapInArrow(_cut, "id long, n_bytes long, spans array<struct<begin:bigint,end:bigint>>, kept binary").withColumnRenamed("id", id_col)


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row."""
    n_removed = F.expr("coalesce(aggregate(spans, 0L, (n, s) -> n + s.end - s.begin), 0L)")
    return remove_repeats(docs).select(
        "doc_id", "n_bytes", n_removed.alias("n_removed"), F.coalesce(F.size("spans"), F.lit(0)).cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))
