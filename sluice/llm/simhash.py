"""SimHash near-duplicates through anchor points of a covering code.

A fingerprint has 64 bits; two that differ in at most three bits agree up to
one bit in one of their halves.  31 bits of each half are looked at through
the perfect Hamming code [31, 26]: every 31-bit word is within one bit (the
covering radius) of exactly one codeword, its anchor.  If x and y differ in at
most one bit there, y is within two bits of x's anchor, so a fingerprint
replicated to every codeword within radius + 1 = 2 bits (one or 16 of them) of
each half meets all its partners at some anchor.  Distances are then compared
on all 64 bits per anchor.
"""

from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.batches import LOWER, flat, release, steps
from sluice.llm.components import components
from sluice.session import materialize

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
#: Rows of one anchor that one task compares; a larger anchor is dealt as pairs of tiles.
TILE_ROWS = 16_384


def _fingerprints(data, offsets, size, seed) -> np.ndarray:
    """64-bit fingerprints of texts: a bit is set if more than half of the shingle hashes have it."""
    lower = LOWER[data].tobytes()
    words = [lower[a:b].split() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    counts = np.array([len(w) for w in words], np.int64)
    joined = b" ".join(w for row in words for w in row)
    del words, lower
    blanks = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts, ends = np.append(0, blanks + 1), np.append(blanks, len(joined))
    first = np.cumsum(counts) - counts
    shingles = np.where(counts > 0, np.maximum(counts - size + 1, 1), 0)
    row_at = np.cumsum(shingles) - shingles
    begin = np.arange(int(shingles.sum()), dtype=np.int64) + np.repeat(first - row_at, shingles)
    end = np.minimum(begin + size, np.repeat(first + counts, shingles)) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts[begin].tolist(), ends[end].tolist(), strict=True)], np.uint64)
    out = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(shingles)
    if len(full):
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, row_at[full], axis=0, dtype=np.int64)
        majority = 2 * ones > shingles[full][:, None]
        out[full] = np.packbits(majority, axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def fingerprints(docs: DataFrame, id_col="doc_id", text_col="text", size=SHINGLE_WORDS, seed=SEED, carry=()) -> DataFrame:
    """(id_col, fingerprint long, *carry) of every row; a text without words has fingerprint zero."""
    carry = list(carry)

    def run(batches):
        for batch in batches:
            data, offsets = flat(batch.column(1))
            found = [_fingerprints(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], size, seed) for i, j in steps(offsets, 2 << 20)]
            values = np.concatenate(found) if found else np.zeros(0, np.uint64)
            release()
            extra = [batch.column(2 + k) for k in range(len(carry))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64)), *extra], names=[id_col, "fingerprint", *carry])

    source = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).alias("_fingerprint_text"), *[F.col(c) for c in carry])
    kinds = "".join(f", `{c}` {source.schema[c].dataType.simpleString()}" for c in carry)
    return source.mapInArrow(run, f"`{id_col}` long, fingerprint long{kinds}")


@cache
def _steps_to_codewords() -> tuple[np.ndarray, np.ndarray]:
    """For every byte of a word its syndrome part, and for every syndrome the flips that lead to codewords."""
    column = np.arange(1, 32)
    parts = np.zeros((4, 256), np.uint8)
    for k in range(4):
        for value in range(256):
            s = 0
            for bit in range(8):
                if value >> bit & 1 and 8 * k + bit < 31:
                    s ^= int(column[8 * k + bit])
            parts[k, value] = s
    flips = np.zeros((32, 16), np.uint32)
    for s in range(1, 32):
        masks = [1 << (s - 1)] + [1 << (i - 1) | 1 << ((i ^ s) - 1) for i in range(1, 32) if i < i ^ s and i ^ s]
        flips[s] = masks
    return parts, flips


def anchors(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every (anchor, row) of the fingerprints; the half is a bit of the anchor."""
    parts, flips = _steps_to_codewords()
    keys, rows = [], []
    for half in (0, 1):
        word = (prints >> np.uint64(33 * half)).astype(np.uint32) & np.uint32(0x7FFFFFFF)
        syndrome = parts[0][word & 255] ^ parts[1][word >> 8 & 255] ^ parts[2][word >> 16 & 255] ^ parts[3][word >> 24]
        code = word[:, None] ^ flips[syndrome]
        wanted = np.ones(code.shape, bool)
        wanted[syndrome == 0, 1:] = False
        keys.append(code[wanted].astype(np.int64) | half << 40)
        rows.append(np.broadcast_to(np.arange(len(prints))[:, None], code.shape)[wanted])
    return np.concatenate(keys), np.concatenate(rows)


def _replicate(batches):
    for batch in batches:
        prints = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        for at in range(0, len(prints), 1 << 15):
            part = prints[at:at + (1 << 15)]
            keys, rows = anchors(part)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(part[rows].view(np.int64))], names=["anchor", "fingerprint"])


def _forest(nodes: int, a, b) -> np.ndarray:
    """Smallest member of every node's component, for edges (a, b)."""
    label = np.arange(nodes)
    while True:
        before = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        label = label[label]
        if np.array_equal(label, before):
            return label


def _linked(anchor, prints, max_bits) -> tuple[np.ndarray, np.ndarray]:
    """Links of a chunk sorted by anchor, as stars: no more rows than fingerprints."""
    nodes, place = np.unique(prints, return_inverse=True)
    label = np.arange(len(nodes))
    run = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
    size = np.diff(np.append(run, len(anchor)))
    left = np.repeat(size, size) - (np.arange(len(anchor)) - np.repeat(run, size)) - 1
    step, rows = 1, np.flatnonzero(left > 0)
    pend_a, pend_b, waiting = [], [], 0
    while len(rows):
        near = np.bitwise_count(prints[rows] ^ prints[rows + step]) <= max_bits
        hit = rows[near]
        fresh = label[place[hit]] != label[place[hit + step]]
        pend_a.append(place[hit[fresh]])
        pend_b.append(place[hit[fresh] + step])
        waiting += int(fresh.sum())
        step += 1
        rows = rows[left[rows] >= step]
        if waiting > len(nodes) or not len(rows):
            link_a, link_b = np.concatenate(pend_a), np.concatenate(pend_b)
            label = _forest(len(nodes), np.append(link_a, np.arange(len(nodes))), np.append(link_b, label))
            pend_a, pend_b, waiting = [], [], 0
    child = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[label[child]].view(np.int64), nodes[child].view(np.int64)


def _pairs(kind, a, b):
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int32)), pa.array(a), pa.array(b)], names=["kind", "u", "v"])


def _compare(max_bits, tile_rows):
    """Rows sorted by anchor to links (kind 0); rows of too large anchors as they are (kind 1)."""

    def run(batches):
        held_a, held_p = np.zeros(0, np.int64), np.zeros(0, np.int64)
        large = None
        for batch in batches:
            a, p = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            if large is not None:
                n = int(np.searchsorted(a, large, "right"))
                yield _pairs(1, a[:n], p[:n])
                a, p = a[n:], p[n:]
                if not len(a):
                    continue
                large = None
            held_a, held_p = np.concatenate([held_a, a]), np.concatenate([held_p, p])
            # The last anchor may go on in the next batch.
            cut = int(np.searchsorted(held_a, held_a[-1], "left")) if len(held_a) else 0
            yield from _whole(held_a[:cut], held_p[:cut], max_bits, tile_rows)
            held_a, held_p = held_a[cut:], held_p[cut:]
            if len(held_a) > tile_rows:
                large = held_a[-1]
                yield _pairs(1, held_a, held_p)
                held_a, held_p = held_a[:0], held_p[:0]
        yield from _whole(held_a, held_p, max_bits, tile_rows)

    return run


def _whole(anchor, prints, max_bits, tile_rows):
    if not len(anchor):
        return
    first = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
    size = np.repeat(np.diff(np.append(first, len(anchor))), np.diff(np.append(first, len(anchor))))
    big = size > tile_rows
    if big.any():
        yield _pairs(1, anchor[big], prints[big])
    keep = (size > 1) & ~big
    if keep.any():
        yield _pairs(0, *_linked(anchor[keep], prints[keep].view(np.uint64), max_bits))


def links(prints: DataFrame, max_bits=MAX_BITS, tile_rows=TILE_ROWS) -> DataFrame:
    """Links (u, v) that connect all of ``prints`` (distinct fingerprint) within ``max_bits`` <= 3.

    Each task gives stars, not all pairs, so a large group of near copies gives
    no more rows than it has members.  An anchor with more than ``tile_rows``
    fingerprints is cut into tiles, and every pair of tiles is compared by some
    task: all its pairs are compared, none gathers in one task.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("the anchors cover distances up to three bits")
    near = prints.select("fingerprint").mapInArrow(_replicate, "anchor long, fingerprint long")
    near = near.repartition("anchor").sortWithinPartitions("anchor")
    found = materialize(near.mapInArrow(_compare(max_bits, tile_rows), "kind int, u long, v long"), "simhash-links")
    large = found.where("kind = 1").select(F.col("u").alias("anchor"), F.col("v").alias("fingerprint"))
    tiles = large.groupBy("anchor").agg(F.ceil(F.count("*") / (tile_rows // 2)).cast("int").alias("tiles"))
    other = F.explode(F.expr("sequence(0, tiles - 1)"))
    dealt = (
        large.join(tiles, "anchor").withColumn("tile", F.expr("cast(pmod(xxhash64(fingerprint), tiles) as int)"))
        .withColumn("other", other).where("tile <> other")
        .select("anchor", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"), "fingerprint")
    )

    def tile_pair(table: pa.Table) -> pa.Table:
        p = table.column("fingerprint").to_numpy().view(np.uint64)
        u, v = _linked(np.zeros(len(p), np.int64), p, max_bits)
        return pa.table({"u": u, "v": v})

    crossed = dealt.groupBy("anchor", "low", "high").applyInArrow(tile_pair, "u long, v long")
    return found.where("kind = 0").select("u", "v").union(crossed)


def _components(marked: DataFrame, id_col, max_bits) -> DataFrame:
    """(fingerprint, component, component_id) of every distinct fingerprint of ``marked``.

    ``component`` is a fingerprint of the component, unique to it;
    component_id its smallest id (null if no member has one).
    """
    nodes = materialize(marked.groupBy("fingerprint").agg(F.min(id_col).alias("least_id")), "simhash-nodes")
    linked = components(links(nodes, max_bits))
    placed = nodes.join(linked, nodes.fingerprint == linked.node, "left").select(
        "fingerprint", "least_id", F.coalesce("component", "fingerprint").alias("component"))
    # Minima first, then looked up: a large component is no hot group.
    least = placed.groupBy("component").agg(F.min("least_id").alias("component_id"))
    return placed.join(least, "component").select("fingerprint", "component", "component_id")


def near_duplicates(docs: DataFrame, id_col="doc_id", text_col="text", size=SHINGLE_WORDS, seed=SEED, max_bits=MAX_BITS) -> DataFrame:
    """(id_col, fingerprint string, component_id) of every row.

    component_id is the smallest id reachable over links of at most
    ``max_bits`` bits; rows without an id take part and get their component's
    (null if no member has an id).  Equal fingerprints are one node, so copies
    are never compared with each other.  No rows give no rows.
    """
    marked = materialize(fingerprints(docs, id_col, text_col, size, seed), "simhash-prints")
    named = _components(marked, id_col, max_bits).select("fingerprint", "component_id")
    return marked.join(named, "fingerprint").select(
        id_col, F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col="doc_id", text_col="text", size=SHINGLE_WORDS, seed=SEED, max_bits=MAX_BITS) -> DataFrame:
    """One row of every component of ``docs``, with all its columns.

    Every row, with or without an id, belongs to the component of its
    fingerprint.  The row kept is the least by id (nulls last), then by the
    SHA-256 of its text, then by a hash of the whole row; of rows equal in
    all that, one.  Two different texts that share an id are kept each
    unless they are near copies.  Components and choices are found on small
    rows (id and two hashes); the choice is a partial minimum per component,
    so no component is gathered in one task, and the documents are shuffled
    once, by the chosen key.  ``docs`` is read twice: pass a scan or a
    written table.
    """
    key = F.concat_ws("|", F.coalesce(F.col(id_col).cast("long").cast("string"), F.lit("-")),
                      F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256), F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).cast("string"))
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"), key.alias("_keep_key"))
    marked = materialize(fingerprints(rows, "_id", "_text", size, seed, carry=["_keep_key"]), "simhash-keys")
    placed = marked.join(_components(marked, "_id", max_bits).select("fingerprint", "component"), "fingerprint")
    placed = placed.withColumn("_order", F.struct(F.col("_id").isNull().alias("a"), F.col("_id").alias("b"), F.col("_keep_key").alias("c")))
    best = placed.groupBy("component").agg(F.min("_order").alias("_best")).select(F.col("_best.c").alias("_keep_key"))
    kept = docs.withColumn("_keep_key", key).join(best, "_keep_key", "left_semi")
    return kept.dropDuplicates(["_keep_key"]).select(*[F.col(f"`{c}`") for c in docs.columns])
