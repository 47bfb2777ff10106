"""Suffix-array and SimHash duplicates beside plain Python."""

import hashlib
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from sluice.llm import components, simhash, suffix_dedup

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def removed(rows, length=100):
    seen, out = set(), {}
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            w = b[i:i + length]
            if w in seen:
                gone[i:i + length] = b"\1" * length
            seen.add(w)
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out[d] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("hot_rows", [suffix_dedup.HOT_ROWS, 3])
def test_suffix_dedup(docs, rows, hot_rows, monkeypatch):
    monkeypatch.setattr(suffix_dedup.repeated_spans, "__defaults__", ("doc_id", "text", 100, hot_rows, 64 << 10))
    assert {r.doc_id: tuple(r)[1:] for r in suffix_dedup.report(docs).collect()} == removed(rows)


def test_suffix_dedup_repeated_and_empty(docs, repeated, empty, rows):
    once = {r.doc_id: tuple(r) for r in suffix_dedup.report(docs).collect()}
    got = suffix_dedup.report(repeated).collect()
    assert len(got) == 2 * len(rows) + 1
    # Rows that share an id are not earlier than each other; the row without one comes last.
    assert all(tuple(r) == once[r.doc_id] for r in got if r.doc_id is not None)
    assert suffix_dedup.report(empty).collect() == []


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(words[i:i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints, bits=3):
    """Smallest id reachable from every id."""
    label = {d: d for d in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if (prints[a] ^ prints[b]).bit_count() <= bits and label[b] < label[a]:
                    label[a], changed = label[b], True
    return label


def test_simhash(docs, rows):
    prints = {d: fingerprint(t) for d, t in rows}
    want = {d: (f"{prints[d]:016x}", g) for d, g in groups(prints).items()}
    assert {r.doc_id: tuple(r)[1:] for r in simhash.near_duplicates(docs).collect()} == want


def test_simhash_keeps_one(docs, repeated, empty, rows):
    names = set(groups({d: fingerprint(t) for d, t in rows}).values())
    kept = simhash.keep_one(repeated)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert ids == sorted(names)
    # The row without an id copies a text that has one: its component keeps the row with the id.
    assert kept.where("doc_id is null").count() == 0 and kept.count() == len(names)
    assert simhash.near_duplicates(empty).collect() == [] and simhash.keep_one(empty).collect() == []


def test_simhash_keeps_texts_that_share_an_id(spark, docs):
    rows = [(1, "alpha beta gamma delta epsilon zeta eta theta"), (1, "completely other words here and there again"),
            (None, "copy without id of nothing else at all"), (None, "copy without id of nothing else at all"), (2, None), (3, "")]
    df = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, fingerprint string")
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.text or "") for r in kept.collect())
    # Null and empty texts share fingerprint zero: id 2 stands for both.
    assert got == sorted([(1, rows[0][1]), (1, rows[1][1]), (-1, rows[2][1]), (2, "")])


@pytest.mark.parametrize("tile_rows", [simhash.TILE_ROWS, 8])
def test_links_find_every_pair(spark, docs, tile_rows):
    """Also where an anchor is cut into tiles: a chain of prints three bits apart, and a cloud around one print."""
    rng = np.random.default_rng(3)
    prints = {int(x) for x in rng.integers(0, 1 << 62, 60)}
    for x in list(prints)[:6]:
        for _ in range(25):
            flips = rng.choice(64, rng.integers(1, 4), replace=False)
            prints.add(x ^ sum(1 << int(b) for b in flips))
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in prints]
    found = components.components(simhash.links(spark.createDataFrame(signed, "fingerprint long"), tile_rows=tile_rows))
    got = {r.node: r.component for r in found.collect()}
    order = {s: x for (s,), x in zip(signed, prints, strict=True)}
    want = groups({s: order[s] for s in order})
    assert {s: got.get(s, s) for s in order} == want


def test_anchors_cover_three_bits():
    rng = np.random.default_rng(5)
    for _ in range(200):
        x = int(rng.integers(0, 1 << 63))
        y = x ^ sum(1 << int(b) for b in rng.choice(64, 3, replace=False))
        keys, rows = simhash.anchors(np.array([x, y], np.uint64))
        assert set(keys[rows == 0]) & set(keys[rows == 1])


def test_components_of_chain_and_star(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7), (3, 2)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 130)}}
    assert components.components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_removed_bytes_and_kept_text(docs):
    got = suffix_dedup.remove_repeats(docs)
    assert got.where("n_bytes <> length(kept) + aggregate(coalesce(spans, array()), 0L, (n, s) -> n + s.end - s.begin)").count() == 0
    assert got.agg(F.sum("n_bytes")).first()[0] > 0
