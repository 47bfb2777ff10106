"""The conversation prefix trie beside plain Python."""

import hashlib
import re
import zlib

import pytest

from sluice.llm import prefix_trie


def brute(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn, role or "", text or ""))
    ordered = {c: [(r, t) for _, r, t in sorted(v, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))] for c, v in convs.items()}
    seqs = {}
    for c in ordered:
        h = zlib.crc32(str(c).encode()) % 4
        b = c - int(c - (abs(c) // 20) * 20 * (1 if c >= 0 else -1)) if False else c - (c % 20 if c >= 0 else -((-c) % 20))
        seqs[c] = ordered.get(b, [])[:h] + ordered[c][h:]
    nodes = {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            nodes.setdefault(tuple(s[:d]), []).append(c)
    kids = {}
    for key in nodes:
        if key:
            kids.setdefault(key[:-1], []).append(key)
    out = []
    for key, members in nodes.items():
        sub = [k for k in nodes if k[:len(key)] == key]
        leaves = sum(1 for k in sub if not kids.get(k))
        saved = sum((len(nodes[k]) - 1) * (len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0) for k in sub)
        ends = sorted(c for c in members if len(seqs[c]) == len(key))
        out.append((min(members), len(key), min(nodes[key[:-1]]) if key else None, len(members), len(kids.get(key, [])), leaves, saved,
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[0], r[1]))


def sample():
    rows = []
    for c in range(0, 63):
        for t in range(c % 5):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", f"turn {t} of {c % 3}" + (" extra words here" if c % 7 == 0 else "")))
    rows += [(5, None, None, None), (5, 0, "user", "turn 0 of 2"), (41, 2, "user", None), (-7, 0, "user", "x"), (-20, 0, "user", "neg base"), (None, 0, "user", "gone")]
    rows += [(100 + k, 0, "user", "hot first turn") for k in range(40)] + [(100 + k, 1, "assistant", f"reply {k % 3}") for k in range(40)]
    # A long chain, which only splicing shortens.
    rows += [(500, t, "user", f"step {t}") for t in range(60)]
    return rows


def test_trie_matches_plain_python(spark):
    from sluice.llm.registry import ship

    ship(spark)
    rows = sample()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    got = sorted((tuple(r) for r in prefix_trie.trie(df.withColumn("cid", df.conv_id)).collect()), key=lambda r: (r[0], r[1]))
    assert got == brute(rows)


def test_contraction_of_chain_and_star(spark):
    chain = [(k, k, k - 1 if k else None, k - 1 if k else None, 1 if k == 99 else 0, k) for k in range(100)]
    star = [(1000, 0, None, None, 0, 1)] + [(1000 + k, 1, 1000, 0, 1, k) for k in range(1, 50)]
    df = spark.createDataFrame(chain + star, "cid long, dep long, pcid long, pdep long, v_leaves long, v_saved long")
    got = {(r.cid, r.dep): (r.v_leaves_total, r.v_saved_total) for r in prefix_trie.contract(df.where("cid < 1000")).collect()}
    assert got == {(k, k): (1, sum(range(k, 100))) for k in range(100)}
    got = {(r.cid, r.dep): (r.v_leaves_total, r.v_saved_total) for r in prefix_trie.contract(df.where("cid >= 1000")).collect()}
    assert got[1000, 0] == (49, 1 + sum(range(1, 50))) and all(got[1000 + k, 1] == (1, k) for k in range(1, 50))


def test_empty(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_trie.trie(df).collect() == []
