"""The Merkle manifest beside a plain-Python tree."""

import pytest

from sluice.llm import merkle

import hashlib, zlib
def sha(t): return hashlib.sha256(t.encode()).hexdigest()
def fld(v):
    if v is None: return "-"
    s = str(v)
    return f"{len(s.encode())}:{s}"
def leaf(row, text=None):
    d, src, lang, n, t = row
    return sha("".join(fld(x) for x in (d, src, lang, n, t if text is None else text)))
def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        cur = out[-1]
        out.append([sha("".join(cur[i:i + 16])) for i in range(0, len(cur), 16)])
    return out
def path(lv, i):
    p = []
    for level in lv[:-1]:
        s = i // 16 * 16
        run = level[s:s + 16]
        p.append(("".join(run[:i - s]), "".join(run[i - s + 1:])))
        i //= 16
    return p
def brute(rows):
    """rows: (doc_id, source, lang, n_chars, text) -> {index: (doc_id, leaf, subroot, root, proof, folded, verified)}"""
    by = {}
    for k, r in enumerate(rows):
        by.setdefault(r[1], []).append(k)
    srcs = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees, subs = {}, []
    for s in srcs:
        ks = sorted(by[s], key=lambda k: (rows[k][0] is not None, rows[k][0] or 0, leaf(rows[k])))
        lv = levels([leaf(rows[k]) for k in ks])
        trees[s] = (ks, lv); subs.append(lv[-1][0])
    top = levels(subs)
    root = top[-1][0]
    out = []
    for si, s in enumerate(srcs):
        ks, lv = trees[s]
        for i, k in enumerate(ks):
            p = path(lv, i) + path(top, si)
            r = rows[k]
            t = r[4]
            if r[0] is not None and t is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                t = t.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
            f = leaf(r, t) if t is not None else leaf(r)
            for a, b in p: f = sha(a + f + b)
            out.append((r[0], leaf(r), lv[-1][0], root, sha("".join(a + b for a, b in p)), f, f == root))
    return out


def rows_of(n_big=300):
    rows = [(k, f"s{k % 3}" if k % 5 else None, "en" if k % 4 else None, k * 7 if k % 6 else None, f"Text {k} ABC" if k % 9 else None) for k in range(60)]
    rows += [(None, "s1", "de", 3, "No Id"), (None, "s1", "de", 3, "No Id"), (7, "s0", "en", 5, "Repeated ID")]
    rows += [(1000 + k, "big", "fr", k, ("Hot Source %d " % k) * (1 + k % 3)) for k in range(n_big)]
    rows += [(5, "é", None, None, ""), (6, "", "xx", 0, "Lone")]
    return rows


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_manifest_matches_plain_tree(spark, levels):
    from sluice.llm.registry import ship

    ship(spark)
    rows = rows_of()
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(4)
    got = [tuple(r) for r in merkle.manifest(docs.withColumn("pos", docs.doc_id), block_levels=levels).collect()]
    key = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
    got, want = sorted(got, key=key), sorted(brute(rows), key=key)
    assert got == want
    assert any(not r[6] for r in got) and any(r[6] for r in got)


def test_one_row_and_empty(spark):
    one = spark.createDataFrame([(1, None, None, None, None)], "doc_id long, source string, lang string, n_chars long, text string")
    (r,) = merkle.manifest(one).collect()
    assert r.leaf == r.subroot == r.root == r.folded_root and r.verified and r.proof_sha256 == sha("")
    assert merkle.manifest(one.where("false")).collect() == []
