"""A Merkle manifest of a table: a 16-ary hash tree per source, and one over the sources.

Leaves: every row is the SHA-256 (lowercase hex) of its fields ``doc_id,
source, lang, n_chars, text``, each ``-`` if null, else its UTF-8 byte count,
``:`` and its value.  Per source the leaves ascend by ``doc_id`` (nulls first,
equal ids by leaf); every 16 consecutive nodes of a level (the last run
fewer, even one) are hashed together, until one node, the subroot, remains.
Subroots ordered by source (null first, bytewise) give the root likewise.

Method, incremental witnesses: the nodes of a level are cut into aligned
blocks of ``16 ** block_levels``, each built by one task as a stream of
appends.  A node appended to an open run waits there with the leaves below
it; when the run is complete (or the block ends), every waiting leaf's
witness at that level is its run's other digests, left and right, and the
run's hash is appended one level up with all those leaves.  A block's root is
then one append of the next pass, so blocks of blocks follow the same way up
to each subroot, and subroots up to the root.  Paths are joined top-down by
block, never by source, so a source with a third of all rows is spread over
many tasks; no task holds more than one block.

Defined results: a null in any field is ``-``; an empty table gives no rows;
a source of one row has that leaf as subroot; repeated rows are leaves each.
Tampering lower-cases A-Z of the text where crc32 of the decimal id is
divisible by 5 (a null id or text is never tampered); the folded root is
recomputed from that leaf with the original siblings.
"""

import functools
import hashlib

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.operators.ordinal import with_ordinal
from sluice.session import materialize

FANOUT = 16
#: Levels that one task builds: a block holds 16 ** BLOCK_LEVELS nodes.
BLOCK_LEVELS = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PATH = "array<struct<left:string,right:string>>"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(col) -> F.Column:
    value = col.cast("string")
    return F.when(col.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaf_digest(cols) -> F.Column:
    return F.sha2(F.concat(*[field(c) for c in cols]), 256)


def height(m) -> F.Column:
    """Hash levels until one node remains, for ``m`` nodes (0 for one)."""
    return sum((m > FANOUT ** k).cast("int") for k in range(16))


def stream_tree(digests, levels):
    """Build ``levels`` levels over one aligned block; (top, witness per member: ``levels`` pairs (left, right))."""
    runs = [[] for _ in range(levels)]
    waiting = [[] for _ in range(levels)]
    witness = [[None] * levels for _ in digests]
    top = digests[0] if not levels and digests else None

    def append(level, digest, below):
        nonlocal top
        if level == levels:
            top = digest
            return
        runs[level].append(digest)
        waiting[level].append(below)
        if len(runs[level]) == FANOUT:
            close(level)

    def close(level):
        run, members = runs[level], waiting[level]
        runs[level], waiting[level] = [], []
        # A completed run extends the witness of every leaf that waited below it.
        for k, below in enumerate(members):
            pair = ("".join(run[:k]), "".join(run[k + 1:]))
            for leaf in below:
                witness[leaf][level] = pair
        append(level + 1, sha("".join(run)), [leaf for below in members for leaf in below])

    for i, digest in enumerate(digests):
        append(0, digest, [i])
    for level in range(levels):
        if runs[level]:
            close(level)
    return top, witness


def _blocks(nodes: DataFrame, block_levels: int, with_witness: bool):
    """Members' witnesses (or None) and block tops of one pass over nodes with levels to build."""
    size = FANOUT ** block_levels

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        levels = min(block_levels, int(pdf.h.iloc[0]))
        top, witness = stream_tree(pdf.digest.tolist(), levels)
        pairs = [[{"left": a, "right": b} for a, b in w] for w in witness] if with_witness else [[] for _ in witness]
        out = pd.DataFrame({"gkey": pdf.gkey.values, "pos": pdf.pos.values, "witness": pairs})
        out["block"], out["top"], out["h"] = pdf.pos.iloc[0] // size, top, int(pdf.h.iloc[0]) - levels
        return out if with_witness else out.iloc[:1].assign(pos=-1)

    schema = f"gkey string, pos long, witness {PATH}, block long, top string, h long"
    grouped = nodes.withColumn("_block", (F.col("pos") / size).cast("long")).groupBy("gkey", "_block")
    made = materialize(grouped.applyInPandas(build, schema), "merkle-blocks")
    tops = made.where("pos = -1" if not with_witness else "true").select(
        "gkey", F.col("block").alias("pos"), F.col("top").alias("digest"), "h").dropDuplicates(["gkey", "pos"])
    return (made.select("gkey", "pos", "witness") if with_witness else None), materialize(tops, "merkle-tops")


def build_levels(nodes: DataFrame, block_levels: int, witness_first=True):
    """Passes from ``nodes`` (gkey, pos, digest, h) up to one node per group: [(nodes, members' witnesses)], last pass's nodes all final."""
    passes = []
    current = nodes
    while True:
        if not current.where("h > 0").limit(1).count():
            passes.append((current, None))
            return passes
        witness, tops = _blocks(current.where("h > 0"), block_levels, witness_first or bool(passes))
        passes.append((current, witness))
        current = tops


def descend(passes, finals: DataFrame, start: int, block_levels: int) -> DataFrame:
    """(gkey, pos, path, subroot) of the nodes of pass ``start``: their way up to their group's top, then ``finals``' path of the group."""
    size = FANOUT ** block_levels
    above = None
    for j in range(len(passes) - 1, start - 1, -1):
        nodes, witness = passes[j]
        done = nodes.where("h = 0").join(finals, "gkey").select("gkey", "pos", "path", F.col("digest").alias("subroot"))
        if witness is None:
            above = done
            continue
        up = above.select("gkey", F.col("pos").alias("_up"), F.col("path").alias("_path"), "subroot")
        climbing = witness.join(up, (witness.gkey == up.gkey) & ((witness.pos / size).cast("long") == up._up)).select(
            witness.gkey, witness.pos, F.concat(witness.witness, up._path).alias("path"), "subroot")
        above = materialize(climbing.unionByName(done), "merkle-paths")
    return above


def manifest(docs: DataFrame, block_levels=BLOCK_LEVELS) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row of ``docs``."""
    spark = docs.sparkSession
    cols = [F.col(c) for c in FIELDS]
    tampered = F.when(
        F.col("doc_id").isNotNull() & (F.crc32(F.col("doc_id").cast("string")) % 5 == 0), F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))
    leaves = docs.select(
        *cols, leaf_digest(cols).alias("leaf"), leaf_digest(cols[:4] + [tampered]).alias("tampered"),
        F.when(F.col("source").isNull(), F.lit("")).otherwise(F.concat(F.lit("s"), "source")).alias("gkey"))
    leaves = with_ordinal(leaves, ["doc_id", "leaf"], ["source"], name="pos", label="merkle-leaves")
    leaves = leaves.withColumn("h", height(F.col("pos_of")))
    size = FANOUT ** block_levels
    nodes = leaves.select("gkey", "pos", F.col("leaf").alias("digest"), "h")
    source_passes = build_levels(nodes, block_levels, witness_first=False)

    # Subroots, ordered by source, are the leaves of the tree over sources.
    finals = leaves.select("gkey", "source").dropDuplicates(["gkey"])
    subroots = [p[0].where("h = 0").select("gkey", "digest") for p in source_passes]
    subroots = functools.reduce(DataFrame.unionByName, subroots)
    tops = with_ordinal(subroots.join(finals, "gkey"), ["source"], name="pos", label="merkle-subroots")
    top_nodes = tops.select(F.lit("*").alias("gkey"), "pos", "digest", height(F.col("pos_of")).alias("h"))
    root_passes = build_levels(top_nodes, block_levels)
    nothing = spark.createDataFrame([("*", [])], f"gkey string, path {PATH}")
    root_paths = descend(root_passes, nothing, 0, block_levels)
    root = [r.subroot for r in root_paths.select("subroot").limit(1).collect()]
    by_source = tops.select("gkey", F.col("pos").alias("_rank")).join(
        root_paths.select(F.col("pos").alias("_rank"), "path"), "_rank").select("gkey", "path")

    # Each leaf block's way up; a source of one leaf is its own subroot.
    if len(source_passes) > 1:
        above = descend(source_passes, by_source, 1, block_levels)
    else:
        above = spark.createDataFrame([], f"gkey string, pos long, path {PATH}, subroot string")
    single = nodes.where("h = 0").join(by_source, "gkey").select("gkey", F.lit(0).cast("long").alias("pos"), "path", F.col("digest").alias("subroot"))
    above = above.unionByName(single)
    root = root[0] if root else None

    def finish(key, given: pd.DataFrame, up: pd.DataFrame) -> pd.DataFrame:
        if given.empty:
            return pd.DataFrame(columns=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])
        given = given.sort_values("pos")
        levels = min(block_levels, int(given.h.iloc[0]))
        _, witness = stream_tree(given.leaf.tolist(), levels)
        path = [(p["left"], p["right"]) for p in up.path.iloc[0]]
        proofs, folded = [], []
        for own, start in zip(witness, given.tampered.tolist(), strict=True):
            full = list(own) + path
            proofs.append(sha("".join(a + b for a, b in full)))
            for a, b in full:
                start = sha(a + start + b)
            folded.append(start)
        return pd.DataFrame({
            "doc_id": given.doc_id.values, "leaf": given.leaf.values, "subroot": up.subroot.iloc[0], "root": root,
            "proof_sha256": proofs, "folded_root": folded, "verified": [f == root for f in folded]})

    blocks = leaves.select("doc_id", "gkey", "pos", "leaf", "tampered", "h", (F.col("pos") / size).cast("long").alias("_block"))
    ups = above.select("gkey", F.col("pos").alias("_block"), "path", "subroot")
    schema = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return blocks.groupBy("gkey", "_block").cogroup(ups.groupBy("gkey", "_block")).applyInPandas(finish, schema)
