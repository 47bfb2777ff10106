"""A prefix trie of conversations, with subtree totals by parallel tree contraction.

Turns of a conversation are ordered by ``turn`` (nulls first; equal turns by
role, then text); a null role or text is empty; rows without ``conv_id`` are
left out.  Every conversation ``c`` is rebuilt: the first ``h`` turns of
conversation ``c - c % 20`` (``%`` as in SQL: the sign of ``c``; all its turns
if fewer, none if absent), then ``c``'s own turns after its first ``h``, where
``h`` is crc32 of the decimal ``c``, modulo 4.

Each distinct sequence of the first ``d`` rebuilt turns is a node of depth
``d``; the root (``d = 0``) holds every conversation, even one without turns.
A node is named by its smallest member and its depth, which no other node
shares.  Node keys are sums of position-salted 64-bit hashes of their turns
(two of them, so that a collision needs both to meet).

Subtree totals (childless nodes, saved tokens) come from tree contraction in
rounds of joins: every leaf is raked into its parent, and a node with one
child whose coin shows heads while its parent's shows tails is spliced out,
its child hanging from its parent with the spliced node's sum carried on the
edge.  The coins are hashes of node and round, so no join finds them.  When
the root alone is left, spliced nodes are expanded in reverse order: a
spliced node's total is its child's plus what it held when spliced.  A long
chain takes about log rounds; a wide node is a key of partial aggregations,
never a group that one task holds.

Defined results: an empty table gives no rows; repeated rows are turns each.
``ends_sha256`` of a node where no conversation ends is the hash of the empty
string.
"""

import functools
import hashlib

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.operators.ordinal import with_ordinal
from sluice.session import materialize

BASE_EVERY, PREFIX_MOD = 20, 4
#: Words are runs of other characters than these.
BLANKS = r"[\x20\x09-\x0D]+"
_EMPTY = hashlib.sha256(b"").hexdigest()
_NODE = ["cid", "dep"]


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, idx, role, text, n): each conversation's turns numbered from 0, and their number."""
    given = conversations.where(F.col("conv_id").isNotNull()).select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return with_ordinal(given, ["turn", "role", "text"], ["conv_id"], name="idx", label="trie-turns").select(
        "conv_id", "idx", "role", "text", F.col("idx_of").alias("n"))


def rebuilt(numbered: DataFrame) -> DataFrame:
    """(c, pos, role, text) of every rebuilt turn, and (c, length) of every conversation."""
    convs = numbered.select("conv_id", "n").dropDuplicates(["conv_id"])
    convs = convs.select(
        F.col("conv_id").alias("c"), F.col("n").alias("n_own"),
        (F.crc32(F.col("conv_id").cast("string")) % PREFIX_MOD).alias("h"),
        (F.col("conv_id") - F.col("conv_id") % BASE_EVERY).alias("b"))
    lengths = convs.select(F.col("c").alias("b"), F.col("n_own").alias("n_base"))
    convs = materialize(convs.join(lengths, "b", "left").select(
        "c", "b", "h", "n_own", F.least(F.col("h"), F.coalesce("n_base", F.lit(0))).alias("k")), "trie-convs")
    first = numbered.where(F.col("idx") < PREFIX_MOD - 1).select(F.col("conv_id").alias("b"), "idx", "role", "text")
    borrowed = convs.select("c", "b", "h").join(first, "b").where(F.col("idx") < F.col("h")).select("c", F.col("idx").alias("pos"), "role", "text")
    own = numbered.join(convs.select(F.col("c").alias("conv_id"), "h", "k"), "conv_id").where(F.col("idx") >= F.col("h")).select(
        F.col("conv_id").alias("c"), (F.col("k") + F.col("idx") - F.col("h")).alias("pos"), "role", "text")
    sizes = convs.select("c", (F.col("k") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))).alias("length"))
    return borrowed.unionByName(own), sizes


def _keys(rows: DataFrame) -> DataFrame:
    """Each rebuilt turn with the key of the prefix that ends with it: (c, d, k1, k2, words)."""
    salt = [F.col("pos"), F.col("role"), F.col("text")]
    e1 = F.xxhash64(F.lit("trie-1"), *salt).cast("decimal(38,0)")
    e2 = F.xxhash64(F.lit("trie-2"), *salt).cast("decimal(38,0)")
    upto = Window.partitionBy("c").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    words = F.size(F.filter(F.split("text", BLANKS), lambda w: w != F.lit("")))
    return rows.select(
        "c", (F.col("pos") + 1).alias("d"), F.sum(e1).over(upto).alias("k1"), F.sum(e2).over(upto).alias("k2"), words.alias("words"))


def _ends(members: DataFrame) -> DataFrame:
    """(cid, dep, ends_sha256) of nodes where conversations end, their ids hashed in ascending order by one stream per node."""

    def digest(batches):
        node, hasher, sep = None, None, ""
        for pdf in batches:
            for cid, dep, c in zip(pdf.cid.tolist(), pdf.dep.tolist(), pdf.c.tolist(), strict=True):
                if (cid, dep) != node:
                    if node is not None:
                        yield pd.DataFrame({"cid": [node[0]], "dep": [node[1]], "ends_sha256": [hasher.hexdigest()]})
                    node, hasher, sep = (cid, dep), hashlib.sha256(), ""
                hasher.update(f"{sep}{c}".encode())
                sep = ","
        if node is not None:
            yield pd.DataFrame({"cid": [node[0]], "dep": [node[1]], "ends_sha256": [hasher.hexdigest()]})

    ordered = members.repartition("cid", "dep").sortWithinPartitions("cid", "dep", "c")
    return ordered.mapInPandas(digest, "cid long, dep long, ends_sha256 string")


def contract(nodes: DataFrame, values=("v_leaves", "v_saved"), label="trie") -> DataFrame:
    """(cid, dep, <value>_total...) of every node of a rooted tree given by (cid, dep, pcid, pdep, values); the root has null parent."""
    names = list(values)
    live = nodes.select(*_NODE, "pcid", "pdep", *[F.col(v).alias(f"acc{k}") for k, v in enumerate(names)],
                        *[F.lit(0).cast("long").alias(f"add{k}") for k in range(len(names))])
    live = materialize(live, f"{label}-live")
    acc = [f"acc{k}" for k in range(len(names))]
    add = [f"add{k}" for k in range(len(names))]
    finished, spliced = [], []
    r = 0
    while live.count() > 1:
        kids = live.where("pcid is not null").groupBy(F.col("pcid").alias("cid"), F.col("pdep").alias("dep")).agg(F.count(F.lit(1)).alias("kids"))
        marked = live.join(kids, _NODE, "left").withColumn("kids", F.coalesce("kids", F.lit(0)))
        marked = materialize(marked, f"{label}-marked")
        # Rake: every leaf is done and gives its parent its total.
        leaves = marked.where("kids = 0 and pcid is not null")
        finished.append(materialize(leaves.select(*_NODE, *[F.col(a).alias(f"s{k}") for k, a in enumerate(acc)]), f"{label}-raked"))
        given = leaves.groupBy(F.col("pcid").alias("cid"), F.col("pdep").alias("dep")).agg(
            *[F.sum(F.col(a) + F.col(b)).alias(f"got{k}") for k, (a, b) in enumerate(zip(acc, add, strict=True))])
        rest = marked.where("not (kids = 0 and pcid is not null)").join(given, _NODE, "left").select(
            *_NODE, "pcid", "pdep", *[(F.col(a) + F.coalesce(F.col(f"got{k}"), F.lit(0))).alias(a) for k, a in enumerate(acc)], *add)
        rest = materialize(rest, f"{label}-rest")
        # Compress: a node with one child, heads, under a parent with tails, is spliced out.
        only = rest.where("pcid is not null").groupBy(F.col("pcid").alias("cid"), F.col("pdep").alias("dep")).agg(
            F.count(F.lit(1)).alias("n"), F.min(F.struct("cid", "dep")).alias("child"))
        coin = lambda c, d: F.pmod(F.xxhash64(c, d, F.lit(r)), F.lit(2)) == 0
        chosen = rest.join(only, _NODE).where(
            (F.col("n") == 1) & F.col("pcid").isNotNull() & coin(F.col("cid"), F.col("dep")) & ~coin(F.col("pcid"), F.col("pdep")))
        chosen = materialize(chosen.select(
            F.col("cid").alias("xcid"), F.col("dep").alias("xdep"), F.col("pcid").alias("xpcid"), F.col("pdep").alias("xpdep"),
            F.col("child.cid").alias("cid"), F.col("child.dep").alias("dep"), *[F.col(a).alias(f"x{a}") for a in acc], *[F.col(b).alias(f"x{b}") for b in add]),
            f"{label}-chosen")
        child = rest.join(chosen, _NODE, "left")
        hit = F.col("xcid").isNotNull()
        spliced.append(materialize(child.where(hit).select(
            F.col("xcid").alias("cid"), F.col("xdep").alias("dep"), F.col("cid").alias("ccid"), F.col("dep").alias("cdep"),
            *[(F.col(f"x{a}") + F.col(b)).alias(f"o{k}") for k, (a, b) in enumerate(zip(acc, add, strict=True))]), f"{label}-spliced"))
        moved = child.select(
            *_NODE, F.when(hit, F.col("xpcid")).otherwise(F.col("pcid")).alias("pcid"), F.when(hit, F.col("xpdep")).otherwise(F.col("pdep")).alias("pdep"),
            *acc, *[F.when(hit, F.col(b) + F.col(f"x{a}") + F.col(f"x{b}")).otherwise(F.col(b)).alias(b) for a, b in zip(acc, add, strict=True)])
        gone = chosen.select(F.col("xcid").alias("cid"), F.col("xdep").alias("dep"))
        live = materialize(moved.join(gone, _NODE, "left_anti"), f"{label}-live")
        r += 1
    known = live.select(*_NODE, *[F.col(a).alias(f"s{k}") for k, a in enumerate(acc)])
    known = [known, *finished]
    # Expand: a spliced node's total is its child's and what it held.
    for step in reversed(spliced):
        have = functools.reduce(DataFrame.unionByName, known)
        have = have.select(F.col("cid").alias("ccid"), F.col("dep").alias("cdep"), *[F.col(f"s{k}").alias(f"c{k}") for k in range(len(names))])
        back = step.join(have, ["ccid", "cdep"]).select(*_NODE, *[(F.col(f"c{k}") + F.col(f"o{k}")).alias(f"s{k}") for k in range(len(names))])
        known.append(materialize(back, f"{label}-expanded"))
    total = functools.reduce(DataFrame.unionByName, known)
    return total.select(*_NODE, *[F.col(f"s{k}").alias(f"{v}_total") for k, v in enumerate(names)])


def trie(conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of every node."""
    numbered = materialize(turns(conversations), "trie-numbered")
    rows, sizes = rebuilt(numbered)
    keyed = _keys(rows)
    root = sizes.select("c", F.lit(0).cast("long").alias("d"), F.lit(0).cast("decimal(38,0)").alias("k1"),
                        F.lit(0).cast("decimal(38,0)").alias("k2"), F.lit(0).alias("words"))
    members = materialize(keyed.unionByName(root), "trie-members")
    nodes = members.groupBy("d", "k1", "k2").agg(
        F.min("c").alias("cid"), F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words"))
    # A node's parent is the node of its smallest member one turn less deep.
    parents = members.select(F.col("c").alias("cid"), (F.col("d") + 1).alias("d"), F.col("k1").alias("pk1"), F.col("k2").alias("pk2"))
    nodes = nodes.select("cid", F.col("d").alias("dep"), "k1", "k2", "n_convs", "words")
    by_key = nodes.select(F.col("cid").alias("pcid"), F.col("dep").alias("pdep"), F.col("k1").alias("pk1"), F.col("k2").alias("pk2"))
    linked = nodes.join(parents, (nodes.cid == parents.cid) & (nodes.dep == parents.d), "left").select(
        nodes.cid, "dep", "n_convs", "words", "pk1", "pk2")
    linked = linked.join(by_key, (linked.dep - 1 == by_key.pdep) & (linked.pk1 == by_key.pk1) & (linked.pk2 == by_key.pk2), "left").select(
        "cid", "dep", "pcid", "pdep", "n_convs", "words")
    linked = materialize(linked, "trie-nodes")
    children = linked.where("pcid is not null").groupBy(F.col("pcid").alias("cid"), F.col("pdep").alias("dep")).agg(F.count(F.lit(1)).alias("n_children"))
    linked = materialize(linked.join(children, _NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "trie-linked")
    valued = linked.select(
        *_NODE, "pcid", "pdep", (F.col("n_children") == 0).cast("long").alias("v_leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).cast("long").alias("v_saved"))
    totals = contract(valued)
    ends = members.join(sizes, (members.c == sizes.c) & (members.d == sizes.length)).select(members.c, members.d, "k1", "k2")
    ends = ends.join(nodes.select("cid", F.col("dep").alias("d"), "k1", "k2"), ["d", "k1", "k2"]).select("cid", F.col("d").alias("dep"), "c")
    hashed = _ends(ends)
    return linked.join(totals, _NODE).join(hashed, _NODE, "left").select(
        F.col("cid").alias("conv_id"), F.col("dep").alias("depth"), F.col("pcid").alias("parent_conv_id"), "n_convs", "n_children",
        F.col("v_leaves_total").alias("n_leaves"), F.col("v_saved_total").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"))
