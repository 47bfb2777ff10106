"""Benchmark decontamination by exact windows of words.

The benchmark's windows become a hash set that every task holds; training
texts are scanned once, without a shuffle.  A window's hash only proposes a
hit: word ids are then compared one by one.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.batches import LOWER, binary_array, flat, release, steps, word_spans

WINDOW_WORDS = 10
#: Bytes of benchmark text that one broadcast set is made of; more is scanned in several passes.
SET_BYTES = 64 << 20

_ALL = np.arange(256)
#: The bytes of [^\x00-\x2F\x3A-\x60\x7B-\x7F], after lower-casing.
WORD = ((_ALL >= 48) & (_ALL <= 57)) | ((_ALL >= 97) & (_ALL <= 122)) | (_ALL >= 128)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def words_of(column) -> tuple:
    """Lower-cased words of a string column: array, start and end byte, first word per row, row offsets."""
    data, offsets = flat(column)
    return words_of_bytes(data, offsets)


def words_of_bytes(data, offsets):
    lower = LOWER[data]
    starts, ends, first = word_spans(lower, offsets, WORD)
    return binary_array(lower, starts, ends), starts, ends, first


def _window_hashes(ids, length):
    """A hash of the ``length`` ids from every place on."""
    n = len(ids) - length + 1
    out = np.zeros(max(n, 0), np.uint64)
    for k in range(length if n > 0 else 0):
        out = (out + ids[k:k + n].astype(np.uint64) + np.uint64(1)) * _FACTOR
        out ^= out >> np.uint64(29)
    return out


class WindowSet:
    """The windows of some benchmark items: per length sorted hashes, word ids and items."""

    def __init__(self, item_ids, texts, length):
        column = pa.array(texts, pa.large_string())
        words, _, _, first = words_of(column)
        self.vocabulary = words.unique()
        ids = pc.index_in(words, value_set=self.vocabulary).to_numpy(zero_copy_only=False).astype(np.int64)
        windows: dict[tuple, set] = {}
        for row, item in enumerate(item_ids):
            own = ids[first[row]:first[row + 1]].tolist()
            size = min(length, len(own))
            for at in range(len(own) - size + 1 if size else 0):
                windows.setdefault(tuple(own[at:at + size]), set()).add(item)
        self.by_length = {}
        for size in sorted({len(w) for w in windows}):
            rows = np.array([w for w in windows if len(w) == size], np.int64)
            hashes = np.array([_window_hashes(r, size)[0] for r in rows], np.uint64)
            order = np.argsort(hashes, kind="stable")
            rows, hashes = rows[order], hashes[order]
            seen = np.zeros(1 << 20, bool)
            seen[(hashes >> np.uint64(44)).astype(np.int64)] = True
            # Windows with one hash lie together; their number bounds the comparisons.
            most = int(np.diff(np.append(np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])), len(hashes))).max())
            self.by_length[size] = (hashes, rows, [windows[tuple(r)] for r in rows.tolist()], seen, most)

    def hits(self, words):
        """Every (first word, length, windows' number) that occurs in a run of words."""
        ids = pc.fill_null(pc.index_in(words, value_set=self.vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        for size, (hashes, rows, items, seen, most) in self.by_length.items():
            if len(ids) < size:
                continue
            known = np.append(0, np.cumsum(ids >= 0))
            at = np.flatnonzero(known[size:] - known[:-size] == size)
            if not len(at):
                continue
            found = _window_hashes(ids, size)[at] if len(at) * 4 > len(ids) else self._at(ids, at, size)
            maybe = seen[(found >> np.uint64(44)).astype(np.int64)]
            at, found = at[maybe], found[maybe]
            place = np.searchsorted(hashes, found)
            for step in range(most):
                near = np.minimum(place + step, len(hashes) - 1)
                same = hashes[near] == found
                for k in range(size):
                    same &= rows[near, k] == ids[at + k]
                yield at[same], size, near[same], items

    @staticmethod
    def _at(ids, at, size):
        out = np.zeros(len(at), np.uint64)
        for k in range(size):
            out = (out + ids[at + k].astype(np.uint64) + np.uint64(1)) * _FACTOR
            out ^= out >> np.uint64(29)
        return out


def _scan(shared, text_col, carry):
    def run(batches):
        windows = shared.value
        for batch in batches:
            table = {n: batch.column(k) for k, n in enumerate(batch.schema.names)}
            data, offsets = flat(table[text_col])
            n_words, all_hits, all_items = [], [], []
            for i, j in steps(offsets):
                cut = offsets[i:j + 1] - offsets[i]
                words, starts, ends, first = words_of_bytes(data[offsets[i]:offsets[j]], cut)
                n_words.append(np.diff(first))
                spans: dict[int, list] = {}
                items: dict[int, set] = {}
                for at, size, number, of in windows.hits(words):
                    row = np.searchsorted(first, at, "right") - 1
                    inside = at + size <= first[row + 1]
                    for a, r, w in zip(at[inside].tolist(), row[inside].tolist(), number[inside].tolist(), strict=True):
                        spans.setdefault(r, []).append((a, a + size))
                        items.setdefault(r, set()).update(of[w])
                for r in range(j - i):
                    own, base, zero = _merged(spans.get(r, ())), int(cut[r]), int(first[r])
                    all_hits.append([{"first": a - zero, "end": b - zero, "start_byte": int(starts[a]) - base, "end_byte": int(ends[b - 1]) - base} for a, b in own])
                    all_items.append(sorted(items.get(r, ())))
            counts = np.concatenate(n_words) if n_words else np.zeros(0, np.int64)
            release()
            made = [pa.array(counts, pa.int64()), pa.array(all_hits, _HITS), pa.array(all_items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([table[c] for c in carry] + made, names=[*carry, "_words", "_found", "_of"])

    return run


_HITS = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64()), ("start_byte", pa.int64()), ("end_byte", pa.int64())]))
_HIT_TYPE = "array<struct<first:bigint,end:bigint,start_byte:bigint,end_byte:bigint>>"


def _merged(spans):
    out = []
    for a, b in sorted(set(spans)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def _sets(benchmark, item_col, text_col, length, set_bytes):
    """The benchmark in window sets of bounded size, one after the other, and whether it is the last."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = int(size // set_bytes) + 1
    for k in range(parts):
        rows = items.where(F.expr(f"pmod(xxhash64(item, text), {parts}) = {k}")).collect()
        yield WindowSet([r.item or "" for r in rows], [r.text for r in rows], length), k + 1 == parts


def scan(docs: DataFrame, benchmark: DataFrame, text_col="text", carry=None, item_col="item_id", item_text_col="text", length=WINDOW_WORDS, set_bytes=SET_BYTES) -> DataFrame:
    """The ``carry`` columns of ``docs`` (all if None) with ``dc_words``, ``dc_hits`` and ``dc_items``.

    dc_words: number of words.  dc_hits: merged runs of words covered by
    occurring windows, by word number and by UTF-8 byte.  dc_items: sorted ids
    (as strings) of the items whose windows occur; an item without an id is ''.
    Columns of these names in ``docs`` are replaced.  Null texts and items have
    no words; an item of fewer words than a window is one window; an empty
    benchmark hits nothing.  The benchmark's size is taken first: beyond
    ``set_bytes`` it is scanned in several passes, each with a set of bounded
    size, and the hits are united.
    """
    spark = docs.sparkSession
    docs = docs.drop("dc_words", "dc_hits", "dc_items")
    carry = docs.columns if carry is None else list(carry)
    whole = carry if text_col in carry else [*carry, text_col]
    out = docs.select(*whole)
    for windows, last in _sets(benchmark, item_col, item_text_col, length, set_bytes):
        first = "dc_hits" not in out.columns
        keep = [*(carry if last else whole), *([] if first else ["dc_hits", "dc_items"])]
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.select(*keep).schema)
        shared = spark.sparkContext.broadcast(windows)
        out = out.mapInArrow(_scan(shared, text_col, keep), f"{schema}, _words long, _found {_HIT_TYPE}, _of array<string>")
        hits, items = (F.col("_found"), F.col("_of")) if first else (_union_hits("dc_hits", "_found"), F.array_sort(F.array_union("dc_items", "_of")))
        out = out.select(*(carry if last else whole), F.col("_words").alias("dc_words"), hits.alias("dc_hits"), items.alias("dc_items"))
        out = out if last else out.drop("dc_words")
    return out


def _union_hits(a, b):
    """Merged runs of two hit lists."""
    return F.expr(f"""aggregate(array_sort(concat({a}, {b})), cast(array() as {_HIT_TYPE}), (done, x) ->
        case when size(done) > 0 and x.first <= element_at(done, -1).end then
          concat(slice(done, 1, size(done) - 1), array(named_struct('first', element_at(done, -1).first,
            'end', greatest(element_at(done, -1).end, x.end), 'start_byte', element_at(done, -1).start_byte,
            'end_byte', greatest(element_at(done, -1).end_byte, x.end_byte))))
        else concat(done, array(x)) end)""")


def remove_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` without any hit, with their own columns."""
    return scan(docs, benchmark, **options).where("size(dc_hits) = 0").select(*docs.columns)


def remove_spans(docs: DataFrame, benchmark: DataFrame, text_col="text", **options) -> DataFrame:
    """``docs`` with every hit run of words cut out of the text; a null text stays null."""
    found = scan(docs, benchmark, text_col=text_col, **options)
    piece = f"""array_join(transform(sequence(0, size(dc_hits)), i -> cast(substring(encode(`{text_col}`, 'utf-8'),
        cast(if(i = 0, 0L, dc_hits[i - 1].end_byte) + 1 as int),
        cast(if(i < size(dc_hits), dc_hits[i].start_byte, octet_length(`{text_col}`)) - if(i = 0, 0L, dc_hits[i - 1].end_byte) as int)) as string)), '')"""
    cut = F.when(F.size("dc_hits") > 0, F.expr(piece)).otherwise(F.col(text_col))
    return found.withColumn(text_col, cut).select(*docs.columns)


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of every row."""
    found = scan(docs, benchmark, carry=["doc_id"])
    n_hit = F.expr("aggregate(dc_hits, 0L, (n, h) -> n + h.end - h.first)")
    return found.select(
        "doc_id", F.col("dc_words").alias("n_words"), n_hit.alias("n_hit"), F.size("dc_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("dc_items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))
