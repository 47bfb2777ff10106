"""Quality by divergence from language references, beside counting rules.

Every text gives two histograms: its characters by class, and its words among
the common words of its language (with one bin for all others).  The reference
of a language is the sum over all its documents.  A text is rejected if the
Jensen-Shannon distance of a histogram from its reference is too large; short
texts are allowed the more that few words lie apart by chance.
"""

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.batches import BLANK, LOWER, binary_array, flat, steps, word_spans
from sluice.session import materialize

MIN_WORDS = 50
REPEAT_PERCENT = 50
COMMON_WORDS = 200
COMMON_WORD_BYTES = 32
#: Languages with references of their own: the commonest codes; the others are 'und'.
MAX_LANGUAGES = 256
#: Distances (base 2, 0 to 1) beyond which a text is rejected.
CLASS_DISTANCE, WORD_DISTANCE = 0.24, 0.57
#: Below so many words the squared limits grow by CHANCE / words: the squared distance of a sample grows so.
FULL_WORDS, CHANCE = 100, 5.0
SYMBOLS = b"#*$%&|<>"
CLASSES = ("lower", "upper", "digit", "blank", "stop", "symbol", "other_mark", "wide")


@cache
def _byte_class() -> np.ndarray:
    """The class of every byte; lead bytes of wider characters are one class, their other bytes none (8)."""
    table = np.full(256, 6, np.uint8)
    table[97:123], table[65:91], table[48:58] = 0, 1, 2
    table[BLANK] = 3
    table[list(b".,;:'\"-()?")] = 4
    table[list(SYMBOLS)] = 5
    table[128:192], table[192:] = 8, 7
    return table


_NOT_BLANK = ~BLANK
_IS_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))


def _per_row(flags, offsets):
    """Sum of a flag per byte over every row."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeats(codes, first):
    """Words inside three-word windows found twice or more in their row."""
    n = len(first) - 1
    out = np.zeros(n, np.int64)
    size = int(codes.max()) + 1 if len(codes) else 1
    for r in range(n):
        own = codes[first[r]:first[r + 1]].astype(np.int64)
        if len(own) < 4:
            continue
        if size ** 3 < 1 << 63:
            key = (own[:-2] * size + own[1:-1]) * size + own[2:]
        else:
            _, key = np.unique(np.stack([own[:-2], own[1:-1], own[2:]], 1), axis=0, return_inverse=True)
        order = np.argsort(key, kind="stable")
        same = np.concatenate([[False], key[order][1:] == key[order][:-1], [False]])
        twice = order[same[1:] | same[:-1]]
        inside = np.zeros(len(own), bool)
        for k in range(3):
            inside[twice + k] = True
        out[r] = int(inside.sum())
    return out


def _dup_lines(text: bytes) -> int:
    seen, n = set(), 0
    for line in text.split(b"\n"):
        if line in seen:
            n += 1
        elif line.strip(b" \t\n\x0b\x0c\r"):
            seen.add(line)
    return n


def _features(data, offsets):
    """Counts of a run of texts, their word codes and the distinct lower-cased words."""
    starts, ends, first = word_spans(data, offsets, _NOT_BLANK)
    exact = binary_array(data, starts, ends).dictionary_encode()
    codes = exact.indices.to_numpy()
    kinds = _byte_class()[data]
    histogram = np.stack([_per_row(kinds == k, offsets) for k in range(8)], 1)
    chars = _per_row((data & 0xC0) != 0x80, offsets)
    raw = data.tobytes()
    counts = {
        "n_words": np.diff(first),
        "word_chars": chars - histogram[:, 3],
        "n_symbols": _per_row(_IS_SYMBOL[data], offsets),
        "n_dup_lines": np.array([_dup_lines(raw[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)], np.int64),
        "n_repeat_words": _repeats(codes, first),
    }
    return counts, histogram, codes, first, [w.lower() for w in exact.dictionary.to_pylist()]


def _code(column):
    return F.lower(F.trim(F.coalesce(column, F.lit(""))))


def language_key(column, kept=None):
    """The whole code, lower-cased and trimmed; 'und' for null, empty, or a code not among ``kept``."""
    code = _code(column)
    known = code != "" if kept is None else code.isin(list(kept))
    return F.when(known, code).otherwise(F.lit("und"))


def languages(docs: DataFrame, lang_col="lang", limit=MAX_LANGUAGES) -> list:
    """The ``limit`` commonest codes (ties by code): references are bounded by count, not by cutting codes."""
    counted = docs.select(_code(F.col(lang_col)).alias("code")).where("code <> ''").groupBy("code").count()
    return [r.code for r in counted.orderBy(F.desc("count"), "code").limit(limit).collect()]


def _totals(batches):
    """Per language class counts (word '', with the class), word counts and the count of long words (kind -2) of what a task has read."""
    for batch in batches:
        langs, texts = batch.column(0).to_pylist(), batch.column(1)
        data, offsets = flat(texts)
        sums: dict[tuple, int] = {}
        for i, j in steps(offsets):
            histogram, codes, first, words = _histograms(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            own = np.array(langs[i:j])
            for lang in sorted(set(langs[i:j])):
                rows = np.flatnonzero(own == lang)
                for k, v in enumerate(histogram[rows].sum(0).tolist()):
                    if v:
                        sums[lang, b"", k] = sums.get((lang, b"", k), 0) + v
                picked = np.concatenate([codes[first[r]:first[r + 1]] for r in rows.tolist()])
                count = np.bincount(picked, minlength=len(words))
                for c in np.flatnonzero(count).tolist():
                    # Words too long to be common only count in sum.
                    key = (lang, words[c], -1) if len(words[c]) <= COMMON_WORD_BYTES else (lang, b"", -2)
                    sums[key] = sums.get(key, 0) + int(count[c])
        keys = list(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.binary()),
             pa.array([k[2] for k in keys], pa.int32()), pa.array(list(sums.values()), pa.int64())],
            names=["lang", "word", "kind", "n"])


def _histograms(data, offsets):
    """Class counts per text, codes of all lower-cased words, first word per text, distinct words."""
    starts, ends, first = word_spans(data, offsets, _NOT_BLANK)
    coded = binary_array(LOWER[data], starts, ends).dictionary_encode()
    kinds = _byte_class()[data]
    histogram = np.stack([_per_row(kinds == k, offsets) for k in range(8)], 1)
    return histogram, coded.indices.to_numpy(), first, coded.dictionary.to_pylist()


def references(docs: DataFrame, text_col="text", lang_col="lang", common=COMMON_WORDS, kept=None) -> DataFrame:
    """(lang, word, kind, n) over all documents: class counts (kind 0-7) and the commonest words (kind -1).

    Counts are summed per task before the shuffle.  Kind -2 holds the words of
    a language that are not among its ``common`` commonest, long words included;
    ties go by bytes.
    """
    parts = docs.select(language_key(F.col(lang_col), kept).alias("lang"), F.col(text_col)).mapInArrow(_totals, "lang string, word binary, kind int, n long")
    # Read three times below, so written once.
    summed = materialize(parts.groupBy("lang", "word", "kind").agg(F.sum("n").alias("n")), "language-counts")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    words = summed.where("kind = -1")
    top = words.withColumn("rank", rank).where(F.col("rank") <= common).drop("rank")
    # Of the rest only the sum is needed: all words, long ones too, less the common ones.
    rest = summed.where("kind < 0").groupBy("lang").agg(F.sum("n").alias("n")).union(top.select("lang", -F.col("n")))
    rest = rest.groupBy("lang").agg(F.sum("n").alias("n")).select("lang", F.lit(b"").alias("word"), F.lit(-2).alias("kind"), "n")
    return summed.where("kind >= 0").union(top).union(rest)


class _Reference:
    def __init__(self, rows):
        self.classes = np.zeros(8)
        self.words, counts, rest = {}, [], 0
        for word, kind, n in rows:
            if kind >= 0:
                self.classes[kind] = n
            elif kind == -1:
                self.words[word] = len(self.words)
                counts.append(n)
            else:
                rest = n
        self.common = np.array([*counts, rest], float)


def distance(p, q) -> np.ndarray:
    """Jensen-Shannon distance (base 2) of every row of p from q; a row without counts has distance 0."""
    total = p.sum(1, keepdims=True)
    p = np.divide(p, total, out=np.zeros(p.shape), where=total > 0)
    q = np.broadcast_to(q / q.sum() if q.sum() else q, p.shape)
    m = (p + q) / 2
    ratio = lambda a: np.where(a > 0, a * np.log2(np.divide(a, m, out=np.ones(a.shape), where=(a > 0) & (m > 0))), 0).sum(1)
    return np.where(total[:, 0] > 0, np.sqrt(np.maximum((ratio(p) + ratio(q)) / 2, 0)), 0.0)


def limit(full, n_words) -> np.ndarray:
    """The distance allowed to texts of so many words: ``full`` from FULL_WORDS on."""
    more = CHANCE / np.clip(n_words, 1, FULL_WORDS) - CHANCE / FULL_WORDS
    return np.where(more > 0, np.sqrt(full ** 2 + more), full)


def _judge(shared, columns, limits):
    def run(batches):
        refs = {lang: _Reference(rows) for lang, rows in shared.value.items()}
        for batch in batches:
            langs, texts = batch.column(len(columns)).to_pylist(), batch.column(len(columns) + 1)
            data, offsets = flat(texts)
            parts = []
            for i, j in steps(offsets):
                counts, histogram, codes, first, words = _features(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                own = np.array(langs[i:j])
                classes, common = np.zeros(j - i), np.zeros(j - i)
                for lang in sorted(set(langs[i:j])):
                    ref = refs[lang]
                    rows = np.flatnonzero(own == lang)
                    classes[rows] = distance(histogram[rows].astype(float), ref.classes)
                    place = np.array([ref.words.get(w, len(ref.words)) for w in words], np.int64)
                    for r in rows.tolist():
                        bins = np.bincount(place[codes[first[r]:first[r + 1]]], minlength=len(ref.common))[None, :].astype(float)
                        common[r] = distance(bins, ref.common)[0]
                parts.append(counts | {"class_distance": classes, "word_distance": common})
            names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "class_distance", "word_distance"]
            empty = {n: np.zeros(0, float if n.endswith("distance") else np.int64) for n in names}
            made = {n: np.concatenate([p[n] for p in parts] or [empty[n]]) for n in names}
            failed = (made["n_words"] < MIN_WORDS) | (100 * made["n_repeat_words"] > REPEAT_PERCENT * made["n_words"])
            class_limit, word_limit = limits
            far = made["class_distance"] > limit(class_limit, made["n_words"])
            far |= made["word_distance"] > limit(word_limit, made["n_words"])
            arrays = [batch.column(k) for k in range(len(columns))] + [pa.array(made[n]) for n in names] + [pa.array(failed), pa.array(~failed & ~far)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*columns, *names, "base_failed", "kept"])

    return run


def judge(docs: DataFrame, id_col="doc_id", text_col="text", lang_col="lang", class_distance=CLASS_DISTANCE, word_distance=WORD_DISTANCE) -> DataFrame:
    """Counts, distances and verdict of every row: see ``report`` for the columns.

    A null or empty text has no words and fails the base rules; a null language
    is the language 'und', as is any code beyond the ``MAX_LANGUAGES``
    commonest.  The references are gathered as one small table: at most
    ``MAX_LANGUAGES`` + 1 languages of ``COMMON_WORDS`` words of 32 bytes at most.
    """
    spark = docs.sparkSession
    kept = languages(docs, lang_col)
    rows = references(docs, text_col, lang_col, kept=kept).collect()
    refs: dict[str, list] = {}
    for r in sorted(rows, key=lambda r: (r.lang, -r.kind, -r.n, bytes(r.word))):
        refs.setdefault(r.lang, []).append((bytes(r.word), r.kind, r.n))
    for lang in [*kept, "und"]:
        refs.setdefault(lang, [])
    shared = spark.sparkContext.broadcast(refs)
    source = docs.select(F.col(id_col).cast("long").alias(id_col), language_key(F.col(lang_col), kept).alias("_lang"), F.col(text_col).alias("_text"))
    schema = f"`{id_col}` long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, class_distance double, word_distance double, base_failed boolean, kept boolean"
    return source.mapInArrow(_judge(shared, [id_col], (class_distance, word_distance)), schema)


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, distances)."""
    return judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "class_distance", "word_distance")
