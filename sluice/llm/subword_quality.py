"""Quality by supervised subword embeddings.

Every word (A-Z lower-cased, split at ``[\\x20\\x09-\\x0D]``) has a feature of
its own and one for each character n-gram, ``MIN_N`` to ``MAX_N`` code points,
of ``<word>``; all are hashed into ``BUCKETS`` rows of an embedding matrix.  A
document's vector is the mean of the rows of all features of all its words,
repeats included; a softmax layer over it gives the two classes.

Training is stochastic gradient descent in numpy, one labelled row at a time,
run where the rows lie: each epoch every partition starts from the same model,
and the partitions' changes are averaged by their number of rows (iterative
parameter mixing).  The model is ``BUCKETS x DIM`` numbers whatever the input,
so it is the only thing that is broadcast or brought to the driver.  All
permitted labelled rows are learned from; nothing is sampled.

Defined results: a null text is empty; an empty text, or one of blanks only,
has no features and the score of the bias alone.  A document's score depends
on its text only.  Repeated documents are scored each; repeated labels of one
id count as one, the mean label of 0.5 or more being 1.  An empty or one-class
training set leaves the embedding as initialised and the bias at the class
share.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.batches import BLANK, LOWER, binary_array, flat, release, steps, word_spans
from sluice.session import materialize

BUCKETS, DIM = 1 << 18, 16
MIN_N, MAX_N = 3, 5
EPOCHS, LEARNING_RATE = 3, 1.0
THRESHOLD = 0.5
#: Training rows of one SGD task, about; the tasks' changes are averaged.
ROWS_PER_TASK = 20_000
#: SGD steps of a partition in an epoch, at least: a smaller partition's rows are passed over again.
MIN_STEPS = 3000
#: Labels whose rows may be broadcast to the documents: at most this many, 16 bytes each.
BROADCAST_LABELS = 4_000_000
SEED = 11

_P = np.uint64(0x100000001B3)
_P_INV = np.uint64(pow(0x100000001B3, -1, 1 << 64))
_MIX = np.uint64(0x9E3779B97F4A7C15)
_WORD_SALT = np.uint64(0x5BD1E995)
_SHIFT = np.uint64(64 - BUCKETS.bit_length() + 1)
_NOT_BLANK = ~BLANK


@dataclass
class Model:
    embedding: np.ndarray  # BUCKETS x DIM
    weights: np.ndarray  # 2 x DIM
    bias: np.ndarray  # 2


def _powers(base, n):
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out, dtype=np.uint64)


def _bucket(h):
    with np.errstate(over="ignore"):
        return ((h * _MIX) >> _SHIFT).astype(np.int64)


def word_features(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(word number, bucket) of every feature of the given distinct words, in word order."""
    data, offsets = flat(words)
    n = len(offsets) - 1
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    lengths = np.diff(offsets)
    marked_offsets = offsets + 2 * np.arange(n + 1)
    marked = np.full(int(marked_offsets[-1]), ord(">"), np.uint8)
    marked[marked_offsets[:-1]] = ord("<")
    inner = np.repeat(marked_offsets[:-1] + 1 - offsets[:-1], lengths) + np.arange(len(data))
    marked[inner] = data
    values = marked.astype(np.uint64) + np.uint64(1)
    with np.errstate(over="ignore"):
        prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * _powers(_P_INV, len(values) - 1), dtype=np.uint64)])
        up = _powers(_P, len(values))

        def span_hash(s, e):
            return up[e - 1] * (prefix[e] - prefix[s])

        # Code points begin at every byte that is not a continuation byte.
        is_begin = (marked & 0xC0) != 0x80
        begins = np.flatnonzero(is_begin)
        chars = np.add.reduceat(is_begin, marked_offsets[:-1], dtype=np.int64)
        word_of = np.repeat(np.arange(n), chars)
        first_char = np.concatenate([[0], np.cumsum(chars)])
        # A sentinel begin at each word's end, so that char i + k of a word is found by index.
        bounds = np.insert(begins, first_char[1:], marked_offsets[1:])
        shifted = first_char[:-1] + np.arange(n)
        index_in_word = np.arange(len(begins)) - np.repeat(first_char[:-1], chars)
        at = np.repeat(shifted, chars) + index_in_word
        chars_left = np.repeat(chars, chars) - index_in_word
        out_w, out_b = [np.arange(n)], [_bucket(span_hash(marked_offsets[:-1] + 1, marked_offsets[1:] - 1) ^ _WORD_SALT)]
        for k in range(MIN_N, MAX_N + 1):
            ok = np.flatnonzero(chars_left >= k)
            here = at[ok]
            s, e = bounds[here], bounds[here + k]
            out_w.append(word_of[ok])
            out_b.append(_bucket(span_hash(s, e) ^ np.uint64(k)))
    w, b = np.concatenate(out_w), np.concatenate(out_b)
    order = np.argsort(w, kind="stable")
    return w[order], b[order]


def _tokens(data, offsets):
    """Per token its distinct-word number, per row its first token, and the distinct words."""
    low = LOWER[data]
    starts, ends, first = word_spans(low, offsets, _NOT_BLANK)
    if not len(starts):
        return np.zeros(0, np.int64), first, pa.array([], pa.large_binary())
    coded = binary_array(low, starts, ends).dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), first, coded.dictionary


def segment_sums(table, index, starts, chunk=1 << 16) -> np.ndarray:
    """Per segment, the sum of ``table[index[s:e]]``; ``starts`` are the segments' first positions (rising; equal for empty segments).

    Rows are gathered ``chunk`` at a time and summed by ``reduceat``, so
    memory stays small however long a segment is.
    """
    starts = np.asarray(starts, np.int64)
    out = np.zeros((len(starts), table.shape[1]))
    for a in range(0, len(index), chunk):
        b = min(a + chunk, len(index))
        cuts = np.unique(np.concatenate([[a], starts[(starts > a) & (starts < b)]]))
        # The segment that holds a cut is the last one starting there (empty segments start there too).
        holder = np.searchsorted(starts, cuts, "right") - 1
        # Cuts differ, and so do the segments that hold them.
        out[holder] += np.add.reduceat(table.take(index[a:b], axis=0), cuts - a, axis=0, dtype=np.float64)
    return out


def _word_sums(embedding, words):
    """Per distinct word, the sum of its features' rows and their number."""
    fw, fb = word_features(words)
    count = np.bincount(fw, minlength=len(words))
    return segment_sums(embedding, fb, np.concatenate([[0], np.cumsum(count)[:-1]])), count


def doc_vectors(model: Model, data, offsets) -> np.ndarray:
    """Mean feature row of every text (zeros for a text without words)."""
    codes, first, words = _tokens(data, offsets)
    rows = len(offsets) - 1
    if not len(codes):
        return np.zeros((rows, model.embedding.shape[1]))
    sums, count = _word_sums(model.embedding, words)
    n = np.bincount(np.repeat(np.arange(rows), np.diff(first)), count[codes], minlength=rows)
    return segment_sums(sums, codes, first[:-1]) / np.maximum(n, 1)[:, None]


def probabilities(model: Model, vectors) -> np.ndarray:
    """Probability of label 1 from document vectors."""
    logits = vectors @ model.weights.T + model.bias
    return 1 / (1 + np.exp(-np.clip(logits[:, 1] - logits[:, 0], -60, 60)))


def initial_model(share=0.5) -> Model:
    rng = np.random.default_rng(SEED)
    embedding = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    share = min(max(share, 1e-3), 1 - 1e-3)
    # An output layer of zeros would give the embedding no gradient until it has grown.
    weights = rng.uniform(-1, 1, (2, DIM))
    return Model(embedding, weights, np.array([0.0, np.log(share / (1 - share))]))


def sgd_epoch(embedding: np.ndarray, touched: np.ndarray, weights, bias, data, offsets, labels, rates) -> tuple[np.ndarray, np.ndarray]:
    """One pass over the rows in order; returns the new output layer.

    ``embedding`` is a task's own working copy and is changed in place;
    ``touched`` marks the buckets changed.  ``rates`` gives each row's
    learning rate.
    """
    codes, first, words = _tokens(data, offsets)
    fw, fb = word_features(words)
    count = np.bincount(fw, minlength=len(words))
    feature_start = np.concatenate([[0], np.cumsum(count)])
    weights, bias = weights.copy(), bias.copy()
    for r in range(len(offsets) - 1):
        token = codes[first[r]:first[r + 1]]
        if len(token):
            word, times = np.unique(token, return_counts=True)
            per = count[word]
            index = np.repeat(feature_start[word] - np.concatenate([[0], np.cumsum(per)[:-1]]), per) + np.arange(int(per.sum()))
            buckets, where = np.unique(fb[index], return_inverse=True)
            weight = np.bincount(where, np.repeat(times, per), minlength=len(buckets)) / float((times * per).sum())
            rows = embedding[buckets]
            h = weight @ rows
        else:
            buckets, h = (), np.zeros(weights.shape[1])
        logits = weights @ h + bias
        p = np.exp(logits - logits.max())
        p /= p.sum()
        p[int(labels[r])] -= 1
        grad_h = weights.T @ p
        weights -= rates[r] * np.outer(p, h)
        bias -= rates[r] * p
        if len(buckets):
            embedding[buckets] = rows - rates[r] * weight[:, None] * grad_h[None, :]
            touched[buckets] = True
    return weights, bias


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, label) of every labelled row that may be learned from: crc32 of the id as text is not 1 modulo 3.

    Labels are broadcast only while there are at most ``BROADCAST_LABELS`` of them; beyond, both sides are shuffled by id.
    """
    own = labels.where("doc_id is not null and quality is not null and crc32(cast(doc_id as string)) % 3 <> 1")
    own = own.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
    own = materialize(own, "quality-labels")
    many = own.count()
    side = F.broadcast(own) if many <= BROADCAST_LABELS else own
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).join(side, "doc_id").select("text", "label")
    # Written once in parts of about ROWS_PER_TASK rows: every epoch reads them, and each part is one SGD task.
    return materialize(rows.repartition(max(1, -(-many // ROWS_PER_TASK))), "quality-rows")


def fit(docs: DataFrame, labels: DataFrame, epochs=EPOCHS, rate=LEARNING_RATE) -> Model:
    """The model learned from all permitted labelled rows."""
    spark = docs.sparkSession
    rows = training_rows(docs, labels)
    sizes = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    total = sum(sizes.values())
    model = initial_model(sizes.get(1, 0) / total if total else 0.5)
    if len(sizes) < 2:
        return model
    names = [f"d{k}" for k in range(DIM)]
    # Rows a partition holds, about: for the fall of the learning rate within an epoch.
    expected = total / max(rows.rdd.getNumPartitions(), 1)
    for epoch in range(epochs):
        shared = spark.sparkContext.broadcast(model)
        done = epoch / epochs

        def train(batches, shared=shared, done=done, epoch=epoch):
            import pyspark

            current = shared.value
            part = pyspark.TaskContext.get().partitionId()
            embedding = current.embedding.astype(np.float64)
            touched = np.zeros(len(embedding), bool)
            weights, bias = current.weights, current.bias
            batches = iter(batches)
            held, n = [], 0
            for batch in batches:
                held.append(batch)
                n += batch.num_rows
                if n >= MIN_STEPS:
                    break
            # A partition of fewer rows than MIN_STEPS is passed over again within the epoch.
            passes = 1 if n >= MIN_STEPS else -(-MIN_STEPS // max(n, 1))
            planned, done_steps = max(expected, n * passes, 1), 0

            def learn(batch, key):
                nonlocal weights, bias, done_steps
                marks = batch.column(1).to_numpy(zero_copy_only=False)
                # Rows in an order of their own per epoch, partition, pass and batch, the same on a re-run.
                order = np.random.default_rng((SEED, epoch, part, *key)).permutation(len(marks))
                data, offsets = flat(batch.column(0).take(pa.array(order)))
                marks = marks[order]
                rates = rate * (1 - done - (done_steps + np.arange(len(marks))) / (planned * epochs)).clip(0.02)
                for i, j in steps(offsets):
                    weights, bias = sgd_epoch(embedding, touched, weights, bias, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], marks[i:j], rates[i:j])
                    release()
                done_steps += len(marks)

            for again in range(passes):
                for number, batch in enumerate(held):
                    learn(batch, (again, number))
            for number, batch in enumerate(batches, len(held)):
                learn(batch, (0, number))
                n += batch.num_rows
            if not n:
                return
            keys = np.flatnonzero(touched)
            change = np.zeros((len(keys) + 3, DIM))
            change[:len(keys)] = embedding[keys] - current.embedding[keys]
            change[len(keys):len(keys) + 2] = weights - current.weights
            change[len(keys) + 2, :2] = bias - current.bias
            # Weighted by the partition's rows: summed and divided by all rows, the changes average.
            change *= n
            keys = np.concatenate([keys, [-1, -2, -3]])
            yield pa.RecordBatch.from_arrays([pa.array(keys)] + [pa.array(change[:, k].astype(np.float32)) for k in range(DIM)], names=["bucket", *names])

        schema = "bucket long, " + ", ".join(f"{c} float" for c in names)
        # At most BUCKETS + 3 rows of DIM numbers, whatever the input.
        got = rows.mapInArrow(train, schema).groupBy("bucket").agg(*[F.sum(c).alias(c) for c in names]).toArrow()
        shared.unpersist()
        keys = got.column("bucket").to_numpy()
        change = np.stack([got.column(c).to_numpy() for c in names], axis=1) / total if len(keys) else np.zeros((0, DIM))
        embedding, weights, bias = model.embedding.copy(), model.weights.copy(), model.bias.copy()
        embedding[keys[keys >= 0]] += change[keys >= 0].astype(np.float32)
        for k in (-1, -2):
            weights[-1 - k] += change[keys == k].sum(axis=0)
        bias += change[keys == -3].sum(axis=0)[:2]
        model = Model(embedding, weights, bias)
    return model


def score(docs: DataFrame, model: Model, carry=("doc_id",), text_col="text") -> DataFrame:
    """The ``carry`` columns with ``quality_score``, the probability of label 1, of every whole text."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    carry = list(carry)

    def run(batches):
        current = shared.value
        for batch in batches:
            data, offsets = flat(batch.column(len(carry)))
            made = np.zeros(len(offsets) - 1)
            for i, j in steps(offsets):
                made[i:j] = probabilities(current, doc_vectors(current, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]))
            release()
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(len(carry))), pa.array(made)], names=[*carry, "quality_score"])

    given = docs.select(*carry, F.col(text_col).alias("_quality_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema[:-1])
    return given.mapInArrow(run, f"{schema}, quality_score double" if carry else "quality_score double")


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``; a null id is not held out."""
    scored = score(docs, fit(docs, labels))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    return scored.select(
        "doc_id", held.alias("held_out"), F.col("quality_score").alias("score"), (F.col("quality_score") >= THRESHOLD).cast("int").alias("predicted"))
