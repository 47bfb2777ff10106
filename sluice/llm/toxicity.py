"""Toxicity by weak supervision.

Voters are lexicon words and word-beginning and surface patterns that stand out
in toxic training rows, beside a short fixed lexicon; a training row's own label
is one voter more, of known accuracy.  A generative label model estimates from
the votes how often each voter fires in either class and how strongly voters
are correlated given the class; correlated voters share their say.  Its posteriors are the labels that a linear classifier over words
and patterns is trained on.  The classifier scores every whole text.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.batches import binary_array, flat, release, steps, word_spans
from sluice.session import materialize

#: Labelled rows that voters, label model and classifier are fitted on: about this many, chosen by a hash of the id.
MAX_LABELLED = 20_000
VOTERS, TOXIC_FEATURES, CLEAN_FEATURES = 96, 256, 64
MIN_ROWS, MIN_SHARE, MIN_LOG_ODDS = 2, 0.01, 1.5
#: How often a given label is taken to be right.
LABEL_ACCURACY = 0.97
THRESHOLD = 0.3
#: Voters that need no labels (fixed values).
LEXICON = ("idiot", "moron", "stupid", "loser", "scum", "trash", "clown", "pathetic", "worthless", "disgusting")
PREFIXES = (3, 4, 5)
SHOUT, CAPITALS = "s:!!", "s:capitals"

_ALL = np.arange(256)
_LETTER = ((_ALL >= 65) & (_ALL <= 90)) | ((_ALL >= 97) & (_ALL <= 122)) | (_ALL >= 128)


def word_features(word: str) -> list[str]:
    """A word's lexicon and pattern features."""
    low = word.lower()
    out = ["w:" + low] + ["p:" + low[:k] for k in PREFIXES if len(low) > k]
    if len(word) > 3 and word.isupper():
        out.append(CAPITALS)
    return out


def _word_codes(data, offsets):
    starts, ends, first = word_spans(data, offsets, _LETTER)
    coded = binary_array(data, starts, ends).dictionary_encode()
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return coded.indices.to_numpy(), rows, [w.decode(errors="replace") for w in coded.dictionary.to_pylist()]


def _shouts(data, offsets):
    """Rows with two exclamation marks in a row."""
    at = np.flatnonzero((data[1:] == 33) & (data[:-1] == 33)) if len(data) else np.zeros(0, np.int64)
    row = np.searchsorted(offsets, at, "right") - 1
    return np.unique(row[at + 1 < offsets[row + 1]])


def _present(data, offsets, number):
    """Distinct (row, feature number) of the texts; ``number`` gives a feature's number, None for no interest."""
    codes, rows, words = _word_codes(data, offsets)
    lists = [[n for f in word_features(w) if (n := number(f)) is not None] for w in words]
    counts = np.array([len(x) for x in lists], np.int64)
    pool = np.array([n for x in lists for n in x], np.int64)
    starts = np.cumsum(counts) - counts
    hit = np.flatnonzero(counts[codes] > 0) if len(codes) else np.zeros(0, np.int64)
    many = counts[codes[hit]]
    index = np.arange(int(many.sum())) + np.repeat(starts[codes[hit]] - (np.cumsum(many) - many), many)
    pairs_row, pairs_feature = np.repeat(rows[hit], many), pool[index]
    shout = number(SHOUT)
    if shout is not None:
        loud = _shouts(data, offsets)
        pairs_row, pairs_feature = np.append(pairs_row, loud), np.append(pairs_feature, np.full(len(loud), shout))
    both = np.unique(pairs_row << 32 | pairs_feature)
    return both >> 32, both & 0xFFFFFFFF


def _class_counts(batches):
    """Rows of either class that hold each feature, summed over what a batch holds."""
    for batch in batches:
        data, offsets = flat(batch.column(0))
        toxic = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
        names: dict[str, int] = {}
        found = [_present(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], lambda f: names.setdefault(f, len(names))) for i, j in steps(offsets)]
        base = [i for i, _ in steps(offsets)]
        rows = np.concatenate([r + b for (r, _), b in zip(found, base, strict=True)] or [np.zeros(0, np.int64)])
        features = np.concatenate([f for _, f in found] or [np.zeros(0, np.int64)])
        yes = np.bincount(features[toxic[rows]], minlength=len(names))
        no = np.bincount(features[~toxic[rows]], minlength=len(names))
        yield pa.RecordBatch.from_arrays([pa.array(list(names), pa.string()), pa.array(yes, pa.int64()), pa.array(no, pa.int64())], names=["feature", "yes", "no"])


@dataclass
class Model:
    """Weights of the linear classifier, and what the label model says of its voters."""

    weights: dict
    bias: float
    accuracies: dict
    correlations: np.ndarray


def fit_label_model(votes: np.ndarray, given: np.ndarray, rounds=25):
    """Posterior of label 1 per row, firing rates per class, and correlations of the voters given the class.

    ``votes``: rows by voters, 1 where a voter fires and 0 where it abstains.
    ``given``: the rows' labels, the voter of known accuracy.  A row in which
    no voter fires is a vote of its own kind.
    """
    n, m = votes.shape
    fired = votes.sum(1)
    sure = np.log(LABEL_ACCURACY / (1 - LABEL_ACCURACY))
    posterior = np.where(given, LABEL_ACCURACY, 1 - LABEL_ACCURACY)
    for _ in range(rounds):
        w1, w0 = posterior.sum() + 1e-9, (1 - posterior).sum() + 1e-9
        rate1 = (posterior @ votes + 0.05) / (w1 + 0.1)
        rate0 = ((1 - posterior) @ votes + 0.05) / (w0 + 10)
        rest = votes - np.outer(posterior, rate1) - np.outer(1 - posterior, rate0)
        spread = np.sqrt((rest ** 2).sum(0)) + 1e-9
        corr = (rest.T @ rest) / np.outer(spread, spread)
        share = 1 / np.abs(corr).sum(1)
        silent1 = max(((fired == 0) * posterior).sum() / w1, 1e-3)
        silent0 = max(((fired == 0) * (1 - posterior)).sum() / w0, 1e-3)
        prior = np.clip(w1 / n, 0.005, 0.5)
        odds = np.log(prior / (1 - prior)) + votes @ (share * np.log(rate1 / rate0)) + (fired == 0) * np.log(silent1 / silent0)
        odds += np.where(given, sure, -sure)
        posterior = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return posterior, rate1, rate0, corr


def _train(x, target, ridge=0.2, rounds=25):
    """Weights and bias of a logistic regression on soft labels, by Newton steps."""
    n, m = x.shape
    x = np.concatenate([x, np.ones((n, 1), x.dtype)], 1).astype(float)
    w = np.zeros(m + 1)
    w[-1] = np.log((target.sum() + 0.5) / (n - target.sum() + 0.5))
    pull = np.append(np.full(m, ridge), 1e-3)

    def loss(w):
        z = x @ w
        return float((np.logaddexp(0, z) - target * z).sum() + (pull * w * w).sum() / 2)

    now = loss(w)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - target) + pull * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(pull)
        step = np.linalg.solve(curve, slope)
        # A full step can overshoot; halve it until the loss falls.
        while (after := loss(w - step)) > now and np.abs(step).max() > 1e-6:
            step = step / 2
        if now - after < 1e-6:
            break
        w, now = w - step, after
    return w[:-1], float(w[-1])


def training_rows(docs: DataFrame, labels: DataFrame, limit=MAX_LABELLED) -> DataFrame:
    """(text, toxic) of about ``limit`` labelled rows that labels may be learned from.

    These are rows whose crc32 of the id as text is not 2 modulo 4.  Repeated
    labels of an id count once, as toxic if one of them is.
    """
    own = labels.where("doc_id is not null and toxic is not null and crc32(cast(doc_id as string)) % 4 <> 2")
    own = own.groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
    total = own.count()
    if total > limit:
        own = own.where(F.expr(f"pmod(xxhash64(doc_id), {1 << 40}) < {(limit << 40) // total}"))
    # About ``limit`` small rows, whatever the corpus.
    return docs.select("doc_id", "text").join(F.broadcast(own), "doc_id").select("text", "toxic")


def fit(docs: DataFrame, labels: DataFrame, limit=MAX_LABELLED) -> Model:
    """Voters, label model and classifier from the training rows.

    Without training rows of both classes the fixed lexicon alone is used.
    """
    rows = materialize(training_rows(docs, labels, limit), "toxicity-rows")
    sizes = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    yes, no = sizes.get(True, 0), sizes.get(False, 0)
    fixed = {f"w:{w}": 2.5 for w in LEXICON}
    if not yes or not no:
        return Model(fixed, -3.0, {}, np.zeros((0, 0)))
    counts = rows.mapInArrow(_class_counts, "feature string, yes long, no long").groupBy("feature").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))
    counts = materialize(counts.where(F.col("yes") + F.col("no") >= MIN_ROWS), "toxicity-counts")
    odds = F.log((F.col("yes") + 0.5) / (yes + 1)) - F.log((F.col("no") + 0.5) / (no + 1))
    scored = counts.withColumn("odds", odds)
    toxic = scored.where((F.col("odds") >= MIN_LOG_ODDS) & (F.col("yes") >= max(MIN_ROWS, MIN_SHARE * yes))).orderBy(F.desc(F.col("odds") * F.sqrt("yes")), "feature").limit(TOXIC_FEATURES).collect()
    clean = scored.where("odds < 0").orderBy(F.asc(F.col("odds") * F.sqrt("no")), "feature").limit(CLEAN_FEATURES).collect()
    names = list(dict.fromkeys([r.feature for r in toxic] + list(fixed) + [r.feature for r in clean]))
    voters = list(dict.fromkeys([r.feature for r in toxic[:VOTERS]] + list(fixed)))
    place = {f: k for k, f in enumerate(names)}

    def presence(batches):
        for batch in batches:
            data, offsets = flat(batch.column(0))
            lists = []
            for i, j in steps(offsets):
                row, feature = _present(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], place.get)
                lists += [x.tolist() for x in np.split(feature, np.searchsorted(row, np.arange(1, j - i)))]
            yield pa.RecordBatch.from_arrays([pa.array(lists, pa.list_(pa.int32())), batch.column(1)], names=["features", "toxic"])

    found = rows.mapInArrow(presence, "features array<int>, toxic boolean").collect()
    x = np.zeros((len(found), len(names)), np.float32)
    for k, row in enumerate(found):
        x[k, row.features] = 1
    posterior, rate1, rate0, corr = fit_label_model(x[:, [place[v] for v in voters]].astype(float), np.array([r.toxic for r in found]))
    weights, bias = _train(x, posterior)
    prior = posterior.mean()
    accuracy = prior * rate1 / (prior * rate1 + (1 - prior) * rate0)
    return Model(dict(zip(names, weights.tolist(), strict=True)), bias, dict(zip(voters, accuracy.tolist(), strict=True)), corr)


def score(docs: DataFrame, model: Model, carry=("doc_id",), text_col="text") -> DataFrame:
    """The ``carry`` columns with ``score``, the probability of label 1, of every whole text.

    Only the text enters the score.  A null or empty text has the score of a
    text without any feature.
    """
    spark = docs.sparkSession
    names = list(model.weights)
    shared = spark.sparkContext.broadcast(({f: k for k, f in enumerate(names)}, np.array([model.weights[f] for f in names] + [0.0]), model.bias))
    carry = list(carry)

    def run(batches):
        place, weights, bias = shared.value
        for batch in batches:
            data, offsets = flat(batch.column(len(carry)))
            total = np.full(len(offsets) - 1, bias)
            for i, j in steps(offsets):
                row, feature = _present(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], place.get)
                total[i:j] += np.bincount(row, weights[feature], minlength=j - i)
            made = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
            release()
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(len(carry))), pa.array(made)], names=[*carry, "tox_score"])

    given = docs.select(*carry, F.col(text_col).alias("_tox_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema[:-1])
    return given.mapInArrow(run, f"{schema}, tox_score double")


def keep_clean(docs: DataFrame, labels: DataFrame, threshold=THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with their own columns."""
    return score(docs, fit(docs, labels), docs.columns).where(F.col("tox_score") < threshold).select(*docs.columns)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    scored = score(docs, fit(docs, labels))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    return scored.select(
        "doc_id", held.alias("held_out"), F.col("tox_score").alias("score"), (F.col("tox_score") >= THRESHOLD).cast("int").alias("predicted"))
