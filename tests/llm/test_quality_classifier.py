"""Quality by subword embeddings beside plain Python."""

import re
import zlib

import numpy as np
import pyarrow as pa

from sluice.llm import subword_quality as sq
from sluice.llm.batches import flat

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
MASK = (1 << 64) - 1


def plain_hash(data: bytes) -> int:
    h = 0
    for b in data:
        h = (h * 0x100000001B3 + b + 1) & MASK
    return h


def plain_bucket(h: int) -> int:
    return ((h * 0x9E3779B97F4A7C15) & MASK) >> (64 - 18)


def plain_features(word: str) -> list[int]:
    """The word's own bucket and those of its character n-grams, by code points of ``<word>``."""
    out = [plain_bucket(plain_hash(word.encode()) ^ 0x5BD1E995)]
    marked = "<" + word + ">"
    for k in range(sq.MIN_N, sq.MAX_N + 1):
        out += [plain_bucket(plain_hash(marked[i:i + k].encode()) ^ k) for i in range(len(marked) - k + 1)]
    return out


def plain_score(model, text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(LOWER)) if w]
    feats = [f for w in words for f in plain_features(w)]
    h = model.embedding[feats].astype(np.float64).mean(0) if feats else np.zeros(sq.DIM)
    logits = model.weights @ h + model.bias
    return 1 / (1 + np.exp(-(logits[1] - logits[0])))


def test_features_are_those_of_plain_python():
    words = ["a", "ab", "hello", "niño", "漢字かな", "$$$", "x" * 40, "é̸"]
    fw, fb = sq.word_features(pa.array([w.encode() for w in words], pa.large_binary()))
    for k, w in enumerate(words):
        assert sorted(fb[fw == k].tolist()) == sorted(plain_features(w))
    # A shared n-gram has one bucket wherever it stands.
    fw, fb = sq.word_features(pa.array([b"bbb$$$", b"xyz$$$"], pa.large_binary()))
    assert plain_bucket(plain_hash(b"$$>") ^ 3) in set(fb[fw == 0]) & set(fb[fw == 1])


def test_scores_are_those_of_the_model(spark, docs, rows):
    labels = spark.createDataFrame([(d, int("moron" not in (t or "")), 0) for d, t in rows], "doc_id long, quality int, toxic int")
    model = sq.fit(docs, labels, epochs=2)
    got = {r.doc_id: r.quality_score for r in sq.score(docs, model).collect()}
    for d, t in rows:
        if t is None or len(t) < 50_000:
            assert abs(got[d] - plain_score(model, t)) < 1e-6
    data, offsets = flat(pa.array([t for _, t in rows]))
    assert np.allclose(sq.probabilities(model, sq.doc_vectors(model, data, offsets)), [got[d] for d, _ in rows])


def test_edges(spark, docs, empty, repeated, rows):
    labels = spark.createDataFrame([(d, int("moron" not in (t or "")), 0) for d, t in rows] * 2 + [(None, 1, 1), (1, None, None)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in sq.report(docs, labels).collect()}
    by_text = {}
    for d, t in rows:
        by_text.setdefault(t or "", set()).add(round(got[d].score, 9))
        assert 0 <= got[d].score <= 1 and got[d].predicted == int(got[d].score >= 0.5)
        assert got[d].held_out == (zlib.crc32(str(d).encode()) % 3 == 1)
    # The score depends on the text alone; null, empty and blank texts share the bias's score.
    assert all(len(s) == 1 for s in by_text.values())
    assert by_text[""] == by_text[" "] == by_text["\n\t \x0b"]
    none = labels.where("false")
    flat_scores = {round(r.score, 9) for r in sq.report(docs, none).collect()}
    assert len(flat_scores) > 1
    assert sq.report(empty, labels).collect() == []
    assert sq.report(repeated, labels).count() == repeated.count()
    nulls = [r for r in sq.report(repeated, labels).collect() if r.doc_id is None]
    assert len(nulls) == 1 and nulls[0].held_out is False


def test_learns_junk_on_held_out_rows(spark):
    path = "/root/testdata/sf0.01"
    given, labels = spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/labels.parquet")
    held = sq.report(given, labels).where("held_out").join(labels, "doc_id").collect()
    right = sum(r.predicted == r.quality for r in held)
    base = max(sum(r.quality for r in held), sum(1 - r.quality for r in held))
    assert right > base and right >= 0.95 * len(held)


def test_a_training_step_gathers_its_rows_once():
    """Gathering the embedding's rows is the cost of a step: once for the vector and the update."""
    class Counted(np.ndarray):
        gathers = 0

        def __getitem__(self, key):
            Counted.gathers += isinstance(key, np.ndarray)
            return np.asarray(self)[key]

    model = sq.initial_model()
    embedding = model.embedding.astype(np.float64)
    data, offsets = flat(pa.array(["a good text", "", "bad bad text"]))
    weights, bias = sq.sgd_epoch(embedding.view(Counted), np.zeros(len(embedding), bool), model.weights, model.bias, data, offsets, np.array([1, 0, 0]), np.ones(3))
    assert Counted.gathers == 2 and not np.array_equal(embedding, model.embedding) and np.isfinite(weights).all() and np.isfinite(bias).all()
