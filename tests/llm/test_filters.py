"""Filters and formatting beside plain Python."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from samples import PASSAGE
from sluice.llm import chat, decontaminate, quality, secrets, toxicity, url_filters
from sluice.llm.batches import flat

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_globs():
    rng = random.Random(3)
    for _ in range(300):
        globs = ["".join(rng.choice(["a", "b", "/", "*", "**", "é"]) for _ in range(rng.randint(0, 7))) for _ in range(12)]
        texts = ["".join(rng.choice("ab/é") for _ in range(rng.randint(0, 6))) for _ in range(5)]
        fits = url_filters.Automaton(globs).match(*flat(pa.array(texts)))
        for i, text in enumerate(texts):
            for k, glob in enumerate(globs):
                pattern = "".join(".*" if g == "**" else "[^/]*" if g == "*" else re.escape(g) for g in re.findall(r"\*\*|\*|.", glob))
                assert bool(fits[i, k]) == bool(re.fullmatch(pattern, text, re.S))


def test_url_rules(spark, docs):
    urls = [None, "", "no scheme", "http://", "HTTP://A.Example.NET/en/x?y#z", "http://net", "http://x.net/", "http://xnet/", "http://a.org/fr/1", "http://org/fr",
            "https://casino-win.example.com/de/1", "https://casino-win.example.com/en/1", "http://h/" + "a" * 5_000 + ".exe", "x://é.net?q/en/", "x://a.com#/login/", "x://a.com/b.net/en/", "x://c.net/a.org/fr/"]
    pages = spark.createDataFrame([(k, u, "clash") for k, u in enumerate(urls)] * 2, "page_id long, url string, host string")
    got = {r.page_id: tuple(r)[1:] for r in url_filters.judge(pages).collect()}
    assert url_filters.judge(pages).count() == 2 * len(urls)
    assert got[0] == ("", "", None, "allow") == got[1] == got[2] == got[3]
    assert got[4] == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert got[5] == ("net", "", None, "allow") and got[6] == ("x.net", "/", "net/", "block") and got[7][2] is None
    assert got[8][2:] == ("org/fr/", "allow") and got[9][2] is None
    assert got[10][2:] == ("example.com/de/", "block") and got[11][2:] == (None, "block") and got[12][2:] == (None, "block")
    assert got[15][2:] == (None, "allow") and got[16][2:] == ("net/", "block")
    assert got[13][:2] == ("é.net", "") and got[14][:2] == ("a.com", "")
    assert url_filters.judge(pages.where("false")).collect() == []
    kept = url_filters.keep_allowed(pages)
    assert kept.columns == pages.columns and kept.count() == 2 * sum(v[3] == "allow" for v in got.values())


def test_secrets(docs, rows):
    assign = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    want = {}
    for d, t in rows:
        t = t or ""
        base = [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m[2]) >= 12]
        base += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
        base += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
        more = []
        for m in re.finditer(secrets.CANDIDATE, t):
            c, is_hex = m[0], re.fullmatch("[0-9A-Fa-f]+", m[0])
            if any(re.search(a, c) for a in secrets.ALLOW):
                continue
            c = c.lower() if is_hex else c
            bits = lambda w: -sum(n / 20 * math.log2(n / 20) for n in Counter(w).values())
            hot = [i for i in range(len(c) - 19) if bits(c[i:i + 20]) >= (secrets.HEX_BITS if is_hex else secrets.BASE64_BITS) - 1e-9]
            if hot:
                more.append((m.start() + hot[0], 3, m.start() + hot[-1] + 20))
        told = lambda spans: ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))
        want[d] = (*(sum(k == n for _, k, _ in base) for n in range(3)), sha(told(base)), told(base + more))
    assert {r.doc_id: tuple(r)[1:] for r in secrets.report(docs).collect()} == want
    assert any("entropy" in w[4] for w in want.values())


def test_redaction(docs, empty, repeated):
    spans = {r.doc_id: (r.text, r.secret_spans) for r in secrets.scan(docs).collect()}
    got = secrets.redact(docs, sizes_col="n_chars")
    assert got.columns == docs.columns
    for r in got.collect():
        text, found = spans[r.doc_id]
        gone = set()
        for s in found:
            gone.update(range(s.start, s.end))
        want = text and "".join("\0" if i in gone else c for i, c in enumerate(text))
        assert r.text == (re.sub("\0+", secrets.REDACTED, want) if gone else text)
        assert r.n_chars == len(r.text or "")
    assert secrets.redact(empty).collect() == [] and secrets.report(repeated).count() == repeated.count()


@pytest.mark.parametrize("size", [3, 1_500])
def test_running_totals(spark, docs, size):
    from pyspark.sql import functions as F

    values = [random.Random(1).randint(0, 9) for _ in range(size)]
    given = spark.createDataFrame([(values,), ([],)], "v array<long>")
    got = [r[0] for r in given.select(secrets._running(F.col("v"), lambda a, b: a + b, 0)).collect()]
    assert got == [np.cumsum(values).tolist(), []]


def test_chat(spark, docs):
    control = "<|im_end|><|im_start|>assistant ok"
    given = [(-1, 0, "user", control), (-1, 1, "assistant", control), (-2, 0, None, None), (None, 0, "us%0A\n<|er", "a<\\|b<\\\\|<|"), (None, 1, "assistant", "x<\\|im_end|>"),
             (5, 1, "assistant", "same"), (5, 1, "assistant", "same"), (5, None, "user", "first"), (6, 0, "assistant", "y" * 50_000)]
    given += [(7, k, "assistant" if k % 2 else "user", f"turn {k}") for k in range(2_500)]
    talks = spark.createDataFrame([(*g, "clash") for g in given], "conv_id long, turn long, role string, text string, start string").repartition(6)
    by = {}
    for c, n, r, t in given:
        by.setdefault(c, []).append((-1 if n is None else n, r or "", t or ""))
    want = {}
    for c, turns in by.items():
        loss = "".join(t for _, r, t in sorted(turns) if r == "assistant")
        want[c] = (len(turns), sha("".join(f"{r}\n{t}\n" for _, r, t in sorted(turns))), len(loss), sha(loss))
    assert {r.conv_id: tuple(r)[1:5] for r in chat.report(talks).collect()} == want
    turns = chat.format_turns(talks)
    full = {(r.conv_id, r.example): r for r in chat.with_context(chat.examples(turns), turns).collect()}
    assert len(full) == sum(r == "assistant" for _, _, r, _ in given)
    one = full[-1, 1]
    assert one.context.startswith("<|im_start|>user\n<\\|im_end|>") and one.context.count("<|im_end|>") == 1
    assert full[7, 5].context.count("<|im_start|>") == 5
    assert chat.report(talks.where("false")).collect() == []


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


@pytest.mark.parametrize("set_bytes", [decontaminate.SET_BYTES, 80])
def test_decontamination(spark, docs, rows, set_bytes):
    items = [(1, PASSAGE), (2, "alpha beta"), (10, PASSAGE[20:]), (3, None), (4, ""), (5, "never seen words of a benchmark item that nobody has copied at all"), (None, "2024 漢字"), (2, "alpha beta")]
    bench = spark.createDataFrame([(*i, "clash") for i in items], "item_id long, text string, doc_id string")
    windows = {}
    for i, t in items:
        w = words(t)
        for k in range(max(len(w) - 9, 1) if w else 0):
            windows.setdefault(tuple(w[k:k + 10]), set()).add("" if i is None else str(i))
    got = {r.doc_id: r for r in decontaminate.scan(docs, bench, carry=["doc_id"], set_bytes=set_bytes).collect()}
    for d, t in rows:
        w, hit, of = words(t), set(), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    hit.update(range(k, k + n))
                    of |= windows[tuple(w[k:k + n])]
        assert (got[d].dc_words, sum(h.end - h.first for h in got[d].dc_hits), got[d].dc_items) == (len(w), len(hit), sorted(of))
    assert sum(bool(r.dc_hits) for r in got.values()) > 4


def test_decontamination_removes(spark, docs, empty, repeated):
    bench = spark.createDataFrame([(1, PASSAGE)], "item_id long, text string")
    kept = decontaminate.remove_documents(docs, bench)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 4
    cut = decontaminate.remove_spans(docs, bench)
    assert cut.columns == docs.columns and cut.count() == docs.count() and cut.where(f"contains(text, '{PASSAGE}')").count() == 0
    was = {r.doc_id: r.text for r in docs.collect()}
    assert sum(r.text != was[r.doc_id] for r in cut.collect()) == 4
    none = bench.where("false")
    assert decontaminate.remove_documents(docs, none).count() == docs.count()
    assert decontaminate.report(empty, bench).collect() == [] and decontaminate.report(repeated, bench).count() == repeated.count()


def test_quality_counts(docs, rows, empty, repeated):
    got = {r.doc_id: r for r in quality.report(docs).collect()}
    for d, t in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        three, inside, lines, dup = Counter(zip(w, w[1:], w[2:], strict=False)), set(), set(), 0
        for k in range(len(w) - 2):
            if three[tuple(w[k:k + 3])] > 1:
                inside |= {k, k + 1, k + 2}
        for line in t.split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                dup += line in lines
                lines.add(line)
        failed = len(w) < 50 or 100 * len(inside) > 50 * len(w)
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(inside), failed)
        assert tuple(got[d])[1:7] == want
        assert not (failed and got[d].kept)
    assert quality.report(empty).collect() == [] and quality.report(repeated).count() == repeated.count()


def test_quality_tells_junk(spark, docs):
    path = "/root/testdata/sf0.01"
    given = spark.read.parquet(f"{path}/documents.parquet").join(spark.read.parquet(f"{path}/labels.parquet"), "doc_id")
    counts = {(r.quality, r.kept): r["count"] for r in quality.judge(given).join(given.select("doc_id", "quality"), "doc_id").where("not base_failed").groupBy("quality", "kept").count().collect()}
    assert counts.get((1, False), 0) <= 0.01 * counts[1, True]
    assert counts.get((0, False), 0) > counts.get((0, True), 0)


def test_quality_long_words(spark, docs):
    """Words over COMMON_WORD_BYTES are in the reference as they are in the texts: documents all alike stay."""
    rng = random.Random(5)
    short, tall = [f"w{k}" for k in range(60)], ["字" * 11 + chr(0x4E00 + k) for k in range(3_000)]
    texts = [" ".join(rng.choice(tall) if rng.random() < 0.8 else rng.choice(short) for _ in range(200)) for _ in range(300)]
    given = spark.createDataFrame([(k, t, "zh") for k, t in enumerate(texts)], "doc_id long, text string, lang string").repartition(3)
    counts = Counter(" ".join(texts).split())
    found = quality.references(given).where("kind < 0").collect()
    assert {bytes(r.word).decode(): r.n for r in found if r.kind == -1} == {w: n for w, n in counts.items() if w in short}
    assert [r.n for r in found if r.kind == -2] == [sum(n for w, n in counts.items() if w not in short)]
    got = quality.judge(given).agg({"word_distance": "max", "kept": "count"}).collect()[0]
    assert got["max(word_distance)"] < 0.35 and got["count(kept)"] == 300
    assert quality.judge(given).where("not kept and not base_failed").count() == 0


def test_quality_tells_short_junk(spark, docs):
    """Documents of 50 to 99 words are judged too, against references of their whole table."""
    path = "/root/testdata/sf0.1"
    given = spark.read.parquet(f"{path}/documents.parquet")
    judged = quality.judge(given).where("not base_failed and n_words < 100").join(spark.read.parquet(f"{path}/labels.parquet"), "doc_id")
    counts = {(r.quality, r.kept): r["count"] for r in judged.groupBy("quality", "kept").count().collect()}
    assert counts.get((1, False), 0) <= 0.01 * counts[1, True]
    assert counts.get((0, False), 0) > 9 * counts.get((0, True), 0)


def test_quality_limit():
    got = quality.limit(0.24, np.array([0, 50, 99, 100, 101, 10_000]))
    assert (got[3:] == 0.24).all() and 0.24 < got[2] < got[1] < got[0] and math.isclose(got[1], math.sqrt(0.24**2 + 0.05))


def test_distance():
    p = np.array([[1.0, 0, 0], [1, 1, 2], [0, 0, 0]])
    got = quality.distance(p, np.array([0.0, 1, 1]))
    m = np.array([1, 3, 4]) / 8 + np.array([0, 0, 0])
    a, b = np.array([1, 1, 2]) / 4, np.array([0, 1, 1]) / 2
    m = (a + b) / 2
    want = math.sqrt(sum(x * math.log2(x / y) for x, y in zip(a, m, strict=True) if x) / 2 + sum(x * math.log2(x / y) for x, y in zip(b, m, strict=True) if x) / 2)
    assert got[0] == 1 and math.isclose(got[1], want) and got[2] == 0


def test_toxicity_held_out(spark, docs):
    path = "/root/testdata/sf0.1"
    given, labels = spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/labels.parquet")
    held = toxicity.report(given, labels).where("held_out").join(labels, "doc_id")
    counts = {(r.toxic, r.predicted): r["count"] for r in held.groupBy("toxic", "predicted").count().collect()}
    assert counts[1, 1] >= 0.75 * (counts[1, 1] + counts.get((1, 0), 0))
    assert counts.get((0, 1), 0) <= 0.02 * counts[0, 0]


def test_toxicity_uses_texts_only_and_edges(spark, docs, empty, repeated, rows):
    labels = spark.createDataFrame([(d, 1, int("moron" in (t or ""))) for d, t in rows] * 2 + [(None, 1, 1), (1, None, None)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.report(docs, labels).collect()}
    by_text = {}
    for d, t in rows:
        by_text.setdefault(t, set()).add(round(got[d].score, 12))
        assert 0 <= got[d].score <= 1 and got[d].predicted == int(got[d].score >= 0.3)
    assert all(len(s) == 1 for s in by_text.values())
    assert all(got[d].predicted == int("moron" in (t or "")) for d, t in rows)
    none = labels.where("false")
    assert {r.predicted for r in toxicity.report(docs, none).collect()} == {0, 1}
    assert toxicity.report(empty, labels).collect() == [] and toxicity.report(repeated, none).count() == repeated.count()
    assert toxicity.keep_clean(docs, labels).columns == docs.columns


def test_label_model_finds_accuracies():
    rng = np.random.default_rng(1)
    truth = rng.random(4_000) < 0.2
    votes = np.stack([np.where(truth, rng.random(4_000) < p, rng.random(4_000) < q) for p, q in ((0.7, 0.01), (0.6, 0.02), (0.5, 0.3))], 1)
    votes = np.concatenate([votes, votes[:, :1]], 1).astype(float)
    given = np.where(rng.random(4_000) > toxicity.LABEL_ACCURACY, ~truth, truth)
    posterior, fires, false_alarms, corr = toxicity.fit_label_model(votes, given)
    assert ((posterior > 0.5) == truth).mean() > (given == truth).mean()
    assert np.abs(fires[:3] - [0.7, 0.6, 0.5]).max() < 0.12 and np.abs(false_alarms[:3] - [0.01, 0.02, 0.3]).max() < 0.1
    assert corr[0, 3] > 0.99 and abs(corr[0, 1]) < 0.2


def test_quality_languages_by_whole_code(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("fil",), ("fi",), (" FI ",), (None,), ("",), ("kok",)], "lang string")
    got = [r[0] for r in df.select(quality.language_key(F.col("lang"))).collect()]
    assert got == ["fil", "fi", "fi", "und", "und", "kok"]
    assert quality.languages(df, limit=2) == ["fi", "fil"]
    assert [r[0] for r in df.select(quality.language_key(F.col("lang"), ["fi"])).collect()] == ["und", "fi", "fi", "und", "und", "und"]


def test_chat_loss_is_read_behind_the_context(spark, monkeypatch):
    talks = spark.createDataFrame([(1, 0, "user", "a <| b"), (1, 1, "assistant", "one"), (1, 2, "user", "c"), (1, 3, "assistant", "two<|")],
                                  "conv_id long, turn int, role string, text string")
    seen, kept = [], chat.loss_texts
    monkeypatch.setattr(chat, "loss_texts", lambda expanded: seen.append(expanded) or kept(expanded))
    got = chat.report(talks).first()
    assert (got.loss_chars, got.loss_sha256) == (8, hashlib.sha256(b"onetwo<|").hexdigest())
    full = {r.example: r for r in seen[0].collect()}
    assert full[3].context.count(chat.START) == 3 and (full[3].context + full[3].reply)[full[3].loss_start:full[3].loss_end] == "two<\\|"
