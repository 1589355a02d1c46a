"""Quality resampling and the toxicity network: held-out accuracy, gradients,
and defined results on messy rows."""

import math
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from relayline.llm import common, importance, toxicity
from tests_llm_data import messy

LABELS = "doc_id long, quality int, toxic int, text string, score double"
SYLLABLES = ["an", "er", "th", "in", "ou", "re", "ti", "ea", "ing", "or", "sh", "ble"]


def word(r):
    return "".join(r.choice(SYLLABLES) for _ in range(r.randrange(1, 4)))


def made(n=700, seed=1):
    """(id, text), and quality and toxic by id."""
    r, rows, quality, toxic = random.Random(seed), [], {}, {}
    for i in range(n):
        words = [word(r) for _ in range(r.choice([4, 20, 60, 200]))]
        quality[i], toxic[i] = int(r.random() < 0.8), int(r.random() < 0.3)
        if toxic[i]:
            for _ in range(1 + len(words) // 40):
                words.insert(r.randrange(len(words)), r.choice(["zorgle", "vekk" + word(r), "Zorgle!"]))
        if not quality[i]:
            words = [w + r.choice(["###", "$$$"]) for w in words] if i % 2 else [w for w in words for _ in range(8)]
        rows.append((i, " ".join(words)))
    return rows, quality, toxic


def labels(spark, rows):
    return spark.createDataFrame([(*r, "t", 0.5) for r in rows], LABELS)


def test_resampling_keeps_good_documents(spark, docs):
    rows, quality, _ = made()
    known = labels(spark, [(i, quality[i], 0) for i in range(0, 400)])
    got = importance.resample(docs(rows), known).collect()
    assert len(got) == len(rows)
    kept = {r.doc_id: r.kept for r in got}
    assert sum(kept[i] != bool(quality[i]) for i in range(400, 700)) <= 6
    again = {r.doc_id: r.kept for r in importance.resample(docs(rows).repartition(7), known).collect()}
    assert again == kept
    left = importance.keep(docs(rows), known)
    assert left.columns == docs(rows).columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(i for i in kept if kept[i])


def test_resampling_of_messy_rows(spark, docs):
    none = labels(spark, [])
    rows = messy()
    got = importance.resample(docs(rows), none).collect()
    assert len(got) == len(rows) and all(r.kept and r.log_weight == 0 for r in got)
    assert importance.resample(docs([]), none).collect() == []
    odd = labels(spark, [(5, 1, None), (5, 0, None), (None, 1, 1), (8, None, 0), (4, 0, 1), (7, 1, 0)])
    assert len(importance.resample(docs(rows), odd).collect()) == len(rows)


def test_weights_are_the_ratio_of_the_models():
    grams = importance.Grams()
    assert len(grams("a b b")) == 3 + 2 + 1  # words, pairs, one repeat
    assert len(grams("")) == len(grams(None)) == 0


def plain_grams(text):
    """Counts of hashed grams, one at a time."""
    found, before = Counter(), None
    for w in re.findall(r"\w+|[^\w\s]+", text or ""):
        h = zlib.crc32(w.encode("utf-8", "replace"))
        found[h % importance.BUCKETS] += 1
        if before is not None:
            found[(before * 31 + h) % importance.BUCKETS] += 1
            found[zlib.crc32(b"<repeat>") % importance.BUCKETS] += h == before
        before = h
    return found


def plain_resample(rows, known, noise):
    """(n_grams, log weight, kept) per row, with dictionaries and a full sort."""
    good = {}
    for i, q, _ in known:
        if i is not None and q in (0, 1):
            good.setdefault(i, set()).add(q)
    good = {i: q.pop() for i, q in good.items() if len(q) == 1}
    grams = [plain_grams(t) for _, t in rows]
    every, target = Counter(), Counter()
    for (i, _), g in zip(rows, grams):
        every.update(g)
        if good.get(i) == 1:
            target.update(g)
    n = [sum(c.values()) + importance.BUCKETS for c in (every, target)]

    def ratio(b):
        return math.log((target[b] + 1) / n[1]) - math.log((every[b] + 1) / n[0])
    weights = [math.fsum(c * ratio(b) for b, c in g.items()) if target else 0.0 for g in grams]
    scored = {}
    for (i, _), w in zip(rows, weights):
        if i in good:
            scored.setdefault(i, []).append(w)
    marks = sorted((sum(w) / len(w), good[i]) for i, w in scored.items())
    border, cost = -math.inf, None
    if len({m for _, m in marks}) == 2:
        places = []
        for at in range(len(marks) + 1):  # what is below the cut goes
            lost = sum(m for _, m in marks[:at]) * importance.LOST + sum(1 - m for _, m in marks[at:])
            gap = marks[at][0] - marks[at - 1][0] if 0 < at < len(marks) else 0.0
            places.append((lost, -gap, at))
        cost, _, at = min(places)
        border = -math.inf if at == 0 else marks[-1][0] + 1 if at == len(marks) else (marks[at - 1][0] + marks[at][0]) / 2
    k = sum(w >= border for w in weights)
    noisy = [w / importance.TEMPERATURE + noise[i] for (i, _), w in zip(rows, weights)]
    least = sorted(noisy, reverse=True)[k - 1] if k else math.inf
    return [(sum(g.values()), w, x >= least - 1e-6) for g, w, x in zip(grams, weights, noisy)]


@pytest.mark.parametrize("labelled", [400, 0])
def test_resampling_equals_plain_counting(spark, docs, labelled):
    """Weights, the number taken and the kept rows of a whole table."""
    rows, quality, _ = made(500, 9)
    rows = rows + [rows[3], (900, None), (901, ""), (902, "é日本 \U0001f642 ß"), (903, "x " * 30_000)]
    known = [(i, quality[i], 0) for i in range(labelled)] + [(450, 1, 0), (450, 0, 0), (None, 1, 0), (451, None, 0)][:labelled]
    ids = spark.createDataFrame([(i,) for i in {i for i, _ in rows}], "i long")
    noise = {r.i: r.g for r in ids.select("i", importance.gumbel(F.col("i"), 11).alias("g")).collect()}
    want = sorted((i, *w) for (i, _), w in zip(rows, plain_resample(rows, known, noise)))
    got = sorted((r.doc_id, r.n_grams, r.log_weight, r.kept) for r in importance.resample(docs(rows), labels(spark, known)).collect())
    assert [(a[0], a[1], a[3]) for a in got] == [(b[0], b[1], b[3]) for b in want]
    assert [a[2] for a in got] == pytest.approx([b[2] for b in want], abs=1e-6)
    assert labelled == 0 or 0 < sum(not a[3] for a in got) < len(got)


def test_keep_of_messy_rows_and_empty_tables(spark, docs):
    rows = messy()
    left = importance.keep(docs(rows), labels(spark, []))
    assert left.columns == docs(rows).columns
    key = lambda x: (x[0] is None, x[0] or 0, x[1] or "")
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=key) == sorted(((r[0], r[1]) for r in rows), key=key)
    assert importance.keep(docs([]), labels(spark, [(1, 1, 0), (2, 0, 0)])).collect() == []


def test_cut_and_kth_largest(spark):
    assert importance.cut([(-5, 0), (-4, 0), (1, 1), (2, 1)]) == -1.5
    assert importance.cut([(1, 1)]) == importance.cut([]) == -np.inf
    r = random.Random(3)
    values = [r.choice([r.random() * 10 ** r.randrange(-8, 9), 5.0, -7.25]) for _ in range(3000)]
    df = spark.createDataFrame([(x,) for x in values], "x double")
    for k in (1, 2, 700, 2999, 3000):
        assert importance.kth_largest(df, "x", k) == sorted(values, reverse=True)[k - 1]


def test_gumbel_top_k_follows_the_weights(spark):
    """With two kinds of documents the first of the sample is of a kind in
    proportion to its weight."""
    df = spark.range(40_000).withColumn("w", F.when(F.col("id") % 4 == 0, 3.0).otherwise(1.0))
    df = df.withColumn("g", F.log("w") + importance.gumbel(F.col("id"), 5))
    top = df.orderBy(F.desc("g")).limit(4000).where("w = 3").count()
    assert 0.46 < top / 4000 < 0.54  # a quarter of the rows, half of the weight


def test_network_learns_held_out_texts(spark, docs):
    rows, _, toxic = made(900, 4)
    known = labels(spark, [(i, 1, toxic[i]) for i in toxic])
    got = toxicity.score_documents(docs(rows), known).collect()
    assert len(got) == len(rows)
    held = [r for r in got if r.held_out]
    assert 150 < len(held) < 300
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert sum(r.predicted != toxic[r.doc_id] for r in held) <= 0.05 * len(held)


def test_held_out_labels_teach_nothing(spark, docs):
    rows, _, toxic = made(200, 5)
    import zlib
    out = {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in toxic}
    one = labels(spark, [(i, 1, toxic[i]) for i in toxic])
    two = labels(spark, [(i, 1, 1 - toxic[i] if out[i] else toxic[i]) for i in toxic])
    a, b = (toxicity.score_documents(docs(rows), x).collect() for x in (one, two))
    assert {r.doc_id: r.score for r in a} == {r.doc_id: r.score for r in b}
    assert {r.doc_id: r.held_out for r in a} == out


def test_scores_of_messy_rows(spark, docs):
    rows = messy()
    for known in ([], [(5, 1, 1), (5, 1, 0), (None, 1, 1), (8, 1, None), (7, 0, 0)]):
        got = toxicity.score_documents(docs(rows), labels(spark, known)).collect()
        assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert toxicity.score_documents(docs([]), labels(spark, [])).collect() == []


@pytest.mark.parametrize("n", [0, 1, 47, 48, 49, 84, 85, 1000])
def test_windows_cover_and_overlap(n):
    found = toxicity.windows(n)
    assert found[0][0] == 0 and found[-1][1] == n
    assert all(a[1] > b[0] > a[0] for a, b in zip(found, found[1:]))
    assert n < toxicity.WINDOW or all(e - s == toxicity.WINDOW for s, e in found)


def test_gradients_equal_differences():
    r = np.random.default_rng(1)
    model = toxicity.Model()
    model.p = {k: v.astype(np.float64) + 0.3 * r.standard_normal(v.shape) for k, v in model.p.items()}
    gates = r.standard_normal((6, 6 * toxicity.HIDDEN))
    ids, length = r.integers(0, 6, (3, 5)), np.array([5, 3, 1])
    push = r.standard_normal(3)

    def loss():
        return float(push @ model.run(gates, ids, length))
    _, share, value, kept = model.run(gates, ids, length, keep=True)
    g, dg = model.back(push, ids, length, share, value, kept, 6)
    for name in ("U", "a", "o", "c"):
        flat, at = model.p[name].reshape(-1), r.integers(0, model.p[name].size)
        old = flat[at]
        flat[at] = old + 1e-3
        up = loss()
        flat[at] = old - 1e-3
        down = loss()
        flat[at] = old
        assert g[name].reshape(-1)[at] == pytest.approx((up - down) / 2e-3, rel=0.05, abs=2e-3)
    gates[2, 7] += 1e-3
    up = loss()
    gates[2, 7] -= 2e-3
    assert dg[2, 7] == pytest.approx((up - loss()) / 2e-3, rel=0.05, abs=2e-3)


def plain_score(model, words):
    """A text's score, window by window and step by step."""
    def sigmoid(v):
        return 1 / (1 + np.exp(-v))
    p, H = {k: v.astype(np.float64) for k, v in model.p.items()}, toxicity.HIDDEN
    x = model.inputs(words).astype(np.float64)
    best = -np.inf
    for start, end in toxicity.windows(len(words)):
        heat, value = np.zeros(end - start), np.zeros(end - start)
        for d in (0, 1):
            h = np.zeros(H)
            for t in range(end - start) if d == 0 else reversed(range(end - start)):
                g, u = x[start + t] @ p["W"][d] + p["b"][d], h @ p["U"][d]
                z, r = sigmoid(g[:H] + u[:H]), sigmoid(g[H:2 * H] + u[H:2 * H])
                new = np.tanh(g[2 * H:] + r * u[2 * H:])
                h = (1 - z) * new + z * h
                heat[t] += h @ p["a"][d]
                value[t] += h @ p["o"][d]
        share = np.exp(heat - heat.max()) if len(heat) else heat
        best = max(best, (share / max(share.sum(), 1e-30) * value).sum() + p["c"][0])
    return sigmoid(best)


def test_scores_equal_a_plain_loop():
    """Long texts, texts of every length below a window, and none."""
    r = np.random.default_rng(3)
    model = toxicity.Model()
    model.p = {k: (v + 0.3 * r.standard_normal(v.shape)).astype(np.float32) for k, v in model.p.items()}
    words = [f"w{k}" for k in range(300)]
    texts = [" ".join(r.choice(words, n)) for n in [*range(0, 52), 84, 85, 400]] + [None, ""]
    got = toxicity.Scorer(model.p).scores(texts)
    want = [plain_score(model, toxicity.split(t)) for t in texts]
    assert got == pytest.approx(want, abs=2e-5)
    assert toxicity.Scorer(model.p).scores([""]) == pytest.approx([want[0]])


def test_the_recurrent_part_learns_order():
    """Both classes have the same words; only their order tells them apart."""
    r = np.random.default_rng(4)
    texts, marks = [], []
    for k in range(400):
        fill = [f"f{x}" for x in r.integers(0, 30, 8)]
        at, pair = int(r.integers(0, 7)), ["alpha", "beta"] if k % 2 else ["beta", "alpha"]
        texts.append(fill[:at] + pair + fill[at:])
        marks.append(k % 2)
    model = toxicity.train(texts[:300], marks[:300], [1.0] * 300, epochs=60)
    got = np.array(toxicity.Scorer(model.p).scores([" ".join(t) for t in texts[300:]]))
    assert np.mean((got >= 0.5) == (np.array(marks[300:]) == 1)) > 0.9


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def test_batches_to_workers_follow_bytes_not_rows(spark, docs):
    """Long texts reach Python in batches of about 2 MB, not 10,000 rows."""
    rows, quality, _ = made(60, 4)
    long = docs([(i, f"{i} " + "longer " * 4000) for i in range(600)], extra=False).coalesce(1)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes]), pa.array([batch.num_rows])], names=["bytes", "rows"])

    try:
        spark.conf.unset(BATCH_BYTES)
        kept = importance.keep(docs(rows), labels(spark, [(i, quality[i], 0) for i in range(60)]))
        found = long.mapInArrow(sizes, "bytes long, rows long").collect()
        assert sum(r.rows for r in found) == 600 and max(r.bytes for r in found) < 3 << 20
        assert 0 < kept.count() <= 60
        spark.conf.set(BATCH_BYTES, "512k")  # a smaller bound of the user's stays
        importance.keep(docs(rows), labels(spark, []))
        assert spark.conf.get(BATCH_BYTES).rstrip("b") in ("512k", str(512 << 10))
    finally:
        spark.conf.unset(BATCH_BYTES)


def test_words_kept_by_a_task_are_few():
    text = " ".join(f"word{i}" for i in range(200_000))
    plain = importance.Grams()(text)
    tracemalloc.start()
    try:
        grams = importance.Grams()
        for at in range(0, 200_000, 1000):
            grams(" ".join(f"word{i}" for i in range(at, at + 1000)))
        assert tracemalloc.get_traced_memory()[0] < 16 << 20
    finally:
        tracemalloc.stop()
    assert (grams(text) == plain).all()


def test_a_key_in_many_batches_is_joined_once(monkeypatch):
    r = random.Random(5)
    keys = sorted(r.choice(["a", "b", "c", "dd", "e"]) for _ in range(3000))
    rows = pa.table({"key": keys, "x": list(range(3000))})
    batches = [b for b in rows.to_batches(max_chunksize=7)] + rows.slice(0, 0).to_batches()
    joined, concat = [], pa.concat_tables

    def counted(tables, *args, **kwargs):
        joined.append(sum(t.num_rows for t in tables))
        return concat(tables, *args, **kwargs)

    monkeypatch.setattr(common.pa, "concat_tables", counted)
    got = [(t["key"].to_pylist(), t["x"].to_pylist(), t["x"].num_chunks) for t in common.by_group(iter(batches), "key")]
    assert [(set(k), len(x), n) for k, x, n in got] == [({k}, keys.count(k), 1) for k in sorted(set(keys))]
    assert [v for _, x, _ in got for v in x] == list(range(3000))
    assert sum(joined) <= 3000  # a row is copied once at most
