"""N-gram join, metric search and vector near-duplicates against brute force."""

import random
import re

import numpy as np
import pytest

from relayline.llm import metric_search, near_vectors, ngram_join
from relayline.llm.common import components
from tests_llm_data import messy

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lowest(nodes, links):
    up = {x: x for x in nodes}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {x: top(x) for x in nodes}


def grams(text, size):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()


def brute(rows, size, percent):
    sets = {i: grams(t, size) for i, t, *_ in rows if i is not None}
    ids = sorted(i for i in sets if sets[i])
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:]
             if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return {i: (len(sets[i]), c) for i, c in lowest(sets, links).items()}


def corpus(seed=3):
    r = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    passage = [r.choice(words) for _ in range(60)]
    rows = []
    for k in range(160):
        n = r.choice([1, 2, 3, 4, 5, 8, 16, 31, 33, 64, 90, 127, 130, 200])
        text = [r.choice(words) for _ in range(n)] + (passage if k % 3 == 0 else [])
        rows.append((10 * k, " ".join(text)))
        for c in range(1, r.choice([1, 1, 2, 4])):  # near copies of all degrees
            for _ in range(r.choice([0, 1, 1, 2, 4])):
                text[r.randrange(len(text))] = r.choice(words)
            rows.append((10 * k + c, " ".join(text).title() if c % 2 else " \n".join(text)))
    base = [r.choice(words) for _ in range(120)]
    for k in range(150):  # a large group of near copies
        text = list(base)
        text[r.randrange(120)] = r.choice(words)
        rows.append((5000 + k, " ".join(text)))
    return rows


def check(df, rows, size, percent):
    got = ngram_join.jaccard_components(df, size, percent).collect()
    assert len(got) == len(rows)
    want = brute(rows, size, percent)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == want


def test_join_equals_brute_force(docs):
    rows = corpus()
    check(docs(rows), rows, 4, 85)


def test_join_at_other_thresholds_and_blocks(docs, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    monkeypatch.setattr(ngram_join, "HOT", 8)
    monkeypatch.setattr(ngram_join, "BROADCAST_IDS", 5)
    rows = corpus(8)
    check(docs(rows), rows, 5, 80)


def test_join_of_messy_rows(docs):
    rows = messy()
    check(docs(rows), rows, 4, 85)
    assert ngram_join.jaccard_components(docs([]), 4, 85).collect() == []
    got = ngram_join.one_of_each(docs(rows))
    assert got.columns == docs(rows).columns
    ids = sorted(str(r.doc_id) for r in got.collect())
    assert ids == sorted(map(str, [1, 2, 3, 4, 5, None, None, 7, 8, 9]))


def test_an_id_with_two_texts_loses_only_the_duplicate(docs):
    same, other = (" ".join(f"{c}{k}" for k in range(40)) for c in "ab")
    rows = [(1, same), (2, same + " end"), (2, other), (2, other), (3, same), (3, "alone here"), (4, other + " end"), (None, same)]
    got = ngram_join.one_of_each(docs(rows)).collect()
    assert sorted((str(r.doc_id), r.text) for r in got) == sorted(
        [("1", same), ("2", other), ("3", "alone here"), ("None", same)])


def test_short_documents_end_in_one_pass(spark, docs, monkeypatch):
    """Texts whose n-grams fall in too few parts keep their links."""
    sketcher = ngram_join.Sketcher(80)
    r, rows, planted = random.Random(5), [], 0
    while planted < 3:
        w = [f"x{r.randrange(10**6)}" for _ in range(8)]
        h = ngram_join.shingles(" ".join(w), 5)
        if any(sketcher.sign(h, b)[2] for b in sketcher.bands(len(h))):
            rows += [(len(rows) + k, t) for k, t in enumerate((" ".join(w), " ".join(w + ["more"]), " ".join(["some"] + w)))]
            planted += 1
    rows += [(1000 + k, " ".join(f"y{r.randrange(10**6)}" for _ in range(8))) for k in range(200)]
    check(docs(rows), rows, 5, 80)
    want = brute(rows, 5, 80)
    assert sum(c != i for i, (_, c) in want.items()) == 6
    # texts with all parts in one place, whatever the number of n-grams
    monkeypatch.setattr(ngram_join.Sketcher, "sign", lambda self, h, band: (
        self._in_band(np.array([7], np.uint64), band), b"\0" * (1 << max(0, band)), True))
    h = ngram_join.shingles(" ".join(f"z{k}" for k in range(40)), 5)
    assert len(sketcher.sign_grams(h, 5)) == sketcher.need(h) <= len(h)


def test_near_copy_groups_write_linear_pairs(spark, docs, monkeypatch):
    """Groups of texts that differ in the last word: pairs grow with the
    group, in all rounds together."""
    r = random.Random(2)
    for size in (100, 400):
        rows = []
        for g in range(6):
            base = [f"g{g}w{r.randrange(10**6)}" for _ in range(15)]
            rows += [(g * 10_000 + k, " ".join(base + [f"end{k}"])) for k in range(size)]
        pairs = []
        real = ngram_join.materialize

        def spy(df, name):
            out = real(df, name)
            if name in ("join-forest", "join-again", "join-more", "join-last"):
                pairs.append(out.count())
            return out
        monkeypatch.setattr(ngram_join, "materialize", spy)
        got = ngram_join.jaccard_components(docs(rows), 4, 85).collect()
        monkeypatch.setattr(ngram_join, "materialize", real)
        assert {x.doc_id: x.component_id for x in got} == {i: i // 10_000 * 10_000 for i, _ in rows}
        assert sum(pairs) < 8 * len(rows)


def test_chains_of_near_copies(docs, monkeypatch):
    """Prefixes of one text with a changing end, over several blocks."""
    monkeypatch.setattr(ngram_join, "BLOCK", 32)
    r = random.Random(8)
    base = [f"b{k}" for k in range(30)]
    rows = [(k, " ".join([*base[:r.randrange(18, 30)], *(f"t{r.randrange(4)}" for _ in range(6))])) for k in range(120)]
    check(docs(rows), rows, 4, 85)
    check(docs(rows), rows, 4, 60)


def test_deal_and_meeting_find_what_is_shared(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(ngram_join, "WINDOW", 40)
    r = random.Random(6)
    rows = [(k, [r.randrange(60) for _ in range(r.randrange(6))] + ([7] if k % 2 else [])) for k in range(100)]
    rows += rows[:10]
    batches = [pa.RecordBatch.from_pylist([{"key": k, "sig": s} for k, sigs in rows[i:i + 9] for s in sigs],
                                          schema=pa.schema([("key", pa.int64()), ("sig", pa.int64())]))
               for i in range(0, len(rows), 9)]
    dealt = pa.Table.from_batches(ngram_join._deal(iter(batches)))
    assert sum(1 for x in dealt.to_pylist() if x["sig"] == 7 and not x["done"]) <= 12  # once a window
    done = {(x["sig"], x["key"]) for x in dealt.to_pylist() if x["done"]}
    meet = dealt.filter(pa.compute.invert(dealt["done"])).sort_by("sig").to_batches(max_chunksize=5)
    met = {(x["sig"], x["key"]) for b in ngram_join._met(iter(meet)) for x in b.to_pylist()}
    holders = {}
    for k, s in rows:
        for g in s:
            holders.setdefault(g, set()).add(k)
    assert done | met == {(g, k) for g, h in holders.items() if len(h) > 1 for k in h}


def test_sketch_bound_holds():
    r = np.random.default_rng(2)
    sketcher = ngram_join.Sketcher(85)
    for n in (1, 5, 40, 300, 3000):
        a = np.unique(r.integers(0, 1 << 63, n).astype(np.uint64))
        b = np.union1d(a[: n - n // 10], r.integers(0, 1 << 63, n // 10).astype(np.uint64))
        band = sketcher.bands(max(len(a), len(b)))[0]
        x, y = (np.frombuffer(sketcher.sign(h, band)[1], np.uint8) for h in (a, b))
        assert np.bitwise_count(x ^ y).sum() <= len(np.setxor1d(a, b))
        assert not sketcher.sign(a, band)[2]


def test_components_of_paths_and_stars(spark):
    edges = [(k, k + 1) for k in range(100, 160)] + [(7, k) for k in range(20, 60)] + [(1, 1), (5, 2), (2, 9), (9, 5)]
    want = lowest({x for e in edges for x in e}, edges)
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: v for k, v in want.items() if k != 1}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, "x", "y") for i, v in rows],
                                 "vec_id long, embedding array<float>, id long, key long, vec string, size string")


NO_PART = [(9000, None), (9001, []), (9002, [0.0] * 16), (9003, [float("nan")] + [1.0] * 15), (9004, [None] + [1.0] * 15),
           (9005, [float("inf")] + [1.0] * 15), (9006, [1.0] * 3), (9007, [1.0, 1.0, 1.01])]


def near_rows():
    r = np.random.default_rng(5)
    rows = []
    for k in range(120):
        base = r.standard_normal(16)
        for c in range(1 + k % 4):
            rows.append((10 * k + c, (base + 0.07 * c * r.standard_normal(16)).astype(np.float32).tolist()))
    hot = r.standard_normal(16)
    rows += [(2000 + k, (hot + 0.15 * r.standard_normal(16)).astype(np.float32).tolist()) for k in range(80)]
    rows += [(3000 + k, rows[0][1]) for k in range(30)] + [rows[5]]  # copies, and a repeated row
    return rows


def test_near_vectors_equal_brute_force(spark, monkeypatch):
    rows = near_rows() + NO_PART
    part = [(i, np.array(v, np.float32).astype(np.float64)) for i, v in rows if i < 9000 or i in (9006, 9007)]
    count, links = dict.fromkeys([i for i, _ in rows], 0), []
    for k, (a, x) in enumerate(part):
        for m, (b, y) in enumerate(part):
            if k != m and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.95:
                count[a] += 1
                links.append((a, b))
    repeated = rows[5][0]
    want = lowest(count, links)
    for block in (512, 16):
        monkeypatch.setattr(near_vectors, "BLOCK", block)
        got = near_vectors.near_vectors(vectors(spark, rows)).collect()
        assert len(got) == len(rows)
        found, every = sum(r.n_links for r in got if r.vec_id != repeated), sum(v for k, v in count.items() if k != repeated)
        assert 0.98 * every <= found <= every
        for r in got:
            assert r.kept == (r.component_id == r.vec_id)
            if r.vec_id != repeated:
                assert r.n_links <= count[r.vec_id]
            if r.vec_id >= 3000:
                assert (r.n_links, r.component_id) == (count[r.vec_id], want[r.vec_id])
    assert near_vectors.near_vectors(vectors(spark, [])).collect() == []


def shifted(d=64, n=1500, seed=8, mean=2.6):
    """Unit vectors with a common mean (2.6: their cosine is about 0.87), and
    partners at cosines 0.95 to 0.97."""
    r = np.random.default_rng(seed)
    x = r.standard_normal((n, d)) + mean * np.sqrt(d) * np.eye(d)[0]
    x /= np.linalg.norm(x, axis=1)[:, None]
    y = r.standard_normal((n, d))
    y -= (y * x).sum(axis=1)[:, None] * x
    cosine = r.uniform(0.95001, 0.97, (n, 1))
    return x, cosine * x + np.sqrt(1 - cosine ** 2) * y / np.linalg.norm(y, axis=1)[:, None]


@pytest.mark.parametrize("mean, cosine", [(0.0, 0.0), (1.83, 0.77), (2.6, 0.87), (6.0, 0.97)])
def test_tables_find_pairs_with_a_common_mean(mean, cosine):
    x, y = shifted(n=4000, mean=mean)
    assert abs((x[:2000] @ x[2000:].T).mean() - cosine) < 0.01
    for n in (10_000, 1_000_000, 100_000_000):
        coder = near_vectors.Coder(n, {64: np.vstack([x[:2000], y[2000:]])})
        plan = coder.plans[64]
        assert plan.bits >= 1 and plan.bits * plan.tables <= near_vectors.BITS
        found = (coder.keys(x) == coder.keys(y)).any(axis=1)
        told = (coder.bits(x) != coder.bits(y))[:, :plan.near].sum(axis=1) <= plan.apart
        assert (found & told).mean() >= 0.99


def test_components_are_kept_exactly():
    r = np.random.default_rng(2)
    for v in (r.standard_normal(9).astype(np.float32).tolist(), r.standard_normal(9).tolist(), [1e300, -1e-300, 0.0], [3e38, 1.0]):
        data = near_vectors.raw(v)
        kind = np.float32 if data[:1] == b"f" else np.float64
        assert np.frombuffer(data, kind, offset=1).astype(float).tolist() == v
        assert near_vectors.unit(data).tobytes() == near_vectors.normal(v)
    assert len(near_vectors.raw(np.ones(64))) == 257


def test_near_vectors_with_a_common_mean(spark):
    x, y = shifted()
    both = np.vstack([x, y]).astype(np.float32)
    unit = both.astype(np.float64)
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    want = (unit @ unit.T >= 0.95).sum(axis=1) - 1
    got = near_vectors.near_vectors(vectors(spark, [(i, v.tolist()) for i, v in enumerate(both)])).collect()
    assert all(r.n_links <= want[r.vec_id] for r in got)
    assert sum(r.n_links for r in got) >= 0.99 * want.sum() > 0


def test_top_k_equals_brute_force(spark, monkeypatch):
    r = np.random.default_rng(6)
    rows = [(k, r.standard_normal(16).round(1).tolist()) for k in range(700)]
    rows += [(1000 + k, rows[0][1]) for k in range(200)] + NO_PART + [(None, [1.0] * 16)]  # many ties
    valid = [(i, np.floor(np.array(v, np.float32).astype(np.float64) * 256).astype(int)) for i, v in rows
             if i is not None and i not in (9000, 9001, 9003, 9004, 9005)]
    want = set()
    for i, x in valid:
        if i % 50 == 0:
            best = sorted((-int(x @ y), j) for j, y in valid if j != i and len(x) == len(y))[:5]
            want |= {(i, k + 1, j, -s) for k, (s, j) in enumerate(best)}
    from pyspark.sql import functions as F
    for shard, group in ((1 << 20, 16384), (2048, 5)):
        monkeypatch.setattr(metric_search, "SHARD_VALUES", shard)
        monkeypatch.setattr(metric_search, "GROUP_QUERIES", group)
        got = metric_search.top_k(vectors(spark, rows), F.col("vec_id") % 50 == 0).collect()
        assert {(x.query_id, x.rank, x.vec_id, x.score) for x in got} == want and len(got) == len(want)
    assert metric_search.top_k(vectors(spark, []), F.lit(True)).collect() == []


def test_repeated_query_rows_take_no_place():
    r = np.random.default_rng(9)
    rows = r.integers(-50, 50, (200, 8))
    rows[20:60] = rows[17] = 60               # the highest scores are the query's own
    ids = np.arange(200)
    ids[20:60] = 17
    got = metric_search.MTree(ids, rows).search(rows[17], 17, 5)
    scores = rows @ rows[17]
    assert got == [(-s, i) for s, i in sorted((-int(s), int(i)) for s, i in zip(scores, ids) if i != 17)[:5]]


def test_top_k_of_unscaled_vectors(spark):
    from pyspark.sql import functions as F
    r = np.random.default_rng(10)
    rows = [(k, (r.standard_normal(4) * 10.0 ** (k % 8)).astype(np.float32).tolist()) for k in range(600)]
    whole = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows]
    want = set()
    for i, x in whole[:600:50]:
        best = sorted((-sum(a * b for a, b in zip(x, y)), j) for j, y in whole if j != i)[:5]
        want |= {(i, k + 1, j, -s) for k, (s, j) in enumerate(best) if abs(s) < 1 << 63}
    asks = [i for i, _ in rows[:600:50] if len([1 for q in want if q[0] == i]) == 5]
    assert any(abs(a) >= 1 << 31 for _, v in whole for a in v) and len(asks) > 2
    got = metric_search.top_k(vectors(spark, rows), F.col("vec_id").isin(asks)).collect()
    assert {(x.query_id, x.rank, x.vec_id, x.score) for x in got} == {q for q in want if q[0] in asks}


def test_scores_beyond_a_long_are_python_integers():
    rows = np.array([[1 << 61, 5], [1 << 61, 7], [-(1 << 61), 0], [3, 1]])
    got = metric_search.MTree(np.arange(4), rows).search(rows[0], 0, 3)
    assert got == [((1 << 122) + 35, 1), (3 * (1 << 61) + 5, 3), (-(1 << 122), 2)]


def test_tree_prunes_on_clustered_rows():
    r = np.random.default_rng(7)
    centres = r.integers(-4000, 4000, (40, 8))
    rows = np.repeat(centres, 500, axis=0) + r.integers(-20, 20, (20_000, 8))
    tree = metric_search.MTree(np.arange(20_000), rows)
    taken = []

    class Seen(np.ndarray):
        def __getitem__(self, key):
            taken.append(len(np.arange(20_000)[key]))
            return np.asarray(super().__getitem__(key))
    tree.ids = tree.ids.view(Seen)
    got = tree.search(rows[17], 17, 5)
    scores = rows @ rows[17]
    want = sorted(((-int(s), i) for i, s in enumerate(scores) if i != 17))[:5]
    assert got == [(-s, i) for s, i in want]
    assert sum(x for x in taken if x) < 10_000
