"""Collocations, source divergence and phrase-name fingerprints against plain
Python."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from relayline.llm import collocations, divergence, phrase_names
from tests_llm_data import messy

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
CUT = re.compile("[.,;:!?\x0a-\x0d]")


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def clashing(df):
    from pyspark.sql import functions as F
    return df.withColumns({c: F.lit("x") for c in ("term", "n", "f", "w1", "grp", "part", "guest", "h", "size", "p", "rank")})


def prose(seed=1, docs=150, langs=("en", None, "de"), sources=("a", "b", None, "c")):
    """A hot source, a very common word and passages that documents share."""
    r = random.Random(seed)
    words = ["the"] * 30 + [f"w{k}" for k in range(60)] + ["Ärger", "Été", "\x00nul", "a\x1cb", "x'y"]
    passage = "new york city hall, of the united states of the union."
    rows = []
    for k in range(docs):
        text = "".join(r.choice(words) + r.choice([" ", "  ", "\t", " ", ", ", ". ", "\n", "!"]) for _ in range(r.randrange(80)))
        text = r.choice([text, text + passage, passage * 3 + text.upper()])
        rows.append((k, text, r.choice(langs), "a" if k % 3 == 0 else r.choice(sources)))
    rows += [(900, "the " * 4000, "en", "long"), (901, None, "en", None), (902, "", "fr", "quiet"), (903, "12 34", "fr", "other"),
             (904, "x" * 50_000, "xx", ""), (904, "x" * 50_000, "xx", "")]
    return rows


# ---------------------------------------------------------------- collocations

def plain_collocations(rows, least, inside, first):
    counts, n = defaultdict(Counter), Counter()
    for _, text, lang, _ in rows:
        lang = "und" if lang is None else lang
        for piece in CUT.split((text or "").translate(LOW)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                counts[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        found = []
        for p, a in f.items():
            if len(p) < 2 or a < least:
                continue
            if any(100 * b >= inside * a for q, b in f.items()
                   if b >= least and len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q)))):
                continue
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:first], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


@pytest.mark.parametrize("budget", [1 << 20, 700, 40])
def test_collocations_equal_plain_counts(spark, monkeypatch, budget):
    """At any memory budget: with no extended prefix, with some words, and
    with pairs of words extended too."""
    monkeypatch.setattr(collocations, "BUDGET", budget)
    monkeypatch.setattr(collocations, "FLUSH", 500)
    rows = prose()
    want = plain_collocations(rows, 5, 50, 40)
    got = collocations.collocations(clashing(table(spark, rows)), least=5, inside=50, first=40).collect()
    assert sorted(map(tuple, got)) == want and len(want) > 60


def test_collocations_of_nothing(spark):
    assert collocations.collocations(table(spark, []), least=1).collect() == []
    rows = [(1, None, None, None), (2, " ,.", "en", "a"), (3, "one", "en", "a"), (3, "one two", "en", "a")]
    got = collocations.collocations(table(spark, rows), least=1).collect()
    assert list(map(tuple, got)) == [("en", 1, "one two", 1, 2, 1, 3, 500_000)]


def test_long_pieces_are_coded_in_parts(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(collocations, "FLUSH", 7)
    r = random.Random(5)
    texts = [" ".join(r.choice("abcd") for _ in range(n)) + "." for n in (30, 1, 7, 8, 9, 2, 100)]
    batch = pa.record_batch({"lang": ["en"] * len(texts), "text": [t.encode() for t in texts]})
    for size in (2, 3):
        got = Counter()
        for _, words, ids in collocations._coded(iter([batch])):
            found, n = collocations._phrases(ids, np.ones(len(words), bool), size)
            for *p, k in zip(*found, n):
                got[tuple(words[x].decode() for x in p if x >= 0)] += k
        want = Counter()
        for t in texts:
            w = t[:-1].split()
            want.update(tuple(w[i:i + size]) for i in range(len(w) - 1))
        assert got == want


def test_groups_hold_the_budget():
    totals = np.array([3, 4, 2, 0, 25, 1, 9, 10])
    first, parts = collocations.packed(totals, 10)
    load = Counter()
    for t, f, p in zip(totals, first, parts):
        for k in range(p):
            load[f + k] += t / p
    assert max(load.values()) <= 10 and parts.tolist() == [1, 1, 1, 1, 3, 1, 1, 1]


def test_scores_beyond_64_bits(spark):
    df = spark.createDataFrame([(20_000_000_000_001, 20_000_000_000_007, 29_999_999_999_999), (7, 7, 7)],
                               "a long, l long, r long")
    got = [r[0] for r in df.select(collocations._score("a", "l", "r")).collect()]
    assert got == [10**6 * a * a // (l * r) for a, l, r in ((20_000_000_000_001, 20_000_000_000_007, 29_999_999_999_999), (7, 7, 7))]


# ------------------------------------------------------------------ divergence

def plain_divergence(rows, least, first):
    n, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        found = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(LOW))
        n[lang, source].update(found)
        docs[lang].update(set(found))
    out = []
    for lang in {g for g, _ in groups}:
        kept = [t for t, d in docs[lang].items() if d >= least]
        sources = [s for g, s in groups if g == lang]
        total = {s: sum(n[lang, s][t] for t in kept) for s in sources}
        p = {s: {t: 1 + 10**9 * (n[lang, s][t] + 1) // (total[s] + len(kept)) for t in kept} for s in sources}
        whole = {t: sum(n[lang, s][t] for s in sources) for t in kept}
        q = {t: 1 + 10**9 * (whole[t] + 1) // (sum(whole.values()) + len(kept)) for t in kept}
        for s in sources:
            pairs = [(-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o.encode()) for o in sources if o != s]
            single = [(-((p[s][t] - q[t]) ** 2 // q[t]), t.encode()) for t in kept if n[lang, s][t] and p[s][t] > q[t]]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(single)[:first])):
                out += [(lang, s, part, i.decode(), -v, k) for k, (v, i) in enumerate(items, 1)]
    return sorted(out)


@pytest.mark.parametrize("blocks", [False, True])
def test_divergence_equals_plain_sums(spark, monkeypatch, blocks):
    sources = ("a", "b", None, "c")
    if blocks:  # several blocks of sources, cells, flushes, pieces and chunks
        sources = [f"s{k}" for k in range(25)]
        for name, value in (("SOURCES", 4), ("ROWS", 50), ("FLUSH", 100), ("PIECE", 64), ("PAIRS", 30)):
            monkeypatch.setattr(divergence, name, value)
    rows = prose(4, 200, sources=sources)
    got = divergence.divergence(clashing(table(spark, rows)), least=3, first=15).collect()
    assert sorted(map(tuple, got)) == plain_divergence(rows, 3, 15)


def test_terms_of_pieces(monkeypatch):
    monkeypatch.setattr(divergence, "PIECE", 5)
    assert [t for p in divergence.terms("Ab, cdÉfgh 1x\nyz Ab".encode()) for t in p] == [
        b"ab", "cdÉfgh".encode(), b"x", b"yz", b"ab"]
    assert list(divergence.terms(None)) == []


def test_divergence_without_kept_terms(spark):
    assert divergence.divergence(table(spark, [])).collect() == []
    rows = [(1, "one two", "en", "a"), (2, None, "en", "b"), (2, "one", "en", None), (3, "x", None, None)]
    got = sorted(map(tuple, divergence.divergence(table(spark, rows)).collect()))
    assert got == plain_divergence(rows, 3, 200) and {r[4] for r in got} == {0} and len(got) == 6


# ----------------------------------------------------------------- fingerprints

M = (1 << 64) - 1


def mix(x):
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & M
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & M
    return x ^ (x >> 31)


def toss(own, left, most):
    d = own ^ left
    k = (d & -d).bit_length() - 1 if d else most
    return 2 * k + (own >> k & 1)


def plain_names(text):
    """(level, name, start, end) of all phrases, symbol by symbol."""
    odd, factors = 0x9E3779B97F4A7C15, [mix(k) | 1 for k in range(1, 17)]
    out, seq = [], [(ord(c), i, i + 1) for i, c in enumerate(text)]
    for level in range(1, 6):
        i, joined = 0, []
        while i < len(seq):
            j = i
            while j < len(seq) and seq[j][0] == seq[i][0]:
                j += 1
            name = seq[i][0] if j == i + 1 else mix((seq[i][0] * odd + (j - i)) & M)
            joined.append((name, seq[i][1], seq[j - 1][2]))
            i = j
        if len(joined) < 2:
            if level == 1 and joined:
                out.append((1, mix(joined[0][0]), 0, len(text)))
            return out
        c = [s & 0xFFFFFFFF for s, _, _ in joined]
        for most in (31, 0, 0, 0):
            c = [toss(x, c[k - 1] if k else x ^ 1, most) for k, x in enumerate(c)]
        cuts = [k for k in range(len(c)) if k == 0 or (
            k > 1 and c[k] > c[k - 1] and (k == len(c) - 1 or c[k] > c[k + 1]))]
        seq = []
        for a, b in zip(cuts, cuts[1:] + [len(c)]):
            total = 0
            for k in range(a, b):
                x = ((joined[k][0] + odd) * factors[(k - a) % 16]) & M
                total = (total + ((x ^ (x >> 32)) * odd)) & M
            seq.append((mix((total + level) & M), joined[a][1], joined[b - 1][2]))
        out += [(level, *s) for s in seq]
    return out


def plain_fingerprint(text):
    ranks = {int(np.float32((mix(name) >> 11) // ((end - at) * (0, 1, 2, 4, 4, 4)[level]) + 1).view(np.uint32))
             for level, name, at, end in plain_names(text)}
    return "".join(f"{r:08x}" for r in sorted(ranks)[:64])


def some_texts():
    r = random.Random(9)
    words = ["".join(r.choice("abcdefgéß漢") for _ in range(r.randrange(1, 9))) for _ in range(400)]
    texts = [" ".join(r.choice(words) for _ in range(r.choice([1, 2, 5, 40, 300]))) for _ in range(60)]
    return texts + ["", "a", "aaaa", "ab", "abab" * 200, " " * 3000, "a\U0001F600" * 5, "\x00", texts[0], texts[0]]


def test_fingerprints_equal_plain_parsing():
    texts = some_texts()
    got = phrase_names.fingerprints(texts)
    assert [x.hex() for x in got] == [plain_fingerprint(t) for t in texts]
    assert phrase_names.fingerprints(texts[5:6])[0] == got[5]  # whatever is parsed beside it


def test_long_texts_are_parsed_in_windows(monkeypatch):
    text = " ".join(some_texts()[:60])
    want = phrase_names.fingerprints([text])
    monkeypatch.setattr(phrase_names, "WINDOW", 100)
    assert phrase_names.fingerprints([text]) == want


def test_equal_substrings_share_names_at_any_offset():
    r = random.Random(2)
    passage = "".join(r.choice("abcdefgh ") for _ in range(4000))
    for before, after in (("", "xyz" * 30), ("q", ""), ("lorem ipsum " * 40, "end")):
        names = {(level, name, at - len(before)) for level, name, at, _ in plain_names(before + passage + after)}
        for level, name, at, end in plain_names("other" + passage + "behind"):
            if 1200 < at - 5 and end - 5 < 3600:
                assert (level, name, at - 5) in names


def test_likeness_estimates_shared_text():
    r = random.Random(3)
    words = ["".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(5000)]
    texts = [" ".join(r.choice(words) for _ in range(500)) for _ in range(40)]
    near, far = [], []
    for x, y in zip(texts, texts[1:]):
        a, b, c = phrase_names.fingerprints([x, x[:len(x) * 3 // 4] + y[:len(x) // 4], y])
        near.append(phrase_names.likeness(a, b))
        far.append(phrase_names.likeness(a, c))
    assert 0.6 < np.mean(near) < 0.85 and min(near) > 0.5 and max(far) < 0.15
    assert phrase_names.likeness(b"", b"") == 1.0 and phrase_names.likeness(b"", a) == 0.0 == phrase_names.likeness(a, b"")


@pytest.mark.parametrize("chars", [1 << 22, 300])
def test_each_row_meets_the_next(spark, docs, monkeypatch, chars):
    """In one part of the id range and in many."""
    monkeypatch.setattr(phrase_names, "CHARS", chars)
    rows = [(7 * k % 71, t) for k, t in enumerate(some_texts())]
    got = phrase_names.compare(docs(rows)).collect()
    rows.sort()
    assert len(got) == len(rows) == len({r.doc_id for r in got})
    for r in got:
        k = [i for i, _ in rows].index(r.doc_id)
        text, after = rows[k][1], rows[(k + 1) % len(rows)][1]
        cut = len(text) // 4
        edited = text[:len(text) - cut] + after[:cut]
        marks = [plain_fingerprint(t) for t in (text, edited, after)]
        own, other, nxt = map(bytes.fromhex, marks)
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == tuple(marks[:2])
        assert (r.near_edited, r.near_next) == (phrase_names.likeness(own, other), phrase_names.likeness(own, nxt))


def test_fingerprints_of_messy_rows(docs):
    assert phrase_names.compare(docs([])).collect() == []
    one, = phrase_names.compare(docs([(5, "only one row here")])).collect()
    assert one.near_next == 1.0
    rows = messy()
    got = phrase_names.compare(docs(rows)).collect()
    assert sorted((str(r.doc_id), r.n_chars, r.fingerprint) for r in got) == sorted(
        (str(i), len(t or ""), plain_fingerprint(t or "") if len(t or "") < 10_000 else phrase_names.fingerprints([t])[0].hex())
        for i, t, *_ in rows)
    hot = phrase_names.compare(docs([(None, "same text again")] * 40 + [(1, "other words")])).collect()
    assert len(hot) == 41 and sum(r.near_next == 1.0 for r in hot) == 39
