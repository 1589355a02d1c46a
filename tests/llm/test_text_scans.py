"""Secrets, personal data, BPE: against plain regular expressions and the
tokenizers library."""

import hashlib
import itertools
import math
import random
import re
import tracemalloc

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from relayline.llm import bpe, pii, secret_scan
from tests_llm_data import messy

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def secrets_of(x):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(x) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", x) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", x) if len(m[0]) >= 24]
    return [(i, s, e) for s, i, e in sorted(found)]


def personal_of(x):
    def digits(s):
        return re.sub("[^0-9]", "", s)
    found = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", x)]
    found += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", x)
              if all(int(p) <= 255 for p in m[0].split("."))]
    found += [(2, *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", x)
              if 16 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))]
    found += [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", x) if 8 <= len(digits(m[0])) <= 15]
    return found


def scan(x):
    data = x.encode()
    return [y for y in secret_scan.points(data, secret_scan.scanner().scan(data)) if y[0] < 3]


SECRET_PIECES = ["token", "secret", "=", ":", " ", '"', "'", "AKIA", "A0", "abc", "0123456789abcdef", "é", "passwd",
                 "api_key", "APIKEY", "PassWord", "x", "\n"]
PERSONAL_PIECES = ["a", "b.c", "@", "%x", "-", ".", "1", "25", "255", "300", "4111111111111111", " ", "+", "(843)",
                   "555-4223", "é", "\n", "0", "٣", "a@b.co"]


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(SECRET_PIECES), max_size=14))
def test_secrets_match_regular_expressions(pieces):
    x = "".join(pieces)
    assert scan(x) == secrets_of(x)


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(PERSONAL_PIECES), max_size=14))
def test_base_personal_data_matches_regular_expressions(pieces):
    x = "".join(pieces)
    assert pii.base_spans(x) == personal_of(x)


def test_automaton_is_minimal_and_total():
    scanner = secret_scan.scanner()
    rows, accepts = scanner.forward.rows, scanner.forward.accepts
    assert all(len(r) == 256 for r in rows)
    assert len({(accepts[i], *r) for i, r in enumerate(rows)}) == len(rows)


def test_added_rules_and_code_points():
    x = "é ghp_" + "a1B2" * 9 + " -----BEGIN RSA PRIVATE KEY-----"
    data = x.encode()
    kinds = {secret_scan.RULES[i].kind: x[s:e] for i, s, e in secret_scan.points(data, secret_scan.scanner().scan(data))}
    assert kinds == {"github": "ghp_" + "a1B2" * 9, "pem": "-----BEGIN RSA PRIVATE KEY-----"}


def test_secret_query_on_messy_rows(docs):
    rows = messy() + [(20, 'é token = "abcdef123456" x AKIA' + "Z" * 16)]
    got = secret_scan.digests(docs(rows)).collect()
    assert len(got) == len(rows)
    want = sorted((str(i), hashlib.sha256(",".join(
        f"{secret_scan.RULES[k].kind}:{s}:{e}" for k, s, e in secrets_of(t or "")).encode()).hexdigest())
        for i, t, *_ in rows)
    assert sorted((str(r.doc_id), r.base_sha256) for r in got) == want
    row = next(r for r in got if r.doc_id == 20)
    assert (row.n_assign, row.n_access, row.n_hex) == (1, 1, 0)
    assert secret_scan.digests(docs([])).collect() == []


def test_redact_keeps_columns_and_cleans(docs):
    df = docs([(1, "a token = abcdef123 b"), (2, None), (3, "clean")])
    got = {r.doc_id: r for r in secret_scan.redact(df).collect()}
    assert secret_scan.redact(df).columns == df.columns
    assert got[1].text == "a [assign] b" and got[1].n_chars == len("a [assign] b") and got[1].size == "xsize"
    assert got[2].text is None and got[3].text == "clean"


def samples():
    r = random.Random(4)
    out = []
    for k in range(160):
        digits = "".join(r.choice("0123456789") for _ in range(15))
        card = next(digits + c for c in "0123456789" if pii.luhn(digits + c))
        bad = digits + str((int(card[-1]) + 1) % 10)
        out += [f"x {card} y", f"x {bad} y", f"see ab.{k}@mail{k % 7}.example.com now",
                f"at {r.randrange(256)}.{r.randrange(256)}.{k % 256}.9, and", f"call +1 ({r.randrange(900):03d}) 555-{k:04d} or",
                f"year {1900 + k} and {k}.5"]
    return [(x, personal_of(x)) for x in out]


def test_field_learns_the_spans_and_decodes_the_best_path():
    every = samples()
    weights = pii.train(every[:480])
    for text, want in every[480:]:
        got = []
        for s, e in pii.places(text):
            got += pii.Lattice(text, s, e).decode(weights)
        assert sorted(got) == sorted(want), text


def test_long_places_decode_in_bounded_memory(monkeypatch):
    r = random.Random(6)
    weights = np.random.default_rng(2).standard_normal((4, pii.FEATURES)) - 0.3
    text = " ".join(r.choice(["7", "4.5", "a1@b.c", "+1 (2", "no", "\n12-3", "9" * 30]) for _ in range(100))
    for chunk in (4096, 7):
        monkeypatch.setattr(pii, "CHUNK", chunk, raising=False)
        for s, e in pii.places(text):
            assert pii.decode(text, s, e, weights) == pii.Lattice(text, s, e).decode(weights)
    table = "\n".join(str(r.randrange(10, 1000)) for _ in range(6000))
    assert len(pii.places(table)) == 1
    monkeypatch.setattr(pii, "CHUNK", 4096, raising=False)
    peaks = []
    for size in (len(table) // 2, len(table)):
        tracemalloc.start()
        pii.find(table[:size], weights)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] < 1.5 * peaks[0] and peaks[1] < 400 * len(table)


def test_decoding_and_marginals_equal_enumeration():
    weights = np.random.default_rng(1).standard_normal((4, pii.FEATURES))
    lattice = pii.Lattice("a1.2", 0, 4)
    scores, bounds = lattice.scores(weights), lattice.bounds
    paths = {}
    for size in range(lattice.n + 1):
        for pick in itertools.combinations(range(len(bounds)), size):
            pick = sorted(pick, key=lambda p: bounds[p])
            if all(bounds[a][1] <= bounds[b][0] for a, b in zip(pick, pick[1:])):
                for kinds in itertools.product(range(4), repeat=size):
                    paths[tuple(zip(kinds, pick))] = sum(scores[k, p] for k, p in zip(kinds, pick))
    best = max(paths, key=paths.get)
    assert lattice.decode(weights) == [(k, *bounds[p][2:]) for k, p in best]
    total = sum(map(math.exp, paths.values()))
    want = np.zeros_like(scores)
    for path, score in paths.items():
        for k, p in path:
            want[k, p] += math.exp(score) / total
    assert np.allclose(lattice.expected(weights), want)


def test_personal_data_query_on_messy_rows(docs):
    rows = messy() + [(20 + k, x) for k, (x, _) in enumerate(samples()[:60])]
    got = pii.digests(docs(rows)).collect()
    want = sorted((str(i), hashlib.sha256(",".join(
        f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in personal_of(t or "")).encode()).hexdigest()) for i, t, *_ in rows)
    assert sorted((str(r.doc_id), r.base_sha256) for r in got) == want
    for r in got:  # base spans stay
        spans = set(r.spans.split(","))
        text = next((t for i, t, *_ in rows if i == r.doc_id), None) or ""
        assert {f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in personal_of(text)} <= spans or r.doc_id is None
    assert pii.digests(docs([])).collect() == []


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(bpe.default_path())


PIECES = ["<|startoftext|>", "<|endoftext|>", "Σ", "ΑΣ", "İ", "é", "é", "\x1c", "\x85", " ", "'s", "don't", "１２",
          "½", " ", "\n", "!!", "ß", "ﬁ", "日本", "​", "🙂", "A", "<|", "٣", "क़", "\x00", "\xa0", "ǅ", "hello"]


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=12))
def test_bpe_equals_the_library(library, pieces):
    x = "".join(pieces)
    own = bpe.load(bpe.default_path())
    want = library.encode(x, add_special_tokens=False).ids
    assert own.encode(x) == want
    assert own.decode(want) == library.decode(want, skip_special_tokens=False)


def test_bpe_query_on_messy_rows(docs, library):
    rows = messy()
    got = bpe.digests(docs(rows)).collect()
    want = []
    for i, t, *_ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((str(i), len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == sorted(want)
    assert bpe.digests(docs([])).collect() == []
    encoded = bpe.encode_documents(docs(rows))
    back = {r.doc_id: r.text for r in bpe.decode_documents(encoded).collect()}
    assert back[8] == library.decode(library.encode("word", add_special_tokens=False).ids)


def test_tokenise_messy_rows_and_an_empty_table(docs, library):
    rows = messy()
    got = sorted(((r.doc_id or -1, r.n_tokens, tuple(r.ids)) for r in bpe.tokenise(docs(rows)).collect()))
    want = sorted((i or -1, len(x), tuple(x)) for i, x in (
        (r[0], library.encode(r[1] or "", add_special_tokens=False).ids) for r in rows))
    assert got == want
    assert bpe.tokenise(docs([])).collect() == []


def test_redact_of_overlaps_long_texts_and_an_empty_table(docs):
    secret = "AKIA" + "B" * 20
    rows = [(1, f"token={secret} end"), (2, ("plain words " * 20_000) + secret + " z"), (3, secret + secret.lower() + " " + "0f" * 20)]
    got = {r.doc_id: r for r in secret_scan.redact(docs(rows)).collect()}
    assert secret not in "".join(r.text for r in got.values())
    assert got[1].text.endswith(" end") and got[1].text.count("[") == 1      # overlapping spans are one mark
    assert got[2].text == ("plain words " * 20_000) + "[access] z" and got[2].n_chars == len(got[2].text)
    assert "0f0f" not in got[3].text
    assert secret_scan.redact(docs([])).collect() == []
