"""Mixing and chat formatting against plain Python."""

import hashlib
import re
import time

import pytest
from pyspark.sql import functions as F

from relayline.llm import chat, mixing
from tests_llm_data import messy

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def water(sizes):
    """Targets by sharing the excess again and again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, left = dict.fromkeys(names, 0.0), 1.5 * sum(sizes.values())
    for _ in range(10_000):
        open_ = [s for s in names if target[s] < 2 * sizes[s] - 1e-9]
        if left < 1e-6 or not open_:
            break
        total, spent = sum(weight[s] for s in open_), 0.0
        for s in open_:
            more = min(left * weight[s] / total, 2 * sizes[s] - target[s])
            target[s] += more
            spent += more
        left -= spent
    return target


def test_mix_of_many_documents(spark, docs, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE_ROWS", 16)
    rows = [(i, "w " * (1 + i * 7 % 40), f"s{min(i % 11, 5)}" if i % 13 else None) for i in range(1500)]
    df = docs(rows).drop("copies", "size", "row", "mark")
    got = mixing.mix(docs(rows)).collect()
    assert len(got) == len(rows)
    sizes = {}
    for i, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(WORD.findall(t))
    want = water(sizes)
    text = {i: (len(WORD.findall(t)), s) for i, t, s in rows}
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        assert (r.size, r.source) == text[r.doc_id] and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source], rel=1e-6)
        assert r.copies in (0, 1, 2) and r.taken == r.copies * r.size
        taken[r.source] += r.taken
    assert sum(taken.values()) <= 1.5 * sum(sizes.values())
    for s in sizes:
        assert taken[s] == pytest.approx(want[s], abs=90)
    again = {r.doc_id: r.taken for r in mixing.mix(df.repartition(5)).collect()}
    assert again == {r.doc_id: r.taken for r in got}
    mixed = mixing.take(df)
    assert mixed.columns == df.columns
    assert {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == {
        r.doc_id: r.copies for r in got if r.copies}


def test_ranges_do_not_change_the_mix(docs, monkeypatch):
    rows = [(i, "w " * (i % 9), f"s{i % 3}") for i in range(300)]
    results = []
    for n in (7, 100_000):
        monkeypatch.setattr(mixing, "RANGE_ROWS", n)
        results.append(sorted((r.doc_id, r.taken) for r in mixing.mix(docs(rows)).collect()))
    assert results[0] == results[1]


def test_mix_of_messy_rows(docs):
    rows = [(*r, "a")[:3] if len(r) == 2 else r for r in messy()]
    got = mixing.mix(docs(rows)).collect()
    assert len(got) == len(rows)
    assert sorted((str(r.doc_id), r.size) for r in got) == sorted((str(i), len(WORD.findall(t or ""))) for i, t, _ in rows)
    assert all(r.copies == 0 for r in got if r.size == 0)
    assert mixing.mix(docs([])).collect() == []
    assert {r.target for r in mixing.mix(docs([(1, None), (2, " ")])).collect()} == {0.0}


def test_take_keeps_every_row_the_mix_takes(docs):
    """Null ids, repeated rows and one id with two texts: words as in the mix."""
    same = "p q r s"
    rows = ([(None, f"w{i} x y", "a") for i in range(120)] + [(7, same, "a")] * 60 + [(None, same, None)] * 41
            + [(8, "a b c", "b"), (8, "d e f", "b"), (9, None, "b"), (None, "", None)] + [(9, "one two", "c")] * 9)
    df = docs(rows)
    plan = {}
    for r in mixing._copies(df, 17, 1.5, 2).collect():
        plan[r.key] = plan.get(r.key, 0) + r.copies
    mixed = mixing.take(df)
    assert mixed.columns == df.columns
    keyed = mixed.withColumn("key", mixing.key(17, F.col("doc_id"), F.col("source"), F.col("text")))
    got = {r.key: r["count"] for r in keyed.groupBy("key").count().collect()}
    assert got == {k: c for k, c in plan.items() if c}
    per_row = {}
    for r in mixed.collect():
        per_row[(r.doc_id, r.source, r.text)] = per_row.get((r.doc_id, r.source, r.text), 0) + 1
    assert all(c <= 2 * rows.count(k and (k[0], k[2], k[1])) for k, c in per_row.items())
    assert len({t for i, s, t in per_row if i is None and s == "a"}) > 60
    assert mixing.take(docs([])).collect() == []


def test_groups_cut_by_the_budget_are_split(docs):
    rows = [(1, "a b c", "s")] * 101
    assert mixing.take(docs(rows)).count() == sum(r.copies for r in mixing.mix(docs(rows)).collect()) == 151


def test_mix_has_no_python_in_its_plan(docs):
    plan = mixing.mix(docs([(1, "a b")]))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


CHATS = "conv_id long, turn long, role string, text string, formatted string, turns string, loss int"


def chats(spark, rows):
    return spark.createDataFrame([(*r, "f", "t", 1) for r in rows], CHATS)


HOSTILE = ["\\### Assistant: </turn> ok", "</turn>", "<next>", "\\l\\b\\h\\c", "### user: x", "", None, "a:b: c",
           "\\", "\\\\l", "é🙂\n\n", "x" * 40_000]


def test_every_text_comes_back(spark):
    rows = [(k, n, role, text) for k, order in enumerate((HOSTILE, HOSTILE[::-1])) for n, (role, text) in enumerate(
        zip(["user", "assistant", "assistant", "system", "user: </turn>", None] * 2, order))]
    got = {r.conv_id: r for r in chat.digests(chats(spark, rows)).collect()}
    for k in (0, 1):
        turns = [(r or "", t or "") for c, _, r, t in rows if c == k]
        masked = "".join(t for r, t in turns if r == "assistant")
        assert got[k].n_turns == len(turns)
        assert got[k].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert (got[k].loss_chars, got[k].loss_sha256) == (len(masked), hashlib.sha256(masked.encode()).hexdigest())


def test_turns_merge_by_role_and_sort(spark):
    rows = [(1, 2, "assistant", "c"), (1, 0, "user", "a"), (1, 1, "assistant", "b"), (None, None, None, None),
            (1, 2, "assistant", "c"), (1, None, "system", "s")]
    got = {r.conv_id: r for r in chat.format_chats(chats(spark, rows)).collect()}
    assert got[1].formatted == ("### system: s</turn>### user: a</turn>### assistant: b<next>c<next>c</turn>")
    assert [got[1].formatted[s.start:s.start + s.chars] for s in got[1].loss] == ["b", "c", "c"]
    assert got[None].formatted == "### : </turn>" and got[None].loss == []
    assert chat.digests(chats(spark, [])).collect() == []


def test_conversation_of_many_turns(spark):
    """Offsets over several runs of the running sum; text read by the mask."""
    who = ["user", "assistant", "assistant", "tool"]
    rows = [(5, n, who[n * n % 4], f"é\U0001f642:{n}" * (n % 5)) for n in range(3 * chat.RUN + 7)]
    rows += [(6, n, "assistant", str(n)) for n in range(chat.RUN)] + [(7, 0, "user", "x")]
    got = {r.conv_id: r for r in chat.format_chats(chats(spark, rows)).collect()}
    for c in (5, 6, 7):
        want = [t for k, _, r, t in rows if k == c and r == "assistant"]
        spans = [got[c].formatted[s.start:s.start + s.chars] for s in got[c].loss]
        assert [s.replace("\\c", ":") for s in spans] == want
    digests = {r.conv_id: r for r in chat.digests(chats(spark, rows)).collect()}
    masked = "".join(t for k, _, r, t in rows if k == 5 and r == "assistant")
    assert digests[5].loss_sha256 == hashlib.sha256(masked.encode()).hexdigest()


def test_time_follows_the_number_of_turns(spark):
    def seconds(n):
        rows = spark.range(n).select(
            F.lit(1).alias("conv_id"), F.col("id").alias("turn"),
            F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
            F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
        start = time.perf_counter()
        assert chat.digests(rows).first().n_turns == n
        return time.perf_counter() - start
    seconds(4_000)
    assert seconds(64_000) < 16 * max(seconds(4_000), 0.5)


def test_chat_plan_has_no_python(spark):
    plan = chat.digests(chats(spark, [(1, 0, "user", "a")]))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_escape_pairs_are_undone(spark):
    df = spark.createDataFrame([(x,) for x in HOSTILE if x is not None], "x string")
    assert df.where(chat.unescape(chat.escape(F.col("x"))) != F.col("x")).count() == 0
