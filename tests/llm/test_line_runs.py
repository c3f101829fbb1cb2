"""Repeated chunks of lines against brute force."""

import random
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tabulyte.llm import line_dedup
from tabulyte.llm.line_dedup import run_dedup


def boundary(a, b):
    """Whether a chunk may end at line b after line a."""
    a, b = (xxhash.xxh64(x.encode(), seed=42).intdigest() for x in (a, b))
    return (((a << 1) | (a >> 63)) ^ b) & line_dedup.MASK != 0


def chunks(text):
    """(first line, last line) of the chunks of a text."""
    lines = text.split("\n")
    w = [k for k, x in enumerate(lines) if x.encode().split()]
    out = set()
    for t in range(len(w) - 1):
        ends = boundary(lines[w[t]], lines[w[t + 1]])
        out.add((w[t], w[t + 1] if ends or t + 2 == len(w) else w[t + 2]))
        out.add((w[t] if ends or t == 0 else w[t - 1], w[t + 1]))
    return lines, out


def brute(rows):
    """Rows after removal: (id, text, lines, removed) with their number."""
    order = lambda i: (i is not None, i or 0)
    texts = {(order(r[0]), r[1]) for r in rows if r[1] is not None}
    places = {}
    for i, t in texts:
        lines, spans = chunks(t)
        for a, b in spans:
            places.setdefault(tuple(lines[a : b + 1]), []).append((i, a, t, b))
    gone = {}
    for found in places.values():
        # ties of id and place are decided by the text hash; the rows here have none
        first = min(found, key=lambda x: x[:2])
        for i, a, t, b in found:
            if (i, t) != (first[0], first[2]) or a > first[3]:
                gone.setdefault((i, t), set()).update(range(a, b + 1))
    out = Counter()
    for i, t, *_ in rows:
        lines = [] if t is None else t.split("\n")
        cut = gone.get((order(i), t), set())
        out[i, None if t is None else "\n".join(x for p, x in enumerate(lines) if p not in cut), len(lines), len(cut)] += 1
    return out


def flat(out):
    return Counter((r.doc_id, r.text, r.line_dedup.lines, r.line_dedup.removed) for r in out.collect())


def test_runs_like_brute_force(docs, rows):
    out = run_dedup(docs)
    assert out.columns == [*docs.columns, "line_dedup"]
    assert flat(out) == brute(rows)


def test_runs_of_real_documents(table):
    docs = table("documents").select("doc_id", "text")
    out = flat(run_dedup(docs))
    assert out == brute([tuple(r) for r in docs.collect()])
    assert sum(k[3] for k in out) > 0


def passages(spark, length, count=20):
    """Runs of lines inside other text and alone: texts, runs, and what is left of each text."""
    rng = random.Random(length)
    line = lambda: " ".join(str(rng.random()) for _ in range(4))
    texts, runs = [], []
    for _ in range(count):
        run = [line() for _ in range(length)]
        runs.append(run)
        own = [[line() for _ in range(5)] for _ in range(4)]
        texts += [own[0] + run + own[1], own[2] + run + own[3], list(run)]
    docs = spark.createDataFrame([(i, "\n".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    return texts, runs, {r.doc_id: r.text for r in run_dedup(docs).collect()}


@pytest.mark.parametrize("length", [3, 4, 6, 8, 10, 40])
def test_every_later_run_goes_whole(spark, length):
    """Runs of three lines and more inside other text, and exact copies, leave no line."""
    texts, runs, out = passages(spark, length)
    for k in range(len(runs)):
        own = texts[3 * k + 1]
        assert out[3 * k] == "\n".join(texts[3 * k])
        assert out[3 * k + 1] == "\n".join(own[:5] + own[-5:]) and out[3 * k + 2] == ""


def test_runs_of_two_lines_go_where_a_boundary_is(spark):
    texts, runs, out = passages(spark, 2, 200)
    gone = 0
    for k, (a, b) in enumerate(runs):
        own = texts[3 * k + 1]
        want = own[:5] + own[-5:] if boundary(a, b) else own
        gone += boundary(a, b)
        assert out[3 * k + 1] == "\n".join(want)
    assert 0.65 < gone / len(runs) < 0.85


def test_single_lines_and_headings_stay(spark):
    """A repeated line among other lines or blank ones is no chunk."""
    rows = [(i, f"first {i}\n\nOverview\n\nsecond {i}\nOverview\nthird {i}") for i in range(40)]
    rows += [(100, "a"), (101, "a"), (102, "\n\n\n"), (103, "\n\n\n"), (104, "a\n\n"), (105, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.text for r in run_dedup(docs).collect()} == dict(rows)


def test_inserted_lines_move_few_boundaries(spark):
    block = "\n".join(f"line {k} of a passage" for k in range(40))
    docs = spark.createDataFrame([(1, "start\n" + block), (2, "other\nfirst\nlines\n" + block.replace("line 20 ", "changed ") + "\nend")], "doc_id long, text string")
    removed = {r.doc_id: r.line_dedup.removed for r in run_dedup(docs).collect()}
    assert removed == {1: 0, 2: 39}


def test_chunks_of_one_hash_are_compared_by_bytes(spark, monkeypatch):
    """With a hash that all chunks share, the result is the same."""
    real = line_dedup._with_chunks
    docs = spark.createDataFrame([(i, "\n".join(f"{x} {x}" for x in t)) for i, t in enumerate(["abcdefg", "xabcdey", "abcdefg", "pqr", "pqrs"])], "doc_id long, text string")
    want = flat(run_dedup(docs))
    monkeypatch.setattr(line_dedup, "_with_chunks", lambda df: real(df).withColumn("key", F.lit(7).cast("long")))
    assert flat(run_dedup(docs)) == want and sum(k[3] for k in want) > 0


def test_lines_equal_to_the_next(spark):
    rows = [(1, "a\na\na"), (2, "b\nb\nb\nb"), (3, "c\nd\nc\nd\nc\nd"), (4, "\n\n\n"), (5, "e\n\ne\n\ne\n\ne\ne\ne")]
    assert flat(run_dedup(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_runs_use_no_python_and_take_an_empty_table(docs, none):
    plan = run_dedup(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
    assert run_dedup(none).count() == 0


@pytest.mark.parametrize("length", [10, 20, 40])
def test_pipeline_leaves_no_fragment_of_a_copy(spark, sf, length):
    rng = random.Random(length)
    texts = ["\n".join(" ".join(str(rng.random()) for _ in range(4)) for _ in range(length)) for _ in range(30)]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts + texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.line_dedup_stage(spark, docs, sf)
    assert {r.doc_id: r.text for r in out.collect()} == dict(enumerate(texts))
