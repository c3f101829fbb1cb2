import base64
import random
from collections import Counter

import pytest
import zstandard
from hypothesis import given, settings, strategies as st

from tabulyte.llm import queries
from tabulyte.llm.chat_format import chat_format, learnt_texts, read_back
from tabulyte.llm.mixing import mix, water_fill
from tabulyte.llm.quality import band, chunks_of, quality

# mixing


@given(st.lists(st.tuples(st.integers(0, 10**9), st.integers(1, 9)), min_size=1, max_size=12), st.floats(0, 4))
@settings(max_examples=200, deadline=None)
def test_water_filling(sources, share):
    sizes, weights = zip(*sources)
    total = share * sum(sizes)
    targets = water_fill(sizes, weights, total, 3)
    assert all(t <= 3 * n + 1e-6 for t, n in zip(targets, sizes))
    assert sum(targets) == pytest.approx(min(total, 3 * sum(sizes)), abs=1e-3, rel=1e-9)
    level = [t / w for t, n, w in zip(targets, sizes, weights) if t < 3 * n * (1 - 1e-12)]
    assert not level or max(level) == pytest.approx(min(level))
    assert not level or all(3 * n / w <= max(level) * (1 + 1e-9) for t, n, w in zip(targets, sizes, weights) if t >= 3 * n)


def test_mix_of_awkward_rows(docs, rows):
    out = mix(docs).collect()
    assert Counter((r.doc_id, r.source) for r in out) == Counter((r[0], r[3]) for r in rows)
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len((r[1] or "").encode().split())
    order = sorted(sizes, key=lambda s: (s is None, s))
    targets = dict(zip(order, water_fill([sizes[s] for s in order], [5, 2, 1, 5], sum(sizes.values()), 3)))
    assert all(r.target == pytest.approx(targets[r.source]) and r.source_size == sizes[r.source] and 0 <= r.copies <= 3 for r in out)
    assert Counter(out) == Counter(mix(docs.repartition(2)).collect())


def test_taken_words_are_near_the_targets(table):
    taken, target = Counter(), {}
    for r in mix(table("documents")).collect():
        taken[r.source] += r.size * r.copies
        target[r.source] = r.target
    assert all(abs(target[s] - taken[s]) <= 0.15 * target[s] for s in target), {s: taken[s] / target[s] for s in target}


def test_mix_of_nothing(spark, none):
    assert mix(none).count() == 0
    empty = spark.createDataFrame([(1, None, "a"), (2, "", "b")], "doc_id long, text string, source string")
    assert [r.copies for r in mix(empty).collect()] == [0, 0]


# chat


def turns_of(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)


def test_round_trip(spark):
    rng = random.Random(2)
    bits = ["</s>", "<s>", "<\\s>", "[INST]", "[/INST]", "[\\INST]", "<<SYS>>", "<</SYS>>", "<|im_end|>\n", "<|im_sep|>", "<|im_start|>", "<", "\\", "[", "a", "é漢", "\n", " ", "$1", "😀"]
    text = lambda: "".join(rng.choice(bits) for _ in range(rng.randrange(8)))
    rows = [(c, t, rng.choice(["user", "assistant", "system", "a\nb", "<|im_end|>\n", None]), rng.choice([text(), None])) for c in range(150) for t in range(rng.randrange(1, 7))]
    rows += [(None, None, "user", "x"), (None, 1, "user", "x"), (None, 1, "user", "x"), (900, 1, "assistant", "b"), (900, 1, "assistant", "a")]
    out = chat_format(turns_of(spark, rows)).select("*", read_back("formatted").alias("turns")).collect()
    expected = {}
    for c, t, role, text_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        expected.setdefault(c, []).append((role or "", text_ or ""))
    assert {r.conv_id: [tuple(t) for t in r.turns] for r in out} == expected
    for r in out:
        at, learnt = 0, []
        for run in r.mask:
            if run.loss:
                learnt.append(r.formatted[at : at + run.chars])
            at += run.chars
        assert at == len(r.formatted)
        assert len(learnt) == sum(role == "assistant" for role, _ in expected[r.conv_id])
        heads = sum(i == 0 or expected[r.conv_id][i - 1][0] != role for i, (role, _) in enumerate(expected[r.conv_id]))
        assert r.formatted.count("<|im_start|>") == heads == r.formatted.count("<|im_end|>\n")


def test_plain_conversation(spark):
    out = chat_format(turns_of(spark, [(1, 0, "user", "Hi </s>"), (1, 1, "assistant", "A"), (1, 2, "assistant", "B")])).first()
    assert out.formatted == "<|im_start|>user\nHi <\\/s><|im_end|>\n<|im_start|>assistant\nA<|im_sep|>B<|im_end|>\n"


def test_learnt_texts_are_cut_by_the_mask(spark):
    said = ["\ufeffa</s>", "", "<|im_end|>\n😀", "<\\", "/s>", None, "é\n漢"]
    rows = [(1, i, "assistant" if i % 3 else "user", t) for i, t in enumerate(said * 3)]
    for role in ("assistant", "user", "nobody"):
        out = chat_format(turns_of(spark, rows), learn=role).select(learnt_texts("formatted", "mask").alias("t")).first()
        assert out.t == [t or "" for _, _, r, t in rows if r == role]


def test_op4_takes_the_loss_from_the_mask(spark, tmp_path, monkeypatch):
    turns_of(spark, [(1, 0, "user", "question?"), (1, 1, "assistant", "yes")]).write.parquet(str(tmp_path / "conversations.parquet"))
    chars = lambda: {r.conv_id: r.loss_chars for r in queries.QUERIES["op4_chat_format"](spark, str(tmp_path)).collect()}
    assert chars() == {-1: 21, 1: 3}
    monkeypatch.setattr(queries, "chat_format", lambda turns: chat_format(turns, learn="user"))
    assert chars() == {-1: 21, 1: 9}


def test_chat_runs_no_python_and_takes_empty_tables(spark):
    out = chat_format(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))
    assert out.count() == 0
    plan = out.select(read_back("formatted"))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


# quality


def test_counts_like_brute_force(docs, rows):
    found = Counter((r.doc_id, *r.quality[:6]) for r in quality(docs).collect())
    expected = Counter()
    for i, t, *_ in rows:
        t = t or ""
        w = [x.decode() for x in t.encode().split()]
        seen = Counter(tuple(w[a : a + 3]) for a in range(len(w) - 2))
        hit = {k for a in range(len(w) - 2) if seen[tuple(w[a : a + 3])] > 1 for k in range(a, a + 3)}
        lines = [x for x in t.split("\n") if x.encode().split()]
        failed = len(w) < 50 or 100 * len(hit) > 50 * len(w)
        expected[i, len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit), failed] += 1
    assert found == expected


def plain_verdict(text):
    """Ratio, chunks outside and chunks, and whether the bands keep the text."""
    raw, pack = text.encode(), zstandard.ZstdCompressor(level=3)
    if not raw:
        return 0.0, 0, 0, False
    inside = lambda x: band(len(x))[0] <= len(x) / len(pack.compress(x)) <= band(len(x))[1]
    count = max(1, len(raw) // 4096)
    chunks = [raw[4096 * k : 4096 * (k + 1) if k + 1 < count else len(raw)] for k in range(count)]
    outside = sum(not inside(c) for c in chunks)
    return len(raw) / len(pack.compress(raw)), outside, count, inside(raw) and outside <= 0.5 * count


def test_verdicts_like_brute_force(table):
    docs = table("documents")
    for r in quality(docs, carry=["text"]).collect():
        ratio, outside, count, fine = plain_verdict(r.text or "")
        assert (r.quality.ratio, r.quality.chunks_outside, r.quality.n_chunks) == (ratio, outside, count)
        assert r.quality.kept == (not r.quality.base_failed and fine)


def test_bands_catch_what_the_base_rules_pass(spark):
    """Templates, random characters, encoded data and garbled halves of 50 words and more:
    the base rules pass them all, the bands none; prose of every length stays."""
    rng = random.Random(4)
    lexicon = ["".join(rng.choice("eeeeettttaaaooiinnsshhrrdllcum") for _ in range(rng.randrange(2, 10))) for _ in range(20_000)]
    prose = lambda n: " ".join(lexicon[int(20_000 ** rng.random()) - 1] for _ in range(n))
    template = lambda n: " ".join(f"item {rng.randrange(10**6)} costs {rng.randrange(10**6)} euros," for _ in range(n))
    noise = lambda n: " ".join("".join(chr(rng.randrange(0x21, 0x7F)) for _ in range(rng.randrange(4, 12))) for _ in range(n))
    coded = lambda n: " ".join(base64.b64encode(rng.randbytes(30)).decode() for _ in range(n))
    bad = [template(n) for n in (60, 200, 2000)] + [noise(n) for n in (100, 500, 4000)] + [coded(n) for n in (60, 400, 3000)]
    bad += [prose(700) + " " + noise(3000), template(3000) + " " + prose(700)]
    good = [prose(n) for n in (80, 150, 400, 900, 2500, 8000)]
    docs = spark.createDataFrame(list(enumerate(bad + good)), "doc_id long, text string")
    out = {r.doc_id: r.quality for r in quality(docs).collect()}
    assert not any(q.base_failed for q in out.values())
    assert [k for k in range(len(bad)) if out[k].kept] == []
    assert [k for k in range(len(bad), len(out)) if not out[k].kept] == []


def test_texts_labelled_good_stay(table):
    good = table("labels").filter("quality = 1").select("doc_id").distinct()
    out = quality(table("documents").join(good, "doc_id"), carry=["doc_id"]).select("quality.*").filter("not base_failed")
    assert out.count() > 10 and out.filter("not kept").count() == 0


def test_chunks_cover_the_whole_text():
    assert chunks_of(10, 4) == [(0, 4), (4, 10)] and chunks_of(3, 4) == [(0, 3)] and chunks_of(8, 4) == [(0, 4), (4, 8)]


def test_carried_columns(docs, none):
    assert quality(docs).columns == [*docs.columns, "quality"]
    assert quality(docs.withColumnRenamed("lang", "quality"), carry=["doc_id", "text"]).columns == ["doc_id", "text", "quality"]
    assert quality(none).count() == 0
