"""Personal data, secrets and the language model against plain versions."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabulyte.llm import katz, pii, secrets
from tabulyte.llm.katz import katz_scores
from tabulyte.llm.pii import base_spans, pii_spans
from tabulyte.llm.secrets import secret_spans, strong_spans

# personal data


def plain_spans(text):
    """The fixed patterns as they are stated, without the linear forms."""
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 13 <= len(digits) <= 19 and pii.luhn(digits):
            out.append((2, *m.span()))
    return out + [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


def test_linear_patterns_equal_the_stated_ones():
    rng = random.Random(1)
    bits = ["a", "B9", "@", ".", "..", "-", "%", "+", "1", "42", "255", "256", "007", " ", "(", ")", "é", "a@b.c", "4111 1111 1111 1111", "10.0.0.1", "+1 (988) 555-2485", "１"]
    for _ in range(6000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(1, 14)))
        assert base_spans(text) == plain_spans(text), text


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "a@" * 100_000, "1" * 300_000, "1." * 100_000, "+" * 100_000):
        base_spans(text)


@pytest.fixture(scope="module")
def people(spark):
    rng = random.Random(9)
    digits = lambda n: "".join(str(rng.randrange(10)) for _ in range(n))
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    rows = []
    for i in range(300):
        items = [f"{word()}.{digits(2)}@mail.example.com", f"10.{rng.randrange(256)}.7.{rng.randrange(256)}", f"+1 ({digits(3)}) 555-{digits(4)}", f"{word()} {digits(2)}", f"page {digits(3)}"]
        rows.append((i, " ".join([word(), rng.choice(items), word(), word(), rng.choice(items), word()])))
    rows.append((900, "call +1 (988) 555-2485 or later (988) 555-2485 again"))
    rows.append((901, "no data in here, only words"))
    rows += [(902, None), (903, ""), (None, "x@y.zz"), (None, "x@y.zz"), (904, "1" * 20000)]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


def test_field_adds_and_keeps(people):
    out = pii_spans(people).collect()
    assert len(out) == people.count()
    texts = defaultdict(list)
    for r in people.collect():
        texts[r.doc_id].append(r.text or "")
    for r in out:
        base = [(pii.KINDS.index(s.kind), s.start, s.end) for s in r.base]
        assert base == plain_spans(texts[r.doc_id][0])
        spans = [(pii.KINDS.index(s.kind), s.start, s.end) for s in r.spans]
        assert set(base) <= set(spans) and spans == sorted(spans)
        added = [s for s in spans if s not in base]
        assert not any(s < e2 and s2 < e for _, s, e in added for _, s2, e2 in base)
        if r.doc_id in range(300):
            assert not added
    by_id = {r.doc_id: r for r in out}
    repeat = texts[900][0].index("(988) 555-2485 again")
    assert ("phone", repeat, repeat + 14) in [(s.kind, s.start, s.end) for s in by_id[900].spans]
    assert not any(by_id[k].spans for k in (901, 902, 903))


def test_skip_edges_carry_a_label():
    """A token that could be either takes the label of a distant token of the same form."""
    field = pii.Field(np.zeros((40, 5)), np.zeros((5, 5)), 3 * np.eye(5))
    field.unary[5, 4] = 6.0
    features, none = [[0, 5], [0], [0]], np.zeros((0, 2), np.int64)
    alone = pii.beliefs(field, features, none, none)
    linked = pii.beliefs(field, features, none, np.array([(0, 1)]))
    assert alone[1].max() < 0.25 and linked[1].argmax() == 4 and linked[1, 4] > 0.7 and linked[2].max() < 0.25


def test_evidence_reaches_all_repeats():
    """The number once with a plus, then 30 times bare among words, and others between."""
    text = "call +442071234567 now " + "and 442071234567 or then " * 30
    nodes = pii._Nodes.of(text)
    size, pairs = nodes.linked()
    assert size == 32 and len(pairs) == 31
    field = pii.Field(np.zeros((40, 5)), np.zeros((5, 5)), 3 * np.eye(5))
    field.unary[pii._features("+442071234567")[3], 4] = 20.0  # what the plus says
    features = nodes.features + [[]]
    p = pii.beliefs(field, features, np.zeros((0, 2), np.int64), np.array(pairs))
    step = math.exp(3) / (math.exp(3) + 4)  # one edge keeps the label so often; two lead to each repeat
    assert p[0, 4] > 0.99 and np.allclose(p[1:31, 4], step**2 + (1 - step) ** 2 / 4, atol=1e-3)


def test_messages_run_until_they_rest():
    """On a long line of tokens the default is exact, and no document changes another."""
    rng = np.random.default_rng(1)
    n = 40
    field = pii.Field(rng.normal(size=(40, 5)), 2 * np.eye(5), 5 * np.eye(5))
    features = [[int(rng.integers(1, 40))] for _ in range(n)]
    line = np.array([(i, i + 1) for i in range(n - 1)])
    ahead, behind = [np.zeros(5)], [np.zeros(5)]
    u = np.array([field.unary[f[0]] for f in features])
    for i in range(n - 1):
        ahead.append(np.logaddexp.reduce((ahead[-1] + u[i])[:, None] + field.skip, axis=0))
        behind.append(np.logaddexp.reduce((behind[-1] + u[n - 1 - i])[:, None] + field.skip, axis=0))
    exact = np.array(ahead) + u + np.array(behind[::-1])
    exact = np.exp(exact - exact.max(1, keepdims=True))
    none = np.zeros((0, 2), np.int64)
    got = pii.beliefs(field, features, none, line)
    assert np.allclose(got, exact / exact.sum(1, keepdims=True), atol=1e-3)
    two = pii.beliefs(field, features + [[1], [2]], none, np.concatenate([line, [(n, n + 1)]]), owner=np.repeat([0, 1], [n, 2]))
    assert np.array_equal(two[:n], got)
    assert np.array_equal(two[n:], pii.beliefs(field, [[1], [2]], none, np.array([(0, 1)])))


def test_messages_are_exact_on_a_tree():
    rng = np.random.default_rng(0)
    field = pii.Field(rng.normal(size=(40, 5)), rng.normal(size=(5, 5)), rng.normal(size=(5, 5)))
    features, chain, skip = [[0, 1], [0, 2], [0, 3]], np.array([(0, 1)]), np.array([(1, 2)])
    score = np.zeros((5, 5, 5))
    for a in range(5):
        for b in range(5):
            for c in range(5):
                score[a, b, c] = sum(field.unary[f, k] for fs, k in zip(features, (a, b, c)) for f in fs) + field.chain[a, b] + field.skip[b, c]
    p = np.exp(score) / np.exp(score).sum()
    exact = np.array([p.sum((1, 2)), p.sum((0, 2)), p.sum((0, 1))])
    assert np.allclose(pii.beliefs(field, features, chain, skip, rounds=60), exact, atol=1e-6)


def test_training_is_repeatable_and_bounded(people):
    a, b = pii.train(people), pii.train(people.repartition(7))
    assert np.allclose(a.unary, b.unary) and np.allclose(a.chain, b.chain) and np.allclose(a.skip, b.skip)


def test_no_personal_data(spark, none):
    assert pii_spans(none).count() == 0
    assert pii_spans(spark.createDataFrame([(1, "words only")], "doc_id long, text string")).first().spans == []


# secrets


def plain_secrets(text):
    out = [("assign", *m.span()) for m in re.finditer(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 12]
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out, key=lambda s: (s[1], secrets.KINDS.index(s[0])))


def test_strong_patterns():
    rng = random.Random(6)
    bits = ["password", "PassWD", "ſecret", "secret", "TOKEN", "toKen", "api_key", "APIKEY", '"', "'", " ", "=", ":", "==", "0123456789abcdef", "AKIA", "ABCDEFGH12345678", "short", "é", "\n", "x" * 12]
    for _ in range(6000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(1, 10)))
        assert strong_spans(text) == plain_secrets(text), text


def found(spark, texts):
    rows = secret_spans(spark.createDataFrame(texts, "doc_id long, text string").repartition(3)).collect()
    return {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in rows}, rows


def test_weak_parts_need_a_complement(spark):
    far = "word " * 120
    texts = [
        (1, "pwd=abc123 and nothing else"), (2, "user=alice pwd=abc123"), (3, f"user=alice {far} pwd=abc123"), (4, "user=alice\n\npwd=abc123"),
        (5, "see https://db.example.com/x"), (6, "url: db.example.com:5432 token: 12ab34"), (7, "login: bob then 0123456789abcdef"), (8, None), (9, ""),
        (10, "password=0123456789abcdef login=bob"), (None, "user=alice pwd=abc123"),
    ]
    spans, rows = found(spark, texts + [texts[1]])
    assert len(rows) == 12
    assert spans[1] == spans[3] == spans[4] == spans[5] == spans[8] == spans[9] == []
    assert spans[2] == [("account", 0, 10), ("key", 15, 21)] == spans[None]
    assert [k for k, *_ in spans[6]] == ["endpoint", "key"]
    assert [k for k, *_ in spans[7]] == ["account", "hex"]
    assert [k for k, *_ in spans[10]] == ["assign", "hex", "account"]


def test_weak_parts_with_prefixed_names(spark):
    texts = [
        (1, "DB_USER=admin\nDB_PASSWORD=hunter2\nDB_HOST=10.0.0.5"), (2, "smtp_login: bob\nclient_secret: ab12cd"),
        (3, "aws_access_key_id=abcd1234\naws_secret_access_key=ab/12cd"), (4, "DB_URL=postgres://u_x:p@db_1/x\nAPP_PWD=abc123"), (5, "myuser=admin\nmypassword=hunter2"),
        (6, "DB_PASSWORD=hunter2"), (7, "xDB_HOST=10.0.0.5"),
    ]
    spans, _ = found(spark, texts)
    listed = {i: [(k, texts[i - 1][1][a:b]) for k, a, b in s] for i, s in spans.items()}
    assert listed[1] == [("account", "USER=admin"), ("key", "hunter2"), ("endpoint", "HOST=10.0.0.5")]
    assert listed[2] == [("account", "login: bob"), ("key", "ab12cd")]
    assert listed[3] == [("account", "access_key_id=abcd1234"), ("key", "ab/12cd")]
    assert listed[4] == [("endpoint", "URL=postgres://u_x:p@db_1/x"), ("key", "abc123")]
    assert listed[5] == listed[6] == listed[7] == []


def test_secrets_in_awkward_rows(spark, docs, rows, none):
    assert Counter(r.doc_id for r in secret_spans(docs).collect()) == Counter(r[0] for r in rows)
    assert secret_spans(none).count() == 0


def test_secrets_of_real_documents(table):
    docs = table("documents")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in secret_spans(docs).collect():
        assert [tuple(s) for s in r.base] == plain_secrets(texts[r.doc_id])
        assert set(r.base) <= set(r.spans)


# language model


def katz_brute(rows, held):
    low = lambda t: (t or "").encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))).split() + ["end"]
    one, two, past = Counter(), Counter(), Counter()
    for (i, t, *_), h in zip(rows, held):
        if not h:
            before = "start"
            for w in low(t):
                one[w] += 1
                two[before, w] += 1
                past[before] += 1
                before = w
    n = sum(one.values())

    def factors(counts):
        c = Counter(min(v, katz.MOST + 2) for v in counts.values())
        return katz.discounts(np.array([c[r] for r in range(katz.MOST + 2)]))

    d1, d2 = factors(one), factors(two)
    left = sum((1 - d1[min(c, 6)]) * c for c in one.values())
    unigram = lambda w: (d1[min(one[w], 6)] * one[w] if one[w] else left or 1) / (n + (not left))
    follow = defaultdict(list)
    for (h, w), c in two.items():
        follow[h].append((w, c))

    def conditional(h, w):
        if not past[h]:
            return unigram(w)
        mass = sum((1 - d2[min(c, 6)]) * c for _, c in follow[h])
        total = past[h] + (mass == 0)
        if two[h, w]:
            return d2[min(two[h, w], 6)] * two[h, w] / total
        return (mass or 1) / total / (1 - sum(unigram(x) for x, _ in follow[h])) * unigram(w)

    for h in list(past)[:50]:  # every history's words and the unknown one sum to 1
        assert math.isclose(sum(conditional(h, w) for w in [*one, "never seen"]), 1, rel_tol=1e-9)
    out = []
    for (i, t, *_), h in zip(rows, held):
        ws, score, base, before = low(t), 0.0, 0.0, "start"
        for w in ws:
            score += math.log10(conditional(before, w))
            base += math.log10((one[w] + 0.5) / (n + 0.5 * (len(one) + 1)))
            before = w
        out.append((i, h, len(ws), sum(one[w] > 0 for w in ws), n, base, score))
    return out


def same_scores(got, expected):
    key = lambda r: (r[0] is not None, r[0] or 0, *r[1:5], round(r[5], 6))
    got, expected = sorted((tuple(r) for r in got), key=key), sorted(expected, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in expected]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in expected], rtol=1e-9)


@pytest.mark.parametrize("rest", [0, 1])
def test_scores_like_brute_force(docs, rows, rest):
    held = [r[0] is not None and r[0] % 2 == rest for r in rows]
    same_scores(katz_scores(docs, F.col("doc_id") % 2 == rest).collect(), katz_brute(rows, held))


def test_scores_of_real_documents(table):
    docs = table("documents").limit(60).cache()
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    same_scores(katz_scores(docs, F.col("doc_id") % 5 == 1).collect(), katz_brute(rows, [i % 5 == 1 for i, _ in rows]))


def test_nothing_to_learn_from(docs, none):
    assert katz_scores(none, F.lit(False)).count() == 0
    assert all(r.score == 0 and r.train_tokens == 0 for r in katz_scores(docs, F.lit(True)).collect())
