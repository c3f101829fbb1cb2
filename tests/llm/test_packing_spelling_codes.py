"""Packing, spelling groups and vector codes against plain versions."""

import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tabulyte.llm import spelling
from tabulyte.llm.oracles import SQL
from tabulyte.llm.packing import Encoder, cut, minimum_bin_slack, pack
from tabulyte.llm.spelling import near_words, spelling_groups, vocabulary
from tabulyte.llm.vector_codes import Codebooks, bounds, distances, vector_codes

# packing


def plain_bin(lengths, room, seeded):
    """The fullest combination of a few pieces; of equal ones that with the longest pieces."""
    pieces = sorted(lengths, reverse=True)
    subsets = {tuple(c) for n in range(1, len(pieces) + 1) for c in itertools.combinations(pieces, n) if sum(c) <= room}
    if seeded:
        subsets = {s for s in subsets if s[0] == pieces[0]}
    return max(subsets, key=lambda s: (sum(s), s))


@pytest.mark.parametrize("seeded", [True, False])
def test_bins_are_filled_one_by_one_as_full_as_they_can_be(seeded):
    rng = random.Random(3)
    for _ in range(60):
        room = rng.randrange(5, 40)
        left = [rng.randrange(1, room + 1) for _ in range(rng.randrange(1, 11))]
        plan = minimum_bin_slack(Counter(left), room, seeded)
        made = [tuple(x for x, c in p.parts for _ in range(c)) for p in plan for _ in range(p.bins)]
        for got in made:
            assert got == plain_bin(left, room, seeded)
            for x in got:
                left.remove(x)
        assert not left


def test_plan_of_many_pieces_is_near_the_least_number_of_bins():
    rng = random.Random(4)
    counts = {x: rng.randrange(1, 10**9) for x in range(1, 2049)}
    plan = minimum_bin_slack(counts)
    used = Counter()
    for p in plan:
        assert 0 < sum(x * c for x, c in p.parts) <= 2048
        for x, c in p.parts:
            used[x] += c * p.bins
    assert used == counts and len(plan) < 10_000
    long = sum(n for x, n in counts.items() if x > 1024)
    assert sum(p.bins for p in plan) <= 1.01 * max(long, sum(x * n for x, n in counts.items()) / 2048)
    assert minimum_bin_slack({}) == []


def test_cut_leaves_the_short_piece_first():
    assert cut(5, 4) == [(0, 1), (1, 4)] and cut(8, 4) == [(0, 4), (4, 4)] and cut(1, 4) == [(0, 1)]


def test_ids_are_those_of_the_tokenizer(table):
    encoder = Encoder()
    texts = [r["text"] for r in table("documents").select("text").collect() if r["text"]]
    texts += ["x" * 3000, "ab é漢字 ᲀ\x85\x1c <|endoftext|>", " \n\n  a  ", "word " * 300_000]
    for text, known in zip(texts, encoder.whole.encode_batch_fast(texts, add_special_tokens=False)):
        assert encoder.ids(text) == np.array([*known.ids, 0], "<u4").tobytes()
    assert encoder.ids(None) == encoder.ids("") == b"\0\0\0\0"


@pytest.mark.parametrize("room", [2048, 16])
def test_packed_sequences_are_gapless_and_whole(docs, rows, room):
    encoder = Encoder()
    got = pack(docs, room=room, with_ids=True).collect()
    want = Counter()
    for r in rows:
        ids = encoder.ids(r[1])
        want.update((r[0], k, start, n, zlib.crc32(ids[4 * start : 4 * start + 4 * n]), ids[4 * start : 4 * start + 4 * n]) for k, (start, n) in enumerate(cut(len(ids) // 4, room)))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids)) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        parts.sort()
        assert [a for a, _ in parts] == [0, *itertools.accumulate(n for _, n in parts[:-1])] and sum(n for _, n in parts) <= room
    assert sorted(sequences) == list(range(sum(p.bins for p in minimum_bin_slack(Counter(r.length for r in got), room))))


def test_packing_of_an_empty_table(none):
    assert pack(none).collect() == []


# spelling


def plain_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_groups(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 7 and c >= 2}
    out, forms = {}, {}
    for w in n:
        near = [v for v in n if plain_near(w, v)]
        best = min(near, key=lambda v: (-n[v], v), default=None)
        if best and n[best] >= 10 * n[w]:
            forms[w] = best
        out[w] = len(near)
    last = lambda w: last(forms[w]) if w in forms else w
    return {(w, forms.get(w), last(w), n[w], k, n.get(forms.get(w))) for w, k in out.items()}


@pytest.fixture(scope="module")
def misspelt(spark):
    """Words of few letters, so that many are near; long words, accents, nulls, copies."""
    rng = random.Random(8)
    base = ["".join(rng.choice("abé") for _ in range(rng.randrange(6, 10))) for _ in range(60)] + ["x" * 3000, "x" * 3001, "ABCDEFGÀ", "abcdefgÀ"]
    rows = [(i, " ".join(rng.choice(base[: 1 + rng.randrange(len(base))]) for _ in range(80))) for i in range(200)]
    rows += [(500, " ".join([base[0]] * 400 + [base[0] + "z"] * 30 + [base[0] + "zz"] * 2)), (501, None), (502, ""), (None, base[1] * 2 + " " + base[2]), (None, None)]
    return rows + rows[:3], spark.createDataFrame(rows + rows[:3], "doc_id long, text string").withColumns({c: F.lit("x") for c in ("word", "n", "form", "key")}).repartition(4)


@pytest.mark.parametrize("small", [False, True])
def test_groups_equal_all_pairs(misspelt, small, monkeypatch):
    rows, df = misspelt
    if small:  # every node is divided among several tasks
        monkeypatch.setattr(spelling, "NODE_WORDS", 3)
        monkeypatch.setattr(spelling, "NODE_VISITORS", 5)
        monkeypatch.setattr(spelling, "SHARD_ROWS", 50)
    got = [tuple(r) for r in spelling_groups(df).collect()]
    want = plain_groups(rows)
    assert len(got) == len(want) and set(got) == want and any(f and f != r for _, f, r, *_ in got)


@pytest.mark.parametrize("depth", [1, 3, 8])
def test_every_depth_finds_the_same(misspelt, depth):
    words = vocabulary(misspelt[1])
    assert sorted(near_words(words, depth).collect()) == sorted(near_words(words, 2).collect())


def test_spelling_of_an_empty_table(none):
    assert spelling_groups(none).collect() == []


def test_spelling_equals_sql(spark, sf, table):
    check_sql("op12_spelling", sf, [tuple(r) for r in spelling_groups(table("documents")).collect()])


def check_sql(name, sf, rows):
    db = duckdb.connect()
    for t in ("documents", "embeddings"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    assert Counter(rows) == Counter(db.execute(SQL[name]).fetchall())


# vector codes


def plain_codes(vectors, entries, rounds):
    """Every part against every entry in each round."""
    x = np.floor(1024 * np.array(vectors, np.float64)).astype(np.int64)
    books = [x[:entries, a:b].copy() for a, b in bounds(x.shape[1], 4)]
    for last in [False] * rounds + [True]:
        d = [((x[:, None, a:b] - books[p][None]) ** 2).sum(2) for p, (a, b) in enumerate(bounds(x.shape[1], 4))]
        code = [v.argmin(1) for v in d]
        if not last:
            for p, (a, b) in enumerate(bounds(x.shape[1], 4)):
                for e in set(code[p]):
                    mine = x[code[p] == e, a:b]
                    books[p][e] = mine.sum(0) // len(mine)
    return np.array(code).T.tolist(), np.array([v.min(1) for v in d]).T.tolist(), books


@pytest.mark.parametrize("scale", [0.3, 30_000.0])
def test_codes_equal_full_rescans(spark, scale):
    rng = np.random.default_rng(5)
    vectors = np.round(rng.normal(size=(700, 16)), 1) * scale  # rounded: many ties
    vectors = np.clip(vectors, -60_000, 60_000).astype(np.float32)
    vectors[100:200] = vectors[0]
    order = rng.permutation(700)
    rows = [(int(i), vectors[i].tolist(), None if i % 3 else int(i % 2)) for i in order]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("code", F.lit("own")).repartition(5)
    got, books = vector_codes(df, carry=["label", "code"], entries=20)
    code, dist, plain = plain_codes(vectors, 20, 4)
    assert {r.vec_id: (r._code, r._dist) for r in got.collect()} == {i: (code[i], dist[i]) for i in range(700)}
    assert all((a == b).all() for a, b in zip(books.entries, plain))


def test_stored_distances_give_what_a_full_scan_gives():
    rng = np.random.default_rng(1)
    x = rng.integers(-4, 5, (300, 8))
    before = Codebooks.first(x[:20], 4)
    code, dist = before.assign(x, None, None)
    after = before.replaced({(p, e): before.entries[p][e] + rng.integers(-1, 2, 2) for p in range(4) for e in range(0, 20, 3)}, {(p, e): 1 for p in range(4) for e in range(20)})
    assert 0 < after.moved[0].sum() < 20
    for a, b in zip(after.assign(x, code, dist), after.assign(x, None, None)):
        assert (a == b).all()


def test_distances_are_exact_beyond_doubles():
    x = np.array([[(1 << 26) - 1, -(1 << 26) + 1]])
    assert distances(x, -x).tolist() == [[2 * (2 * ((1 << 26) - 1)) ** 2]]


def test_odd_vectors(spark):
    good = [float(i) for i in range(8)]
    rows = [(3, good, 1), (None, good, None), (1, good[::-1], None), (1, good[::-1], None), (2, None, 1), (4, [], 1), (5, good[:7] + [None], 1), (6, good[:7] + [float("nan")], 1),
            (7, good[:7] + [float("-inf")], 1), (8, good[:4], 1)]
    schema = "vec_id long, embedding array<double>, label int"
    got, books = vector_codes(spark.createDataFrame(rows, schema))
    assert sorted((r.vec_id or 0, r._code, r._dist) for r in got.collect()) == [(0, [2] * 4, [0] * 4), (1, [0] * 4, [0] * 4), (1, [0] * 4, [0] * 4), (3, [2] * 4, [0] * 4)]
    assert len(books.entries[0]) == 4
    got, _ = vector_codes(spark.createDataFrame([], schema))
    assert got.collect() == []
    with pytest.raises(Exception, match="too large"):
        vector_codes(spark.createDataFrame([(1, [1e30] * 4, 1)], schema))


def test_query_of_codes_equals_sql(spark, sf):
    from tabulyte.llm.queries import QUERIES

    out = QUERIES["op13_vector_codes"](spark, sf)
    check_sql("op13_vector_codes", sf, [tuple(r) for r in out.collect()])
