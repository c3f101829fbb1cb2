"""The pipeline's stages on planted rows and the registered queries."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
import corpus_pipeline
from tabulyte.llm import queries
from tools.compare import compare


def test_numbered_queries_are_registered():
    names = entry_point.queries()
    assert "pipeline" in names and all(sum(k.startswith(f"op{n}_") for k in names) == 1 for n in range(1, 14))
    assert set(queries.SQL) <= set(queries.QUERIES)


@pytest.mark.parametrize("key", sorted(queries.SQL))
def test_same_rows_as_sql(spark, sf, key):
    import duckdb

    from tabulyte.plans.registry import TABLE_NAMES

    con = duckdb.connect()
    for name in TABLE_NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    state, _, note = compare(spark, con, key, queries.QUERIES[key], queries.SQL[key], sf)
    assert state == "OK", note


def test_digest_columns(spark, sf):
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in queries.QUERIES["op3_substring_dedup"](spark, sf).collect():
        if r.n_removed == 0:
            assert r.kept_sha256 == hashlib.sha256(b" ".join(text[r.doc_id].encode().split())).hexdigest()
    for r in queries.QUERIES["op10_katz"](spark, sf).collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 1) and r.score > r.base_score


def planted(spark, table):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("etaoinshrdlucmf") for _ in range(rng.randrange(2, 9)))
    prose = lambda n: " ".join(word() + ("\n" if rng.random() < 0.08 else "") for _ in range(n))
    bench = table("benchmark").orderBy("item_id").filter(F.length("text") > 150).first().text
    clean = [(k, prose(150), "en", f"s{k % 3}", 1) for k in range(40)]
    near = clean[0][1].split(" ")
    near[70] = "altered"
    rows = clean + [
        (100, clean[1][1], "en", "s0", 1), (101, " ".join(near), "en", "s1", 1), (102, "too short", "en", "s1", 1),
        (103, "again and again " * 60, "en", "s1", 1), (104, None, None, None, None), (105, f"{prose(80)} {bench} {prose(80)}", "en", "s2", 1), (106, bench * 2, "en", "s2", 1)]
    return rows, bench


def test_stages(spark, sf, table):
    rows, bench = planted(spark, table)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    steps = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, sf)
        steps[name] = docs = spark.createDataFrame(docs.collect(), docs.schema)
        if name != "mix":
            assert docs.columns == before.columns
    ids = {k: {r.doc_id for r in v.collect()} for k, v in steps.items()}
    assert set(range(40)) <= ids["quality_rules"] and not ids["quality_rules"] & {102, 103, 104}
    assert set(range(40)) <= ids["near_duplicates"]
    # line chunks already cut the copies, so near duplicates are judged on the rows before
    alone = {r.doc_id for r in dict(corpus_pipeline.STAGES)["near_duplicates"](spark, steps["quality_rules"], sf).collect()}
    assert alone == ids["quality_rules"] - {100, 101}
    texts = {r.doc_id: r.text for r in steps["decontaminate"].collect()}
    start = " ".join(re.findall(r"[^\x20\x09-\x0D]+", bench)[:10])
    assert 106 not in texts and start not in re.sub(r"\s+", " ", texts[105]) and set(range(40)) <= set(texts)
    last = steps["mix"].collect()
    assert all(texts[r.doc_id] == r.text and 1 <= r.copy <= 3 for r in last) and len({(r.doc_id, r.copy) for r in last}) == len(last)


def test_stages_take_an_empty_table_and_awkward_rows(spark, sf, docs, none):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    for table in (none, docs):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, table.select(*columns), sf)
            assert out.columns[:5] == columns
            rows = out.collect()
            assert table is docs or not rows


def test_run(spark, sf):
    out = corpus_pipeline.run(spark, sf)
    assert out.count() > 0 and out.groupBy("doc_id", "copy").count().filter("count > 1").count() == 0


OWN = ["copies", "rows", "t_id", "text_hash", "copy", "_hash", "_quality", "_lines", "quality", "line_dedup", "h", "id", "row", "own_hash", "spans"]


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_pass_columns_of_any_name(spark, sf, table, name):
    rows, _ = planted(spark, table)
    plain = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    more = plain.withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in OWN})
    stage = dict(corpus_pipeline.STAGES)[name]
    out, wide = stage(spark, plain, sf), stage(spark, more, sf)
    new = ["copy"] if name == "mix" else []
    assert wide.columns == [*plain.columns, *[c for c in OWN if c not in new], *new]
    assert sorted(map(str, wide.select(out.columns).collect())) == sorted(map(str, out.collect()))
    kept = [c for c in OWN if c not in new]
    assert all(r[c] == (None if r.doc_id is None else f"{c}{r.doc_id}") for r in wide.collect() for c in kept)


def test_near_duplicates_with_clashing_ids(spark, sf, table):
    rng = random.Random(2)
    a, c, d = (" ".join(str(rng.random()) for _ in range(60)) for _ in range(3))
    rows = [(1, a), (5, a), (5, c), (5, c), (None, a), (None, d), (7, ""), (8, None), (9, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.near_duplicates(spark, docs, sf)
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted([(1, a), (5, c), (None, d), (7, ""), (8, None), (9, None)], key=str)
    assert corpus_pipeline.near_duplicates(spark, docs.limit(0), sf).count() == 0


def test_whole_short_items_are_cut(spark):
    from tabulyte.llm.decontaminate import decontaminate

    items = spark.createDataFrame([(1, "a rather short item"), (1, "a rather short item")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "here stands A rather, short item! and so on and on and on"), (2, "a rather short one")], "doc_id long, text string")
    assert {r.doc_id: r.text for r in decontaminate(docs, items).collect()} == {1: "here stands and so on and on and on", 2: "a rather short one"}
