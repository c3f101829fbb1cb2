"""Text operators over the documents and their labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabulyte.functions import text as tx
from tabulyte.operators import aggregates as ag, terms
from tabulyte.plans.registry import query
from tabulyte.plans.scalars import CLEAN_SQL, EMOJI_SQL

# The words that these queries leave out.
STOP = ("the and of to in is it that on en for with as this be by are at or an "
        "la le de et les des un une du au qui que").split()
STOP_SQL = ", ".join(f"'{w}'" for w in STOP)

ROWS_SQL = "(SELECT doc_id, text, quality AS y FROM documents JOIN labels USING (doc_id))"
ALL_SQL = "(SELECT doc_id, text, NULL AS y FROM documents)"


def words_sql(source):
    return f"""(SELECT doc_id, y, list_filter(string_split({CLEAN_SQL}, ' '), lambda w: len(w) >= 2 AND w NOT IN ({STOP_SQL})) AS w FROM {source})"""


WORDS_SQL = words_sql(ROWS_SQL)
PAIRS = "list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])"


def grams_sql(sizes, source=ROWS_SQL):
    grams = {(1, 1): "w", (2, 2): PAIRS, (1, 2): f"list_concat(w, {PAIRS})"}[sizes]
    return f"(SELECT doc_id, y, unnest({grams}) AS term FROM {words_sql(source)})"


def counts_sql(sizes, limit, source=ROWS_SQL):
    return f"""(WITH g AS MATERIALIZED (SELECT doc_id, y, term, count(*) AS tf FROM {grams_sql(sizes, source)} GROUP BY ALL),
        v AS MATERIALIZED (SELECT term FROM g GROUP BY term ORDER BY sum(tf) DESC, term LIMIT {limit})
        SELECT doc_id, y, term, tf FROM g JOIN v USING (term))"""


def rows(t):
    return t.spread("documents").select("doc_id", "text").join(t.labels.select("doc_id", F.col("quality").alias("y")), "doc_id")


@query("txt_tokenize_count", f"SELECT y::BIGINT AS y, term, count(*) AS n FROM {grams_sql((1, 1))} GROUP BY ALL")
def txt_tokenize_count(t):
    return terms.class_counts(rows(t), "text", "y", STOP)


def every(t):
    return t.spread("documents").select("doc_id", "text")


@query("txt_count_vectorize", f"SELECT doc_id, term, tf FROM {counts_sql((1, 2), 500, ALL_SQL)}")
def txt_count_vectorize(t):
    return terms.term_counts(every(t), "text", "doc_id", max_features=500, stop=STOP, sizes=(1, 2))


def weights_sql(limit, source=ROWS_SQL):
    return f"""(WITH c AS {counts_sql((1, 1), limit, source)}, f AS (SELECT term, count(*) AS df FROM c GROUP BY 1),
      w AS (SELECT doc_id, y, c.term, tf, (1 + ln(tf)) * (ln((1 + (SELECT count(*) FROM {source})) / (1 + df)) + 1) AS w FROM c JOIN f USING (term))
      SELECT doc_id, y, term, tf, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM w)"""


def weights(t, limit):
    docs = rows(t)
    counts = terms.term_counts(docs, "text", "doc_id", ["y"], limit, STOP)
    return terms.tfidf(counts, "doc_id", terms.row_count(docs), sublinear=True, max_features=limit)


@query("txt_tfidf", f"SELECT doc_id, term, tf, weight FROM {weights_sql(1000, ALL_SQL)}", {8: "weight"})
def txt_tfidf(t):
    docs = every(t)
    counts = terms.term_counts(docs, "text", "doc_id", max_features=1000, stop=STOP)
    return terms.tfidf(counts, "doc_id", terms.row_count(docs), sublinear=True, max_features=1000)


def scores_sql(sizes, limit):
    return f"""(WITH s AS (SELECT avg(y) AS p FROM {ROWS_SQL}),
      c AS (SELECT term, sum(tf) FILTER (y = 1) AS a, sum(tf) FILTER (y = 0) AS b, avg(y) AS mean_label FROM {counts_sql(sizes, limit)} GROUP BY 1),
      d AS (SELECT term, coalesce(a, 0)::BIGINT AS pos, coalesce(b, 0)::BIGINT AS neg, mean_label, p FROM c, s)
      SELECT term, pos, neg, mean_label, power(pos - (pos + neg) * p, 2) / ((pos + neg) * p) + power(neg - (pos + neg) * (1 - p), 2) / ((pos + neg) * (1 - p)) AS chi2,
             ln((pos + 0.1) / (neg + 0.1)) AS log_odds FROM d)"""


def scores(t, sizes, limit):
    docs = rows(t)
    counts = terms.term_counts(docs, "text", "doc_id", ["y"], limit, STOP, sizes)
    return terms.chi2_terms(counts, docs, "y")


@query(
    "txt_chi2_terms",
    f"""SELECT *, CASE WHEN mean_label > 0.5 THEN 'positive' ELSE 'negative' END AS direction
        FROM {scores_sql((1, 1), 2000)} ORDER BY chi2 DESC, term LIMIT 20""",
    {8: "mean_label chi2 log_odds"},
)
def txt_chi2_terms(t):
    return terms.top_chi2(scores(t, (1, 1), 2000), 20)


@query(
    "txt_log_odds",
    f"""SELECT *, len(string_split(term, ' ')) AS words, CASE WHEN log_odds > 0 THEN 'positive' ELSE 'negative' END AS direction,
               row_number() OVER (PARTITION BY len(string_split(term, ' ')), log_odds > 0 ORDER BY chi2 DESC, term) AS rank
        FROM {scores_sql((1, 2), 3000)} WHERE log_odds <> 0 QUALIFY rank <= 10""",
    {8: "mean_label chi2 log_odds"},
)
def txt_log_odds(t):
    return terms.top_log_odds(scores(t, (1, 2), 3000), 10)


@query(
    "txt_top_tfidf_class",
    f"""SELECT y::BIGINT AS y, term, mean_weight, row_number() OVER (PARTITION BY y ORDER BY mean_weight DESC, term) AS rank FROM (
          SELECT w.y, term, round(sum(weight) / (SELECT count(*) FROM {ROWS_SQL} r WHERE r.y = w.y), 10) AS mean_weight
          FROM {weights_sql(1000)} w GROUP BY w.y, term) QUALIFY rank <= 15""",
    {8: "mean_weight"},
)
def txt_top_tfidf_class(t):
    sizes = rows(t).groupBy("y").agg(ag.rows().alias("rows"))
    return terms.top_tfidf_per_class(weights(t, 1000), sizes, "y", 15)


@query(
    "txt_top_bigrams",
    f"""SELECT y::BIGINT AS y, term, n, rank, n / sqrt(sum(n * n) OVER (PARTITION BY y)) AS weight FROM (
          SELECT y, term, count(*) AS n, row_number() OVER (PARTITION BY y ORDER BY count(*) DESC, term) AS rank FROM {grams_sql((2, 2))} GROUP BY y, term
          QUALIFY rank <= 10)""",
    {8: "weight"},
)
def txt_top_bigrams(t):
    return terms.top_bigrams(rows(t), "text", "y", STOP, 10)


@query(
    "txt_wordcloud_freq",
    f"""SELECT y::BIGINT AS y, term, n, rank, n / max(n) OVER (PARTITION BY y) AS weight FROM (
          SELECT y, term, count(*) AS n, row_number() OVER (PARTITION BY y ORDER BY count(*) DESC, term) AS rank FROM {grams_sql((1, 1))} GROUP BY y, term
          QUALIFY rank <= 100)""",
    {8: "weight"},
)
def txt_wordcloud_freq(t):
    return terms.cloud_frequencies(rows(t), "text", "y", STOP, 100)


@query("txt_daily_volume", "SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1")
def txt_daily_volume(t):
    return ag.grouped(t.events, [F.to_date("ts").alias("day")], n=ag.rows())


@query(
    "txt_feature_block",
    rf"""SELECT doc_id, length(text) AS text_len, len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')) AS word_count,
               contains(text, 'http')::BIGINT AS has_url, contains(text, '?')::BIGINT AS has_question, contains(text, '!')::BIGINT AS has_exclaim,
               regexp_matches(text, '{EMOJI_SQL}')::BIGINT AS has_emoji, starts_with(text, '@')::BIGINT AS has_mention,
               length(regexp_replace(text, '\P{{Lu}}', '', 'g')) / greatest(length(text), 1) AS caps_ratio FROM documents""",
    {8: "caps_ratio"},
)
def txt_feature_block(t):
    return t.spread("documents").select("doc_id", *tx.feature_block("text"))
