"""Text, date and numeric functions over the given tables."""

from __future__ import annotations

from pyspark.sql import Window as W, functions as F

from tabulyte.functions import dates, maths, text as tx
from tabulyte.operators import aggregates as ag
from tabulyte.plans.registry import query
from tabulyte.sources.sinks import report_lines

EMOJI_SQL = r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F1E0}-\x{1F1FF}]"


@query("str_length", "SELECT doc_id, length(text) AS n FROM documents")
def str_length(t):
    return t.documents.select("doc_id", F.length("text").alias("n"))


@query(
    "str_word_count",
    r"SELECT doc_id, len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')) AS n FROM documents",
)
def str_word_count(t):
    return t.spread("documents").select("doc_id", tx.word_count("text").alias("n"))


@query(
    "str_contains",
    """SELECT doc_id, contains(text, 'http') AS link, contains(text, '?') AS question,
              regexp_matches(text, '[0-9]{4}') AS number FROM documents""",
)
def str_contains(t):
    return t.documents.select(
        "doc_id", tx.has("text", "http", literal=True).alias("link"),
        tx.has("text", "?", literal=True).alias("question"), tx.has("text", "[0-9]{4}").alias("number"),
    )


@query("str_startswith", "SELECT conv_id, turn, starts_with(text, 'T') AS flag FROM conversations")
def str_startswith(t):
    return t.conversations.select("conv_id", "turn", tx.starts_with("text", "T").alias("flag"))


@query("str_emoji", rf"SELECT page_id, regexp_matches(html, '{EMOJI_SQL}') AS flag FROM pages")
def str_emoji(t):
    return t.pages.select("page_id", tx.has_emoji("html").alias("flag"))


@query(
    "str_caps_ratio",
    r"SELECT doc_id, length(regexp_replace(text, '\P{Lu}', '', 'g')) / greatest(length(text), 1) AS ratio FROM documents",
    {8: "ratio"},
)
def str_caps_ratio(t):
    return t.spread("documents").select("doc_id", tx.caps_ratio("text").alias("ratio"))


STRIPPED_SQL = r"regexp_replace(regexp_replace(lower(text), 'http\S+|www\.\S+', '', 'g'), '@[A-Za-z0-9_]+', '', 'g')"
CLEAN_SQL = rf"trim(regexp_replace(regexp_replace({STRIPPED_SQL}, '[^a-z\s]', ' ', 'g'), '\s+', ' ', 'g'))"


@query("str_clean_space", f"SELECT doc_id, {CLEAN_SQL} AS clean FROM documents")
def str_clean_space(t):
    return t.spread("documents").select("doc_id", tx.clean_spaced("text").alias("clean"))


@query(
    "str_clean_delete",
    rf"SELECT doc_id, trim(regexp_replace(regexp_replace({STRIPPED_SQL}, '[^a-z\s]', '', 'g'), '\s+', ' ', 'g')) AS clean FROM documents",
)
def str_clean_delete(t):
    return t.spread("documents").select("doc_id", tx.clean_deleted("text").alias("clean"))


@query("str_trim_split_part", "SELECT o_orderkey, trim(string_split(o_orderpriority, '-')[-1]) AS part FROM orders")
def str_trim_split_part(t):
    return t.orders.select("o_orderkey", tx.last_part("o_orderpriority", "-").alias("part"))


@query("str_prefix", "SELECT c_custkey, substr(c_name, 1, 12) AS short FROM customer")
def str_prefix(t):
    return t.customer.select("c_custkey", F.substring("c_name", 1, 12).alias("short"))


@query("str_replace", "SELECT p_partkey, replace(p_brand, 'Brand#', 'B') AS b, regexp_replace(p_name, '[aeiou]', '_', 'g') AS m FROM part")
def str_replace(t):
    return t.part.select(
        "p_partkey", F.replace("p_brand", F.lit("Brand#"), F.lit("B")).alias("b"),
        F.regexp_replace("p_name", "[aeiou]", "_").alias("m"),
    )


@query("str_concat_prefix", "SELECT vec_id, 'Profile ' || label::VARCHAR AS profile FROM embeddings")
def str_concat_prefix(t):
    return t.embeddings.select("vec_id", F.concat(F.lit("Profile "), F.col("label").cast("string")).alias("profile"))


@query(
    "str_first_digit",
    """SELECT d AS digit, count(*) AS n FROM (
         SELECT CASE WHEN regexp_matches(substr(c_acctbal::VARCHAR, 1, 1), '^[0-9]$') THEN substr(c_acctbal::VARCHAR, 1, 1) END AS d
         FROM customer) GROUP BY d""",
)
def str_first_digit(t):
    return t.customer.select(tx.first_digit("c_acctbal").alias("digit")).groupBy("digit").agg(ag.rows().alias("n"))


@query(
    "str_join_group",
    r"""SELECT source, token, count(*) AS n FROM (
          SELECT source, unnest(regexp_split_to_array(text, '\s+')) AS token FROM documents)
        WHERE token <> '' GROUP BY ALL""",
)
def str_join_group(t):
    tokens = t.spread("documents").select("source", F.explode(tx.words("text")).alias("token"))
    return tokens.groupBy("source", "token").agg(ag.rows().alias("n"))


@query(
    "str_format",
    """SELECT format('    {:<30} -> {:>5}  ({:>7.3f}%)', p_type, n, pct) AS value FROM (
         SELECT p_type, count(*) AS n, count(*) * 100.0 / (SELECT count(*) FROM part) AS pct FROM part GROUP BY 1)""",
)
def str_format(t):
    return report_lines(ag.frequencies(t.part, "p_type"), "    %-30s -> %5d  (%7.3f%%)", "p_type", "n", "pct")


@query(
    "sig_stars",
    """SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber,
              CASE WHEN l_tax < 0.001 THEN '***' WHEN l_tax < 0.01 THEN '**' WHEN l_tax < 0.05 THEN '*' ELSE 'ns' END AS mark
       FROM lineitem""",
)
def sig_stars(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", tx.stars("l_tax").alias("mark"))


@query(
    "date_parts",
    """SELECT event_id, month(ts) AS month, year(ts) AS year, quarter(ts) AS quarter, hour(ts) AS hour, week(ts) AS week FROM events""",
)
def date_parts(t):
    return t.events.select("event_id", *[c.alias(n) for n, c in dates.parts("ts").items()])


@query(
    "date_names",
    "SELECT o_orderkey, dayname(o_orderdate) AS weekday, monthname(o_orderdate) AS month_name, dayofweek(o_orderdate) IN (0, 6) AS weekend FROM orders",
)
def date_names(t):
    return t.orders.select("o_orderkey", *[c.alias(n) for n, c in dates.names("o_orderdate").items()])


@query("date_dow", "SELECT o_orderkey, isodow(o_orderdate) - 1 AS dow FROM orders")
def date_dow(t):
    return t.orders.select("o_orderkey", dates.monday_zero("o_orderdate").alias("dow"))


@query("date_format", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS d FROM orders")
def date_format(t):
    return t.orders.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("d"))


@query("date_trunc_day", "SELECT event_id, CAST(ts AS DATE) AS day FROM events")
def date_trunc_day(t):
    return t.events.select("event_id", F.to_date("ts").alias("day"))


@query(
    "date_future_spine",
    "SELECT CAST(unnest(generate_series(max(o_orderdate) + INTERVAL 1 DAY, max(o_orderdate) + INTERVAL 30 DAY, INTERVAL 1 DAY)) AS DATE) AS day FROM orders",
)
def date_future_spine(t):
    return dates.future_spine(t.orders, "o_orderdate", 30)


@query(
    "math_log",
    "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, ln(l_extendedprice) AS a, log10(l_extendedprice) AS b, ln(1 + l_quantity) AS c FROM lineitem",
    {8: "a b c"},
)
def math_log(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", F.ln("l_extendedprice").alias("a"),
        F.log10("l_extendedprice").alias("b"), F.log1p("l_quantity").alias("c"),
    )


@query("math_neglog_p", "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, -log10(greatest(l_discount, 1e-300)) AS score FROM lineitem", {8: "score"})
def math_neglog_p(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", maths.neglog10("l_discount").alias("score"))


@query(
    "math_sqrt_exp_abs",
    """SELECT c_custkey, sqrt(abs(c_acctbal)) AS a, exp(c_acctbal / 1000) AS b, abs(c_acctbal) AS c,
              least(greatest(c_acctbal, 0.0), 5000.0) AS d FROM customer""",
    {6: "a b", 2: "c d"},
)
def math_sqrt_exp_abs(t):
    bal = F.col("c_acctbal")
    return t.customer.select(
        "c_custkey", F.sqrt(F.abs(bal)).alias("a"), F.exp(bal / 1000).alias("b"), F.abs(bal).alias("c"),
        maths.clip("c_acctbal", 0.0, 5000.0).alias("d"),
    )


@query(
    "math_grid",
    """SELECT i, (i + 1) / 100 AS x, (SELECT count(*) FROM lineitem WHERE l_discount * 9 >= (i + 1) / 100) AS n
       FROM range(99) r(i)""",
)
def math_grid(t):
    points = maths.grid(t.spark, 1, 99, 99).select("i", (F.col("x") / 100).alias("x"))
    reached = t.lineitem.groupBy(maths.hundredth_below(F.col("l_discount") * 9).alias("h")).agg(ag.rows().alias("n"))
    from_here = W.orderBy(F.desc("i")).rowsBetween(W.unboundedPreceding, 0)
    at = reached.groupBy((F.least("h", F.lit(99)) - 1).alias("i")).agg(F.sum("n").alias("n"))
    return points.join(at, "i", "left").select(
        "i", "x", F.coalesce(F.sum("n").over(from_here), F.lit(0)).alias("n")
    )
