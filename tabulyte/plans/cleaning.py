"""Projections, filters, cleaning and encodings over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabulyte.operators import clean, encode
from tabulyte.operators.ordering import quantiles
from tabulyte.plans.registry import query


@query("proj_binary_label", "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, CAST(l_returnflag = 'R' AS BIGINT) AS label FROM lineitem")
def proj_binary_label(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", clean.equals_flag("l_returnflag", "R").alias("label"))


@query("proj_label_normalised", "SELECT c_custkey, CAST(lower(trim('  ' || c_mktsegment || ' ')) = 'building' AS BIGINT) AS label FROM customer")
def proj_label_normalised(t):
    padded = t.customer.withColumn("segment", F.concat(F.lit("  "), "c_mktsegment", F.lit(" ")))
    return padded.select("c_custkey", clean.normalised_flag("segment", "building").alias("label"))


@query(
    "proj_arith",
    """SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber,
              (l_extendedprice + l_extendedprice * (1 - l_discount)) / 2 AS amount,
              l_extendedprice - l_extendedprice * (1 - l_discount) AS net FROM lineitem""",
    {6: "amount net"},
)
def proj_arith(t):
    debit, credit = F.col("l_extendedprice"), F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", ((debit + credit) / 2).alias("amount"), (debit - credit).alias("net")
    )


@query("proj_drop_cols", "SELECT p_partkey, p_brand, p_retailprice FROM part")
def proj_drop_cols(t):
    return t.part.drop("p_name", "p_type", "p_size", "absent")


@query("filter_eq", "SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT'")
def filter_eq(t):
    return t.orders.filter(F.col("o_orderpriority") == "1-URGENT").select("o_orderkey")


@query(
    "filter_and",
    """SELECT o_orderkey FROM orders
       WHERE (o_orderstatus = 'F' AND o_orderpriority = '2-HIGH') OR o_totalprice < 5000 OR o_totalprice > 400000""",
)
def filter_and(t):
    both = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "2-HIGH")
    outside = (F.col("o_totalprice") < 5000) | (F.col("o_totalprice") > 400000)
    return t.orders.filter(both | outside).select("o_orderkey")


@query("filter_isin", "SELECT p_partkey FROM part WHERE p_type IN ('PROMO', 'SMALL')")
def filter_isin(t):
    return t.part.filter(F.col("p_type").isin("PROMO", "SMALL")).select("p_partkey")


@query(
    "filter_date_range",
    "SELECT o_orderkey FROM orders WHERE o_orderdate >= DATE '1997-01-01' AND o_orderdate < DATE '1998-07-01'",
)
def filter_date_range(t):
    d = F.col("o_orderdate")
    return t.orders.filter(
        (d >= F.expr("TIMESTAMP_NTZ'1997-01-01'")) & (d < F.expr("TIMESTAMP_NTZ'1998-07-01'"))
    ).select("o_orderkey")


@query(
    "filter_median_split",
    "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < (SELECT median(c_acctbal) FROM customer)",
)
def filter_median_split(t):
    mid = quantiles(t.customer, "c_acctbal", {"mid": 0.5}).scalar()
    return t.customer.select("c_custkey", "c_acctbal").filter(F.col("c_acctbal") < mid)


@query(
    "proj_map_values",
    "SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 0 WHEN 'P' THEN 1 WHEN 'F' THEN 2 END::BIGINT AS code FROM orders",
)
def proj_map_values(t):
    return t.orders.select("o_orderkey", clean.map_values("o_orderstatus", {"O": 0, "P": 1, "F": 2}).alias("code"))


@query(
    "proj_case",
    "SELECT o_orderkey, CASE WHEN o_orderdate < DATE '1998-01-01' THEN 'before' ELSE 'after' END AS period FROM orders",
)
def proj_case(t):
    return t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderdate") < F.expr("TIMESTAMP_NTZ'1998-01-01'"), "before").otherwise("after").alias("period"),
    )


@query("clean_to_numeric", "SELECT event_id, TRY_CAST(regexp_replace(props, '[^0-9]', '', 'g') AS DOUBLE) AS k, TRY_CAST(event_type AS DOUBLE) AS bad FROM events")
def clean_to_numeric(t):
    return t.events.select(
        "event_id",
        clean.to_number(F.regexp_replace("props", "[^0-9]", "")).alias("k"),
        clean.to_number("event_type").alias("bad"),
    )


@query(
    "clean_numeric_tokens",
    """SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS bal FROM customer""",
    {2: "bal"},
)
def clean_numeric_tokens(t):
    text = t.customer.select(
        "c_custkey",
        F.when(F.col("c_acctbal") < -500, "ND").when(F.col("c_acctbal") < 0, " N/A ")
        .otherwise(F.format_number("c_acctbal", 2)).alias("bal"),
    )
    return text.select("c_custkey", clean.number_from_tokens("bal").alias("bal"))


@query(
    "clean_to_datetime",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS d FROM orders""",
)
def clean_to_datetime(t):
    text = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", "not a date")
        .when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "MM/dd/yyyy"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("d"),
    )
    return text.select("o_orderkey", F.to_date(clean.to_timestamp_or_null("d")).alias("d"))


@query(
    "clean_tweet_date",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL
              ELSE date_trunc('second', ts) + INTERVAL 8 HOUR END AS ts FROM events""",
)
def clean_tweet_date(t):
    text = t.events.select(
        "event_id",
        F.when(F.col("event_type") == "error", "never")
        .otherwise(F.concat(F.date_format("ts", "E MMM dd HH:mm:ss"), F.lit(" PST "), F.date_format("ts", "yyyy")))
        .alias("d"),
    )
    parsed = clean.zoned_date("d").cast("timestamp")
    return text.select("event_id", F.to_timestamp_ntz(F.date_format(parsed, "yyyy-MM-dd HH:mm:ss")).alias("ts"))


LABELLED = "(SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id))"


def labelled(t):
    return t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")


@query(
    "clean_dropna",
    f"SELECT doc_id, lang, quality::BIGINT AS quality, toxic::BIGINT AS toxic FROM {LABELLED} WHERE quality IS NOT NULL AND toxic IS NOT NULL",
)
def clean_dropna(t):
    kept = clean.drop_nulls(labelled(t), "all", ["quality", "toxic"])
    return clean.drop_nulls(clean.drop_nulls(kept, "any", ["quality"]))


@query(
    "clean_fill_const",
    f"SELECT doc_id, coalesce(quality, 0)::BIGINT AS quality, coalesce(toxic, 0)::BIGINT AS toxic FROM {LABELLED}",
)
def clean_fill_const(t):
    return clean.fill_const(labelled(t).drop("lang"), 0, ["quality", "toxic"])


HOLES = """(SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS a,
                   CASE WHEN c_acctbal < 5000 THEN c_acctbal END AS b,
                   CASE WHEN c_acctbal >= 100 THEN c_mktsegment END AS g FROM customer)"""


def holes(t):
    bal = F.col("c_acctbal")
    return t.customer.select(
        "c_custkey",
        F.when(bal >= 0, bal).alias("a"),
        F.when(bal < 5000, bal).alias("b"),
        F.when(bal >= 100, F.col("c_mktsegment")).alias("g"),
    )


@query(
    "clean_fill_stat",
    f"""SELECT c_custkey, coalesce(a, (SELECT median(a) FROM {HOLES})) AS a,
               coalesce(b, (SELECT avg(b) FROM {HOLES})) AS b,
               coalesce(g, (SELECT g FROM {HOLES} WHERE g IS NOT NULL GROUP BY g ORDER BY count(*) DESC, g LIMIT 1)) AS g
        FROM {HOLES}""",
    {5: "a b"},
)
def clean_fill_stat(t):
    df = clean.fill_stat(holes(t), ["a"], "median")
    df = clean.fill_stat(df, ["b"], "mean")
    return clean.fill_stat(df, ["g"], "mode")


@query(
    "clean_inf",
    "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, CASE WHEN l_tax > 0 THEN l_discount / l_tax END AS ratio FROM lineitem",
    {6: "ratio"},
)
def clean_inf(t):
    raw = F.when(F.col("l_tax") > 0, F.col("l_discount") / F.col("l_tax")).otherwise(
        F.when(F.col("l_discount") > 0, F.lit(float("inf"))).otherwise(F.lit(float("nan")))
    )
    return t.lineitem.select("l_orderkey", "l_linenumber", raw.alias("ratio")).withColumn(
        "ratio", clean.infinite_to_null("ratio")
    )


@query(
    "clean_dedup",
    """WITH p AS (SELECT p_brand, p_type, p_size FROM part)
       SELECT (SELECT count(*) FROM p) AS "rows", count(*) AS distinct_rows,
              (SELECT count(*) FROM p) - count(*) AS duplicates FROM (SELECT DISTINCT * FROM p)""",
)
def clean_dedup(t):
    return clean.count_duplicates(t.part.select("p_brand", "p_type", "p_size"))


@query(
    "clean_null_audit",
    f"""SELECT feature, nulls, nulls * 100.0 / n AS null_pct FROM (
          SELECT 'doc_id' AS feature, count(*) - count(doc_id) AS nulls, count(*) AS n FROM {LABELLED} UNION ALL
          SELECT 'lang', count(*) - count(lang), count(*) FROM {LABELLED} UNION ALL
          SELECT 'quality', count(*) - count(quality), count(*) FROM {LABELLED} UNION ALL
          SELECT 'toxic', count(*) - count(toxic), count(*) FROM {LABELLED})""",
    {4: "null_pct"},
)
def clean_null_audit(t):
    return clean.null_audit(labelled(t))


@query("clean_drop_constant", "SELECT s_suppkey, s_acctbal FROM supplier")
def clean_drop_constant(t):
    df = t.supplier.select("s_suppkey", "s_acctbal", F.lit(8).alias("hours"), F.lit("Y").alias("over"))
    return clean.drop_constant(df, ["s_acctbal", "hours", "over"])


@query(
    "enc_label",
    """SELECT p_partkey, (dense_rank() OVER (ORDER BY p_brand) - 1)::BIGINT AS brand_code,
              (dense_rank() OVER (ORDER BY p_type) - 1)::BIGINT AS type_code FROM part""",
)
def enc_label(t):
    df = t.part.select("p_partkey", "p_brand", "p_type")
    for col, name in (("p_brand", "brand_code"), ("p_type", "type_code")):
        df = encode.encode(df, col, encode.label_codes(df, col), name)
    return df.select("p_partkey", "brand_code", "type_code")


@query(
    "enc_factorize",
    """WITH f AS (SELECT p_brand, min(p_partkey) AS first FROM part GROUP BY p_brand)
       SELECT p_partkey, code FROM part JOIN (
         SELECT p_brand, (row_number() OVER (ORDER BY first) - 1)::BIGINT AS code FROM f) USING (p_brand)""",
)
def enc_factorize(t):
    codes = encode.factorize_codes(t.part, "p_brand", ["p_partkey"])
    return encode.encode(t.part.select("p_partkey", "p_brand"), "p_brand", codes, "code").select("p_partkey", "code")


@query(
    "bin_cut",
    """SELECT band, band_ord, count(*) AS n FROM (
         SELECT CASE WHEN l_quantity > 1 AND l_quantity <= 10 THEN 'low' WHEN l_quantity > 10 AND l_quantity <= 25 THEN 'mid'
                     WHEN l_quantity > 25 AND l_quantity <= 50 THEN 'high' END AS band,
                CASE WHEN l_quantity > 1 AND l_quantity <= 10 THEN 0 WHEN l_quantity > 10 AND l_quantity <= 25 THEN 1
                     WHEN l_quantity > 25 AND l_quantity <= 50 THEN 2 END::BIGINT AS band_ord FROM lineitem)
       GROUP BY ALL""",
)
def bin_cut(t):
    edges = [1, 10, 25, 50]
    return (
        t.lineitem.select(
            clean.cut("l_quantity", edges, ["low", "mid", "high"]).alias("band"),
            clean.cut_order("l_quantity", edges).alias("band_ord"),
        )
        .groupBy("band", "band_ord")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "bin_round",
    """SELECT o_orderkey, round_even(o_totalprice / 10, 0) * 10 AS near_10,
              round_even(o_totalprice / 50, 0) * 50 AS near_50 FROM orders""",
)
def bin_round(t):
    return t.orders.select(
        "o_orderkey",
        clean.round_to("o_totalprice", 10).alias("near_10"),
        clean.round_to("o_totalprice", 50).alias("near_50"),
    )


DAY_LABELS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday", "Holiday"]


@query(
    "order_categorical",
    """WITH l AS (SELECT unnest(['Monday','Tuesday','Wednesday','Thursday','Friday','Saturday','Sunday','Holiday']) AS day,
                         unnest(range(8)) AS day_ord),
            g AS (SELECT dayname(o_orderdate) AS day, count(*) AS n FROM orders GROUP BY 1)
       SELECT l.day, l.day_ord, coalesce(g.n, 0) AS n FROM l LEFT JOIN g USING (day)""",
)
def order_categorical(t):
    groups = t.orders.groupBy(F.date_format("o_orderdate", "EEEE").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return encode.in_label_order(groups, "day", DAY_LABELS, {"n": 0})
