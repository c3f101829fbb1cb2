"""Scans, sinks and schema operators over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabulyte.plans.registry import query
from tabulyte.session import landing_path
from tabulyte.sources import files, schema, sinks

CUSTOMER = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


def landed_csv(t, df, label, header=True, encoding="UTF-8"):
    path = landing_path(t.spark, label)
    df.write.options(header=header, encoding=encoding, escape='"', ignoreLeadingWhiteSpace=False,
                     ignoreTrailingWhiteSpace=False).csv(path)
    return path


@query("src_csv", "SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) c_nationkey, c_acctbal, c_mktsegment FROM customer")
def src_csv(t):
    return files.read_csv(t.spark, landed_csv(t, t.customer, "customer"), CUSTOMER)


@query("src_csv_dates", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_totalprice FROM orders")
def src_csv_dates(t):
    rows = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("o_orderdate"), "o_totalprice")
    path = landed_csv(t, rows, "orders")
    return files.read_csv(t.spark, path, "o_orderkey bigint, o_orderdate date, o_totalprice double")


LATIN = r"[^\x20-\x7E\xA0-\xFF]"


@query(
    "src_csv_headerless",
    rf"SELECT doc_id, lang, source, regexp_replace(text, '{LATIN}', ' ', 'g') AS text FROM documents",
)
def src_csv_headerless(t):
    rows = t.documents.select(
        "doc_id", "lang", "source", F.regexp_replace("text", LATIN, " ").alias("text")
    )
    path = landed_csv(t, rows, "documents", header=False, encoding="ISO-8859-1")
    return files.read_csv_headerless(t.spark, path, "doc_id bigint, lang string, source string, text string")


@query(
    "src_csv_badlines",
    """SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name,
              CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment END AS segment
       FROM customer WHERE c_acctbal >= 0""",
)
def src_csv_badlines(t):
    full = F.concat_ws(",", "c_custkey", F.concat(F.lit('"'), "c_name", F.lit('"')), "c_mktsegment")
    line = (
        F.when(F.col("c_acctbal") < 0, F.concat(full, F.lit(",surplus,fields")))
        .when(F.col("c_mktsegment") == "BUILDING", F.concat_ws(",", "c_custkey", "c_name"))
        .otherwise(full)
    )
    path = landing_path(t.spark, "uneven-lines")
    t.customer.select(line.alias("value")).write.text(path)
    return files.read_csv_skip_long_lines(t.spark, path, ["id", "name", "segment"])


@query(
    "src_csv_slice",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5000 OFFSET 800",
)
def src_csv_slice(t):
    return files.read_slice(t.orders.select("o_orderkey", "o_totalprice"), ["o_orderkey"], 800, 5000)


@query("src_excel", "SELECT p_partkey, p_name, p_brand, CAST(p_size AS BIGINT) AS p_size FROM part")
def src_excel(t):
    sheet = landed_csv(t, t.part.select("p_partkey", "p_name", "p_brand", "p_size"), "sheet")
    return files.read_csv(t.spark, sheet, "p_partkey bigint, p_name string, p_brand string, p_size int")


@query("src_remote_csv", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def src_remote_csv(t):
    landed = landed_csv(t, t.supplier.select("s_suppkey", "s_name", "s_acctbal"), "fetched")
    return files.read_csv(t.spark, landed, "s_suppkey bigint, s_name string, s_acctbal double")


@query("src_bundled_dataset", "SELECT doc_id, CAST(1 - toxic AS BIGINT) AS label FROM labels")
def src_bundled_dataset(t):
    return t.labels.select("doc_id", (1 - F.col("toxic")).alias("label"))


@query("src_first_existing", "SELECT count(*) AS n FROM orders")
def src_first_existing(t):
    path = files.first_existing(t.spark, [f"{t.folder}/orders_v2.parquet", f"{t.folder}/orders.parquet"])
    return t.spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n"))


@query(
    "src_report_kv",
    """SELECT count(*) AS samples, round(avg(l_discount) * 5, 3) AS auc,
              round(avg(l_tax) * 5, 3) AS avg_precision
       FROM lineitem GROUP BY l_returnflag""",
)
def src_report_kv(t):
    stats = t.lineitem.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.avg("l_discount").alias("d"), F.avg("l_tax").alias("x")
    )
    text = F.format_string(
        "REPORT %s\n  total customers: %,d\n  Auc = %.6f\n  Average Precision:  %.6f\n",
        "l_returnflag", "n", F.col("d") * 5, F.col("x") * 5,
    )
    path = landing_path(t.spark, "reports")
    stats.select("l_returnflag", text.alias("value")).write.partitionBy("l_returnflag").text(path)
    return files.read_report_metrics(t.spark, f"{path}/*").drop("report")


@query(
    "sink_text_report",
    """SELECT format('{:<20}|{:>10}', c_mktsegment, n) AS value
       FROM (SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1)""",
)
def sink_text_report(t):
    counts = t.customer.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    lines = sinks.report_lines(counts, "%-20s|%10d", "c_mktsegment", "n", order="c_mktsegment")
    return t.spark.read.text(sinks.write_text_report(lines, landing_path(t.spark, "report")))


@query(
    "sink_result_tables",
    "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL",
)
def sink_result_tables(t):
    table = t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))
    return t.spark.read.parquet(sinks.write_result_table(table, landing_path(t.spark, "result")))


@query("schema_strip", 'SELECT s_suppkey AS "key", s_name AS "name" FROM supplier')
def schema_strip(t):
    padded = t.supplier.select(F.col("s_suppkey").alias(" key"), F.col("s_name").alias("name  "))
    return schema.strip_names(padded)


@query("schema_rename_pos", "SELECT r_regionkey::BIGINT AS id, r_name AS label FROM region")
def schema_rename_pos(t):
    return schema.rename_positional(t.region, ["id", "label"])


@query("schema_rename_map", "SELECT n_nationkey::BIGINT AS id, n_name AS nation, n_regionkey::BIGINT AS n_regionkey FROM nation")
def schema_rename_map(t):
    return schema.rename_map(t.nation, {"n_nationkey": "id", "n_name": "nation", "absent": "x"})


@query(
    "schema_target_find",
    """SELECT CAST(CASE WHEN regexp_matches(CASE WHEN o_orderstatus = 'F' THEN 'Yes' ELSE 'No' END,
                                            '(?i)yes|true|1|bankrupt') THEN 1 ELSE 0 END AS BIGINT) AS target,
              count(*) AS n FROM orders GROUP BY 1""",
)
def schema_target_find(t):
    labelled = t.orders.select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "F", "Yes").otherwise("No").alias("Order Status")
    )
    return schema.binary_target(labelled).groupBy("target").agg(F.count(F.lit(1)).alias("n"))


@query(
    "schema_dtype_roles",
    """SELECT 'numeric' AS role, c AS feature, n FROM (
         UNPIVOT (SELECT count(l_orderkey) l_orderkey, count(l_partkey) l_partkey, count(l_suppkey) l_suppkey,
                         count(l_linenumber) l_linenumber, count(l_quantity) l_quantity,
                         count(l_extendedprice) l_extendedprice, count(l_discount) l_discount,
                         count(l_tax) l_tax FROM lineitem) ON COLUMNS(*) INTO NAME c VALUE n)
       UNION ALL
       SELECT 'categorical', c, n FROM (
         UNPIVOT (SELECT count(l_returnflag) l_returnflag, count(l_linestatus) l_linestatus FROM lineitem)
         ON COLUMNS(*) INTO NAME c VALUE n)""",
)
def schema_dtype_roles(t):
    found = schema.roles(t.lineitem)
    role_of = {c: role for role, cols in found.items() for c in cols}
    counts = t.lineitem.agg(*[F.count(c).alias(c) for c in role_of])
    long = counts.unpivot([], list(role_of), "feature", "n")
    pairs = [F.lit(x) for kv in role_of.items() for x in kv]
    return long.select(F.create_map(*pairs)[F.col("feature")].alias("role"), "feature", "n")


@query("schema_col_exclude", "SELECT o_custkey, o_totalprice FROM orders")
def schema_col_exclude(t):
    return schema.features(t.orders, ["o_orderkey", "o_orderstatus", "o_orderdate", "o_orderpriority", "absent"])
