"""Registered queries: scans (S1–S3, S6–S8), quality (V2–V6), imputation."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlens.operators import quality as Q
from leadlens.operators.ordered import row_numbers
from leadlens.plans.oracle_views import with_training
from leadlens.plans.registry import register
from leadlens.session import checkpoint_dir
from leadlens.sources import csv_io, profile, tables
from leadlens.sources import testviews as TV

NUM = TV.NUMERIC_FEATURES
CAT = TV.CATEGORICAL_FEATURES


@register("s1_scan_lowercase", "SELECT * FROM customer")
def q_scan(spark, sf_dir):
    return tables.read_table(spark, f"{sf_dir}/customer.parquet")


@register("s2_sql_scan", "SELECT o_orderpriority, CAST(count(*) AS BIGINT) AS n_orders, "
          "sum(o_totalprice) AS total_price FROM orders GROUP BY o_orderpriority")
def q_sql_scan(spark, sf_dir):
    spark.read.parquet(f"{sf_dir}/orders.parquet").createOrReplaceTempView("leadlens_orders")
    return tables.query(spark, "SELECT o_orderpriority, count(*) AS N_ORDERS, "
                               "sum(o_totalprice) AS TOTAL_PRICE FROM leadlens_orders "
                               "GROUP BY o_orderpriority")


@register("s3_o3_scan_limit", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 10")
def q_scan_limit(spark, sf_dir):
    return tables.scan_limit(spark.read.parquet(f"{sf_dir}/orders.parquet"), 10, ["o_orderkey"])


PROFILED = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
            "embeddings", "pages", "benchmark", "labels", "conversations")
_DTYPE = ("CASE typeof({c}) WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' "
          "WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' "
          "WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'FLOAT[]' THEN 'array<float>' ELSE lower(typeof({c})) END")


def _profile_sql(duck_columns: dict[str, list[str]]) -> str:
    parts = []
    for t, cols in duck_columns.items():
        for i, c in enumerate(cols):
            parts.append(
                f"SELECT '{t}' AS table_name, CAST((SELECT count(*) FROM {t}) AS BIGINT) AS row_count, "
                f"{i} AS ordinal, '{c}' AS column_name, "
                f"(SELECT {_DTYPE.format(c=c)} FROM {t} LIMIT 1) AS data_type, "
                f"CAST((SELECT count(*) FROM {t} WHERE {c} IS NULL) AS BIGINT) AS null_count")
    return " UNION ALL ".join(parts)


# Column lists of the profiled driver tables, in file order.
_PROFILE_COLUMNS = {
    "region": ["r_regionkey", "r_name"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
               "o_orderpriority"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                 "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                 "l_shipdate"],
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
    "documents": ["doc_id", "text", "lang", "source", "n_chars"],
    "embeddings": ["vec_id", "embedding", "label"],
    "pages": ["page_id", "url", "html"],
    "benchmark": ["item_id", "text"],
    "labels": ["doc_id", "quality", "toxic"],
    "conversations": ["conv_id", "turn", "role", "text"],
}


@register("s8_table_profile", _profile_sql(_PROFILE_COLUMNS))
def q_profile(spark, sf_dir):
    return profile.profile_tables({t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in PROFILED})


#: What the sample rows are checked by: the columns of whole numbers, as text.
_WHOLE = {"region": ("r_regionkey",), "nation": ("n_nationkey", "n_regionkey"), "customer": ("c_custkey", "c_nationkey"),
          "supplier": ("s_suppkey", "s_nationkey"), "part": ("p_partkey", "p_size"), "orders": ("o_orderkey", "o_custkey"),
          "lineitem": ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"), "events": ("event_id", "user_id"),
          "documents": ("doc_id", "n_chars"), "embeddings": ("vec_id", "label"), "pages": ("page_id",), "benchmark": ("item_id",),
          "labels": ("doc_id", "quality", "toxic"), "conversations": ("conv_id", "turn")}


def _catalogue_sql() -> str:
    def one(t: str, whole: tuple[str, ...]) -> str:
        told = " || ':' || ".join(f"coalesce(CAST({c} AS VARCHAR), 'null')" for c in whole)
        return (f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) AS row_count, CAST({len(_PROFILE_COLUMNS[t])} AS INTEGER) AS n_columns, "
                f"(SELECT string_agg(told, ',') FROM (SELECT {told} AS told FROM (SELECT * FROM {t} ORDER BY ALL NULLS FIRST LIMIT 3))) AS sample")
    return " UNION ALL ".join(one(t, w) for t, w in _WHOLE.items())


@register("s8_catalogue", _catalogue_sql())
def q_catalogue(spark, sf_dir):
    """Every table that the folder holds, found by listing it, with its first rows in whole numbers."""
    def one(name, df):
        whole = [c for c, kind in df.dtypes if kind in ("int", "bigint")]
        told = F.transform("sample", lambda r: F.array_join(F.array(*[r[c].cast("string") for c in whole]), ":", "null"))
        return profile.summary(df, name).withColumn("sample", F.array_join(told, ","))

    return reduce(DataFrame.unionByName, [one(name, df) for name, df in profile.folder_tables(spark, sf_dir).items()])


def _training(spark, sf_dir):
    return TV.training_view(spark, sf_dir)


_CSV_ORACLE = with_training() + "SELECT " + ", ".join(
    [f"coalesce({c}, 0.0) AS {c}" for c in csv_io.FLOAT_FIELDS]
    + [f"CAST(coalesce({c}, 0) AS BIGINT) AS {c}" for c in csv_io.INT_FIELDS]
    + [f"coalesce({c}, '') AS {c}" for c in CAT]) + " FROM training"


@register("s6_csv_batch_roundtrip", _CSV_ORACLE)
def q_csv_roundtrip(spark, sf_dir):
    """Training rows written as CSV text by Spark, then parsed with the batch rules."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/csv/{spark.sparkContext.applicationId}/leads-{uuid.uuid4().hex}"
    (_training(spark, sf_dir).select(*csv_io.ALL_FIELDS)
     .write.mode("overwrite").option("header", True).csv(path))
    return csv_io.read_leads_csv(spark, path)


@register("v2_duplicate_rows", with_training() +
          "SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS duplicate_rows FROM ("
          f"SELECT count(*) AS c, {', '.join(['id', *NUM, *CAT, 'intent_label'])} FROM ("
          "SELECT * FROM training UNION ALL SELECT * FROM training WHERE id % 9 = 0 UNION ALL "
          "SELECT * FROM training WHERE id % 27 = 0) u GROUP BY ALL) g")
def q_duplicates(spark, sf_dir):
    """Every column counts; every ninth row stands there twice, every 27th three times."""
    t = _training(spark, sf_dir)
    return Q.duplicate_rows(t.unionByName(t.where(F.col("id") % 9 == 0)).unionByName(t.where(F.col("id") % 27 == 0)))


@register("s4_s5_written_and_loaded", with_training() + "SELECT * FROM training")
def q_written_and_loaded(spark, sf_dir):
    """The training table is written, read back and validated (V1 raises on an empty one)."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{spark.sparkContext.applicationId}/training-{uuid.uuid4().hex}"
    tables.write_table(_training(spark, sf_dir), path)
    df, report = tables.load_training(spark, path, list(NUM), list(CAT))
    if report["dtype_warnings"]:
        raise ValueError(f"unexpected column types: {report['dtype_warnings']}")
    return df


_TYPED = {"lead_score": "VARCHAR", "page_views": "VARCHAR", "industry": "INTEGER"}


@register("v1_v4_p8_schema", with_training() + " UNION ALL ".join(
    [f"SELECT 'numeric' AS finding, '{c}' AS column_name, count({c}) AS present FROM training"
     for c in ("id", *[c for c in NUM if c not in _TYPED], "industry", "intent_label")]
    + [f"SELECT 'warning' AS finding, '{c}' AS column_name, count({c}) AS present FROM training" for c in _TYPED]))
def q_schema(spark, sf_dir):
    """V4 and P8 on a training table with three columns of another type than declared; V1 passes."""
    t = _training(spark, sf_dir).withColumns({
        "lead_score": F.nanvl("lead_score", F.lit(None).cast("double")).cast("string"),
        "page_views": F.col("page_views").cast("string"), "industry": F.length("industry")})
    Q.check_shape(t)
    warned = [next(c for c in (*NUM, *CAT) if f"'{c}'" in w) for w in Q.dtype_warnings(t, NUM, CAT)]
    found = [("numeric", c) for c in Q.numeric_columns(t)] + [("warning", c) for c in warned]
    one = Q.missing_as_null(t).agg(*[F.count(c).alias(f"c{i}") for i, (_, c) in enumerate(found)])
    rows = ", ".join(f"'{k}', '{c}', c{i}" for i, (k, c) in enumerate(found))
    return one.selectExpr(f"stack({len(found)}, {rows}) AS (finding, column_name, present)")


@register("f17_categories", with_training() + "SELECT id, " + ", ".join(
    f"CASE WHEN lower(trim(coalesce({c}, 'missing'))) IN ('', 'nan', 'none') THEN 'missing' "
    f"ELSE lower(trim(coalesce({c}, 'missing'))) END AS {c}" for c in CAT) + " FROM training")
def q_categories(spark, sf_dir):
    """The categorical columns that are there, normalised."""
    from leadlens.functions.exprs import normalise_category
    from leadlens.plans.training import available

    t = _training(spark, sf_dir)
    found, missing = available(t, [*CAT, "no_such_column"])
    if missing != ["no_such_column"]:
        raise ValueError(f"missing columns: {missing}")
    return t.select("id", *[normalise_category(c).alias(c) for c in found])


_ALL = ["id", *NUM, *CAT, "intent_label"]


@register("v3_null_counts", with_training() + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS null_count "
    f"FROM training" for c in _ALL))
def q_nulls(spark, sf_dir):
    return Q.null_counts(_training(spark, sf_dir), _ALL)


def _iqr_sql() -> str:
    q = ", ".join(f"quantile_cont(CAST({c} AS DOUBLE), 0.25) AS {c}_q1, "
                  f"quantile_cont(CAST({c} AS DOUBLE), 0.75) AS {c}_q3" for c in NUM)
    cond = " OR ".join(
        f"coalesce({c} < q.{c}_q1 - 1.5 * (q.{c}_q3 - q.{c}_q1) "
        f"OR {c} > q.{c}_q3 + 1.5 * (q.{c}_q3 - q.{c}_q1), false)" for c in NUM)
    return with_training(f"q AS (SELECT {q} FROM training)") + \
        f"SELECT t.id, ({cond}) AS is_outlier FROM training t CROSS JOIN q"


@register("v5_iqr_outliers", _iqr_sql())
def q_outliers(spark, sf_dir):
    return Q.iqr_outliers(_training(spark, sf_dir), list(NUM)).select("id", "is_outlier")


def _violation_sql() -> str:
    parts = []
    for c, lo, hi in Q.RANGE_RULES:
        cond = f"{c} IS NULL" + (f" OR {c} < {lo}" if lo is not None else "") + \
               (f" OR {c} > {hi}" if hi is not None else "")
        parts.append(f"SELECT '{c}' AS rule, CAST(count(*) FILTER (WHERE {cond}) AS BIGINT) AS violations FROM training")
    for c in Q.REQUIRED:
        parts.append(f"SELECT '{c}' AS rule, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS violations FROM training")
    return with_training() + " UNION ALL ".join(parts)


@register("v6_range_violations", _violation_sql())
def q_violations(spark, sf_dir):
    return Q.violation_counts(_training(spark, sf_dir))


def _valid_sql() -> str:
    conds = []
    for c, lo, hi in Q.RANGE_RULES:
        conds.append(f"{c} IS NULL" + (f" OR {c} < {lo}" if lo is not None else "")
                     + (f" OR {c} > {hi}" if hi is not None else ""))
    conds += [f"{c} IS NULL" for c in Q.REQUIRED]
    bad = " OR ".join(f"({x})" for x in conds)
    return with_training() + (f"SELECT NOT ({bad}) AS is_valid, CAST(count(*) AS BIGINT) AS n "
                              f"FROM training GROUP BY 1")


@register("v6_valid_split", _valid_sql())
def q_valid_split(spark, sf_dir):
    return (Q.valid_flag(_training(spark, sf_dir)).groupBy("is_valid")
            .agg(F.count(F.lit(1)).alias("n")))


def _fill_sql(stat: str) -> str:
    cols = ", ".join(f"coalesce(CAST({c} AS DOUBLE), (SELECT {stat.format(c=c)} FROM training)) AS {c}"
                     for c in NUM)
    return with_training() + f"SELECT id, {cols}, intent_label FROM training"


@register("i1_fill_mean", _fill_sql("avg({c})"))
def q_fill_mean(spark, sf_dir):
    t = _training(spark, sf_dir).select("id", *NUM, "intent_label")
    return Q.fill_mean(t, list(NUM))


@register("i2_fill_median", _fill_sql("quantile_cont(CAST({c} AS DOUBLE), 0.5)"))
def q_fill_median(spark, sf_dir):
    t = _training(spark, sf_dir).select("id", *NUM, "intent_label")
    return Q.fill_median(t, list(NUM))


def _ffill_sql() -> str:
    cols = ", ".join(
        f"coalesce(last_value({c} IGNORE NULLS) OVER (ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
        f"first_value({c} IGNORE NULLS) OVER (ORDER BY id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS {c}"
        for c in [*NUM, *CAT])
    return with_training() + f"SELECT id, {cols} FROM training"


@register("i3_w2_ffill_bfill", _ffill_sql())
def q_ffill(spark, sf_dir):
    t = _training(spark, sf_dir).select("id", *NUM, *CAT)
    return Q.fill_ordered(t, "id", [*NUM, *CAT])


@register("w2_text_key_rows", """
SELECT o_orderkey, row_number() OVER (ORDER BY 'order-of-' || lower(o_orderpriority), o_orderkey) AS row FROM orders""")
def q_text_key_rows(spark, sf_dir):
    """Row numbers along a text key with a common prefix and few values, split within a value by the order key."""
    orders = tables.read_table(spark, f"{sf_dir}/orders.parquet").select(
        "o_orderkey", F.concat(F.lit("order-of-"), F.lower("o_orderpriority")).alias("key"))
    return row_numbers(orders, "key", tie_breakers=["o_orderkey"]).select("o_orderkey", "row")
