"""CRM-shaped views over the driver's retail tables.

The feature build reads seven CRM tables (leads, activities, contacts,
facebook events, voicebot logs, users, status master).  The driver supplies
retail tables instead, so these views derive CRM-shaped tables from them with
integer arithmetic that plants nulls, blank and tab-only strings, placeholder
e-mails, unparsable status ids, owners without users and leads without
activities.  Every view is a pure projection/join of the given tables, so its
size grows with them.

``plans/oracle_views.py`` holds the same mapping as DuckDB CTE text; the two
must stay in sync.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values for the retail-backed views.
REF_DATE = _dt.date(2001, 7, 15)
COMPUTED_AT = _dt.datetime(2001, 7, 15, 0, 0, 0)
JSON_ID_PATH = "$.k"
VOICEBOT_ACTION = "init_call"
POSITIVE_DETAILS = ("ring", "widget")
POSITIVE_DESCRIPTION = ("economy",)
NEGATIVE_DETAILS = ("small",)
NEGATIVE_DESCRIPTION = ("small",)

# (column, modulus) for the profile text columns: id % m picks
# 0 → null, 1 → '', 2 → tab only, else a value.
PROFILE_TEXT = (
    ("ctc_annual_package", 4), ("experience", 5), ("company_name", 6),
    ("designation", 7), ("salary_increment", 8), ("gender", 9), ("dob", 10),
    ("state", 11), ("city", 12), ("alternate_mobile_number", 13),
    ("best_time_to_call", 14), ("qualification", 15), ("pain_points", 16),
)


@dataclass
class CrmTables:
    leads: DataFrame
    activities: DataFrame
    contacts: DataFrame
    facebook_events: DataFrame
    voicebot_logs: DataFrame
    users: DataFrame
    status_master: DataFrame


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _m(c: Column, k: int) -> Column:
    return c % F.lit(k)


def _null() -> Column:
    return F.lit(None)


def leads_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    j = o.join(c, o.o_custkey == c.c_custkey, "left")
    id_ = F.col("o_orderkey")
    lead_date = F.timestamp_add("MINUTE", _m(id_ * 7, 1440), F.col("o_orderdate"))
    interested = (F.when(F.col("o_orderstatus") == "F", 1)
                  .when(F.col("o_orderstatus") == "O", 0).cast("int"))
    cols = [
        id_.alias("id"),
        F.col("o_custkey").alias("contact_id"),
        interested.alias("is_interested"),
        F.when(_m(id_, 17) == 0, F.col("o_orderdate")).alias("deleted_at"),
        F.when(_m(id_, 13) == 0, _null()).otherwise(F.col("o_orderpriority")).alias("lead_channel"),
        F.when(_m(id_, 19) == 0, _null())
         .otherwise(F.concat(F.lit("m"), _m(id_, 6).cast("string"))).alias("source_medium"),
        F.when(_m(id_, 7) == 0, _null()).when(_m(id_, 11) == 0, F.lit("  "))
         .otherwise(F.col("c_mktsegment")).alias("campaign_name"),
        _m(id_, 120).alias("lead_owner"),
        F.when(_m(id_, 3) == 0, _null()).otherwise(_m(id_ + _m(id_, 2), 120)).alias("previous_lead_owner"),
        lead_date.alias("lead_date"),
        F.when(_m(id_, 23) == 0, _null())
         .otherwise(F.timestamp_add("HOUR", _m(id_, 5), lead_date)).alias("created_at"),
        F.timestamp_add("DAY", _m(id_, 40), lead_date).alias("updated_at"),
        F.when((interested == 1) & (_m(id_, 3) != 1),
               F.timestamp_add("HOUR", _m(id_, 200), lead_date)).alias("interested_date_time"),
        F.when(_m(id_, 9) == 0, _null()).otherwise(_m(id_, 5)).cast("int").alias("call_count"),
        _m(id_, 4).cast("int").alias("sms_count"),
        F.when(_m(id_, 10) == 0, _null()).otherwise(_m(id_, 3)).cast("int").alias("email_count"),
        _m(id_, 2).cast("int").alias("whatsapp_count"),
        F.when(_m(id_, 29) == 0, F.lit("n/a")).otherwise(_m(id_, 30).cast("string")).alias("lead_status"),
        F.when(_m(id_, 4) == 0, _null())
         .otherwise(F.concat(_m(id_, 27).cast("string"), F.lit(".0"))).alias("lead_sub_status"),
        F.when(_m(id_, 5) == 0, _null())
         .otherwise(_m(id_ + _m(id_, 3), 30).cast("string")).alias("previous_lead_status"),
    ]
    for name, k in PROFILE_TEXT:
        r = _m(id_, k)
        cols.append(F.when(r == 0, _null()).when(r == 1, F.lit("")).when(r == 2, F.lit("\t"))
                    .otherwise(F.lit("v")).alias(name))
    e = _m(id_, 6)
    cols += [
        F.when(e == 0, _null()).when(e == 1, F.lit("")).when(e == 2, F.lit("default@crm.io"))
         .otherwise(F.concat(F.lit("lead"), id_.cast("string"), F.lit("@mail.io"))).alias("email"),
        F.when(_m(id_, 21) == 0, _null())
         .otherwise(F.when(_m(id_, 8) == 0, 1).otherwise(0)).cast("int").alias("is_chatbot"),
        F.when(_m(id_, 9) == 1, 1).otherwise(0).cast("int").alias("is_voicebot"),
        F.when(_m(id_, 25) == 0, 1).otherwise(0).cast("int").alias("duplicate_check"),
        F.when(_m(id_, 3) == 0, F.lit("inbound")).when(_m(id_, 3) == 1, F.lit("Outbound "))
         .alias("lead_type"),
        _m(id_, 12).alias("course"),
        F.when(_m(id_, 7) == 3, _null()).otherwise(_m(id_, 15)).alias("university_interested"),
    ]
    return j.select(*cols)


def activities_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem")
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    p = read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)
    rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
    status = (F.when(rf == "N", _null()).when(rf == "R", F.lit("Answered"))
              .when(ls == "F", F.lit("CONNECTED")).otherwise(F.lit("no answer")))
    pk = F.col("l_partkey")
    duration = (F.when(_m(pk, 10) == 0, F.lit(0.0)).when(_m(pk, 10) == 1, _null())
                .otherwise(F.col("l_quantity")))
    minutes = _m(pk * 37 + F.col("l_suppkey"), 4000)
    return j.select(
        F.when(_m(pk, 53) != 0, F.col("l_orderkey")).alias("lead_id"),
        F.col("l_linenumber").cast("long").alias("activity_id"),
        status.alias("call_status"),
        duration.cast("double").alias("duration"),
        F.when(_m(F.col("l_suppkey"), 3) == 0, F.lit("rec")).alias("call_recordings"),
        F.when(ls == "O", pk).alias("follow_up_id"),
        F.timestamp_add("MINUTE", minutes, F.col("o_orderdate")).alias("created_at"),
        F.col("p_name").alias("activity_details"),
        F.col("p_type").alias("description"),
    )


def contacts_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer")
    n = read(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    j = c.join(n, c.c_nationkey == n.n_nationkey, "left")
    k = F.col("c_custkey")
    return j.select(
        k.alias("id"),
        _m(k, 4).cast("int").alias("lead_count"),
        F.when(_m(k, 5) == 0, _null())
         .otherwise(F.when(F.col("n_regionkey") == 1, 1).otherwise(0)).cast("int").alias("is_domestic"),
    )


def users_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    return s.select(
        k.alias("id"),
        F.when(F.col("s_acctbal") > 0, 1).otherwise(0).cast("int").alias("status"),
        F.when(_m(k, 9) == 0, F.lit("2001-01-01 00:00:00").cast("timestamp_ntz")).alias("deleted_at"),
        F.col("s_nationkey").alias("role_id"),
    )


def status_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("name"))


def facebook_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read(spark, sf_dir, "events")
    return ev.select(
        F.col("user_id").alias("lead_id"),
        (F.col("event_type") == "purchase").alias("success"),
        F.floor(F.col("value") / 50).cast("int").alias("retry_count"),
    )


def voicebot_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read(spark, sf_dir, "events")
    et = F.col("event_type")
    return ev.select(
        F.col("props").alias("request"),
        F.when(et == "click", F.lit("202")).otherwise(F.lit("500")).alias("status_code"),
        F.when(et != "error", F.lit(VOICEBOT_ACTION)).otherwise(F.lit("other")).alias("action_type"),
    )


def crm_tables(spark: SparkSession, sf_dir: str) -> CrmTables:
    return CrmTables(
        leads=leads_view(spark, sf_dir),
        activities=activities_view(spark, sf_dir),
        contacts=contacts_view(spark, sf_dir),
        facebook_events=facebook_view(spark, sf_dir),
        voicebot_logs=voicebot_view(spark, sf_dir),
        users=users_view(spark, sf_dir),
        status_master=status_view(spark, sf_dir),
    )


# The small lead table's feature lists (numeric, categorical, target).
NUMERIC_FEATURES = ("lead_score", "company_size", "engagement_score", "response_time_hours",
                    "email_open_rate", "email_click_rate", "page_views", "time_since_signup_days")
CATEGORICAL_FEATURES = ("industry", "company_type", "location", "product_interest", "source",
                        "sales_stage")
TARGET = "intent_label"
SOURCES = ("LinkedIn", "Direct", "Partner", "Event")
STAGES = ("Awareness", "Consideration", "Decision", "Qualification")


def training_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The small lead table (8 numeric, 6 categorical, ``intent_label``).

    Built from orders ⋈ customer with planted nulls, NaN (missing as well, so
    the oracle's side has nulls), blanks and out-of-range values (lead_score above 100, company_size 0, negative response time,
    click rate above 1, future sign-up).
    """
    o = read(spark, sf_dir, "orders")
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    j = o.join(c, o.o_custkey == c.c_custkey, "left")
    id_ = F.col("o_orderkey")
    src = F.element_at(F.array(*[F.lit(s) for s in SOURCES]), (_m(id_, 4) + 1).cast("int"))
    stage = F.when(_m(id_, 5) == 4, F.lit("")).otherwise(
        F.element_at(F.array(*[F.lit(s) for s in STAGES]), (_m(id_, 5) + 1).cast("int")))
    return j.select(
        id_.alias("id"),
        F.when(_m(id_, 62) == 0, F.lit(float("nan"))).when(_m(id_, 31) == 0, _null())
         .otherwise(F.round(F.col("o_totalprice") / 4900, 2)).cast("double").alias("lead_score"),
        _m(F.col("o_custkey"), 999).cast("int").alias("company_size"),
        F.when(_m(id_, 37) == 0, _null()).otherwise(_m(id_ * 37, 1000) / 10.0)
         .cast("double").alias("engagement_score"),
        (_m(id_, 97) / 2.0 - 0.5).cast("double").alias("response_time_hours"),
        (_m(id_, 101) / 100.0).cast("double").alias("email_open_rate"),
        F.when(_m(id_, 86) == 0, F.lit(float("nan"))).when(_m(id_, 43) == 0, _null())
         .otherwise(_m(id_, 103) / 100.0).cast("double").alias("email_click_rate"),
        _m(id_, 100).cast("int").alias("page_views"),
        F.datediff(F.lit(REF_DATE), F.to_date("o_orderdate")).alias("time_since_signup_days"),
        F.when(_m(id_, 41) == 0, _null()).otherwise(F.col("c_mktsegment")).alias("industry"),
        F.col("o_orderpriority").alias("company_type"),
        F.concat(F.lit("R"), _m(F.col("c_nationkey"), 4).cast("string")).alias("location"),
        F.col("o_orderstatus").alias("product_interest"),
        src.alias("source"),
        stage.alias("sales_stage"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).cast("int").alias("intent_label"),
    )
