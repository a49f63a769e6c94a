"""DuckDB text of the CRM-shaped views (mirror of ``sources/testviews.py``).

Oracle queries are ``WITH <views> SELECT ...`` over the driver's
pre-registered retail views.  Only the mapping is shared with the Spark side;
every operator is written independently in SQL here and in DataFrame code
there.
"""

from __future__ import annotations

from leadlens.sources.testviews import (JSON_ID_PATH, PROFILE_TEXT,
                                        VOICEBOT_ACTION)

TAB = "chr(9)"


def _profile_cols() -> str:
    out = []
    for name, k in PROFILE_TEXT:
        out.append(
            f"CASE id % {k} WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN {TAB} ELSE 'v' END AS {name}")
    return ",\n    ".join(out)


LEADS = f"""
leads AS (
  SELECT
    id, contact_id, is_interested, deleted_at, lead_channel, source_medium, campaign_name,
    lead_owner, previous_lead_owner, lead_date, created_at, updated_at, interested_date_time,
    call_count, sms_count, email_count, whatsapp_count, lead_status, lead_sub_status,
    previous_lead_status,
    {_profile_cols()},
    CASE id % 6 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'default@crm.io'
         ELSE 'lead' || CAST(id AS VARCHAR) || '@mail.io' END AS email,
    CAST(CASE WHEN id % 21 = 0 THEN NULL WHEN id % 8 = 0 THEN 1 ELSE 0 END AS INTEGER) AS is_chatbot,
    CAST(CASE WHEN id % 9 = 1 THEN 1 ELSE 0 END AS INTEGER) AS is_voicebot,
    CAST(CASE WHEN id % 25 = 0 THEN 1 ELSE 0 END AS INTEGER) AS duplicate_check,
    CASE id % 3 WHEN 0 THEN 'inbound' WHEN 1 THEN 'Outbound ' END AS lead_type,
    id % 12 AS course,
    CASE WHEN id % 7 = 3 THEN NULL ELSE id % 15 END AS university_interested
  FROM (
    SELECT
      o.o_orderkey AS id,
      o.o_custkey AS contact_id,
      CAST(CASE o.o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS INTEGER) AS is_interested,
      CASE WHEN o.o_orderkey % 17 = 0 THEN o.o_orderdate END AS deleted_at,
      CASE WHEN o.o_orderkey % 13 = 0 THEN NULL ELSE o.o_orderpriority END AS lead_channel,
      CASE WHEN o.o_orderkey % 19 = 0 THEN NULL
           ELSE 'm' || CAST(o.o_orderkey % 6 AS VARCHAR) END AS source_medium,
      CASE WHEN o.o_orderkey % 7 = 0 THEN NULL WHEN o.o_orderkey % 11 = 0 THEN '  '
           ELSE c.c_mktsegment END AS campaign_name,
      o.o_orderkey % 120 AS lead_owner,
      CASE WHEN o.o_orderkey % 3 = 0 THEN NULL
           ELSE (o.o_orderkey + o.o_orderkey % 2) % 120 END AS previous_lead_owner,
      ld AS lead_date,
      CASE WHEN o.o_orderkey % 23 = 0 THEN NULL
           ELSE ld + to_hours(CAST(o.o_orderkey % 5 AS BIGINT)) END AS created_at,
      ld + to_days(CAST(o.o_orderkey % 40 AS INTEGER)) AS updated_at,
      CASE WHEN o.o_orderstatus = 'F' AND o.o_orderkey % 3 <> 1
           THEN ld + to_hours(CAST(o.o_orderkey % 200 AS BIGINT)) END AS interested_date_time,
      CAST(CASE WHEN o.o_orderkey % 9 = 0 THEN NULL ELSE o.o_orderkey % 5 END AS INTEGER) AS call_count,
      CAST(o.o_orderkey % 4 AS INTEGER) AS sms_count,
      CAST(CASE WHEN o.o_orderkey % 10 = 0 THEN NULL ELSE o.o_orderkey % 3 END AS INTEGER) AS email_count,
      CAST(o.o_orderkey % 2 AS INTEGER) AS whatsapp_count,
      CASE WHEN o.o_orderkey % 29 = 0 THEN 'n/a'
           ELSE CAST(o.o_orderkey % 30 AS VARCHAR) END AS lead_status,
      CASE WHEN o.o_orderkey % 4 = 0 THEN NULL
           ELSE CAST(o.o_orderkey % 27 AS VARCHAR) || '.0' END AS lead_sub_status,
      CASE WHEN o.o_orderkey % 5 = 0 THEN NULL
           ELSE CAST((o.o_orderkey + o.o_orderkey % 3) % 30 AS VARCHAR) END AS previous_lead_status
    FROM (SELECT *, o_orderdate + to_minutes(CAST((o_orderkey * 7) % 1440 AS BIGINT)) AS ld
          FROM orders) o
    LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  ) b
)"""

ACTIVITIES = """
activities AS (
  SELECT
    CASE WHEN l.l_partkey % 53 <> 0 THEN l.l_orderkey END AS lead_id,
    CAST(l.l_linenumber AS BIGINT) AS activity_id,
    CASE WHEN l.l_returnflag = 'N' THEN NULL WHEN l.l_returnflag = 'R' THEN 'Answered'
         WHEN l.l_linestatus = 'F' THEN 'CONNECTED' ELSE 'no answer' END AS call_status,
    CAST(CASE WHEN l.l_partkey % 10 = 0 THEN 0.0 WHEN l.l_partkey % 10 = 1 THEN NULL
              ELSE l.l_quantity END AS DOUBLE) AS duration,
    CASE WHEN l.l_suppkey % 3 = 0 THEN 'rec' END AS call_recordings,
    CASE WHEN l.l_linestatus = 'O' THEN l.l_partkey END AS follow_up_id,
    o.o_orderdate + to_minutes(CAST((l.l_partkey * 37 + l.l_suppkey) % 4000 AS BIGINT)) AS created_at,
    p.p_name AS activity_details,
    p.p_type AS description
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
)"""

CONTACTS = """
contacts AS (
  SELECT c.c_custkey AS id,
         CAST(c.c_custkey % 4 AS INTEGER) AS lead_count,
         CAST(CASE WHEN c.c_custkey % 5 = 0 THEN NULL WHEN n.n_regionkey = 1 THEN 1 ELSE 0 END
              AS INTEGER) AS is_domestic
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""

USERS = """
crm_users AS (
  SELECT s_suppkey AS id,
         CAST(CASE WHEN s_acctbal > 0 THEN 1 ELSE 0 END AS INTEGER) AS status,
         CASE WHEN s_suppkey % 9 = 0 THEN TIMESTAMP '2001-01-01 00:00:00' END AS deleted_at,
         s_nationkey AS role_id
  FROM supplier
)"""

STATUS = """
status_master AS (
  SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name FROM nation
)"""

FACEBOOK = """
fb_events AS (
  SELECT user_id AS lead_id,
         event_type = 'purchase' AS success,
         CAST(floor(value / 50) AS INTEGER) AS retry_count
  FROM events
)"""

VOICEBOT = f"""
vb_logs AS (
  SELECT props AS request,
         CASE WHEN event_type = 'click' THEN '202' ELSE '500' END AS status_code,
         CASE WHEN event_type <> 'error' THEN '{VOICEBOT_ACTION}' ELSE 'other' END AS action_type
  FROM events
)"""

JSON_PATH = JSON_ID_PATH

ALL_VIEWS = [LEADS, ACTIVITIES, CONTACTS, USERS, STATUS, FACEBOOK, VOICEBOT]


def with_views(*extra_ctes: str) -> str:
    """``WITH`` clause holding every CRM view plus extra CTEs (name AS (...))."""
    return "WITH " + ",\n".join(ALL_VIEWS + list(extra_ctes)) + "\n"

TRAINING = """
training AS (
  SELECT
    o.o_orderkey AS id,
    CAST(CASE WHEN o.o_orderkey % 31 = 0 THEN NULL ELSE round(o.o_totalprice / 4900, 2) END AS DOUBLE) AS lead_score,
    CAST(o.o_custkey % 999 AS INTEGER) AS company_size,
    CAST(CASE WHEN o.o_orderkey % 37 = 0 THEN NULL ELSE ((o.o_orderkey * 37) % 1000) / 10.0 END AS DOUBLE) AS engagement_score,
    CAST((o.o_orderkey % 97) / 2.0 - 0.5 AS DOUBLE) AS response_time_hours,
    CAST((o.o_orderkey % 101) / 100.0 AS DOUBLE) AS email_open_rate,
    CAST(CASE WHEN o.o_orderkey % 43 = 0 THEN NULL ELSE (o.o_orderkey % 103) / 100.0 END AS DOUBLE) AS email_click_rate,
    CAST(o.o_orderkey % 100 AS INTEGER) AS page_views,
    CAST(date_diff('day', CAST(o.o_orderdate AS DATE), DATE '2001-07-15') AS INTEGER) AS time_since_signup_days,
    CASE WHEN o.o_orderkey % 41 = 0 THEN NULL ELSE c.c_mktsegment END AS industry,
    o.o_orderpriority AS company_type,
    'R' || CAST(c.c_nationkey % 4 AS VARCHAR) AS location,
    o.o_orderstatus AS product_interest,
    CASE o.o_orderkey % 4 WHEN 0 THEN 'LinkedIn' WHEN 1 THEN 'Direct' WHEN 2 THEN 'Partner' ELSE 'Event' END AS source,
    CASE o.o_orderkey % 5 WHEN 4 THEN '' WHEN 0 THEN 'Awareness' WHEN 1 THEN 'Consideration'
         WHEN 2 THEN 'Decision' ELSE 'Qualification' END AS sales_stage,
    CAST(CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END AS INTEGER) AS intent_label
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
)"""


def with_training(*extra_ctes: str) -> str:
    return "WITH " + ",\n".join([TRAINING] + list(extra_ctes)) + "\n"
