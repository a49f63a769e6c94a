"""DuckDB oracle text for the source aggregates and the feature table."""

from __future__ import annotations

from leadlens.plans.oracle_views import JSON_PATH, with_views
from leadlens.sources import testviews as TV

REF = f"DATE '{TV.REF_DATE.isoformat()}'"
REF_TS = f"TIMESTAMP '{TV.REF_DATE.isoformat()} 00:00:00'"
COMPUTED_TS = f"TIMESTAMP '{TV.COMPUTED_AT.isoformat(sep=' ')}'"
WS = "' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)"


def nonblank(c: str) -> str:
    return f"({c} IS NOT NULL AND trim(CAST({c} AS VARCHAR), {WS}) <> '')"


def flag(c: str) -> str:
    return f"CAST(CASE WHEN {nonblank(c)} THEN 1 ELSE 0 END AS INTEGER)"


def b(cond: str) -> str:
    return f"CAST(CASE WHEN {cond} THEN 1 ELSE 0 END AS INTEGER)"


def any_contains(c: str, words) -> str:
    return "(" + " OR ".join(f"contains(lower(coalesce({c}, '')), '{w}')" for w in words) + ")"


def days(ts: str) -> str:
    return f"CAST(date_diff('day', CAST({ts} AS DATE), {REF}) AS INTEGER)"


def hours(a: str, bb: str) -> str:
    return f"(date_diff('microsecond', {a}, {bb}) / 3.6e9)"


def minutes(a: str, bb: str) -> str:
    return f"(date_diff('microsecond', {a}, {bb}) / 6e7)"


POS = any_contains("activity_details", TV.POSITIVE_DETAILS)[:-1] + " OR " + \
    any_contains("description", TV.POSITIVE_DESCRIPTION)[1:]
NEG = any_contains("activity_details", TV.NEGATIVE_DETAILS)[:-1] + " OR " + \
    any_contains("description", TV.NEGATIVE_DESCRIPTION)[1:]

ACT_AGG = f"""
act AS (
  SELECT lead_id,
    CAST(count(*) AS BIGINT) AS total_activities,
    CAST(count(DISTINCT activity_id) AS BIGINT) AS unique_activity_types,
    CAST(count(*) FILTER (WHERE call_status IS NOT NULL) AS BIGINT) AS total_calls_logged,
    CAST(count(*) FILTER (WHERE lower(call_status) IN ('answered', 'connected')) AS BIGINT) AS answered_calls,
    coalesce(sum(duration), 0.0) AS total_call_duration_sec,
    avg(CASE WHEN coalesce(duration, 0) > 0 THEN duration END) AS avg_call_duration_sec,
    max(duration) AS max_call_duration_sec,
    CAST(count(*) FILTER (WHERE call_recordings IS NOT NULL) AS BIGINT) AS calls_with_recording,
    CAST(count(DISTINCT follow_up_id) AS BIGINT) AS followup_count,
    min(CASE WHEN follow_up_id IS NOT NULL THEN created_at END) AS first_followup_at,
    max(CASE WHEN follow_up_id IS NOT NULL THEN created_at END) AS last_followup_at,
    min(created_at) AS first_activity_at,
    max(created_at) AS last_activity_at,
    CAST(sum(CASE WHEN {POS} THEN 1 ELSE 0 END) AS BIGINT) AS positive_intent_kw_count,
    CAST(sum(CASE WHEN {NEG} THEN 1 ELSE 0 END) AS BIGINT) AS negative_intent_kw_count
  FROM activities GROUP BY lead_id
)"""

FB_AGG = """
fb AS (
  SELECT lead_id,
    CAST(count(*) AS BIGINT) AS fb_events_count,
    CAST(sum(CASE WHEN success THEN 1 ELSE 0 END) AS BIGINT) AS fb_events_success,
    round(avg(coalesce(retry_count, 0)), 2) AS avg_fb_retry_count
  FROM fb_events GROUP BY lead_id
)"""

VB_KEY = (f"try_cast(CASE WHEN json_valid(request) THEN json_extract_string(request, '{JSON_PATH}') END"
          " AS DECIMAL(38,0))")
VB_AGG = f"""
vb AS (
  SELECT CAST({VB_KEY} AS BIGINT) AS lead_id,
    CAST(count(*) AS BIGINT) AS voicebot_call_count,
    CAST(sum(CASE WHEN status_code = '202' THEN 1 ELSE 0 END) AS BIGINT) AS voicebot_initiated_count
  FROM vb_logs
  WHERE action_type = '{TV.VOICEBOT_ACTION}' AND {VB_KEY} IS NOT NULL
  GROUP BY 1
)"""

LD0 = "ld0 AS (SELECT * FROM leads WHERE deleted_at IS NULL)"
CH = "ch AS (SELECT lead_channel AS k, avg(is_interested) AS cvr, CAST(count(id) AS BIGINT) AS vol FROM ld0 GROUP BY lead_channel)"
CP = (f"cp AS (SELECT campaign_name AS k, avg(is_interested) AS cvr, CAST(count(id) AS BIGINT) AS vol "
      f"FROM ld0 WHERE {nonblank('campaign_name')} GROUP BY campaign_name)")
OW = (f"ow AS (SELECT lead_owner AS k, avg(is_interested) AS cvr, CAST(count(id) AS BIGINT) AS vol, "
      f"CAST(floor(date_diff('microsecond', min(created_at), {REF_TS}) / 8.64e10) AS BIGINT) AS tenure, "
      f"CAST(count(*) FILTER (WHERE updated_at >= {REF_TS} - INTERVAL 30 DAY) AS BIGINT) AS active "
      f"FROM ld0 GROUP BY lead_owner)")
US = ("us AS (SELECT id, CAST(CASE WHEN deleted_at IS NULL AND status = 1 THEN 1 ELSE 0 END AS INTEGER) AS active, "
      "role_id FROM crm_users)")

PROFILE = ["ctc_annual_package", "experience", "company_name", "designation", "salary_increment",
           "gender", "dob", "state", "city", "alternate_mobile_number", "best_time_to_call",
           "qualification", "pain_points"]

REAL_EMAIL = b("l.email IS NOT NULL AND NOT contains(l.email, 'default@')")


def _z(c: str) -> str:
    return f"coalesce({c}, 0)"


FEATURE_SELECT = f"""
SELECT
  l.id AS lead_id, l.contact_id, CAST(coalesce(l.is_interested, 0) AS INTEGER) AS is_interested,
  l.lead_channel, l.source_medium,
  coalesce(ch.cvr, 0.0) AS channel_historical_cvr, CAST(coalesce(ch.vol, 0) AS BIGINT) AS channel_volume,
  {flag('l.campaign_name')} AS has_campaign,
  coalesce(cp.cvr, 0.0) AS campaign_historical_cvr, CAST(coalesce(cp.vol, 0) AS BIGINT) AS campaign_volume,
  CAST(coalesce(a.followup_count, 0) AS BIGINT) AS followup_count,
  {hours('l.lead_date', 'a.first_followup_at')} AS hours_to_first_followup,
  CASE WHEN coalesce(a.followup_count, 0) > 1
       THEN {hours('a.first_followup_at', 'a.last_followup_at')} / greatest(coalesce(a.followup_count, 0) - 1, 1)
  END AS avg_followup_interval_hours,
  {days('l.lead_date')} AS lead_age_days,
  {days('l.updated_at')} AS days_since_last_update,
  {b(days('l.lead_date') + ' <= 7')} AS is_fresh_7d,
  {b(days('l.lead_date') + ' <= 30')} AS is_fresh_30d,
  CAST(hour(l.lead_date) AS INTEGER) AS lead_hour_of_day,
  CAST(isodow(l.lead_date) - 1 AS INTEGER) AS lead_day_of_week,
  CAST(month(l.lead_date) AS INTEGER) AS lead_month,
  {b('isodow(l.lead_date) IN (6, 7)')} AS is_weekend_lead,
  {b('hour(l.lead_date) BETWEEN 9 AND 18')} AS is_business_hours_lead,
  CAST(coalesce(us.active, 0) AS INTEGER) AS is_owner_active,
  us.role_id AS owner_role_id,
  coalesce(ow.cvr, 0.0) AS owner_historical_cvr,
  CAST(coalesce(ow.active, 0) AS BIGINT) AS owner_workload_30d,
  CAST(coalesce(ow.tenure, 0) AS BIGINT) AS owner_tenure_days,
  {b('l.previous_lead_owner IS NOT NULL AND l.previous_lead_owner IS DISTINCT FROM l.lead_owner')} AS was_reassigned,
  {_z('l.call_count')} AS call_count, {_z('l.sms_count')} AS sms_count,
  {_z('l.email_count')} AS email_count, {_z('l.whatsapp_count')} AS whatsapp_count,
  {_z('l.call_count')} * 3 + {_z('l.whatsapp_count')} * 2 + {_z('l.email_count')} + {_z('l.sms_count')}
    AS engagement_intensity_score,
  {b("(CASE WHEN coalesce(l.call_count,0) > 0 THEN 1 ELSE 0 END + CASE WHEN coalesce(l.sms_count,0) > 0 THEN 1 ELSE 0 END"
     " + CASE WHEN coalesce(l.email_count,0) > 0 THEN 1 ELSE 0 END + CASE WHEN coalesce(l.whatsapp_count,0) > 0 THEN 1 ELSE 0 END) >= 2")}
    AS has_multi_channel_engagement,
  CAST(coalesce(a.total_activities, 0) AS BIGINT) AS total_activities,
  CAST(coalesce(a.total_calls_logged, 0) AS BIGINT) AS total_calls_logged,
  CAST(coalesce(a.answered_calls, 0) AS BIGINT) AS answered_calls,
  coalesce(a.total_call_duration_sec, 0.0) AS total_call_duration_sec,
  coalesce(a.avg_call_duration_sec, 0.0) AS avg_call_duration_sec,
  CAST(coalesce(a.max_call_duration_sec, 0.0) AS DOUBLE) AS max_call_duration_sec,
  round_even(CASE WHEN coalesce(a.total_calls_logged, 0) > 0
                  THEN coalesce(a.answered_calls, 0) / coalesce(a.total_calls_logged, 0) ELSE 0.0 END, 3)
    AS call_answer_rate,
  CAST(coalesce(a.calls_with_recording, 0) AS BIGINT) AS calls_with_recording,
  CAST(coalesce(a.unique_activity_types, 0) AS BIGINT) AS unique_activity_types,
  {days('a.last_activity_at')} AS days_since_last_activity,
  CAST(coalesce(a.positive_intent_kw_count, 0) AS BIGINT) AS positive_intent_kw_count,
  CAST(coalesce(a.negative_intent_kw_count, 0) AS BIGINT) AS negative_intent_kw_count,
  CAST(coalesce(a.positive_intent_kw_count, 0) - coalesce(a.negative_intent_kw_count, 0) AS BIGINT) AS net_intent_score,
  {b('coalesce(a.positive_intent_kw_count, 0) > 0')} AS has_positive_intent,
  {b('coalesce(a.negative_intent_kw_count, 0) > 0')} AS has_negative_intent,
  {minutes('l.lead_date', 'a.first_activity_at')} AS minutes_to_first_contact,
  {b(minutes('l.lead_date', 'a.first_activity_at') + ' <= 60')} AS contacted_within_1hr,
  {b(minutes('l.lead_date', 'a.first_activity_at') + ' <= 1440')} AS contacted_within_24hrs,
  {b('a.first_activity_at IS NULL')} AS never_contacted,
  l.lead_status AS lead_status_id, s1.name AS lead_status_name,
  l.lead_sub_status AS lead_sub_status_id, s2.name AS lead_sub_status_name,
  l.previous_lead_status AS previous_lead_status_id, s3.name AS previous_lead_status_name,
  {b('l.previous_lead_status IS NOT NULL AND l.previous_lead_status IS DISTINCT FROM l.lead_status')} AS status_changed,
  {b('l.interested_date_time IS NOT NULL')} AS reached_interested_stage,
  {hours('l.lead_date', 'l.interested_date_time')} AS hours_to_interested_stage,
  {days('l.updated_at')} AS days_in_current_status,
  {flag('l.ctc_annual_package')} AS has_ctc, {flag('l.experience')} AS has_experience,
  {flag('l.company_name')} AS has_company, {flag('l.designation')} AS has_designation,
  {flag('l.company_name')} * {flag('l.designation')} AS is_employed_professional,
  {flag('l.salary_increment')} AS has_salary_increment_goal,
  {REAL_EMAIL} AS has_real_email, {flag('l.gender')} AS has_gender, {flag('l.dob')} AS has_dob,
  {flag('l.state')} AS has_state, {flag('l.city')} AS has_city,
  {flag('l.alternate_mobile_number')} AS has_alternate_mobile,
  {flag('l.best_time_to_call')} AS has_best_time_to_call,
  {flag('l.qualification')} AS has_qualification, {flag('l.pain_points')} AS has_pain_points,
  {REAL_EMAIL} + {flag('l.gender')} + {flag('l.dob')} + {flag('l.state')} + {flag('l.city')}
    + {flag('l.alternate_mobile_number')} + {flag('l.designation')} + {flag('l.company_name')}
    + {flag('l.ctc_annual_package')} + {flag('l.experience')} + {flag('l.qualification')}
    + {flag('l.pain_points')} AS profile_completeness_score,
  CAST(coalesce(l.is_chatbot, 0) AS INTEGER) AS is_chatbot,
  CAST(coalesce(l.is_voicebot, 0) AS INTEGER) AS is_voicebot,
  CAST(coalesce(l.duplicate_check, 0) AS INTEGER) AS is_duplicate,
  l.lead_type, l.course AS course_id, l.university_interested AS university_id,
  coalesce(ct.lead_count, 0) AS contact_lead_count,
  coalesce(ct.is_domestic, 1) AS is_domestic,
  {b('coalesce(ct.lead_count, 0) > 1')} AS is_repeat_contact,
  {b('fb.fb_events_count IS NOT NULL')} AS is_facebook_lead,
  CAST(coalesce(fb.fb_events_count, 0) AS BIGINT) AS fb_events_count,
  CAST(coalesce(fb.fb_events_success, 0) AS BIGINT) AS fb_events_success,
  round_even(CASE WHEN coalesce(fb.fb_events_count, 0) > 0
                  THEN coalesce(fb.fb_events_success, 0) / coalesce(fb.fb_events_count, 0) ELSE 0.0 END, 3)
    AS fb_event_success_rate,
  {b('vb.voicebot_call_count IS NOT NULL')} AS has_voicebot_interaction,
  CAST(coalesce(vb.voicebot_call_count, 0) AS BIGINT) AS voicebot_call_count,
  CAST(coalesce(vb.voicebot_initiated_count, 0) AS BIGINT) AS voicebot_initiated_count,
  l.lead_date, l.created_at, l.updated_at, {COMPUTED_TS} AS feature_computed_at
FROM ld0 l
LEFT JOIN ch ON l.lead_channel IS NOT DISTINCT FROM ch.k
LEFT JOIN cp ON l.campaign_name = cp.k
LEFT JOIN ow ON l.lead_owner IS NOT DISTINCT FROM ow.k
LEFT JOIN us ON l.lead_owner = us.id
LEFT JOIN status_master s1 ON try_cast(l.lead_status AS DOUBLE) = CAST(s1.id AS DOUBLE)
LEFT JOIN status_master s2 ON try_cast(l.lead_sub_status AS DOUBLE) = CAST(s2.id AS DOUBLE)
LEFT JOIN status_master s3 ON try_cast(l.previous_lead_status AS DOUBLE) = CAST(s3.id AS DOUBLE)
LEFT JOIN act a ON l.id = a.lead_id
LEFT JOIN fb ON l.id = fb.lead_id
LEFT JOIN vb ON l.id = vb.lead_id
LEFT JOIN contacts ct ON l.contact_id = ct.id
"""

FEATURE_CTES = [ACT_AGG, FB_AGG, VB_AGG, LD0, CH, CP, OW, US]


def features_with(*extra: str) -> str:
    """WITH clause exposing the oracle feature table as CTE ``feat``."""
    return with_views(*FEATURE_CTES, f"feat AS ({FEATURE_SELECT})", *extra)


FEATURES_SQL = with_views(*FEATURE_CTES) + FEATURE_SELECT
