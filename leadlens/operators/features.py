"""Wide per-lead feature table.

``build_features`` is a single lazy plan:

1. soft-delete filter (P1) and timestamp coercion on the lead table;
2. channel / campaign / owner statistics in one grouping-sets scan, joined
   back as size-checked broadcasts (J1–J3);
3. user and status lookups as size-checked broadcasts (J8, J9);
4. the per-lead activity, facebook and voicebot aggregates joined on the
   lead id (J4–J6) — one shuffle of the lead table, the aggregates arrive
   already partitioned on ``lead_id``;
5. the contact lookup (J7);
6. one projection computing the 99 output columns (G0–G16), all built-in
   expressions inside whole-stage codegen.

The reference date and the computed-at timestamp are parameters, so a
rebuild is deterministic.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlens.functions import exprs as X
from leadlens.operators import aggregates as A
from leadlens.operators.joins import (DEFAULT_MAX_BROADCAST_BYTES, bounded_broadcast, bounded_lookup, fits_broadcast,
                                      left_lookup, unique_key)

FEATURE_COLUMNS: tuple[str, ...] = (
    "lead_id", "contact_id", "is_interested",
    "lead_channel", "source_medium", "channel_historical_cvr", "channel_volume",
    "has_campaign", "campaign_historical_cvr", "campaign_volume",
    "followup_count", "hours_to_first_followup", "avg_followup_interval_hours",
    "lead_age_days", "days_since_last_update", "is_fresh_7d", "is_fresh_30d",
    "lead_hour_of_day", "lead_day_of_week", "lead_month", "is_weekend_lead",
    "is_business_hours_lead",
    "is_owner_active", "owner_role_id", "owner_historical_cvr", "owner_workload_30d",
    "owner_tenure_days", "was_reassigned",
    "call_count", "sms_count", "email_count", "whatsapp_count", "engagement_intensity_score",
    "has_multi_channel_engagement", "total_activities", "total_calls_logged", "answered_calls",
    "total_call_duration_sec", "avg_call_duration_sec", "max_call_duration_sec",
    "call_answer_rate", "calls_with_recording", "unique_activity_types",
    "days_since_last_activity",
    "positive_intent_kw_count", "negative_intent_kw_count", "net_intent_score",
    "has_positive_intent", "has_negative_intent",
    "minutes_to_first_contact", "contacted_within_1hr", "contacted_within_24hrs",
    "never_contacted",
    "lead_status_id", "lead_status_name", "lead_sub_status_id", "lead_sub_status_name",
    "previous_lead_status_id", "previous_lead_status_name", "status_changed",
    "reached_interested_stage", "hours_to_interested_stage", "days_in_current_status",
    "has_ctc", "has_experience", "has_company", "has_designation",
    "is_employed_professional", "has_salary_increment_goal",
    "has_real_email", "has_gender", "has_dob", "has_state", "has_city",
    "has_alternate_mobile", "has_best_time_to_call", "has_qualification", "has_pain_points",
    "profile_completeness_score",
    "is_chatbot", "is_voicebot", "is_duplicate", "lead_type", "course_id", "university_id",
    "contact_lead_count", "is_domestic", "is_repeat_contact",
    "is_facebook_lead", "fb_events_count", "fb_events_success", "fb_event_success_rate",
    "has_voicebot_interaction", "voicebot_call_count", "voicebot_initiated_count",
    "lead_date", "created_at", "updated_at", "feature_computed_at",
)

LEAD_TIMESTAMPS = ("lead_date", "created_at", "updated_at", "interested_date_time", "deleted_at")


def _coerce_timestamps(df: DataFrame, names: Sequence[str]) -> DataFrame:
    types = dict(df.dtypes)
    for n in names:
        if n in types and types[n] == "string":
            df = df.withColumn(n, X.to_timestamp_lenient(n))
    return df


def prepare_leads(leads: DataFrame) -> DataFrame:
    """Lower-case names, drop soft-deleted rows (P1), coerce timestamps."""
    ld = A.lower_columns(leads)
    if "deleted_at" in ld.columns:
        ld = ld.where(F.col("deleted_at").isNull())
    return _coerce_timestamps(ld, LEAD_TIMESTAMPS)


def _status_lookup(status_master: DataFrame) -> DataFrame:
    s = A.lower_columns(status_master).select(
        F.col("id").cast("double").alias("st_id"), F.col("name").alias("st_name"))
    return unique_key(s, "st_id", "status master")


def _user_lookup(users: DataFrame) -> DataFrame:
    u = A.lower_columns(users)
    status = F.col("status") if "status" in u.columns else None
    deleted = F.col("deleted_at") if "deleted_at" in u.columns else None
    role = F.col("role_id") if "role_id" in u.columns else F.lit(None).cast("int")
    u = u.select(F.col("id").alias("u_id"),
                 X.user_active(status, deleted).alias("u_active"),
                 role.alias("u_role_id"))
    return unique_key(u, "u_id", "users")


def _contact_lookup(contacts: DataFrame) -> DataFrame:
    c = A.lower_columns(contacts)
    lc = F.col("lead_count") if "lead_count" in c.columns else F.lit(None).cast("int")
    dom = F.col("is_domestic") if "is_domestic" in c.columns else F.lit(None).cast("int")
    c = c.select(F.col("id").alias("c_id"), lc.alias("c_lead_count"), dom.alias("c_is_domestic"))
    return unique_key(c, "c_id", "contacts")


def _map_status(ld: DataFrame, status: DataFrame, source: str, out: str, fits: bool) -> DataFrame:
    s = status.select(F.col("st_id").alias(f"{out}_k"), F.col("st_name").alias(out))
    return bounded_lookup(ld, s, X.to_number(source, "double"), f"{out}_k", "id", fits=fits)


def join_sources(
    leads: DataFrame, act_agg: DataFrame, contacts: DataFrame, fb_agg: DataFrame,
    vb_agg: DataFrame, users: DataFrame, status_master: DataFrame, ref_date: _dt.date,
    max_broadcast_rows: int | None = None,
    max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Every lookup attached to the prepared lead table."""
    ld = prepare_leads(leads)
    bounds = {"max_rows": max_broadcast_rows, "max_bytes": max_broadcast_bytes}
    stats = bounded_broadcast(A.lead_group_stats(ld, ref_date), materialize=True, **bounds)
    ld = left_lookup(ld, A.channel_stats(stats), "lead_channel", "s_channel", null_safe=True)
    ld = left_lookup(ld, A.campaign_stats(stats), "campaign_name", "s_campaign")
    ld = left_lookup(ld, A.owner_stats(stats), "lead_owner", "s_owner", null_safe=True)
    ld = bounded_lookup(ld, _user_lookup(users), "lead_owner", "u_id", "id", **bounds)
    status = _status_lookup(status_master)
    fits = fits_broadcast(status, **bounds)
    for src, out in (("lead_status", "lead_status_name"),
                     ("lead_sub_status", "lead_sub_status_name"),
                     ("previous_lead_status", "previous_lead_status_name")):
        ld = _map_status(ld, status, src, out, fits)
    act = A.lower_columns(act_agg).withColumnRenamed("lead_id", "a_lead_id")
    fb = A.lower_columns(fb_agg).withColumnRenamed("lead_id", "f_lead_id")
    vb = (A.lower_columns(vb_agg).withColumn("lead_id", F.col("lead_id").try_cast("long"))
          .withColumnRenamed("lead_id", "v_lead_id"))
    ld = left_lookup(ld, act, "id", "a_lead_id")
    ld = left_lookup(ld, fb, "id", "f_lead_id")
    ld = left_lookup(ld, vb, "id", "v_lead_id")
    ld = bounded_lookup(ld, _contact_lookup(contacts), "contact_id", "c_id", "id", **bounds)
    return ld


def feature_columns(ld: DataFrame, ref_date: _dt.date, computed_at: _dt.datetime) -> list[Column]:
    """The 99 output expressions over the joined lead table."""
    c = F.col
    z = lambda name: F.coalesce(c(name), F.lit(0))
    call, sms, email, wa = z("call_count"), z("sms_count"), z("email_count"), z("whatsapp_count")
    age = X.days_since("lead_date", ref_date)
    mins_first = X.minutes_between("lead_date", "first_activity_at")
    pos_kw, neg_kw = z("positive_intent_kw_count"), z("negative_intent_kw_count")
    calls_logged, answered = z("total_calls_logged"), z("answered_calls")
    fb_n, fb_ok = z("fb_events_count"), z("fb_events_success")
    has = {name: X.flag(name) for name in (
        "ctc_annual_package", "experience", "company_name", "designation", "salary_increment",
        "gender", "dob", "state", "city", "alternate_mobile_number", "best_time_to_call",
        "qualification", "pain_points")}
    real_email = X.real_email("email")
    contact_n = F.coalesce(c("c_lead_count"), F.lit(0))
    profile = (real_email + has["gender"] + has["dob"] + has["state"] + has["city"]
               + has["alternate_mobile_number"] + has["designation"] + has["company_name"]
               + has["ctc_annual_package"] + has["experience"] + has["qualification"]
               + has["pain_points"])
    cols = [
        # G0 identifiers + target
        c("id").alias("lead_id"), c("contact_id"),
        z("is_interested").cast("int").alias("is_interested"),
        # G1 source quality
        c("lead_channel"), c("source_medium"),
        F.coalesce(c("channel_cvr"), F.lit(0.0)).alias("channel_historical_cvr"),
        z("channel_volume").cast("long").alias("channel_volume"),
        # G2 campaign
        X.flag("campaign_name").alias("has_campaign"),
        F.coalesce(c("campaign_cvr"), F.lit(0.0)).alias("campaign_historical_cvr"),
        z("campaign_volume").cast("long").alias("campaign_volume"),
        # G3 follow-up velocity
        z("followup_count").cast("long").alias("followup_count"),
        X.hours_between("lead_date", "first_followup_at").alias("hours_to_first_followup"),
        X.avg_interval_hours("first_followup_at", "last_followup_at", "followup_count")
         .alias("avg_followup_interval_hours"),
        # G4 freshness
        age.alias("lead_age_days"),
        X.days_since("updated_at", ref_date).alias("days_since_last_update"),
        X.bool_flag(age <= 7).alias("is_fresh_7d"),
        X.bool_flag(age <= 30).alias("is_fresh_30d"),
        X.hour_of_day("lead_date").alias("lead_hour_of_day"),
        X.day_of_week("lead_date").alias("lead_day_of_week"),
        F.month("lead_date").alias("lead_month"),
        X.is_weekend("lead_date").alias("is_weekend_lead"),
        X.is_business_hours("lead_date").alias("is_business_hours_lead"),
        # G5 owner
        F.coalesce(c("u_active"), F.lit(0)).cast("int").alias("is_owner_active"),
        c("u_role_id").alias("owner_role_id"),
        F.coalesce(c("owner_cvr_overall"), F.lit(0.0)).alias("owner_historical_cvr"),
        z("owner_active_leads_30d").cast("long").alias("owner_workload_30d"),
        z("owner_tenure_days").cast("long").alias("owner_tenure_days"),
        X.changed("previous_lead_owner", "lead_owner").alias("was_reassigned"),
        # G6 engagement
        call.alias("call_count"), sms.alias("sms_count"), email.alias("email_count"),
        wa.alias("whatsapp_count"),
        X.weighted_engagement(call, wa, email, sms).alias("engagement_intensity_score"),
        X.multi_channel(call, sms, email, wa).alias("has_multi_channel_engagement"),
        z("total_activities").cast("long").alias("total_activities"),
        calls_logged.cast("long").alias("total_calls_logged"),
        answered.cast("long").alias("answered_calls"),
        F.coalesce(c("total_call_duration_sec"), F.lit(0.0)).alias("total_call_duration_sec"),
        F.coalesce(c("avg_call_duration_sec"), F.lit(0.0)).alias("avg_call_duration_sec"),
        F.coalesce(c("max_call_duration_sec"), F.lit(0.0)).cast("double").alias("max_call_duration_sec"),
        X.guarded_ratio(answered, calls_logged).alias("call_answer_rate"),
        z("calls_with_recording").cast("long").alias("calls_with_recording"),
        z("unique_activity_types").cast("long").alias("unique_activity_types"),
        X.days_since("last_activity_at", ref_date).alias("days_since_last_activity"),
        # G7 text intent
        pos_kw.cast("long").alias("positive_intent_kw_count"),
        neg_kw.cast("long").alias("negative_intent_kw_count"),
        (pos_kw - neg_kw).cast("long").alias("net_intent_score"),
        X.bool_flag(pos_kw > 0).alias("has_positive_intent"),
        X.bool_flag(neg_kw > 0).alias("has_negative_intent"),
        # G8 time to response
        mins_first.alias("minutes_to_first_contact"),
        X.bool_flag(mins_first <= 60).alias("contacted_within_1hr"),
        X.bool_flag(mins_first <= 1440).alias("contacted_within_24hrs"),
        X.bool_flag(c("first_activity_at").isNull()).alias("never_contacted"),
        # G9 funnel
        c("lead_status").alias("lead_status_id"), c("lead_status_name"),
        c("lead_sub_status").alias("lead_sub_status_id"), c("lead_sub_status_name"),
        c("previous_lead_status").alias("previous_lead_status_id"), c("previous_lead_status_name"),
        X.changed("previous_lead_status", "lead_status").alias("status_changed"),
        X.bool_flag(c("interested_date_time").isNotNull()).alias("reached_interested_stage"),
        X.hours_between("lead_date", "interested_date_time").alias("hours_to_interested_stage"),
        X.days_since("updated_at", ref_date).alias("days_in_current_status"),
        # G10 affordability
        has["ctc_annual_package"].alias("has_ctc"), has["experience"].alias("has_experience"),
        has["company_name"].alias("has_company"), has["designation"].alias("has_designation"),
        (has["company_name"] * has["designation"]).alias("is_employed_professional"),
        has["salary_increment"].alias("has_salary_increment_goal"),
        # G11 profile
        real_email.alias("has_real_email"), has["gender"].alias("has_gender"),
        has["dob"].alias("has_dob"), has["state"].alias("has_state"), has["city"].alias("has_city"),
        has["alternate_mobile_number"].alias("has_alternate_mobile"),
        has["best_time_to_call"].alias("has_best_time_to_call"),
        has["qualification"].alias("has_qualification"),
        has["pain_points"].alias("has_pain_points"),
        profile.alias("profile_completeness_score"),
        # G12 misc
        z("is_chatbot").cast("int").alias("is_chatbot"),
        z("is_voicebot").cast("int").alias("is_voicebot"),
        z("duplicate_check").cast("int").alias("is_duplicate"),
        c("lead_type"), c("course").alias("course_id"),
        c("university_interested").alias("university_id"),
        # G13 contact
        contact_n.alias("contact_lead_count"),
        F.coalesce(c("c_is_domestic"), F.lit(1)).alias("is_domestic"),
        X.bool_flag(contact_n > 1).alias("is_repeat_contact"),
        # G14 facebook
        X.bool_flag(c("fb_events_count").isNotNull()).alias("is_facebook_lead"),
        fb_n.cast("long").alias("fb_events_count"), fb_ok.cast("long").alias("fb_events_success"),
        X.guarded_ratio(fb_ok, fb_n).alias("fb_event_success_rate"),
        # G15 voicebot
        X.bool_flag(c("voicebot_call_count").isNotNull()).alias("has_voicebot_interaction"),
        z("voicebot_call_count").cast("long").alias("voicebot_call_count"),
        z("voicebot_initiated_count").cast("long").alias("voicebot_initiated_count"),
        # G16 timestamps
        c("lead_date"), c("created_at"), c("updated_at"),
        X.ts_literal(computed_at).alias("feature_computed_at"),
    ]
    return cols


def build_features(
    leads: DataFrame, activities: DataFrame, contacts: DataFrame, facebook_events: DataFrame,
    voicebot_logs: DataFrame, users: DataFrame, status_master: DataFrame,
    ref_date: _dt.date, computed_at: _dt.datetime, voicebot_action: str,
    keywords: dict[str, Sequence[str]] | None = None, voicebot_id_path: str = A.VOICEBOT_ID_PATH,
    max_broadcast_rows: int | None = None,
    max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Raw CRM tables → 99-column feature table.

    ``voicebot_action`` is the action type that starts a call.  The group
    statistics are written, and the lookup tables checked, while the plan is
    built; the table itself is lazy.
    """
    act = A.activity_aggregate(activities, **(keywords or {}))
    fb = A.facebook_aggregate(facebook_events)
    vb = A.voicebot_aggregate(voicebot_logs, voicebot_action, voicebot_id_path)
    ld = join_sources(leads, act, contacts, fb, vb, users, status_master, ref_date,
                      max_broadcast_rows, max_broadcast_bytes)
    return ld.select(*feature_columns(ld, ref_date, computed_at))
