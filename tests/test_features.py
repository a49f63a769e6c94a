"""Hand-made CRM tables with every trap the feature build must handle."""
import datetime as dt

import pytest

from leadlens.operators import aggregates as A
from leadlens.operators import features as G
from leadlens.operators import summaries as S

REF = dt.date(2024, 2, 1)
NOW = dt.datetime(2024, 2, 1, 12, 0)

LEAD_SCHEMA = ("id long, contact_id long, is_interested int, deleted_at timestamp, lead_channel string, "
               "source_medium string, campaign_name string, lead_owner long, previous_lead_owner long, "
               "lead_date string, created_at string, updated_at string, interested_date_time string, "
               "call_count int, sms_count int, email_count int, whatsapp_count int, lead_status string, "
               "lead_sub_status string, previous_lead_status string, ctc_annual_package string, "
               "experience string, company_name string, designation string, salary_increment string, "
               "email string, gender string, dob string, state string, city string, "
               "alternate_mobile_number string, best_time_to_call string, qualification string, "
               "pain_points string, is_chatbot int, is_voicebot int, duplicate_check int, lead_type string, "
               "course long, university_interested long")


def _lead(i, **kw):
    base = dict(id=i, contact_id=100 + i, is_interested=1, deleted_at=None, lead_channel="web",
                source_medium="cpc", campaign_name="camp", lead_owner=7, previous_lead_owner=None,
                lead_date="2024-01-30 10:00:00", created_at="2024-01-30 10:00:00",
                updated_at="2024-01-31 10:00:00", interested_date_time=None, call_count=1, sms_count=0,
                email_count=None, whatsapp_count=2, lead_status="1", lead_sub_status="2.0",
                previous_lead_status=None, ctc_annual_package="5L", experience="3", company_name="Acme",
                designation="Eng", salary_increment=None, email="a@b.c", gender="F", dob="1990",
                state="KA", city="BLR", alternate_mobile_number=None, best_time_to_call="eve",
                qualification="BE", pain_points="\t", is_chatbot=0, is_voicebot=None, duplicate_check=0,
                lead_type="inbound", course=3, university_interested=None)
    base.update(kw)
    return tuple(base[c.split()[0]] for c in LEAD_SCHEMA.split(", "))


@pytest.fixture(scope="module")
def crm(spark):
    leads = spark.createDataFrame([
        _lead(1),
        _lead(2, lead_channel=None, is_interested=0, campaign_name="  ", lead_owner=None,
              previous_lead_owner=5, email="", lead_status="12.5", lead_date="bad date"),
        _lead(3, lead_channel=None, is_interested=None, campaign_name=None, lead_owner=99,
              email="default@x.io", lead_date="2024-02-05 08:00:00", previous_lead_status="1"),
        _lead(4, deleted_at=NOW),
        _lead(5, lead_channel="web", is_interested=0, previous_lead_owner=7, lead_status="x"),
    ], LEAD_SCHEMA)
    acts = spark.createDataFrame([
        (1, 10, "Answered", 30.0, "rec", 500, dt.datetime(2024, 1, 30, 10, 30), "Student is not interested", None),
        (1, 11, None, 0.0, None, None, dt.datetime(2024, 1, 30, 12, 0), "asked about coffee", "fee"),
        (1, 11, "busy", None, None, 501, dt.datetime(2024, 1, 31, 9, 0), None, None),
        (5, 12, "CONNECTED", 10.0, None, None, dt.datetime(2024, 1, 30, 18, 0), "wrong number", None),
    ], "lead_id long, activity_id long, call_status string, duration double, call_recordings string, "
       "follow_up_id long, created_at timestamp, activity_details string, description string")
    contacts = spark.createDataFrame([(101, 3, None), (103, 1, 0)], "id long, lead_count int, is_domestic int")
    fb = spark.createDataFrame([(1, True, None), (1, False, 2), (3, True, 1)],
                               "lead_id long, success boolean, retry_count int")
    vb = spark.createDataFrame([('{"lead_id": "1"}', "202", "start_call"),
                                ('{"lead_id": "12.5"}', "500", "start_call"),
                                ("{malformed", "202", "start_call"),
                                ('{"lead_id": 5}', "202", "other_action")],
                               "request string, status_code string, action_type string")
    users = spark.createDataFrame([(7, 1, None, 3), (99, 1, NOW, 4)],
                                  "id long, status int, deleted_at timestamp, role_id int")
    status = spark.createDataFrame([(1, "New"), (12, "Twelve"), (13, "Thirteen"), (2, "Two")], "id long, name string")
    return leads, acts, contacts, fb, vb, users, status


@pytest.fixture(scope="module")
def feats(crm):
    f = G.build_features(*crm, ref_date=REF, computed_at=NOW, voicebot_action="start_call").toPandas()
    return f.set_index("lead_id")


def test_shape_and_soft_delete(feats):
    assert len(feats.columns) + 1 == 99
    assert sorted(feats.index) == [1, 2, 3, 5]


def test_null_channel_is_a_group(feats):
    # leads 2 and 3 share the null channel: cvr = mean(0, null) = 0, volume 2
    assert feats.loc[2, "channel_historical_cvr"] == 0.0 and feats.loc[2, "channel_volume"] == 2
    assert feats.loc[1, "channel_volume"] == 2 and feats.loc[1, "channel_historical_cvr"] == 0.5


def test_blank_campaign_misses(feats):
    assert feats.loc[2, "has_campaign"] == 0 and feats.loc[2, "campaign_volume"] == 0
    assert feats.loc[1, "campaign_volume"] == 2


def test_owner_lookup_and_reassignment(feats):
    assert feats.loc[1, "is_owner_active"] == 1 and feats.loc[1, "owner_role_id"] == 3
    assert feats.loc[3, "is_owner_active"] == 0  # deleted user
    assert feats.loc[2, "is_owner_active"] == 0 and feats.loc[2, "was_reassigned"] == 1  # null owner
    assert feats.loc[5, "was_reassigned"] == 0


def test_activity_aggregate_and_keywords(feats):
    r = feats.loc[1]
    assert r.total_activities == 3 and r.unique_activity_types == 2 and r.total_calls_logged == 2
    assert r.answered_calls == 1 and r.total_call_duration_sec == 30.0 and r.avg_call_duration_sec == 30.0
    assert r.followup_count == 2 and r.calls_with_recording == 1
    # "not interested" counts as positive and negative; "coffee" matches "fee"
    assert r.positive_intent_kw_count == 2 and r.negative_intent_kw_count == 1
    assert r.call_answer_rate == 0.5
    assert feats.loc[2, "never_contacted"] == 1 and feats.loc[2, "total_activities"] == 0


def test_time_features(feats):
    assert feats.loc[1, "minutes_to_first_contact"] == 30.0 and feats.loc[1, "contacted_within_1hr"] == 1
    assert feats.loc[3, "lead_age_days"] == -4  # future lead
    assert feats.loc[2, "lead_hour_of_day"] != feats.loc[2, "lead_hour_of_day"] or \
        feats.loc[2, "lead_hour_of_day"] is None  # bad date → null
    assert feats.loc[2, "is_fresh_7d"] == 0


def test_status_lookup_numeric_coercion(feats):
    assert feats.loc[1, "lead_status_name"] == "New"
    assert feats.loc[1, "lead_sub_status_name"] == "Two"
    assert feats.loc[2, "lead_status_name"] is None  # 12.5 is not an id
    assert feats.loc[5, "lead_status_name"] is None  # 'x'
    assert feats.loc[3, "status_changed"] == 0 and feats.loc[1, "status_changed"] == 0


def test_profile_and_email(feats):
    assert feats.loc[1, "has_pain_points"] == 0  # tab only
    assert feats.loc[2, "has_real_email"] == 1  # empty string counts as real
    assert feats.loc[3, "has_real_email"] == 0
    assert feats.loc[1, "is_employed_professional"] == 1


def test_contact_facebook_voicebot(feats):
    assert feats.loc[1, "contact_lead_count"] == 3 and feats.loc[1, "is_domestic"] == 1
    assert feats.loc[1, "is_repeat_contact"] == 1
    assert feats.loc[2, "contact_lead_count"] == 0 and feats.loc[2, "is_domestic"] == 1
    assert feats.loc[1, "fb_events_count"] == 2 and feats.loc[1, "fb_event_success_rate"] == 0.5
    assert feats.loc[1, "voicebot_call_count"] == 1 and feats.loc[1, "voicebot_initiated_count"] == 1
    assert feats.loc[5, "has_voicebot_interaction"] == 0


def test_voicebot_id_rounds_like_warehouse(spark, crm):
    vb = A.voicebot_aggregate(crm[4], "start_call").toPandas()
    assert sorted(int(x) for x in vb["lead_id"]) == [1, 13]


def test_correlation_constant_column_is_null(spark, crm):
    f = G.build_features(*crm, ref_date=REF, computed_at=NOW, voicebot_action="start_call")
    out = S.target_correlations(f).toPandas()
    assert out["correlation"].abs().is_monotonic_decreasing and len(out) <= 15
    df = spark.createDataFrame([(1, 0, 5.0), (1, 1, 6.0), (1, 0, 7.0)], "c int, y int, x double")
    corr = {r.feature: r.correlation for r in S.target_correlations(df, "y", ["c", "x"]).collect()}
    assert "c" not in corr and abs(corr["x"]) < 1e-12  # constant column dropped, no ANSI error


def test_run_feature_build_writes_and_summarises(spark, crm, feats, tmp_path):
    from leadlens.plans.feature_build import run_feature_build
    from leadlens.sources.testviews import CrmTables

    stored, stats, corr = run_feature_build(CrmTables(*crm), str(tmp_path / "features"), REF, NOW,
                                             voicebot_action="start_call")
    assert sorted(r.lead_id for r in stored.select("lead_id").collect()) == sorted(feats.index)
    assert len(stored.columns) == 99
    s = stats.first()
    assert s.total_rows == 4 and s.positive_class == int(feats["is_interested"].sum())
    assert corr.count() <= 15
