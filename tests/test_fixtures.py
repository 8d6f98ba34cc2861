"""The reference's 13 model fixtures (names of people replaced)."""

import datetime as dt

from builders import A, B, closers, deals, flags, meeting_deals, meetings, rows_of, stages

from dealflow.operators import models as M

AS_OF = dt.date(2026, 8, 17)
D = dt.date


# ---------------------------------------------------------------- meetings


def test_first_call_dedup_per_deal_and_category(spark):
    m = meetings(spark, [
        {"meeting_id": 1, "owner_id": A, "activity_type": "Renewal Strategy", "meeting_outcome": "COMPLETED", "meeting_start_at": "2026-08-01 10:00:00"},
        {"meeting_id": 2, "owner_id": A, "activity_type": "Renewal Follow-up", "meeting_outcome": "COMPLETED", "meeting_start_at": "2026-08-05 10:00:00"},
        {"meeting_id": 3, "owner_id": A, "activity_type": "Renewal Strategy", "meeting_outcome": "COMPLETED", "meeting_start_at": "2026-08-10 10:00:00"},
        {"meeting_id": 4, "owner_id": A, "activity_type": "Renewal 3 Month", "meeting_outcome": "COMPLETED", "meeting_start_at": "2026-08-01 09:00:00"},
        {"meeting_id": 5, "owner_id": A, "activity_type": "Renewal Strategy", "meeting_outcome": "CANCELED", "meeting_start_at": "2026-07-28 10:00:00"},
    ])
    md = meeting_deals(spark, [{"meeting_id": i, "deal_id": 100} for i in (1, 2, 4, 5)])
    out = M.meetings(m, md, closers(spark, [(A, "Closer A")]))
    cols = ["meeting_id", "closer_owner_id", "meeting_category", "deal_id", "is_booked", "is_completed", "is_first_call"]
    assert rows_of(out, cols) == sorted([
        (1, A, "RC", 100, True, True, True),
        (2, A, "RC", 100, True, True, False),
        (3, A, "RC", None, True, True, True),
        (4, A, "PC", 100, True, True, True),
        (5, A, "RC", 100, False, False, True),
    ], key=lambda t: str(t))


def test_closing_call_flag_and_retired_types(spark):
    m = meetings(spark, [
        {"meeting_id": 10, "owner_id": A, "activity_type": "Renewal Accelerator Evergreen", "meeting_outcome": "COMPLETED", "meeting_start_at": "2026-08-01 10:00:00"},
        {"meeting_id": 11, "owner_id": A, "activity_type": "Renewal Follow-up", "meeting_outcome": "COMPLETED", "meeting_start_at": "2026-08-02 10:00:00"},
        {"meeting_id": 12, "owner_id": A, "activity_type": "Renewal Strategy", "meeting_outcome": "COMPLETED", "meeting_start_at": "2026-08-03 10:00:00"},
    ])
    out = M.meetings(m, meeting_deals(spark, []), closers(spark, [(A, "Closer A")]))
    cols = ["meeting_id", "activity_type", "meeting_category", "is_completed", "is_closing_call"]
    assert rows_of(out, cols) == [(11, "Renewal Follow-up", "RC", True, False),
                                  (12, "Renewal Strategy", "RC", True, True)]


# ---------------------------------------------------------------- won deals

WON_COLS = ["deal_id", "closer_owner_id", "pipeline_id", "dealstage_id", "close_date_et", "cash_collected",
            "is_post_webinar_close"]


def test_won_deals_include_winback_on_won_stage(spark):
    d = deals(spark, [
        {"deal_id": 1, "closer_owner_id": A, "pipeline_id": "917643668", "dealstage_id": "1401758776", "close_date": "2026-08-01", "cash_collected": 12000},
        {"deal_id": 2, "closer_owner_id": A, "pipeline_id": "95211801", "dealstage_id": "175346331", "close_date": "2026-08-01", "cash_collected": 5000},
        {"deal_id": 3, "closer_owner_id": A, "pipeline_id": "917643668", "dealstage_id": "1401758773", "close_date": "2026-08-01", "cash_collected": 0},
    ])
    out = M.won_deals(d, closers(spark, [(A, "Closer A")]))
    assert rows_of(out, WON_COLS) == [
        (1, A, "917643668", "1401758776", D(2026, 8, 1), 12000.0, False),
        (2, A, "95211801", "175346331", D(2026, 8, 1), 5000.0, False),
    ]


def test_won_deals_exclude_non_won_and_non_roster(spark):
    d = deals(spark, [
        {"deal_id": 1, "closer_owner_id": A, "pipeline_id": "95211801", "dealstage_id": "175346325", "close_date": "2026-08-01", "cash_collected": 5000},
        {"deal_id": 2, "closer_owner_id": "999999999", "pipeline_id": "95211801", "dealstage_id": "175346331", "close_date": "2026-08-01", "cash_collected": 5000},
    ])
    assert M.won_deals(d, closers(spark, [(A, "Closer A")])).count() == 0


def test_won_deals_post_webinar_attribution(spark):
    base = {"closer_owner_id": A, "pipeline_id": "95211801", "dealstage_id": "175346331", "close_date": "2026-08-01", "cash_collected": 5000}
    d = deals(spark, [dict(base, deal_id=1, renewal_traffic_source="Webinar"), dict(base, deal_id=2, renewal_traffic_source=""),
                      dict(base, deal_id=3, renewal_traffic_source=None)])
    out = M.won_deals(d, closers(spark, [(A, "Closer A")]))
    assert dict(rows_of(out, ["deal_id", "is_post_webinar_close"])) == {1: True, 2: False, 3: False}


# ---------------------------------------------------------------- pipeline snapshot

SNAP_COLS = ["closer_owner_id", "closer_name", "pipeline_id", "stage_group", "snapshot_col", "deal_id", "entry_date_et"]
NEW_MEMBER = {"stage_id": "1359829634", "pipeline_id": "898243912", "stage_group": "renewal_pipeline", "snapshot_col": "new_member"}


def snap(spark, deal_rows, stage_rows, flag_rows=(), roster=None):
    return M.fct_pipeline_snapshot(deals(spark, deal_rows), flags(spark, list(flag_rows)), stages(spark, stage_rows),
                                   closers(spark, roster), AS_OF)


def test_snapshot_maps_winback_and_renewal_stages(spark):
    out = snap(spark, [
        {"deal_id": 1, "closer_owner_id": A, "pipeline_id": "917643668", "dealstage_id": "1401758773", "date_entered_current_stage": "2026-06-15T18:00:00"},
        {"deal_id": 2, "closer_owner_id": A, "pipeline_id": "917643668", "dealstage_id": "1401758773", "date_entered_current_stage": "2026-06-20T18:00:00"},
        {"deal_id": 3, "closer_owner_id": B, "pipeline_id": "95211801", "dealstage_id": "175346325", "date_entered_current_stage": "2026-07-01T18:00:00"},
    ], [{"stage_id": "1401758773", "pipeline_id": "917643668", "stage_group": "winback", "snapshot_col": "wb_booked"},
        {"stage_id": "175346325", "pipeline_id": "95211801", "stage_group": "progress_call", "snapshot_col": "pc_scheduled"}])
    assert rows_of(out, SNAP_COLS) == sorted([
        (A, "Closer A", "917643668", "winback", "wb_booked", 1, D(2026, 6, 15)),
        (A, "Closer A", "917643668", "winback", "wb_booked", 2, D(2026, 6, 20)),
        (B, "Closer B", "95211801", "progress_call", "pc_scheduled", 3, D(2026, 7, 1)),
    ], key=lambda t: str(t))


def test_snapshot_drops_unknown_stage_and_non_roster_owner(spark):
    out = snap(spark, [
        {"deal_id": 1, "closer_owner_id": A, "pipeline_id": "000000000", "dealstage_id": "000000000"},
        {"deal_id": 2, "closer_owner_id": "999999999", "pipeline_id": "917643668", "dealstage_id": "1401758773"},
    ], [{"stage_id": "1401758773", "pipeline_id": "917643668", "stage_group": "winback", "snapshot_col": "wb_booked"}],
        roster=[(A, "Closer A")])
    assert out.count() == 0


def test_snapshot_excludes_internal_test_contacts(spark):
    st = [{"stage_id": "175346325", "pipeline_id": "95211801", "stage_group": "progress_call", "snapshot_col": "pc_scheduled"}]
    out = snap(spark, [
        {"deal_id": 1, "closer_owner_id": A, "pipeline_id": "95211801", "dealstage_id": "175346325", "date_entered_current_stage": "2026-06-15T18:00:00"},
        {"deal_id": 2, "closer_owner_id": A, "pipeline_id": "95211801", "dealstage_id": "175346325", "date_entered_current_stage": "2026-06-18T18:00:00"},
    ], st, [{"deal_id": 1, "is_test_contact": True}], roster=[(A, "Closer A")])
    assert rows_of(out, SNAP_COLS) == [(A, "Closer A", "95211801", "progress_call", "pc_scheduled", 2, D(2026, 6, 18))]


def test_snapshot_rc_due_45_days_before_expiration(spark):
    out = snap(spark, [{"deal_id": 1, "closer_owner_id": A, "pipeline_id": "898243912", "dealstage_id": "1359841792",
                        "membership_expiration_date": "2026-09-05"}],
               [{"stage_id": "1359841792", "pipeline_id": "898243912", "stage_group": "renewal_pipeline", "snapshot_col": "pc_invited"}],
               roster=[(A, "Closer A")])
    assert rows_of(out, SNAP_COLS) == [(A, "Closer A", "898243912", "renewal_call", "rc_due", 1, D(2026, 7, 22))]


def test_snapshot_pc_due_15_days_before_midpoint(spark):
    out = snap(spark, [{"deal_id": 1, "closer_owner_id": A, "pipeline_id": "898243912", "dealstage_id": "1359829634",
                        "close_date": "2026-02-15", "membership_expiration_date": "2027-02-15"}], [NEW_MEMBER],
               roster=[(A, "Closer A")])
    assert rows_of(out, SNAP_COLS) == [(A, "Closer A", "898243912", "progress_call", "pc_due", 1, D(2026, 8, 1))]


def test_snapshot_pc_due_has_no_upper_bound(spark):
    out = snap(spark, [{"deal_id": 1, "closer_owner_id": A, "pipeline_id": "898243912", "dealstage_id": "1359829634",
                        "close_date": "2020-01-01", "membership_expiration_date": "2021-01-01"}], [NEW_MEMBER],
               roster=[(A, "Closer A")])
    assert rows_of(out, SNAP_COLS) == [(A, "Closer A", "898243912", "progress_call", "pc_due", 1, D(2020, 6, 17))]


def test_snapshot_pc_due_falls_back_to_contact_date(spark):
    out = snap(spark, [{"deal_id": 1, "closer_owner_id": A, "pipeline_id": "898243912", "dealstage_id": "1359829634",
                        "membership_expiration_date": "2027-02-15"}], [NEW_MEMBER],
               [{"deal_id": 1, "contact_true_renewal_close_date": "2026-02-15T00:00:00"}], roster=[(A, "Closer A")])
    assert rows_of(out, SNAP_COLS) == [(A, "Closer A", "898243912", "progress_call", "pc_due", 1, D(2026, 8, 1))]


def test_snapshot_rc_due_wins_over_pc_due(spark):
    out = snap(spark, [{"deal_id": 1, "closer_owner_id": A, "pipeline_id": "898243912", "dealstage_id": "1359829634",
                        "close_date": "2026-07-25", "membership_expiration_date": "2026-09-05"}], [NEW_MEMBER],
               roster=[(A, "Closer A")])
    assert rows_of(out, SNAP_COLS) == [(A, "Closer A", "898243912", "renewal_call", "rc_due", 1, D(2026, 7, 22))]
