"""Project constants as one frozen dataclass.

Every operator takes a ``PipelineConfig`` instead of reading globals, so the same
code runs on the CRM tables, on the fixtures and on the stand-in tables derived
from the driver's parquet files.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values (must equal the reference for the same results) -----------------
# Pipelines: old renewal sales pipeline, new renewal pipeline, win-back pipeline.
OLD_RENEWAL_PIPELINE_ID = "95211801"
NEW_RENEWAL_PIPELINE_ID = "898243912"
WINBACK_PIPELINE_ID = "917643668"
# Closed-won stages of the two renewal pipelines, and of the win-back pipeline.
WON_STAGE_IDS = ("175346331", "229787714", "1359841456")
WINBACK_WON_STAGE_IDS = ("1401758776",)
# Stage-entry columns: (entry type, raw column in the new pipeline, raw column in the old pipeline).
STAGE_ENTRY_SOURCES = (
    ("pc_invited", "property_hs_v_2_date_entered_1359841792", "property_hs_v_2_date_entered_240516941"),
    ("pc_scheduled", "property_hs_v_2_date_entered_1359841793", "property_hs_v_2_date_entered_175346325"),
    ("rc_invited", "property_hs_v_2_date_entered_1359841800", "property_hs_v_2_date_entered_240516942"),
    ("rc_scheduled", "property_hs_v_2_date_entered_1359841801", "property_hs_v_2_date_entered_186350393"),
)
# Meeting activity types per category; two former RC types are retired and map to nothing.
PC_ACTIVITY_TYPES = ("Renewal 3 Month", "Renewal Accelerator 3 month")
RC_ACTIVITY_TYPES = ("Renewal Strategy", "Renewal Accelerator", "Renewal Follow-up")
PWC_ACTIVITY_TYPES = ("Renewal Post Webinar Call",)
WB_ACTIVITY_TYPES = ("Renewal Winback Call",)
RETIRED_ACTIVITY_TYPES = ("Renewal Strategy Alignment", "Renewal Accelerator Evergreen")
FOLLOW_UP_ACTIVITY_TYPE = "Renewal Follow-up"
CANCELED_OUTCOMES = ("CANCELED", "CANCELLED")
COMPLETED_OUTCOME = "COMPLETED"
LIVE_CATEGORIES = ("RC", "PWC", "WB")
TEST_LEAD_STATUS = "Internal Test Record"
WEBINAR_TRAFFIC_SOURCE = "Webinar"
RC_DUE_DAYS = 45
PC_DUE_LEAD_DAYS = 15
PRE_RC_SNAPSHOT_COLS = ("new_member", "pc_invited", "pc_scheduled", "pc_not_cmplt", "pc_completed")
PRE_PC_SNAPSHOT_COLS = ("new_member",)
PRODUCT_COLUMNS = ("ACC_TIER", "MM_TIER", "TERM_2", "WINBACK", "UNMAPPED")
TIER_COLUMNS = ("ACC_TIER", "MM_TIER", "TERM_2", "UNMAPPED")
SNAPSHOT_COLS = (
    "pc_due", "pc_invited", "pc_scheduled", "pc_not_cmplt", "pc_completed",
    "rc_due", "rc_invited", "rc_scheduled", "rc_not_cmplt",
    "nurture", "redzone", "closed_won", "closed_lost", "new_member",
    "wb_eligible", "wb_attempting", "wb_booked", "wb_not_complete", "wb_nurture",
    "wb_redzone", "wb_closed_won", "wb_closed_lost",
)
TIMEZONE = "America/New_York"
# Dashboard targets (team level) and traffic-light thresholds.
TEAM_TARGETS = {"cash": 350_000.0, "deals": 30.0, "close_pct": 30.0, "dpl": 3_500.0}
STATUS_YELLOW_FROM = 0.6
# Reconciliation tolerances.
CASH_TOLERANCE = 1.00
RATIO_TOLERANCE = 0.02
# Source freshness (hours).
FRESHNESS_WARN_HOURS = 4
FRESHNESS_ERROR_HOURS = 8
# --- end of fixed values ----------------------------------------------------------


@dataclass(frozen=True)
class CashComponent:
    """One dated payment stored side by side on a deal row.

    ``date_rule`` is ``"close"`` (the deal's close date), ``"date"`` (a midnight-anchored
    date property: plain cast) or ``"instant"`` (a real timestamp: ET conversion).
    """

    name: str
    amount_col: str
    date_col: str | None
    date_rule: str = "date"


DEFAULT_COMPONENTS = (
    CashComponent("base", "cash_collected", None, "close"),
    CashComponent("ap1", "ap1_amount", "ap1_stamped_at"),
    CashComponent("ap2", "ap2_amount", "ap2_stamped_at"),
    CashComponent("ap3", "ap3_amount", "ap3_stamped_at"),
    CashComponent("ap4", "ap4_amount", "ap4_stamped_at"),
    CashComponent("ap11", "ap11_amount", "ap11_stamped_at"),
    CashComponent("ap12", "ap12_amount", "ap12_stamped_at"),
)


@dataclass(frozen=True)
class PipelineConfig:
    renewal_pipeline_ids: tuple = (OLD_RENEWAL_PIPELINE_ID, NEW_RENEWAL_PIPELINE_ID)
    old_pipeline_id: str = OLD_RENEWAL_PIPELINE_ID
    new_pipeline_id: str = NEW_RENEWAL_PIPELINE_ID
    winback_pipeline_id: str = WINBACK_PIPELINE_ID
    won_stage_ids: tuple = WON_STAGE_IDS
    winback_won_stage_ids: tuple = WINBACK_WON_STAGE_IDS
    stage_entry_sources: tuple = STAGE_ENTRY_SOURCES
    components: tuple = DEFAULT_COMPONENTS
    timezone: str = TIMEZONE
    rc_due_days: int = RC_DUE_DAYS
    pc_due_lead_days: int = PC_DUE_LEAD_DAYS
    test_lead_status: str = TEST_LEAD_STATUS
    webinar_source: str = WEBINAR_TRAFFIC_SOURCE
    # Upper bound on rows of a dimension we are willing to broadcast.
    max_broadcast_rows: int = 100_000
    extra_deal_columns: tuple = field(default=("renewal_product", "renewal_pipeline_type"))

    @property
    def tracked_pipeline_ids(self) -> tuple:
        return tuple(self.renewal_pipeline_ids) + (self.winback_pipeline_id,)

    @property
    def all_won_stage_ids(self) -> tuple:
        return tuple(self.won_stage_ids) + tuple(self.winback_won_stage_ids)


DEFAULT = PipelineConfig()
