"""The aggregate-based rewrites of the two ROW_NUMBER windows (W1, W2) against a
plain-Python evaluation of the window semantics on random inputs (ties, NULLs, hot groups)."""

import datetime as dt
import random

from builders import A, closers, deals, meeting_deals, meetings

from dealflow.operators import models as M
from dealflow.operators import staging as ST

TRACKED = {"95211801", "898243912", "917643668"}


def _w1_expected(assoc_rows, deal_pipe):
    best = {}
    for mid, did in assoc_rows:
        prio = 0 if deal_pipe.get(did) in TRACKED else 1
        # ORDER BY prio ASC, deal_id DESC with NULL first
        key = (prio, 0 if did is None else 1, -(did or 0))
        if mid not in best or key < best[mid][0]:
            best[mid] = (key, did)
    return {m: v[1] for m, v in best.items()}


def test_one_deal_per_meeting_matches_window_semantics(spark):
    rnd = random.Random(11)
    deal_pipe = {d: rnd.choice(sorted(TRACKED) + ["1", None]) for d in range(40)}
    assoc_rows = []
    for mid in range(300):
        hot = mid < 100  # a third of the meetings share few deals
        for _ in range(rnd.randint(1, 4)):
            assoc_rows.append((mid, rnd.choice([0, 1]) if hot else rnd.choice(list(range(40)) + [None, 99])))
    assoc = spark.createDataFrame(assoc_rows, "engagement_id long, deal_id long")
    d = deals(spark, [{"deal_id": k, "pipeline_id": v} for k, v in deal_pipe.items()])
    got = dict(ST.one_deal_per_meeting(assoc, d).collect())
    assert got == _w1_expected(assoc_rows, deal_pipe)


def _w2_expected(rows, links):
    live = {"Renewal Strategy": "RC", "Renewal Accelerator": "RC", "Renewal Follow-up": "RC",
            "Renewal Post Webinar Call": "PWC", "Renewal Winback Call": "WB"}
    groups = {}
    for mid, act, outcome, start in rows:
        cat = live.get(act)
        did = links.get(mid)
        if cat and outcome == "COMPLETED" and did is not None:
            key = (start is None, start or dt.datetime.min, mid)
            g = groups.setdefault((did, cat), [])
            g.append((key, mid))
    first = {min(g)[1] for g in groups.values()}
    out = {}
    for mid, act, outcome, start in rows:
        if act in live or act in ("Renewal 3 Month",):
            eligible = act in live and outcome == "COMPLETED" and links.get(mid) is not None
            out[mid] = (mid in first) if eligible else True
    return out


def test_first_call_matches_window_semantics(spark):
    rnd = random.Random(5)
    acts = ["Renewal Strategy", "Renewal Follow-up", "Renewal Post Webinar Call", "Renewal Winback Call",
            "Renewal 3 Month"]
    rows, links = [], {}
    for mid in range(400):
        start = None if rnd.random() < 0.08 else dt.datetime(2026, 8, 1 + rnd.randint(0, 3), rnd.choice([9, 10]))
        rows.append((mid, rnd.choice(acts), rnd.choice(["COMPLETED", "COMPLETED", "CANCELED", None]), start))
        r = rnd.random()
        links[mid] = None if r < 0.15 else (7 if r < 0.5 else rnd.randint(0, 30))  # deal 7 is hot
    m = meetings(spark, [{"meeting_id": a, "owner_id": A, "activity_type": b, "meeting_outcome": c,
                          "meeting_start_at": d.isoformat() if d else None} for a, b, c, d in rows])
    md = meeting_deals(spark, [{"meeting_id": k, "deal_id": v} for k, v in links.items() if v is not None])
    got = dict(M.meetings(m, md, closers(spark)).select("meeting_id", "is_first_call").collect())
    assert got == _w2_expected(rows, links)
