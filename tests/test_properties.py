"""Property tests: the distributed operators against direct Python models."""

from hypothesis import given, settings
from hypothesis import strategies as st

from playback_qos.functions.qos import tier_ranking
from playback_qos.operators.telemetry import buffering_intervals
from playback_qos.schema import EVT_BUFFER_END, EVT_BUFFER_START, TIERS

EVENTS = st.lists(
    st.tuples(
        st.sampled_from(["s1", "s2", "s3"]),
        st.integers(min_value=0, max_value=40),
        st.sampled_from([EVT_BUFFER_START, EVT_BUFFER_END, "quality_change"]),
    ),
    min_size=0,
    max_size=60,
)


def model(rows):
    """The collector's rules, one session at a time, in (time, seq) order."""
    out = []
    for session in sorted({r[0] for r in rows}):
        pending = None
        for _, ts, kind, _seq in sorted(
            (r for r in rows if r[0] == session), key=lambda r: (r[1], r[3])
        ):
            if kind == EVT_BUFFER_START:
                pending = ts
            elif kind == EVT_BUFFER_END and pending is not None:
                out.append((session, pending, ts, ts - pending))
                pending = None
    return sorted(out)


@settings(max_examples=12, deadline=None)
@given(EVENTS, st.sampled_from([1, 2, 5, 1000]))
def test_intervals_match_model(spark, events, bucket_ms):
    rows = [(s, ts, kind, i) for i, (s, ts, kind) in enumerate(events)]
    df = spark.createDataFrame(
        rows, "sessionId string, timestamp long, event_type string, seq long"
    )
    got = buffering_intervals(
        df, order=("timestamp", "seq"), bucket_ms=bucket_ms
    ).collect()
    assert sorted(tuple(r) for r in got) == model(rows)


@given(st.sets(st.sampled_from(TIERS)))
def test_lexical_rank_order_is_string_order(present):
    ranking = tier_ranking("lexical")
    if present:
        assert max(present, key=ranking.index) == max(present)


# --- data-quality rules -----------------------------------------------------

import math  # noqa: E402

from playback_qos.operators.quality import dq_results, valid_rows  # noqa: E402
from tests.rows import raw_df, raw_row, traffic  # noqa: E402

DQ_ROWS = st.lists(
    st.tuples(
        st.sampled_from(["c", None]),
        st.sampled_from([None, -1, 0, 3]),
        st.sampled_from([None, -0.5, 0.0, 0.5, 1.0, 1.5, math.nan]),
    ),
    min_size=0,
    max_size=25,
)


@settings(max_examples=10, deadline=None)
@given(DQ_ROWS)
def test_dq_counts_match_model(spark, rows):
    df = raw_df(spark, [raw_row(customer=c, bufferings=b, src=traffic(responses=r))
                        for c, b, r in rows])
    got = {r["rule_name"]: (r["passed_count"], r["failed_count"])
           for r in dq_results(df, with_timestamp=False).collect()}
    n = len(rows)
    f1 = sum(c is None for c, _, _ in rows)
    f2 = sum(b is not None and b < 0 for _, b, _ in rows)
    f3 = sum(r is not None and (math.isnan(r) or r < 0 or r > 1) for _, _, r in rows)
    assert got["required_fields_not_null"] == (n - f1, f1)
    assert got["bufferings_non_negative"] == (n - f2, f2)
    assert got["responses_between_0_and_1"] == (n - f3, f3)
    valid = sum(c is not None and b is not None and b >= 0 and r is not None
                and not math.isnan(r) and 0 <= r <= 1 for c, b, r in rows)
    assert valid_rows(df).count() == valid


# --- gold aggregate -----------------------------------------------------------

from playback_qos.operators.gold import viewer_qos  # noqa: E402
from tests.rows import silver_df, silver_row  # noqa: E402

TIER_SETS = st.tuples(*[st.sampled_from([None, 0, 1]) for _ in TIERS])
GOLD_ROWS = st.lists(
    st.tuples(
        st.sampled_from(["a", "b"]),
        st.sampled_from([None, 0, 50]),            # bufferingTime
        st.sampled_from([None, 0, 2]),             # bufferings
        st.sampled_from([None, 0, 100, 300]),      # src bytes
        st.sampled_from([None, 0, 200]),           # p2p bytes
        TIER_SETS,
    ),
    min_size=1,
    max_size=20,
)


def gold_model(rows):
    out = {}
    for cust in sorted({r[0] for r in rows}):
        rs = [r for r in rows if r[0] == cust]
        totals = [(s or 0) + (p or 0) for _, _, _, s, p, _ in rs]
        ratios = [(t_ / tot if t_ is not None else None) if tot > 0 else 0.0
                  for (_, t_, _, _, _, _), tot in zip(rs, totals)]
        shares = [(p / tot if p is not None else None) if tot > 0 else 0.0
                  for (_, _, _, _, p, _), tot in zip(rs, totals)]

        def total(xs):
            xs = [x for x in xs if x is not None]
            return sum(xs) if xs else None

        def mean(xs):
            xs = [x for x in xs if x is not None]
            return sum(xs) / len(xs) if xs else None

        time_sum = total([r[1] for r in rs])
        tiers = [t for r in rs for t, v in zip(TIERS, r[5]) if v is not None]
        out[cust] = (
            time_sum, total([r[2] for r in rs]), sum(totals), mean(ratios), mean(shares),
            len(rs), max(tiers) if tiers else None,
            (time_sum / sum(totals) if time_sum is not None else None) if sum(totals) > 0 else 0.0,
        )
    return out


def close(a, b):
    if a is None or b is None:
        return a is b
    return abs(a - b) <= 1e-9 * max(1.0, abs(a), abs(b))


@settings(max_examples=10, deadline=None)
@given(GOLD_ROWS)
def test_gold_matches_model(spark, rows):
    df = silver_df(spark, [
        silver_row(customer=c, client=f"x{i}", buffering_time=t, bufferings=b, src_rx=s,
                   p2p_rx=p, tiers=tiers)
        for i, (c, t, b, s, p, tiers) in enumerate(rows)
    ])
    want = gold_model(rows)
    got = {r["customerId"]: r for r in viewer_qos(df).collect()}
    assert set(got) == set(want)
    for cust, w in want.items():
        g = got[cust]
        vals = (g["total_buffering_time"], g["total_bufferings"], g["total_received_data"],
                g["avg_buffering_ratio"], g["avg_p2p_share"], g["event_count"],
                g["max_quality"], g["buffering_ratio"])
        assert vals[0] == w[0] and vals[1] == w[1] and vals[2] == w[2]
        assert close(vals[3], w[3]) and close(vals[4], w[4]) and close(vals[7], w[7])
        assert vals[5] == w[5] and vals[6] == w[6]
