"""Property test: the gold report equals a brute-force Python computation
on random small silver tables (ties, null keys, null times, static assets)."""

import datetime as dt
import re
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidelog.functions.http import ROBOTS_PATH, STATIC_ASSET_RE
from tidelog.operators.report import access_report

SCHEMA = "client_ip string, timestamp timestamp, endpoint_clean string, status_code int, response_size bigint"
DAYS = [None] + [dt.datetime(2024, 1, d, h) for d in (1, 2, 3, 6, 7) for h in (0, 23)]
ROW = st.tuples(
    st.sampled_from(["a", "b", "c", "d", "", None]),
    st.sampled_from(DAYS),
    st.sampled_from(["/", "/a", "/b/", "/x.css", "/y.JS?v=1", ROBOTS_PATH, "/p.png#t", "", None]),
    st.sampled_from([200, 301, 400, 404, 499, 500, None]),
    st.sampled_from([None, 0, 7, 10 ** 12]),
)


def rank(counter, k):
    key = lambda kv: (-kv[1], kv[0] is None, kv[0] or "")
    return [tuple(x) for x in sorted(counter.items(), key=key)[:k]]


def brute(rows):
    ips = Counter(r[0] for r in rows)
    pages = Counter(r[2] for r in rows
                    if r[2] is not None and not re.search(STATIC_ASSET_RE, r[2].lower()) and r[2] != ROBOTS_PATH)
    errors = Counter(r[1].strftime("%A") if r[1] else None for r in rows if r[3] is not None and 400 <= r[3] <= 499)
    sizes = [float(r[4]) for r in rows if r[4] is not None]
    worst = rank(errors, 1)
    return {
        "top_ips": rank(ips, 10),
        "top_endpoints": rank(pages, 6),
        "distinct_ip_count": len({r[0] for r in rows if r[0] is not None}),
        "distinct_day_count": len({r[1].date() for r in rows if r[1] is not None}),
        "day_with_most_client_errors": worst[0][0] if worst else None,
        "total_volume": sum(sizes) if sizes else None,
        "max_volume": max(sizes) if sizes else None,
        "min_volume": min(sizes) if sizes else None,
        "avg_volume": sum(sizes) / len(sizes) if sizes else None,
    }


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(ROW, min_size=0, max_size=60))
def test_report_matches_brute_force(spark, rows):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    got = access_report(spark.createDataFrame(rows, SCHEMA)).first().asDict(recursive=True)
    got["top_ips"] = [(x["client_ip"], x["access_count"]) for x in got["top_ips"]]
    got["top_endpoints"] = [(x["endpoint"], x["access_count"]) for x in got["top_endpoints"]]
    assert got == brute(rows)
