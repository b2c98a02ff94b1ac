"""End-to-end example: an access log delivered to a landing folder → gold report.

    python examples/access_log.py <landing folder> <lake folder> [file name]

The gold step is driven by SQL text, as pipelines configured with a SQL
parameter are; ``gold_builder=access_report`` gives the same table from
the DataFrame form.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidelog import PipelineSpec, access_report_sql, log_analysis, monitoring_analysis, run  # noqa: E402
from tidelog.session import local_session  # noqa: E402


def main() -> None:
    landing, lake = sys.argv[1], sys.argv[2]
    file_name = sys.argv[3] if len(sys.argv) > 3 else "access_log.txt"
    spark = local_session()
    spec = PipelineSpec(
        pipeline_name="access_log",
        file_name=file_name,
        landing_path=landing,
        base_path=lake,
        table_name_bronze="b_access_logs",
        table_name_silver="s_access_logs",
        table_name_gold="g_access_logs",
        is_log=True,
        sql_gold=access_report_sql("silver.s_access_logs"),
        once_only=True,
    )
    run(spark, spec, until=4)
    frames = log_analysis(spark, spec)
    frames["kpis"].show(truncate=False)
    frames["top_ips"].show(truncate=False)
    frames["top_endpoints"].show(truncate=False)
    mon = monitoring_analysis(spark)
    mon["durations"].show()
    mon["status"].show()


if __name__ == "__main__":
    main()
