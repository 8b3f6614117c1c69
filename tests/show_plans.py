"""Write PLANS.md: physical plans of representative queries (sf0.01, AQE off for readability).

Run: ``python tests/show_plans.py > PLANS.md``
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.01"
SHOW = [
    ("parse_events", "decode: one pipeline; the only exchange is the one that this query asks for, as the supplied table is one split"),
    ("deadletter", "routing: the filter reads the computed reason above the decode"),
    ("gold_dedup_agg", "gold, aggregate form: partial aggregate per map task, one exchange on event_id"),
    ("gold_dedup", "gold, window form: partial WindowGroupLimit, one exchange on event_id"),
    ("dq_unique", "unique test: partial count before the exchange"),
    ("batch_rotation", "column pruning: the scan reads two columns"),
]


def main():
    from eventlake.session import build_session
    import __spark_entry__ as E
    from eventlake.plans import medallion as PL
    from eventlake.plans.stored import _layout
    from eventlake.plans import corpus as CP
    from eventlake.sinks import tables as TB

    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    out = ["# Physical plans\n", "Generated by `tests/show_plans.py` at sf0.01 with AQE off, so the",
           "static plan is shown; at run time AQE coalesces and splits shuffle partitions.\n"]

    def block(title, note, df):
        spark.conf.set("spark.sql.adaptive.enabled", "false")  # query functions re-enable it
        plan = df._jdf.queryExecution().executedPlan().toString()
        out.extend([f"## {title}\n", note + "\n", "```", plan.rstrip(), "```\n"])

    for name, note in SHOW:
        block(name, note, E.queries()[name](spark, SF))

    layout = _layout(spark, "plans")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    PL.run(spark, CP.mixed(CP.events(spark, SF)), layout, raise_on_test_failure=False, expire_as_of=False)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    block("retention on the bronze table", "partition pruning on the derived day column",
          TB.unexpired(spark.table(layout.bronze), "2024-02-15", 30).groupBy("event_type").count())
    block("unique test on the gold table", "bucketed on event_id: no exchange",
          spark.table(layout.gold).groupBy("event_id").count().where("count > 1"))
    print("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
