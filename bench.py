"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is fully executed (``noop`` sink: every row is produced, none is
collected); the time per query is the median of $BENCH_REPS runs after one
warm-up of the flagship.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "topic_summary",            # flagship: route + group
    "parse_transactions",       # JSON documents → events
    "scan_transaction_trees",   # tree documents (exercised events)
    "encode_tx_envelope",       # group by transaction → envelope JSON
    "filter_and",               # filter algebra on the typed payload
    "filter_json_payload",      # filter algebra on JSON payload text
    "subscribe",                # party × template subscription
    "route_party_template",     # stakeholder explode + broadcast join
    "kafka_record_contract",    # sink records with headers
    "pack_requests",            # chunked per-stream numbering
    "partial_failures",
    "events_processed",
    "lag_histogram",
    "reconnects",               # transitions by chunk, edges stitched
    "reconcile_delivery",       # two counts in one aggregate
    "latest_feed",              # top-k
    "ordered_delivery",         # range layout and its check
    "dedupe_events",            # streaming: dropDuplicates, RocksDB state
    "fan_out",                  # streaming: two sinks
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from ledgerlane import plans
    if only == ["all"]:
        only = sorted(plans.QUERIES)
    from ledgerlane.session import local_session

    spark = local_session(cpus, app="ledgerlane-bench")
    spark.conf.set("spark.sql.shuffle.partitions", str(max(8, int(cpus) * 2)))

    def run(name: str) -> float:
        t = time.perf_counter()
        plans.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t

    run("topic_summary")  # warm-up: JIT, file listing caches
    out = {}
    for name in (only or HEADLINE):
        out[name] = round(statistics.median(run(name) for _ in range(reps)), 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(out.values()), 3), "unit": "sec",
                      "queries": out, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": int(cpus), "reps": reps}))


if __name__ == "__main__":
    main()
