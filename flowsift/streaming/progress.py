"""G11/T6op for streams: engine counters from a query's progress reports.

packets_seen = input rows over all progress reports; flows_emitted = rows written by the
sink (None when the sink does not report it, as file sinks); active_flows = flows held in the flow tracker's state after the latest batch
(opened less closed over all reports; of a query resumed from its checkpoint, the earlier runs' reports belong to the list);
dropped_late = rows dropped by the watermark (the ``run_*_to_end`` functions raise on them).
"""

from __future__ import annotations

from pyspark.sql.streaming import StreamingQuery

#: The flow tracker's metric in the progress reports; other streams are counted by their state rows.
OBSERVED = "flow_tracker"


def counters(progress: list[dict]) -> dict:
    seen = sum(int(p.get("numInputRows", 0)) for p in progress)
    sink_rows = [int(p.get("sink", {}).get("numOutputRows", -1) or 0) for p in progress]
    emitted = None if any(r < 0 for r in sink_rows) else sum(sink_rows)  # file sinks report -1
    last = progress[-1] if progress else {}
    ops = last.get("stateOperators", []) or []
    opened = [m[OBSERVED]["opened"] for m in (p.get("observedMetrics") or {} for p in progress) if m.get(OBSERVED)]
    active = sum(opened) if opened else sum(int(o.get("numRowsTotal", 0)) for o in ops)
    dropped = sum(int(o.get("numRowsDroppedByWatermark", 0))
                  for p in progress for o in (p.get("stateOperators", []) or []))
    return {"packets_seen": seen, "flows_emitted": emitted, "active_flows": active, "dropped_late": dropped}


def query_counters(query: StreamingQuery) -> dict:
    return counters([dict(p) for p in query.recentProgress])
