"""Read SQL metrics from an executed plan (tests only)."""
from __future__ import annotations


def shuffle_records(plan) -> list[int]:
    """``shuffleRecordsWritten`` of every shuffle exchange in an executed plan
    (run with AQE off so the executed plan is the one that ran)."""
    out = []
    if plan.nodeName().startswith("Exchange") and plan.metrics().contains("shuffleRecordsWritten"):
        out.append(int(plan.metrics().apply("shuffleRecordsWritten").value()))
    children = plan.children()
    for i in range(children.size()):
        out += shuffle_records(children.apply(i))
    return out
