"""Micro-graphs with hand-computed answers (one week each, in one table)."""

A, B, C, H = 1, 2, 3, 0

GRAPHS = {
    "C3": [(A, B), (B, C), (C, A)],
    "STAR": [(H, A), (H, B), (H, C)],
    "PATH3": [(A, B), (B, C)],
    "LOOP": [(A, A), (A, B)],
    "MIX": [(A, B), (B, A), (B, C), (C, A)],
}
WEEK = {"C3": "20201", "STAR": "20202", "PATH3": "20203", "LOOP": "20204", "MIX": "202010"}


def tx_rows():
    rows = []
    for g, es in GRAPHS.items():
        rows += [(WEEK[g], s, d) for s, d in es]
    # DUP: a->b three times, null endpoints dropped
    rows += [("20205", A, B)] * 3 + [("20205", None, A), ("20205", A, None)]
    return rows


def tx(spark):
    return spark.createDataFrame(tx_rows(), "time_week string, src bigint, dst bigint")


def by_week(df, key="time_week"):
    out = {}
    for r in df.collect():
        out.setdefault(r[key], []).append(r.asDict())
    return out


def node_map(df, col):
    return {(r["time_week"], r["node"]): r[col] for r in df.collect()}
