"""DuckDB oracle SQL helpers: the adapter view as CTEs shared by every oracle.

The oracle text is an independent, plain-SQL statement of each query; it is
run by the driver's DuckDB on the same Parquet tables.
"""

from __future__ import annotations

from pathlib import Path

_ADAPTER = (Path(__file__).with_name("adapter.sql")).read_text().strip()

LABELS = ("CASE WHEN booking_bool = 1 THEN 5 WHEN click_bool = 1 THEN 1 ELSE 0 END")
GAINS = ("CASE WHEN booking_bool = 1 THEN 31 WHEN click_bool = 1 THEN 1 ELSE 0 END")

BASE = (
    "search_log AS (SELECT a.*, a.srch_id * 16777216 + a.position AS row_id FROM (\n" + _ADAPTER + "\n) a),\n"
    f"labeled AS (SELECT *, {LABELS} AS relevance, {GAINS} AS dcg_gain FROM search_log),\n"
    "train AS (SELECT * FROM labeled WHERE srch_id % 5 <> 0),\n"
    "test AS (SELECT * EXCLUDE (position, gross_bookings_usd, click_bool, booking_bool, relevance, dcg_gain)"
    " FROM labeled WHERE srch_id % 5 = 0)"
)


def exact_rounding(sql: str, digits: int = 6) -> str:
    """``round(x, 6)`` by way of ten decimal digits, so that noise of a sum's order can't turn a tie."""
    out, end = "", f", {digits})"
    while (at := sql.find("round(")) >= 0:
        depth, z = 1, at + 6
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[z], 0)
            z += 1
        inner = sql[at + 6:z]
        if inner.endswith(end):
            inner = f"CAST(round(CAST({exact_rounding(inner[:-len(end)], digits)} AS DECIMAL(38,10)){end} AS DOUBLE)"
        else:
            inner = "round(" + exact_rounding(inner, digits)
        out, sql = out + sql[:at] + inner, sql[z:]
    return out + sql


def with_base(*ctes: str, select: str) -> str:
    """``WITH <adapter>, <ctes...> <select>``."""
    parts = [BASE] + [c.strip().rstrip(",") for c in ctes if c.strip()]
    return "WITH " + ",\n".join(parts) + "\n" + select.strip()


def ndcg_ctes(src: str, score: str, prefix: str = "n", k: int = 5, rel: str = "relevance",
              group: str = "srch_id", desc: bool = True, tie: str = "row_id") -> list[str]:
    """CTEs ending in ``{prefix}_per(group, ndcg)`` for score ordering."""
    d = "DESC" if desc else "ASC"
    return [
        f"{prefix}_rk AS (SELECT {group}, {rel} AS rel, "
        f"row_number() OVER (PARTITION BY {group} ORDER BY {score} {d}, {tie}) AS rn, "
        f"row_number() OVER (PARTITION BY {group} ORDER BY {rel} DESC, {tie}) AS irn FROM {src})",
        f"{prefix}_per AS (SELECT {group}, "
        f"sum(CASE WHEN rn <= {k} THEN (pow(2, rel) - 1) / log2(rn + 1) ELSE 0 END) AS dcg, "
        f"sum(CASE WHEN irn <= {k} THEN (pow(2, rel) - 1) / log2(irn + 1) ELSE 0 END) AS idcg, "
        f"CASE WHEN sum(CASE WHEN irn <= {k} THEN (pow(2, rel) - 1) / log2(irn + 1) ELSE 0 END) > 0 "
        f"THEN sum(CASE WHEN rn <= {k} THEN (pow(2, rel) - 1) / log2(rn + 1) ELSE 0 END) / "
        f"sum(CASE WHEN irn <= {k} THEN (pow(2, rel) - 1) / log2(irn + 1) ELSE 0 END) ELSE 0 END AS ndcg "
        f"FROM {prefix}_rk GROUP BY {group})",
    ]
