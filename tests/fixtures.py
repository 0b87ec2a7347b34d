"""Hand-made raw CSV files (FIXTURES.md section 2)."""

from __future__ import annotations

import os

from probelens import config as C

HEADER = ",".join(f.name for f in C.RAW_SCHEMA.fields)


def row(ts, speed, op, cell, lon="-6.26", lat="53.35") -> str:
    vals = {f.name: "" for f in C.RAW_SCHEMA.fields}
    vals.update(
        {
            "Timestamp": ts,
            "Longitude": lon,
            "Latitude": lat,
            "Speed": speed,
            "Operatorname": op,
            "CellID": cell,
            "NetworkMode": "4G",
            "RSRP": "-90",
            "RSRQ": "-10",
            "SNR": "5.5",
            "CQI": "9",
        }
    )
    return ",".join(vals[f.name] for f in C.RAW_SCHEMA.fields)


CASES = [
    row("2017.11.30_16.48.26", "5", "A", "11"),
    row("2017.11.30_16.48.27", "6", "A", "-"),
    row("2017.11.30_17.48.27", "12.5", "A", "11"),
    row("bad-time", "40", "B", "12"),
    row("2017.12.03_23.59.59", "30", "B", "12"),
    row("2017.12.03_23.10.00", "10", "", "12"),
]


def write_csv(directory: str, name: str, lines: list[str], header: str | None = HEADER) -> str:
    os.makedirs(directory, exist_ok=True)
    path = os.path.join(directory, name)
    with open(path, "w", encoding="utf-8") as fh:
        if header is not None:
            fh.write(header + "\n")
        for line in lines:
            fh.write(line + "\n")
    return path


def plan_text(df, mode: str = "formatted") -> str:
    """The physical plan as ``df.explain(mode)`` prints it."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()
