from __future__ import annotations

import os
import sys
import tempfile
from datetime import date

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from macropanel.model import PANEL_SCHEMA, SERIES_SCHEMA  # noqa: E402

HEADER = ("OUTPUT", "PRICES", "RATE n.a.")
CODES = {"OUTPUT": 5, "PRICES": 6, "RATE n.a.": 2}


def vintage_rows(months: int = 9) -> dict[str, list[float | None]]:
    """Own vintage: growth, prices and a rate, with a gap in each of the last two."""
    out = {
        "OUTPUT": [round(80 * 1.015**i, 3) for i in range(months)],
        "PRICES": [round(31 + 0.4 * i + 0.05 * i * i, 3) for i in range(months)],
        "RATE n.a.": [round(6.5 - 0.3 * i + (0.9 if i % 3 == 0 else 0.0), 3) for i in range(months)],
    }
    out["PRICES"][0] = None
    if months > 4:
        out["RATE n.a."][4] = None
    return out


def vintage_text(months: int = 9) -> str:
    """The same as a published file: CRLF, a labelled code line, two spellings of a missing value, a blank last line."""
    rows = vintage_rows(months)
    lines = ["sasdate," + ",".join(HEADER), "Transform:," + ",".join(f"{CODES[h]}.0" for h in HEADER)]
    for i, d in enumerate(month_dates(months, date(1985, 3, 1))):
        cells = ["." if h == "PRICES" and rows[h][i] is None else "" if rows[h][i] is None else str(rows[h][i]) for h in HEADER]
        lines.append(f"{d.month}/{d.day}/{d.year}," + ",".join(cells))
    return "\r\n".join(lines) + "\r\n"


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    s = (
        SparkSession.builder.master("local[4]")
        .appName("macropanel-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="macropanel-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir() -> str:
    return tempfile.mkdtemp(prefix="macropanel-test-")


def month_dates(n: int, start: date = date(1990, 1, 1)) -> list[date]:
    first = start.year * 12 + start.month - 1
    return [date(k // 12, k % 12 + 1, 1) for k in range(first, first + n)]


def long_panel(spark, columns: dict[str, list], dates: list[date], panel_id: str = "p", tcodes: dict[str, int] | None = None):
    """(panel, series) DataFrames from Python columns; None = missing."""
    rows = [(panel_id, sid, d, None if v is None else float(v)) for sid, values in columns.items() for d, v in zip(dates, values, strict=True)]
    dim = [(panel_id, sid, i, (tcodes or {}).get(sid)) for i, sid in enumerate(columns)]
    return spark.createDataFrame(rows, PANEL_SCHEMA), spark.createDataFrame(dim, SERIES_SCHEMA)


def wide(df, value: str = "value") -> dict[str, list]:
    """Long DF -> {series_id: [values by date]}."""
    out: dict[str, list] = {}
    for r in df.orderBy("series_id", "date").collect():
        out.setdefault(r["series_id"], []).append(r[value])
    return out
