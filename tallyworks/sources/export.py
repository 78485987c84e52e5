"""Small result tables as CSV and Markdown files."""

from __future__ import annotations

import csv
from datetime import date
from pathlib import Path

from pyspark.sql import DataFrame


def render(value) -> str:
    """Null empty, dates ISO, doubles with up to four digits, lists comma-joined."""
    if value is None:
        return ""
    if isinstance(value, date):  # timestamps too
        return value.isoformat()
    if isinstance(value, float):
        return f"{value:.4f}".rstrip("0").rstrip(".")
    return ", ".join(map(str, value)) if isinstance(value, list) else str(value)


def markdown(columns: list[str], rows: list[list[str]]) -> str:
    line = lambda cells: f"| {' | '.join(c.replace('|', '/') for c in cells)} |"
    return "\n".join([line(columns), f"|{'---|' * len(columns)}", *map(line, rows)])


def export(reports: dict[str, tuple[str, DataFrame]], out: str) -> None:
    """One CSV a report (title and frame by name) and results.md with all of them. Rows keep the frames' order."""
    to = Path(out)
    to.mkdir(parents=True, exist_ok=True)
    parts = ["# Results"]
    for name, (title, df) in reports.items():
        rows = [[render(v) for v in r] for r in df.toLocalIterator()]
        with (to / f"{name}.csv").open("w", newline="", encoding="utf-8") as f:
            csv.writer(f).writerows([df.columns, *rows])
        parts += [f"## {title}", markdown(df.columns, rows)]
    (to / "results.md").write_text("\n\n".join(parts) + "\n", encoding="utf-8")
