"""The validation report of a night as HTML: a row per design."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .tables import desired_first
from .text import escape

#: The columns that come first, in order.
ORDER = [
    "designId", "ppc_code", "inr1", "inr2", "el1", "el2", "unfib_bright", "ag1", "ag2", "ag3", "ag4", "ag5", "ag6", "ag_sum",
    "sky_mean", "sky_std", "sky_min", "sky_max", "sky_sum", "std_mean", "std_std", "std_min", "std_max", "std_sum",
]
STYLE = "background-color: #f4a6a6"


def report_html(flagged: DataFrame, title: str, order: list[str] = ORDER) -> str:
    """flagged: the report with its flag_<column> columns (design.report_flags);
    flagged cells are coloured by the style sheet, so that they can be found
    again (text.highlighted_cells). The report has one row per design of a
    night and is put together on the driver."""
    flagged = flagged.withColumnRenamed("design_id", "designId")
    columns = desired_first([c for c in flagged.columns if not c.startswith("flag_")], order)
    marks, lines = [], []
    for i, r in enumerate(flagged.orderBy(columns[0]).toLocalIterator()):
        cells = []
        for j, c in enumerate(columns):
            if f"flag_{c}" in flagged.columns and r[f"flag_{c}"]:
                marks.append(f"#T_row{i}_col{j}")
            value = "" if r[c] is None else f"{r[c]:.2f}" if isinstance(r[c], float) else str(r[c])
            cells.append(f'<td id="T_row{i}_col{j}">{escape(value)}</td>')
        lines.append(f"<tr>{''.join(cells)}</tr>")
    style = f"<style>{', '.join(marks)} {{ {STYLE} }}</style>" if marks else ""
    head = "".join(f"<th>{escape(c)}</th>" for c in columns)
    return f"<!DOCTYPE html><html><head><title>{escape(title)}</title>{style}</head><body><table><tr>{head}</tr>{''.join(lines)}</table></body></html>"
