"""CSV export of the panel's loaders, by kind (SNK4)."""

from __future__ import annotations

from pitpanel.plans import loaders
from pitpanel.sinks.writers import export_csv
from pitpanel.sources import runlogs
from pitpanel.sources.store import PanelStore

KINDS = ("prices", "metadata-current", "panel", "runs-summary")


def parse_keys(text: str | None) -> list[str] | None:
    """A comma-separated key list (``"1,2, 3"``) -> ``["1", "2", "3"]``."""
    if not text:
        return None
    return [k.strip() for k in text.split(",") if k.strip()]


def export(store: PanelStore, kind: str, output: str, start=None, end=None, skus=None) -> str:
    """Write one loader's result as CSV below ``output``; returns the folder.

    Folder names carry the kind and, for time-ranged kinds, the range
    (``prices_2026-04-21_to_all``).  Nested columns become JSON text.  The
    rows are written by the executors in parallel (one file per task).
    """
    if kind not in KINDS:
        raise ValueError(f"kind must be one of {KINDS}")
    rng = f"{start or 'all'}_to_{end or 'all'}"
    if kind == "prices":
        df, name = loaders.load_prices(store.prices(), start, end, skus), f"prices_{rng}"
    elif kind == "metadata-current":
        df, name = loaders.load_metadata_current(store.current(), skus), "metadata_current"
    elif kind == "panel":
        df, name = loaders.load_panel(store.prices(), store.current(), start, end, skus), f"panel_{rng}"
    else:
        df, name = runlogs.runs_summary(store.spark, store.path("logs/runs")), "runs_summary"
    target = f"{output.rstrip('/')}/{name}"
    export_csv(df, target)
    return target
