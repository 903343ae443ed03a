"""pitpanel — versioned product panels on Spark.

Snapshots of a keyed catalog are kept as an append-only measure table
(prices) and a slowly-changing attribute log (metadata history).  The
package answers the questions such a panel exists for: latest snapshot,
time/key-bounded series, attributes as of a past moment, point-in-time
joins, change detection by content hash, group statistics and pipeline
health rollups.  Everything is lazy DataFrame code; nothing is collected
to the driver except bounded, explicitly sized values.
"""

from pitpanel.plans.loaders import (load_day_last_snapshot, load_metadata_at, load_metadata_current,
                                    load_panel, load_panel_historical, load_prices, load_prices_latest)
from pitpanel.session import build_session, checkpoint_dir, materialize
from pitpanel.sources.store import PanelStore

__all__ = [
    "PanelStore", "build_session", "checkpoint_dir", "materialize",
    "load_prices_latest", "load_prices", "load_day_last_snapshot", "load_metadata_current",
    "load_metadata_at", "load_panel", "load_panel_historical",
]
