"""windrow: a PySpark batch engine for mobile-attribution event reports.

Reports are all-string CSV exports, one per window (app, attribution type, date
range).  The package validates each window on its own, types the rows strictly,
resolves duplicate events, and loads the result by replacing exactly the windows
a run owns, or by appending unseen events only.
"""

from windrow.spec import EVENTS, INSTALLS, ReportSpec, WINDOW_COLS

__all__ = ["EVENTS", "INSTALLS", "ReportSpec", "WINDOW_COLS"]
