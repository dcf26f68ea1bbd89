"""Folders of the given tables and the hand-made trips the star's tests use.

A module of its own: a folder below may have a ``conftest`` too."""

from __future__ import annotations

import datetime as dt

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


def T(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


# The six hand-made trips (columns in TRIPS_COORD order).
HAND_ROWS = [
    (T("2024-01-07 00:00:00"), T("2024-01-07 00:10:00"), 40.5, -74.0, 40.75, -73.5, 1, 2.0, 10.0, 2.0, 12.0, 1),
    (T("2024-01-07 00:00:00"), T("2024-01-07 00:10:00"), 40.5, -74.0, 40.75, -73.5, 1, 4.0, 20.0, 0.0, 20.0, 2),
    (T("2024-01-07 23:59:58.500"), T("2024-01-08 00:00:01"), 40.5, -74.0, 40.5, -74.0, 2, 0.5, 0.0, 0.0, 0.0, 3),
    (T("2024-01-08 12:00:00"), T("2024-01-08 12:30:00"), 40.25, -74.0, 40.5, -74.0, None, 1.0, 8.0, 1.0, 9.0, 1),
    (T("2024-02-29 06:00:00"), T("2024-02-29 06:15:00"), 40.25, -74.0, 40.75, -73.5, 2, 3.0, 16.0, 4.0, 20.0, 9),
    (T("2024-02-29 06:00:00"), T("2024-02-29 06:20:00"), 40.25, -74.0, 40.75, -73.5, 6, 1.5, 5.0, 0.0, 5.0, None),
]
