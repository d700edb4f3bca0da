"""The golden mini-dataset and writers for its files."""

from __future__ import annotations

import contextlib
import csv
import datetime as dt
import io
import os

from pyspark.sql import functions as F

from reddwatch import schemas
from reddwatch.params import HOME_GROUP, SiteGroup, site_group_table

HEADER = list(schemas.REPORT_HEADERS.values())
AS_OF = dt.date(2025, 4, 18)

L = "LGRLDR - Lower Granite adult ladder"
Y = "YANKFK - Tributary release"
U = "XXUNK - Unlisted"
LOWER = "YFK - Lower array"
TRIB = "YANKFK - Trib"


def tag(number: int) -> str:
    return f"3DD.{number:010d}"


def _row(number, release, stage, released, site, time, length):
    return [tag(number), "W", release, stage, released, site, time, length]


# Columns as in HEADER.
ROWS = [
    _row(1, L, "Adult", "09/15/2024", LOWER, "04/10/2025 11:30:00 PM", "610"),
    _row(1, L, "Adult", "09/15/2024", LOWER, "04/12/2025 01:00:00 AM", "610"),
    _row(2, L, "Adult", "10/01/2024", TRIB, "03/08/2025 12:00:00 PM", "640"),
    _row(2, L, "Adult", "10/01/2024", LOWER, "03/09/2025 11:30:00 PM", "640"),
    _row(3, Y, "Juvenile", "05/01/2022", LOWER, "04/12/2025 08:00:00 AM", "150"),
    _row(4, Y, "Juvenile", "05/01/2022", LOWER, "04/13/2025 09:00:00 AM", "140"),
    _row(5, Y, "Juvenile", "05/02/2022", LOWER, "04/13/2025 10:00:00 AM", "145"),
    _row(6, Y, "Juvenile", "04/01/2025", LOWER, "04/16/2025 10:00:00 AM", "130"),
    _row(7, L, "Adult", "09/18/2024", "CEY - Side channel", "04/14/2025 07:15:00 AM", ""),
    _row(8, L, "Adult", "09/30/2023", LOWER, "05/01/2024 06:00:00 AM", "700"),
    _row(9, L, "Adult", "09/20/2024", LOWER, "10/05/2024 05:45:00 PM", "655"),
    _row(10, L, "Adult", "09/20/2024", LOWER, "", "630"),
    _row(11, L, "Adult", "", LOWER, "04/12/2025 02:00:00 PM", "612"),
    _row(12, U, "", "09/25/2024", TRIB, "04/15/2025 03:00:00 AM", "600"),
]
SITES = [
    ("LGRLDR", "Lower Granite", 46.66, -117.43),
    ("YANKFK", "Tributary", 44.27, -114.73),
]
READINGS = [
    ("G", dt.date(2024, 12, 31), "00060", 30.0),
    ("G", dt.date(2025, 1, 1), "00010", 1.5),
    ("G", dt.date(2025, 1, 1), "00060", 40.0),
    ("G", dt.date(2025, 1, 2), "00060", 41.0),
]
GROUP = SiteGroup(
    "G1", HOME_GROUP.members, HOME_GROUP.presence, HOME_GROUP.entry, HOME_GROUP.home_release
)


def write_report(path, rows=ROWS, header=HEADER, columns=None, mark=True, newline="\r\n"):
    """A UTF-16LE file; `columns` reorders, `mark` adds a byte-order mark."""
    order = columns or header
    text = io.StringIO()
    writer = csv.writer(text, lineterminator=newline)
    writer.writerow(order)
    for row in rows:
        named = dict(zip(header, row))
        writer.writerow([named.get(c, "x, y") for c in order])
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as file:
        file.write((b"\xff\xfe" if mark else b"") + text.getvalue().encode("utf-16-le"))


def report(spark, rows=ROWS):
    """Report rows as a DataFrame, empty text being missing as in the reader."""
    schema = ", ".join(f"`{h}` string" for h in HEADER)
    return spark.createDataFrame([[v or None for v in row] for row in rows], schema)


def downstream(spark, *numbers):
    return spark.createDataFrame([(tag(n),) for n in numbers or (3,)], "pit_id string")


def no_tags(spark):
    return spark.createDataFrame([], "pit_id string")


def sites(spark, rows=SITES):
    return spark.createDataFrame(rows, schemas.SITES)


def readings(spark, rows=READINGS):
    return spark.createDataFrame(rows, schemas.GAUGE_READINGS)


def site_groups(spark):
    return site_group_table(spark, [GROUP])


def rows_of(frame, *columns):
    """Rows as tuples in a stable order."""
    picked = frame.select(*columns) if columns else frame
    return sorted((tuple(r) for r in picked.collect()), key=str)


def missing_text():
    return F.lit(None).cast("string")


def plan_of(frame, run=False):
    """The formatted plan; after `run` it is the one adaptive execution ended with."""
    if run:
        frame.collect()
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        frame.explain("formatted")
    return text.getvalue()
