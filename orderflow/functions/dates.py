"""Date text handling for the register.

The register holds dates as text in three layouts: dd.mm.yyyy, dd-mm-yyyy and
yyyy-mm-dd. ``iso_text`` only reorders characters by position (nothing is
parsed), so an impossible day such as 31-11-2024 survives to be caught by
``valid_date``. The length test is on the trimmed text, but the slicing is on
the cell as typed, so a padded cell does not come out as a date.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_SHAPE = r"^[0-9]{4}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])$"


def iso_text(cell: Column) -> Column:
    """The cell reordered into yyyy-mm-dd text, or NULL if it has no date shape."""
    dmy = F.concat(F.substring(cell, 7, 4), F.lit("-"), F.substring(cell, 4, 2), F.lit("-"),
                   F.substring(cell, 1, 2))
    return (F.when(cell.isNull() | (F.length(F.trim(cell)) != 10), F.lit(None).cast("string"))
            .when(F.substring(cell, 3, 1).isin(".", "-"), dmy)
            .when(F.substring(cell, 5, 1) == "-", cell))


def valid_date(iso: Column) -> Column:
    """R2: the ISO text as a DATE only if it is a real calendar date."""
    return F.try_to_date(iso, "yyyy-MM-dd")


def impossible(iso: Column) -> Column:
    """R3 (one column): TRUE when the text has a date's shape (month 01-12, day
    01-31) but no such day exists; FALSE when it is a real date or empty; NULL
    when it is not a date at all (month 13, day 32, letters)."""
    shaped = iso.rlike(ISO_SHAPE)
    return (F.when(iso.isNull(), F.lit(False))
            .when(shaped & valid_date(iso).isNull(), F.lit(True))
            .when(shaped, F.lit(False)))


def layout(cell: Column) -> Column:
    """Which of the three layouts a cell uses ('unrecognised' otherwise)."""
    return (F.when(cell.isNull(), F.lit(None).cast("string"))
            .when(F.substring(cell, 3, 1) == ".", "dd.mm.yyyy")
            .when(F.substring(cell, 3, 1) == "-", "dd-mm-yyyy")
            .when(F.substring(cell, 5, 1) == "-", "yyyy-mm-dd")
            .otherwise("unrecognised"))


def strict_parse(cell: Column) -> Column:
    """The whole trimmed text must match one layout exactly and be a real date."""
    t = F.trim(cell)
    return F.coalesce(
        F.when(t.rlike(r"^[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}$"), F.try_to_date(t, "d.M.yyyy")),
        F.when(t.rlike(r"^[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}$"), F.try_to_date(t, "d-M-yyyy")),
        F.when(t.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"), F.try_to_date(t, "yyyy-M-d")),
    )
