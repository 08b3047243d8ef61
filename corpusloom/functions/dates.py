"""Dates as pages write them, brought to YYYY-MM-DD by built-in functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Formats in the order in which they are tried; day before month where both would do.
PATTERNS = ("MMMM d, yyyy", "MMM d, yyyy", "d MMMM yyyy", "d MMM yyyy", "d/M/yyyy", "M/d/yyyy", "yyyy/M/d", "d-M-yyyy", "d. MMMM yyyy", "yyyy年M月d日")
#: Then, after the others: month first with dots, as a lenient parser reads it, and day first where that is no date.
DOTTED = ("M.d.yyyy", "d.M.yyyy")


def normalise_date(raw: Column) -> Column:
    """'' for empty; the first ten characters of ISO dates, unchecked; the date by the first format that fits; else the text
    without its label. Missing parts are never taken from today."""
    text = F.trim(F.coalesce(raw, F.lit("")))
    bare = F.trim(F.regexp_replace(text, r"(?i)(published|posted|updated|date)[:\s\-]+", ""))
    short = F.substring(bare, 1, 40)
    # A weekday and a time of day, as in feeds, say nothing about the date.
    day = F.regexp_replace(short, r"^[A-Za-z]{3},\s*", "")
    day = F.regexp_replace(day, r"^(\d{1,2} [A-Za-z]{3} \d{4}) \d{1,2}:\d{2}(:\d{2})?( .*)?$", "$1")
    iso = F.when(short.rlike(r"^\d{4}-\d{2}-\d{2}(T|\s|$)"), F.try_to_timestamp(F.substring(short, 1, 10), F.lit("yyyy-MM-dd")))
    tries = [F.try_to_timestamp(short, F.lit(p)) for p in PATTERNS] + [F.try_to_timestamp(day, F.lit("d MMM yyyy"))] + [F.try_to_timestamp(short, F.lit(p)) for p in DOTTED] + [iso]
    found = F.date_format(F.coalesce(*tries), "yyyy-MM-dd")
    return F.when(text == "", F.lit("")).when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), F.substring(text, 1, 10)).otherwise(F.coalesce(found, bare))
