"""Sentences that go with the reason keys of failed checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PERIOD = {
    "together": "a period needs both its first and its last day",
    "too_early": "the period reaches back before 2018",
    "reversed": "the last day of the period lies before its first",
    "daily_future": "a daily period cannot go beyond today",
    "daily_span": "a daily period covers 60 days at the most",
    "daily_age": "a daily period cannot begin more than 60 days ago",
    "weekly_span": "a weekly period needs three weeks or more",
    "monthly_span": "a monthly period needs three months or more",
}

BATCH = {
    "no_phrases": "the batch has no phrase",
    "blank_region": "the region is blank",
    "blank_phrase": "one of the phrases is blank",
    "resume_needs_one": "only a batch of a single phrase can be resumed",
}

#: Follow the file's name.
EXPORT = {
    "undecodable": "is neither UTF-8 nor cp1251",
    "no_header": "has no header row",
    "empty_header": "has a blank header",
    "unparsed_delimiter": "has a delimiter left inside a header",
    "duplicate_header": "has the same header twice",
    "overflow": "has an integer that its column cannot hold",
    "too_large": "is too large to be read whole",
}

#: With the granularity, and the two dates that the check compared.
SERIES = {
    "empty": "the %s series has no rows, so it cannot be trusted",
    "bad_date": "the %s series has a date in another format",
    "gap": "the %s series breaks off between %s and %s",
    "before_window": "the %s series begins on %s, ahead of its window that begins on %s",
    "after_window": "the %s series ends on %s, past its window that ends on %s",
}


def sentence(reason: Column, texts: dict[str, str]) -> Column:
    """The text of a reason key; null for others."""
    expr = F.lit(None).cast("string")
    for key, text in texts.items():
        expr = F.when(reason == key, F.lit(text)).otherwise(expr)
    return expr


def sql_case(reason: str, texts: dict[str, str]) -> str:
    """The same choice as a SQL expression."""
    return f"CASE {reason} " + " ".join("WHEN '{}' THEN '{}'".format(k, v.replace("'", "''")) for k, v in texts.items()) + " END"
