"""Small helpers of the tests, in a module of their own so that no conftest hides them."""

import datetime


def day(text):
    return datetime.date.fromisoformat(text)


def rows(frame, *order):
    """Rows as tuples, ordered if asked for."""
    return [tuple(row) for row in (frame.orderBy(*order) if order else frame).collect()]
