"""Text shown to readers of predictions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: display texts
CITY_LABELS = {"msc": "Москва", "spb": "Санкт-Петербург"}
CRASH_ONE, CRASH_FEW, CRASH_MANY = "авария", "аварии", "аварий"
DISPLAY_TIME = "dd.MM.yyyy HH:mm:ss"


def crash_word(count: Column, compat: bool = False) -> Column:
    """Noun form that goes with ``count``.

    The default follows Russian grammar. ``compat`` gives the wording readers of
    the earlier service saw: the last two digits decide "few", and 11 counts as one.
    """
    last, last_two = count % 10, count % 100
    if compat:
        few, one = last_two.between(2, 4), last == 1
    else:
        few = last.between(2, 4) & ~last_two.between(12, 14)
        one = (last == 1) & (last_two != 11)
    return F.when(few, CRASH_FEW).when(one, CRASH_ONE).otherwise(CRASH_MANY)


def label_of(code: Column, labels: Mapping[str, str]) -> Column:
    """Label of ``code``; a code without label stands for itself."""
    if not labels:
        return code
    table = F.create_map(*[F.lit(part) for pair in labels.items() for part in pair])
    return F.coalesce(F.try_element_at(table, code), code)
