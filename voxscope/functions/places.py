"""Ordered substring gazetteers: country, province, city."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fv

Rules = Sequence[tuple[str, Sequence[str]]]


def match_place(location: Column, rules: Rules, other: str) -> Column:
    """The place of the first rule with a keyword inside ``location``, without regard to case.

    Missing values and 未知 stay 未知; ``other`` is the answer when no rule matches.
    """
    lowered = F.lower(location)
    answer = F.lit(other)
    for place, keywords in reversed(rules):
        # One pattern per place keeps the generated code small.
        answer = F.when(lowered.rlike("|".join(re.escape(k.lower()) for k in keywords)), place).otherwise(answer)
    missing = location.isNull() | location.isin("nan", fv.UNKNOWN_PLACE)
    return F.when(missing, fv.UNKNOWN_PLACE).otherwise(answer)


def standardize_location(location: Column, rules: Rules = fv.COUNTRY_RULES) -> Column:
    return match_place(location, rules, fv.OTHER_REGION)


def extract_province(location: Column, rules: Rules = fv.PROVINCE_RULES) -> Column:
    return match_place(location, rules, fv.UNKNOWN_PLACE)


def extract_city(location: Column, rules: Rules = fv.CITY_RULES) -> Column:
    return match_place(location, rules, fv.UNKNOWN_PLACE)
