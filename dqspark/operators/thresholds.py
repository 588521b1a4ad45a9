"""Thresholds of a check: ``"> 0"``, ``"<= 5%"``, and several of them as a tuple."""

from __future__ import annotations

import operator
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, functions as F

_COMPARE = {
    ">=": operator.ge,
    "<=": operator.le,
    "!=": operator.ne,
    ">": operator.gt,
    "<": operator.lt,
    "=": operator.eq,
}
_FORM = re.compile(r"\s*(>=|<=|!=|>|<|=)\s*([-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?)\s*(%?)\s*")


@dataclass(frozen=True)
class Threshold:
    op: str
    value: float
    percent: bool = False

    @classmethod
    def of(cls, text: str) -> Threshold:
        found = _FORM.fullmatch(text)
        if not found:
            raise ValueError(f"not a threshold: {text!r}")
        return cls(found[1], float(found[2]), bool(found[3]))

    def holds(self, value: Column) -> Column:
        return _COMPARE[self.op](value, F.lit(self.value))


def thresholds(texts: str | tuple[str, ...] | None) -> tuple[Threshold, ...]:
    if texts is None:
        return ()
    return tuple(Threshold.of(t) for t in ((texts,) if isinstance(texts, str) else texts))


def any_holds(limits: tuple[Threshold, ...], value: Column) -> Column:
    """True if one of the thresholds holds; a NULL value reaches none."""
    return F.coalesce(reduce(operator.or_, [t.holds(value) for t in limits]), F.lit(False))


def all_hold(limits: tuple[Threshold, ...], value: Column) -> Column:
    """True if all thresholds hold; a NULL value fails them."""
    return F.coalesce(reduce(operator.and_, [t.holds(value) for t in limits]), F.lit(False))
