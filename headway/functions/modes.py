"""Route type to transport mode."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from headway.constants import (
    HISTORY_MODE_DEFAULT,
    HISTORY_MODES,
    LIVE_MODE_DEFAULT,
    LIVE_MODES,
)


def _lookup(mapping: dict, key: Column, default: str) -> Column:
    literal = F.create_map(*[F.lit(part) for part in chain.from_iterable(mapping.items())])
    return F.coalesce(F.try_element_at(literal, key), F.lit(default))


def history_mode(route_type: Column) -> Column:
    """Mode in the historical tables; unmapped or missing types are unknown."""
    return _lookup(HISTORY_MODES, route_type, HISTORY_MODE_DEFAULT)


def live_mode(route_type: Column) -> Column:
    """Mode on the live board; unmapped or missing types are other."""
    return _lookup(LIVE_MODES, route_type.cast("string"), LIVE_MODE_DEFAULT)
