"""Numbers to named bands, and names to numbers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import config


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def below(value: Column | str, edges: Sequence, names: Sequence) -> Column:
    """The name of the first edge the value stays below; the last name otherwise."""
    value = _col(value)
    (first_edge, first_name), *rest = zip(edges, names)
    chain = F.when(value < first_edge, F.lit(first_name))
    chain = reduce(lambda done, step: done.when(value < step[0], F.lit(step[1])), rest, chain)
    return chain.otherwise(F.lit(names[-1]))


def above(value: Column | str, edges: Sequence, names: Sequence, inclusive: bool = False) -> Column:
    """The name of the first (highest) edge the value exceeds; the last name otherwise."""
    value = _col(value)

    def passes(edge) -> Column:
        return value >= edge if inclusive else value > edge

    (first_edge, first_name), *rest = zip(edges, names)
    chain = F.when(passes(first_edge), F.lit(first_name))
    chain = reduce(lambda done, step: done.when(passes(step[0]), F.lit(step[1])), rest, chain)
    return chain.otherwise(F.lit(names[-1]))


def lookup(key: Column | str, table: Mapping, default=None) -> Column:
    """A constant mapping as one literal map expression."""
    entries = [F.lit(part) for pair in table.items() for part in pair]
    found = F.try_element_at(F.create_map(*entries), _col(key))
    return found if default is None else F.coalesce(found, F.lit(default))


def congestion_level(index: Column | str) -> Column:
    """0 (free) to 3 (jammed) from a 0-100 congestion index."""
    return below(index, config.LEVEL_EDGES, range(4))


def level_label(level: Column | str) -> Column:
    return lookup(_col(level).cast("int"), dict(enumerate(config.LEVEL_LABELS)))


def price_category(price: Column | str) -> Column:
    return below(price, config.PRICE_EDGES, config.PRICE_LABELS)


def traffic_severity(index: Column | str) -> Column:
    return above(index, config.SEVERITY_EDGES, config.SEVERITY_LABELS)


def zone_band(delta: Column | str) -> Column:
    """Impact zone by fixed thresholds on the congestion change (points)."""
    delta = _col(delta)
    low, moderate, high = config.ZONE_LABELS
    return (
        F.when(delta > config.ZONE_BAND_HIGH, high)
        .when(delta >= config.ZONE_BAND_MODERATE, moderate)
        .otherwise(low)
    )


def impact_code(zone: Column | str, default: str = "moderate_impact") -> Column:
    return lookup(zone, dict(zip(config.ZONE_LABELS, config.IMPACT_CODES)), default)


def strength(r: Column | str) -> Column:
    return above(
        F.abs(_col(r)), config.STRENGTH_EDGES, config.STRENGTH_LABELS, inclusive=True
    )


def direction(r: Column | str) -> Column:
    return F.when(_col(r) < 0, "negative").otherwise("positive")
