"""Messages -> golden records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from goldweft.operators import classify as C
from goldweft.operators import golden as G
from goldweft.operators import latest as L
from goldweft.operators import link as K


def latest_of(
    messages: DataFrame, order: str = "ord", tasks: int | None = None
) -> DataFrame:
    return L.latest_by_key(C.classify(messages), order, tasks)


def link(latest: DataFrame, complete_only: bool = True) -> DataFrame:
    """Complete identities (or all passports) with everything linked to them."""
    people = L.by_passport(latest)
    if complete_only:
        people = people.filter(K.COMPLETE_IDENTITY)
    named = K.link_names(people, L.by_fullname(latest))
    return K.link_addresses(named, L.by_address(latest))


def golden_of(latest: DataFrame, consolidated_at: Column | None = None) -> DataFrame:
    return G.golden_projection(link(latest), consolidated_at)


def consolidate(
    messages: DataFrame,
    order: str = "ord",
    consolidated_at: Column | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """One golden record per passport with a complete identity.

    One scan and parse, one shuffle for the aggregation, then each input of the name
    and address joins is shuffled once.  ``tasks``: see :func:`L.latest_by_key`.
    """
    return golden_of(latest_of(messages, order, tasks), consolidated_at)


def unmatched(latest: DataFrame) -> DataFrame:
    """Passports without a complete identity, bank data without a person included."""
    return L.by_passport(latest).filter(f"NOT {K.COMPLETE_IDENTITY}")
