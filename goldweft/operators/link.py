"""Record linkage: personal and bank data by passport, then full name, then address."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldweft.functions.text import build_fullname, filled, normalize_key
from goldweft.operators.latest import by_address, by_fullname, by_passport

#: Name and last name both filled; only these records become golden.
COMPLETE_IDENTITY = f"({filled('personal.name')} AND {filled('personal.last_name')})"

FULLNAME_KEY = normalize_key(build_fullname("personal.name", "personal.last_name"))


def link_names(people: DataFrame, names: DataFrame) -> DataFrame:
    """Left link by normalised full name; namesakes all get the same row.

    ``names`` holds one row per full name, so a hot name is a skewed left side, which
    adaptive execution may split.  ``names`` comes from an aggregation over another
    key, so both join inputs are plain exchanges, as that needs.  A blank full name
    never matches: those rows get the passport as join key, so they spread over all
    partitions, and the flag keeps them from matching.
    """
    people = people.selectExpr("*", f"{FULLNAME_KEY} AS fullname_key").selectExpr(
        "*",
        "fullname_key <> '' AS has_name",
        "CASE WHEN fullname_key <> '' THEN fullname_key ELSE key END AS join_name",
    )
    names = names.withColumnRenamed("key", "name_key")
    return people.join(names, F.expr("join_name = name_key AND has_name"), "left").drop(
        "name_key", "join_name", "has_name"
    )


def link_addresses(people: DataFrame, addresses: DataFrame) -> DataFrame:
    """Left link of network data by the normalised address of the linked location.

    Without a location nothing may match; such rows are spread by passport like blank
    names above.
    """
    people = people.selectExpr(
        "*",
        "location IS NOT NULL AS located",
        f"CASE WHEN location IS NOT NULL THEN {normalize_key('location.address')} ELSE key END"
        " AS address_key",
    )
    addresses = addresses.withColumnRenamed("key", "network_key")
    return people.join(
        addresses, F.expr("address_key = network_key AND located"), "left"
    ).drop("network_key", "located")


def touched(linked: DataFrame, latest: DataFrame) -> DataFrame:
    """Linked rows whose passport, full name or address has a message in ``latest``.

    Each of the three is tested by a join that adds a flag; keys of ``latest`` are unique
    in their domain, so no row is repeated.  Rows without a name or an address are spread by
    passport, as in the links above, and match nothing.
    """
    keys = {
        "passport": (by_passport(latest), "key", "true"),
        "name": (by_fullname(latest), "fullname_key", "fullname_key <> ''"),
        "address": (by_address(latest), "address_key", "location IS NOT NULL"),
    }
    columns = linked.columns
    for name, (rows, own, has) in keys.items():
        found = rows.selectExpr(f"key AS {name}_found")
        linked = linked.selectExpr(
            "*", f"CASE WHEN {has} THEN {own} ELSE key END AS {name}_own", f"{has} AS {name}_has"
        ).join(found, F.expr(f"{name}_own = {name}_found AND {name}_has"), "left")
    hit = " OR ".join(f"{name}_found IS NOT NULL" for name in keys)
    return linked.filter(hit).select(*columns)
