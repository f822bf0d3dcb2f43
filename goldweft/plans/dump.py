"""Relational tables -> flat CSV data set."""

from __future__ import annotations

from pyspark.sql import DataFrame

from goldweft.operators.dump import flat_person_dataset
from goldweft.sources.relational import export_csv


def dump(tables: dict[str, DataFrame], path: str) -> None:
    export_csv(flat_person_dataset(tables), path)
