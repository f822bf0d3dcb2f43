"""Golden records -> relational tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldweft import schemas as S
from goldweft.operators import golden as G
from goldweft.operators import keys as K
from goldweft.operators import rows as R
from goldweft.operators.surrogate import max_id, running_ids
from goldweft.sources.staging import materialize


@dataclass
class Load:
    """New rows per table, and what became of the records."""

    tables: dict[str, DataFrame]
    loaded: DataFrame  # _id of every loaded record
    outcomes: DataFrame  # outcome, records


def empty_tables(spark: SparkSession) -> dict[str, DataFrame]:
    return {name: spark.createDataFrame([], ddl) for name, ddl in S.TABLES.items()}


def _bases(existing: dict[str, DataFrame] | None) -> dict[str, Column | int]:
    names = ("person", "bank", "work", "address")
    if existing is None:
        return dict.fromkeys(names, 0)
    return {name: max_id(existing[name]) for name in names}


def build_tables(
    golden: DataFrame,
    existing: dict[str, DataFrame] | None = None,
    mode: str = "bulk",
    bases: dict[str, Column | int] | None = None,
    staging: str | None = None,
) -> dict[str, DataFrame]:
    """All five tables of the given records (unique ``_id``), ids after the existing ones.

    Ids are given in the plan, so dependents get their foreign keys without looking
    them up: a new person's id is above every older one with the same passport.
    """
    base = {
        k: F.lit(v) if isinstance(v, int) else v
        for k, v in (_bases(existing) if bases is None else bases).items()
    }
    home, work_address = R.has_home(mode), R.has_work_address(mode)
    bank, work = R.has_bank(), R.has_work(mode)

    def row(when: str, *columns: str) -> str:
        return f"CASE WHEN {when} THEN struct({', '.join(columns)}) END"

    numbered = running_ids(
        golden,
        "_id",
        {
            "person_no": "1",
            "bank_no": bank,
            "work_no": work,
            "address_no": f"CAST({home} AS int) + CAST({work_address} AS int)",
        },
    )
    # Home comes before work, so it has the smaller of two address ids.
    home_no = f"address_no - CAST({work_address} AS int)"
    shifted = numbered.select(
        "*", *[base[t].cast("bigint").alias(f"{t}_base") for t in base]
    )
    staged = materialize(
        shifted.selectExpr(
            "person_base + person_no AS person_id",
            f"struct({', '.join(R.aliased(R.person_columns(mode)))}) AS person",
            row(bank, "bank_base + bank_no AS id", *R.aliased(R.bank_columns())) + " AS bank",
            row(work, "work_base + work_no AS id", *R.aliased(R.work_columns())) + " AS work",
            row(
                home,
                f"address_base + {home_no} AS id",
                f"'{R.HOME}' AS type",
                *R.aliased(R.home_columns(mode)),
            )
            + " AS home",
            row(
                work_address,
                "address_base + address_no AS id",
                f"'{R.WORK}' AS type",
                *R.aliased(R.work_address_columns(mode)),
            )
            + " AS work_address",
        ),
        "numbered",
        staging,
    )
    addresses = staged.select(
        "person_id", F.inline(F.array_compact(F.array("home", "work_address")))
    )

    def dependent(name, *columns):
        return staged.filter(F.col(name).isNotNull()).select(
            f"{name}.id", "person_id", *[f"{name}.{c}" for c in columns]
        )

    return {
        "person": staged.select(F.col("person_id").alias("id"), "person.*"),
        "address": addresses.select("id", "street_name", "city", "ip_address"),
        "person_address": addresses.select(F.col("id").alias("address_id"), "person_id", "type"),
        "bank": dependent("bank", "iban", "salary"),
        "work": dependent("work", "company", "position", "phone", "email"),
    }


def _outcomes(judged: DataFrame) -> DataFrame:
    return judged.groupBy("outcome").agg(F.count("*").alias("records"))


def load_bulk(
    golden: DataFrame,
    existing: dict[str, DataFrame] | None = None,
    on_existing: str = "append",
    bases: dict[str, Column | int] | None = None,
    staging: str | None = None,
) -> Load:
    """Load complete records that are not uploaded yet.

    ``append`` adds a second person for a passport that is there already; ``skip``
    leaves such records out (they still count as uploaded).
    """
    if on_existing not in ("append", "skip"):
        raise ValueError(f"unknown on_existing {on_existing!r}")
    waiting = G.pending(golden)
    good = R.skip_missing_passport(waiting)
    if on_existing == "skip" and existing is not None:
        judged = _judge_existing(waiting, existing["person"], F.col("_id").isNull(), "skipped")
        # Written once: numbering reads its input for totals and for ranks.
        good = materialize(
            K.skip_existing_persons(good, existing["person"]), "accepted", staging
        )
    else:
        judged = waiting.select(
            F.when(F.col("_id").isNull(), "skipped").otherwise("processed").alias("outcome")
        )
    tables = build_tables(good, existing, "bulk", bases, staging)
    return Load(tables, good.select("_id"), _outcomes(judged))


def load_strict(
    golden: DataFrame,
    existing: dict[str, DataFrame] | None = None,
    bases: dict[str, Column | int] | None = None,
    staging: str | None = None,
) -> Load:
    """Load with validation: records of a known passport are skipped, incomplete ones
    are errors, one bad record never affects another.

    Where records have a column ``passport``, it stands in for a missing ``_id``; of records
    that share a passport then, one with an ``_id`` of its own is loaded, the others skipped.
    """
    waiting = G.pending(golden, exact_names=True)
    if "passport" in golden.columns:
        waiting = R.passport_fallback(waiting)
    else:
        waiting = R.strict_row_validation(waiting).withColumn("repeated", F.lit(False))
    good = waiting.filter(F.col("reject_reason").isNull() & ~F.col("repeated"))
    bad = F.col("reject_reason").isNotNull()
    if existing is not None:
        judged = _judge_existing(waiting, existing["person"], bad, "error")
        good = K.skip_existing_persons(good, existing["person"])
    else:
        judged = waiting.select(
            F.when(bad, "error")
            .when(F.col("repeated"), "skipped")
            .otherwise("processed")
            .alias("outcome")
        )
    good = materialize(good.select(*S.GOLDEN.fieldNames()), "accepted", staging)
    tables = build_tables(good, existing, "strict", bases, staging)
    return Load(tables, good.select("_id"), _outcomes(judged))


def _judge_existing(
    waiting: DataFrame, person: DataFrame, bad: Column, bad_outcome: str
) -> DataFrame:
    """An existing passport is ``skipped`` before any other test."""
    known = person.select(F.col("passport").alias("known_passport")).distinct()
    repeated = F.col("repeated") if "repeated" in waiting.columns else F.lit(False)
    return waiting.join(known, F.col("_id") == F.col("known_passport"), "left").select(
        F.when(F.col("known_passport").isNotNull() | repeated, "skipped")
        .when(bad, bad_outcome)
        .otherwise("processed")
        .alias("outcome")
    )


def load_json(
    golden_file: DataFrame,
    existing: dict[str, DataFrame] | None = None,
    bases: dict[str, Column | int] | None = None,
    staging: str | None = None,
) -> Load:
    """Load a golden JSON file: every record with an id that has no person yet, the
    first of repeated ids, full name from its parts, all dependents."""
    spark = golden_file.sparkSession
    # Parsed once: the loaded records and the total both come from this copy.
    golden_file = materialize(golden_file, "read", staging)
    persons = (existing or empty_tables(spark))["person"]
    good = K.skip_existing_persons(
        golden_file.filter(F.col("_id").isNotNull()), persons, position="position"
    )
    good = materialize(good, "accepted", staging)
    tables = build_tables(good, existing, "json", bases, staging)
    # Everything not processed is skipped: total minus processed.
    total = golden_file.groupBy().agg(F.count("*").alias("n"))
    done = good.groupBy().agg(F.count("*").alias("n"))
    parts = total.select(F.lit("skipped").alias("outcome"), "n").union(
        done.select(
            F.inline(
                F.array(
                    F.struct(F.lit("processed").alias("outcome"), F.col("n").alias("n")),
                    F.struct(F.lit("skipped").alias("outcome"), (-F.col("n")).alias("n")),
                )
            )
        )
    )
    outcomes = parts.groupBy("outcome").agg(F.sum("n").alias("records"))
    return Load(tables, good.select("_id"), outcomes)
