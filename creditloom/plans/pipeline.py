"""All six table plans, the star join and the final sets."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from creditloom.plans import application, bureau, card, instalments, merge, pos, previous
from creditloom.sources.sinks import Paths, write_final, write_stage


TIE = "_tie"


def with_tie(rows: DataFrame) -> DataFrame:
    """A hash of the whole row: orders rows of the same month, and equal rows are interchangeable."""
    return rows.withColumn(TIE, F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]))


def feature_tables(tables: Mapping[str, DataFrame], compat: bool = False) -> dict[str, DataFrame]:
    """The five applicant-level tables; each is one job over its own input."""
    detail = {n: with_tie(tables[n]) for n in ("bureau_balance", "installments_payments", "POS_CASH_balance",
                                                "credit_card_balance")}
    balances = bureau.balance_features(detail["bureau_balance"], [TIE])
    return {
        "bureau": bureau.bureau_features(tables["bureau"], balances, compat),
        "previous": previous.previous_features(tables["previous_application"]),
        "instalments": instalments.instalment_features(detail["installments_payments"], [TIE],
                                                       "table" if compat else "loan"),
        "pos": pos.pos_features(detail["POS_CASH_balance"], [TIE]),
        "card": card.card_features(detail["credit_card_balance"], [TIE]),
    }


def run(tables: Mapping[str, DataFrame], paths: Paths, compat: bool = False, **options) -> tuple[DataFrame, DataFrame]:
    """Build every stage, write it, join, and write the final train and test sets."""
    parts = {n: write_stage(t, paths.stage(n)) for n, t in feature_tables(tables, compat).items()}
    train, test = application.application_features(tables["application_train"], tables["application_test"],
                                                   tables["previous_application"], compat, **options)
    train = write_stage(train, paths.stage("application_train"))
    test = write_stage(test, paths.stage("application_test"))
    return write_final(*merge.merged_sets(train, test, parts), paths)
