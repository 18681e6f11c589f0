"""Seeded reference dimensions.  The rows are fixed values."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# key, type, short label, long label, category, frequency, active
RECEIVABLE_TYPES = (
    ("TYP_RECOUVREMENT", "RECOUVREMENT", "Recouvrement", "Recouvrement de créances", "RECOUVREMENT", "PONCTUELLE", True),
    ("TYP_REDEVANCE", "REDEVANCE", "Redevance", "Redevance d'occupation", "REDEVANCE", "ANNUELLE", True),
    ("TYP_IMPOT", "IMPOT", "Impôt", "Impôt sur les bénéfices", "IMPOT", "ANNUELLE", True),
    ("TYP_TAXE", "TAXE", "Taxe", "Taxe professionnelle", "TAXE", "ANNUELLE", True),
    ("TYP_AMENDE", "AMENDE", "Amende", "Amende pour retard", "AMENDE", "PONCTUELLE", True),
)

# key, status, label, description, category, order, recoverable, closed, needs action, colour
RECEIVABLE_STATUSES = (
    ("STAT_EN_COURS", "EN_COURS", "En cours", "Collecte en cours de traitement", "ACTIVE", 1, True, False, True, "#FFA500"),
    ("STAT_RECOUVREE", "RECOUVREE", "Recouvrée", "Collecte entièrement recouvrée", "TERMINEE", 5, False, True, False, "#28A745"),
    ("STAT_PART_RECOUVREE", "PARTIELLEMENT_RECOUVREE", "Partiellement recouvrée", "Collecte partiellement recouvrée", "ACTIVE", 3, True, False, True, "#FFC107"),
    ("STAT_NON_RECOUVREE", "NON_RECOUVREE", "Non recouvrée", "Collecte non recouvrée", "ACTIVE", 2, True, False, True, "#DC3545"),
    ("STAT_ANNULEE", "ANNULEE", "Annulée", "Collecte annulée", "INACTIVE", 6, False, True, False, "#6C757D"),
    ("STAT_SUSPENDUE", "SUSPENDUE", "Suspendue", "Collecte temporairement suspendue", "INACTIVE", 4, False, False, True, "#17A2B8"),
)

# key, mode, label, description, kind, days to clear, fee rate, active
PAYMENT_MODES = (
    ("MODE_ESPECE", "ESPECE", "Espèces", "Paiement en espèces", "PHYSIQUE", 0, "0.0000", True),
    ("MODE_CHEQUE", "CHEQUE", "Chèque", "Paiement par chèque", "BANCAIRE", 3, "0.0000", True),
    ("MODE_VIREMENT", "VIREMENT", "Virement", "Virement bancaire", "ELECTRONIQUE", 1, "0.0050", True),
    ("MODE_CB", "CARTE_BANCAIRE", "Carte bancaire", "Paiement par carte bancaire", "ELECTRONIQUE", 1, "0.0250", True),
    ("MODE_MOBILE", "MOBILE_MONEY", "Mobile Money", "Paiement mobile", "ELECTRONIQUE", 0, "0.0150", True),
)


def small_frame(spark: SparkSession, rows: tuple[tuple, ...], ddl: str) -> DataFrame:
    """A fixed list of rows as a local relation.

    Going through Arrow keeps the rows inside the plan, so their size is known
    to the optimizer and no Python worker takes part in the query.
    """
    schema = T.StructType.fromDDL(ddl)
    arrow = to_arrow_schema(schema)
    records = [dict(zip(schema.names, row)) for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(records, schema=arrow), schema)


def receivable_types(spark: SparkSession) -> DataFrame:
    return small_frame(
        spark, RECEIVABLE_TYPES,
        "type_key string, receivable_type string, short_label string, long_label string, "
        "category string, frequency string, is_active boolean")


def receivable_statuses(spark: SparkSession) -> DataFrame:
    return small_frame(
        spark, RECEIVABLE_STATUSES,
        "status_key string, status string, status_label string, description string, "
        "status_category string, status_order int, is_recoverable boolean, "
        "is_closed boolean, needs_action boolean, display_colour string")


def payment_modes(spark: SparkSession) -> DataFrame:
    return small_frame(
        spark, PAYMENT_MODES,
        "mode_key string, payment_mode string, mode_label string, description string, "
        "mode_kind string, clearing_days int, fee_rate string, is_active boolean",
    ).withColumn("fee_rate", F.col("fee_rate").cast("decimal(5,4)"))
