"""Extracts: source tables (French source names) to staging contracts.

Each extract is one projection, so filters and column choices made later reach
the source scan.  Sorting on extract has no effect on the result and is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landledger import schemas
from landledger.functions import scalars as s

# Priority texts that make a request a priority.
PRIORITY_TEXTS = ("haute", "élevée", "prioritaire", "urgente")

# The status codes used by the staging tables, and the other
# spellings of the same status found in the sources and labels.
PENDING = "EN_COURS"
ACCEPTED = "ACCEPTEE"
REJECTED = "REJETEE"
DOCUMENTS_REJECTED = "DOCUMENTS_REJETES"
STATUS_SPELLINGS = {
    "VALIDE": ACCEPTED,
    "VALIDEE": ACCEPTED,
    "VALIDÉE": ACCEPTED,
    "ACCEPTÉE": ACCEPTED,
    "REJETE": REJECTED,
    "REJETÉE": REJECTED,
}


def canonical_status(status: Column) -> Column:
    pairs = [F.lit(x) for pair in STATUS_SPELLINGS.items() for x in pair]
    status = status.cast("string")
    return F.coalesce(F.try_element_at(F.create_map(*pairs), status), status)


def with_request_flags(requests: DataFrame, as_of) -> DataFrame:
    """Status code, priority and outcome flags and elapsed full days.

    A pending request ages until ``as_of``; other open states have no duration.
    """
    status = F.col("status")
    finalised = status.isin(ACCEPTED, REJECTED)
    return (
        requests
        .withColumn("status", canonical_status(status))
        .withColumn("is_priority", F.coalesce(F.lower("priority").isin(*PRIORITY_TEXTS), F.lit(False)))
        .withColumn("is_finalised", F.coalesce(finalised, F.lit(False)))
        .withColumn("is_accepted", F.coalesce(status == ACCEPTED, F.lit(False)))
        .withColumn(
            "processing_days",
            F.when(finalised, s.full_days(F.col("created_at"), F.col("modified_at")))
             .when(status == PENDING, s.full_days(F.col("created_at"), s.as_timestamp(as_of))))
    )


def extract_requests(source: DataFrame, as_of) -> DataFrame:
    """Requests with the amount and job count read out of their JSON columns."""
    staged = source.select(
        F.col("id").alias("request_id"),
        "reference",
        F.col("statut").cast("string").alias("status"),
        F.col("etape_courante").alias("current_step"),
        F.col("type_demande").cast("string").alias("request_type"),
        F.col("operateur_id").alias("operator_id"),
        F.col("entreprise_id").alias("company_id"),
        F.col("lot_id").alias("plot_id"),
        "zone_id",
        F.col("priorite").alias("priority"),
        s.json_amount(F.col("financement"), "montantTotal").alias("financing_amount"),
        s.json_count(F.col("emplois"), "total").alias("total_jobs"),
        F.col("created_at"),
        F.col("updated_at").alias("modified_at"),
    )
    return schemas.conform(with_request_flags(staged, as_of), schemas.REQUESTS)


def extract_companies(source: DataFrame) -> DataFrame:
    renamed = source.withColumnsRenamed({
        "id": "company_id", "raison_sociale": "company_name", "telephone": "phone",
        "registre_commerce": "trade_register", "compte_contribuable": "tax_account",
        "forme_juridique": "legal_form", "adresse": "address",
        "date_constitution": "founded_on", "domaine_activite_id": "activity_id",
        "date_creation": "created_at", "date_modification": "modified_at",
    })
    return schemas.conform(renamed, schemas.COMPANIES)


def extract_plots(source: DataFrame) -> DataFrame:
    renamed = source.withColumnsRenamed({
        "id": "plot_id", "numero": "plot_number", "ilot": "block", "superficie": "area",
        "unite_mesure": "area_unit", "statut": "status", "priorite": "priority",
        "viabilite": "is_serviced", "coordonnees": "coordinates",
        "zone_industrielle_id": "zone_id", "entreprise_id": "company_id",
        "operateur_id": "operator_id", "date_acquisition": "acquired_on",
        "date_reservation": "reserved_on", "delai_option": "option_days",
        "updated_at": "modified_at",
    })
    cleaned = (
        renamed
        .withColumn("price", s.price_amount(F.col("prix")))
        .withColumn("description", F.coalesce(F.col("description"), F.lit("")))
    )
    return schemas.conform(cleaned, schemas.PLOTS)


def extract_zones(source: DataFrame) -> DataFrame:
    """Zones; ``region`` is optional in the source."""
    if "region" not in source.columns:
        source = source.withColumn("region", F.lit(None).cast("string"))
    renamed = source.withColumnsRenamed({
        "id": "zone_id", "code": "zone_code", "libelle": "zone_name", "superficie": "area",
        "unite_mesure": "area_unit", "lots_disponibles": "plots_available",
        "adresse": "address", "statut": "status", "updated_at": "modified_at",
    })
    cleaned = (
        renamed
        .withColumn("description", F.coalesce(F.col("description"), F.lit("")))
        .withColumn("address", F.coalesce(F.col("address"), F.lit("")))
    )
    return schemas.conform(cleaned, schemas.ZONES)


def extract_receivables(source: DataFrame) -> DataFrame:
    """Receivables of the source system: one constant type, links unknown.

    Amounts and dates stay as delivered; ``clean_receivables`` types them.
    """
    unknown = F.lit(None)
    return source.select(
        F.col("id").alias("receivable_id"),
        "reference",
        F.lit("RECOUVREMENT").alias("receivable_type"),
        F.col("montant_a_recouvrer").alias("amount_due"),
        F.col("montant_recouvre").alias("amount_collected"),
        F.col("statut").cast("string").alias("status"),
        F.col("date_debut").alias("created_on"),
        F.col("date_fin_prevue").alias("due_on"),
        unknown.cast("date").alias("recovered_on"),
        F.col("cree_par").alias("agent_id"),
        unknown.cast("bigint").alias("company_id"),
        unknown.cast("bigint").alias("plot_id"),
        unknown.cast("bigint").alias("zone_id"),
        unknown.cast("bigint").alias("request_id"),
        F.col("commentaire").alias("notes"),
        F.col("updated_at").alias("modified_at"),
    )


def incremental_agents(source: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Agents that are active, or were modified in the last ``days`` days."""
    recent = F.col("date_modification") >= s.as_timestamp(as_of) - F.expr(f"INTERVAL {int(days)} DAYS")
    return source.filter((F.col("statut") == "ACTIF") | recent).select(
        "agent_id",
        s.concat_present(F.col("nom"), F.lit(" "), F.col("prenom")).alias("agent_name"),
        F.col("matricule").alias("badge_number"),
        F.lit("COLLECTEUR").alias("job_title"),
        F.col("zone_assignee_id").alias("zone_id"),
        F.col("telephone").alias("phone"),
        "email",
        F.col("statut").alias("status"),
        F.col("date_embauche").alias("hired_on"),
        F.col("date_creation").alias("created_on"),
        F.col("date_modification").alias("modified_at"),
    )


def incremental_recoveries(source: DataFrame, as_of, days: int = 1) -> DataFrame:
    """Recovery actions modified in the last ``days`` days.

    The bare comparison on the source column is pushed to the scan and prunes
    partitions where the table is laid out by modification date.
    """
    start = s.as_timestamp(as_of) - F.expr(f"INTERVAL {int(days)} DAYS")
    return all_recoveries(source.filter(F.col("date_modification") >= start))


def all_recoveries(source: DataFrame) -> DataFrame:
    return source.select(
        F.col("recouvrement_id").alias("recovery_id"),
        F.col("collecte_id").alias("receivable_id"),
        F.col("type_action").alias("action_type"),
        F.col("date_action").alias("action_on"),
        F.col("montant_paiement").alias("payment"),
        F.col("mode_paiement").alias("payment_mode"),
        F.col("agent_recouvrement_id").alias("agent_id"),
        F.col("statut_recouvrement").alias("status"),
        F.col("observations").alias("notes"),
        F.col("piece_justificative").alias("document"),
        F.col("date_creation").alias("created_on"),
        F.col("date_modification").alias("modified_at"),
    )
