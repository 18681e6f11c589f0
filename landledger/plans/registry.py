"""Named KPIs and their registration as SQL views.

``VIEWS`` maps the published view name to a builder over a warehouse and to the
published column names; SQL written against those views keeps working.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landledger.functions import scalars as s
from landledger.plans import finance as f
from landledger.plans import requests as r


class View(NamedTuple):
    build: Callable[..., DataFrame]
    columns: dict[str, str]


_SUMS = {"requests": "nombre_demandes", "share_pct": "pourcentage",
         "financing": "montant_total", "jobs": "emplois_total"}
_DURATIONS = {"avg_days": "delai_moyen_jours", "median_days": "delai_median_jours",
              "min_days": "delai_min_jours", "max_days": "delai_max_jours",
              "up_to_7_days": "demandes_sous_7j", "from_8_to_15_days": "demandes_8_15j",
              "over_15_days": "demandes_plus_15j",
              "finalised_requests": "total_demandes_finalisees"}

# Published view and column names.
VIEWS: dict[str, View] = {
    "v_kpi_demandes_par_statut": View(
        lambda w: r.kpi_by_status(w.fact_requests), {"status": "statut", **_SUMS}),
    "v_kpi_demandes_par_type": View(
        lambda w: r.kpi_by_zone_type(w.fact_requests),
        {"zone_type": "type_zone", **_SUMS, "avg_days": "delai_moyen_jours"}),
    "v_kpi_demandes_par_entite": View(
        lambda w: r.kpi_by_entity(w.fact_requests, w.dim_zone, w.dim_plot, w.dim_company),
        {"zone_name": "zone_industrielle", "plot_number": "lot", "company_name": "entreprise",
         "requests": "nombre_demandes", "financing": "montant_total_finance", "jobs": "emplois_crees",
         "avg_days": "delai_moyen_jours", "accepted": "demandes_validees",
         "rejected": "demandes_rejetees", "pending": "demandes_en_cours"}),
    "v_kpi_demandes_prioritaires": View(
        lambda w: r.kpi_priority_split(w.fact_requests),
        {"priority_level": "niveau_priorite", **_SUMS, "avg_days": "delai_moyen_jours",
         "accepted": "demandes_validees"}),
    "v_kpi_delai_traitement": View(
        lambda w: r.kpi_delay_stats(w.fact_requests), _DURATIONS),
    "v_kpi_delai_traitement_finalisees": View(
        lambda w: r.kpi_delay_finalised(w.fact_requests), _DURATIONS),
    "v_kpi_taux_acceptation": View(
        lambda w: r.kpi_acceptance(w.fact_requests),
        {"acceptance_pct": "taux_acceptation_pourcentage", "accepted": "demandes_validees",
         "rejected": "demandes_rejetees", "pending": "demandes_en_cours",
         "finalised": "demandes_finalisees", "requests": "total_demandes",
         "rejection_pct": "taux_rejet_pourcentage"}),
    "v_kpi_taux_acceptation_finalisees": View(
        lambda w: r.kpi_acceptance_finalised(w.fact_requests),
        {"acceptance_pct": "valeur_pourcentage", "accepted": "demandes_acceptees",
         "finalised": "demandes_finalisees", "requests": "total_demandes"}),
    "v_kpi_evolution_prioritaires": View(
        lambda w: r.kpi_priority_trend(w.fact_requests, w.dim_date),
        {"year": "annee", "month": "mois", "month_name_fr": "mois_nom_fr", "quarter": "trimestre",
         "requests": "total_demandes", "priority_requests": "demandes_prioritaires",
         "normal_requests": "demandes_normales", "priority_pct": "pourcentage_prioritaires",
         "financing": "montant_total_periode", "jobs": "emplois_total_periode",
         "avg_days": "delai_moyen_periode"}),
    "v_kpi_volume_demandes": View(
        lambda w: r.kpi_volume(w.fact_requests),
        {"requests": "total_demandes", "pending": "demandes_en_cours", "accepted": "demandes_acceptees",
         "rejected": "demandes_rejetees", "finalised": "demandes_finalisees",
         "priority_requests": "demandes_prioritaires", "in_zone": "demandes_zone_industrielle",
         "out_of_zone": "demandes_hors_zone", "priority_pct": "pourcentage_prioritaires",
         "in_zone_pct": "pourcentage_zone_industrielle"}),
    "v_kpi_performance_financiere": View(
        lambda w: r.kpi_financial_performance(w.fact_requests),
        {"requests": "nombre_demandes", "financing": "montant_total_finance",
         "avg_financing": "montant_moyen_finance", "jobs": "emplois_total_crees",
         "avg_jobs": "emplois_moyen_par_demande", "cost_per_job": "cout_par_emploi",
         "requests_with_financing": "demandes_avec_financement",
         "requests_with_jobs": "demandes_avec_emplois",
         "with_financing_pct": "pourcentage_avec_financement"}),
    "v_kpi_analyse_temporelle": View(
        lambda w: r.kpi_monthly(w.fact_requests),
        {"period": "periode_mois", "year": "annee", "month": "mois", "requests": "demandes_creees",
         "accepted": "demandes_acceptees", "rejected": "demandes_rejetees",
         "priority_requests": "demandes_prioritaires", "avg_days": "delai_moyen_jours",
         "financing": "montant_finance", "jobs": "emplois_crees",
         "acceptance_pct": "taux_acceptation_mensuel",
         "priority_pct": "pourcentage_prioritaires_mensuel"}),
    "v_kpi_repartition_geographique": View(
        lambda w: r.kpi_by_zone(w.fact_requests, w.dim_zone),
        {"zone_name": "zone_industrielle", "zone_code": "code_zone", "region": "region",
         "requests": "total_demandes", "accepted": "demandes_acceptees",
         "pending": "demandes_en_cours", "priority_requests": "demandes_prioritaires",
         "avg_days": "delai_moyen_jours", "financing": "montant_total_finance",
         "jobs": "emplois_total_crees", "acceptance_pct": "taux_acceptation_zone",
         "share_pct": "pourcentage_demandes_totales"}),
    "v_kpi_tableau_bord_executif": View(
        lambda w: r.kpi_executive(w.fact_requests),
        {"requests": "total_demandes", "pending": "demandes_en_cours",
         "finalised": "demandes_finalisees", "acceptance_pct": "taux_acceptation_pct",
         "avg_days": "delai_moyen_jours", "priority_requests": "demandes_prioritaires",
         "priority_pct": "pourcentage_prioritaires", "financing": "montant_total_finance",
         "avg_financing": "montant_moyen_finance", "jobs": "emplois_total_crees",
         "in_zone": "demandes_zone_industrielle", "out_of_zone": "demandes_hors_zone",
         "alert_status": "statut_alerte"}),
    "mv_kpi_collectes_summary": View(
        lambda w: f.kpi_receivables_summary(
            w.fact_receivables, w.dim_date, w.dim_agent, w.dim_receivable_type,
            w.dim_receivable_status, w.as_of),
        {"date": "date_collecte", "agent_name": "agent_collecteur", "category": "categorie_collecte",
         "status_label": "statut", "receivables": "nombre_collectes", "amount_due": "montant_total_du",
         "amount_collected": "montant_total_collecte", "amount_remaining": "montant_restant_du",
         "avg_recovery_rate": "taux_recouvrement_moyen", "avg_recovery_days": "delai_moyen_jours",
         "late": "nombre_en_retard", "closed": "nombre_terminees"}),
    "v_kpi_montant_total_paiements": View(
        lambda w: f.fin_total_payments(w.fact_payments),
        {"amount": "valeur", "payments": "nombre_transactions"}),
    "v_kpi_revenus_paiements_reussis": View(
        lambda w: f.fin_net_revenue(w.fact_payments),
        {"net_amount": "valeur", "payments": "nombre_paiements_reussis", "avg_net_amount": "montant_moyen"}),
    "v_dashboard_financier_complet": View(
        lambda w: f.fin_dashboard(w.fact_payments),
        {"position": "ordre", "kpi": "kpi", "value_text": "valeur", "detail": "detail"}),
    "vw_kpi_collectes_periode": View(
        lambda w: f.fin_collections_monthly(w.fact_payments),
        {"period": "periode", "payments": "nombre_collectes", "amount": "montant_total",
         "avg_amount": "montant_moyen"}),
    "vw_kpi_agents_performance": View(
        lambda w: f.fin_agent_performance(w.fact_payments),
        {"agent_id": "agent_id", "payments": "nombre_operations", "amount": "montant_collecte",
         "complete": "paiements_complets", "success_pct": "taux_reussite_pct"}),
    "vw_kpi_recouvrement_zone": View(
        lambda w: f.fin_recovery_by_zone(w.fact_payments),
        {"zone_key": "zone_key", "payments": "nombre_recouvrements", "amount": "montant_recouvre",
         "late": "retards", "late_pct": "taux_retard_pct"}),
    "vw_kpi_evolution_mensuelle": View(
        lambda w: f.fin_monthly_by_type(w.fact_payments),
        {"period": "mois", "transaction_type": "type_transaction", "payments": "nombre_operations",
         "amount": "montant_total"}),
    "vw_kpi_methodes_paiement": View(
        lambda w: f.fin_by_method(w.fact_payments),
        {"payment_method": "methode_paiement_key", "payments": "nombre_transactions",
         "amount": "montant_total", "avg_amount": "montant_moyen"}),
    "vw_kpi_dashboard_global": View(
        lambda w: f.fin_global_dashboard(w.fact_payments),
        {"payments": "total_transactions", "amount": "montant_global", "collections": "collectes",
         "recoveries": "recouvrements", "complete": "paiements_complets", "late": "paiements_retard",
         "success_pct": "taux_reussite_global"}),
}

# The KPIs a health check counts: the request views.
REQUEST_KPIS: dict[str, Callable[..., DataFrame]] = {
    "kpi_by_status": lambda w: r.kpi_by_status(w.fact_requests),
    "kpi_by_zone_type": lambda w: r.kpi_by_zone_type(w.fact_requests),
    "kpi_by_entity": lambda w: r.entity_rollup(w.fact_requests, w.dim_zone, w.dim_plot, w.dim_company),
    "kpi_priority_split": lambda w: r.kpi_priority_split(w.fact_requests),
    "kpi_delay_stats": lambda w: r.kpi_delay_stats(w.fact_requests),
    "kpi_acceptance": lambda w: r.kpi_acceptance(w.fact_requests),
    "kpi_priority_trend": lambda w: r.kpi_priority_trend(w.fact_requests, w.dim_date),
    "kpi_acceptance_finalised": lambda w: r.kpi_acceptance_finalised(w.fact_requests),
    "kpi_delay_finalised": lambda w: r.kpi_delay_finalised(w.fact_requests),
    "kpi_volume": lambda w: r.kpi_volume(w.fact_requests),
    "kpi_financial_performance": lambda w: r.kpi_financial_performance(w.fact_requests),
    "kpi_monthly": lambda w: r.kpi_monthly(w.fact_requests),
    "kpi_by_zone": lambda w: r.kpi_by_zone(w.fact_requests, w.dim_zone),
    "kpi_executive": lambda w: r.kpi_executive(w.fact_requests),
}


def published(name: str, warehouse) -> DataFrame:
    """A view under its published column names, with its calculation date."""
    view = VIEWS[name]
    df = view.build(warehouse).select(*[F.col(c).alias(p) for c, p in view.columns.items()])
    as_of = getattr(warehouse, "as_of", None)
    return df if as_of is None else df.withColumn("date_calcul", s.as_date(as_of))


def register_views(warehouse) -> list[str]:
    """Create or replace every published view in the session."""
    for name in VIEWS:
        published(name, warehouse).createOrReplaceTempView(name)
    return list(VIEWS)
