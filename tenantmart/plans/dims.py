"""Dimension models and account charts (projections and left star joins).

Dimension sides are small tables; join strategy is left to the planner's
size-checked broadcast (``autoBroadcastJoinThreshold``, AQE at run time).
The one-to-many attachments here (account -> attachments, budget account ->
P&L links, plot -> operational groups) are bounded by the chart of accounts
and the plot register, so they stay plain left joins; the fact-scale
fan-outs use ``operators.skew.fanout_left_join``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import Params, Source

# Plot status labels of the plot dimension.
STATUS_IN_PROGRESS = "En cours"
STATUS_REMOVED = "Arrachée"

ANALYTIC_ACCOUNT_COLUMNS = (
    "id_code_analytique", "classe_", "rubrique_1", "rubrique_2", "rubrique_3", "rubrique_4",
    "rubrique_5", "id_referentiel", "table_nom", "ordre_", "type_charge", "code_analytique",
    "id_bdg_attachements_codes", "id_code_budgetaire")


def analytic_accounts(src: Source, params: Params) -> DataFrame:
    """Analytic accounts with their budget attachments (account x attachment);
    the join column appears once."""
    acc = src("bdg_codes_analytiques")
    att = src("bdg_attachements_codes")
    return acc.join(att, on="id_code_analytique", how="left").select(*ANALYTIC_ACCOUNT_COLUMNS)


def budget_accounts(src: Source, params: Params) -> DataFrame:
    """Budget accounts -> P&L link -> P&L account (``compte_pl`` NULL when
    either hop is missing)."""
    cb = src("bdg_codes_budgetaires")
    link = src("bdg_comptes_pl_details").select("id_code_budgetaire", "id_compte_pl")
    pl = src("bdg_comptes_pl").select(F.col("id_bdg_comptes_pl"))
    j = (cb.join(link, on="id_code_budgetaire", how="left")
         .join(pl, link["id_compte_pl"] == pl["id_bdg_comptes_pl"], how="left"))
    return j.select("id_code_budgetaire", "classe_", "rubrique_1", "rubrique_2", "rubrique_3",
                    "rubrique_4", "rubrique_5", "code_budgetaire", "unite", "cout_unitaire",
                    F.col("id_bdg_comptes_pl").alias("compte_pl"))


def pl_accounts(src: Source, params: Params) -> DataFrame:
    return src("bdg_comptes_pl").select(
        "id_bdg_comptes_pl", "code", "type", "ordre", "formule", "creation_par", "creation_date",
        "niveau", "id_compte_parent")


def budget_versions(src: Source, params: Params) -> DataFrame:
    v = src("bdg_versions")
    return v.where(F.col("etat") == 1).select(
        "reference", "id_bdg_versions",
        F.col("derniere_generation").cast("timestamp_ntz").alias("derniere_generation"),
        "hypothese", "status")


def dim_staff(src: Source, params: Params) -> DataFrame:
    pers = src("personnel")
    cat = src("categorie_personnel").select(F.col("id").alias("categorie"),
                                            F.col("categorie").alias("categorie_personnel"))
    return pers.join(cat, on="categorie", how="left").select(
        F.col("id").alias("id_personnel"), F.col("mat").alias("matricule_personnel"),
        F.col("nom").alias("nom_personnel"), F.col("prenom").alias("prenom_personnel"),
        "date_embauche", "salaire_base", "categorie_personnel")


def dim_operation(src: Source, params: Params) -> DataFrame:
    op = src("operation_ref")
    fam = src("famille_operation").select(F.col("id").alias("oper_famille"),
                                          F.col("famille").alias("famille_operation"))
    return op.join(fam, on="oper_famille", how="left").select(
        F.col("operef_id").alias("id_operation"),
        F.col("operef_intitule").alias("reference_operation"), "famille_operation")


def dim_plot(src: Source, params: Params) -> DataFrame:
    """Plot dimension; fans out to one row per (plot, operational group)."""
    pc = src("parcelleculturale")
    farms = src("fermes").select("idfermes", F.col("nom").alias("ferme"),
                                 F.col("ville").alias("zone"), "id_societe")
    company = src("societe").select(F.col("id").alias("id_societe"),
                                    F.col("rais_social").alias("societe"))
    variety = src("variete").select(F.col("id").alias("variete_id"),
                                    F.col("variete").alias("variete_nom"),
                                    F.col("culture").alias("culture_id"))
    crop = src("culture").select(F.col("id").alias("culture_id"), F.col("culture"))
    stock = src("porte_greffe").select("idporte_greffe", F.col("libile").alias("porte_greffe"))
    plot_group = src("parcellecultural_groupe_operationnel").select(
        F.col("parcellecultural").alias("id"), "groupecultural")
    group = src("groupecultural_operationnel").select(
        F.col("idgroupecultural_operationnel").alias("groupecultural"),
        F.col("intitule").alias("groupe_operationnel"))
    j = (pc.join(farms, on="idfermes", how="left")
         .join(company, on="id_societe", how="left")
         .join(variety, pc["variete"] == variety["variete_id"], how="left")
         .join(crop, on="culture_id", how="left")
         .join(stock, on="idporte_greffe", how="left")
         .join(plot_group, on="id", how="left")
         .join(group, on="groupecultural", how="left"))
    return j.select(
        F.col("id").alias("id_parcelle"), F.col("ref").alias("parcelleculturale"),
        F.col("reference").alias("reference_parcelle_2"),
        F.year("dat_plant").alias("annee_plantation"), F.col("dat_plant").alias("date_plantation"),
        F.when(F.col("statut_cycle") == 1, F.lit(STATUS_IN_PROGRESS))
        .otherwise(F.lit(STATUS_REMOVED)).alias("statut"),
        F.col("sup").alias("superficie_ha"), F.col("dat_arrach").alias("date_arrachage"),
        "societe", "ferme", "zone", F.col("variete_nom").alias("variete"), "culture",
        "porte_greffe", "groupe_operationnel", "tokenpolygone",
        F.col("latposition").cast("double").alias("latitude"),
        F.col("lngposition").cast("double").alias("longitude"))


def dim_season(src: Source, params: Params) -> DataFrame:
    """Seasons with the previous season of the same company (by start date,
    ties broken by id).  Seasons are a dimension: a handful per company and
    year, so each company's window partition stays small."""
    s = src("fermes_compagne")
    w = Window.partitionBy("idsociete").orderBy("date_debut", "id_compagne")
    return s.select(
        F.col("id_compagne").alias("id_campagne"), "date_debut", "date_fin",
        F.col("idsociete").alias("societe"), F.col("code_compagne").alias("reference_campagne"),
        F.lag("id_compagne").over(w).alias("id_campagne_n1"))


CENTRE_COLUMNS = (
    "idcentre_intermediaire", "titre", "description", "id_service", "type_centre",
    "code_campagne", "id_responsable", "date_debut", "date_fin", "uo", "cout_pre_etabli",
    "created", "updated", "updatedby", "section", "reference", "ref_titre", "idsociete",
    "is_source", "createdby")


def dim_cost_centre(src: Source, params: Params) -> DataFrame:
    return src("centre_intermediaire").select(*CENTRE_COLUMNS)
