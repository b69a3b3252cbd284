"""Sales, production profile, budget lines and direct costs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import concat_null_as_empty, typed_null, week_start_date
from ..operators.skew import fanout_left_join
from .base import Params, Source, date_window

# Account-chart labels the models select on or emit.
YIELD_TABLE = "produit_rendement"
MARKET_LOCAL = "Marché local"
MARKET_EXPORT = "Export"
EXCLUDED_SALE_TYPES = (4,)
LEVEL_OVERHEADS = "Frais généraux"
LEVEL_LABOUR = "Main d'oeuvre"
LEVEL_INPUTS = "Intrants"

def _yield_accounts(src: Source, market: str) -> DataFrame:
    """Analytic accounts of the yield products of one market (the ON-clause
    literals are applied to the right side before the left join)."""
    return (src("bdg_codes_analytiques")
            .where((F.col("table_nom") == YIELD_TABLE) & (F.col("rubrique_5") == market))
            .select(F.col("id_referentiel").alias("idproduit_rendement"), "code_analytique",
                    "id_code_analytique"))


def _sales_header(src: Source) -> DataFrame:
    return src("vente").select(
        "idvente", "idfermes", F.col("ref").alias("reference_vente"),
        F.col("date").cast("timestamp_ntz").alias("date_vente"), "total", "client",
        "description", "type")


def sales_production(src: Source, params: Params) -> DataFrame:
    """Local-market sales (crate receipts) UNION export sales (quality
    reports), de-duplicated as whole rows.  The sale's header columns come last,
    so that the lines are shuffled narrow for all other lookups."""
    plots = src("parcelleculturale").select(F.col("id").alias("idparcelle"), "variete",
                                            "idproduit_rendement")
    units = src("unite_operation").select("idunite_operation", "unite")

    # local market: crate receipt -> receipt x plot -> plot -> station receipt -> sale
    v = _sales_header(src).where(
        F.col("type").isNotNull() & ~F.col("type").isin(*EXCLUDED_SALE_TYPES))
    rc = src("exp_recp_caisse").where(date_window(F.col("date"), params.sales_since,
                                                  params.until)).select(
        F.col("id").alias("id_recp"), "idvente",
        F.col("date").cast("timestamp_ntz").alias("date_recolte"))
    rcp = src("exp_recp_caisse_parcelleculturale").select(
        F.col("exp_recp_caisse").alias("id_recp"), F.col("parcelleculturale").alias("idparcelle"),
        "kg_estime", "qte_caisse", "idunite_operation")
    station = src("bon_recp_station").select(F.col("exp_recp_caisse").alias("id_recp"),
                                             F.col("idvariete").alias("variete"), "pu")
    local = (fanout_left_join(rc, rcp, "id_recp")
             .join(plots, on="idparcelle", how="left")
             .join(station, on=["id_recp", "variete"], how="left")
             .join(v, on="idvente", how="inner")
             .join(units, on="idunite_operation", how="left")
             .join(_yield_accounts(src, MARKET_LOCAL), on="idproduit_rendement", how="left")
             .select("idfermes", "idvente", "reference_vente", "date_vente", "total", "client",
                     "description", "date_recolte", F.col("pu").alias("prix"),
                     typed_null("double").alias("pfq"), "idparcelle", "idproduit_rendement",
                     "code_analytique", "id_code_analytique",
                     F.col("kg_estime").alias("poids_moyen"), F.col("qte_caisse").alias("quantite"),
                     (F.col("kg_estime") * F.col("qte_caisse")).alias("poids_kg"), "unite",
                     (F.col("qte_caisse") * F.col("kg_estime") * F.col("pu"))
                     .alias("chiffre_affaire")))

    # export: quality report (driving table) -> report x plot -> plot, sale
    rq = src("rdt_rapport_qualite").where(
        date_window(F.col("date_rapport"), params.sales_since, params.until)).select(
        F.col("idrdt_rapport_qualite").alias("id_rq"), F.col("idvente").alias("rq_idvente"),
        F.col("date_rapport").cast("timestamp_ntz").alias("date_recolte"), "prix", "pfq")
    rqp = src("rdt_parcelle_rapport_qualite").select(
        F.col("idrdt_rapport_qualite").alias("id_rq"), "idparcelle", "pm", "qte_receptionne",
        "poid_recp", "idunite_operation")
    vh = _sales_header(src).drop("type")
    export = (fanout_left_join(rq, rqp, "id_rq")
              .join(plots.drop("variete"), on="idparcelle", how="left")
              .join(vh, F.col("rq_idvente") == F.col("idvente"), how="left")
              .join(units, on="idunite_operation", how="left")
              .join(_yield_accounts(src, MARKET_EXPORT), on="idproduit_rendement", how="left")
              .select("idfermes", "idvente", "reference_vente", "date_vente", "total", "client",
                      "description", "date_recolte", "prix", "pfq", "idparcelle",
                      "idproduit_rendement", "code_analytique", "id_code_analytique",
                      F.col("pm").alias("poids_moyen"), F.col("qte_receptionne").alias("quantite"),
                      F.col("poid_recp").alias("poids_kg"), "unite",
                      (F.col("prix") * F.col("poid_recp")).alias("chiffre_affaire")))
    return local.unionByName(export).distinct()


def production_profile(src: Source, params: Params) -> DataFrame:
    """Distinct profile x season x plot rows; rows without a known plot are
    dropped (the outer join to the plot becomes an inner one)."""
    ppc = src("bdg_parcelles_profils_campagnes")
    prof = src("bdg_profils_production").select(
        "id_bdg_profil_production", F.col("designation").alias("profil"), "descriptif")
    pc = src("parcelleculturale").select(
        F.col("id").alias("id_parcelleculturale"), F.col("ref").alias("parcelle"),
        F.col("sup").alias("superficie"), F.col("statut_cycle").alias("statut_arrachage"),
        F.col("variete").alias("variete_id"), "idfermes",
        F.col("date_previsionnelle").alias("date_debut_travaux"), "previsionnelle")
    var = src("variete").select(F.col("id").alias("variete_id"), "variete",
                                F.col("culture").alias("culture_id"))
    crop = src("culture").select(F.col("id").alias("culture_id"), "culture")
    farms = src("fermes").select("idfermes", F.col("nom").alias("ferme"))
    j = (ppc.join(pc, ppc["id_parcelle_culturale"] == pc["id_parcelleculturale"], "inner")
         .join(prof, on="id_bdg_profil_production", how="left")
         .join(var, on="variete_id", how="left")
         .join(crop, on="culture_id", how="left")
         .join(farms, on="idfermes", how="left"))
    return j.select("id_bdg_profil_production", "id_campagne", "profil", "descriptif", "filiere",
                    "id_parcelleculturale", "parcelle", "superficie", "statut_arrachage",
                    "variete", "culture", "ferme", "date_debut_travaux",
                    "previsionnelle").distinct()


def budget_weekly(src: Source, params: Params) -> DataFrame:
    d = src("bdg_versions_details")
    return d.select(
        "id_bdg_versions", F.col("id_parcelle").alias("idparcelle"),
        F.col("id_bdg_profil_production").alias("idprofil"),
        F.col("id_compte_budgetaire").alias("idcomptebudgetaire"),
        F.col("total").alias("montant_total"), F.col("montant_norme").alias("montant_ha"),
        week_start_date(F.col("annee"), F.col("semaine"), params.week_start).alias("dateweek"))


def _cost_overheads(src: Source, params: Params) -> DataFrame:
    """Expense lines spread on plots; de-duplicated as in the original.  The
    assignment table only filters (semi-join): its columns are never read and
    duplicates it could add are removed by the DISTINCT."""
    d = src("depence").where(date_window(F.col("date_depense"), params.expense_since,
                                         params.until))
    assigned = src("affectation").select("idaffectation")
    prod = src("produit").select(F.col("id").alias("id_produit"), "designation",
                                 "id_categorie_depense")
    cat = src("categorie_depence").select(F.col("id").alias("id_categorie_depense"),
                                          "categ_depense")
    spread = src("parcelleculturale_depence").select("id_depence", "id_parcelle", "cout")
    j = (d.join(assigned, on="idaffectation", how="left_semi")
         .join(prod, on="id_produit", how="left")
         .join(cat, on="id_categorie_depense", how="left"))
    j = fanout_left_join(j, spread, "id_depence", d)      # expense -> its plot spread lines
    return j.select(
        F.col("date_depense").cast("timestamp_ntz").alias("date"),
        F.lit(LEVEL_OVERHEADS).alias("charge_niv1"), F.col("categ_depense").alias("charge_niv2"),
        F.col("designation").alias("charge_niv3"), F.lit("").alias("charge_article"),
        F.col("id_parcelle").alias("idparcelleculturale"), "cout",
        F.lit(0.0).alias("quantite"), F.lit(0.0).alias("cout_unitaire")).distinct()


def _plots_planned(src: Source) -> DataFrame:
    return src("parcelleculturale").select(F.col("id").alias("_pc_id"),
                                           F.col("date_previsionnelle").alias("_pc_planned"))


def _cost_labour(src: Source, params: Params) -> DataFrame:
    """Timesheet x plot lines (one line with NULL plot when a timesheet has
    none).  Joins whose columns are unused are kept: they set the row
    multiplicity exactly as the original model does."""
    p = src("pointage").where(date_window(F.col("date"), params.labour_cost_since, params.until))
    p = p.select("idpointage", "date", "oper_liste", "idfermes")
    ops = src("operation_ref").select(F.col("operef_intitule").alias("oper_liste"),
                                      "oper_famille", "operef_gr")
    fam = src("famille_operation").select(F.col("id").alias("oper_famille"), "famille")
    grp = src("groupe_operation").select(F.col("id").alias("operef_gr"))
    farms = src("fermes").select("idfermes")
    links = src("pointage_parcelleculturale").select("idpointage", "parccul_id", "cout")
    pcs = _plots_planned(src)
    t = (p.join(ops, on="oper_liste", how="left")
         .join(fam, on="oper_famille", how="left")
         .join(grp, on="operef_gr", how="left")
         .join(farms, on="idfermes", how="left"))
    j = (fanout_left_join(t, links, "idpointage", p)
         .join(pcs, (F.col("parccul_id") == F.col("_pc_id"))
               & (F.col("date") >= F.col("_pc_planned")), how="left"))
    return j.select(
        F.col("date").cast("timestamp_ntz").alias("date"), F.lit(LEVEL_LABOUR).alias("charge_niv1"),
        F.col("famille").alias("charge_niv2"), F.col("famille").alias("charge_niv3"),
        F.col("oper_liste").alias("charge_article"),
        F.col("parccul_id").alias("idparcelleculturale"), "cout",
        F.lit(0.0).alias("quantite"), F.lit(0.0).alias("cout_unitaire"))


def _cost_inputs(src: Source, params: Params) -> DataFrame:
    """Stock issues to plots, summed per (date, product, movement, plot,
    product labels).  ``cout_unitaire`` is a sum, as in the original.  The rows
    are summed before they get the labels, so that no text is held in a task's
    memory; a product listed several times with the same labels counts as often."""
    ms = src("mouvement_stock").where(date_window(F.col("date"), params.stock_since, params.until))
    ms = ms.select(F.col("idmouvement_stock").alias("mouvement_stock"), "date", "cmup",
                   "iddepots", "produit")
    msp = src("mouvementstock_parcelleculturale").select("mouvement_stock", "parcelleculturale",
                                                         "qantite")
    depots = src("depots").select("iddepots")
    labels = ("categorie", "sous_categorie", "designation")
    prod = (src("produit").select(F.col("id").alias("produit"), *labels)
            .groupBy("produit", *labels).agg(F.count(F.lit(1)).alias("_times")))
    pcs = _plots_planned(src)
    j = (msp.join(ms, on="mouvement_stock", how="inner")
         .join(depots, on="iddepots", how="left")
         .join(pcs, (F.col("parcelleculturale") == F.col("_pc_id"))
               & (F.col("date") >= F.col("_pc_planned")), how="left"))
    sums = j.groupBy("date", "produit", "mouvement_stock", "parcelleculturale").agg(
        F.sum(F.col("qantite") * F.col("cmup")).alias("cout"),
        F.sum("qantite").alias("quantite"), F.sum("cmup").alias("cout_unitaire"))
    times = F.coalesce("_times", F.lit(1))
    g = sums.join(prod, on="produit", how="left").withColumns(
        {c: (F.col(c) * times).cast(sums.schema[c].dataType) for c in ("cout", "quantite", "cout_unitaire")})
    return g.select(
        F.col("date").cast("timestamp_ntz").alias("date"), F.lit(LEVEL_INPUTS).alias("charge_niv1"),
        F.col("categorie").alias("charge_niv2"), F.col("sous_categorie").alias("charge_niv3"),
        F.col("designation").alias("charge_article"),
        F.col("parcelleculturale").alias("idparcelleculturale"), "cout", "quantite",
        "cout_unitaire")


def direct_costs(src: Source, params: Params) -> DataFrame:
    """Overheads + labour + inputs (UNION ALL), then plot, farm, variety and
    crop labels; the analytic account is the NULL-as-empty concatenation of
    the three levels and the article."""
    t = (_cost_overheads(src, params)
         .unionByName(_cost_labour(src, params))
         .unionByName(_cost_inputs(src, params)))
    pc = src("parcelleculturale").select(F.col("id").alias("idparcelleculturale"),
                                         F.col("ref").alias("parcelle_culturale"), "idfermes",
                                         F.col("variete").alias("variete_id"))
    farms = src("fermes").select("idfermes", F.col("nom").alias("ferme"))
    var = src("variete").select(F.col("id").alias("variete_id"), "variete",
                                F.col("culture").alias("culture_id"))
    crop = src("culture").select(F.col("id").alias("culture_id"), "culture")
    j = (t.join(pc, on="idparcelleculturale", how="left")
         .join(farms, on="idfermes", how="left")
         .join(var, on="variete_id", how="left")
         .join(crop, on="culture_id", how="left"))
    return j.select(
        "date", "charge_niv1", "charge_niv2", "charge_niv3", "charge_article", "ferme", "culture",
        "variete", "idparcelleculturale", "parcelle_culturale", "cout", "quantite",
        "cout_unitaire",
        concat_null_as_empty("charge_niv1", "charge_niv2", "charge_niv3", "charge_article")
        .alias("compte_analytique"))
