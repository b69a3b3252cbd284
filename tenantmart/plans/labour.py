"""Labour models: the allocated labour-cost fact and the farm labour lines.

``fact_labour`` grain: timesheet x person x (plot or cost centre).  Every
timesheet-level attribute (farm name, operation id, season) is resolved once
on the timesheet table, before the person x plot / person x centre fan-out,
so the wide rows are never shuffled for a dimension lookup.  A timesheet
with both plots and centres counts its cost on both sides, as in the
original model.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import safe_ratio, typed_null
from ..operators.cleanse import shared_units
from ..operators.lookup import interval_lookup, unique_lookup
from ..operators.skew import fanout_left_join, hot_keys, lines_with_placeholders, own_exchange_join
from .base import Params, Source

# Overtime buckets: fact column <- person-timesheet column.
HOUR_BUCKETS = (("hj_direct", "hj"), ("hj_hs25", "hs_25"), ("hj_hs50", "hs_50"),
                ("hj_hs100", "hs_100"), ("hj_hsnm", "hs_nm"))

DEFAULT_HOURS_THRESHOLD = 8

#: Different dates of timesheets up to which their seasons are broadcast.
FEW_DATES = 20_000


def timesheets(src: Source) -> DataFrame:
    """Timesheet level: farm name, operation id (own id, else by label) and
    the season whose [start, end] holds the date (smallest id wins)."""
    p = src("pointage").select("idpointage", "date", "oper_liste", "idfermes", "operef_id",
                               "cout_totale")
    farms = src("fermes").select(F.col("idfermes"), F.col("nom").alias("ferme"))
    by_label = unique_lookup(src("operation_ref"), "operef_intitule", "operef_id",
                             "oper_liste", "_op_by_label")
    t = (p.join(farms, on="idfermes", how="left")
         .join(by_label, on="oper_liste", how="left")
         .withColumn("id_operation", F.coalesce("operef_id", "_op_by_label"))
         .drop("_op_by_label", "operef_id", "idfermes"))
    seasons = src("fermes_compagne").select("id", "date_debut", "date_fin")
    return interval_lookup(t, "date", seasons, "id", "date_debut", "date_fin", "campagne", times=p, few=FEW_DATES)


def _persons(src: Source) -> DataFrame:
    return src("personnel_pointage").select(
        "idpointage", F.col("pers_id").alias("id_personnel"), F.col("cout").alias("pers_cout"),
        "hj", "hs_25", "hs_50", "hs_100", "hs_nm", "cout_hscu", "hscu",
        F.coalesce(F.col("seuil_horaire"), F.lit(DEFAULT_HOURS_THRESHOLD)).alias("seuil"))


def _hours(link_cost: str, person_col: str):
    return safe_ratio(F.col(link_cost) * F.col(person_col), F.col("cout_totale"), F.col("seuil"))


def _links(src: Source) -> tuple[DataFrame, DataFrame]:
    """Plot links and cost-centre links.  The cost-centre dimension is joined for
    its row multiplicity only (no column is read), before any fan-out; of a
    link's copies one is ``counted``."""
    plots = src("parcelleculturale").select(F.col("id").alias("id_parcelle"), "sup")
    plot_links = (src("pointage_parcelleculturale")
                  .select("idpointage", F.col("parccul_id").alias("id_parcelle"),
                          F.col("cout").alias("link_cout"))
                  .join(plots, on="id_parcelle", how="left")
                  .select("idpointage", F.lit(True).alias("is_plot"), "id_parcelle",
                          typed_null("bigint").alias("id_centre_cout"), "link_cout", "sup", F.lit(True).alias("counted")))
    copies = Window.partitionBy("id_centre_cout").orderBy("id_centre_cout")
    centres = (src("centre_intermediaire").select(F.col("idcentre_intermediaire").alias("id_centre_cout"))
               .where("id_centre_cout IS NOT NULL").withColumn("_copy", F.row_number().over(copies)))
    centre_links = (src("cc_pointage").select(
        "idpointage", F.lit(False).alias("is_plot"), typed_null("bigint").alias("id_parcelle"),
        F.col("idcentre_intermediaire").alias("id_centre_cout"), F.col("cout").alias("link_cout"),
        typed_null("double").alias("sup"))
        .join(centres, on="id_centre_cout", how="left")
        .withColumn("counted", F.coalesce(F.col("_copy") == 1, F.lit(True))).drop("_copy"))
    return plot_links, centre_links


def _statistics(counted) -> list:
    """Planted area of a timesheet's linked plots, and number of its linked centres."""
    return [F.sum("sup"), F.count_if(~F.col("is_plot") & counted)]


def _is_hot(src: Source) -> bool:
    return bool(hot_keys([src(t) for t in ("personnel_pointage", "pointage_parcelleculturale", "cc_pointage")], "idpointage"))


def _hot_rows(src: Source) -> DataFrame:
    """Timesheet x person x link, each fan-out with exchanges of its own.  The
    statistics are one partial aggregation, attached to the timesheets, where both
    sides have one row per key."""
    links = reduce(DataFrame.unionByName, _links(src))
    area, n_centres = _statistics(F.col("counted"))
    stats = links.groupBy("idpointage").agg(area.alias("area"), n_centres.alias("n_centres"))
    # a timesheet without links gives no row, so statistics may join inner
    sheets = timesheets(src).join(stats, on="idpointage", how="inner")
    lines = lines_with_placeholders(src("pointage"), _persons(src), "idpointage")
    return own_exchange_join(own_exchange_join(sheets, lines, "idpointage", 1), links, "idpointage", 2)


def _plain_rows(src: Source, sheets: DataFrame) -> DataFrame:
    """Timesheet x person x link on one partitioning by timesheet, which the links'
    statistics use as well.  NULL timesheet keys never meet a link; a timesheet
    without persons keeps one NULL person."""
    keyed = F.col("idpointage").isNotNull()
    links = reduce(DataFrame.unionByName, [df.where(keyed) for df in _links(src)])
    sheet = Window.partitionBy("idpointage")
    area, n_centres = (c.over(sheet) for c in _statistics(F.col("counted")))
    links = links.withColumns({"area": area, "n_centres": n_centres}).drop("counted")
    return sheets.join(_persons(src).where(keyed), on="idpointage", how="left").join(links, on="idpointage", how="inner")


def fact_labour(src: Source, params: Params) -> DataFrame:
    """Direct (plot) and indirect (cost-centre) rows in one pass.

    Plot links and centre links are stacked into one link table, which has its
    per-timesheet statistics (planted area of the linked plots, number of
    linked centres).  The two fan-outs, persons and links, are on one partitioning
    by timesheet.  If any timesheet is hot (``skew.hot_keys``, by persons or by
    links), each has exchanges of its own instead, so AQE can split a timesheet
    that holds a third of the persons or of the links; only data with such a key
    pay for that.
    """
    return _fact_columns(_hot_rows(src) if _is_hot(src) else _plain_rows(src, timesheets(src)))


def fact_labour_pieces(src: Source, params: Params) -> list:
    """``fact_labour`` for the removal of duplicates.  Equal rows of two timesheets
    have the same date, operation label, farm and person.  Few timesheets share
    these with another; all others have their duplicates within themselves, where
    the fan-outs leave them, and need no shuffle of whole rows."""
    if _is_hot(src):
        return [(_fact_columns(_hot_rows(src)), None)]
    p = src("pointage").select("idpointage", "date", "oper_liste", "idfermes")
    farms = src("fermes").select("idfermes", F.col("nom").alias("ferme"))
    persons = src("personnel_pointage").select("idpointage", "pers_id").where(F.col("idpointage").isNotNull())
    shared = shared_units(p.join(farms, on="idfermes", how="left").drop("idfermes").join(persons, on="idpointage", how="left"), "idpointage")
    sheets = timesheets(src)
    alone, among = (_plain_rows(src, sheets.join(shared, on="idpointage", how=how)) for how in ("left_anti", "left_semi"))
    return [(_fact_columns(alone, "idpointage"), "idpointage"), (_fact_columns(among), None)]


def _fact_columns(rows: DataFrame, *more: str) -> DataFrame:
    plot = F.col("is_plot")

    def on_plot(expr):
        return F.when(plot, expr).otherwise(typed_null("double"))

    hours = {fc: on_plot(_hours("link_cout", pc)) for fc, pc in HOUR_BUCKETS}
    direct = on_plot(safe_ratio(F.col("pers_cout") * F.col("sup"), F.col("area")))
    indirect = F.when(~plot, safe_ratio(F.col("pers_cout"), F.col("n_centres")))
    return rows.select(
        F.col("date").alias("date_pointage"), "id_parcelle", "id_personnel", "id_operation",
        direct.alias("cost_analytique_direct"),
        *[hours[fc].alias(fc) for fc, _ in HOUR_BUCKETS],
        on_plot(F.col("cout_hscu")).alias("cout_hscu"), on_plot(F.col("hscu")).alias("hscu"),
        "id_centre_cout", indirect.alias("cost_analytique_indirect"),
        F.when(~plot, _hours("link_cout", "hj")).alias("hj_indirect"),
        F.when(plot & F.col("id_parcelle").isNotNull(), F.lit("Parcelle"))
        .otherwise(F.lit("Centre")).alias("type_affectation"),
        typed_null("boolean").alias("paie_generee"), "campagne",
        typed_null("string").alias("sbi"),
        (F.coalesce(direct, F.lit(0.0)) + F.coalesce(indirect, F.lit(0.0)))
        .alias("cost_analytique"),
        F.lit(0.0).cast("double").alias("cost_paie"), "ferme", "oper_liste",
        F.col("id_personnel").alias("ouvrier"), *more)


def farm_labour(src: Source, params: Params) -> DataFrame:
    """Timesheet x person lines with operation family, person category and
    the farm's planted area (plots of every variety but the excluded one;
    a NULL variety is excluded too, as ``<>`` drops NULL)."""
    p = src("pointage").select("idpointage", "date", "oper_liste", "idfermes")
    pp = src("personnel_pointage").select("idpointage", "pers_id", "hj")
    ops = src("operation_ref").select(F.col("operef_intitule").alias("oper_liste"),
                                      F.col("oper_famille"))
    fam = src("famille_operation").select(F.col("id").alias("oper_famille"), "famille")
    farms = src("fermes").select("idfermes", F.col("nom").alias("ferme"))
    staff = src("personnel").select(F.col("id").alias("pers_id"), F.col("categorie").alias("_cat"))
    cat = src("categorie_personnel").select(F.col("id").alias("_cat"), "categorie")
    area = (src("parcelleculturale").where(F.col("variete") != params.excluded_variety)
            .groupBy("idfermes").agg(F.sum("sup").alias("sup_ferme")))
    # the per-timesheet attributes first, then the person fan-out
    t = (p.join(ops, on="oper_liste", how="left")
         .join(fam, on="oper_famille", how="left")
         .join(farms, on="idfermes", how="left")
         .join(area, on="idfermes", how="left"))
    staff_cat = staff.join(cat, on="_cat", how="left").drop("_cat")
    lines = (fanout_left_join(t, pp, "idpointage", p)
             .join(staff_cat, on="pers_id", how="left"))
    return lines.select("ferme", "date", "famille", "oper_liste",
                        F.col("pers_id").alias("ouvrier"), "hj", "categorie", "sup_ferme")
