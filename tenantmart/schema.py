"""Declared warehouse schema: 16 tables, their types and constraints.

One table per model (same name everywhere) plus the calendar dimension.
``varchar(n)`` lengths, primary keys, the unique constraint and the foreign
keys are declared here; Spark does not enforce them, the audit operators
check them as queries.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Col:
    name: str
    type: str                    # Spark SQL type name; varchar(n) kept as text
    ref: tuple[str, str] | None = None   # (table, column) of a foreign key

    @property
    def length(self) -> int | None:
        if self.type.startswith("varchar("):
            return int(self.type[8:-1])
        return None

    @property
    def spark_type(self) -> str:
        return "string" if self.length is not None else self.type


@dataclass(frozen=True)
class Table:
    name: str
    columns: tuple[Col, ...]
    primary_key: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, T._parse_datatype_string(c.spark_type), True)
                             for c in self.columns])

    def ddl_columns(self) -> str:
        return ", ".join(f"`{c.name}` {c.type}" for c in self.columns)


def _cols(spec: str, **refs) -> tuple[Col, ...]:
    out = []
    for part in spec.split(","):
        name, typ = part.split()
        out.append(Col(name, typ, refs.get(name)))
    return tuple(out)


def _vc(n):
    return f"varchar({n})"


TABLES: dict[str, Table] = {}


def _table(name, spec, pk=(), unique=(), **refs):
    TABLES[name] = Table(name, _cols(spec, **refs), tuple(pk), tuple(unique))


# Column types and lengths of the declared warehouse tables.
_table("dim_staff", "id_personnel bigint, matricule_personnel varchar(50), "
       "nom_personnel varchar(100), prenom_personnel varchar(100), date_embauche date, "
       "salaire_base double, categorie_personnel varchar(100)", pk=("id_personnel",))
_table("dim_operation", "id_operation bigint, reference_operation varchar(200), "
       "famille_operation varchar(200)", pk=("id_operation",))
_table("dim_plot", "id_parcelle bigint, parcelleculturale varchar(100), "
       "reference_parcelle_2 varchar(100), annee_plantation int, date_plantation date, "
       "statut varchar(50), superficie_ha double, date_arrachage date, societe varchar(200), "
       "ferme varchar(200), zone varchar(100), variete varchar(100), culture varchar(100), "
       "porte_greffe varchar(100), groupe_operationnel varchar(100), "
       "tokenpolygone varchar(1000), latitude double, longitude double", pk=("id_parcelle",))
_table("farm_labour", "ferme varchar(200), date date, famille varchar(100), "
       "oper_liste varchar(100), ouvrier bigint, hj double, categorie varchar(100), "
       "sup_ferme double", pk=("ferme",))
_table("dim_cost_centre", "idcentre_intermediaire bigint, titre varchar(200), "
       "description varchar(500), id_service bigint, type_centre varchar(100), "
       "code_campagne varchar(50), id_responsable bigint, date_debut date, date_fin date, "
       "uo varchar(50), cout_pre_etabli double, created date, updated date, "
       "updatedby varchar(100), section varchar(100), reference varchar(100), "
       "ref_titre varchar(100), idsociete bigint, is_source boolean, createdby varchar(100)",
       pk=("idcentre_intermediaire",))
_table("dim_season", "id_campagne bigint, date_debut date, date_fin date, "
       "societe varchar(200), reference_campagne varchar(100), id_campagne_n1 bigint",
       pk=("id_campagne",), id_campagne_n1=("dim_season", "id_campagne"))
_table("dim_calendar", "date_cal date, year int, quarter varchar(10), month_number int, "
       "month varchar(20), day int, week_of_year int, day_of_week int, day_name varchar(20)",
       pk=("date_cal",))
_table("budget_accounts", "id_code_budgetaire bigint, classe_ varchar(50), "
       "rubrique_1 varchar(100), rubrique_2 varchar(100), rubrique_3 varchar(100), "
       "rubrique_4 varchar(100), rubrique_5 varchar(100), code_budgetaire varchar(100), "
       "unite varchar(50), cout_unitaire double, compte_pl bigint", pk=("id_code_budgetaire",))
_table("analytic_accounts", "id_code_analytique bigint, classe_ varchar(50), "
       "rubrique_1 varchar(100), rubrique_2 varchar(100), rubrique_3 varchar(100), "
       "rubrique_4 varchar(150), rubrique_5 varchar(100), id_referentiel bigint, "
       "table_nom varchar(100), ordre_ bigint, type_charge varchar(50), "
       "code_analytique varchar(150), id_bdg_attachements_codes bigint, "
       "id_code_budgetaire bigint", pk=("id_code_analytique",),
       id_code_budgetaire=("budget_accounts", "id_code_budgetaire"))
_table("pl_accounts", "id_bdg_comptes_pl bigint, code varchar(100), type varchar(50), "
       "ordre bigint, formule varchar(255), creation_par varchar(100), creation_date date, "
       "niveau bigint, id_compte_parent bigint", pk=("id_bdg_comptes_pl",),
       id_compte_parent=("pl_accounts", "id_bdg_comptes_pl"))
_table("production_profile", "id_bdg_profil_production bigint, id_campagne bigint, "
       "profil varchar(150), descriptif varchar(500), filiere varchar(100), "
       "id_parcelleculturale bigint, parcelle varchar(100), superficie double, "
       "statut_arrachage varchar(100), variete varchar(100), culture varchar(100), "
       "ferme varchar(200), date_debut_travaux date, previsionnelle int",
       pk=("id_bdg_profil_production",), unique=(("id_parcelleculturale",),),
       id_campagne=("dim_season", "id_campagne"),
       id_parcelleculturale=("dim_plot", "id_parcelle"), ferme=("farm_labour", "ferme"))
_table("sales_production", "idfermes bigint, idvente bigint, reference_vente varchar(150), "
       "date_vente date, total double, client bigint, description varchar(500), "
       "date_recolte date, prix double, pfq double, idparcelle bigint, "
       "idproduit_rendement bigint, code_analytique varchar(150), id_code_analytique bigint, "
       "poids_moyen double, quantite double, poids_kg double, unite varchar(50), "
       "chiffre_affaire double", pk=("idvente",),
       idparcelle=("dim_plot", "id_parcelle"),
       id_code_analytique=("analytic_accounts", "id_code_analytique"))
_table("direct_costs", "date date, charge_niv1 varchar(100), charge_niv2 varchar(100), "
       "charge_niv3 varchar(100), charge_article varchar(150), ferme varchar(200), "
       "culture varchar(100), variete varchar(100), idparcelleculturale bigint, "
       "parcelle_culturale varchar(100), cout double, quantite double, cout_unitaire double, "
       "compte_analytique varchar(400)",
       ferme=("farm_labour", "ferme"), idparcelleculturale=("dim_plot", "id_parcelle"))
_table("budget_weekly", "id_bdg_versions bigint, idparcelle bigint, idprofil bigint, "
       "idcomptebudgetaire bigint, montant_total double, montant_ha double, dateweek date",
       pk=("id_bdg_versions",), idparcelle=("dim_plot", "id_parcelle"),
       idprofil=("production_profile", "id_bdg_profil_production"),
       idcomptebudgetaire=("budget_accounts", "id_code_budgetaire"))
_table("budget_versions", "reference varchar(100), id_bdg_versions bigint, "
       "derniere_generation timestamp_ntz, hypothese varchar(100), status varchar(50)",
       pk=("reference",))
_table("fact_labour", "date_pointage date, id_parcelle bigint, id_personnel bigint, "
       "id_operation bigint, cost_analytique_direct double, hj_direct double, hj_hs25 double, "
       "hj_hs50 double, hj_hs100 double, hj_hsnm double, cout_hscu double, hscu double, "
       "id_centre_cout bigint, cost_analytique_indirect double, hj_indirect double, "
       "type_affectation varchar(50), paie_generee varchar(50), campagne bigint, sbi double, "
       "cost_analytique double, cost_paie double, ferme varchar(200), "
       "oper_liste varchar(100), ouvrier bigint",
       id_parcelle=("dim_plot", "id_parcelle"), id_personnel=("dim_staff", "id_personnel"),
       id_operation=("dim_operation", "id_operation"),
       id_centre_cout=("dim_cost_centre", "idcentre_intermediaire"),
       campagne=("dim_season", "id_campagne"), ferme=("farm_labour", "ferme"))


def foreign_keys() -> list[tuple[str, str, str, str]]:
    """(child table, child column, parent table, parent column)."""
    return [(t.name, c.name, c.ref[0], c.ref[1])
            for t in TABLES.values() for c in t.columns if c.ref]


def key_constraints() -> list[tuple[str, str, tuple[str, ...]]]:
    """(table, 'primary'|'unique', columns)."""
    out = []
    for t in TABLES.values():
        if t.primary_key:
            out.append((t.name, "primary", t.primary_key))
        for u in t.unique:
            out.append((t.name, "unique", u))
    return out
