"""The tenant models, one lazy DataFrame plan each.

``keys`` are the row identity used by the keyed upsert; ``date_cols`` the
business date columns handed to the cleansing step; ``merge`` marks the
tables appended into the central multi-tenant store.
"""

from __future__ import annotations

from .base import FIXTURE_PARAMS, Model, Params, Source
from .dims import (analytic_accounts, budget_accounts, budget_versions, dim_cost_centre,
                   dim_operation, dim_plot, dim_season, dim_staff, pl_accounts)
from .labour import fact_labour, fact_labour_pieces, farm_labour
from .calendar import tenant_calendar
from .sales import budget_weekly, direct_costs, production_profile, sales_production

_MODELS: list[Model] = [
    Model("analytic_accounts", analytic_accounts, keys=("id_code_analytique",), merge=True,
          grain="account x budget attachment"),
    Model("budget_accounts", budget_accounts, keys=("id_code_budgetaire",), merge=True,
          grain="budget account x P&L link"),
    Model("sales_production", sales_production, keys=("idvente",), date_cols=("date_vente",),
          merge=True, grain="sale x harvest batch x plot", unique=False, distinct=True),
    Model("production_profile", production_profile, keys=("id_bdg_profil_production",),
          merge=True, grain="profile x season x plot", unique=False, distinct=True),
    Model("direct_costs", direct_costs, keys=("idparcelleculturale", "date"),
          date_cols=("date",), merge=True, grain="cost line x plot", unique=False),
    Model("budget_weekly", budget_weekly, keys=("id_bdg_versions", "idparcelle"),
          date_cols=("dateweek",), merge=True, grain="budget detail line", unique=False),
    Model("pl_accounts", pl_accounts, keys=("id_bdg_comptes_pl",), merge=True,
          grain="P&L account"),
    Model("budget_versions", budget_versions, keys=("id_bdg_versions",), merge=True,
          grain="budget version"),
    Model("dim_staff", dim_staff, keys=("id_personnel",), grain="person"),
    Model("dim_operation", dim_operation, keys=("id_operation",), grain="operation"),
    Model("dim_plot", dim_plot, keys=("id_parcelle",), grain="plot x operational group", unique=False),
    Model("farm_labour", farm_labour, keys=("ferme",), grain="timesheet x person", unique=False),
    Model("dim_season", dim_season, keys=("id_campagne",), grain="season"),
    Model("dim_cost_centre", dim_cost_centre, keys=("idcentre_intermediaire",),
          grain="cost centre"),
    Model("fact_labour", fact_labour, keys=("date_pointage", "id_personnel", "id_operation"),
          date_cols=("date_pointage",), grain="timesheet x person x (plot | cost centre)", unique=False,
          pieces=fact_labour_pieces),
]

MODELS: dict[str, Model] = {m.name: m for m in _MODELS}

# Built by batch runs beside the models; the registered query of this name spans the base tables.
CALENDAR = Model("dim_calendar", tenant_calendar, keys=("date_cal",), merge=True, grain="day")


def merge_tables() -> list[str]:
    """Tables appended into the central store: the staging models and the
    calendar (tenant tagging covers every model)."""
    return [m.table for m in MODELS.values() if m.merge] + [CALENDAR.table]


def register(model: Model) -> Model:
    MODELS[model.name] = model
    return model


__all__ = ["CALENDAR", "FIXTURE_PARAMS", "MODELS", "Model", "Params", "Source", "merge_tables", "register"]
