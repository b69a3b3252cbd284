"""tenantmart: multi-tenant farm-accounting warehouse models on Spark.

Subpackages: ``sources`` (where tenant tables come from), ``plans`` (the
models as lazy DataFrame plans), ``operators`` (cleansing, loads, tenants,
audits, lookups, skew-safe joins), ``functions`` (column helpers).
``registry`` holds the queries registered for the driver, ``oracle`` their
DuckDB formulations.
"""

__version__ = "0.1.0"
