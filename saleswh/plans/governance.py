"""Governance: PII masking by role (G1, G2) and role-scoped views.

Masking is a column expression; the role is a literal, so Catalyst folds
the privileged branch away and the plan stays a plain projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saleswh.plans import marts
from saleswh.plans.warehouse import Warehouse

# Privileged roles, the mask text and the e-mail mask rule.
PRIVILEGED_ROLES = ("R_DATA_ANALYST", "R_DATA_ENGINEER", "ACCOUNTADMIN", "SYSADMIN")
MASK = "***PROTEGIDO***"
EMAIL_LOCAL_PART = "^[^@]+"
EMAIL_MASK = "*****"

# Column -> policy for the customer dimension.
CUSTOMER_POLICY = {"CUSTOMER_NAME": "string", "TAX_ID": "string", "EMAIL": "email"}

# Role -> objects it may read (KPI-only, masked analyst, ...).
ROLE_OBJECTS = {
    "R_DATA_ENGINEER": ("*",),
    "R_DATA_ANALYST": ("curated",),
    "R_ANALYST_MASKED": ("curated",),
    "R_GERENCIA": ("v_ventas_mensuales", "v_cumplimiento_ppto"),
    "R_AUDITOR": ("governance",),
    "R_ML_SERVICE": ("curated",),
}


def mask_string(c: Column, role: str) -> Column:
    """G1: value for privileged roles, the mask otherwise (NULL is masked too)."""
    return c if role in PRIVILEGED_ROLES else F.lit(MASK)


def mask_email(c: Column, role: str) -> Column:
    """Local part replaced, domain kept; text without '@' becomes the mask."""
    return c if role in PRIVILEGED_ROLES else F.regexp_replace(c, EMAIL_LOCAL_PART, EMAIL_MASK)


def mask_pii(df: DataFrame, role: str, policy: dict[str, str] | None = None) -> DataFrame:
    policy = policy or CUSTOMER_POLICY
    out = []
    for c in df.columns:
        kind = policy.get(c)
        if kind == "string":
            out.append(mask_string(F.col(c), role).alias(c))
        elif kind == "email":
            out.append(mask_email(F.col(c), role).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def publish_views(spark: SparkSession, role: str, objects: dict[str, tuple[str, DataFrame]]) -> list[str]:
    """Register the temp views a role may read, PII masked per role.

    ``objects`` maps view name -> (layer, frame).  Returns the view names.
    """
    allowed = ROLE_OBJECTS.get(role, ())
    names = []
    for name, (layer, df) in objects.items():
        if "*" in allowed or layer in allowed or name in allowed:
            mask_pii(df, role).createOrReplaceTempView(name)
            names.append(name)
    return names


def named_views(wh: Warehouse) -> dict[str, tuple[str, DataFrame]]:
    """The KPI and model-input views by name, for ``publish_views``: what reports and models read."""
    views = {"v_ventas_mensuales": marts.monthly_sales(wh), "v_cumplimiento_ppto": marts.budget_attainment(wh),
             "model_daily_sales": marts.daily_sales(wh), "model_daily_billing": marts.daily_billing(wh), "model_driver_base": marts.driver_base(wh)}
    return {name: ("curated", df) for name, df in views.items()}
