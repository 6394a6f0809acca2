"""Column functions (F*, P*, U1)."""
from saleswh.functions.sap import *  # noqa: F401,F403
