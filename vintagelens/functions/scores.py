"""Reading of model quality and drift figures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Alert limits.
PSI_CRITICAL = 0.25
PSI_WARNING = 0.1
AUC_RETRAIN = 0.65


def gini(auc: Column | str) -> Column:
    """``2 * auc - 1`` to three places, rounded on the decimal value."""
    c = F.col(auc) if isinstance(auc, str) else auc
    return F.round((2 * c - 1).cast("decimal(18,12)"), 3).cast("double")


def psi_status(psi: Column | str) -> Column:
    c = F.col(psi) if isinstance(psi, str) else psi
    known = F.when(c > PSI_CRITICAL, "CRITICAL").when(c > PSI_WARNING, "WARNING").when(c.isNotNull(), "STABLE")
    return known.otherwise("NO BINS")


def auc_status(auc: Column | str) -> Column:
    c = F.col(auc) if isinstance(auc, str) else auc
    return F.when(c < AUC_RETRAIN, "RETRAIN").when(c.isNotNull(), "CLEAR").otherwise("NO LABELS")
