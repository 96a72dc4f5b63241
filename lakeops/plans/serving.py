"""One view over several stores, everything as text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.functions.text import as_text
from lakeops.plans.feeds import BILL_ORDER

AUDIT = ("creation_user", "creation_date", "creation_ip")
LABEL = "tabla_origen"


def union_view(stores: Mapping[str, DataFrame], columns: Sequence[str] = (*BILL_ORDER, *AUDIT)) -> DataFrame:
    """UNION ALL of the stores, each column cut to 255 characters and labelled by its store. A
    column a store lacks is NULL there. Stays lazy, so a filter on the view reaches each scan."""
    view = None
    for label, rows in stores.items():
        have = set(rows.columns)
        texts = [as_text(F.col(c) if c in have else F.lit(None)).alias(c) for c in columns]
        part = rows.select(*texts, F.lit(label).alias(LABEL))
        view = part if view is None else view.unionByName(part)
    if view is None:
        raise ValueError("no stores to unite")
    return view
