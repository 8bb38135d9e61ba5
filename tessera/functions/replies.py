"""Reply parsing for batched labelling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.nulls import strip_ws

# Fixed label set of the risk classifier; anything else becomes the default.
RISK_LABELS = [
    "competitive_risk", "cyber_technology_risk", "financial_credit_risk",
    "litigation_risk", "market_risk", "operational_risk",
    "other_risk", "regulatory_risk", "strategic_risk",
]
DEFAULT_LABEL = "other_risk"


def extract_json_array(reply: Column) -> Column:
    """The JSON array of strings in a reply that may have text around it:
    from the first ``[`` to the last ``]`` of the stripped reply; no bracket or
    invalid JSON -> NULL."""
    body = F.regexp_extract(strip_ws(reply), r"(?s)\[.*\]", 0)
    return F.when(body == "", F.lit(None)).otherwise(F.from_json(body, "array<string>"))


def normalize_labels(labels: Column, n: Column, valid: Sequence[str] = RISK_LABELS,
                     default: str = DEFAULT_LABEL) -> Column:
    """Strip, lower-case, spaces to ``_``; unknown -> default; a failed parse
    -> ``n`` defaults; the result is padded / truncated to ``n``."""
    allowed = F.array(*[F.lit(v) for v in valid])

    def norm(lbl: Column) -> Column:
        t = F.regexp_replace(F.lower(strip_ws(lbl)), " ", "_")
        return F.when(F.array_contains(allowed, t), t).otherwise(F.lit(default))

    cleaned = F.transform(labels, norm)
    filled = F.coalesce(cleaned, F.array_repeat(F.lit(default), n))
    padded = F.concat(filled, F.array_repeat(F.lit(default), F.greatest(n - F.size(filled), F.lit(0))))
    return F.slice(padded, 1, n)
