"""The three steps from feed lines to enriched quotes."""

from tapewright.plans.enrich import enrich_quotes, run_enrich
from tapewright.plans.ingest import ingest, run_ingest
from tapewright.plans.preprocess import preprocess, run_late_deliveries, run_preprocess

__all__ = [
    "enrich_quotes",
    "ingest",
    "preprocess",
    "run_enrich",
    "run_ingest",
    "run_late_deliveries",
    "run_preprocess",
]
