"""The composed datasets."""

from tabularium.plans.enrichment import enrich, enrich_files, page_results, unsearchable
from tabularium.plans.registry import (
    ADDRESS_COLUMNS,
    activities,
    cities,
    companies,
    countries,
    establishments,
    legal_natures,
    partners,
    qualifications,
    regime,
)
from tabularium.plans.job import RegistryFiles, consolidate_files, job_counts, read_regime, read_registry
from tabularium.plans.state import state_extract
