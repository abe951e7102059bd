"""Three-level time-series catalogues on Spark: build, navigate, profile, check."""

from .config import BuildSpec, CatalogueConfig, EmbeddingSpec, Filters, SourceSpec, load_config
from .plans.build import Catalogue, build_catalogue, read_catalogue, run, write_catalogue
from .plans.diagnostics import diagnostics
from .plans.maps import map_l2_l3
from .plans.preview import series_preview
from .plans.validation import repro_manifest, validate_catalogue

__all__ = [
    "BuildSpec", "Catalogue", "CatalogueConfig", "EmbeddingSpec", "Filters", "SourceSpec",
    "build_catalogue", "diagnostics", "load_config", "map_l2_l3", "read_catalogue",
    "repro_manifest", "run", "series_preview", "validate_catalogue", "write_catalogue",
]
