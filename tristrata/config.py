"""Build configuration as plain dataclasses; unknown keys are refused."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field, fields
from typing import Any


def _checked(cls, values: dict[str, Any] | None):
    values = dict(values or {})
    known = {f.name for f in fields(cls)}
    unknown = sorted(set(values) - known)
    if unknown:
        raise ValueError(f"unknown {cls.__name__} options: {unknown}")
    return cls(**values)


@dataclass
class SourceSpec:
    """One input table; ``meta`` entries become literal columns."""

    table: int
    url: str
    meta: dict[str, Any] = field(default_factory=dict)


@dataclass
class Filters:
    """Series filters; the defaults drop nothing."""

    min_points: int = 1
    drop_if_zeros_pct_gte: float | None = None
    drop_constant: bool = False


@dataclass
class BuildSpec:
    area_col: str = "Area"
    item_col: str = "Item"
    element_col: str = "Element"
    unit_col: str = "Unit"
    year_col: str = "Year"
    value_col: str = "Value"
    drop_columns_regex: str | None = r".*(Source|Code|Flag|Note|Unnamed).*"
    include_codes: bool = False
    filters: Filters = field(default_factory=Filters)
    # Descriptions start with "<dataset> domain" / "<dataset> series".
    dataset: str = "Statistics"
    # "spread": combine duplicates map-side and shuffle by (series, year), safe
    # for hot series. "colocate": one exchange by series, for clean inputs.
    shuffle: str = "spread"


@dataclass
class EmbeddingSpec:
    enabled: bool = False
    levels: list[str] = field(default_factory=lambda: ["l3", "l2"])
    model_name: str = "hashed-tokens-64"
    l2_normalize: bool = True
    batch_size: int = 1024

    def __post_init__(self) -> None:
        bad = sorted(set(self.levels) - {"l3", "l2"})
        if bad:
            raise ValueError(f"embedding levels must be l3 or l2, got {bad}")


@dataclass
class CatalogueConfig:
    sources: list[SourceSpec]
    run_id: str = "catalogue"
    seed: int = 42
    build: BuildSpec = field(default_factory=BuildSpec)
    embeddings: EmbeddingSpec = field(default_factory=EmbeddingSpec)

    def __post_init__(self) -> None:
        if not self.sources:
            raise ValueError("a catalogue needs one source at least")

    @classmethod
    def from_dict(cls, raw: dict[str, Any]) -> "CatalogueConfig":
        """Build from nested dictionaries (``run``, ``sources``, ``build``, ``embeddings``)."""
        raw = dict(raw)
        unknown = sorted(set(raw) - {"run", "sources", "build", "embeddings"})
        if unknown:
            raise ValueError(f"unknown configuration sections: {unknown}")
        run = dict(raw.get("run") or {})
        extra = sorted(set(run) - {"run_id", "seed"})
        if extra:
            raise ValueError(f"unknown run options: {extra}")
        build = dict(raw.get("build") or {})
        if "filters" in build:
            build["filters"] = _checked(Filters, build["filters"])
        return cls(
            sources=[_checked(SourceSpec, s) for s in raw.get("sources") or []],
            build=_checked(BuildSpec, build),
            embeddings=_checked(EmbeddingSpec, raw.get("embeddings")),
            **run,
        )

    def to_json(self) -> str:
        return json.dumps(asdict(self), ensure_ascii=False, sort_keys=True)


def load_config(path: str) -> CatalogueConfig:
    """Read a JSON configuration file."""
    with open(path, encoding="utf-8") as f:
        return CatalogueConfig.from_dict(json.load(f))
