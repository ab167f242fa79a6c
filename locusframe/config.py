"""Analysis thresholds and configuration parsing."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields


@dataclass(frozen=True)
class Thresholds:
    """Numeric settings of an analysis run.

    min_freq: haplotypes rarer than this are pooled into one "rare" term.
    max_haps: an estimation with more candidate haplotypes fails.
    min_pp:   haplotype pairs with a smaller posterior are trimmed after
              each batch of sites.
    n_try:    number of starts of the haplotype estimation.
    n_batch:  sites inserted at a time.
    min_ac:   allele count band, see ``operators.variants``.
    """

    min_freq: float = 0.01
    max_haps: float = 4e6
    min_pp: float = 1e-5
    n_try: int = 2
    n_batch: int = 2
    min_ac: float = 5

    @classmethod
    def from_mapping(cls, values: Mapping[str, object]) -> "Thresholds":
        """Build from a parsed config section.

        YAML 1.1 hands ``4e6`` and ``1e-5`` over as strings, so every value
        goes through ``float`` first.
        """
        known = {f.name: f.type for f in fields(cls)}
        unknown = sorted(set(values) - set(known))
        if unknown:
            raise ValueError(f"unknown thresholds: {', '.join(unknown)}")
        parsed: dict[str, float] = {}
        for name, raw in values.items():
            number = float(str(raw))
            parsed[name] = int(number) if known[name] == "int" else number
        return cls(**parsed)


def optional_path(value: str | None) -> str | None:
    """A path setting that may be switched off with null, '' or 'None'."""
    if value is None or value.strip() in ("", "None"):
        return None
    return value
