"""Thresholds of the evidence operators, each with its default."""

from __future__ import annotations

from dataclasses import dataclass, field

from gleaner import vocab


@dataclass(frozen=True)
class Settings:
    """now: the instant (epoch seconds) that ages are measured from."""

    now: int = 1_770_000_000
    default_half_life: float = 4.0
    half_lives: dict[str, float] = field(default_factory=lambda: dict(vocab.HALF_LIFE_YEARS))
    default_confidence: float = 0.6
    shrinkage: float = 2.0
    per_document: int = 3
    per_author_cell: int = 2
    label_band: float = 0.15
    min_price_weight: float = 1.0
    min_weight: float = 0.3
    min_item_weight: float = 1.0
    min_timestamp: int = 1_100_000_000
    horizon_years: float = 5.0
    min_chars: int = 40
    max_chars: int = 6000
    parent_chars: int = 1500
    review_chars: int = 120
    min_ratings: int = 20
    match_metres: float = 150.0
    min_claims_to_calibrate: int = 30
    branch_points: int = 10
    disagreement_sigmas: float = 2.0
    min_cell_weight: float = 1.0
    habit_half_life_days: float = 56.0
    habit_floor: float = 0.35
