"""Parameters of the pipeline. Every operator takes them as arguments; these are the defaults."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    # Clean layer keeps these years, marts analyse these years.
    window_first_year: int = 2019
    window_last_year: int = 2025
    year_min: int = 2019
    year_max: int = 2025
    # KPI guards.
    min_clearances: int = 10
    min_recalls: int = 3
    # Fuzzy matching, on a 0-100 scale.
    high_score: float = 85
    low_score: float = 60
    alias_score: float = 90
    review_top_n: int = 200
    # Row caps of the app tables.
    overview_rows: int = 5_000
    category_rows: int = 20_000
    manufacturer_rows: int = 30_000


DEFAULTS = Settings()
