"""Everything about a run that is not data: identity, clock and fixed thresholds."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime, timezone


@dataclass(frozen=True)
class RunContext:
    """Injected clock and parameters; no operator reads the wall clock itself."""

    run_id: str = "manual"
    started_at: datetime = field(default_factory=lambda: datetime.now(timezone.utc))
    as_of: date | None = None
    # First report year, index ticker, look-back years, display time zone.
    min_year: int = 2018
    benchmark: str = "VNINDEX"
    history_years: int = 8
    display_zone: str = "Asia/Ho_Chi_Minh"
    # Form of a company key; rows with another one are left out.
    ticker_pattern: str = "^[A-Z0-9]{3}$"
    # "decimal4" quantises ratios to four digits before ranking, "double" keeps them whole.
    ratio_mode: str = "double"

    @property
    def today(self) -> date:
        return self.as_of or self.started_at.date()

    @property
    def fallback_date(self) -> date:
        """Start of history for an entity that has never been ingested."""
        return date(self.today.year - self.history_years, 1, 1)

    @property
    def absolute_quarter(self) -> int:
        return self.today.year * 4 + (self.today.month + 2) // 3
