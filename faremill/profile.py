"""Thresholds and conventions as frozen dataclasses, so that each caller picks a named profile."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class CleaningLimits:
    """Inclusive limits a trip must satisfy to be kept."""

    fare: tuple[float, float] = (2.5, 250.0)
    distance: tuple[float, float] = (0.1, 50.0)
    duration: tuple[float, float] = (1.0, 180.0)
    passengers: tuple[float, float] = (1.0, 6.0)
    max_speed: float = 100.0
    short_distance: float = 0.1
    long_wait_minutes: float = 5.0


@dataclass(frozen=True)
class Conventions:
    """Which zones and hours a flag covers; training and serving disagree, so both are named."""

    airports: tuple[int, ...]
    manhattan: tuple[int, int]
    rush_hours: tuple[int, ...]
    late_hours: tuple[int, ...]
    business_hours: tuple[int, int] = (9, 17)


LIMITS = CleaningLimits()

TRAINING = Conventions(
    airports=(132, 138, 161),
    manhattan=(4, 233),
    rush_hours=(7, 8, 9, 16, 17, 18, 19),
    late_hours=(22, 23, 0, 1, 2, 3, 4),
)

SERVING = Conventions(
    airports=(132, 138),
    manhattan=(100, 170),
    rush_hours=(7, 8, 9, 17, 18, 19),
    late_hours=(23, 0, 1, 2, 3),
)
