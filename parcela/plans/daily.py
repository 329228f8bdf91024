"""Chains of steps: a day's run, and a backfill by region. Each step is one or a few Spark jobs."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field


@dataclass
class Steps:
    """What a run is made of; each callable starts Spark jobs and returns figures."""

    discover: Callable[..., dict]
    pending: Callable[[], int]
    drain: Callable[..., dict]
    mirror: Callable[[], dict]
    cleanup: Callable[[], dict]


@dataclass
class Settings:
    """Thresholds and defaults of the engine."""

    regions: tuple[int, ...] = tuple(range(1, 17))
    retry_cap: int = 3
    grace_pages: int = 2
    page_size: int = 10
    temp_days: int = 7
    units_at_once: int = 8
    error_chars: int = field(default=300)
    #: Pages of each unit that a full crawl stores at once.
    pages_at_once: int = 10
    #: What draws the reports of a limited drain; none for another draw each time.
    seed: int | None = None


def discover_all(regions: Iterable[int], discover: Callable[[int], dict], error_chars: int = 300) -> dict:
    """Figures of all regions; one that fails leaves its error, and the others go on."""
    total, failed, by_region = 0, 0, {}
    for r in regions:
        try:
            found = discover(r)
            total += found.get("rows_new", 0)
            by_region[r] = found
        except Exception as e:  # noqa: BLE001  a region's failure must not end the run
            failed += 1
            by_region[r] = {"error": str(e)[:error_chars]}
    return {"rows_new": total, "errors": failed, "regions": by_region}


def daily(steps: Steps, settings: Settings = Settings()) -> dict:
    """Discover, count what is pending, drain, mirror and clean up, in this order."""
    return {
        "discovery": discover_all(settings.regions, steps.discover, settings.error_chars),
        "pending": steps.pending(),
        "drain": steps.drain(),
        "mirror": steps.mirror(),
        "cleanup": steps.cleanup(),
    }


def backfill(regions: Iterable[int], steps: Steps, with_drain: bool = True, incremental: bool = False, resume: bool = False, most: int | None = None, limit: int | None = None) -> dict:
    """Per region its discovery, a full crawl unless ``incremental``, and the drain of its pending reports.

    With ``resume`` finished units are left out and others go on where they ended; ``most`` pages of a unit and ``limit`` reports of a
    region at most. A region that fails leaves its error, and the others go on.
    """
    return discover_all(regions, lambda r: _backfilled(r, steps, with_drain, incremental, resume, most, limit))


def _backfilled(region: int, steps: Steps, with_drain: bool, incremental: bool, resume: bool, most: int | None, limit: int | None) -> dict:
    found = steps.discover(region, incremental=incremental, resume=resume, most=most)
    return found | ({"drain": steps.drain(limit=limit, region=region)} if with_drain else {})
