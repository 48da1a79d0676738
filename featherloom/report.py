"""Collects what a spec asked for but the data could not give."""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

log = logging.getLogger("featherloom")


@dataclass
class Report:
    """Skipped names per operator; every entry is logged as a warning too."""

    skipped: list[tuple[str, str, str]] = field(default_factory=list)

    def skip(self, operator: str, name: str, reason: str) -> None:
        self.skipped.append((operator, name, reason))
        log.warning("%s: skipped %s (%s)", operator, name, reason)

    def names(self, operator: str | None = None) -> list[str]:
        return [n for op, n, _ in self.skipped if operator in (None, op)]


def ensure(report: Report | None) -> Report:
    return report if report is not None else Report()
