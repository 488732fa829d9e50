"""What a run over landed files came to."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class LandingReport:
    """Files read and refused, rows stored, cells left out because they held no number."""

    read: int = 0
    refused: int = 0
    stored: int = 0
    left_out: int = 0
