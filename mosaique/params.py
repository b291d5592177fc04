"""Parameters of the analysis."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    """psi: day threshold. phi: sub-period ratio. xi: disclosure threshold. k: k-anonymity of indicator histograms.
    floor, cap, min_count: bounds of a calibration weight. epsilon: least strength."""

    psi: float = 10.0
    phi: float = 0.5
    xi: float = 1.0
    k: int = 20
    floor: float = 0.2
    cap: float = 10.0
    min_count: float = 10.0
    epsilon: float = 1e-20
    with_calibration: bool = True
    float32_state: bool = False
    random_ties: int | None = None

    def __post_init__(self):
        if not self.psi > 0:
            raise ValueError("psi must be positive")


#: Bounds of a report request.
MAX_AREAS, MAX_AREA_ROWS, MAX_RESIDENT_ROWS = 128, 1_000_000, 1_000_000
#: Record sizes in bytes: input, state, quantised.
H_BYTES, S_BYTES, Y_BYTES = 36, 32, 48
