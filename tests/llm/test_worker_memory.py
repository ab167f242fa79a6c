from __future__ import annotations

import numpy as np

from locusframe.llm.common import worker_cache


def _resident_mb() -> float:
    with open("/proc/self/statm") as f:
        return int(f.read().split()[1]) * 4096 / 1e6


def test_a_stage_gives_back_what_the_one_before_held():
    """Small arrays lie in the C library's heap; one that lives on behind them
    keeps it from shrinking by itself."""
    held = worker_cache("first stage")
    held["arrays"] = [np.ones(300) for _ in range(60_000)]
    pin = np.ones(300)
    before = _resident_mb()
    del held
    worker_cache("second stage")
    assert before - _resident_mb() > 100
    assert pin.sum() == 300
