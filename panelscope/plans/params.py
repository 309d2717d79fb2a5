"""Thresholds of the engine: frozen sections with type and range checks, loaded from JSON or used as defaults."""

from __future__ import annotations

import dataclasses
import hashlib
import json
from dataclasses import dataclass, field, fields


@dataclass(frozen=True)
class Clusters:
    method: str = "province"
    distance: str = "category_mix"
    distance_mix_weight: float = 0.5
    max_distance_quantile: float = 0.9
    size_hist_periods: int = 3
    size_max_splits: int = 4
    min_store: int = 10
    min_store_soft: int = 5
    soft_stop: bool = True
    min_store_cat: int = 10
    min_item: int = 10
    min_overlap_periods: int = 3
    trend_min_common_stores: int = 1
    vi_max: float = 1.2
    ks_max: float = 0.2
    psi_max: float = 0.25
    max_median_ratio: float = 2.0
    psi_bins: int = 10
    psi_min_bin_count: int = 5
    het_alpha: float = 0.05
    forced_nearest_warn_ratio: float = 0.3
    allow_forced_nearest: bool = False
    check_level: str = "cluster"
    mix_lookback: int = 1
    mix_weights: tuple = ()
    mix_common_stores: bool = False
    mix_start_period: int = 0


@dataclass(frozen=True)
class Detectors:
    adjbox_a: float = -4.0
    adjbox_b: float = 3.0
    adjbox_c: float = 7.0
    level_iqr_coef: float = 1.9992
    trim_pct: float = 0.01
    min_hist_periods: int = 3
    recommended_hist_periods: int = 13
    hist_start_period: int = 0
    hist_start_filter: bool = False
    trend_fence_fallback: bool = True
    level_borrow_cell: bool = True
    level_borrow_scale: float = 3.0
    fence_fallback_min_n: int = 10
    borrow_min_peer: int = 5
    shrink: bool = True
    shrink_min_n: int = 30
    shrink_scale: float = 3.0
    #: Count a store once in stratum references even if it stands in two of their peer sets.
    dedupe_cell_reference: bool = False


@dataclass(frozen=True)
class Seasonal:
    baseline_periods: int = 13
    sign_crit: float = 1.281552
    min_common_stores: int = 10
    borrow_cell: bool = True


@dataclass(frozen=True)
class Peer:
    evaluate_zero_rows: bool = False
    missing_sell_ratio: float = 0.8
    missing_min_prev_ratio: float = 0.5
    fallback_min_sell: int = 10
    store_drop_ratio: float = 0.5
    store_drop_min_prev_cat: int = 5


@dataclass(frozen=True)
class Items:
    min_level: str = "suspicious"
    top_n: int = 5
    min_peer_stores: int = 5
    tail_detect: float = 0.995
    tail_correct: float = 0.9
    tail_max: int = 50
    critical_ratio: float = 2.5
    packsize_tolerance: float = 0.2
    store_shift_ratio: float = 0.6
    store_shift_min_cat: int = 5


@dataclass(frozen=True)
class Params:
    base_cell: tuple = ("PLATFORMNAME", "SHOPTYPE")
    clusters: Clusters = field(default_factory=Clusters)
    detectors: Detectors = field(default_factory=Detectors)
    seasonal: Seasonal = field(default_factory=Seasonal)
    peer: Peer = field(default_factory=Peer)
    items: Items = field(default_factory=Items)
    evidence_high_min: int = 3
    eta2_strong: float = 0.06
    eta2_medium: float = 0.01
    rate_spike_ratio: float = 3.0
    grid_adjbox_c: tuple = (1.5, 3.0, 7.0, 9.0)

    def replaced(self, **sections) -> "Params":
        """With some fields of sections changed: replaced(clusters={"min_store": 30})."""
        new = {k: dataclasses.replace(getattr(self, k), **v) if isinstance(v, dict) else v for k, v in sections.items()}
        return validated(dataclasses.replace(self, **new))

    def flat(self) -> list[tuple[str, str]]:
        """(dotted key, JSON value) rows for snapshots."""
        out = []
        for k, v in dataclasses.asdict(self).items():
            out += [(f"{k}.{x}", json.dumps(y)) for x, y in v.items()] if isinstance(v, dict) else [(k, json.dumps(v))]
        return out


RANGES = {
    "clusters.max_distance_quantile": (0, 1),
    "clusters.distance_mix_weight": (0, 1),
    "clusters.het_alpha": (0, 1),
    "clusters.min_store": (1, None),
    "detectors.trim_pct": (0, 0.5),
    "detectors.adjbox_c": (0, None),
    "seasonal.baseline_periods": (1, None),
    "seasonal.min_common_stores": (1, None),
    "peer.missing_sell_ratio": (0, 1),
    "peer.store_drop_ratio": (0, 1),
    "items.tail_detect": (0, 1),
    "items.tail_correct": (0, 1),
    "items.top_n": (1, None),
}


def validated(p: Params) -> Params:
    for section in (p, *(getattr(p, f.name) for f in fields(p) if dataclasses.is_dataclass(getattr(p, f.name)))):
        for f in fields(section):
            v, want = getattr(section, f.name), type(f.default) if f.default is not dataclasses.MISSING else None
            if want in (int, float, bool, str, tuple):
                fits = isinstance(v, want) or want is float and isinstance(v, int) or want is tuple and isinstance(v, list)
                if not fits or want in (int, float) and isinstance(v, bool):
                    raise TypeError(f"{f.name}: {want.__name__} expected, not {type(v).__name__}")
    for key, (low, high) in RANGES.items():
        section, name = key.split(".")
        v = getattr(getattr(p, section), name)
        if low is not None and v < low or high is not None and v > high:
            raise ValueError(f"{key} = {v} is outside [{low}, {high}]")
    if p.clusters.method not in ("province", "size"):
        raise ValueError(f"unknown cluster method {p.clusters.method!r}")
    if p.clusters.distance not in ("category_mix", "trend", "combined"):
        raise ValueError(f"unknown distance {p.clusters.distance!r}")
    if p.clusters.check_level not in ("cluster", "category"):
        raise ValueError(f"unknown check level {p.clusters.check_level!r}")
    return p


def load(path: str) -> Params:
    """Sections and fields of a JSON file over the defaults; unknown keys raise KeyError."""
    with open(path, encoding="utf-8") as f:
        raw = json.load(f)
    base, out = Params(), {}
    for k, v in raw.items():
        if k not in {f.name for f in fields(Params)}:
            raise KeyError(k)
        now = getattr(base, k)
        if dataclasses.is_dataclass(now):
            known = {f.name for f in fields(now)}
            if unknown := set(v) - known:
                raise KeyError(f"{k}: {sorted(unknown)}")
            v = {x: tuple(y) if isinstance(y, list) else y for x, y in v.items()}
        elif isinstance(v, list):
            v = tuple(v)
        out[k] = v
    return base.replaced(**out)


def digest(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()
