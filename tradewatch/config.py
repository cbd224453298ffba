"""Parameters of the two feature models and of the alerting and training steps.

Plain frozen dataclasses: every operator takes one as an argument, nothing is read from the
environment, and wall-clock time never enters a transform (callers pass ``as_of``).
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Thresholds:
    """Alert limits of one symbol; ``None`` falls back to the default row field by field."""

    z: float | None = None
    volume: float | None = None
    price_change: float | None = None


# Default limits, then per-symbol overrides.
DEFAULT_THRESHOLDS = Thresholds(z=3.5, volume=3.0, price_change=5.0)
SYMBOL_THRESHOLDS = {
    "BTC/USDT": Thresholds(z=3.5, volume=3.0, price_change=3.0),
    "ETH/USDT": Thresholds(z=3.8, volume=3.5, price_change=4.0),
    "SOL/USDT": Thresholds(z=4.0, volume=4.0, price_change=6.0),
}

# Symbols shown before any trade has been seen.
DEFAULT_SYMBOLS = ("BTC/USDT", "ETH/USDT", "BNB/USDT", "SOL/USDT")

# Look-back choices of the read side, in minutes.
LOOKBACK_MINUTES = (10, 15, 60, 240, 1440, 10080)

# Candle interval names and the Spark durations they stand for.
CANDLE_INTERVALS = {
    "1min": "1 minute",
    "5min": "5 minutes",
    "15min": "15 minutes",
    "30min": "30 minutes",
    "1H": "1 hour",
    "1D": "1 day",
}


@dataclass(frozen=True)
class WindowConfig:
    """Event-time windows of the windowed model.

    ``tick_scale`` is the number of decimals of the price feed. When given, price sums are taken
    over whole ticks, so averages do not depend on the order in which partial sums are merged.
    ``max_trade_id`` is the largest id the feed can send; when it is small enough, first and last
    prices are found with a cheaper order key.
    """

    duration: str = "60 seconds"
    slide: str = "20 seconds"
    watermark: str = "30 seconds"
    tick_scale: int | None = None
    max_trade_id: int | None = None


@dataclass(frozen=True)
class RollingConfig:
    """Row frames of the rolling model, counted in trades of one symbol."""

    window: int = 1000
    min_history: int = 50
    vwap_window: int = 100
    velocity_window: int = 20
    spike_window: int = 50
    pressure_window: int = 10
    z_threshold: float = 3.5
    tick_scale: int | None = None
    block_rows: int = 1_000_000

    def __post_init__(self) -> None:
        widest = max(self.vwap_window, self.velocity_window, self.spike_window, self.pressure_window)
        if widest > self.window:
            raise ValueError("no frame may be wider than `window`")
        if min(self.min_history, self.pressure_window, self.velocity_window) < 2:
            raise ValueError("frames and min_history must cover at least two trades")
        if self.block_rows < 2 * self.window:
            raise ValueError("block_rows must be at least twice the rolling window")


@dataclass(frozen=True)
class ForestConfig:
    """Isolation-forest training parameters."""

    n_trees: int = 100
    max_samples: int = 256
    contamination: float = 0.01
    seed: int = 42
    min_rows: int = 100
    max_rows: int = 1000
    trees_per_task: int = 10
    features: tuple[str, ...] = ("z_score", "price_change_pct", "time_gap_sec")

    def __post_init__(self) -> None:
        if not 0.0 < self.contamination < 0.5:
            raise ValueError("contamination must lie in (0, 0.5)")
        if self.n_trees < 1 or self.max_samples < 2:
            raise ValueError("need at least one tree and two samples")


@dataclass(frozen=True)
class RetrainPolicy:
    """First fit at ``first`` usable rows, then at every ``every``-th trade of the symbol."""

    first: int = 100
    every: int = 3000
    min_history: int = 50


@dataclass(frozen=True)
class AlertConfig:
    """Which detections may alert, and how often one (symbol, type) may repeat."""

    cooldown_seconds: int = 60
    lookback_minutes: int = 5
    enabled_methods: tuple[str, ...] = ("z_score", "filtered_isoforest")


@dataclass(frozen=True)
class InjectionConfig:
    """Synthetic anomalies for evaluation runs.

    Picks come from a hash of ``trade_id``, so a re-run or a retried task injects the same trades.
    """

    rate: float = 0.01
    magnitude_pct: float = 2.0
    # Multiplier and label of each spike kind.
    kinds: tuple[tuple[float, str], ...] = field(
        default=(
            (1.05, "price_spike_5pct"),
            (0.95, "price_drop_5pct"),
            (1.08, "price_spike_8pct"),
            (0.92, "price_drop_8pct"),
        )
    )
