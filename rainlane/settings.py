"""Settings and zone layout; every operator takes its parameters from here."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from rainlane.fixed_values import LEVEL_CODES, LEVEL_DEFAULT


@dataclass(frozen=True)
class TreeGrids:
    """Cross-validation grids; the defaults are the full 27 and 12 settings.

    The default values are fixed: the reports are made for these searches.
    """

    rf: Mapping[str, tuple] = field(
        default_factory=lambda: {
            "numTrees": (50, 100, 150),
            "maxDepth": (5, 10, 15),
            "minInstancesPerNode": (1, 5, 10),
        }
    )
    gbt: Mapping[str, tuple] = field(
        default_factory=lambda: {
            "maxIter": (50, 100),
            "maxDepth": (3, 5, 7),
            "stepSize": (0.01, 0.1),
        }
    )
    folds: int = 5
    parallelism: int = 4


@dataclass(frozen=True)
class Settings:
    join_keys: tuple[str, ...] = ("date",)
    level_codes: Mapping[str, int] = field(default_factory=lambda: dict(LEVEL_CODES))
    level_default: int = LEVEL_DEFAULT
    bins: int = 8
    label: str = "reported_incidents"
    features: tuple[str, ...] = ("max_temp", "precipitation", "congestion_level_num")
    grids: TreeGrids = field(default_factory=TreeGrids)
    train_share: float = 0.7
    seed: int = 42
    # Rows without a label or a feature: "raise", or "leave_out" and report how many.
    missing: str = "raise"
    # At most about so many labelled rows are fitted on; None takes all.
    fit_rows: int | None = None
    # Rows that a task of a fit reads, about.
    rows_per_fit_task: int = 50_000
    # Raw input that can't be read: "raise", or "set_aside" in a table of its own and go on.
    corrupt: str = "raise"
    # Landed rows of files that are gone or written anew, as a share of the live ones, from
    # which on they are cleared out.
    dead_share: float = 0.5
    # Upper limit of raw files per micro-batch; None takes all that have arrived.
    files_per_batch: int | None = None
    # The weather side is broadcast only when its measured size is below this.
    broadcast_max_bytes: int = 64 << 20
    # Runs whose refined tables are kept; readers may still be at the one before the last.
    keep_runs: int = 2

    @property
    def corrupt_mode(self) -> str:
        """What the sources do with input that can't be read."""
        return {"raise": "raise", "set_aside": "keep"}[self.corrupt]


@dataclass(frozen=True)
class Layout:
    """Paths of the raw, trusted and refined zones under one root. The refined tables are those
    of ``run``, if it is named."""

    root: str
    run: str | None = None

    def at(self, *parts: str) -> str:
        return "/".join((self.root.rstrip("/"), *parts))

    def of_run(self, run: str) -> Layout:
        return replace(self, run=run)

    def run_folder(self, run: str) -> str:
        return self.at("refined", "runs", run)

    def refined(self, *parts: str) -> str:
        return "/".join((self.run_folder(self.run), *parts)) if self.run else self.at("refined", *parts)

    @property
    def raw_weather(self) -> str:
        return self.at("raw", "api")

    @property
    def raw_incidents(self) -> str:
        return self.at("raw", "mysql")

    def landed(self, side: str) -> str:
        return self.at("landed", "rows", side)

    def rejected(self, side: str) -> str:
        return self.at("landed", "rejected", side)

    def ledger(self, side: str) -> str:
        return self.at("landed", "ledger", side)

    @property
    def landed_weather(self) -> str:
        return self.landed("weather")

    @property
    def landed_incidents(self) -> str:
        return self.landed("incidents")

    def raw_rejected(self, side: str) -> str:
        return self.at("trusted", "raw_rejected", side)

    @property
    def trusted(self) -> str:
        return self.at("trusted", "joined_data")

    @property
    def trusted_by_month(self) -> str:
        return self.at("trusted", "joined_by_month")

    @property
    def trusted_sources(self) -> str:
        return self.at("trusted", "sources_by_month")

    @property
    def stage_counts(self) -> str:
        return self.at("trusted", "stage_counts")

    @property
    def refined_state(self) -> str:
        return self.at("refined", "state")

    @property
    def global_stats(self) -> str:
        return self.refined("descriptive_stats", "global_stats")

    @property
    def congestion_stats(self) -> str:
        return self.refined("descriptive_stats", "congestion_stats")

    @property
    def correlations(self) -> str:
        return self.refined("descriptive_stats", "correlations")

    @property
    def charts(self) -> str:
        return self.at("refined", "visualizations")

    @property
    def chart_metadata(self) -> str:
        return self.refined("visualizations_metadata")

    @property
    def scenario(self) -> str:
        return self.refined("models", "test_data")

    @property
    def model_evaluation(self) -> str:
        return self.refined("models", "results", "model_evaluation")

    @property
    def predictions_rf(self) -> str:
        return self.refined("models", "results", "predictions_rf")

    @property
    def predictions_gbt(self) -> str:
        return self.refined("models", "results", "predictions_gbt")

    @property
    def scored_days(self) -> str:
        return self.refined("models", "results", "scored_days")

    @property
    def model_cards(self) -> str:
        return self.refined("models", "cards")

    def model(self, name: str) -> str:
        return self.refined("models", "fitted", name.lower().replace(" ", "_"))

    @property
    def published(self) -> str:
        return self.at("refined", "published")

    def checkpoint(self, stream: str) -> str:
        return self.at("checkpoints", "landing", stream)
