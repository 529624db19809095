"""Job parameters. Every limit used by the library has its default here."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Experiment:
    name: str
    kind: str
    options: dict = field(default_factory=dict)


# The four experiments compared against the rule baseline.
DEFAULT_EXPERIMENTS = (
    Experiment("logreg_balanced", "logreg", {"C": 1.0, "balanced": True, "max_iter": 2000}),
    Experiment("gbt_default", "gbt", {"step": 0.1, "max_iter": 200, "leaves": 31, "balanced": True}),
    Experiment(
        "gbt_tuned", "gbt",
        {"step": 0.05, "max_iter": 400, "leaves": 15, "l2": 1.0, "min_leaf": 50, "balanced": True},
    ),
    Experiment(
        "gbt_calibrated", "gbt",
        {"step": 0.05, "max_iter": 300, "leaves": 15, "l2": 1.0, "min_leaf": 50, "calibrate": True},
    ),
)


@dataclass(frozen=True)
class Params:
    # Limits every result depends on.
    seed: int = 42

    min_rows: int = 5000
    max_missing_rate: float = 0.6
    min_label_rate: float = 0.02
    max_label_rate: float = 0.5
    exclude_discharge_ids: tuple[int, ...] = (11, 13, 14, 19, 20, 21)

    test_size: float = 0.15
    val_size: float = 0.15

    top_k_frac: float = 0.20
    min_group_positives: int = 100
    experiments: tuple[Experiment, ...] = DEFAULT_EXPERIMENTS

    min_pr_auc: float = 0.15
    min_gain_over_baseline: float = 0.01
    max_regression_vs_champion: float = 0.005
    max_brier: float = 0.25
    max_model_size_mb: float = 50.0
    max_fairness_gap: float = 0.10
    # Ours: batch scoring replaces single-row latency.
    max_score_seconds_per_million_rows: float = 600.0

    psi_threshold: float = 0.2
    drift_share_threshold: float = 0.2
    pred_psi_threshold: float = 0.2
    min_labels: int = 300
    min_predictions: int = 100
    perf_drop_threshold: float = 0.05
    label_shift_threshold: float = 0.05
    window_size: int = 2000
    new_train_share: float = 0.7

    slo_p95_ms: float = 300.0
    slo_p50_ms: float = 100.0
    slo_error_rate: float = 0.01
    slo_min_rps: float = 30.0
