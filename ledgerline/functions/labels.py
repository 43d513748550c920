"""Display labels for keys."""

from __future__ import annotations

# Labels shown for strategy, model and metric keys.
STRATEGY_LABELS = {
    "buy_and_hold": "Buy & Hold",
    "cash": "Cash",
    "previous_day_direction": "Previous Day Direction",
    "price_above_trailing_ema_20": "Price > Trailing EMA 20",
    "positive_20d_momentum": "Positive 20D Momentum",
    "log_reg_long_cash": "Logistic Regression",
    "random_forest_long_cash": "Random Forest",
    "hist_gradient_boosting_long_cash": "Hist Gradient Boosting",
}
MODEL_LABELS = {
    "log_reg": "Logistic Regression",
    "random_forest": "Random Forest",
    "hist_gradient_boosting": "Hist Gradient Boosting",
}
METRIC_LABELS = {
    "accuracy": "Accuracy",
    "balanced_accuracy": "Balanced Accuracy",
    "f1": "F1",
}
PRIMARY_STRATEGIES = (
    "buy_and_hold",
    "price_above_trailing_ema_20",
    "positive_20d_momentum",
    "log_reg_long_cash",
    "random_forest_long_cash",
    "hist_gradient_boosting_long_cash",
)
