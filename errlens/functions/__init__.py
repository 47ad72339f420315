"""Scalar column expressions (all built-in, JVM-side, codegen-friendly)."""

from errlens.functions.columns import (
    binarize, correct, month_key, month_label, stable_bucket, class_probability,
    confidence, threshold_decision, coerce_numeric, percent_text, short_id,
    param_value, vector_column,
)

__all__ = [
    "binarize", "correct", "month_key", "month_label", "stable_bucket",
    "class_probability", "confidence", "threshold_decision", "coerce_numeric",
    "percent_text", "short_id", "param_value", "vector_column",
]
