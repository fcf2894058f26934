"""Column-level functions: code labels, hash order, scalar helpers."""

from farecast.functions.codes import payment_label, provider_label, rate_label
from farecast.functions.hashing import hash_order
from farecast.functions.scalar import apply_scalar, comparable, inverse_zscore, zscore

__all__ = [
    "apply_scalar",
    "comparable",
    "hash_order",
    "inverse_zscore",
    "payment_label",
    "provider_label",
    "rate_label",
    "zscore",
]
