from facetide.functions.arrays import (
    abs_error, argmax, expected_index, in_top_k, l2_penalty, reverse_channels, softmax, sparse_xent, standardize,
)
from facetide.functions.dates import age_at, safe_int, serial_to_date
from facetide.functions.images import decode_raw, image_features, image_tensor
from facetide.functions.schedule import decayed_lr
from facetide.functions.text import corpus_dir, format_result, image_path, shard_name

__all__ = [
    "abs_error", "age_at", "argmax", "corpus_dir", "decayed_lr", "decode_raw", "expected_index", "format_result",
    "image_features", "image_path", "image_tensor", "in_top_k", "l2_penalty", "reverse_channels", "safe_int", "serial_to_date",
    "shard_name", "softmax", "sparse_xent", "standardize",
]
