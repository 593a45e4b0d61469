"""Operators for preparing training data: counting, filtering, matching, mixing and packing documents."""
