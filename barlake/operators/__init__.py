"""Bar operators: normalization, checks, cross-validation, queries."""
