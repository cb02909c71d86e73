"""Operators for training-data pipelines: each numbered operator lives in its
own module; nothing outside this subpackage imports it."""
