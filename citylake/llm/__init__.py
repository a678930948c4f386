"""Operators of a training-data pipeline. Nothing else in citylake imports this subpackage."""
