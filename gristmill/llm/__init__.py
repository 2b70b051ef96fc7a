"""Operators for preparing training data: filters, duplicate removal, extraction, classifiers, packing and search."""
