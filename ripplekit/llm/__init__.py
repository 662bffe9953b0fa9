"""Operators of a training-data pipeline: deduplication, scoring, search,
fingerprints, mixing, packing and personal data.  Nothing else in the library
imports this subpackage."""
