"""Operators of a training-data pipeline: deduplication, decontamination,
language ID, licence scans, language-model scoring and packing.

Nothing outside this subpackage imports it, apart from the driver entry file and
``corpus_pipeline.py`` at the repository top."""
