"""Operators for building training corpora: duplicates, privacy, packing,
quality, decontamination and archives, each as a Spark job."""
