"""Operators of a training-data pipeline.  Nothing outside this folder imports it
except the registry hook in ``__spark_entry__.py`` and ``corpus_pipeline.py``."""
