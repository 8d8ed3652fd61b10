"""Incidents that arrive file by file, and models that follow them."""

from precinct.streaming.ingest import Ingested, ingest, new_files, read_store, store_cells
from precinct.streaming.retraining import retrain

__all__ = ["Ingested", "ingest", "new_files", "read_store", "retrain", "store_cells"]
