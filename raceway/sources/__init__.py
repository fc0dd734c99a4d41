from raceway.sources.buckets import lookup_stored, store_dimension, store_fact
from raceway.sources.catalogue import CATALOGUE, SourceSpec, load_specs
from raceway.sources.readers import read_csv, read_json_batches, read_source, read_warehouse
from raceway.sources.variants import field, mixed, read_json_records
from raceway.sources.writers import cluster_for_write, export_csv, write_raw, write_warehouse

__all__ = [
    "CATALOGUE",
    "SourceSpec",
    "cluster_for_write",
    "export_csv",
    "field",
    "load_specs",
    "lookup_stored",
    "mixed",
    "read_csv",
    "read_json_batches",
    "read_json_records",
    "read_source",
    "read_warehouse",
    "store_dimension",
    "store_fact",
    "write_raw",
    "write_warehouse",
]
