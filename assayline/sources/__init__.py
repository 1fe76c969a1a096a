from assayline.sources.records import read_bronze, read_records, read_rejects, split_records, write_records
from assayline.sources.products import read_products

__all__ = ["read_bronze", "read_products", "read_records", "read_rejects", "split_records", "write_records"]
