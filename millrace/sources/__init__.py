from millrace.sources.landing import landing_manifest, landing_schema, read_landing
from millrace.sources.star import retail_records
from millrace.sources.tables import Store, write_csv

__all__ = ["Store", "landing_manifest", "landing_schema", "read_landing", "retail_records", "write_csv"]
