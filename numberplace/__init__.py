"""Tables of telephone-number place records on Spark.

Generate them, load and check them, count exact places, look records up by
place, operator or code, singly with pages or in bulk, and sample.
"""

from numberplace.functions.match import with_keys
from numberplace.operators.bulk import bulk_lookup_rows, bulk_lookup_summary
from numberplace.operators.counts import pair_count, place_counts
from numberplace.operators.paging import cursor, find_records, lookup, page_after, page_rows, page_summary
from numberplace.operators.profile import column_profile, load_profile
from numberplace.operators.sampling import partition_ids, sample_exact, sample_native
from numberplace.plans.jobs import run_pair_count, run_report, run_sampling
from numberplace.session import scratch
from numberplace.sources.csv_files import load_csv, write_csv
from numberplace.sources.generate import generate, records_from
from numberplace.sources.results import read_result, write_result
from numberplace.sources.tables import cached, read_table, write_table

__all__ = [
    "bulk_lookup_rows",
    "bulk_lookup_summary",
    "cached",
    "column_profile",
    "cursor",
    "find_records",
    "generate",
    "load_csv",
    "load_profile",
    "lookup",
    "page_after",
    "page_rows",
    "page_summary",
    "pair_count",
    "partition_ids",
    "place_counts",
    "read_result",
    "read_table",
    "records_from",
    "run_pair_count",
    "run_report",
    "run_sampling",
    "sample_exact",
    "sample_native",
    "scratch",
    "with_keys",
    "write_csv",
    "write_result",
    "write_table",
]
