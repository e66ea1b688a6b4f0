"""Session-stream analytics on Spark: clip cutting, log extraction, a keyed store with time-to-live."""

import sys

from pyspark import cloudpickle

from chunklake.operators.clips import continuity_breaks, cut_clips
from chunklake.operators.logs import extract_log, filter_json_lines
from chunklake.operators.sidecar import parse_sidecar
from chunklake.operators.store import compact, latest_per_key, lookup, lookup_many, to_store_rows
from chunklake.plans.pipeline import run_pipeline, run_stream_pipeline
from chunklake.sinks.snapshot import merge_store
from chunklake.sources.runindex import index_runs, read_store_for, read_store_for_keys
from chunklake.streaming.segments import append_cut_stream, read_cut_clips

# the functions that run in tasks travel with the job, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = [
    "append_cut_stream",
    "compact",
    "continuity_breaks",
    "cut_clips",
    "extract_log",
    "filter_json_lines",
    "index_runs",
    "latest_per_key",
    "lookup",
    "lookup_many",
    "merge_store",
    "parse_sidecar",
    "read_cut_clips",
    "read_store_for",
    "read_store_for_keys",
    "run_pipeline",
    "run_stream_pipeline",
    "to_store_rows",
]
