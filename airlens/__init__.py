"""airlens: environmental sensor analytics on Spark.

The user-level API; everything returns lazy DataFrames or running
StreamingQueries.
"""

from .functions.predicates import Box, Period
from .operators.align import align_on_time, first_group, pair_first
from .operators.profile import profile
from .operators.ranking import rank_within
from .operators.regression import (compare, comparison_lines, feature_label, fit_linear, load_linear, load_pa,
                                   pa_fit, pa_fit_groups, predict_linear, predict_pa, rmse_lines, save_linear,
                                   save_pa)
from .operators.series import SeriesIndex
from .plans.apps import stream_report_job, stream_score_job
from .plans.ingest import ingest_readings, read_ingested, region_report_ingested
from .plans.merge import merge, merge_files, write_merged
from .plans.report import region_readings, region_report, report_lines
from .plans.train import load_models, train, train_files
from .session import build_session, cluster_settings, ensure_checkpoint_dir
from .sinks.results import create_result_table, drop_result_table, latest_results, read_results
from .sources.records import read_merged, read_pollution, read_records, read_traffic
from .sources.weather import read_weather
from .streaming.replay import replay
from .streaming.report import stream_region_report, stream_window_profile
from .streaming.score import stream_score
from .streaming.sources import decode, file_lines, topic_lines

__all__ = [
    "align_on_time", "Box", "build_session", "cluster_settings", "compare", "comparison_lines",
    "create_result_table", "decode", "drop_result_table", "ensure_checkpoint_dir", "feature_label",
    "file_lines", "first_group", "fit_linear", "ingest_readings", "latest_results", "load_linear",
    "load_models", "load_pa", "merge", "merge_files", "pa_fit", "pa_fit_groups", "pair_first", "Period",
    "predict_linear", "predict_pa", "profile", "rank_within", "read_ingested", "read_merged", "read_pollution",
    "read_records", "read_results", "read_traffic", "read_weather", "region_readings", "region_report",
    "region_report_ingested", "replay", "report_lines", "rmse_lines", "save_linear", "save_pa", "SeriesIndex",
    "stream_region_report", "stream_report_job", "stream_score", "stream_score_job", "stream_window_profile",
    "topic_lines", "train", "train_files", "write_merged",
]
