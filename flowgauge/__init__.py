"""Flow analytics on event tables: roll-ups, profiles, features, forecasts and reports on Spark."""

from flowgauge.models.competition import fit_daily_models, fit_slot_models
from flowgauge.models.forecast import forecast_recursive, forecast_slots, linear_predictor, model_predictor
from flowgauge.operators.features import daily_features, slot_features, standardize
from flowgauge.operators.flow import daily_totals, merge_directions
from flowgauge.operators.quality import missing_days, quality_audit, unmapped
from flowgauge.operators.series import gap_fill, linspace_grid, rolling_mean, slot_grid
from flowgauge.operators.spline import spline_densify
from flowgauge.operators.stats import best_model, describe_exact, regression_metrics, tail_mean
from flowgauge.plans.cleaning import clean_swipes
from flowgauge.plans.jobs import run_daily_forecast, run_profiles, run_rollup, run_slot_forecast
from flowgauge.plans.profiles import date_label, line_hourly_curve, line_hourly_profile, line_station_profile
from flowgauge.plans.report import build_report
from flowgauge.plans.rollup import daily_flow, observed_flow, station_flow
from flowgauge.streaming.flow_stream import flow_stream, run_available

__all__ = [name for name in dir() if not name.startswith("_")]
