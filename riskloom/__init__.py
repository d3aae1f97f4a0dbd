"""Transaction risk analytics on Spark DataFrames."""

from riskloom.operators.aggregation import create_aggregation_features
from riskloom.operators.ensemble import blend_predictions, optimize_weights, rank_average
from riskloom.operators.evaluation import evaluate_model, roc_auc
from riskloom.operators.interaction import create_interaction_features
from riskloom.operators.missing import create_missing_value_features
from riskloom.operators.ordering import time_split
from riskloom.operators.pipeline import FeatureBuilder, build_features
from riskloom.operators.preprocess import Preprocessor, quick_preprocess
from riskloom.operators.temporal import create_temporal_features
from riskloom.operators.training import Baseline, Stacking, cross_validate, train_baseline_model
from riskloom.operators.tuning import FeatureSearch, Tuner, quick_feature_selection, quick_tune, staged_tune
from riskloom.session import build_session, intermediates
from riskloom.sources.tables import load_data, validate_submission, write_submission

__all__ = [
    "Baseline", "FeatureBuilder", "FeatureSearch", "Preprocessor", "Stacking", "Tuner", "blend_predictions",
    "build_features", "build_session", "create_aggregation_features", "create_interaction_features",
    "create_missing_value_features", "create_temporal_features", "cross_validate", "evaluate_model", "intermediates",
    "load_data", "optimize_weights", "quick_feature_selection", "quick_preprocess", "quick_tune", "rank_average", "roc_auc",
    "staged_tune", "time_split", "train_baseline_model", "validate_submission", "write_submission",
]
