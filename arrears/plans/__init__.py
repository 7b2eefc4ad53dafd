from .pipeline import run_pipeline  # noqa: F401
from .preprocess import features_table, preprocess, scored_table  # noqa: F401
from .train import TrainResult, prepare_splits, train  # noqa: F401
