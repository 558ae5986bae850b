"""basketry: behavioural-log analytics for e-commerce, built on Spark DataFrames.

Every operator is a ``DataFrame -> DataFrame`` function (usable with
``DataFrame.transform``); pipelines in :mod:`basketry.plans` compose them and
the most used ones are re-exported here.
"""

__version__ = "0.1.0"

from .plans.behaviour import aggregate_log  # noqa: E402
from .plans.feature import generate_features, sort_log  # noqa: E402
from .plans.instances import build_instances, instance_stats, item_table  # noqa: E402
from .plans.metadata import prepare_metadata  # noqa: E402
from .plans.recommend import evaluate, prediction_report, recommend, similar_items  # noqa: E402
from .plans.titles import item_title_vectors, title_neighbours  # noqa: E402

__all__ = ["aggregate_log", "build_instances", "evaluate", "generate_features", "instance_stats",
           "item_table", "item_title_vectors", "prediction_report", "prepare_metadata", "recommend",
           "similar_items", "sort_log", "title_neighbours"]
