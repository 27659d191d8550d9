"""flexspark: cleaning and reshaping of data whose schema is inconsistent, on plain Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from flexspark.frame import FlexFrame, FrameSet  # noqa: E402
from flexspark.operators.choice import ResolveOption  # noqa: E402
from flexspark.sources.bookmarks import Bookmarks  # noqa: E402
from flexspark.sources.read import FlexDataFrameReader, FlexReader  # noqa: E402
from flexspark.sources.write import FlexWriter  # noqa: E402
from flexspark.streaming.batches import for_each_batch, sample_stream  # noqa: E402

__all__ = [
    "Bookmarks", "FlexDataFrameReader", "FlexFrame", "FlexReader", "FlexWriter", "FrameSet", "ResolveOption",
    "for_each_batch", "sample_stream",
]
