"""Inputs: fixture views over the driver's tables, stored tables, log slices."""

from tallyspark.sources.gamelogs import slice_log  # noqa: F401
from tallyspark.sources.inputs import Inputs, fixture_inputs, read_table_inputs  # noqa: F401
