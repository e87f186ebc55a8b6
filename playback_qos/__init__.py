"""Playback quality-of-service layers (bronze -> validated -> silver -> gold) on Spark.

Common entry points::

    from playback_qos import get_spark, Layout, run_batch, write_layers, jobs
"""

from playback_qos.plans.layers import run_batch, write_layers
from playback_qos.session import get_spark
from playback_qos.streaming import jobs
from playback_qos.streaming.layout import Layout

__version__ = "0.1.0"

__all__ = ["Layout", "get_spark", "jobs", "run_batch", "write_layers"]
