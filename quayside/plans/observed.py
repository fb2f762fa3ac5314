"""Observed metrics of a write."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Observation


def observed_metrics(obs: Observation) -> dict:
    """The metrics; none if adaptive execution removed an empty plan before it reported.

    That one case is told by the failed conversion of a row without a schema; any other
    error is raised.
    """
    try:
        return obs.get
    except Py4JJavaError as e:
        if "PythonSQLUtils.toPyRow" in str(e) and "AssertionError" in str(e):
            return {}
        raise
