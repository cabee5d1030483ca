"""Telemetry analytics (logs, traces, metrics) as Spark DataFrame functions.

Every operator takes DataFrames and returns a lazy DataFrame built from Catalyst expressions;
nothing is collected on the driver inside an operator.
"""

__version__ = "0.1.0"
