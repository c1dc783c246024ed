"""Distributed loader for exported field-camera projects, built on Spark.

Projects, their ordered image groups ("timeseries") and image metadata with
predicted boxes are turned into seven linked target tables in one job over
all requested projects.  Everything is a lazy DataFrame; the plan has no
driver loop and collects nothing.
"""

__all__ = ["session"]
