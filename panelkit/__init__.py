"""panelkit: a PySpark toolkit for building weekly event-count panels from
messy snapshot sources and modelling them series by series.

Every operator is a lazy ``DataFrame -> DataFrame`` function. Nothing here
collects a fact table to the driver; the few small driver-side values are
summary numbers (at most a few hundred per call).
"""

from panelkit.session import get_session, work_dir

__all__ = ["get_session", "work_dir"]
