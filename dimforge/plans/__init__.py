"""Conformed-table builds: raw frames in, one conformed DataFrame out.

Each build is a pure function of DataFrames (no temp views, no global
state), so a plan built earlier never changes when a view is redefined, and
the order of calls cannot break a build.
"""

from dimforge.plans.field import build_field
from dimforge.plans.loads import load_all, load_field, load_planning, load_site, load_variety
from dimforge.plans.planning import ConformedTables, build_planning
from dimforge.plans.site import build_site, build_site_analysis
from dimforge.plans.variety import build_variety

__all__ = [
    "ConformedTables", "build_field", "build_planning", "build_site",
    "build_site_analysis", "build_variety", "load_all", "load_field", "load_planning",
    "load_site", "load_variety",
]
