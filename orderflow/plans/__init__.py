from orderflow.plans.dimensions import refresh_dimensions, refresh_store
from orderflow.plans.outcall import run_outcall
from orderflow.plans.receive import run_receive
from orderflow.plans.reports import rebuild_reports, refresh_reports
from orderflow.plans.save import merge_run, save_run, start_store

__all__ = ["merge_run", "rebuild_reports", "refresh_dimensions", "refresh_reports",
           "refresh_store", "run_outcall", "run_receive", "save_run", "start_store"]
