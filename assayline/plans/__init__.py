from assayline.plans.pipeline import backfill, refresh, run_day, run_days

__all__ = ["backfill", "refresh", "run_day", "run_days"]
