from headway.plans.pipeline import Migration, run_all

__all__ = ["Migration", "run_all"]
