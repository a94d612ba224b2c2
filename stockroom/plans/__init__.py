"""Composed plans: the end-to-end pipeline, the query catalog and plan inspection."""

from stockroom.plans.pipeline import PipelineRun, movement_cube, run_pipeline, save
from stockroom.plans.shape import plan_counts, plan_text

__all__ = ["PipelineRun", "movement_cube", "plan_counts", "plan_text", "run_pipeline", "save"]
