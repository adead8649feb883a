"""Scalable clustering of numeric vectors and profiling of their datasets, on Spark."""

from cellwise.plans.config import FitConfig, KMeansModel, SeedConfig, Seeding
from cellwise.plans.estimator import ParallelKMeans
from cellwise.plans.grid import fit_many, grid, seed_many
from cellwise.plans.lloyd import fit_centers
from cellwise.plans.reduce import reduce_candidates
from cellwise.plans.seeding import seed_candidates
from cellwise.plans.sweep import SweepConfig, sweep

__all__ = [
    "FitConfig",
    "KMeansModel",
    "ParallelKMeans",
    "SeedConfig",
    "Seeding",
    "SweepConfig",
    "fit_centers",
    "fit_many",
    "grid",
    "reduce_candidates",
    "seed_candidates",
    "seed_many",
    "sweep",
]
