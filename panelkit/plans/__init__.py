"""Model evaluation on top of the operators: folds, ablations, sweeps, tasks, staged runs."""
