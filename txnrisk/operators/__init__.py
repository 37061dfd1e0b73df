"""DataFrame operators of the workload."""
