"""Model jobs: sums on executors, coefficient-sized algebra on the driver."""
