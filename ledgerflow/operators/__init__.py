"""DataFrame-in, DataFrame-out building blocks; some stage an intermediate result."""
