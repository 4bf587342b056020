"""DataFrame-in, DataFrame-out steps. None of them collects rows to the driver."""
