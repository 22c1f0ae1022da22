"""Reports, and the queries registered with the driver."""
