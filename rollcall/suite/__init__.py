"""Every query and operator of the library bound to the benchmark tables, with its check in SQL."""
