"""DataFrame operators: columns, cleaning, profiling, charts, ordering, sampling, evaluation."""
